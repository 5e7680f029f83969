"""Typed metadata fields and lists: kinds, missing fields, bad texts."""

from skytrace.operators import movement as mv


def points(spark, texts):
    rows = [("2025.02.08", "aaaaaa", "p", i, None, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "source_date STRING, icao STRING, path STRING, seq INT, datetime_utc TIMESTAMP_NTZ, aircraft_metadata STRING")


def test_kinds(spark):
    texts = ['{"alt_baro":"ground","nic":8.0,"version":2,"flight":" AB1 ","gs":"fast","seen":1}', '{"alt_baro":1200.0,"nic":"x","messages":5000000000}',
             '{"alt_baro":-25,"mach":0.5}', "{}", "no json", None]
    got = [(r.alt_baro, r.nic, r.version, r.flight, r.gs, r.seen, r.messages, r.mach) for r in mv.metadata_fields(points(spark, texts)).collect()]
    assert got == [("ground", 8, 2, "AB1", None, 1.0, None, None), ("1200", None, None, None, None, None, 5000000000, None),
                   ("-25", None, None, None, None, None, None, 0.5), (None,) * 8, (None,) * 8]


def test_lists(spark):
    texts = ['{"nav_modes":["autopilot","vnav"],"tisb":[],"mlat":["lat"]}', '{"nav_modes":"lnav"}', '{"tisb":["gs"]}', "[1]", None]
    got = sorted((r.seq, r.field, r.place, r.item) for r in mv.metadata_lists(points(spark, texts)).collect())
    assert got == [(0, "mlat", 0, "lat"), (0, "nav_modes", 0, "autopilot"), (0, "nav_modes", 1, "vnav"), (2, "tisb", 0, "gs")]
