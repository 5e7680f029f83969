"""Zones: DMS parsing, ring rules, strict point-in-polygon, grid join."""

import random
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skytrace.functions.geo import dms_to_decimal
from skytrace.operators import spatial
from skytrace.operators.spatial import MAX_INDEX_BYTES, TARGET_CELLS, cell_index, zone_join, zone_tags
from skytrace.plans.params import ZONES_DMS
from skytrace.sources.zones import zones_from_pairs

BOX = ZONES_DMS["box"]


def test_dms(spark):
    vals = ["013000N", "1043600E", " 013000s ", "013000Nxx", "01.3000N", "0130N", "1800000W", "\t013000n\r"]
    df = spark.createDataFrame([(v,) for v in vals], "v STRING")
    got = [r[0] for r in df.select(dms_to_decimal("v")).collect()]
    assert got[:4] == [1.5, 104.6, -1.5, 1.5]
    assert got[4] is None and got[5] is None and got[6] == -180.0 and got[7] == 1.5


def _pts(spark, pts):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "id INT, longitude DOUBLE, latitude DOUBLE")


def test_box_corner_edge_centre_outside(spark):
    z = zones_from_pairs(spark, {"box": BOX})
    p = _pts(spark, [(104.6, 2.0), (106.0, 2.5), (105.0, 2.0), (104.59, 2.0), (105.0, 1.5), (104.6, 1.5)])
    inside = sorted(r.id for r in zone_join(p, z).collect())
    assert inside == [2]


def test_ring_rules(spark):
    z = zones_from_pairs(spark, {
        "open": BOX, "closed": BOX + "013000N 1043600E\n", "two": "013000N 1043600E\n023000N 1043600E\n",
        "bad": "013000N 1043600E\n0230 1043600E\n023000N 1060000E\n", "comma": "013000N 1043600E,x\n\n023000N 1043600E\n023000N 1060000E\n",
    })
    r = {x.zone: x for x in z.collect()}
    assert r["open"].n_vertices == 4 and len(r["open"].ring) == 5 and r["open"].valid
    assert r["closed"].n_vertices == 5 and len(r["closed"].ring) == 5 and r["closed"].valid
    assert not r["two"].valid and "3 coordinates" in r["two"].error
    assert not r["bad"].valid and "invalid vertex" in r["bad"].error
    assert r["comma"].valid and r["comma"].n_vertices == 3
    assert (r["open"].ring[0].lon, r["open"].ring[0].lat) == (104.6, 1.5)


def test_concave_notch(spark):
    z = zones_from_pairs(spark, {"ell": ZONES_DMS["ell"]})
    # Inside the L's foot, inside its stem, and in the notch (outside).
    p = _pts(spark, [(105.5, 1.5), (104.7, 2.5), (105.5, 2.5)])
    assert sorted(r.id for r in zone_join(p, z).collect()) == [0, 1]


def _ring_text(coords):
    def dms(v, pos, neg, width):
        h = pos if v >= 0 else neg
        v = abs(v)
        d = int(v)
        m = int(round((v - d) * 60))
        return f"{d:0{width}d}{m:02d}00{h}"

    return "\n".join(f"{dms(lat, 'N', 'S', 2)} {dms(lon, 'E', 'W', 3)}" for lon, lat in coords)


@settings(max_examples=15, deadline=None)
@given(st.integers(0, 5), st.booleans())
def test_rotation_and_reversal_invariant(spark, shift, rev):
    tri = [(104.2, 1.1), (105.5, 2.9), (106.3, 1.2)]
    coords = tri[shift % 3:] + tri[: shift % 3]
    if rev:
        coords = coords[::-1]
    z = zones_from_pairs(spark, {"a": _ring_text(tri), "b": _ring_text(coords)})
    pts = [(104.0 + i * 0.05, 1.0 + j * 0.1) for i in range(50) for j in range(20)]
    j = zone_join(_pts(spark, pts), z)
    a = {r.id for r in j.where("zone = 'a'").collect()}
    b = {r.id for r in j.where("zone = 'b'").collect()}
    assert a == b and len(a) > 0


def _inside_by_hand(x, y, ring):
    """Even-odd with the boundary outside, in exact fractions."""
    x, y, odd = Fraction(x), Fraction(y), False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:], strict=False):
        x1, y1, x2, y2 = map(Fraction, (x1, y1, x2, y2))
        c = (x2 - x1) * (y - y1) - (x - x1) * (y2 - y1)
        if c == 0 and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
            return False
        if (y1 > y) != (y2 > y) and (c > 0) == (y2 > y1):
            odd = not odd
    return odd


SHAPES = {
    **ZONES_DMS,
    "star": _ring_text([(104.0, 2.0), (105.5, 2.25), (106.0, 4.0), (106.5, 2.25), (108.0, 2.0), (106.5, 1.75), (106.0, 0.0), (105.5, 1.75)]),
    "bow": _ring_text([(104.0, 1.0), (106.0, 3.0), (106.0, 1.0), (104.0, 3.0)]),  # crosses itself
    "thin": _ring_text([(104.0, 1.5), (108.0, 1.55), (104.0, 1.6)]),
    "south": _ring_text([(-71.0, -34.0), (-70.0, -34.0), (-70.0, -33.0), (-71.0, -33.0)]),
}


@pytest.mark.parametrize("cell_deg", [None, 0.25, 0.0625, 4.0])
def test_cell_index_equals_edge_test(spark, cell_deg):
    z = zones_from_pairs(spark, SHAPES)
    rings = {r.zone: [(v.lon, v.lat) for v in r.ring] for r in z.where("valid").collect()}
    r = random.Random(4)
    pts = [(104.0 + i * 0.125, j * 0.125) for i in range(36) for j in range(34)]  # on cell borders, edges and corners
    pts += [(r.uniform(103.9, 108.1), r.uniform(-0.1, 4.1)) for _ in range(1500)]
    pts += [(r.uniform(-71.2, -69.8), r.uniform(-34.2, -32.8)) for _ in range(300)] + [p for ring in rings.values() for p in ring]
    want = sorted((i, zone) for i, (x, y) in enumerate(pts) for zone, ring in rings.items() if _inside_by_hand(x, y, ring))
    index = cell_index(z, cell_deg)
    p = _pts(spark, pts)
    assert sorted((x.id, x.zone) for x in zone_join(p, index).collect()) == want
    tags = {x.id: x.zones for x in zone_tags(p, index).collect()}
    assert sorted((i, zone) for i, zs in tags.items() for zone in zs) == want and len(tags) == len(pts)
    assert all(zs == sorted(zs) for zs in tags.values())


def test_index_cells(spark):
    index = cell_index(zones_from_pairs(spark, SHAPES))
    n = {r.inside: (r.n, r.e) for r in index.cells.groupBy("inside").agg(F.count("*").alias("n"), F.max(F.size("edges")).alias("e")).collect()}
    assert n[True][0] > n[False][0] and n[True][1] == 0  # most cells need no edge test
    assert sum(x[0] for x in n.values()) <= TARGET_CELLS and 0 < index.n_bytes < MAX_INDEX_BYTES


def test_large_index_is_shuffled(spark, monkeypatch):
    index = cell_index(zones_from_pairs(spark, ZONES_DMS))
    p = spark.range(3000).selectExpr("cast(id as int) id", "104 + id % 60 * 0.037 longitude", "1 + id % 50 * 0.041 latitude")
    want = sorted((r.id, r.zone) for r in zone_join(p, index).collect())
    tags = sorted((r.id, *r.zones) for r in zone_tags(p, index).collect())
    monkeypatch.setattr(spatial, "MAX_INDEX_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = zone_join(p, index)
        assert "Broadcast" not in j._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.id, r.zone) for r in j.collect()) == want and len(want) > 100
        assert sorted((r.id, *r.zones) for r in zone_tags(p, index).collect()) == tags
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_null_positions_and_no_zones(spark):
    p = spark.createDataFrame([(1, None, 2.0), (2, 105.0, None), (3, 105.0, 2.0)], "id INT, longitude DOUBLE, latitude DOUBLE")
    index = cell_index(zones_from_pairs(spark, {"box": BOX}))
    assert [r.id for r in zone_join(p, index).collect()] == [3]
    assert {r.id: r.zones for r in zone_tags(p, index).collect()} == {1: [], 2: [], 3: ["box"]}
    none = zones_from_pairs(spark, {"two": "013000N 1043600E\n023000N 1043600E\n"})
    assert zone_join(p, none).count() == 0 and zone_tags(p, none).count() == 3
    with pytest.raises(ValueError, match="two: need at least 3 coordinates"):
        cell_index(none, strict=True)
