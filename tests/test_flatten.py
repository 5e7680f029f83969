"""Flatten rules (F2 fixture cases): short/empty/long/bad entries, unions, ids."""

import datetime as dt

from conftest import docs_df

from skytrace.operators.flatten import doc_status, flatten_docs

FULL = '[1.5,1.6,104.7,"ground",null,1.0,2,null,{"flight":"ABC1 ","true_heading":12.5},"adsb_icao",null,null,null,null]'
NUM = '[2,1.61,104.71,3500,180.5,90.0,0,640,null,"mlat",3600,650,170.0,-1.5]'


def _doc(trace, extra='"icao":"7380e5","timestamp":1738976400.123,"dbFlags":2'):
    return "{" + extra + ',"trace":[' + ",".join(trace) + "]}"


def test_documented_example(spark):
    d = docs_df(spark, [("a/2025.02.08/trace_full_7380e5.json", "2025.02.08", _doc([FULL, NUM]))])
    rows = {r.seq: r for r in flatten_docs(d).collect()}
    g, n = rows[0], rows[1]
    assert g.icao == "7380e5" and g.dbFlags == 2
    assert g.altitude_ft == "ground" and g.on_ground is True and g.altitude_ft_num is None
    assert g.aircraft_metadata == '{"flight":"ABC1 ","true_heading":12.5}'
    assert g.source_type == "adsb_icao" and g.flags_bitfield == 2
    assert n.altitude_ft == "3500" and n.altitude_ft_num == 3500 and n.on_ground is False
    assert n.geometric_altitude_ft == 3600 and n.roll_angle_deg == -1.5 and n.vertical_rate_fpm == 640
    assert g.datetime_utc == dt.datetime(2025, 2, 8, 1, 0, 1, 623000)
    assert g.hour == 1


def test_short_empty_long_entries(spark):
    trace = ["[2,1.6,104.7,3500]", "[]", "[3,1,2,3,4,5,6,7,null,\"x\",10,11,12,13,99,100]"]
    d = docs_df(spark, [("p", "2025.02.08", _doc(trace))])
    rows = {r.seq: r for r in flatten_docs(d).collect()}
    assert rows[0].altitude_ft == "3500" and rows[0].ground_speed_kts is None and rows[0].roll_angle_deg is None
    assert rows[1].seconds_after_timestamp is None and rows[1].latitude is None
    assert rows[1].datetime_utc == dt.datetime(2025, 2, 8, 1, 0, 0, 123000)
    assert rows[2].roll_angle_deg == 13.0


def test_bad_entries_skipped_and_counted(spark):
    trace = [NUM, "null", "7", '{"k":2}', NUM]
    d = docs_df(spark, [("p", "2025.02.08", _doc(trace))])
    assert sorted(r.seq for r in flatten_docs(d).collect()) == [0, 4]
    st = doc_status(d).first()
    assert (st.n_entries, st.n_bad_entries, st.n_rows, st.status) == (5, 3, 2, "processed")


def test_bad_document_and_empty_trace_fail(spark):
    d = docs_df(spark, [("bad", "2025.02.08", "{bad"), ("empty", "2025.02.08", _doc([])),
                        ("nots", "2025.02.08", '{"icao":"a","trace":[[1,2,3]]}'),
                        ("nulloff", "2025.02.08", _doc(["[null,1,2]"]))])
    assert flatten_docs(d).count() == 0
    st = {r.path: r for r in doc_status(d).collect()}
    assert st["bad"].parsed is False and st["bad"].status == "failed"
    assert st["empty"].status == "failed" and st["empty"].n_entries == 0
    assert st["nots"].status == "failed" and st["nulloff"].status == "failed"


def test_hex_id_stays_text_and_float_ints(spark):
    d = docs_df(spark, [("p", "2025.02.08", _doc(['[1,1,1,3500.0,1,1,3.0,2.0]'], '"icao":"000e10","timestamp":1738976400'))])
    r = flatten_docs(d).first()
    assert r.icao == "000e10" and r.altitude_ft_num == 3500 and r.flags_bitfield == 3 and r.vertical_rate_fpm == 2


def test_midnight_spill_stays_in_source_date(spark):
    d = docs_df(spark, [("p", "2025.02.08", _doc(["[86400.5,1,1]", "[90000,1,1]"], '"icao":"a","timestamp":1738972800'))])
    rows = sorted(flatten_docs(d).collect(), key=lambda r: r.seq)
    assert [r.source_date for r in rows] == ["2025.02.08", "2025.02.08"]
    assert [r.hour for r in rows] == [0, 1]
    assert rows[0].datetime_utc.date() == dt.date(2025, 2, 9)


from hypothesis import given, settings
from hypothesis import strategies as st

_elem = st.one_of(st.none(), st.integers(-5, 5), st.floats(0, 1000, allow_nan=False), st.just('"ground"'))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(_elem, min_size=0, max_size=16), min_size=0, max_size=12))
def test_flatten_keeps_every_entry_with_a_time(spark, entries):
    def txt(v):
        return "null" if v is None else (v if isinstance(v, str) else repr(v))

    trace = ["[" + ",".join(txt(v) for v in e) + "]" for e in entries]
    d = docs_df(spark, [("p", "2025.02.08", _doc(trace))])
    n_time = sum(1 for e in entries if not e or (e[0] is not None and not isinstance(e[0], str)))
    assert flatten_docs(d).count() == n_time
    st_row = doc_status(d).first()
    assert st_row.n_entries == len(entries) and st_row.n_rows == n_time and st_row.n_bad_entries == 0


def test_empty_input_flows_through(spark):
    from skytrace.operators import stats, tracks
    from skytrace.plans.params import WINDOWS

    d = docs_df(spark, [])
    p = flatten_docs(d)
    assert p.count() == 0
    assert stats.hourly_counts(p).count() == 0
    assert stats.window_stats(p, WINDOWS).count() == 0
    assert tracks.track_summary(p).count() == 0
