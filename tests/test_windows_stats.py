"""Hour windows, reorder, window statistics, hourly counts."""

import pytest
from conftest import SF_SMALL, docs_df

from pyspark.sql import functions as F

from skytrace.operators import stats, windows
from skytrace.operators.flatten import flatten_docs
from skytrace.plans import queries as Q
from skytrace.plans.params import WINDOWS


def _hours(spark, hours):
    return spark.createDataFrame([(i, h) for i, h in enumerate(hours)], "id INT, hour INT")


def test_half_open_and_no_wrap(spark):
    df = _hours(spark, [0, 1, 2, 3, 4, 11, 12, 13, None])
    assert sorted(r.hour for r in windows.filter_hours(df, 1, 4).collect()) == [1, 2, 3]
    assert windows.filter_hours(df, 22, 2).count() == 0


def test_tag_windows(spark):
    df = _hours(spark, [0, 1, 3, 4, 11, 12, 13])
    got = sorted((r.hour, r.window) for r in windows.tag_windows(df, WINDOWS).collect())
    assert got == [(1, "0100-0400"), (3, "0100-0400"), (11, "1100-1300"), (12, "1100-1300")]
    t = windows.tag_windows(df, WINDOWS + [("0000-2400", 0, 24)], keep_outside=True)
    assert t.where("first_tag").count() == 7 and t.count() == 11


def test_reorder_and_required(spark):
    p = Q.points(spark, SF_SMALL)
    r = windows.reorder_window_columns(p)
    assert r.columns[:8] == ["datetime_utc", "icao", "latitude", "longitude", "altitude_ft",
                             "geometric_altitude_ft", "track_deg", "flags_bitfield"]
    with pytest.raises(ValueError):
        windows.reorder_window_columns(p.drop("track_deg"))
    with pytest.raises(ValueError):
        windows.require_columns(p.drop("icao"))


def test_valid_positions_counts_what_the_operator_leaves(spark, monkeypatch):
    trace = '[[1,1.5,104.5],[2,null,104.5],[3,1.5,null],[4,"NaN",104.5],[5,1.5,"NaN"],[6,1.6,104.6],[7,1.6,104.6]]'
    known = f'{{"icao":"7380e5","timestamp":1738976400,"trace":{trace}}}'
    unknown = f'{{"timestamp":1738976400,"trace":{trace}}}'
    p = flatten_docs(docs_df(spark, [
        ("a", "2025.02.08", known), ("b", "2025.02.08", unknown), ("c", "2025.02.09", unknown), ("d", None, known), ("e", None, known)]))
    monkeypatch.setattr(Q, "points", lambda spark, sf_dir: p)
    got = Q.q_valid_positions(spark, SF_SMALL)
    assert {tuple(r) for r in got.collect()} == {("2025.02.08", 14, 3), ("2025.02.09", 7, 0), (None, 14, 6)}
    left = Q.valid(spark, SF_SMALL).groupBy("source_date").count()
    assert {tuple(r) for r in got.select("source_date", "n_valid").where("n_valid > 0").collect()} == {tuple(r) for r in left.collect()}


def test_counts_add_up(spark):
    p = Q.points(spark, SF_SMALL)
    total = p.count()
    hc = stats.hourly_counts(p)
    assert hc.agg(F.sum("n_rows")).first()[0] == total
    assert hc.count() == 24 * p.select("source_date").distinct().count()
    ws = {(r.source_date, r.window): r for r in stats.window_stats(p, WINDOWS).collect()}
    per_date = {r.source_date: r[1] for r in p.groupBy("source_date").count().collect()}
    for (d, w), r in ws.items():
        assert r.rows_before == per_date[d] and r.rows_after <= r.rows_before
        assert r.unique_aircraft <= r.rows_after
