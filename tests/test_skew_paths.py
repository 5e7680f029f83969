"""Sequence queries give the oracle's answer when every aircraft is hot.

With ``rows_per_split = 2`` every aircraft-day (and every date, for ranks)
is split into buckets, so the carry stitching of ``sequence_scan`` decides
every result.
"""

import pytest
from test_oracle import _rows, con  # noqa: F401  (fixture)
from conftest import SF_SMALL

import __spark_entry__ as E
from skytrace.operators import sequence

SEQUENCE_QUERIES = ["legs", "movements", "zone_visits", "tracks", "track_summary", "track_features"]


@pytest.mark.parametrize("name", SEQUENCE_QUERIES)
def test_split_path_matches_oracle(spark, con, monkeypatch, name):  # noqa: F811
    monkeypatch.setattr(sequence, "DEFAULT_ROWS_PER_SPLIT", 2)
    df = E.queries()[name](spark, SF_SMALL)
    r = con.sql(E.oracle_sql()[name])
    assert _rows(df.columns, df.collect()) == _rows(r.columns, r.fetchall())


def test_small_split_makes_hot_keys(spark):
    from skytrace.plans import queries as Q

    v = Q.valid(spark, SF_SMALL)
    hot = sequence._hot_keys(v, ["source_date", "icao"], 2)
    assert hot.count() > 10
