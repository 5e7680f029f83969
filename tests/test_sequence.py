"""Skew-safe sequence scan equals a plain window, also when hot keys split."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skytrace.operators.sequence import sequence_scan, split_rows


@pytest.fixture(scope="module")
def skewed(spark):
    # One hot key with most rows, several small keys; ties broken by id.
    rows = [("hot", i * 7 % 1000, i) for i in range(3000)]
    rows += [(f"k{k}", (i * 13) % 50, 10_000 + k * 100 + i) for k in range(20) for i in range(30)]
    return spark.createDataFrame(rows, "key STRING, t BIGINT, id BIGINT").withColumn(
        "flag", ((F.col("id") % 3) == 0).cast("int")
    )


@pytest.mark.parametrize("rows_per_split", [1_000_000, 100, 7])
def test_scan_matches_window(skewed, rows_per_split):
    s = sequence_scan(
        skewed, ["key"], ["t", "id"], row_number="pos",
        running_sums={"cum": F.col("flag")}, lags={"prev_id": "id"}, rows_per_split=rows_per_split,
    )
    w = Window.partitionBy("key").orderBy("t", "id")
    ref = skewed.select(
        "id", F.row_number().over(w).alias("pos2"), F.sum("flag").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum2"),
        F.lag("id").over(w).alias("prev2"),
    )
    got = {r.id: (r.pos, r.cum, r.prev_id) for r in s.collect()}
    want = {r.id: (r.pos2, r.cum2, r.prev2) for r in ref.collect()}
    assert got == want


def test_null_keys_go(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("a", 0)], "key STRING, t BIGINT")
    assert sorted((r.t, r.pos) for r in sequence_scan(df, ["key"], ["t"], rows_per_split=1).collect()) == [(0, 1), (1, 2)]


def test_hot_key_is_split(skewed):
    sizes = split_rows(skewed, ["key"], ["t", "id"], skewed.count(), 100).groupBy("_split").count()
    assert sizes.count() >= 30 and sizes.agg(F.max("count")).first()[0] <= 200


def test_rows_of_one_instant_are_split(spark):
    """All rows of a hot key at one instant: only the full order can cut them."""
    rows = [("hot", 5, i) for i in range(2000)] + [("k", i, 20_000 + i) for i in range(5)]
    df = spark.createDataFrame(rows, "key STRING, t BIGINT, id BIGINT").withColumn("flag", F.lit(1))
    sizes = split_rows(df.where("key = 'hot'"), ["key"], ["t", "id"], 2000, 10).groupBy("_split").count()
    assert sizes.agg(F.max("count")).first()[0] <= 20
    s = sequence_scan(df, ["key"], ["t", "id"], row_number="pos", lags={"prev_id": "id"},
                      running_sums={"cum": F.col("flag")}, rows_per_split=10)
    got = {r.id: (r.pos, r.prev_id, r.cum) for r in s.collect()}
    assert all(got[i] == (i + 1, i - 1 if i else None, i + 1) for i in range(2000))
    assert got[20_004] == (5, 20_003, 5)


def test_burst_is_split(spark):
    """A hot key whose rows sit almost all in 1% of its time span."""
    rows = [("hot", i, i) for i in range(2000)]              # burst: t in [0, 2000)
    rows += [("hot", 200_000 + i * 1000, 10_000 + i) for i in range(200)]  # sparse tail
    rows += [("k", i, 20_000 + i) for i in range(50)]
    df = spark.createDataFrame(rows, "key STRING, t BIGINT, id BIGINT").withColumn("flag", F.lit(1))
    s = sequence_scan(df, ["key"], ["t", "id"], row_number="pos", lags={"prev_id": "id"},
                      running_sums={"cum": F.col("flag")}, rows_per_split=100)
    w = Window.partitionBy("key").orderBy("t", "id")
    ref = df.select("id", F.row_number().over(w).alias("p"), F.lag("id").over(w).alias("l"))
    assert {r.id: (r.pos, r.prev_id, r.cum) for r in s.collect()} == {r.id: (r.p, r.l, r.p) for r in ref.collect()}
