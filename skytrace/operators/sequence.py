"""Skew-safe ordered scans: row number, running sums and lag within key groups.

``Window.partitionBy(key).orderBy(t)`` sends a whole key group to one task; a
single aircraft (or date) holding a third of all rows would then be sorted
and scanned by one core. ``sequence_scan`` computes the same values without
that bottleneck:

1. Rows per key are counted (a partial aggregation). Keys with more than
   ``rows_per_split`` rows are *hot*; there are at most ``total / rows_per_split``
   of them. Where none is, a plain window is bounded per task.
2. The rows of hot keys are cut into buckets at sampled boundaries of the full
   order (keys, then all order columns): Spark's range partitioning samples the
   rows, so that a burst, or thousands of rows of one instant, is cut like any
   other stretch. The rows are written with their bucket (``_split``), once, so
   that all that follows reads the same buckets, also after a lost executor.
3. A window over ``(keys, _split)`` computes local row numbers, running sums
   and lags; each window group is one bucket.
4. A summary per ``(keys, _split)`` (count, sum, last row) and a window over
   it (one row per bucket of a key) give carries: rows and sums of earlier
   buckets, and the previous bucket's last row. They are joined back on
   ``(keys, _split)``, the partitioning the window already has.
5. Rows of the other keys take the plain window.

Key columns must be non-null (rows with a null key are dropped here); the
order columns must give a total order within a key.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

DEFAULT_ROWS_PER_SPLIT = 1_000_000
#: A key's text and count take a few dozen bytes: some 100 MB at most.
MAX_BROADCAST_HOT_KEYS = 1_000_000
#: Buckets at most; beyond that they grow (the driver holds their boundaries).
MAX_BUCKETS = 20_000


def _hot_keys(df: DataFrame, keys: list[str], rows_per_split: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_kn")).where(F.col("_kn") > rows_per_split)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_rows(df: DataFrame, keys: list[str], order: list[str], n_rows: int, rows_per_split: int) -> DataFrame:
    """``df`` (``n_rows`` rows) with ``_split``, the number of a row's bucket in
    the order of keys and order columns, written once."""
    buckets = max(1, min(MAX_BUCKETS, math.ceil(n_rows / rows_per_split)))
    placed = df.repartitionByRange(buckets, *keys, *order).withColumn("_split", F.spark_partition_id())
    return written(placed, "sequence")


def _plain_scan(base: DataFrame, keys, order, row_number, running_sums, lags) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    out = base
    if row_number:
        out = out.withColumn(row_number, F.row_number().over(w).cast("bigint"))
    for name, expr in running_sums.items():
        out = out.withColumn(name, F.sum(expr.cast("bigint")).over(
            w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    for name, col in lags.items():
        out = out.withColumn(name, F.lag(col).over(w))
    return out


def sequence_scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    row_number: str | None = "pos",
    running_sums: dict[str, Column] | None = None,
    lags: dict[str, str] | None = None,
    rows_per_split: int | None = None,
    max_key_rows: int | None = None,
) -> DataFrame:
    """Add ordered-scan columns to ``df``.

    One small job first looks for keys above ``rows_per_split``.

    * ``row_number``: 1-based position within the key group (None: skip);
    * ``running_sums``: ``{out: int_expr}``, inclusive running sum of ``int_expr``;
    * ``lags``: ``{out: column}``, value of ``column`` on the previous row;
    * ``max_key_rows``: a known upper bound of any key's rows (a statistic of
      the table ``df`` was filtered from); within ``rows_per_split`` it
      replaces the hot-key check job.
    """
    running_sums = running_sums or {}
    lags = lags or {}
    rows_per_split = rows_per_split or DEFAULT_ROWS_PER_SPLIT

    base = df.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)))
    if max_key_rows is not None and max_key_rows <= rows_per_split:
        # Bounded by a table statistic: every group fits one task.
        return _plain_scan(base, keys, order, row_number, running_sums, lags)
    hot = _hot_keys(base, keys, rows_per_split)
    n_hot, n_rows = hot.agg(F.count(F.lit(1)), F.sum("_kn")).first()
    if n_hot == 0:
        return _plain_scan(base, keys, order, row_number, running_sums, lags)
    hot = written(hot.select(*keys), "sequence-hot")
    if n_hot <= MAX_BROADCAST_HOT_KEYS:
        hot = F.broadcast(hot)
    cold = _plain_scan(base.join(hot, keys, "left_anti"), keys, order, row_number, running_sums, lags)
    split = split_rows(base.join(hot, keys, "left_semi"), keys, order, n_rows, rows_per_split)
    return cold.unionByName(_split_scan(split, keys, order, row_number, running_sums, lags))


def _split_scan(split: DataFrame, keys, order, row_number, running_sums, lags) -> DataFrame:
    base = split
    for name, expr in running_sums.items():
        base = base.withColumn(f"_rs_{name}", expr.cast("bigint"))
    gkeys = [*keys, "_split"]
    w = Window.partitionBy(*gkeys).orderBy(*order)
    w_cum = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = base.withColumn("_lrn", F.row_number().over(w))
    for name in running_sums:
        local = local.withColumn(f"_lsum_{name}", F.sum(f"_rs_{name}").over(w_cum))
    for name, col in lags.items():
        local = local.withColumn(f"_llag_{name}", F.lag(col).over(w))

    aggs = [F.count(F.lit(1)).alias("_n")]
    for name in running_sums:
        aggs.append(F.sum(f"_rs_{name}").alias(f"_s_{name}"))
    if lags:
        last = F.struct(*[F.col(c).alias(name) for name, c in lags.items()])
        aggs.append(F.max_by(last, F.struct(*order)).alias("_last"))
    # From the input, not the window output: the window's exchange then has
    # one consumer, and this partial aggregation shrinks each bucket to a row.
    summary = base.groupBy(*gkeys).agg(*aggs)

    w2 = Window.partitionBy(*keys).orderBy("_split")
    before = w2.rowsBetween(Window.unboundedPreceding, -1)
    carry_cols = [F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")]
    for name in running_sums:
        carry_cols.append(
            F.coalesce(F.sum(f"_s_{name}").over(before), F.lit(0)).alias(f"_coff_{name}")
        )
    if lags:
        carry_cols.append(F.lag("_last").over(w2).alias("_prev"))
    carries = summary.select(*gkeys, *carry_cols)

    out = local.join(carries, on=gkeys, how="inner")
    first_local = F.col("_lrn") == 1
    if row_number:
        out = out.withColumn(row_number, (F.col("_lrn") + F.col("_off")).cast("bigint"))
    for name in running_sums:
        out = out.withColumn(name, F.col(f"_lsum_{name}") + F.col(f"_coff_{name}"))
    for name in lags:
        out = out.withColumn(
            name, F.when(first_local, F.col("_prev")[name]).otherwise(F.col(f"_llag_{name}"))
        )
    drop = ["_split", "_lrn", "_off"]
    drop += [f"_rs_{n}" for n in running_sums] + [f"_lsum_{n}" for n in running_sums]
    drop += [f"_coff_{n}" for n in running_sums] + [f"_llag_{n}" for n in lags]
    if lags:
        drop.append("_prev")
    return out.drop(*drop)
