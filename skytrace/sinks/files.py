"""File sinks: hourly point partitions, per-window files, GeoJSON features.

A table's folders are ``source_date=…/hour=…/run=…`` (or ``window`` in place
of ``hour``): each write adds a run folder of its own and touches no other.
When its files stand, one small file in ``_runs`` says, for each date of the
run, that this run now is what its *writer* (``batch``, or a micro-batch of a
stream) has for that date. Readers take the latest run of every writer and
date, so that

* a batch run replaces the batch rows of its dates at one instant, also where
  hours or windows hold no rows any more, and leaves streamed rows alone;
* a run that fails midway, or a reader beside it, sees nothing of it;
* a repeated micro-batch replaces its earlier attempt, whatever hours that had.

``vacuum`` deletes the folders of replaced and failed runs.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S
from ..functions.timefn import iso_utc
from ..operators.windows import tag_windows

POINT_FILE_COLUMNS = S.POINT_COLUMNS + ["path", "seq", "event_us", "altitude_ft_num", "on_ground"]
BATCH = "batch"
_RUNS = "source_date string, writer string, run string, committed_us long"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _committed(spark: SparkSession, base: str) -> DataFrame | None:
    path = f"{base.rstrip('/')}/_runs"
    fs, p, _ = _fs(spark, path)
    return spark.read.schema(_RUNS).parquet(path) if fs.exists(p) else None


def current_runs(spark: SparkSession, base: str) -> DataFrame | None:
    """(source_date, run) that make up the table now; None before the first run."""
    runs = _committed(spark, base)
    if runs is None:
        return None
    # With a filter on this side, Spark prunes the table's run folders by it.
    return runs.where(F.col("writer") > "").groupBy("source_date", "writer").agg(F.max_by("run", F.struct("committed_us", "run")).alias("run")).select("source_date", "run")


def _write_run(out: DataFrame, fmt: str, base: str, second: str, dates: list[str] | None, writer: str = BATCH) -> list[tuple]:
    """Add ``out`` as a run and commit it; the (date, ``second``) partitions written.

    ``dates`` belong to the run even without rows; a stream's writer always
    has all its dates replaced.
    """
    spark, run, seen = out.sparkSession, uuid.uuid4().hex, Observation()
    held = out.observe(seen, F.collect_set(F.struct("source_date", second)).alias("parts"))  # a few per date
    w = held.withColumn("run", F.lit(run)).write.mode("append").format(fmt).partitionBy("source_date", second, "run")
    if fmt == "csv":
        w = w.option("header", True).option("nullValue", "")
    w.save(base)
    parts = sorted({(r[0], r[1]) for r in seen.get["parts"]})
    of_run = {d for d, _ in parts} | set(dates or [])
    before = _committed(spark, base)
    if writer != BATCH and before is not None:
        of_run |= {r[0] for r in before.where(F.col("writer") == writer).select("source_date").distinct().collect()}
    if of_run:
        rows = [(d, writer, run, time.time_ns() // 1000) for d in sorted(of_run)]
        spark.createDataFrame(rows, _RUNS).coalesce(1).write.mode("append").parquet(f"{base.rstrip('/')}/_runs")
    return parts


def _current(table: DataFrame, base: str) -> DataFrame:
    """The rows of the table's current runs; the runs' folders are pruned."""
    runs = current_runs(table.sparkSession, base)
    return table if runs is None else table.join(runs, ["source_date", "run"], "left_semi")


def vacuum(spark: SparkSession, base: str) -> int:
    """Delete the folders of runs that no reader takes any more (no run may be
    under way); their number. A step of upkeep, not of any write."""
    runs = current_runs(spark, base)
    keep = {(r[0], r[1]) for r in runs.collect()} if runs is not None else set()
    fs, _, jvm = _fs(spark, base)
    gone = 0
    for st in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{base.rstrip('/')}/source_date=*/*/run=*")) or []:
        of = dict(x.split("=", 1) for x in st.getPath().toString().split("/") if "=" in x)
        if (of["source_date"], of["run"]) not in keep:
            fs.delete(st.getPath(), True)
            gone += 1
    return gone


def _hourly_rows(points: DataFrame, fmt: str) -> DataFrame:
    """The sink's columns, rows of an hour together; ``rebalance`` lets a hot
    hour spread over several tasks."""
    out = points.select(*POINT_FILE_COLUMNS, "source_date", "hour")
    if fmt == "csv":
        out = out.withColumn("datetime_utc", iso_utc("event_us")).select(*S.POINT_COLUMNS, "source_date", "hour")
    return out.hint("rebalance", "source_date", "hour")


def write_hourly(points: DataFrame, base: str, fmt: str = "parquet", dates: list[str] | None = None) -> list[tuple[str, int]]:
    """Write points under ``base/source_date=<d>/hour=<h>/`` and return the
    (date, hour) partitions of this run. ``dates`` are the dates of the run
    (default: those with rows); each is replaced as a whole.

    CSV output carries the 23 point columns with a header, ``datetime_utc``
    as ISO-8601 text and null as an empty field.
    """
    return _write_run(_hourly_rows(points, fmt), fmt, base, "hour", dates)


def append_hourly(points: DataFrame, base: str, batch: str) -> None:
    """Add a micro-batch to the hourly table. ``batch`` names it: the same
    batch written again replaces its own rows."""
    _write_run(_hourly_rows(points, "parquet"), "parquet", base, "hour", None, batch)


def _file_schema(fmt: str) -> T.StructType:
    if fmt == "csv":
        fields = list(S.POINT_SCHEMA.fields)
    else:
        fields = [
            T.StructField(f.name, T.TimestampNTZType()) if f.name == "datetime_utc" else f
            for f in S.POINT_SCHEMA.fields
        ] + [
            T.StructField("path", T.StringType()),
            T.StructField("seq", T.IntegerType()),
            T.StructField("event_us", T.LongType()),
            T.StructField("altitude_ft_num", T.IntegerType()),
            T.StructField("on_ground", T.BooleanType()),
        ]
    return T.StructType(fields + [
        T.StructField("source_date", T.StringType()), T.StructField("hour", T.IntegerType()), T.StructField("run", T.StringType())])


def _hourly_table(spark: SparkSession, base: str, fmt: str) -> DataFrame:
    r = spark.read.format(fmt).schema(_file_schema(fmt))
    if fmt == "csv":
        r = r.option("header", True).option("nullValue", "")
    return r.load(base)


def read_hourly(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """The hourly point table with ``source_date`` and ``hour`` as partition
    columns (filters on them prune folders)."""
    return _current(_hourly_table(spark, base, fmt), base).drop("run")


def hourly_file_stats(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """Rows, files, bytes and size in MB (one decimal) per written
    (source_date, hour)."""
    df = _current(_hourly_table(spark, base, fmt).select(
        "source_date", "hour", "run", F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("b")), base)
    per_file = df.groupBy("source_date", "hour", "f").agg(F.count(F.lit(1)).alias("n"), F.first("b").alias("b"))
    g = per_file.groupBy("source_date", "hour").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_files"), F.sum("b").alias("n_bytes"),
    )
    return g.withColumn("size_mb", F.round(F.col("n_bytes") / F.lit(1024.0 * 1024.0), 1))


def write_windows(points: DataFrame, windows, base: str, fmt: str = "parquet", dates: list[str] | None = None) -> None:
    """One folder per (source_date, window), front columns first, rows in
    time order; the dates of the run (default: those with rows) are replaced
    as a whole, so a window without rows any more goes. Range partitioning splits a large window over several
    files, each a contiguous, sorted time range. CSV output has a header,
    ``datetime_utc`` as ISO-8601 text and empty fields for null."""
    from ..operators.windows import reorder_window_columns

    t = reorder_window_columns(tag_windows(points, windows))
    t = t.repartitionByRange("source_date", "window", "event_us").sortWithinPartitions(
        "source_date", "window", "event_us", "icao", "seq")
    if fmt == "csv":
        cols = [c for c in t.columns if c not in ("path", "event_us", "seq", "hour", "altitude_ft_num", "on_ground")]
        t = t.withColumn("datetime_utc", iso_utc("event_us")).select(*cols)
    _write_run(t, fmt, base, "window", dates)


def read_windows(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame:
    """The window rows with ``source_date`` and ``window`` as partition columns."""
    r = spark.read.format(fmt)
    table = (r.option("header", True).option("nullValue", "") if fmt == "csv" else r).load(base)
    return _current(table.withColumn("source_date", F.col("source_date").cast("string")), base).drop("run")


def write_features(features: DataFrame, path: str) -> None:
    """Newline-delimited GeoJSON features (one ``feature`` text per line)."""
    features.select("feature").write.mode("overwrite").text(path)
