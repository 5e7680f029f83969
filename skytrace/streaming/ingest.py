"""Structured Streaming: incremental ingest and hourly counts.

* ``stream_points``: newly landed ``trace_full_*.json`` documents (whole file
  = one row) → the same flatten as the batch path. The file source tracks
  what it has read in the checkpoint, so a restart after an executor or
  driver loss neither loses nor duplicates documents.
* ``start_ingest``: points → the hour-partitioned table of the batch writer,
  one named batch at a time, e.g. ``trigger(availableNow=True)``.
* ``hourly_counts_stream``: event-time hour windows with a watermark. The
  window runs on the UTC instant (``timestamp_micros``), so hours are UTC
  whatever the session time zone. Batch ``hourly_counts`` is keyed by
  (source_date, hour); the two agree when no point spills past midnight.
* ``start_late_rows``: the rows that come too late for their window, as a
  side output.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.timefn import US_PER_HOUR
from ..operators.flatten import flatten_docs
from ..sinks.files import append_hourly
from ..sources.trace_docs import date_of_path


_SEEN = "last_us long, batch long"


def stream_docs(spark: SparkSession, src_dir: str, max_files_per_trigger: int | None = None,
                lines: bool = False) -> DataFrame:
    """New documents under ``src_dir``: one file = one document, or with
    ``lines`` one line = one document (NDJSON dumps, ``*.json`` / ``*.txt``)."""
    r = spark.readStream.format("text").option("recursiveFileLookup", True)
    if lines:
        r = r.option("pathGlobFilter", "*.txt")
    else:
        r = r.option("wholetext", True).option("pathGlobFilter", "trace_full_*.json")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.load(src_dir)
    path = F.col("_metadata.file_path")
    # A line's own id: equal lines of a file are one document.
    doc = F.concat_ws("#", path, F.sha2("value", 256)) if lines else path
    return raw.select(doc.alias("path"), date_of_path(path).alias("source_date"), F.col("value").alias("content"))


def stream_points(spark: SparkSession, src_dir: str, max_files_per_trigger: int | None = None,
                  lines: bool = False) -> DataFrame:
    return flatten_docs(stream_docs(spark, src_dir, max_files_per_trigger, lines))


def start_ingest(points: DataFrame, out_dir: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Points → the hourly table that the batch writer writes as well. Each
    micro-batch goes through ``append_hourly`` under a name made of this
    stream's checkpoint and the batch id: a batch repeated after a failure
    replaces its own rows, and batch rows of other runs stay readable."""
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, batch_id: int) -> None:
        append_hourly(batch, out_dir, f"s{stream}-{batch_id}")

    w = points.writeStream.option("checkpointLocation", checkpoint).outputMode("append").foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def start_hourly_counts(points: DataFrame, out_dir: str, checkpoint: str, watermark: str = "1 hour") -> StreamingQuery:
    """Hourly counts of a stream into ``out_dir/batch=<id>``: each micro-batch
    writes the windows that it changed (update mode, so the watermark drops
    old state), and nothing passes through the driver. Rows that come after
    their window was closed are not counted; ``start_late_rows`` gives them."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={batch_id}")

    counts = hourly_counts_stream(points, watermark)
    return counts.writeStream.option("checkpointLocation", checkpoint).outputMode("update").foreachBatch(write) \
        .trigger(availableNow=True).start()


def read_hourly_counts(spark: SparkSession, out_dir: str) -> DataFrame:
    """(window_start_us, n_rows): the latest count of each window."""
    rows = spark.read.schema("window_start_us long, n_rows long, batch long").parquet(out_dir)
    return rows.groupBy("window_start_us").agg(F.max_by("n_rows", "batch").alias("n_rows"))


def start_late_rows(points: DataFrame, out_dir: str, checkpoint: str, late_after_us: int = US_PER_HOUR) -> StreamingQuery:
    """The rows of a stream that come after their hour window was closed, into
    ``out_dir/rows/batch=<id>``: a side output beside ``start_hourly_counts``
    over the same source with the same batches.

    A window is closed when the latest instant of all earlier batches, less
    ``late_after_us``, has reached its end, which is the rule of the watermark.
    Each batch leaves its latest instant in ``out_dir/seen/batch=<id>``, so a
    restarted stream goes on where it stood, and a repeated batch finds the
    same bound and replaces its own rows.
    """
    base = out_dir.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = spark.read.schema(_SEEN).parquet(f"{base}/seen").where(F.col("batch") < batch_id) if batch_id else None
        last = seen.agg(F.max("last_us")).first()[0] if seen is not None else None
        batch.agg(F.max("event_us").alias("last_us")).write.mode("overwrite").parquet(f"{base}/seen/batch={batch_id}")
        # The watermark counts whole milliseconds.
        bound = None if last is None else last // 1000 * 1000 - late_after_us
        end = F.col("event_us") - F.pmod("event_us", F.lit(US_PER_HOUR)) + F.lit(US_PER_HOUR)
        late = batch.where(F.lit(False) if bound is None else end <= F.lit(bound))
        late.write.mode("overwrite").parquet(f"{base}/rows/batch={batch_id}")

    return points.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).trigger(availableNow=True).start()


def read_late_rows(spark: SparkSession, out_dir: str) -> DataFrame:
    """All late rows so far, with the batch that brought them."""
    return spark.read.parquet(f"{out_dir.rstrip('/')}/rows")


def hourly_counts_stream(points: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """Rows per UTC hour window; a window is emitted once the watermark passes it."""
    ts = F.timestamp_micros(F.col("event_us"))
    p = points.withColumn("event_ts", ts).withWatermark("event_ts", watermark)
    g = p.groupBy(F.window("event_ts", "1 hour")).agg(F.count(F.lit(1)).alias("n_rows"))
    start_us = F.unix_micros(F.col("window.start"))
    return g.select(
        start_us.alias("window_start_us"),
        "n_rows",
    )
