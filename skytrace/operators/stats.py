"""Ingest and window statistics (all partial/final hash aggregations)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import hour_range_label, hourly_file_name, ntz_from_us, utc_seconds_text
from .windows import tag_windows


def hourly_counts(points: DataFrame) -> DataFrame:
    """Rows per (source_date, hour), all 24 hours listed, empty hours as 0.

    One pass: per date, 24 conditional counts in a single (partial/final)
    aggregation, then ``posexplode`` of that 24-element array gives the
    zero-filled rows — no second scan, no join.
    """
    h = F.col("hour")
    per_date = points.groupBy("source_date").agg(
        F.array(*[F.count_if(h == i) for i in range(24)]).alias("_counts")
    )
    out = per_date.select("source_date", F.posexplode("_counts").alias("hour", "n_rows"))
    return out.select(
        "source_date",
        F.col("hour").cast("int").alias("hour"),
        hour_range_label("hour").alias("hour_range"),
        hourly_file_name("source_date", "hour").alias("file_name"),
        F.col("n_rows").cast("bigint").alias("n_rows"),
    )


def ingest_stats(status: DataFrame) -> DataFrame:
    """Per date: documents processed/failed, bad entries, rows written,
    active hours and files created (one per active hour).

    One aggregation over the document status: hours come as per-document
    24-bit masks, OR-ed per date and counted, so no second pass and no
    point rows are needed. ``total_rows`` is the true count.
    """
    g = status.groupBy("source_date").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count_if(F.col("status") == "processed").alias("processed_docs"),
        F.count_if(F.col("status") == "failed").alias("failed_docs"),
        F.sum("n_bad_entries").cast("bigint").alias("bad_entries"),
        F.sum("n_rows").cast("bigint").alias("total_rows"),
        F.bit_or("hour_mask").alias("_mask"),
    )
    hours = F.bit_count(F.coalesce(F.col("_mask"), F.lit(0))).cast("bigint")
    return g.select(
        "source_date", "n_docs", "processed_docs", "failed_docs", "bad_entries",
        F.coalesce("total_rows", F.lit(0)).cast("bigint").alias("total_rows"),
        hours.alias("active_hours"),
        hours.alias("files_created"),
    )


def window_stats(points: DataFrame, windows, approx: bool = False) -> DataFrame:
    """Per (source_date, window): rows before/after the filter, distinct
    aircraft, first/last time as ``YYYY-MM-DD HH:MM:SS UTC``.

    One pass: every point is tagged with its windows (or none), one
    aggregation gives per-window figures and, through ``first_tag``, the
    date totals. ``approx`` counts aircraft with a HyperLogLog sketch
    (``approx_count_distinct``), fixed memory per group.
    """
    tagged = tag_windows(points, windows, keep_outside=True)
    icao = F.when(F.col("window").isNotNull(), F.col("icao"))  # points in no window add nothing to count
    distinct = F.approx_count_distinct(icao) if approx else F.countDistinct(icao)
    g = tagged.groupBy("source_date", "window").agg(
        F.count(F.lit(1)).alias("rows_after"),
        F.count_if("first_tag").alias("_firsts"),
        distinct.alias("unique_aircraft"),
        F.min("event_us").alias("_min_us"),
        F.max("event_us").alias("_max_us"),
    )
    per_date = Window.partitionBy("source_date")
    g = g.withColumn("rows_before", F.sum("_firsts").over(per_date))
    return g.where(F.col("window").isNotNull()).select(
        "source_date",
        "window",
        F.col("rows_before").cast("bigint").alias("rows_before"),
        "rows_after",
        "unique_aircraft",
        ntz_from_us("_min_us").alias("time_min"),
        ntz_from_us("_max_us").alias("time_max"),
        utc_seconds_text("_min_us").alias("time_min_text"),
        utc_seconds_text("_max_us").alias("time_max_text"),
    )


def multi_date_counts(points: DataFrame, dates: list[str] | None = None) -> DataFrame:
    """Per date of a multi-date run: rows, aircraft, documents, hours.

    ``dates`` restricts the run (``source_date IN …``, a partition filter on
    a stored table); None means every date present. Points are first folded
    per document (rows, aircraft, hour bitmask; a partial aggregation), so
    the per-date step sees one row per document and needs a single distinct
    count instead of expanding every point row for three of them.
    """
    p = points if not dates else points.where(F.col("source_date").isin(*dates))
    # A document is one aircraft's: its icao is a document-level key.
    per_doc = p.groupBy("source_date", "path").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max("icao").alias("icao"),
        F.bit_or(F.pow(F.lit(2), F.col("hour")).cast("int")).alias("_mask"),
    )
    return per_doc.groupBy("source_date").agg(
        F.sum("_n").cast("bigint").alias("n_rows"),
        F.countDistinct("icao").alias("n_aircraft"),
        F.count(F.lit(1)).alias("n_docs"),
        F.bit_count(F.bit_or("_mask")).cast("bigint").alias("n_hours"),
    )
