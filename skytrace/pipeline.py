"""Production flow over files: ingest a list of dates, then query the table.

Layout per date under ``base`` (the trace-release layout):

* ``<date>/json/trace_full_*.json``           plain documents, or
* ``<date>/extracted/traces/<xx>/*.json``      gzip documents in buckets, or
* ``<date>/downloaded/*.tar[.xx]``             split tar archives.

``ingest`` reads every date in one job (plain, gzip and tar sources are
unioned), flattens, and writes the hour-partitioned point table. The study
functions then read that table with ``source_date``/``hour`` partition
filters, so a window query over 6 dates reads 6 × 3 hour folders.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import stats, windows
from .operators.flatten import doc_status, flatten_docs
from .operators.spatial import cell_index, unique_aircraft_in_zones, valid_positions, zone_join
from .session import ensure_checkpoint_dir
from .sinks.files import read_hourly, write_hourly
from .sources import archives
from .sources.listing import archive_groups
from .sources.trace_docs import read_trace_docs

DOC_COLUMNS = ["path", "source_date", "content"]


def _fs_listing(spark: SparkSession, pattern: str) -> list[str]:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(p)
    return [st.getPath().toString() for st in (found or [])]


def date_docs(spark: SparkSession, base: str, dates: list[str]) -> DataFrame:
    """Trace documents of the given dates from whichever layout exists; one
    that cannot be read stays, without content."""
    base = base.rstrip("/")
    parts: list[DataFrame] = []
    plain = [f"{base}/{d}/json" for d in dates if _fs_listing(spark, f"{base}/{d}/json")]
    if plain:
        parts.append(read_trace_docs(spark, plain))
    for d in dates:
        if _fs_listing(spark, f"{base}/{d}/extracted/traces/??"):
            g = archives.read_gzip_traces(spark, f"{base}/{d}/extracted/traces")
            parts.append(g.select("path", F.lit(d).alias("source_date"), "content"))
    tar_files = [p for d in dates for p in _fs_listing(spark, f"{base}/{d}/downloaded/*.tar*")]
    if tar_files:
        listing = spark.createDataFrame([(p, p.rsplit("/", 1)[1]) for p in tar_files], "path STRING, name STRING")
        groups = archive_groups(listing)
        idx = archives.tar_member_index(groups)
        t = archives.tar_trace_docs(idx)
        parts.append(t.select(*DOC_COLUMNS))
    if not parts:
        return spark.createDataFrame([], "path STRING, source_date STRING, content STRING")
    out = parts[0].select(*DOC_COLUMNS)
    for p in parts[1:]:
        out = out.unionByName(p.select(*DOC_COLUMNS))
    return out


def ingest(spark: SparkSession, base: str, dates: list[str], table: str) -> DataFrame:
    """Flatten the dates into the hour-partitioned table; returns per-date
    ingest statistics computed from the same documents."""
    # Read and unpacked once: points and statistics come from this copy.
    copy = f"{ensure_checkpoint_dir(spark).rstrip('/')}/docs-{uuid.uuid4().hex}"
    date_docs(spark, base, dates).write.parquet(copy)
    docs = spark.read.parquet(copy)
    write_hourly(flatten_docs(docs), table, dates=dates)
    return stats.ingest_stats(doc_status(docs))


def window_zone_counts(spark: SparkSession, table: str, dates: list[str], win, zones: DataFrame) -> DataFrame:
    """Distinct aircraft per (date, window, zone) from the stored table; the
    date and hour filters prune partition folders before any file is read. An
    invalid zone stops the study, as its count would be missed unnoticed."""
    hours = sorted({h for _, s, e in win for h in range(s, e)})
    p = read_hourly(spark, table).where(F.col("source_date").isin(*dates) & F.col("hour").isin(*hours))
    tagged = windows.tag_windows(valid_positions(p), win)
    return unique_aircraft_in_zones(zone_join(tagged, cell_index(zones, strict=True)), ["source_date", "window", "zone"])
