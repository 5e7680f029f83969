"""Trace-document and point-table file sources.

* ``read_trace_docs``: every ``trace_full_*.json`` under one or more date
  folders, one whole file = one document row (``wholetext``). The date is the
  last ``YYYY.MM.DD`` folder of the path, so many dates are one scan.
* ``read_points_csv``: the 23-column point CSV with an explicit schema
  (never inferred: a hex id like ``7380e5`` must stay text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S

#: The last folder of a path that is a date, alone or as a partition value.
DATE_IN_PATH = r".*[/=](\d{4}\.\d{2}\.\d{2})/"


def date_of_path(path) -> Column:
    return F.regexp_extract(path, DATE_IN_PATH, 1)


def read_trace_docs(spark: SparkSession, paths, glob: str = "trace_full_*.json") -> DataFrame:
    """Date folders (or files) → ``(path, source_date, content)``."""
    if isinstance(paths, str):
        paths = [paths]
    raw = (
        spark.read.option("wholetext", True)
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", True)
        .text(list(paths))
    )
    path = F.col("_metadata.file_path")
    return raw.select(
        path.alias("path"),
        date_of_path(path).alias("source_date"),
        F.col("value").alias("content"),
    )


def read_points_csv(spark: SparkSession, paths, projected=None) -> DataFrame:
    """Header CSV of the 23 point columns, empty field = null, types fixed.

    ``projected`` keeps only those columns (a missing one raises, as a
    projected read of a file without it would).
    """
    df = (
        spark.read.schema(S.POINT_SCHEMA)
        .option("header", True)
        .option("nullValue", "")
        .option("enforceSchema", False)
        .csv(paths)
    )
    df = df.withColumn("datetime_utc", F.to_timestamp_ntz(F.regexp_replace("datetime_utc", r"\+00:00$|Z$", "")))
    if projected:
        missing = [c for c in projected if c not in df.columns]
        if missing:
            raise ValueError(f"missing columns: {missing}")
        df = df.select(*projected)
    return df
