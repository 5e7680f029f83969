"""The stored point table: ingest once, query many times.

Analytics queries read the flattened points from Parquet written into the
session's shared checkpoint folder (``spark.checkpoint.dir``) rather than
re-running the JSON parse in every branch of their plans. Column pruning
makes the branches of one plan read different projections, so Spark cannot
reuse an exchange between them; from Parquet each branch is a cheap pruned
scan. Writing the table also cuts the lineage: a lost executor re-reads
files instead of recomputing the ingest.

The table is keyed by the source's files (name, size, modification time), so
a changed input is ingested again, and its statistics by the stored folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

_STORED: dict[tuple, str] = {}


def _source_key(spark: SparkSession, sf_dir: str, table: str) -> tuple:
    """Path, sizes and modification times of all files of the source, through
    the file system that holds it."""
    path = f"{sf_dir}/{table}.parquet"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stamp = tuple(sorted((st.getPath().getName(), st.getLen(), st.getModificationTime()) for st in fs.listStatus(p)))
    return spark.sparkContext.applicationId, path, stamp


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))


#: Rows of a Parquet page: the unit that column statistics let a scan skip.
PAGE_ROWS = 2048


def write_clustered(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), sort_by: tuple[Column, ...] = (),
                    page_rows: int = PAGE_ROWS) -> None:
    """Write ``df`` with the rows of a partition together (``rebalance`` splits
    large ones, so that a folder holds few files) and in the order of
    ``sort_by``: each page's least and greatest values then lie close, and a
    scan with a filter on them skips the pages elsewhere."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    # Parquet looks at a page's length after 100 rows for the first time.
    pages = {"parquet.page.row.count.limit": page_rows, "parquet.page.size.row.check.min": min(page_rows, 100)}
    df.write.mode("overwrite").options(**pages).partitionBy(*partition_by).parquet(path)


def stored_path(spark: SparkSession, sf_dir: str, name: str, build, partition_by: tuple[str, ...] = (),
                sort_by: tuple[Column, ...] = ()) -> str:
    """Folder of the Parquet copy of ``build()`` for this source, written
    clustered on first use and again when a file of the source changed."""
    key = (*_source_key(spark, sf_dir, "events"), name)
    path = _STORED.get(key)
    if path is None or not _exists(spark, path):
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        write_clustered(build(), path, partition_by, sort_by)
        _STORED[key] = path
    return path


_POINT_STATS: dict[str, tuple[int, int]] = {}


def point_stats(points: DataFrame, table_key: str) -> tuple[int, int]:
    """Statistics of a stored point table, computed once per table in one
    job: rows of the largest (source_date, icao) group and aircraft of the
    largest date."""
    if table_key not in _POINT_STATS:
        from pyspark.sql import functions as F

        per = points.groupBy("source_date", "icao").agg(F.count(F.lit(1)).alias("n"))
        per_date = per.groupBy("source_date").agg(F.max("n").alias("m"), F.count(F.lit(1)).alias("a"))
        r = per_date.agg(F.max("m"), F.max("a")).first()
        _POINT_STATS[table_key] = (int(r[0] or 0), int(r[1] or 0))
    return _POINT_STATS[table_key]
