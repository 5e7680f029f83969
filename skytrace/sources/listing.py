"""File listings: split-archive grouping and compressed-trace folders.

* ``archive_groups``: files named ``<base>.tar`` or ``<base>.tar.<xx>`` grouped
  by base name (text before the first ``.tar``), parts in path order. The
  asset suffix rule runs first, so a ``.tar.gz`` never joins a group.
* ``list_trace_buckets``: ``*.json`` files directly inside two-character
  bucket folders of ``traces/`` (``binaryFile`` listing, no content read).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import accepted_asset, archive_base
from ..plans import params as P


def files_from_orders(orders: DataFrame) -> DataFrame:
    """Synthetic download listing built from order keys and dates:
    ``v<YYYY.MM.DD>-<key mod n><suffix>``, suffixes cycling over the list."""
    d = F.regexp_replace(F.col("o_orderdate").cast("date").cast("string"), "-", ".")
    k = F.col("o_orderkey")
    suffix = F.element_at(
        F.array(*[F.lit(s) for s in P.ARCHIVE_SUFFIXES]), (k % len(P.ARCHIVE_SUFFIXES) + 1).cast("int")
    )
    name = F.concat(F.lit("v"), d, F.lit("-"), (k % P.ARCHIVE_BASES).cast("string"), suffix)
    return orders.select(name.alias("name")).distinct().select(
        F.concat(F.lit("downloaded/"), F.col("name")).alias("path"), "name"
    )


def archive_groups(files: DataFrame) -> DataFrame:
    """``(path, name)`` listing → one row per archive with its ordered parts.
    Files belong together by folder and base name: equal names under two
    dates are two archives.

    A group holds the distinct files of one base name, so its list is bounded
    by the number of part suffixes, not by the size of the listing.
    """
    f = files.where(F.col("name").rlike(r"\.tar") & accepted_asset("name"))
    folder = F.expr("left(path, length(path) - length(name))")
    g = f.groupBy(folder.alias("_folder"), archive_base("name").alias("archive")).agg(
        F.count(F.lit(1)).alias("n_parts"),
        F.array_join(F.sort_array(F.collect_list("path")), ",").alias("parts"),
        F.max("name").alias("_one"),
    )
    mode = F.when((F.col("n_parts") == 1) & F.col("_one").endswith(".tar"), F.lit("standalone")).otherwise(
        F.lit("multipart")
    )
    return g.select("archive", "n_parts", "parts", mode.alias("mode"))


def list_trace_buckets(spark: SparkSession, traces_dir: str) -> DataFrame:
    """``traces/<2 chars>/*.json`` → ``(path, bucket, length)``; content not read."""
    df = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .load(f"{traces_dir.rstrip('/')}/??/")
        .select("path", "length")
    )
    bucket = F.regexp_extract("path", r"/([^/]{2})/[^/]*$", 1)
    return df.select("path", bucket.alias("bucket"), "length").where(F.length("bucket") == 2)
