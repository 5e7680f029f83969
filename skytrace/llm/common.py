"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, read_table

#: White space that separates words, as one string and as a regex class.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
#: Rows and bytes of an Arrow batch of texts.
BATCH_ROWS, BATCH_BYTES = 1000, "8MB"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def small_batches(spark: SparkSession) -> None:
    """Have texts reach Python in batches of ``BATCH_ROWS`` rows and
    ``BATCH_BYTES`` at most: with the default of 10,000 rows, two columns of long
    texts fill a worker's memory. The settings stay, as results are computed
    after the operator has returned; ``text_batches`` is for jobs within one."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


@contextmanager
def text_batches(spark: SparkSession, rows: int = BATCH_ROWS, size: str = BATCH_BYTES) -> Iterator[None]:
    """Within the block, batches that reach Python hold ``rows`` rows and
    ``size`` bytes at most (one row at least); the session's own settings
    return at its end. Holds for jobs that run inside the block."""
    ours = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows), "spark.sql.execution.arrow.maxBytesPerBatch": size}
    before = {k: spark.conf.get(k, None) for k in ours}
    try:
        for k, v in ours.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hand_back() -> None:
    """Return memory that is free within this process to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc
        trim(0)


def tidy(batches_fn: Callable) -> Callable:
    """A function for ``mapInPandas`` that hands memory back before its first
    and after its last batch: Spark uses a Python worker for the tasks of many
    stages, and each would keep what the stages before it had freed."""

    @wraps(batches_fn)
    def run(batches: Iterator) -> Iterator:
        hand_back()
        try:
            yield from batches_fn(batches)
        finally:
            hand_back()

    return run


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body`` any number of times.

    A column that a lambda refers to would otherwise be evaluated for each
    element of the array the lambda runs over.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; no words for null."""
    trimmed = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage at files that every executor can read, so that a lost
    executor costs no more than the tasks it was running.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
