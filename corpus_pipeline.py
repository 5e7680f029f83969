"""The corpus pipeline: raw documents to token shards.

Each stage reads what its predecessor wrote and applies one operator of
``skytrace.llm``. All stages but the last return the columns of documents.

1. ``language``: rows whose text has no language that the profiles know
   (``und``), or is further from every profile than ``MIN_SCORE``, go.
2. ``neardup``: one document of each group of near copies stays.
3. ``decontaminate``: documents that hold benchmark items go.
4. ``mix``: each document as often as the mix of sources takes it.
5. ``tokens``: token shards; one row a document read back from them.

Rows without a doc_id pass the second stage (they are linked with nothing)
and the third unless their text is contaminated. Columns of documents keep
their names and order whatever else the table holds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skytrace.llm import decontaminate, language, mixing, neardup, tokens
from skytrace.llm.common import documents, written
from skytrace.session import ensure_checkpoint_dir, read_table

#: Least share of the greatest out-of-place distance that a kept text saves.
MIN_SCORE = 0.1
#: Similarity of two documents, in hundredths, from which on one of them goes.
SIMILAR = 80


def _few(ids: DataFrame, name: str) -> DataFrame:
    """Document ids, to be broadcast where they are few (8 bytes each, counted),
    so that the documents need no shuffle to be picked by them."""
    ids = written(ids, name)
    return F.broadcast(ids) if ids.count() <= neardup.BROADCAST_IDS else ids


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learned = language.profiles(docs.where(~language.held_out()).select("text", "lang"))
    p = language.predict(docs, learned)
    return p.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("lang_score") >= MIN_SCORE)).select(*docs.columns)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    linked = written(neardup.link(docs, SIMILAR), "linked")
    gone = _few(linked.where("not kept").select("doc_id").distinct(), "gone")
    left = docs.where("doc_id is not null").join(gone, "doc_id", "left_anti").select(*docs.columns)
    # Repeated rows share a doc_id: one of them stays.
    several = _few(linked.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "several")
    if not several.isEmpty():
        one = left.join(several, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
        left = left.join(several, "doc_id", "left_anti").select(*docs.columns).unionByName(one)
    return left.unionByName(docs.where("doc_id is null"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(docs, read_table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    d, f = docs.alias("d"), _few(found, "found").alias("f")
    return d.join(f, F.col("d.doc_id").eqNullSafe(F.col("f.doc_id")), "left_anti").select(*docs.columns)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs).select(*docs.columns)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.stored(docs)


STAGES = [
    ("language", language_stage),
    ("neardup", neardup_stage),
    ("decontaminate", decontaminate_stage),
    ("mix", mix_stage),
    ("tokens", tokens_stage),
]

#: Neither the profiles, the forest, Newton's steps nor the tokenizer are SQL;
#: tests/llm holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    ensure_checkpoint_dir(spark)
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
