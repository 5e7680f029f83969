"""Remove repeated lines or paragraphs across documents.

Texts are cut into lines (or paragraphs), and these into sentences. Each unit
is normalised (lower case, white space and punctuation dropped; a line of
several sentences is the list of these) and digested;
digests are grouped over the whole corpus, and the occurrence in the document
of least doc_id, there the first, is kept. A line that holds a letter goes at
every other occurrence, however short it is. Sentences within lines that differ
otherwise go where the run of neighbouring repeated sentences they stand in has
``MIN_WORDS`` words or more: short phrases recur by chance inside a line and
stay. Removed spans keep their offsets in the original text.

A unit goes through the shuffle as two digest halves, its document and place.
The grouping is a plain minimum with map-side combine, so a line that a third
of all documents share costs one row a task; within a document only the first
occurrence takes part.

Defined results: a null or empty text has no units and stays as it is; rows
that share a doc_id count as one occurrence and are cut alike where their
texts are equal; a row without doc_id ranks last and stays whole; a document's
own second occurrence is removed like a foreign one; offsets are code points,
ends exclusive; an empty table gives an empty result; texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import documents, small_batches, written

#: Words that a run of repeated sentences must have outside repeated lines.
MIN_WORDS = 20
#: Where a unit ends: the pattern covers what separates it from the next.
UNITS = {
    "line": re.compile(r"\n+"),
    "paragraph": re.compile(r"\n[ \t]*\n\s*"),
    "sentence": re.compile(r"(?<=[.!?])[ \t]+|\n+"),
}
_DROPPED = re.compile(r"[\W_]+")
#: A unit in six numbers, as it is shuffled. ``place``: 32 bits, the number of
#: its (first) sentence; 2 bits, what it is; 30 bits, its words (of several
#: sentences: how many). ``span``: its offsets, 32 bits each.
SCHEMA = "doc_id long, t long, place long, span long, h1 long, h2 long, again boolean"
#: So many changed documents (16 bytes each) may be broadcast to pick their
#: texts; more are joined by shuffling all texts.
BROADCAST_DOCS = 4_000_000
#: A sentence inside a line, one that is a whole line with a letter, and a line
#: with a letter of several sentences.
INSIDE, WHOLE, SEVERAL = 0, 1, 2


def cut(text: str, unit: str) -> Iterator[tuple[int, int]]:
    """Offsets of the units of a text, separators left out."""
    at = 0
    for m in UNITS[unit].finditer(text):
        if m.start() > at:
            yield at, m.start()
        at = m.end()
    if at < len(text):
        yield at, len(text)


def normalised(unit: str) -> str:
    return _DROPPED.sub(" ", unit.lower()).strip()


def _sentences(text: str, unit: str) -> Iterator[tuple[int, int, int, int, str]]:
    """(first sentence or its own number, kind, words or sentences, from, to,
    normalised text) of the sentences of a text and of its units that hold several."""
    k = 0
    for lo, hi in cut(text, unit):
        own = [(lo + i, lo + j, plain) for i, j in cut(text[lo:hi], "sentence") if (plain := normalised(text[lo + i : lo + j]))]
        whole = unit != "sentence" and any(c.isalpha() for _, _, plain in own for c in plain)
        for n, (i, j, plain) in enumerate(own):
            yield k + n, WHOLE if whole and len(own) == 1 else INSIDE, plain.count(" ") + 1, i, j, plain
        if whole and len(own) > 1:
            yield k, SEVERAL, len(own), own[0][0], own[-1][1], "\n".join(plain for _, _, plain in own)
        k += len(own)


def _units(unit: str):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 512):
                some = b.iloc[at : at + 512]
                rows, halves = [], []
                for doc_id, t, text in zip(some["doc_id"], some["t"], some["text"], strict=True):
                    seen = set()
                    for k, kind, n, i, j, plain in _sentences(text, unit):
                        h = xxhash.xxh3_128_digest(plain.encode("utf-8", "surrogatepass"))
                        rows.append((doc_id, t, k << 32 | kind << 30 | n, i << 32 | j, h in seen))
                        halves.append(h)
                        seen.add(h)
                out = pd.DataFrame(rows, columns=["doc_id", "t", "place", "span", "again"])
                both = np.frombuffer(b"".join(halves), np.int64).reshape(-1, 2)
                yield out.assign(h1=both[:, 0], h2=both[:, 1])

    return of


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("t", F.xxhash64("text"))


def repeats(docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, t, from, to, n_units, n_words, kept_in): spans to remove, and
    the least document in which a sentence of the span stays; ``t`` tells texts
    under the same doc_id apart. ``unit``: ``line`` or ``paragraph``, removed
    whatever its length, or ``sentence``, removed in runs only."""
    small_batches(docs.sparkSession)
    rows = _keyed(docs.select("doc_id", "text")).where("doc_id is not null and text is not null")
    units = written(rows.mapInPandas(_units(unit), SCHEMA), "repeat-units")
    firsts = units.where("not again").groupBy("h1", "h2").agg(F.min("doc_id").alias("kept_in"), F.max("doc_id").alias("last"))
    # A table of its own: a join of two plain shuffles, whose hot digests the engine splits.
    shared = written(firsts.where("last > kept_in").select("h1", "h2", "kept_in"), "repeat-shared")
    key = ["doc_id", "t", "place", "span"]
    foreign = units.select(*key, "h1", "h2").join(shared, ["h1", "h2"]).where("doc_id > kept_in").select(*key, "kept_in")
    own = units.where("again").select(*key, F.col("doc_id").alias("kept_in"))
    gone = foreign.unionByName(own).groupBy(*key).agg(F.min("kept_in").alias("kept_in"))
    high, low = (lambda c: F.shiftright(c, 32).cast("int")), (lambda c: F.col(c).bitwiseAND(0xFFFFFFFF).cast("int"))
    bits = F.shiftright("place", 30).bitwiseAND(3).cast("int")
    gone = gone.select("doc_id", "t", high("place").alias("unit"), bits.alias("kind"), F.col("place").bitwiseAND((1 << 30) - 1).cast("int").alias("n"),
                       high("span").alias("from"), low("span").alias("to"), "kept_in")
    # Every sentence of a repeated line is repeated itself, so a line only marks
    # its sentences as covered; then runs of neighbouring sentences are measured.
    so_far = W.partitionBy("doc_id", "t").orderBy("unit", F.col("kind").desc())
    reach = F.max(F.when(F.col("kind") == SEVERAL, F.col("unit") + F.col("n"))).over(so_far)
    covered = (F.col("kind") == WHOLE) | F.coalesce(reach > F.col("unit"), F.lit(False))
    gone = gone.withColumn("covered", covered).where(F.col("kind") != SEVERAL)
    in_doc = W.partitionBy("doc_id", "t").orderBy("unit")
    long = F.sum("n").over(W.partitionBy("doc_id", "t", "run")) >= min_words
    gone = gone.withColumn("run", F.col("unit") - F.row_number().over(in_doc)).withColumn("long", long).where("covered or long")
    return gone.withColumn("run", F.col("unit") - F.row_number().over(in_doc)).groupBy("doc_id", "t", "run").agg(
        F.min("from").alias("from"), F.max("to").alias("to"), F.count(F.lit(1)).alias("n_units"),
        F.sum("n").alias("n_words"), F.min("kept_in").alias("kept_in")).drop("run")


def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    def cut_out(text: str, gone) -> str:
        out, at = [], 0
        for s in gone:
            out.append(text[at : s["from"]])
            at = s["to"]
        return "".join([*out, text[at:]])

    return pd.Series([cut_out(t, g) for t, g in zip(texts, spans, strict=True)], dtype=object)


def remove(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """The documents that lose something: their columns, the text without the
    spans, and ``removed``, an array of (from, to, n_units, n_words, kept_in)."""
    by_doc = spans.groupBy("doc_id", "t").agg(F.sort_array(F.collect_list(F.struct("from", "to", "n_units", "n_words", "kept_in"))).alias("removed"))
    by_doc = written(by_doc, "repeat-spans")
    docs, changed = _keyed(docs.drop("t", "removed")), by_doc.select("doc_id", "t")
    few = changed.count() <= BROADCAST_DOCS
    joined = docs.join(F.broadcast(changed) if few else changed, ["doc_id", "t"], "left_semi").join(by_doc, ["doc_id", "t"])
    offsets = F.transform("removed", lambda s: F.struct(s["from"].alias("from"), s["to"].alias("to")))
    return joined.withColumn("text", F.pandas_udf(_without, "string")("text", offsets)).drop("t")


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that repeats passages of earlier ones or of itself: what
    is removed, where it stays, and the text that is left."""
    d = documents(spark, sf_dir).select("doc_id", "text")
    cleaned = remove(d, repeats(d))
    return cleaned.select(
        "doc_id",
        F.array_join(F.transform("removed", lambda s: F.concat_ws(":", s["from"].cast("string"), s["to"].cast("string"))), ",").alias("spans"),
        F.array_sort(F.array_distinct(F.transform("removed", lambda s: s["kept_in"]))).alias("kept_in"),
        F.aggregate("removed", F.lit(0).cast("long"), lambda a, s: a + s["n_words"]).alias("n_words"),
        "text",
    )
