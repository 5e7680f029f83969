"""Target-distribution importance resampling, ranked by parallel sorting by regular sampling.

Features of a text are its runs of one to three words, hashed into ``BUCKETS``
buckets. A bucket's gain is the logarithm of its share among the features of
the target texts over its share among those of the documents (one added to
each count). Both counts are arrays of ``BUCKETS`` numbers, and so are the
gains that score every document: a document's weight is the sum of the gains
of its features. To the weight comes a Gumbel value, drawn from a digest of the
document's id, so that the highest scores are a sample without replacement in
proportion to exp(weight / 1000).

Ranks come from parallel sorting by regular sampling:

1. the scored rows stand in runs, each sorted by itself and written with every
   row's place; a run gives rows at regular steps as its samples;
2. of the sorted samples every so-manieth is a splitter, which cuts all
   runs into segments; rows per segment are counted;
3. the counts before each segment (prefix counts) are the ranks it begins at;
   segments that begin beyond the number drawn need no rank and stay;
4. the others are exchanged, one task a segment, which merges its parts of the
   runs and numbers the rows.

With as many samples a run as there are segments, no segment gets more than
twice its share. Rows are ordered by score, then id, then by their run and
place, so that equal rows can't pile up in one segment either.

CRCs of runs of words are put together from those of the words: for bytes A
and B, crc(AB) is crc(A) moved on by the length of B, exclusive-or crc(B), and
moving on is linear in the bits, so a table for each length and byte of the
crc does it for whole arrays.

Defined results: null and wordless texts have no features, weight 0, and no
rank; a null doc_id hashes like an empty one and comes last among ties; every
row of a repeated document is scored and ranked; empty tables give empty
results; without target texts all gains follow from the documents' own counts.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..session import read_table
from .common import documents, text_batches, written

BUCKETS = 10_000
LONGEST = 3
SEED = 42
#: Texts with fewer words are scored, but never drawn.
LEAST_WORDS = 20
#: Share of the others that is drawn, in hundredths.
PERCENT = 5
#: Segments (and samples a run) at most: the samples that one task sorts are
#: SEGMENTS * SEGMENTS rows of four numbers at most, whatever the input.
SEGMENTS = 512
#: Words up to so many bytes are moved on by table, longer ones one by one.
TABLE_BYTES = 64

_WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())
_SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def _moved_on() -> np.ndarray:
    """table[n, k, v]: what byte ``v`` at place ``k`` of a crc becomes after n bytes."""
    poly = 0xEDB88320
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(poly), step >> 1)
    table = np.empty((TABLE_BYTES + 1, 4, 256), np.uint32)
    table[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(1, TABLE_BYTES + 1):
        table[n] = (table[n - 1] >> 8) ^ step[table[n - 1] & 255]
    return table


_TABLE = _moved_on()


def _on(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Each crc moved on by n bytes."""
    out = np.zeros(len(crc), np.uint32)
    todo, left = np.arange(len(crc)), n.astype(np.int64)
    value = crc.astype(np.uint32)
    while len(todo):
        by = np.minimum(left, TABLE_BYTES)
        value = _TABLE[by, 0, value & 255] ^ _TABLE[by, 1, (value >> 8) & 255] ^ _TABLE[by, 2, (value >> 16) & 255] ^ _TABLE[by, 3, value >> 24]
        left = left - by
        out[todo] = value
        more = left > 0
        todo, left, value = todo[more], left[more], value[more]
    return out


def feature_buckets(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of all features, the text of each, words of each text)."""
    split = [t.encode("utf-8").translate(_WORD_BYTES).split() if t else [] for t in texts]
    n_words = np.array([len(w) for w in split], np.int64)
    flat = [w for ws in split for w in ws]
    owner = np.repeat(np.arange(len(split)), n_words)
    crc = np.fromiter(map(zlib.crc32, flat), np.uint32, len(flat))
    size = np.fromiter(map(len, flat), np.int64, len(flat))
    spaced = crc ^ _on(np.full(len(flat), zlib.crc32(b" "), np.uint32), size)  # of a space and the word
    out, owners, run = [crc], [owner], crc
    for k in range(1, LONGEST):
        run = _on(run[:-1], size[k:] + 1) ^ spaced[k:]
        own = owner[:-k] == owner[k:]  # words in between lie in the same text
        out.append(run[own])
        owners.append(owner[k:][own])
    return np.concatenate(out) % np.uint32(BUCKETS), np.concatenate(owners), n_words


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n = np.zeros(BUCKETS, np.int64)
    for b in batches:
        n += np.bincount(feature_buckets(b["text"].tolist())[0], minlength=BUCKETS)
    at = np.flatnonzero(n)
    yield pd.DataFrame({"bucket": at, "n": n[at]})


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """Features of all texts by bucket; each task sums its own first."""
    rows = texts.select("text").mapInPandas(_counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # BUCKETS rows at most
    n = np.zeros(BUCKETS, np.int64)
    n[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return n


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of target share over own share, floored."""
    s_all, t_all = int(own.sum()), int(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (s_all + BUCKETS) / ((s + 1) * (t_all + BUCKETS)))) for s, t in zip(own.tolist(), target.tolist(), strict=True)], np.int64)


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """Thousandths of a Gumbel value drawn from the id's digest, floored."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, by_bucket: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every row."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            buckets, owner, n_words = feature_buckets(b["text"].tolist())
            weight = np.zeros(len(b), np.int64)
            np.add.at(weight, owner, by_bucket[buckets])
            ids = [None if x is None else int(x) for x in b["id"]]
            yield pd.DataFrame({
                "doc_id": pd.array(ids, dtype="Int64"), "n_words": n_words, "n_features": np.bincount(owner, minlength=len(b)), "weight": weight,
                "score": weight + np.array([gumbel(x, seed) for x in ids], np.int64).reshape(-1),
            })

    # As text: pandas would turn ids beside nulls into floating-point numbers.
    return docs.select(F.col("doc_id").cast("string").alias("id"), "text").mapInPandas(score, _SCORED)


def _keys(b: pd.DataFrame) -> np.ndarray:
    """Keys whose bytes sort as (score descending, id with null last, run, place)."""
    key = np.empty(len(b), [("score", ">u8"), ("last", "u1"), ("id", ">u8"), ("run", ">u4"), ("place", ">u8")])
    flip = np.uint64(1 << 63)
    key["score"] = ~(b["score"].to_numpy(np.int64).view(np.uint64) ^ flip)
    key["last"] = b["no_id"]
    key["id"] = b["doc_id"].to_numpy(np.int64).view(np.uint64) ^ flip
    key["run"], key["place"] = b["run"], b["place"]
    return key.view(f"S{key.itemsize}")


def _placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    run, at = TaskContext.get().partitionId(), 0
    for b in batches:
        yield b.assign(run=run, place=np.arange(at, at + len(b)))
        at += len(b)


def _numbered(before: np.ndarray, drawn: int):
    """Ranks of sorted rows: the rows before their segment, and their place in it."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segment, at = -1, 0
        for b in batches:
            own = b["segment"].to_numpy()
            first = np.flatnonzero(np.diff(own, prepend=segment))
            start = np.zeros(len(b), np.int64) - at
            for i, to in zip(first, np.append(first, len(b))[1:], strict=True):
                start[i:to] = i
            rank = before[own] + np.arange(len(b)) - start + 1
            segment, at = own[-1] if len(b) else segment, (len(b) - start[-1]) if len(b) else at
            yield b.drop(columns="segment").assign(rank=pd.array(rank, "Int64")).assign(rank=lambda x: x["rank"].where(x["rank"] <= drawn))

    return number


def ranked(rows: DataFrame, n_rows: int, drawn: int, segments: int = SEGMENTS) -> DataFrame:
    """The ``n_rows`` rows of ``rows`` (doc_id, score and more) with ``rank``: 1 for
    the first by score and then id, up to ``drawn``; null for the others."""
    spark = rows.sparkSession
    segments = max(1, min(segments, SEGMENTS, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    columns = rows.columns
    rows = rows.withColumns({"no_id": F.col("doc_id").isNull(), "doc_id": F.coalesce("doc_id", F.lit(0).cast("long"))})
    fields = rows.schema.fields
    with_place = StructType([*fields, StructField("run", IntegerType()), StructField("place", LongType())])
    order = [F.col("score").desc(), F.col("no_id"), F.col("doc_id")]
    runs = written(rows.coalesce(segments).sortWithinPartitions(*order).mapInPandas(_placed, with_place), "resample-runs")

    # One row in so many of every run: segments * segments samples and one a run.
    step = max(1, n_rows // segments**2)
    samples = np.sort(_keys(runs.where(F.col("place") % step == 0).select("score", "no_id", "doc_id", "run", "place").toPandas()))
    splitters = samples[-(-len(samples) // segments) :: max(1, -(-len(samples) // segments))]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(segment=np.searchsorted(splitters, _keys(b), "right").astype(np.int32))

    pieces = runs.mapInPandas(cut, StructType([*with_place.fields, StructField("segment", IntegerType())]))
    counts = np.zeros(len(splitters) + 1, np.int64)
    for r in pieces.groupBy("segment").count().collect():  # a row a segment
        counts[r["segment"]] = r["count"]
    before = np.cumsum(counts) - counts
    asked = int((before < drawn).sum())  # segments that hold a drawn row

    held = [f.name for f in fields]
    own_id = F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id")
    named = [own_id if c == "doc_id" else F.col(c) for c in columns] + [F.col("rank")]
    rest = pieces.where(F.col("segment") >= asked).select(*held, F.lit(None).cast("long").alias("rank")).select(*named)
    if not asked:
        return rest
    exchanged = pieces.where(F.col("segment") < asked).repartitionById(asked, F.col("segment"))
    merged = exchanged.sortWithinPartitions("segment", *order, "run", "place").select(*held, "segment")
    return merged.mapInPandas(_numbered(before, drawn), StructType([*fields, StructField("rank", LongType())])).select(*named).unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, seed: int = SEED, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of
    ``docs`` (doc_id, text; other columns are not read).

    ``percent`` hundredths of the documents of ``least_words`` words or more
    are drawn towards the texts of ``target`` (text) and have a rank.
    """
    with text_batches(docs.sparkSession):
        by_bucket = gains(bucket_counts(docs), bucket_counts(target))
        rows = written(scored(docs, by_bucket, seed), "resample-scored")
    long_enough = F.col("n_words") >= least_words
    n = rows.where(long_enough).count()
    out = ranked(rows.where(long_enough), n, percent * n // 100)
    return out.unionByName(rows.where(~long_enough).withColumn("rank", F.lit(None).cast("long")))


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents towards the benchmark's texts, and the ranks of those drawn."""
    out = resampled(documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


#: The same; crc32 is spelt out byte by byte over the distinct features.
ORACLE = r"""
WITH low AS (
  SELECT 0 AS target, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
  UNION ALL SELECT 1, NULL, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
d AS (SELECT row_number() OVER () AS k, target, doc_id, list_filter(string_split_regex(t, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM low),
f AS (
  SELECT k, target, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS g FROM d),
-- crc32 by its rule: a table of 256 steps, then byte after byte.
step AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, (c & 1) * 3988292384)) ORDER BY i) AS s
  FROM range(256) r(i)),
b AS (
  SELECT g, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(0, octet_length(encode(g))), lambda i: ('0x' || substr(hex(encode(g)), 2 * i + 1, 2))::BIGINT)),
    lambda c, x: xor(c >> 8, s[(xor(c, x) & 255) + 1]))) % 10000 AS bucket
  FROM (SELECT DISTINCT g FROM f), step),
fb AS (SELECT k, target, bucket FROM f JOIN b USING (g)),
n AS (SELECT count(*) FILTER (target = 0) AS s_all, count(*) FILTER (target = 1) AS t_all FROM fb),
gain AS (
  SELECT bucket, floor(1000 * ln((count(*) FILTER (target = 1) + 1)::DOUBLE * (any_value(s_all) + 10000) / ((count(*) FILTER (target = 0) + 1)::DOUBLE * (any_value(t_all) + 10000))))::BIGINT AS gain
  FROM fb, n GROUP BY bucket),
scored AS (
  SELECT d.k, any_value(doc_id) AS doc_id, any_value(len(w)) AS n_words, count(fb.bucket) AS n_features, coalesce(sum(gain), 0)::BIGINT AS weight
  FROM d LEFT JOIN fb ON fb.k = d.k LEFT JOIN gain USING (bucket) WHERE d.target = 0 GROUP BY d.k),
s AS (
  SELECT *, weight + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM scored),
r AS (
  SELECT *, n_words >= 20 AS may, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS n_may
  FROM s)
SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= 5 * n_may // 100 THEN place END AS rank FROM r
"""
