"""Token counts of texts of any length by overlap resynchronisation.

A text of at most ``CHUNK`` code points is encoded whole. A longer one is cut
into chunks of ``CHUNK``, each of which begins ``OVERLAP`` code points before
the end of the one before it. Chunks are rows, dealt over all tasks, encoded
with offsets. Two neighbours are spliced at a token that both have at the same
place of their overlap: left of its end the left chunk's tokens count, right of
it the right chunk's. Where they share none, the document is encoded again with
overlaps ``WIDEN`` times as wide (and chunks of four overlaps at least), until
all neighbours share one or a chunk holds the whole text.

Why the splice is exact: BPE merges, again and again, the two neighbouring
symbols of best score, the leftmost first. Take two tokens that stand side by
side in an encoding. No merge ever crossed their borders, so all merges inside
the two were, one after another, the best ones there, and encoding the two by
themselves makes the same merges and gives the same two tokens. The other way
round, let each two neighbours of a sequence be such a pair, and suppose that
encoding the whole crosses one of the sequence's borders; take the first such
merge. Until then both tokens at that border went through the merges that the
pair goes through by itself, so the pair by itself would cross the border as
well, which it doesn't. So a sequence of which all neighbours are valid is the
encoding of its text. In the spliced sequence they are: pairs up to the shared
token come from the left chunk, pairs from it on from the right one.

That needs a BPE model which takes characters as they are. Others
(normalising ones, unigram models, user-defined pieces) are refused.

A space put before each chunk by the model sticks to a chunk's first tokens
only, which never count as shared. Byte pieces of a character outside the
vocabulary have one place in common and are kept together.

Defined results: a null text is empty, 0 bytes and 0 tokens; repeated rows and
rows without doc_id each give a row; equal long texts are encoded once; texts
are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from .common import documents, text_batches, written

TOKENIZER = "piece_bpe_32k.model"
#: Code points of a chunk and of the part it shares with its neighbour.
CHUNK, OVERLAP = 16_384, 512
WIDEN = 8
#: Tokens that a document should have at most.
LIMIT = 4096

_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6  # kinds of pieces
_CHUNK_ROWS = "text_key string, n long, overlap long, chunk int, at long, text string"
_ENCODED = "text_key string, n long, overlap long, chunk int, n_tokens long, left_zone array<long>, left_count array<long>, right_zone array<long>, right_count array<long>"


@lru_cache(maxsize=2)
def _model(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def check_model(path: str) -> None:
    """Refuse models for which shared tokens don't prove a splice."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    norm = proto.normalizer_spec
    if proto.trainer_spec.model_type != proto.trainer_spec.BPE:
        raise ValueError("not a BPE model")
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or proto.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("the model changes characters before it encodes")
    if {p.type for p in proto.pieces} - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
        raise ValueError("the model has pieces that are found before any merge")


def _short(path: str, chunk: int):
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = _model(path)
        for texts in batches:
            short = [t if t and len(t) <= chunk else "" for t in texts]
            n = [len(x) for x in model.encode(short, num_threads=1, return_type="numpy")]
            yield pd.Series([k if not t or len(t) <= chunk else None for k, t in zip(n, texts, strict=True)], dtype="Int64")

    return F.pandas_udf(count, "long")


def sizes(n: int, overlap: int, chunk: int) -> int:
    """Code points of a text's chunks, the whole where one chunk will do."""
    return n if n <= max(chunk, 4 * overlap) else max(chunk, 4 * overlap)


def _cut(chunk: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for key, overlap, text in zip(b["text_key"], b["overlap"], b["text"], strict=True):
                size = sizes(len(text), overlap, chunk)
                for i, at in enumerate(range(0, len(text), size)):
                    first = max(0, at - overlap)
                    yield pd.DataFrame({"text_key": [key], "n": [len(text)], "overlap": [overlap], "chunk": [i], "at": [first],
                                        "text": [text[first : at + size]]})

    return cut


def zone(ends: np.ndarray, starts: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Tokens that lie within lo < start, end < hi, as start << 32 | end - start
    (ascending), and how many of the chunk's tokens end there or before."""
    own = (ends > starts) & (starts > lo) & (ends < hi)
    return (starts[own] << 32) | (ends[own] - starts[own]), np.searchsorted(ends, ends[own], "right")


def _encode(path: str, chunk: int):
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = _model(path)
        for b in batches:
            for r in b.itertuples(index=False):
                size = sizes(r.n, r.overlap, chunk)
                place = np.array(model.encode(r.text, return_type="offset_mapping")["offsets"], np.int64).reshape(-1, 2) + r.at
                starts, ends = place[:, 0], place[:, 1]
                begin, end = r.chunk * size, r.at + len(r.text)
                none = np.zeros(0, np.int64)
                left = zone(ends, starts, r.at, begin) if r.chunk else (none, none)
                right = zone(ends, starts, end - r.overlap, end) if end < r.n else (none, none)
                yield pd.DataFrame({"text_key": [r.text_key], "n": [r.n], "overlap": [r.overlap], "chunk": [r.chunk], "n_tokens": [len(ends)],
                                    "left_zone": [left[0]], "left_count": [left[1]], "right_zone": [right[0]], "right_count": [right[1]]})

    return encode


def _spliced(encoded: DataFrame) -> DataFrame:
    """(text_key, overlap, n_tokens) of texts; n_tokens null where neighbours share no token.

    Chunk by chunk: its tokens after the splice with its left neighbour, less
    those after the splice with its right one.
    """
    left = encoded.select("text_key", "overlap", "n_tokens", "chunk", "left_zone", "left_count")
    right = encoded.select("text_key", (F.col("chunk") + 1).alias("chunk"), "n_tokens", "right_zone", "right_count") \
        .select("text_key", "chunk", F.col("n_tokens").alias("n_before"), "right_zone", "right_count")
    both = left.join(right, ["text_key", "chunk"], "left")
    shared = F.array_max(F.array_intersect("left_zone", "right_zone"))
    at = lambda zone, count: F.element_at(count, F.array_position(zone, F.col("shared")).cast("int"))
    # The last token that both have; tokens before it are left out of this chunk, those after it out of the one before.
    both = both.withColumn("shared", shared)
    net = F.when(F.col("chunk") == 0, F.col("n_tokens")).otherwise(
        F.col("n_tokens") - at("left_zone", "left_count") - (F.col("n_before") - at("right_zone", "right_count")))
    return both.groupBy("text_key", "overlap").agg(
        F.when(F.count(net) == F.count(F.lit(1)), F.sum(net)).alias("n_tokens"))


def long_counts(texts: DataFrame, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(text_key, n_tokens) of distinct long texts (text_key string, text string)."""
    done, open_, width = None, texts.withColumn("overlap", F.lit(overlap).cast("long")), overlap
    while True:
        rows = open_.mapInPandas(_cut(chunk), _CHUNK_ROWS)
        spread = rows.repartition("text_key", "chunk").mapInPandas(_encode(path, chunk), _ENCODED)
        counts = written(_spliced(written(spread, "counts-chunks")), "counts-spliced")
        found = counts.where("n_tokens is not null").select("text_key", "n_tokens")
        done = found if done is None else done.unionByName(found)
        failed = counts.where("n_tokens is null").select("text_key")
        if failed.isEmpty():
            return done
        width *= WIDEN  # beyond a quarter of a text, that text is one chunk: the loop ends
        open_ = texts.join(failed, "text_key", "left_semi").withColumn("overlap", F.lit(width).cast("long"))


def counted(docs: DataFrame, tokenizer: str = TOKENIZER, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of ``docs`` (doc_id, text;
    other columns are not read), tokens as the whole text's encoding has them."""
    if not 0 < overlap <= chunk // 4:
        raise ValueError("a chunk holds four overlaps at least")
    path = public_tokenizers.path(tokenizer)
    check_model(path)
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = docs.select("doc_id", text.alias("text"))
    is_long = F.char_length("text") > chunk
    with text_batches(spark):
        first = written(docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), _short(path, chunk)("text").alias("n_short"),
                                    F.when(is_long, F.sha2("text", 256)).alias("text_key")), "counts-short")
        if first.where("text_key is not null").isEmpty():
            return first.select("doc_id", "n_bytes", F.col("n_short").alias("n_tokens"))
        texts = docs.where(is_long).select(F.sha2("text", 256).alias("text_key"), "text").dropDuplicates(["text_key"])
        longs = long_counts(written(texts, "counts-long"), path, chunk, overlap)
    return first.join(longs, "text_key", "left").select("doc_id", "n_bytes", F.coalesce("n_short", "n_tokens").alias("n_tokens"))


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document's whole text, and whether they are over the limit."""
    c = counted(documents(spark, sf_dir))
    return c.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
