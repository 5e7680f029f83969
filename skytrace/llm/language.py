"""Language identification by rank-order profiles.

The n-grams (1 to ``LONGEST`` letters of lower-cased words, a space at either
end) of all labelled texts of a language are counted over the whole corpus;
the ``PROFILE`` most frequent, by rank, are its profile. A document's own
most frequent n-grams are ranked alike. Its distance to a profile is the sum
of the differences in rank, ``PROFILE`` for an n-gram that the profile lacks;
the nearest profile is the prediction. The score is one minus the distance's
share of the greatest possible distance.

Counting is map-side: every task adds up the n-grams of the texts it reads
and only its sums are shuffled, so a language that holds most of the rows
costs no more than another. The profiles (languages times ``PROFILE`` rows,
checked against ``MAX_PROFILES``) are all that reaches the driver.

Defined results: a null text, or one without a letter, is ``und`` with score
0; equal counts rank by n-gram, equal distances choose the language first by
code point; without any labelled text everything is ``und``; rows with a null
label, and repeated rows, count as they stand; very long texts are counted
whole, in pieces of ``PIECE`` characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import documents, small_batches, tidy

LONGEST = 3
PROFILE = 400
MAX_PROFILES = 5000
UNKNOWN = "und"
PIECE = 1 << 20
#: Distinct n-grams that a task holds before it passes its sums on.
HELD = 500_000
_BITS = 21  # of a code point


@cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


def _grams(piece: str) -> np.ndarray:
    """Codes of all n-grams in a piece, none of which spans two words."""
    c = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[c]
    c = np.where(letter, c, 32)
    keep = np.ones(len(c), bool)
    keep[1:] = letter[1:] | letter[:-1]  # one space of each run
    c = np.concatenate([[32], c[keep], [32]]).astype(np.int64)
    inner = c != 32
    out, code = [c[inner]], c
    for n in range(2, LONGEST + 1):
        code = (code[:-1] << _BITS) | c[n - 1 :]
        ok = np.ones(len(code), bool)
        for k in range(1, n - 1):  # a space may stand at either end, but not inside
            ok &= inner[k : k + len(code)]
        if n == 2:
            ok &= inner[:-1] | inner[1:]
        out.append(code[ok])
    return np.concatenate(out)


def _counted(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and their (summed) counts."""
    if counts is None:
        codes = np.sort(codes)
    else:
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
    if not len(codes):
        return codes, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    sums = np.diff(np.append(first, len(codes))) if counts is None else np.add.reduceat(counts, first)
    return codes[first], sums


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """N-gram codes of a text in order, with counts."""
    text = text.lower()
    pieces, at = [], 0
    while at < len(text):
        end = at + PIECE
        while end < len(text) and text[end - 1].isalpha() and end < at + 2 * PIECE:
            end += 1  # to the end of a word
        pieces.append(_counted(_grams(text[at:end])))
        at = end
    if len(pieces) == 1:
        return pieces[0]
    if not pieces:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return _counted(np.concatenate([p[0] for p in pieces]), np.concatenate([p[1] for p in pieces]))


def _sum_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    n = 0

    def sums() -> Iterator[pd.DataFrame]:
        for lang, parts in held.items():
            codes, counts = _counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            yield pd.DataFrame({"lang": lang, "gram": codes, "n": counts})

    for b in batches:
        for lang, text in zip(b["lang"], b["text"], strict=True):
            part = gram_counts(text)
            held.setdefault(lang, []).append(part)
            n += len(part[0])
            if n > HELD:  # add up; pass on if that doesn't help
                held = {k: [_counted(np.concatenate([p[0] for p in v]), np.concatenate([p[1] for p in v]))] for k, v in held.items()}
                n = sum(len(v[0][0]) for v in held.values())
                if n > HELD // 2:
                    yield from sums()
                    held, n = {}, 0
    yield from sums()


def profiles(labelled: DataFrame) -> DataFrame:
    """(lang, gram, rank) of the most frequent n-grams of each language.

    ``labelled``: columns text and lang; rows lacking either are left out.
    """
    small_batches(labelled.sparkSession)
    sums = labelled.select("lang", "text").where("lang is not null and text is not null") \
        .mapInPandas(tidy(_sum_grams), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return sums.withColumn("rank", rank).where(F.col("rank") <= PROFILE).select("lang", "gram", "rank")


def _ranks(rows) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, all grams of the profiles in order, and their ranks by language."""
    langs = sorted({r.lang for r in rows})
    grams = np.unique(np.array([r.gram for r in rows], np.int64))
    ranks = np.full((len(grams), len(langs)), -1, np.int32)
    place = {k: i for i, k in enumerate(langs)}
    for r in rows:
        ranks[np.searchsorted(grams, r.gram), place[r.lang]] = r.rank - 1
    return langs, grams, ranks


def nearest(text: str | None, langs: list[str], grams: np.ndarray, ranks: np.ndarray) -> tuple[str, float]:
    """The language whose profile is the least out of place, and the score."""
    if text is None or not langs:
        return UNKNOWN, 0.0
    codes, counts = gram_counts(text)
    if not len(codes):
        return UNKNOWN, 0.0
    top = np.argsort(-counts, kind="stable")[:PROFILE]
    at = np.searchsorted(grams, codes[top])
    at[at == len(grams)] = 0
    own = ranks[at]
    own[grams[at] != codes[top]] = -1
    apart = np.where(own < 0, PROFILE, np.abs(own - np.arange(len(top))[:, None])).sum(axis=0)
    best = int(apart.argmin())
    return langs[best], 1.0 - float(apart[best]) / (PROFILE * len(top))


def predict(docs: DataFrame, learned: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``; columns of these names give way."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = learned.limit(MAX_PROFILES * PROFILE + 1).collect()
    if len(rows) > MAX_PROFILES * PROFILE:
        raise ValueError(f"more than {MAX_PROFILES} languages")
    model = spark.sparkContext.broadcast(_ranks(rows))

    @F.pandas_udf("lang string, score double")
    def guess(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([nearest(t, *model.value) for t in texts], columns=["lang", "score"])

    out = docs.withColumn("lang_guess", guess(F.col(f"`{text}`")))
    return out.withColumn("lang_pred", F.col("lang_guess.lang")).withColumn("lang_score", F.col("lang_guess.score")).drop("lang_guess")


def held_out(doc_id: str = "doc_id"):
    """Whether a document is kept from learning: crc32 of its id modulo 4 is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those not held out."""
    d = documents(spark, sf_dir)
    learned = profiles(d.where(~held_out()).select("text", "lang"))
    p = predict(d.select("doc_id", "text"), learned)
    return p.select("doc_id", held_out().alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
