"""Runs of words that repeat with a period, by internal pattern matching.

A run is a stretch of words in which words ``q`` apart are equal, with ``q``
its smallest period, at least ``LEAST`` words and two periods long, that its
neighbouring words don't extend. The words of a batch of documents are numbered
so that equal numbers mean equal words of one document; then:

1. Prefix doubling names all stretches of 1, 2, 4, ... words (equal names,
   equal stretches) until no name stands twice in a document. The last names
   give the suffix array; at each level the suffixes that begin with a stretch
   are neighbours in it.
2. Blocks of 2^k words (k >= 2) begin at every 2^(k-1)-th word. Any stretch of
   3 * 2^(k-1) - 1 words holds one. So a run's first ``length - q`` words hold
   a block of the level of ``q`` that occurs again ``q`` words on.
3. A block asks for its occurrences in the window that follows it, one after
   another: the least place from x on in its range of the suffix array (range
   successor), counted down a wavelet matrix over the suffix array. Windows are
   a few blocks long, so there are O(n) answers a level, O(n log n) in all.
4. Occurrences that follow each other by ``p``, half a block at most, are a
   progression: the block has period p. If the block itself stands in the
   same stretch of period p, only p can be a smallest period there; else every
   term of the progression gives a candidate period.
5. A candidate period is extended from its block to both sides, comparing
   names of falling length; what reaches the length of a run is one. Of equal
   stretches the smallest period counts.

All steps are array operations over the batch; documents without a repeated
block of four words have no run and leave after the second doubling. A batch
holds ``BATCH_WORDS`` words or one document; memory is 4 bytes for each word
and level of it.

Defined results: null and wordless texts have no runs and collapse to the
empty text; rows are judged by themselves, repeated ids or not; a row without
doc_id is taken as it stands (nothing of it is made periodic); an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, text_batches, written

LEAST = 12
FIRST_LEVEL = 2
BATCH_WORDS = 1 << 16

_RESULT = "key string, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def _dense(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of values (equal ones share one), and their sorted order."""
    order = np.argsort(values, kind="stable")
    by = values[order]
    rank = np.empty(len(values), np.int32)
    rank[order] = np.cumsum(np.concatenate([[0], by[1:] != by[:-1]]), dtype=np.int32)
    return rank, order


def double(names: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of stretches twice as long, and the order of their first words.

    The batch's last word is unlike any other, so that stretches beyond its
    end never decide.
    """
    second = np.full(len(names), -1, np.int64)
    second[: len(names) - half] = names[half:]
    return _dense(names.astype(np.int64) * (len(names) + 1) + second + 1)


class WaveletMatrix:
    """Counts and order statistics of ranges of a sequence below 2^bits."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values) - 1).bit_length())
        self.ones, self.zeros = [], []
        v = values
        for b in range(self.bits - 1, -1, -1):
            bit = (v >> b) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32))
            self.zeros.append(len(v) - int(self.ones[-1][-1]))
            v = np.concatenate([v[bit == 0], v[bit == 1]])

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray, none: int) -> np.ndarray:
        """Least value >= x within each range [lo, hi), ``none`` where there is none."""
        below, a, b = np.zeros(len(lo), np.int64), lo.astype(np.int64), hi.astype(np.int64)
        for i, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            bit = (x >> (self.bits - 1 - i)) & 1
            one_a, one_b = ones[a], ones[b]
            below += np.where(bit == 1, (b - a) - (one_b - one_a), 0)
            a, b = np.where(bit == 1, zeros + one_a, a - one_a), np.where(bit == 1, zeros + one_b, b - one_b)
        found = (below < hi - lo) & (x >> self.bits == 0)
        out = np.full(len(lo), none, np.int64)
        a, b, nth = lo[found].astype(np.int64), hi[found].astype(np.int64), below[found]
        value = np.zeros(len(a), np.int64)
        for i, (ones, zeros) in enumerate(zip(self.ones, self.zeros, strict=True)):
            one_a, one_b = ones[a], ones[b]
            n_zero = (b - a) - (one_b - one_a)
            up = nth >= n_zero
            nth = np.where(up, nth - n_zero, nth)
            value |= up.astype(np.int64) << (self.bits - 1 - i)
            a, b = np.where(up, zeros + one_a, a - one_a), np.where(up, zeros + one_b, b - one_b)
        out[found] = value
        return out


def forward(names: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Equal words from i and j on."""
    n, out = len(names[0]), np.zeros(len(i), np.int64)
    for k in range(len(names) - 1, -1, -1):
        a, b = np.minimum(i + out, n - 1), np.minimum(j + out, n - 1)
        out += np.where(names[k][a] == names[k][b], 1 << k, 0)
    return out


def backward(names: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Equal words before i and j (i < j)."""
    out = np.zeros(len(i), np.int64)
    for k in range(len(names) - 1, -1, -1):
        a, b = i - out - (1 << k), j - out - (1 << k)
        out += np.where((a >= 0) & (names[k][np.maximum(a, 0)] == names[k][np.maximum(b, 0)]), 1 << k, 0)
    return out


def _occurrences(names: list[np.ndarray], level: int, wavelet: WaveletMatrix, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of a block, candidate period) from the blocks of a level.

    ``first``, ``size``: the range of the suffix array of each name of the level.
    """
    block, n = 1 << level, len(names[0])
    lo_q, hi_q = (1, 3 * block - 1) if level == FIRST_LEVEL else (3 * block // 2 - 1, 3 * block - 1)
    at = np.arange(0, n, block // 2)
    name = names[level][at]
    at, name = at[size[name] > 1], name[size[name] > 1]
    x, found = at + lo_q, []
    while len(at):
        lo, hi = first[name], first[name] + size[name]
        y = wavelet.successor(lo, hi, x, n + hi_q)
        on = y < at + hi_q
        at, name, y, lo, hi = at[on], name[on], y[on], lo[on], hi[on]
        if not len(at):
            break
        found.append((at, y - at))
        z = wavelet.successor(lo, hi, y + 1, n + hi_q)
        p = z - y
        series = (p <= block // 2) & (z < at + hi_q)
        x = y + 1
        if series.any():
            s = np.flatnonzero(series)
            end = z[s] + forward(names, y[s], z[s])  # of the stretch of period p
            last = np.minimum(y[s] + (end - block - y[s]) // p[s] * p[s], at[s] + hi_q - 1)
            terms = (last - y[s]) // p[s]
            same = forward(names, at[s], at[s] + p[s]) >= y[s] - at[s]  # the block stands in that stretch itself
            terms = np.where(same, 0, terms)
            more = np.repeat(np.arange(len(s)), terms)
            step = np.arange(len(more)) - np.repeat(np.cumsum(terms) - terms, terms) + 1
            found.append((at[s][more], (y[s] - at[s])[more] + step * p[s][more]))
            x[s] = y[s] + (end - block - y[s]) // p[s] * p[s] + 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def find(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, by start and then period.

    ``words``: numbers of words; ``owner``: the document of each, ascending.
    Places are those in ``words``.
    """
    none = (np.zeros(0, np.int64),) * 3
    if not len(words):
        return none
    # Equal words of two documents differ, and one word stands after each document.
    spread = np.arange(len(words)) + owner  # each owner's words move on by the stops before
    n = len(words) + owner[-1] + 1
    text = np.empty(n, np.int64)
    text[spread] = owner * (words.max() + 1) + words
    gap = np.ones(n, bool)
    gap[spread] = False
    text[gap] = text[spread].max() + 1 + np.arange(gap.sum())
    names = [_dense(text)[0]]
    order = None
    while order is None or names[-1][order[-1]] < n - 1:
        rank, order = double(names[-1], 1 << (len(names) - 1))
        names.append(rank)
    wavelet, found = None, []
    for level in range(FIRST_LEVEL, len(names)):
        size = np.bincount(names[level], minlength=n)
        if size.max() < 2:
            break
        if wavelet is None:
            wavelet = WaveletMatrix(order)
        found.append(_occurrences(names, level, wavelet, np.cumsum(size) - size, size))
    if not found:
        return none
    at, q = (np.concatenate(c) for c in zip(*found, strict=True))
    start = at - backward(names, at, at + q)
    end = at + q + forward(names, at, at + q)
    ok = end - start >= np.maximum(LEAST, 2 * q)
    start, end, q = start[ok], end[ok], q[ok]
    by = np.lexsort((q, end, start))
    start, end, q = start[by], end[by], q[by]
    least = np.concatenate([[True], (np.diff(start) != 0) | (np.diff(end) != 0)])[: len(start)]
    start, end, q = start[least], end[least], q[least]
    by = np.lexsort((q, start))
    back = np.cumsum(gap)  # stops up to each place
    return start[by] - back[start[by]], (end - start)[by], q[by]


def periodic(words: list, doc_id: str | None) -> list:
    """The words with a periodic end, where the contract's rule asks for one."""
    h = zlib.crc32(doc_id.encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def _repeats(names: np.ndarray, owner: np.ndarray, docs: int) -> np.ndarray:
    """Documents in which a block of four words stands twice."""
    codes = owner.astype(np.int64) * (int(names.max()) + 1) + names
    n = len(codes)
    if n < LEAST:
        return np.zeros(docs, bool)
    h = np.zeros(n - 3, np.uint64)
    for k in range(4):
        h = (h ^ codes[k : n - 3 + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    by = np.argsort(h)
    twice = by[1:][h[by][1:] == h[by][:-1]]  # equal blocks have equal digests: none is missed
    out = np.zeros(docs, bool)
    out[owner[twice]] = True
    return out


def _numbers(lists: list[list]) -> tuple[np.ndarray, np.ndarray]:
    flat = [w for ws in lists for w in ws]
    seen: dict = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in flat), np.int64, len(flat)), np.repeat(np.arange(len(lists)), [len(w) for w in lists])


def describe(lists: list[list[bytes]]) -> list[tuple]:
    """Per document (n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256)."""
    starts = np.cumsum([0] + [len(w) for w in lists])
    runs: list[list[tuple[int, int, int]]] = [[] for _ in lists]
    numbers, owner = _numbers(lists)
    if len(numbers):
        some = _repeats(numbers, owner, len(lists))
        rows = some[owner]
        again = np.cumsum(some) - 1  # the documents that are left, numbered anew
        to = np.flatnonzero(rows)
        for s, n, q in zip(*(x.tolist() for x in find(numbers[rows], again[owner[rows]])), strict=True):
            i = int(owner[to[s]])
            runs[i].append((int(to[s]) - int(starts[i]), n, q))
    out = []
    for ws, own in zip(lists, runs, strict=True):
        if own:
            drop = np.zeros(len(ws) + 1, np.int64)
            for s, n, q in own:
                drop[s + q] += 1
                drop[s + n] -= 1
            gone = np.cumsum(drop) > 0
            ws = [w for w, x in zip(ws, gone.tolist(), strict=False) if not x]
            s, n, q = min(own, key=lambda r: (-r[1], r[0], r[2]))
            top = (len(own), s, n, q, 1000 * n // q)
        else:
            top = (0, None, None, None, None)
        text = "".join(f"{s},{n},{q}\n" for s, n, q in own)
        out.append((*top, hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(b" ".join(ws)).hexdigest()))
    return out


def _described(prepare):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            keys, lists, words = [], [], 0
            for key, text in zip(b["key"], b["text"], strict=True):
                ws = prepare(text.encode("utf-8").split() if text else [], key)
                if lists and words + len(ws) > BATCH_WORDS:
                    yield _frame(keys, lists)
                    keys, lists, words = [], [], 0
                keys.append(key)
                lists.append(ws)
                words += len(ws)
            if lists:
                yield _frame(keys, lists)

    return rows


def _frame(keys: list, lists: list) -> pd.DataFrame:
    cols = [c.split()[0] for c in _RESULT.split(", ")]
    df = pd.DataFrame([(k, *r) for k, r in zip(keys, describe(lists), strict=True)], columns=cols)
    return df.astype({c: "Int64" for c in cols[1:6]})


def _as_it_is(words: list, key: str | None) -> list:
    return words


def word_runs(docs: DataFrame, prepare=_as_it_is) -> DataFrame:
    """Runs of every row of ``docs`` (doc_id, text; other columns are not read):
    doc_id, n_runs, the longest run, digests of all runs and of the text without
    its repetitions. ``prepare`` maps (words, doc_id as text) to the words judged."""
    rows = docs.select(F.col("doc_id").cast("string").alias("key"), "text").mapInPandas(_described(prepare), _RESULT)
    cols = [c.split()[0] for c in _RESULT.split(", ")][1:]
    with text_batches(docs.sparkSession):
        return written(rows.select(F.col("key").cast(docs.schema["doc_id"].dataType).alias("doc_id"), *cols), "runs")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, some of which are made periodic by rule."""
    return word_runs(documents(spark, sf_dir), periodic)
