"""Token ids as grammar-compressed binary shards (Re-Pair).

Documents are range-partitioned by doc_id, encoded with a public tokenizer
and packed, in order, into shards of whole documents of about
``SHARD_TOKENS`` ids. Within a shard Re-Pair replaces frequent pairs of ids
by nonterminals: a round counts all pairs, takes the most frequent, gives
each a rule and replaces its occurrences from left to right; rounds follow
until no pair is frequent (or the shard has ``SYMBOLS`` symbols, of which a
pair takes 32 bits). Pairs never span two documents, so each document
is a run of symbols of its own and can be decoded alone; the stored expansion
lengths give the ids before any symbol without expanding it.

File format: a Parquet folder, one row a shard, written by Spark's committer
(a lost executor's shard is written again, never twice). Columns:

- ``part``, ``shard``: place in doc_id order; ``start``: ids of all documents
  of the part before the shard;
- ``doc_ids`` (array), ``symbols_to`` and ``tokens_to`` (arrays): where each
  document's symbols and ids end within the shard;
- ``terminals``: the distinct ids in the shard, uint32 little-endian; symbol
  ``s`` below their number is the id there;
- ``rules``: pairs of symbols, uint32 little-endian; symbol ``n_terminals + r``
  expands to pair ``r``; ``lengths``: ids that each rule expands to, uint32;
- ``symbols``: the shard's symbols, uint16 little-endian where ``wide`` is
  false, else uint32.

Defined results: a null text is empty and holds the end id alone; documents
with equal ids stand by text, nulls first, and repeated rows all stay; null
doc_ids come first; an empty table gives an empty folder and an empty result;
a text longer than a shard is a shard by itself.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import ensure_checkpoint_dir
from .common import documents, small_batches, tidy, written

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
SHARD_TOKENS = 1 << 18
#: A pair gets a rule from this many occurrences on; so many rules a round.
MIN_COUNT, RULES_A_ROUND = 6, 2048
#: Terminals and rules of a shard at most: a pair of symbols is 32 bits.
SYMBOLS = 1 << 16
#: Parts of texts whose ids a worker remembers; beyond it, the half met in most
#: batches stay.
REMEMBERED = 300_000
#: Parts encoded in one string.
PARTS_A_RUN = 256

FORMAT = ("part long, shard long, start long, doc_ids array<long>, symbols_to array<long>, tokens_to array<long>, "
          "terminals binary, rules binary, lengths binary, symbols binary, wide boolean")

_SHARD = pa.schema([
    ("part", pa.int64()), ("shard", pa.int64()), ("start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("symbols_to", pa.list_(pa.int64())),
    ("tokens_to", pa.list_(pa.int64())), ("terminals", pa.binary()), ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary()),
    ("wide", pa.bool_()),
])

#: The tokenizer splits a text before a space that follows anything but white
#: space, between a letter and one of these marks, and after a single line
#: break, whatever stands around it; it encodes the parts independently.
_LETTER, _MARK = "[A-Za-zÀ-ÖØ-öø-ɏ]", "[.,;:!?]"
_CUT = re.compile(rf"(?<=\S)(?= )|(?<={_LETTER})(?={_MARK})|(?<=\S\n)(?=\S)")
#: The same in Arrow's regexes, which do not look behind: a separator goes in
#: at each cut. Texts that hold it, or white space before a space (not every
#: space cuts) or a space at the start, are cut by ``_CUT``.
_AT = "\x01"
_BLANK = r"\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
_FINER = (f"({_LETTER})({_MARK})", rf"([^{_BLANK}]\n)([^{_BLANK}])")
_ODD = rf"(?:^|[{_BLANK}]) |{_AT}"
#: Parts that begin with a space and end without white space.
_PLAIN = rf"(?s)^ .*[^{_BLANK}]$"


class Encoder:
    """Encodes texts part by part, each distinct part once."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.n_bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)  # one letter of a byte-level token stands for one byte
        for token, i in vocabulary.items():
            self.n_bytes[i] = len(token)
        self._remember(pa.array([], pa.large_string()), np.array([END_ID], np.uint32), np.array([1]), np.zeros(1, np.int64))

    def _remember(self, known: pa.Array, ids: np.ndarray, size: np.ndarray, met: np.ndarray) -> None:
        """Parts by place from 1 on (0 is the end of a text), the ids of all,
        how many each has, and in how many batches each was met."""
        self.known, self.ids, self.size, self.met = known, ids, size, met
        self.first = np.cumsum(size) - size

    def _forget(self) -> None:
        keep = np.sort(np.argsort(-self.met[1:], kind="stable")[: REMEMBERED // 2])
        places = np.concatenate([[0], keep + 1])
        ids, size = self._ids(places)
        self._remember(self.known.take(pa.array(keep)), ids, size, self.met[places] // 2)

    def _encode(self, parts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all parts, and how many each has. Parts that begin with a
        space and end without one are encoded in one string: the cut between
        them is one that the tokenizer makes itself."""
        plain = pc.match_substring_regex(parts, _PLAIN)
        row = plain.to_numpy(zero_copy_only=False).astype(bool)
        order = np.concatenate([np.flatnonzero(row), np.flatnonzero(~row)])
        runs, n = parts.filter(plain), int(row.sum())
        data = "".join(runs.to_numpy(zero_copy_only=False).tolist())
        letters = np.concatenate([[0], np.cumsum(pc.utf8_length(runs).to_numpy())])[np.append(np.arange(0, n, PARTS_A_RUN), n)]
        texts = [data[i:j] for i, j in zip(letters[:-1], letters[1:], strict=True)] + parts.filter(pc.invert(plain)).to_pylist()
        ids = np.concatenate([  # what the tokenizer returns takes much memory
            np.fromiter(chain.from_iterable(e.ids for e in self.tokenizer.encode_batch_fast(texts[i : i + 128], add_special_tokens=False)), np.uint32)
            for i in range(0, len(texts), 128)
        ])
        to = np.cumsum(pc.binary_length(parts).to_numpy()[order])
        ends = np.searchsorted(np.cumsum(self.n_bytes[ids]), to) + 1
        size = np.empty(len(parts), np.int64)
        size[order] = np.diff(np.concatenate([[0], ends]))
        first = np.empty(len(parts), np.int64)
        first[order] = ends - size[order]
        return ids[_spread(first, size)], size

    def _ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known parts, one after another, and how many each has."""
        size = self.size[places]
        return self.ids[_spread(self.first[places], size)], size

    def _places(self, parts: pa.Array) -> np.ndarray:
        """The places of parts; those not met before are encoded. Known parts
        stand first in the dictionary, so that a part's index is its place."""
        n = len(self.known)
        every = pa.concat_arrays([self.known, parts]).dictionary_encode()
        places = every.indices.to_numpy()[n:] + 1
        if len(every.dictionary) > n:
            ids, size = self._encode(every.dictionary.slice(n))
            self._remember(every.dictionary, np.concatenate([self.ids, ids]), np.concatenate([self.size, size]),
                           np.concatenate([self.met, np.zeros(len(size), np.int64)]))
        self.met += np.bincount(places, minlength=len(self.met)) > 0
        return places

    def _split(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places of all parts of texts that every space cuts, and how many
        each text has."""
        cut = texts
        for pattern in _FINER:
            cut = pc.replace_substring_regex(cut, pattern, rf"\1{_AT}\2")
        cut = pc.split_pattern(pc.replace_substring(cut, " ", f"{_AT} "), _AT)
        return self._places(cut.flatten()), pc.list_value_length(cut).to_numpy()

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same for any texts."""
        cut = [_CUT.split(t) for t in texts.to_pylist()]
        return self._places(pa.array(chain.from_iterable(cut), pa.large_string())), np.array([len(c) for c in cut], np.int64)

    def __call__(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, the end id after each, and where each text ends."""
        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        if len(self.known) > REMEMBERED:
            self._forget()
        some = pc.fill_null(pc.binary_length(texts), 0).to_numpy() > 0
        odd = pc.fill_null(pc.match_substring_regex(texts, _ODD), False).to_numpy(zero_copy_only=False).astype(bool)
        count = np.zeros(len(texts), np.int64)
        found = []
        for which, split in ((np.flatnonzero(some & ~odd), self._split), (np.flatnonzero(some & odd), self._cut)):
            if len(which):
                places, n = split(texts.take(pa.array(which)))
                count[which] = n
                found.append((which, places, n))
        ends = np.cumsum(count + 1) - 1
        every = np.zeros(len(texts) + int(count.sum()), np.int64)  # 0: the end of a text
        for which, places, n in found:
            every[_spread(ends[which] - n, n)] = places
        ids, size = self._ids(every)
        return ids, np.cumsum(size)[ends]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return Encoder(path)


def compress(ids: np.ndarray, doc_to: np.ndarray) -> dict:
    """Re-Pair over one shard. ``doc_to``: where each document ends."""
    present = np.zeros(int(ids.max(initial=0)) + 1, bool)
    present[ids] = True
    terminals = np.flatnonzero(present).astype(np.uint32)
    s = (np.cumsum(present) - 1)[ids]
    ends = np.asarray(doc_to, np.int64) - 1  # the last symbol of each document: no pair starts there
    rules, n, fresh = [], len(terminals), 0  # only pairs with a symbol from ``fresh`` on can be frequent
    while True:
        room = min(RULES_A_ROUND, SYMBOLS - n)
        if len(s) < 2 or room <= 0:
            break
        new = s >= fresh
        new = new[:-1] | new[1:]
        new[ends[:-1]] = False
        where = np.flatnonzero(new)
        first, second = s[where], s[where + 1]
        order = np.sort(((first << 16) | second).astype(np.uint32))
        starts = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]])) if len(order) else np.zeros(0, np.int64)
        counts = np.diff(np.append(starts, len(order)))
        often = np.flatnonzero(counts >= MIN_COUNT)
        if not len(often):
            break
        # No occurrence of a rule's pair outlasts its round, and old symbols do
        # not become neighbours: with all frequent pairs taken, the next ones
        # have a symbol of this round.
        fresh = n if len(often) <= room else 0
        best = often if fresh else np.sort(often[np.argsort(-counts[often], kind="stable")[:room]])
        pairs = order[starts[best]]
        # The rules' left and right symbols are numbered, and a table of both
        # numbers has the rule: one look a place that both sides could begin.
        left, right = _numbers(pairs >> np.uint32(16), n), _numbers(pairs & np.uint32(0xFFFF), n)
        width = int(right.max()) + 1
        rule = np.zeros((int(left.max()) + 1) * width, np.int16)
        rule[left[pairs >> np.uint32(16)] * width + right[pairs & np.uint32(0xFFFF)]] = np.arange(1, len(pairs) + 1)
        a, b = left.take(first), right.take(second)
        both = np.flatnonzero((a > 0) & (b > 0))
        at = rule.take(a[both] * width + b[both]).astype(np.int64) - 1
        hit = at >= 0
        where, at = where[both[hit]], at[hit]
        # Of overlapping occurrences, every other one from the left is replaced.
        run, place = np.ones(len(where), bool), np.arange(len(where))
        np.greater(where[1:] - where[:-1], 1, out=run[1:])
        odd = (place - np.maximum.accumulate(np.where(run, place, 0))) & 1 == 0
        take = where[odd]
        s[take] = n + at[odd]
        keep = np.ones(len(s), bool)
        keep[take + 1] = False
        s = s[keep]
        ends = ends - np.searchsorted(take, ends)
        rules.append(pairs)
        n += len(pairs)
    codes = np.concatenate(rules) if rules else np.zeros(0, np.uint32)
    pairs = np.stack([codes >> np.uint32(16), codes & np.uint32(0xFFFF)], axis=1)
    lengths = expansion_lengths(len(terminals), pairs)
    wide = n > 1 << 16
    return {
        "symbols_to": ends + 1, "tokens_to": doc_to, "terminals": terminals.astype("<u4").tobytes(),
        "rules": pairs.astype("<u4").tobytes(), "lengths": lengths[len(terminals) :].astype("<u4").tobytes(),
        "symbols": s.astype("<u4" if wide else "<u2").tobytes(), "wide": wide,
    }


def _numbers(symbols: np.ndarray, n: int) -> np.ndarray:
    """Numbers from 1 for the distinct ``symbols``, 0 for the others below ``n``."""
    out = np.zeros(n, np.int32)
    out[symbols] = 1
    met = np.flatnonzero(out)
    out[met] = np.arange(1, len(met) + 1)
    return out


def expansion_lengths(n_terminals: int, pairs: np.ndarray, level: np.ndarray | None = None) -> np.ndarray:
    """Ids that each symbol expands to; a rule refers to earlier symbols only."""
    out = np.ones(n_terminals + len(pairs), np.int64)
    level = _levels(n_terminals, pairs) if level is None else level
    for k in range(1, int(level.max(initial=0)) + 1):
        at = np.flatnonzero(level == k)
        out[at] = out[pairs[at - n_terminals]].sum(axis=1)
    return out


def _levels(n_terminals: int, pairs: np.ndarray) -> np.ndarray:
    """How deep the rules of each symbol nest."""
    level = np.zeros(n_terminals + len(pairs), np.int64)
    if not len(pairs):
        return level
    level[n_terminals:] = 1
    while True:
        new = level.copy()
        new[n_terminals:] = level[pairs].max(axis=1) + 1
        if (new == level).all():
            return level
        level = new


def expand(symbols: np.ndarray, terminals: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """The ids of a run of symbols: what each rule stands for is spelt out
    once, level by level; the run then is one gather."""
    n = len(terminals)
    level = _levels(n, pairs)
    size = expansion_lengths(n, pairs, level)
    to = np.cumsum(size)
    spelt = np.zeros(int(to[-1]) if len(to) else 0, np.uint32)
    spelt[:n] = terminals
    for k in range(1, int(level.max(initial=0)) + 1):
        rule = np.flatnonzero(level == k)
        both = pairs[rule - n].reshape(-1)
        spelt[_spread(to[rule] - size[rule], size[rule])] = spelt[_spread(to[both] - size[both], size[both])]
    s = symbols.astype(np.int64)
    return spelt[_spread((to - size)[s], size[s])]


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of runs that begin at ``first``, one after another."""
    to = np.cumsum(size)
    return np.repeat(first - (to - size), size) + np.arange(int(to[-1]) if len(to) else 0)


def decode(row) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a shard, and where each document ends."""
    terminals, pairs, symbols = _parts(row)
    return expand(symbols, terminals, pairs), np.asarray(row["tokens_to"], np.int64)


def decode_document(row, k: int, lo: int = 0, hi: int | None = None) -> np.ndarray:
    """The ids of document ``k`` of a shard, or those from ``lo`` to ``hi`` of it.

    Only what is asked for is expanded: the stored lengths say where the ids of
    each symbol begin, symbols beside the stretch are passed over, and rules
    are replaced by their pairs until terminals are left.
    """
    to, size = row["symbols_to"], np.frombuffer(row["lengths"], "<u4")
    terminals, rules = np.frombuffer(row["terminals"], "<u4"), np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    s = np.frombuffer(row["symbols"], "<u4" if row["wide"] else "<u2")[to[k - 1] if k else 0 : to[k]].astype(np.int64)
    n = len(terminals)

    def length(x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), np.int64)
        out[x >= n] = size[x[x >= n] - n]
        return out

    each = length(s)
    first = np.cumsum(each) - each
    hi = int(each.sum()) if hi is None else min(hi, int(each.sum()))
    out = np.zeros(max(0, hi - lo), np.uint32)
    while len(s):
        near = (first < hi) & (first + each > lo)
        s, first = s[near], first[near]
        done = s < n
        out[first[done] - lo] = terminals[s[done]]
        both, at = rules[s[~done] - n].astype(np.int64), first[~done]
        s = both.reshape(-1)
        each = length(s)
        first = np.stack([at, at + each[::2]], axis=1).reshape(-1)
    return out


def _parts(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.frombuffer(row["terminals"], "<u4"), np.frombuffer(row["rules"], "<u4").reshape(-1, 2).astype(np.int64),
            np.frombuffer(row["symbols"], "<u4" if row["wide"] else "<u2"))


def _pack(path: str):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path), TaskContext.get().partitionId()
        ids, sizes, doc_ids, held, shard, start = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            row = compress(np.concatenate(ids), np.cumsum(sizes))
            return pa.RecordBatch.from_pylist([{"part": part, "shard": shard, "start": start, "doc_ids": doc_ids, **row}], _SHARD)

        for b in batches:
            got, to = encode(b.column("text"))
            size = np.diff(to, prepend=0).tolist()
            for doc_id, n, hi in zip(b.column("doc_id").to_pylist(), size, to.tolist(), strict=True):
                if held and held + n > SHARD_TOKENS:
                    yield close()
                    ids, sizes, doc_ids, held, shard, start = [], [], [], 0, shard + 1, start + held
                ids.append(got[hi - n : hi])
                sizes.append(n)
                doc_ids.append(doc_id)
                held += n
        if held:
            yield close()

    return pack


def write(docs: DataFrame, path: str, tokenizer: str | None = None) -> None:
    """Write the token ids of ``docs`` (doc_id long, text string; other columns
    are not read) to the folder ``path``, in ascending doc_id order."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text").repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    rows.mapInArrow(tidy(_pack(tokenizer or public_tokenizers.path(TOKENIZER))), FORMAT).write.parquet(path)


_DIGEST = ["doc_id", "part", "before", "n_tokens", "ids_crc32", "n_symbols"]


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, n_symbols) of every document in the
    folder, all from its decoded ids."""
    shards = spark.read.schema(FORMAT).parquet(path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder.cache_clear()  # the shards are written: no task encodes any more
        for b in batches:
            for row in b.to_pylist():
                ids, to = decode(row)
                data, ends = memoryview(ids.astype("<u4", copy=False)).cast("B"), (4 * to).tolist()
                size = np.diff(to, prepend=0)
                crc = [zlib.crc32(data[i:j]) for i, j in zip([0, *ends[:-1]], ends, strict=True)]
                symbols = np.diff(np.asarray(row["symbols_to"], np.int64), prepend=0)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (
                    row["doc_ids"], np.full(len(to), row["part"]), row["start"] + to - size, size, crc, symbols)], _DIGEST)

    out = written(shards.mapInArrow(tidy(digest), ", ".join(f"{c} long" for c in _DIGEST)), "token-documents")
    # One row a part, as many as the range partitions of the writing job.
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    earlier = out.groupBy("part").agg(F.sum("n_tokens").alias("n")) \
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    return out.join(earlier, "part").select("doc_id", (F.col("earlier") + F.col("before")).alias("start"), "n_tokens", "ids_crc32", "n_symbols")


def stored(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` to a new folder beside the checkpoints and read it back."""
    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tokens-{uuid.uuid4().hex}"
    write(docs, path, tokenizer)
    return read_documents(spark, path)


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and digest of every document in the token files."""
    return stored(documents(spark, sf_dir))
