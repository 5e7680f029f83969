"""Near-duplicate documents: LSH forest over MinHash signatures.

A document's set is its distinct 5-word shingles. Equal sets collapse to one
representative by digest. Each representative enters ``TREES`` sorted orders;
order ``t`` sorts by the signature read from value ``STRIDE * t`` on, so that
neighbours share long prefixes. A region of an order is a run of rows that
agree on ``SHALLOW`` values at least. Depth adapts to the region: a run of up
to ``NEAR`` rows gives all its pairs, a larger one is cut at the next depth,
and what stays together down to the last value is paired with the next row.
So a row gives at most ``NEAR - 1`` pairs per order, whatever the group size.

Every link is confirmed on the full sets of both texts. First each document's
neighbour with the longest common prefix is tried; components follow; then all
remaining candidates between different components whose signatures don't rule
them out, until no pair between components is left untried. Pairs inside a
component are not tried: they can't change the result, and a group of
thousands of copies stays linear. In regions too large for all pairs, each row
is then tried against every member of the other groups it shares a region
with, in blocks that count all intersections through one shingle index; and
the rows single there before are tried against each other by prefixes of their
full sets, which leaves out no pair that reaches the similarity: rows that
share a shingle of their prefixes are a list; equal lists are taken once; pairs
are formed within tasks, and only those leave them that the signatures don't
rule out (short lists) or that are confirmed links between what the task has
not linked yet (long lists, in blocks).

A pair at similarity 0.85 shares ``SHALLOW`` values in one of the orders with
probability 1 - (1 - 0.85**4)**20 > 0.9999995, at six values still 0.9999.

Defined results: a null or wordless text has the empty set, component and
keeps itself; rows that share a doc_id are one document; a row without doc_id
is linked with nothing and stays; repeated rows share a component; ties go to
the least doc_id; an empty table gives an empty result; texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, small_batches, tidy, written
from .components import components

SHINGLE = 5
PERCENT = 85
TREES, STRIDE, DEPTH, SHALLOW = 20, 6, 16, 4
HASHES = TREES * STRIDE
NEAR = 5
#: Shingles in a block when rows are tried against all members of a group or
#: list: some 500 texts of usual length, few of great length.
BLOCK_SHINGLES = 200_000
#: Rows that a list may have to be compared in one stretch.
SHORT_LIST = 256
#: Counts of shingles are kept by so many of their low bits' values.
BUCKETS = 1 << 20
#: So many ids (8 bytes each) may be broadcast to pick the texts to compare;
#: more are joined by shuffling.
BROADCAST_IDS = 4_000_000
ROWS = 2048  # of a long set hashed at once

_rng = np.random.default_rng(20240229)
_MUL = (_rng.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)).astype(np.uint32)
_ADD = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit shingle digests; A-Z lower-cased, ASCII white space."""
    w = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    k = min(SHINGLE, len(w))
    code = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        code = code * _P + h[i : len(w) - k + 1 + i]
    return np.unique(_mix(code))


def signature(s: np.ndarray) -> bytes:
    """The low 16 bits of ``HASHES`` minima, big-endian."""
    h = (s >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(h), ROWS):
        np.minimum(least, (h[i : i + ROWS, None] * _MUL + _ADD).min(axis=0), out=least)
    return (least & np.uint32(0xFFFF)).astype(">u2").tobytes()


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
            s = shingles(text)
            some = len(s) > 0
            rows.append((doc_id, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest() if some else None, signature(s) if some else None))
        yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "set_key", "sig"]).astype({"doc_id": "Int64"})


def _pairs_of(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Candidate pairs among sorted rows, with the length of their common prefix."""
    n = len(ids)
    same = keys[1:] == keys[:-1]
    common = np.where(same.all(axis=1), keys.shape[1], same.argmin(axis=1))
    cut = np.full(n, DEPTH + 1, np.int16)  # the least depth at which the run of a row is small
    for d in range(DEPTH, SHALLOW - 1, -1):
        starts = np.flatnonzero(np.concatenate([[True], common < d]))
        sizes = np.diff(np.append(starts, n))
        cut[np.repeat(sizes <= NEAR, sizes)] = d
    out = []
    low = common
    for j in range(1, min(NEAR, n)):
        if j > 1:
            low = np.minimum(low[: n - j], common[j - 1 :])
        ok = low >= SHALLOW
        if j > 1:
            ok &= low >= cut[: n - j]
        i = np.flatnonzero(ok)
        out.append((ids[i], ids[i + j], low[i]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True)) if out else (ids[:0], ids[:0], ids[:0])


def _neighbours(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = None
    for b in batches:
        if held is not None:
            b = pd.concat([held, b], ignore_index=True)
        for _, g in b.groupby("tree", sort=False):
            keys = np.frombuffer(b"".join(g["key"]), ">u2").reshape(len(g), DEPTH)
            x, y, common = _pairs_of(keys, g["id"].to_numpy(np.int64))
            yield pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y), "common": common.astype(np.int32)})
        held = b.tail(NEAR)


def candidates(reps: DataFrame) -> DataFrame:
    """(a, b, common): candidate pairs of representatives (id, sig)."""
    orders = reps.select("id", F.concat("sig", "sig").alias("twice"), F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    rows = orders.select("tree", F.substring("twice", F.col("tree") * 2 * STRIDE + 1, F.lit(2 * DEPTH)).alias("key"), "id")
    pairs = rows.repartitionByRange("tree", "key", "id").sortWithinPartitions("tree", "key", "id") \
        .mapInPandas(tidy(_neighbours), "a long, b long, common int")
    return pairs.where("a <> b").groupBy("a", "b").agg(F.max("common").alias("common"))


def ruled_out(percent: int) -> float:
    """Share of agreeing values six standard deviations below the similarity."""
    p = percent / 100
    return p - 6 * (p * (1 - p) / HASHES) ** 0.5


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets reach the similarity."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(a) + len(b) - both)


def _signatures(sigs: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), ">u2").reshape(len(sigs), HASHES)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts' full sets reach the similarity."""
    def linked(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([similar(shingles(s), shingles(t), percent) for s, t in zip(x, y, strict=True)], dtype=bool)

    a, b = (texts.select(F.col("doc_id").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")
    return pairs.select("a", "b").join(a, "a").join(b, "b").where(F.pandas_udf(linked, "boolean")("text_a", "text_b")).select("a", "b")


def _regions(reps: DataFrame) -> DataFrame:
    """(tree, region, id): the shallow region of each order that a row is in."""
    orders = reps.select("id", F.concat("sig", "sig").alias("twice"), F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    return orders.select("tree", F.substring("twice", F.col("tree") * 2 * STRIDE + 1, F.lit(2 * SHALLOW)).alias("region"), "id")


def _ask(members: pd.DataFrame, askers: pd.DataFrame, percent: int) -> pd.DataFrame:
    """One link from each asker into a block of members, where there is one.

    An index from shingle to members counts all intersections of an asker at once.
    """
    out = []
    if len(members) and len(askers):
        sets = [shingles(t) for t in members["text"]]
        sizes, ids = np.array([len(x) for x in sets]), members["id"].to_numpy()
        values, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(values, kind="stable")
        values, owner = values[order], owner[order]
        for u, text in zip(askers["id"], askers["text"], strict=True):
            own = shingles(text)
            lo, hi = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            n = hi - lo
            at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(sets))
            hit = np.flatnonzero((both > 0) & (100 * both >= percent * (sizes + len(own) - both)))
            if len(hit):
                out.append((u, ids[hit[0]]))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _blocks(n_shingles) -> F.Column:
    return F.ceil(n_shingles / BLOCK_SHINGLES).cast("int")


def links_into(groups: DataFrame, asked: DataFrame, reps: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links between askers and components, tried against every member.

    ``groups``: (id, component); ``asked``: (id, component) to try. Both sides
    come in blocks of about ``BLOCK_SHINGLES``, so that no task holds a whole group.
    """
    size = reps.select("id", "n_shingles")
    total = lambda d, name: d.join(size, "id").groupBy("component").agg(F.sum("n_shingles").alias(name))
    sizes = total(groups, "n").join(total(asked, "m"), "component")
    text = texts.select(F.col("doc_id").alias("id"), "text").dropDuplicates(["id"])
    every = lambda n: F.explode(F.sequence(F.lit(0), _blocks(F.col(n)) - 1))
    own = lambda n: F.pmod(F.xxhash64("id"), _blocks(F.col(n))).cast("int")
    members = groups.join(sizes, "component").select("component", "id", own("n").alias("x"), every("m").alias("y")).join(text, "id")
    askers = asked.join(sizes, "component").select("component", "id", own("m").alias("y"), every("n").alias("x")).join(text, "id")
    key = ["component", "x", "y"]
    # Both sides come from the same tables: new names keep them apart.
    members, askers = (d.select(*[F.col(c).alias(c) for c in [*key, "id", "text"]]) for d in (members, askers))
    ask = lambda m, a: _ask(m, a, percent)
    return members.groupBy(*key).cogroup(askers.groupBy(*key)).applyInPandas(ask, "a long, b long")


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n = np.zeros(BUCKETS, np.int64)
    for b in batches:
        for text in b["text"]:
            np.add.at(n, (shingles(text) & np.uint64(BUCKETS - 1)).astype(np.int64), 1)
    at = np.flatnonzero(n)
    yield pd.DataFrame({"bucket": at, "n": n[at]})


def _short_lists(percent: int):
    """Pairs of rows of one list that sizes and signatures don't rule out."""
    least = ruled_out(percent)

    def of(g: pd.DataFrame) -> pd.DataFrame:
        key, ids, n, sig = g["list"].to_numpy(), g["id"].to_numpy(), g["n"].to_numpy(), _signatures(g["sig"])
        out = []
        for j in range(1, len(g)):
            i = np.flatnonzero(key[:-j] == key[j:])
            if not len(i):
                break
            i = i[100 * np.minimum(n[i], n[i + j]) >= percent * np.maximum(n[i], n[i + j])]
            i = i[(sig[i] == sig[i + j]).mean(axis=1) >= least]
            out.append(np.stack([np.minimum(ids[i], ids[i + j]), np.maximum(ids[i], ids[i + j])], axis=1))
        return pd.DataFrame(np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64), columns=["a", "b"])

    def pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for b in batches:
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            whole = b["list"].to_numpy() != b["list"].iloc[-1]  # the last list may go on; it is short
            if whole.any():
                yield of(b[whole])
            held = b[~whole]
        if held is not None:
            yield of(held)

    return pairs


def _long_list(percent: int):
    """Links that join up what is similar among the rows of one or two blocks."""
    least = ruled_out(percent)

    def links(g: pd.DataFrame) -> pd.DataFrame:
        g = g.drop_duplicates("id", ignore_index=True)
        ids, own, sig = g["id"].to_numpy(np.int64), g["own"].to_numpy(), _signatures(g["sig"])
        sets = [shingles(t) for t in g["text"]]
        n, root, out = np.array([len(x) for x in sets]), np.arange(len(g)), []
        two = own.min() != own.max()
        for i in range(len(g)):
            may = np.flatnonzero((100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & ((own != own[i]) if two else True))
            may = may[may > i]
            may = may[(sig[may] == sig[i]).mean(axis=1) >= least]
            for j in may:
                if root[i] != root[j] and similar(sets[i], sets[j], percent):
                    out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                    root[root == root[j]] = root[i]
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    return links


def alike(texts: DataFrame, reps: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, links): pairs (a, b) of texts (doc_id, text) of which the
    similarity may be reached, to be confirmed, and confirmed links. Together
    they join up every two texts that reach it.

    With all sets in one order of shingles, rare ones first, two sets that
    reach the similarity share one of the first ``n - ceil(n * percent / 100) + 1``
    of each. Any order is exact; counts by bucket come close to rare first.
    """
    counts = np.zeros(BUCKETS, np.int64)
    seen = texts.mapInPandas(tidy(_counted), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # BUCKETS rows at most
    counts[seen["bucket"].to_numpy(np.int64)] = seen["n"].to_numpy(np.int64)

    def prefixes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for doc_id, text in zip(b["doc_id"], b["text"], strict=True):
                s = shingles(text)
                first = np.lexsort((s, counts[(s & np.uint64(BUCKETS - 1)).astype(np.int64)]))[: len(s) + (-len(s) * percent) // 100 + 1]
                yield pd.DataFrame({"list": s[first].view(np.int64), "id": np.int64(doc_id), "n": np.int64(len(s))})

    held = written(texts.mapInPandas(tidy(prefixes), "list long, id long, n long"), "neardup-prefixes")
    # A list is known by its rows: shingles of one template have the same list, and one of them will do.
    digest = [F.bit_xor(F.xxhash64("id")).alias("x"), F.sum(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 40))).alias("y")]
    lists = held.groupBy("list").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("all"), *digest).where("rows > 1")
    once = lists.groupBy("rows", "all", "x", "y").agg(F.min("list").alias("list")).select("list", "rows", "all")
    rows = written(held.join(once, "list"), "neardup-lists")
    sig = reps.select("id", "sig")
    short = rows.where(F.col("rows") <= SHORT_LIST).select("list", "id", "n").join(sig, "id")
    pairs = short.repartition("list").sortWithinPartitions("list").mapInPandas(tidy(_short_lists(percent)), "a long, b long").distinct()

    text = texts.select(F.col("doc_id").alias("id"), "text").dropDuplicates(["id"])
    blocks = _blocks(F.col("all"))
    other = rows.where(F.col("rows") > SHORT_LIST).select(
        "list", "id", F.pmod(F.xxhash64("id"), blocks).cast("int").alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    both = other.select("list", "id", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")).join(sig, "id").join(text, "id")
    links = both.groupBy("list", "lo", "hi").applyInPandas(_long_list(percent), "a long, b long").distinct()
    return pairs, links


def _may(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs that the signatures don't rule out."""
    least = ruled_out(percent)

    def may_link(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series((_signatures(x) == _signatures(y)).mean(axis=1) >= least) if len(x) else pd.Series([], dtype=bool)

    sig = lambda k: reps.select(F.col("id").alias(k), F.col("sig").alias(f"sig_{k}"))
    both = pairs.select("a", "b").join(sig("a"), "a").join(sig("b"), "b")
    return both.where(F.pandas_udf(may_link, "boolean")("sig_a", "sig_b")).select("a", "b")


def _nearest(pairs: DataFrame) -> DataFrame:
    """The pair of the longest common prefix of each row."""
    ends = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "common"))
    best = ends.groupBy("a").agg(F.max(F.struct("common", (-F.col("b")).alias("last"))).alias("best"))
    return best.select(F.least("a", -F.col("best.last")).alias("x"), F.greatest("a", -F.col("best.last")).alias("b")) \
        .select(F.col("x").alias("a"), "b").distinct()


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs between different components."""
    of = lambda name, k: found.select(F.col("id").alias(k), F.col("component").alias(name))
    both = pairs.select("a", "b").join(of("of_a", "a"), "a", "left").join(of("of_b", "b"), "b", "left")
    return both.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def _asked(deep: DataFrame, found: DataFrame) -> DataFrame:
    """(id, component): rows of deep regions and the groups of other rows there;
    of two groups, the one with the larger id asks."""
    rows = deep.join(found, "id", "left")
    here = rows.where("component is not null").select("tree", "region", F.col("component").alias("group")).distinct()
    met = rows.join(here, ["tree", "region"]).where("component is null or component > group")
    return met.select("id", F.col("group").alias("component")).distinct()


class _Links:
    """The components that the confirmed links so far give."""

    def __init__(self, links: DataFrame):
        self.found = written(components(written(links, "neardup-links")), "neardup-components")

    def add(self, links: DataFrame) -> bool:
        """Join components by new links; whether there were any."""
        new = written(links, "neardup-links")
        if new.isEmpty():
            return False
        of = lambda name, k: self.found.select(F.col("id").alias(k), F.col("component").alias(name))
        between = new.join(of("of_a", "a"), "a", "left").join(of("of_b", "b"), "b", "left") \
            .select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
        merged = components(written(between, "neardup-links"))
        to = merged.select(F.col("id").alias("component"), F.col("component").alias("new"))
        old = self.found.join(to, "component", "left").select("id", F.coalesce("new", "component").alias("component"))
        self.found = written(old.unionByName(merged.join(self.found, "id", "left_anti")), "neardup-components")
        return True


def link(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``
    (doc_id long, text string; other columns are not read); two texts are
    linked from a similarity of ``percent`` hundredths on."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    described = written(docs.mapInPandas(tidy(_describe), "doc_id long, n_shingles long, set_key binary, sig binary"), "neardup-sets")
    known = described.where("set_key is not null and doc_id is not null")
    by_set = known.groupBy("set_key").agg(F.min("doc_id").alias("id"))
    reps = written(known.join(by_set, "set_key").where("doc_id = id").select("id", "n_shingles", "sig").distinct(), "neardup-reps")

    # Rows that share a doc_id are one document, whatever their sets.
    sets = known.select("set_key", "doc_id").distinct().join(by_set, "set_key").select("doc_id", "id")
    several = sets.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a <> z")
    same_doc = several.join(sets, "doc_id").select("a", F.col("id").alias("b")).where("a <> b")

    pairs = written(candidates(reps), "neardup-pairs")
    regions = _regions(reps)
    large = regions.groupBy("tree", "region").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > NEAR)
    deep = written(regions.join(large, ["tree", "region"], "left_semi"), "neardup-deep")
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).unionByName(deep.select(F.col("id").alias("doc_id")))
    ids = written(ids.distinct(), "neardup-ids")
    few = ids.count() <= BROADCAST_IDS
    texts = written(docs.join(F.broadcast(ids) if few else ids, "doc_id", "left_semi"), "neardup-texts")

    first = _nearest(pairs)
    so_far = _Links(confirmed(first, texts, percent).unionByName(same_doc))
    so_far.add(confirmed(_may(_apart(pairs, so_far.found).join(first, ["a", "b"], "left_anti"), reps, percent), texts, percent))
    # All pairs of the rows single now are tried below, so rows that join a group first need not be asked again.
    alone = written(deep.select("id").distinct().join(so_far.found, "id", "left_anti"), "neardup-alone")
    asked = written(_asked(deep, so_far.found), "neardup-asked")
    if not asked.isEmpty():
        so_far.add(links_into(so_far.found.join(asked.select("component").distinct(), "component", "left_semi"), asked, reps, texts, percent))
    if not alone.isEmpty():
        among, links = alike(texts.join(alone.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi"), reps, percent)
        among = written(_apart(among.join(pairs, ["a", "b"], "left_anti"), so_far.found), "neardup-pairs")
        so_far.add(confirmed(among, texts, percent).unionByName(links))

    component = sets.join(so_far.found, "id", "left").groupBy("doc_id").agg(F.min(F.coalesce("component", "id")).alias("component_id"))
    own = F.col("d.doc_id")
    return described.alias("d").join(component.alias("c"), own == F.col("c.doc_id"), "left").select(
        own, F.col("d.n_shingles"), F.coalesce("c.component_id", own).alias("component_id"),
        F.coalesce(own == F.coalesce("c.component_id", own), F.lit(True)).alias("kept"),
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near copies of every document."""
    return link(documents(spark, sf_dir))


#: The same by comparing every two documents that share a shingle.
ORACLE = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT x, y FROM shared JOIN n AS p ON p.doc_id = x JOIN n AS q ON q.doc_id = y
  WHERE 100 * n_both >= 85 * (p.n + q.n - n_both)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
reach(doc_id, root) AS (
  SELECT DISTINCT x, x FROM e UNION SELECT e.y, r.root FROM reach r JOIN e ON e.x = r.doc_id),
c AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       coalesce(c.component_id, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
"""
