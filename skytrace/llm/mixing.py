"""Mix sources to target weights by entropy balancing.

Each document gets a rate between 0 and ``MAX_RATE``, the number of times the
mix takes it. Of all rates that meet the token target of its source, the mix
uses those closest in (bounded) entropy to taking every document once. The
convex dual has one unknown per source, ``tilt``; the rate of a document of
``x`` mean sizes is ``MAX_RATE / (1 + exp(-tilt * x))``. Newton steps solve
it: each aggregates gradient and curvature of all sources at once, over the
table of distinct (source, size) with counts, and a bracket keeps the steps
safe. The state, one row a source, stays a DataFrame and is checkpointed.

Rates are then rounded to whole copies by carrying the rounding error from
the longest document to the shortest, within buckets of bounded size, so that
a source of any size is spread over tasks and misses its target by little
more than the sizes of its shortest documents.

Defined results: a null text has size 0 and is taken 0 words whatever its
copies; null sources form one source, ranked last; rows with the same doc_id,
source and size are one unit, whose copies are rounded together and dealt to
its rows as evenly as they go (so rows without doc_id meet their target as
well); an empty table gives an empty result; the same rows give the same result
in every run.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.sequence import sequence_scan
from ..session import cut_lineage
from .common import SPACE, SPACE_CLASS, documents, written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_RATE = 2.0
#: Documents in a rounding bucket, about.
BUCKET = 2_000
NEWTON_STEPS = 60
#: Units (some 100 bytes each) that may be broadcast to the documents; more are
#: joined by shuffling the documents.
BROADCAST_UNITS = 400_000
TOLERANCE = 1e-10


def size_of(text):
    """Words of a text: runs of white space between them, and one."""
    t = F.trim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(t == "", 0).otherwise(F.regexp_count(t, F.lit(SPACE_CLASS + "+")) + 1).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MAX_RATE) -> DataFrame:
    """(source, n, source_size) with ``target``: ``share`` of all sizes dealt by
    weight, no source above ``most`` times its size, the excess dealt again.

    One row a source: the windows below run over the sources, not the rows.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    all_rows = W.orderBy("ratio", F.col("source").asc_nulls_last())
    deal = F.array(*[F.lit(float(w)) for w in weights])
    s = sources.withColumn("weight", F.get(deal, (F.row_number().over(by_name) - 1) % len(weights)))
    s = s.withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    before, after = all_rows.rowsBetween(W.unboundedPreceding, -1), all_rows.rowsBetween(0, W.unboundedFollowing)
    whole = all_rows.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumn(
        "level",
        (share * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after),
    ).withColumn("full", F.col("ratio") <= F.col("level") * (1 + 1e-12))
    level = F.min(F.when(~F.col("full"), F.struct("ratio", "level"))).over(whole)
    s = s.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * level.level))
    return s.select("source", "n", "source_size", "target")


def _rate(x):
    return MAX_RATE / (1 + F.exp(-F.col("tilt") * x))


def solve(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` with ``tilt``. ``sizes``: (source, size, n)."""
    mean = F.greatest(F.col("source_size") / F.col("n"), F.lit(1e-9))
    open_ = (F.col("target") > 0) & (F.col("target") < MAX_RATE * F.col("source_size") * (1 - TOLERANCE))
    state = cut_lineage(wanted.select(
        "source", "source_size", "target", F.col("n").alias("source_n"), mean.alias("mean"),
        F.when(open_, 0.0).when(F.col("target") > 0, float("inf")).otherwise(float("-inf")).alias("tilt"),
        F.lit(-1e9).alias("lo"), F.lit(1e9).alias("hi"), (~open_).alias("done"),
    ))
    sizes = written(sizes, "mix-sizes")
    for _ in range(NEWTON_STEPS):
        if state.where(~F.col("done")).isEmpty():
            break
        x = F.col("size") / F.col("mean")
        r = _rate(x)
        sums = (
            sizes.join(state.where(~F.col("done")), sizes.source.eqNullSafe(state.source)).groupBy(state.source.alias("of"))
            .agg(F.sum(F.col("sizes_n") * r * F.col("size")).alias("got"),
                 F.sum(F.col("sizes_n") * r * (1 - r / MAX_RATE) * x * F.col("size")).alias("slope"),
                 F.lit(1).alias("hit"))
        )
        gap = F.col("got") - F.col("target")
        lo = F.when(gap < 0, F.col("tilt")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("tilt")).otherwise(F.col("hi"))
        step = F.col("tilt") - gap / F.greatest(F.col("slope"), F.lit(1e-300))
        # Outside the bracket: halve it, or double the tilt while one side is open.
        away = F.when(gap < 0, F.when(F.col("new_hi") < 1e9, (F.col("new_lo") + F.col("new_hi")) / 2).otherwise(2 * F.abs("tilt") + 1)) \
            .otherwise(F.when(F.col("new_lo") > -1e9, (F.col("new_lo") + F.col("new_hi")) / 2).otherwise(-2 * F.abs("tilt") - 1))
        inside = (F.col("step") > F.col("new_lo")) & (F.col("step") < F.col("new_hi")) & (F.abs(F.col("step") - F.col("tilt")) <= 2 + F.abs("tilt"))
        s = state.join(sums, state.source.eqNullSafe(sums.of), "left").withColumn("new_lo", lo).withColumn("new_hi", hi).withColumn("step", step)
        near = F.col("done") | (F.abs(gap) <= TOLERANCE * F.col("target"))
        state = cut_lineage(s.select(
            "source", "source_size", "target", "source_n", "mean",
            F.when(near, F.col("tilt")).when(inside, F.col("step")).otherwise(away).alias("tilt"),
            F.when(near, F.col("lo")).otherwise(F.col("new_lo")).alias("lo"),
            F.when(near, F.col("hi")).otherwise(F.col("new_hi")).alias("hi"),
            F.coalesce(near, F.lit(True)).alias("done"),
        ))
    wide = F.col("hi") - F.col("lo") > 1e-6 * (1 + F.abs("tilt"))  # else the bracket has closed as far as doubles go
    if not state.where(~F.col("done") & wide).isEmpty():
        raise ArithmeticError(f"targets not met after {NEWTON_STEPS} steps")
    # Sums of floats differ in their last bits between runs; what follows must not.
    return state.withColumn("tilt", F.round("tilt", 9))


def _round(g: pd.DataFrame) -> pd.DataFrame:
    """Copies in one bucket, the rounding error carried from long to short.
    The copies of all rows of a unit are rounded together."""
    g = g.sort_values(["size", "doc_id"], ascending=[False, True], kind="stable")
    size, rows = g["size"].to_numpy(float), g["m"].to_numpy(np.int64)
    wanted = g["rate"].to_numpy(float) * rows
    out, carry = np.zeros(len(g), np.int64), 0.0
    for i in range(len(g)):
        c = wanted[i] + (carry / size[i] if size[i] else 0.0)
        out[i] = min(max(int(np.floor(c + 0.5)), 0), int(MAX_RATE) * int(rows[i]))
        carry += (wanted[i] - out[i]) * size[i]
    g = g.assign(copies=out // rows, more=out % rows)
    return g[["doc_id", "source", "size", "m", "source_size", "target", "rate", "copies", "more"]]


def mix(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """Copies of each unit (doc_id, source, size) of a table of these columns.

    Returns doc_id, source, size, m (rows of the unit), source_size, target,
    rate, copies (of each row) and more (rows of the unit that have one more).
    """
    units = written(sized.groupBy("source", "doc_id", "size").agg(F.count(F.lit(1)).alias("m")), "mix-units")
    sizes = units.groupBy("source", "size").agg(F.sum("m").alias("sizes_n"))
    wanted = targets(
        units.groupBy("source").agg(F.sum("m").alias("n"), F.sum(F.col("size") * F.col("m")).alias("source_size")), weights, share)
    state = solve(sizes, wanted)
    u = units.alias("u").join(state.alias("s"), F.col("u.source").eqNullSafe(F.col("s.source")))
    u = u.select("u.doc_id", "u.source", "u.size", "u.m", "s.source_size", "s.target", "s.source_n",
                 F.when(F.col("s.tilt") == float("inf"), MAX_RATE).when(F.col("s.tilt") == float("-inf"), 0.0)
                 .otherwise(_rate(F.col("u.size") / F.col("s.mean"))).alias("rate"))
    bucket = F.pmod(F.xxhash64("doc_id", "size"), F.ceil(F.col("source_n") / BUCKET))
    schema = "doc_id long, source string, size long, m long, source_size long, target double, rate double, copies long, more long"
    return u.withColumn("bucket", bucket).groupBy("source", "bucket").applyInPandas(_round, schema)


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The documents of the mix, each row as often as it is taken. Where only
    some rows of a unit have one copy more, those first by their texts' digests."""
    key = [F.col("doc_id"), F.col("source"), size_of(F.col("text")).alias("size")]
    copies = written(mix(docs.select(*key), **how).where("copies > 0 or more > 0").select("doc_id", "source", "size", "copies", "more"), "mix-copies")
    copies = (F.broadcast(copies) if copies.count() <= BROADCAST_UNITS else copies).alias("c")
    d = docs.withColumn("__size", size_of(F.col("text"))).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.__size") == F.col("c.size"))
    own = [F.col(f"d.`{c}`") for c in docs.columns]
    each = F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))
    times = lambda t: t.where("__copies > 0").withColumn("__time", each).select(*[F.col(f"`{c}`") for c in docs.columns])
    even = times(d.join(copies.where("c.more = 0"), same).select(*own, F.col("c.copies").alias("__copies")))
    if copies.where("more > 0").isEmpty():
        return even
    # Rows of a unit are numbered by a scan that splits units of very many rows.
    unit = F.to_json(F.struct(F.col("d.doc_id").alias("a"), F.col("d.source").alias("b"), F.col("d.__size").alias("c")))
    some = d.join(copies.where("c.more > 0"), same).select(
        *own, F.col("c.copies").alias("__copies"), F.col("c.more").alias("__more"), unit.alias("__unit"), F.xxhash64("d.text").alias("__digest"))
    dealt = sequence_scan(some, ["__unit"], ["__digest"], row_number="__row").withColumn(
        "__copies", F.col("__copies") + (F.col("__row") <= F.col("__more")).cast("long"))
    return even.unionByName(times(dealt))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    d = documents(spark, sf_dir)
    m = mix(d.select("doc_id", "source", size_of(F.col("text")).alias("size")))
    m = m.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("m").cast("int"))))
    m = m.withColumn("copies", F.col("copies") + (F.col("row") <= F.col("more")).cast("long"))
    return m.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "rate", "copies")
