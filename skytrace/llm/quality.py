"""Quality rules as weak supervision (DataFrame functions only).

Each rule looks at counts of a document and votes good (1), bad (0) or
abstains (null). No rule decides alone: expectation-maximisation over the
votes of all documents estimates how often each rule is right on good and on
bad documents, and every document gets its posterior probability of being
good.

The votes of the whole corpus reduce to at most ``3 ** len(RULES)`` patterns
with their counts (one aggregation with map-side combine), and the EM steps
run over that table. Its size depends on the number of rules alone, so the
driver may hold it. The posterior is then an expression over the votes: no
join, no second shuffle.

Defined results: a null or empty text has no words, fails the base rules and
is not kept; documents of an empty table give an empty result; repeated rows
are judged alike; very long texts are counted whole (n log n in their words).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, SPACE_CLASS, documents, let, words, written

#: A word of letters with at most the usual punctuation around it.
PLAIN_WORD = r"(?<![^\x20\x09-\x0D])[\"'(\[]*\p{L}[\p{L}\p{M}'’-]*+[.,;:!?…\"')\]]*+(?![^\x20\x09-\x0D])"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Accuracy at the start and its bounds. On good documents a rule stays right
#: more often than not; on bad ones it may miss most faults, but a bad vote
#: stays likelier there by ``EDGE`` than on good ones. This fixes what "good" means.
START_ACCURACY, MIN_ACCURACY, MAX_ACCURACY, EDGE = 0.8, 0.55, 0.998, 0.02
MIN_PRIOR, MAX_PRIOR = 0.05, 0.98
EM_STEPS = 100
EM_TOLERANCE = 1e-9
KEEP_AT = 0.5


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the text.

    Most texts repeat no window: their digests are all distinct. In the
    others, few repeated digests are looked up directly; many are found by
    sorting the windows with their position, so that the cost stays at
    n log n for very long texts. Each word that a repeated window covers
    counts once.
    """
    n = F.size(w) - 2

    def by_sort(h: Column) -> Column:
        windows = F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        marked = lambda s: F.filter(s, lambda x, i: (x.h == F.get(s, i - 1).h) | (x.h == F.get(s, i + 1).h))
        return let(F.sort_array(windows), lambda s: F.sort_array(F.transform(marked(s), lambda x: x.i)))

    def by_lookup(h: Column, again: Column) -> Column:
        return F.filter(F.transform(h, lambda x, i: F.when(F.array_contains(again, x), i)), lambda i: i.isNotNull())

    def covered(p: Column) -> Column:  # positions in order: each window adds the words after the one before
        return F.size(p) * 3 - F.aggregate(
            F.sequence(F.lit(1), F.size(p) - 1), F.lit(0),
            lambda acc, k: acc + F.greatest(F.lit(0), F.lit(3) - (F.get(p, k) - F.get(p, k - 1))),
        )

    def repeated(h: Column) -> Column:
        again = let(F.sort_array(h), lambda s: F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i + 1))))
        positions = let(again, lambda a: F.when(F.size(a) <= 16, by_lookup(h, a)).otherwise(by_sort(h)))
        return let(positions, covered)

    digests = F.slice(F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))), F.lit(1), n)
    count = let(digests, lambda h: F.when(F.size(F.array_distinct(h)) == n, 0).otherwise(repeated(h)))
    return F.when(n < 2, F.lit(0)).otherwise(count).cast("long")


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but for the text, and counts as ``q_*``."""
    t = F.coalesce(F.col(text), F.lit(""))
    left = lambda drop: F.length(F.regexp_replace(t, drop, "")).cast("long")
    line_stats = let(
        F.filter(F.split(t, "\n"), lambda x: F.trim(x, F.lit(SPACE)) != ""),
        lambda ls: F.struct(
            F.size(ls).cast("long").alias("n_lines"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        ),
    )
    word_stats = let(
        words(F.col(text)),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words")),
    )
    out = docs.withColumn("q_w", word_stats).withColumn("q_l", line_stats)
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns if c != text and not c.startswith("q_")],
        F.col("q_w.n_words").alias("q_words"),
        left(SPACE_CLASS + "+").alias("q_word_chars"),
        left(r"[^#*$%&|<>]+").alias("q_symbols"),
        F.col("q_l.n_lines").alias("q_lines"),
        F.col("q_l.n_dup_lines").alias("q_dup_lines"),
        F.col("q_w.n_repeat_words").alias("q_repeat_words"),
        F.regexp_count(t, F.lit(r"[.!?…][\"')\]]?(?:[\x20\x09-\x0D]|$)")).cast("long").alias("q_stops"),
        left(r"[^0-9]+").alias("q_digits"),
        left(r"[^\p{L}\p{M}]+").alias("q_letters"),
        F.regexp_count(t, F.lit(PLAIN_WORD)).cast("long").alias("q_plain_words"),
    )


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, 0).when(good, 1)


def rules() -> dict[str, Column]:
    """Votes over the columns of :func:`measures`: 1 good, 0 bad, null abstains."""
    n = F.greatest(F.col("q_words"), F.lit(1))
    per_word = lambda c: F.col(c) / n
    mean_len = F.col("q_word_chars") / n
    dup = F.col("q_dup_lines") / F.greatest(F.col("q_lines"), F.lit(1))
    return {
        "length": _vote(F.col("q_words") >= 100, F.col("q_words") < MIN_WORDS),
        "word_length": _vote((mean_len >= 3) & (mean_len <= 9), (mean_len < 2) | (mean_len > 14)),
        "symbols": _vote(per_word("q_symbols") <= 0.02, per_word("q_symbols") > 0.1),
        "dup_lines": _vote((F.col("q_lines") >= 2) & (dup <= 0.05), dup > 0.3),
        "repeats": _vote((per_word("q_repeat_words") <= 0.2) & (F.col("q_words") >= MIN_WORDS),
                         per_word("q_repeat_words") > MAX_REPEAT_PERCENT / 100),
        "sentences": _vote((per_word("q_stops") >= 0.02) & (per_word("q_stops") <= 0.3),
                           (per_word("q_stops") < 0.004) | (per_word("q_stops") > 0.6)),
        "letters": _vote(F.col("q_letters") >= 0.85 * F.col("q_word_chars"), F.col("q_letters") < 0.7 * F.col("q_word_chars")),
        "plain_words": _vote(per_word("q_plain_words") >= 0.85, per_word("q_plain_words") < 0.6),
        "digits": _vote(F.col("q_digits") <= 0.05 * F.col("q_word_chars"), F.col("q_digits") > 0.3 * F.col("q_word_chars")),
    }


def estimate(patterns: list[tuple[tuple[int | None, ...], int]], n_rules: int) -> tuple[float, list[tuple[float, float]]]:
    """EM over vote patterns with counts: the share of good documents and, per
    rule, how often its vote is right on good and on bad documents."""
    prior, acc = 0.8, [(START_ACCURACY, START_ACCURACY)] * n_rules
    total = sum(c for _, c in patterns)
    if not total:
        return prior, acc
    clamp = lambda x, lo, hi: min(max(x, lo), hi)
    for _ in range(EM_STEPS):
        good = 0.0
        sums = [[0.0, 0.0, 0.0, 0.0] for _ in range(n_rules)]  # right and all votes on good, then on bad
        for votes, c in patterns:
            p = posterior(votes, prior, acc)
            good += c * p
            for s, v in zip(sums, votes, strict=True):
                if v is not None:
                    s[0] += c * p * v
                    s[1] += c * p
                    s[2] += c * (1 - p) * (1 - v)
                    s[3] += c * (1 - p)
        new_prior = clamp(good / total, MIN_PRIOR, MAX_PRIOR)
        # One pseudo-vote at the start value keeps unused rules defined.
        new = []
        for s in sums:
            on_good = clamp((s[0] + START_ACCURACY) / (s[1] + 1), MIN_ACCURACY, MAX_ACCURACY)
            new.append((on_good, clamp((s[2] + START_ACCURACY) / (s[3] + 1), 1 - on_good + EDGE, MAX_ACCURACY)))
        moved = max([abs(new_prior - prior), *(abs(x - y) for a, b in zip(acc, new, strict=True) for x, y in zip(a, b, strict=True))])
        prior, acc = new_prior, new
        if moved < EM_TOLERANCE:
            break
    return prior, acc


def _weights(a: tuple[float, float]) -> tuple[float, float]:
    """Log odds that a good vote and a bad vote add."""
    good, bad = a
    return math.log(good / (1 - bad)), math.log((1 - good) / bad)


def posterior(votes, prior: float, acc) -> float:
    z = math.log(prior / (1 - prior))
    for v, a in zip(votes, acc, strict=True):
        if v is not None:
            z += _weights(a)[0 if v else 1]
    return 1 / (1 + math.exp(-z))


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but for the text, counts (``q_*``), and
    ``q_good``, the posterior probability of good quality given all votes.

    The counts, a few numbers a document, are written once: the estimate and
    the verdict both read them. Columns of ``docs`` named ``q_*`` give way.
    """
    counts = written(measures(docs, text), "quality")
    votes = rules()
    patterns = counts.select(*[v.alias(k) for k, v in votes.items()]).groupBy(*votes).count().collect()
    prior, acc = estimate([(tuple(r[:-1]), r[-1]) for r in sorted(patterns, key=str)], len(votes))
    z = F.lit(math.log(prior / (1 - prior)))
    for v, a in zip(votes.values(), acc, strict=True):
        up, down = _weights(a)
        z = z + F.when(v == 1, up).when(v == 0, down).otherwise(0.0)
    return counts.withColumn("q_good", 1 / (1 + F.exp(-z)))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the weak-supervision verdict of every document."""
    j = judge(documents(spark, sf_dir).select("doc_id", "text"))
    failed = (F.col("q_words") < MIN_WORDS) | (100 * F.col("q_repeat_words") > MAX_REPEAT_PERCENT * F.col("q_words"))
    return j.select(
        "doc_id",
        F.col("q_words").alias("n_words"),
        F.col("q_word_chars").alias("word_chars"),
        F.col("q_symbols").alias("n_symbols"),
        F.col("q_dup_lines").alias("n_dup_lines"),
        F.col("q_repeat_words").alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & (F.col("q_good") >= KEEP_AT)).alias("kept"),
        F.col("q_good").alias("p_good"),
    )
