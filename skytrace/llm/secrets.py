"""Secret scan (DataFrame functions only): patterns plus sliding-window entropy.

Base patterns (assignments, access keys, long hex runs) give the base spans.
On what they leave, candidate strings (long runs of key-like characters with
letters and digits) are scanned by a sliding window. The window keeps counts
of its characters; a step removes one character, adds one, and updates the
sum of ``c * log2(c)`` from the counts that changed, which gives the Shannon
entropy without a recount. A candidate whose highest window reaches the
threshold of its character class is a span, unless the allow list knows it.

Every step works within a row: no shuffle, and the work grows with the text.
Start positions are sums over pieces, taken in chunks, so that a text with
very many matches stays far from quadratic cost.

Defined results: a null text is an empty text and has no spans; positions are
code points, ends exclusive; repeated rows give the same spans; an empty
table gives an empty result. Control character U+0001 serves as a marker;
where a text holds it, it is read as U+0002, which no pattern matches either.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, let

#: Base kinds in the order in which they are listed; pattern, and the group
#: that must have at least so many characters.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {
    "assign": (ASSIGN, 2, 6),
    "access": (r"(AKIA[A-Z0-9]+)", 1, 20),
    "hex": (r"([0-9a-f]{24,})", 1, 24),
}
KINDS = [*BASE, "entropy"]

#: Candidate strings: runs of 20 or more characters with a letter and a digit.
RUN = r"A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![{RUN}])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])([{RUN}]{{20,}}+)"
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-"
WINDOW = 20
#: Classes of candidates by the characters they are made of, the first that
#: fits, and the least entropy, in bits, of a window. Of random strings of 20
#: characters of the class at most some 2 in 100 stay below it (measured on
#: 3,000 strings each); longer ones have more windows and miss less.
CLASSES = (
    ("hex digits of one case", r"^([0-9A-F]+|[0-9a-f]+)$", 2.9),
    ("base 32 of one case", r"^([A-Z2-7]+|[a-z2-7]+)$", 3.4),
    ("letters of one case and digits", r"^([A-Z0-9]+|[a-z0-9]+)$", 3.45),
    ("letters of one case with separators", r"^([A-Z0-9+/_=-]+|[a-z0-9+/_=-]+)$", 3.8),
    ("base 62 or 64", r"^", 3.7),
)
#: A word, a number, or words in one, as parts of paths and names have them.
PART = r"([a-z]+|[A-Z]+|[A-Z][a-z]+|[a-z]{2,}([A-Z][a-z]{2,})+|([A-Z][a-z]{2,})+)?[0-9]{0,4}"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9]{2,6}Z?)?"
#: Strings that look random but are no secrets: UUIDs; paths, dates and names of
#: which every part is a word, number or date; digests named as such.
ALLOW = (
    r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    rf"^/?(({DATE}|{PART}([_=-]+{PART})*)/){{2,}}({DATE}|{PART}([_=-]+{PART})*)$",
    rf"^{DATE}([_/=-]+{PART})*$",
    r"^([A-Za-z]+|[0-9]{1,6})([_/=-]+([A-Za-z]+|[0-9]{1,6}))+$",
    r"^(sha1|sha256|sha384|sha512|md5)[-=]",
)
#: Longer candidates are no names or paths; entropy alone judges them.
ALLOW_LENGTH = 512
MARK, SPARE = "\x01", "\x02"
CHUNK = 128

SPAN = "struct<start:bigint,kind:int,end:bigint>"


def _pieces(text: Column, pattern: str) -> Column:
    """Text cut at the matches: even places lie between matches, odd ones match."""
    return F.split(F.regexp_replace(text, pattern, MARK + "$0" + MARK), MARK)


def _spans(pieces: Column, kind: int, ok) -> Column:
    """Spans of the odd pieces for which ``ok`` holds, by start."""
    none = F.array().cast(f"array<{SPAN}>")

    def chunk(state: Column, first: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            piece = F.get(pieces, i)
            end = s.pos + F.length(piece)
            span = F.struct(s.pos.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
            return F.struct(end.alias("pos"), F.when((i % 2 == 1) & ok(piece), F.concat(s.found, F.array(span))).otherwise(s.found).alias("found"))

        last = F.least(first + CHUNK, F.size(pieces)) - 1
        start = F.struct(state.pos.alias("pos"), none.alias("found"))
        return let(
            F.aggregate(F.sequence(first, last), start, step),
            lambda c: F.struct(c.pos.alias("pos"), F.concat(state.chunks, F.array(c.found)).alias("chunks")),
        )

    start = F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast(f"array<array<{SPAN}>>").alias("chunks"))
    firsts = F.sequence(F.lit(0), F.size(pieces) - 1, F.lit(CHUNK))
    return F.when(F.size(pieces) > 1, F.flatten(F.aggregate(firsts, start, chunk, lambda s: s.chunks))).otherwise(none)


def _masked(pieces: Column, ok) -> Column:
    """The text with matches overwritten, in its length, by what no pattern matches."""
    return F.array_join(F.transform(pieces, lambda p, i: F.when((i % 2 == 1) & ok(p), F.repeat(F.lit(SPARE), F.length(p))).otherwise(p)), "")


def _found(text: Column, pattern: str, kind: int, ok) -> Column:
    """Most texts match nothing: these are read once and not taken apart."""
    none = F.array().cast(f"array<{SPAN}>")
    return F.when(text.rlike(pattern), let(_pieces(text, pattern), lambda ps: _spans(ps, kind, ok))).otherwise(none)


def _mask(pattern: str, ok):
    return lambda t: let(_pieces(t, pattern), lambda ps: _masked(ps, ok))


def _long_enough(pattern: str, group: int, least: int):
    return lambda p: F.length(F.regexp_extract(p, pattern, group)) >= least


def window_entropy(candidate: Column) -> Column:
    """Highest Shannon entropy of a window of a candidate, by incremental counts."""
    terms = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)])
    term = lambda c: F.get(terms, c)
    place = lambda ch: F.position(ch, F.lit(ALPHABET)) - 1

    def scan(at: Column) -> Column:
        def step(s: Column, i: Column) -> Column:
            gone, come = F.coalesce(F.get(at, i - WINDOW), F.lit(-1)), F.get(at, i)

            def moved(x: Column) -> Column:
                has = F.get(s.counts, x.gone)
                less = F.when(x.gone >= 0, term(has - 1) - term(has)).otherwise(0.0)
                held = F.get(s.counts, x.come) - F.when(x.gone == x.come, 1).otherwise(0)
                total = s.total + less + term(held + 1) - term(held)
                counts = F.transform(s.counts, lambda c, k: c + (k == x.come).cast("int") - (k == x.gone).cast("int"))
                bits = F.when(i >= WINDOW - 1, F.greatest(s.best, math.log2(WINDOW) - total / WINDOW)).otherwise(s.best)
                return F.struct(counts.alias("counts"), total.alias("total"), bits.alias("best"))

            return let(F.struct(gone.alias("gone"), come.alias("come")), moved)

        start = F.struct(
            F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"), F.lit(0.0).alias("total"), F.lit(0.0).alias("best"))
        return F.aggregate(F.sequence(F.lit(0), F.size(at) - 1), start, step, lambda s: s.best)

    places = F.transform(F.filter(F.split(candidate, ""), lambda c: c != ""), place)
    return let(places, scan)


def _secret(allow: tuple[str, ...]):
    def ok(p: Column) -> Column:
        known = F.lit(False)
        for rule in allow:
            known = known | p.rlike(rule)
        least = F.lit(CLASSES[-1][2])
        for _, characters, bits in reversed(CLASSES[:-1]):
            least = F.when(p.rlike(characters), bits).otherwise(least)
        return F.when((F.length(p) <= ALLOW_LENGTH) & known, False).otherwise(window_entropy(p) >= least)

    return ok


def scan(docs: DataFrame, text: str = "text", allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """The columns of ``docs`` and ``secrets``, an array of (start, kind, end)
    by start and kind; ``kind`` is a place in ``KINDS``. A column of that name
    in ``docs`` gives way."""
    raw = F.replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), F.lit(MARK), F.lit(SPARE))

    rules = [(pattern, _long_enough(pattern, group, least)) for pattern, group, least in BASE.values()]
    entropy = lambda t: _found(t, CANDIDATE, len(BASE), _secret(allow))

    def masked(t: Column) -> Column:
        for pattern, ok in rules:
            t = let(t, _mask(pattern, ok))
        return t

    def spans(t: Column) -> Column:
        base = F.concat(*[_found(t, pattern, kind, ok) for kind, (pattern, ok) in enumerate(rules)])
        return let(base, lambda b: F.concat(b, F.when(F.size(b) == 0, entropy(t)).otherwise(let(masked(t), entropy))))

    return docs.withColumn("secrets", F.sort_array(let(raw, spans)))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base counts and digest, and all spans."""
    s = scan(documents(spark, sf_dir).select("doc_id", "text")).select("doc_id", "secrets")
    count = lambda k: F.size(F.filter("secrets", lambda x: x.kind == k)).cast("long")
    base = F.filter("secrets", lambda x: x.kind < len(BASE))
    return s.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("secrets")).alias("spans"),
        count(3).alias("n_entropy"),
    )
