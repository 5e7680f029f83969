"""Personal data: exact base patterns plus a semi-Markov CRF.

Base patterns (email, ip, card, phone) give the base spans. Where a text holds
other digits or address marks, its tokens form a region, and a semi-Markov
conditional random field segments it: segments of one token are plain, longer
ones (up to ``LONGEST`` tokens) may be personal data of a kind. Features look
at a whole candidate span (its groups of digits, separators, check sum, the
words before it); dynamic programming over all segmentations of a region
chooses boundaries and kinds jointly. Base spans stand fixed, the CRF only
adds spans between them: numbers without the plus sign, spelt-out addresses,
spaced or bracketed dots.

Training maximises the conditional likelihood (forward-backward) on at most
``SAMPLE`` regions of at most ``SAMPLE_TOKENS`` tokens, taken from the corpus
in digest order. Their base spans are the labels; each also appears rewritten
in forms that the patterns miss, and replaced by numbers of other meaning
(dates, versions, prices), which are plain. The sample bound is all that
reaches the driver. Scanning and decoding cover whole texts, row by row, with
no shuffle.

Defined results: a null text is empty and has no spans; offsets are code
points, ends exclusive; repeated rows get the same spans; a corpus without any
base span trains on generated ones; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, small_batches, written

KINDS = ("email", "ip", "card", "phone")
SAMPLE, SAMPLE_TOKENS = 1500, 80
LONGEST = 18
EPOCHS, RATE, RIDGE = 25, 0.3, 1e-3
#: Characters between triggers of one region, and around it.
GAP, AROUND = 24, 40

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    odd, even = digits[::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _CHAIN.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, at + size
            at += size + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and luhn(d):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind and start."""
    return [(k, *s) for k, find in enumerate((_emails, _ips, _cards, _phones)) for s in find(text)]


# --- regions and their tokens ---------------------------------------------

_AT = r"(?:\s?[\[({<]\s?at\s?[\])}>]\s?|\s?@\s?)"
_DOT = r"(?:\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\sdot\s|\s\.\s|\.)"
_TRIGGER = re.compile(r"[0-9]+|@|[\[({<]\s?(?:at|dot)\s?[\])}>]|\w at \w+ dot \w", re.I)
_TOKEN = re.compile(r"[0-9]+|[^\W\d_]+|\S")
#: A bare "at" counts where the dots are spelt out as well.
_EMAILISH = re.compile(
    rf"[\w%+-]+(?:{_DOT}[\w%+-]+)*{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)*{_DOT}[A-Za-z]{{2,6}}"
    r"|[\w%+-]+(?:\sdot\s[\w%+-]+)*\sat\s[A-Za-z0-9-]+(?:\sdot\s[A-Za-z0-9-]+)*\sdot\s[A-Za-z]{2,6}", re.I)
_AT_MARK = re.compile(rf"{_AT}|\sat\s", re.I)
_DATE = re.compile(r"\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}[-/.]\d{2,4}")
_DECIMAL = re.compile(r"\d{1,3}(?:[,.\x20]\d{3})*(?:[.,]\d{1,2})?")
_CONTEXT = (re.compile(r"\b(?:tel|phone|call|mobile|fax|cell|text)\W*$", re.I), re.compile(r"\b(?:e-?mail|mail|contact|write|address)\W*$", re.I),
            re.compile(r"\b(?:card|visa|credit|debit|account|iban)\W*$", re.I), re.compile(r"\b(?:ip|host|server|from|address)\W*$", re.I))


def regions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, str, bool]]:
    """(offset, string, whether it holds more than base spans) of each region."""
    marks = sorted((a, b) for _, a, b in base)
    out, k = [], 0
    lo = hi = None
    more = False
    for m in _TRIGGER.finditer(text):
        a, b = m.span()
        while k < len(marks) and marks[k][1] <= a:
            k += 1
        inside = k < len(marks) and marks[k][0] <= a
        if lo is not None and a - hi > GAP:
            out.append((lo, hi, more))
            lo = None
        if lo is None:
            lo, hi, more = a, b, False
        hi, more = max(hi, b), more or not inside
    if lo is not None:
        out.append((lo, hi, more))
    wide = []
    for a, b, more in out:
        a, b = max(0, a - AROUND), min(len(text), b + AROUND)
        if wide and a < wide[-1][1]:
            a = wide[-1][1]
        wide.append((a, b, more))
    return [(a, text[a:b], more) for a, b, more in wide]


def features(s: str, a: int, b: int, tokens: int) -> np.ndarray:
    x = s[a:b]
    groups = re.findall(r"[0-9]+", x)
    seps = re.split(r"[0-9]+", x)[1:-1]
    n = sum(map(len, groups))
    before = s[max(0, a - 16) : a]
    at = bool(_AT_MARK.search(x))
    dotted = len(groups) == 4 and len(set(seps)) == 1 and re.fullmatch(_DOT, seps[0] or "-") is not None
    digits = "".join(groups)
    alnum = (a > 0 and s[a - 1].isalnum()) or (b < len(s) and s[b].isalnum())
    near = (a > 0 and s[a - 1] in "+.,-_/@$€£#%") or (b < len(s) - 1 and s[b] in ".,-_/@%" and s[b + 1].isalnum())
    plain = all(set(p) <= set(" ().-") and len(p) <= 3 for p in seps) and x[0] in "+(0123456789" and x[-1].isdigit()
    return np.array([
        1, at, _EMAILISH.fullmatch(x) is not None, dotted, dotted and all(len(g) <= 3 and int(g) <= 255 for g in groups),
        16 <= n <= 19, 16 <= n <= 19 and luhn(digits), 16 <= n <= 19 and plain, 8 <= n <= 15, 10 <= n <= 12, x[0] == "+", x[0] == "(",
        len(groups) >= 2 and len(groups[-1]) == 4 and len(groups[-2]) == 3, len(groups) >= 3, len(groups) == 1, plain, n < 7, n > 19,
        _DATE.fullmatch(x) is not None, _DECIMAL.fullmatch(x) is not None,
        *(c.search(before) is not None for c in _CONTEXT), tokens / 10, len(groups) >= 4 and {len(g) for g in groups} == {4},
        alnum, near, any(c.isalpha() for c in x) and not at, len(set(seps)) > 1,
    ], float)


N_FEATURES = len(features("1", 0, 1, 1))


class Spans:
    """Spans by start, for finding those that meet a stretch without trying all."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.spans = sorted(spans)
        self.starts = [a for a, _ in self.spans]
        self.reach = list(accumulate((b for _, b in self.spans), max))  # the furthest end so far

    def meeting(self, a: int, b: int) -> list[tuple[int, int]]:
        some = self.spans[bisect_right(self.reach, a) : bisect_left(self.starts, b)]
        return [x for x in some if x[1] > a]


def _candidates(s: str, fixed: list[tuple[int, int]]):
    """Token ends in a region, and its candidate spans as (i, j, features)."""
    tokens = [m.span() for m in _TOKEN.finditer(s)]
    known = Spans(fixed)
    taken = [bool(known.meeting(a, b)) for a, b in tokens]
    digit = [s[a].isdigit() for a, _ in tokens]
    out = []
    for i, (a, _) in enumerate(tokens):
        if taken[i] or not (digit[i] or s[a] in "+(" or s[a].isalpha()):
            continue
        letters = s[a].isalpha()
        for j in range(i, min(i + LONGEST, len(tokens))):
            b = tokens[j][1]
            if taken[j] or "\n" in s[a:b]:
                break
            c = s[tokens[j][0]]
            if not letters and not (digit[j] or c in "+().-[]{}<> "):
                if not (c.isalpha() and _AT_MARK.search(s[a : b + 24])):
                    break
            numeric = not letters and digit[j] and sum(ch.isdigit() for ch in s[a:b]) >= 4
            if numeric or ((c.isalpha() or digit[j]) and j > i + 1 and _EMAILISH.fullmatch(s, a, b)):
                out.append((i, j + 1, features(s, a, b, j + 1 - i)))
    return tokens, out


class Crf:
    """A semi-Markov CRF: weights of each kind over whole-span features."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def _by_end(self, n: int, spans) -> list[list]:
        ends = [[] for _ in range(n + 1)]
        if spans:
            scores = np.stack([f for _, _, f in spans]) @ self.weights.T
            for k, ((i, j, _), sc) in enumerate(zip(spans, scores, strict=True)):
                ends[j].append((i, k, sc))
        return ends

    def decode(self, n: int, spans) -> list[tuple[int, int, int]]:
        """The best segmentation's spans (kind, i, j)."""
        best, back = np.zeros(n + 1), [None] * (n + 1)
        for j, ends in enumerate(self._by_end(n, spans)):
            if j:
                best[j] = best[j - 1]
            for i, _, sc in ends:
                y = int(sc.argmax())
                if best[i] + sc[y] > best[j]:
                    best[j], back[j] = best[i] + sc[y], (y, i)
        out, j = [], n
        while j > 0:
            if back[j] is None:
                j -= 1
            else:
                out.append((*back[j], j))
                j = back[j][1]
        return out[::-1]

    def expected(self, n: int, spans) -> tuple[np.ndarray, float]:
        """Probability of each (span, kind), and the log of the normaliser."""
        ends = self._by_end(n, spans)
        alpha, beta = np.zeros(n + 1), np.zeros(n + 1)
        for j in range(1, n + 1):
            alpha[j] = np.logaddexp.reduce(np.concatenate([[alpha[j - 1]], *[alpha[i] + sc for i, _, sc in ends[j]]]))
        beta[:n] = -np.inf
        for j in range(n, 0, -1):
            beta[j - 1] = np.logaddexp(beta[j - 1], beta[j])
            for i, _, sc in ends[j]:
                beta[i] = np.logaddexp(beta[i], np.logaddexp.reduce(sc) + beta[j])
        p = np.zeros((len(spans), len(KINDS)))
        for j in range(1, n + 1):
            for i, k, sc in ends[j]:
                p[k] = np.exp(alpha[i] + sc + beta[j] - alpha[n])
        return p, float(alpha[n])


def _rewritten(kind: int, x: str, r: np.random.Generator) -> str:
    """A form of a base span that the patterns miss."""
    if kind == 0:
        at, dot = [(" @ ", "."), (" [at] ", " [dot] "), (" (at) ", "."), (" at ", " dot ")][r.integers(4)]
        local, _, domain = x.partition("@")
        return local + at + domain.replace(".", dot)
    if kind == 1:
        return x.replace(".", ["[.]", " . ", "(.)"][r.integers(3)])
    digits = _NOT_DIGIT.sub("", x)
    if kind == 2:
        return [".", "  ", " - "][r.integers(3)].join(digits[i : i + 4] for i in range(0, len(digits), 4))
    d = digits[-10:].rjust(10, "5")
    return [f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"1-{d[:3]}-{d[3:6]}-{d[6:]}"][r.integers(4)]


def _other(r: np.random.Generator) -> str:
    """A number that is no personal data."""
    n = lambda a, b: int(r.integers(a, b))
    return [
        f"{n(1900, 2100)}-{n(1, 13):02}-{n(1, 29):02}", f"{n(1, 29)}/{n(1, 13)}/{n(1990, 2030)}", f"{n(0, 20)}.{n(0, 20)}.{n(0, 99)}", f"${n(1, 999)},{n(100, 999)}.{n(10, 99)}",
        f"{n(10**15, 10**16)}", f"{n(1, 24):02}:{n(0, 60):02}:{n(0, 60):02}", f"{n(1900, 2030)}-{n(1900, 2030)}", f"{n(10**7, 10**12)}", f"{n(1, 9)}.{n(10, 99)} {n(1, 9)}.{n(10, 99)} {n(1, 9)}.{n(10, 99)}",
        f"{n(300, 999)}.{n(300, 999)}.{n(1, 99)}.{n(1, 99)}", f"{n(100, 999)} {n(100, 999)} {n(10, 99)}", f"978-{n(0, 9)}-{n(100, 999)}-{n(10000, 99999)}-{n(0, 9)}",
    ][n(0, 12)]


def _generated(kind: int, r: np.random.Generator) -> str:
    d = lambda k: "".join(map(str, r.integers(0, 10, k)))
    if kind == 2:
        first = "4" + d(14)
        return next(first + str(c) for c in range(10) if luhn(first + str(c)))
    return (f"user{d(2)}@mail{d(1)}.example.com", ".".join(str(v) for v in r.integers(1, 255, 4)), "", f"+1 ({d(3)}) {d(3)}-{d(4)}")[kind]


def train(sample: list[str]) -> Crf:
    """Fit to regions of the corpus and rewritten copies of them."""
    r = np.random.default_rng(7)
    rows: list[tuple[str, list[tuple[int, int, int]]]] = []
    for s in sample:
        base = base_spans(s)
        rows.append((s, base))
        for kind, a, b in base[:3]:
            if any(x < b and a < y and (k, x, y) != (kind, a, b) for k, x, y in base):
                continue
            for new, gold in ((_rewritten(kind, s[a:b], r), True), (_other(r), False)):
                shift = len(new) - (b - a)
                kept = [(k, x + shift * (x >= b), y + shift * (x >= b)) for k, x, y in base if (k, x, y) != (kind, a, b)]
                rows.append((s[:a] + new + s[b:], kept + [(kind, a, a + len(new))] * gold))
    for _ in range(60):  # a floor of examples of each kind, whatever the corpus holds
        for kind in range(len(KINDS)):
            x = _generated(kind, r)
            for new, gold in ((x, True), (_rewritten(kind, x, r), True), (_other(r), False)):
                rows.append((f"word and {new} then more", [(kind, 9, 9 + len(new))] * gold))
    data = []
    for s, gold in rows:
        tokens, spans = _candidates(s, [])
        where = {(tokens[i][0], tokens[j - 1][1]): k for k, (i, j, _) in enumerate(spans)}
        at = [(kind, where.get((a, b))) for kind, a, b in gold]
        if spans and all(k is not None for _, k in at):
            data.append((len(tokens), spans, np.stack([f for _, _, f in spans]), at))
    model, seen = Crf(np.zeros((len(KINDS), N_FEATURES))), np.full((len(KINDS), N_FEATURES), 1e-6)
    for _ in range(EPOCHS):
        for k in r.permutation(len(data)):
            n, spans, f, gold = data[k]
            p, _ = model.expected(n, spans)
            grad = -p.T @ f - RIDGE * model.weights
            for kind, at in gold:
                grad[kind] += f[at]
            seen += grad**2
            model.weights = model.weights + RATE * grad / np.sqrt(seen)
    return model


def added(model: Crf, region: str, fixed: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(kind, start, end) that the model adds to a region, within it."""
    tokens, spans = _candidates(region, fixed)
    return [(y, tokens[i][0], tokens[j - 1][1]) for y, i, j in model.decode(len(tokens), spans)] if spans else []


# --- over a table ----------------------------------------------------------

_SPANS = "array<struct<kind:int,start:long,end:long>>"


def _scan(text: pd.Series) -> pd.DataFrame:
    rows = []
    for t in text:
        base = base_spans(t or "")
        rows.append((
            [{"kind": k, "start": a, "end": b} for k, a, b in base],
            [{"at": a, "text": s, "more": m} for a, s, m in regions(t or "", base)],
        ))
    return pd.DataFrame(rows, columns=["base", "regions"])


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but for the text, with ``pii``, all spans as
    (kind, start, end) by kind and start, and ``pii_base``, the base spans.
    Columns of these names give way."""
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in {text, "pii", "pii_base"}]
    found = F.pandas_udf(_scan, f"struct<base:{_SPANS},regions:array<struct<at:long,text:string,more:boolean>>>")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], found(F.col(f"`{text}`")).alias("_found"))
    rows = written(rows.select(*[F.col(f"`{c}`") for c in kept], F.col("_found.base").alias("pii_base"), F.col("_found.regions").alias("_regions")), "pii-regions")
    texts = rows.select(F.explode("_regions").alias("r")).select("r.text").distinct().where(F.length("text") <= 6 * SAMPLE_TOKENS)
    sample = [r.text for r in texts.orderBy(F.xxhash64("text"), "text").limit(SAMPLE).collect()]
    model = docs.sparkSession.sparkContext.broadcast(train(sample))

    def extra(base: pd.Series, found: pd.Series) -> pd.Series:
        out = []
        for b, rs in zip(base, found, strict=True):
            new, known = [], Spans([(s["start"], s["end"]) for s in b])
            for x in rs:
                at = x["at"]
                if x["more"]:
                    fixed = [(i - at, j - at) for i, j in known.meeting(at, at + len(x["text"]))]
                    new += [{"kind": k, "start": at + i, "end": at + j} for k, i, j in added(model.value, x["text"], fixed)]
            out.append(new)
        return pd.Series(out, dtype=object)

    more = F.when(F.exists("_regions", lambda x: x.more), F.pandas_udf(extra, _SPANS)("pii_base", "_regions")).otherwise(F.array().cast(_SPANS))
    return rows.withColumn("pii", F.sort_array(F.concat("pii_base", more))).drop("_regions")


def span_text(spans) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start.cast("string"), s.end.cast("string"))), ",")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts and digest, all spans."""
    s = scan(documents(spark, sf_dir).select("doc_id", "text"))
    counts = [F.size(F.filter("pii_base", _of(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return s.select(
        "doc_id", *counts, F.sha2(span_text("pii_base"), 256).alias("base_sha256"), span_text("pii").alias("spans"),
        (F.size("pii") - F.size("pii_base")).cast("long").alias("n_added"))


def _of(kind: int):
    return lambda s: s.kind == kind
