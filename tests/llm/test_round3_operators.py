"""Token counts, importance resampling and periodic runs against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import sentencepiece

from skytrace.llm import resample, runs, token_counts
from skytrace.llm.common import documents, text_batches
from skytrace.session import read_table

SF = "/root/testdata/sf0.001"
LONG = "one two three four five six seven. " * 20_000
EDGE = [(1, ""), (2, None), (3, " \t\n"), (4, "word"), (4, "word"), (None, "no id here"), (None, None), (5, LONG), (6, "\x01a b\x02 c"),
        (7, "é ü 中文 \U0001F600 x"), (2**60 + 1, "a large id"), (-3, "a negative id")]


def table(spark, rows):
    """doc_id, text, and columns whose names operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("key", "n", "overlap", "chunk", "text_key", "n_tokens", "rank", "score", "run", "place", "segment", "weight", "start", "period"):
        df = df.selectExpr("*", f"'x' as {c}")
    return df


def order(rows):
    return sorted(map(tuple, rows), key=lambda r: [(x is None, x if x is not None else 0) for x in r])


# Token counts


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.TOKENIZER))


def token_texts():
    r = random.Random(1)
    return [
        "a" * 5000, "a" * 3001 + "b" * 3000, " " * 4000 + "x", "ᚠ\U00012000" * 700, "ab " * 2000, "▁▁ x" * 900, "ab" * 3000 + " c" * 500,
        "".join(r.choice("ab \n\U0001F600ᚠé1") for _ in range(6000)), "".join(r.choice(["the ", "token", "isation", "  ", "\n\n", "12", "!="]) for _ in range(2000)),
        "<s> </s> <unk> <0x0A> " * 300,
    ]


@pytest.mark.parametrize("chunk,overlap", [(256, 16), (1024, 64)])
def test_spliced_counts(spark, model, chunk, overlap):
    texts = token_texts()
    rows = EDGE + [(100 + i, t) for i, t in enumerate(texts)] + [(200, texts[1]), (100, texts[1]), (100, texts[1])]
    got = [tuple(r) for r in token_counts.counted(table(spark, rows), chunk=chunk, overlap=overlap).collect()]
    assert order(got) == order((d, len((t or "").encode()), len(model.encode(t or ""))) for d, t in rows)


def test_overlaps_are_widened(spark, model):
    # Runs of one letter are cut into pieces of several from the left on: chunks
    # that begin elsewhere in a run share no token with their neighbour.
    r = random.Random(3)
    text = "".join(r.choice("ab") * r.randint(200, 900) for _ in range(12))
    got = token_counts.counted(table(spark, [(1, text)]), chunk=128, overlap=8).first()
    assert got.n_tokens == len(model.encode(text))


def test_counts_of_documents(spark, model):
    want = {r.doc_id: len(model.encode(r.text or "")) for r in documents(spark, SF).collect()}
    got = token_counts.op11_token_counts(spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in got} == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got)
    small = token_counts.counted(documents(spark, SF), chunk=2048, overlap=128).collect()
    assert {r.doc_id: r.n_tokens for r in small} == want


def test_counts_empty_and_refused(spark):
    assert token_counts.counted(table(spark, [])).count() == 0
    with pytest.raises(ValueError):
        token_counts.counted(table(spark, []), chunk=100, overlap=50)


def test_batch_settings_return(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with text_batches(spark, 7):
        assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "7"
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


# Importance resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute_resample(docs, target, percent=5):
    s, t, out = [0] * 10000, [0] * 10000, []
    described = [(d, *features(x)) for d, x in docs]
    for _, _, f in described:
        for b in f:
            s[b] += 1
    for x in target:
        for b in features(x)[1]:
            t[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + 10000) / ((x + 1) * (sum(t) + 10000)))) for x, y in zip(s, t, strict=True)] if docs else []
    for d, n, f in described:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([d, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    may = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for i, r in enumerate(may[: percent * len(may) // 100]):
        r[5] = i + 1
    return out


def test_feature_buckets():
    r = random.Random(7)
    texts = [None, "", "ABC-def_ghi", "Straße ÄÖ " + "y" * 200 + " " + "z" * 64 + " " + "q" * 65, " ".join("w" * r.randint(1, 90) for _ in range(300))]
    buckets, owner, n = resample.feature_buckets(texts)
    for i, t in enumerate(texts):
        assert (int(n[i]), Counter(buckets[owner == i].tolist())) == (features(t)[0], Counter(features(t)[1]))


def test_resample_documents(spark):
    docs = [(r.doc_id, r.text) for r in documents(spark, SF).collect()]
    target = [r.text for r in read_table(spark, SF, "benchmark").collect()]
    got = resample.op12_resample(spark, SF).select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert order(got) == order((r[0], *r[2:]) for r in brute_resample(docs, target))


@pytest.mark.parametrize("percent", [0, 5, 63, 100])
def test_resample_edges(spark, percent):
    # A third of all rows is one row; many ties; rows without id.
    rows = EDGE + [(7, "a b c " * 10)] * 200 + [(None, "x y " * 12)] * 50 + [(i, "q " * (i % 40)) for i in range(300)]
    target = spark.createDataFrame([("a b c q",), (None,)], "text string")
    got = resample.resampled(table(spark, rows), target, percent=percent)
    assert order(got.collect()) == order(brute_resample(rows, ["a b c q", None], percent))


def test_resample_empty(spark):
    none = spark.createDataFrame([], "text string")
    assert resample.resampled(table(spark, []), none).count() == 0
    assert order(resample.resampled(table(spark, EDGE), none).collect()) == order(brute_resample(EDGE, []))


def test_ranks_over_segments(spark):
    rows = spark.range(20_000).selectExpr("id as doc_id", "pmod(xxhash64(id), 500) as score").repartition(7)
    got = {r.doc_id: r["rank"] for r in resample.ranked(rows, 20_000, 3_000).collect()}
    by = sorted((-r.score, r.doc_id) for r in rows.collect())
    assert got == {d: i + 1 if i < 3_000 else None for i, (_, d) in enumerate(by)}


# Periodic runs


def brute_runs(w):
    out, seen = [], set()
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(12, 2 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(ws):
    own, drop = brute_runs(ws), set()
    for s, n, q in own:
        drop.update(range(s + q, s + n))
    top = (0, None, None, None, None)
    if own:
        s, n, q = min(own, key=lambda r: (-r[1], r[0], r[2]))
        top = (len(own), s, n, q, 1000 * n // q)
    kept = b" ".join(w for i, w in enumerate(ws) if i not in drop)
    return (*top, hashlib.sha256("".join("%d,%d,%d\n" % r for r in own).encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def made_periodic(ws, doc_id):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not ws:
        return ws
    a = h // 10 % len(ws)
    p = 1 + (len(ws) - a) // (3 + h // 10 % 8)
    return [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]


def random_words(r):
    n, k = r.choice([0, 1, 5, 11, 12, 13, 30, 80, 200]), r.choice([1, 2, 2, 3, 4, 20])
    ws = [b"%d" % r.randrange(k) for _ in range(n)]
    if n and r.random() < 0.6:
        u = ws[: r.randint(1, n)]
        ws += u * r.randint(1, 6) + ws[: r.randint(0, n)] + [b"z"] + u * r.randint(0, 3)
        if r.random() < 0.5:
            ws[r.randrange(len(ws))] = b"y"
    if r.random() < 0.2:
        a, b = [b"a"], [b"a", b"b"]  # Fibonacci words are full of runs
        for _ in range(r.randint(3, 9)):
            a, b = b, b + a
        ws += b
    return ws


@pytest.mark.parametrize("seed", range(4))
def test_random_runs(seed):
    r = random.Random(seed)
    for _ in range(60):
        lists = [random_words(r) for _ in range(r.randint(1, 6))]
        assert runs.describe(lists) == [brute_row(ws) for ws in lists]


def test_range_successor():
    r = np.random.default_rng(2)
    values = r.permutation(1000)
    w = runs.WaveletMatrix(values)
    lo = r.integers(0, 1000, 500)
    hi = np.minimum(1000, lo + r.integers(0, 60, 500))
    x = r.integers(0, 1030, 500)
    want = [min((v for v in values[a:b] if v >= y), default=-1) for a, b, y in zip(lo, hi, x, strict=True)]
    assert w.successor(lo, hi, x, -1).tolist() == want


def test_runs_of_documents(spark):
    docs = [(r.doc_id, r.text) for r in documents(spark, SF).collect()]
    got = {r.doc_id: tuple(r)[1:] for r in runs.op13_periodic_runs(spark, SF).collect()}
    short = [(d, t) for d, t in docs if len(t.split()) < 1500]
    assert len(got) == len(docs) and len(short) > 150
    assert all(got[d] == brute_row(made_periodic((t or "").encode().split(), d)) for d, t in short)


def test_run_edges(spark):
    got = runs.word_runs(table(spark, [x for x in EDGE if x[1] != LONG]), runs.periodic).collect()
    assert order(got) == order((d, *brute_row(made_periodic((t or "").encode().split(), d))) for d, t in EDGE if t != LONG)
    one = runs.word_runs(table(spark, [(None, LONG)])).first()
    assert tuple(one)[:6] == (None, 1, 0, 140_000, 7, 20_000_000)
    assert runs.word_runs(table(spark, [])).count() == 0


def test_ranks_where_a_segment_spans_batches():
    seg = np.repeat([0, 2], [5, 7])
    rows = [pd.DataFrame({"doc_id": range(i, i + 2), "segment": seg[i : i + 2]}) for i in range(0, 12, 2)]
    got = pd.concat(resample._numbered(np.array([0, 5, 5]), 9)(iter(rows)))["rank"]
    assert [None if pd.isna(x) else x for x in got] == [*range(1, 10), None, None, None]
