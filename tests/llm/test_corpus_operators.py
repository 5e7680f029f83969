"""Near copies, repeats, decontamination, mixing, tokens and preference pairs
against brute force, and their edge cases."""

import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skytrace.llm import decontaminate, mixing, neardup, preference, repeats, tokens
from skytrace.llm.common import documents
from skytrace.llm.components import components

SF = "/root/testdata/sf0.001"
EDGE = [(1, ""), (2, None), (3, " \t\n"), (4, "word"), (4, "word"), (None, "no id here"), (5, "long text of words " * 20_000), (7, "é ü 中文 \U0001F600 x")]


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in ("id", "sig", "set_key", "component", "t", "unit", "removed", "w", "c", "pos", "digest", "part", "start", "common", "tree"):
        df = df.selectExpr("*", f"'x' as {c}")
    return df


# --- near copies ------------------------------------------------------------

def shingle_set(t):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows, percent=85):
    sets = [(d, shingle_set(t)) for d, t in rows if d is not None]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d, _ in sets}


def check_links(spark, rows, percent=85):
    want = brute_components(rows, percent)
    got = neardup.link(table(spark, rows), percent).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert Counter(r.n_shingles for r in got) == Counter(len(shingle_set(t)) for _, t in rows)


def test_near_copies_of_documents(spark):
    check_links(spark, [(r.doc_id, r.text) for r in documents(spark, SF).select("doc_id", "text").collect()])


def edited(r, words, k):
    w = list(words)
    for i in r.sample(range(len(w)), k):
        w[i] = f"new{r.random()}"
    return " ".join(w)


def test_near_copies_of_a_dense_group(spark, monkeypatch):
    """Hundreds of differing copies, close to the threshold, in small blocks."""
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 2500)
    r = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, edited(r, base, r.choice([0, 1, 2, 2, 3]))) for i in range(260)]
    rows += [(1000 + i, edited(r, base, r.choice([4, 6, 30]))) for i in range(40)]
    rows += [(2000 + i, " ".join(f"z{i}_{k}" for k in range(r.randint(1, 30)))) for i in range(60)]
    r.shuffle(rows)
    check_links(spark, rows)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_copies_at_other_similarities(spark, percent):
    r = random.Random(percent)
    base = [[f"w{k}_{i}" for i in range(120)] for k in range(12)]
    rows = [(100 * k + i, edited(r, b, r.choice([0, 1, 2, 3, 4]))) for k, b in enumerate(base) for i in range(8)]
    assert brute_components(rows, 80) != brute_components(rows, 85)
    check_links(spark, rows, percent)


@pytest.mark.parametrize("short,block", [(256, 200_000), (8, 1500), (8, 200_000)])
def test_near_copies_among_singles_of_one_template(spark, monkeypatch, short, block):
    """Pairs at 0.86 among rows that are all at 0.74 of each other, none of
    them close neighbours in an order; lists in one stretch, and in blocks."""
    monkeypatch.setattr(neardup, "SHORT_LIST", short)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", block)
    orders = neardup.candidates
    monkeypatch.setattr(neardup, "candidates", lambda reps: orders(reps).where("false"))
    template, rows = [f"t{i}" for i in range(120)], []
    for i in range(60):
        own = [f"o{i}_{k}" for k in range(20)]
        rows.append((i, " ".join(template + own)))
        if i % 12 == 0:
            rows.append((5000 + i, " ".join(template + own[:10] + [f"p{i}_{k}" for k in range(10)])))
    check_links(spark, rows)


def test_near_copies_edges(spark):
    check_links(spark, [*EDGE, (8, "WORD"), (9, "a b c d"), (10, "a  b\nC d"), (11, "a b c")])
    assert neardup.link(table(spark, [])).count() == 0


def test_rows_of_one_id_are_one_document(spark):
    rows = [(1, "a b c d e f"), (5, "a b c d e f"), (5, "p q r s t u"), (9, "p q r s t u"), (12, "other")]
    got = {(r.doc_id, r.component_id) for r in neardup.link(table(spark, rows)).collect()}
    assert got == {(1, 1), (5, 1), (9, 1), (12, 12)}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 299), (299, 300)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 160), 100), 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- repeats ------------------------------------------------------------------

def brute_repeats(rows, unit, least):
    first, out = {}, {}
    for d, t in sorted((d, t) for d, t in rows if d is not None and t):
        lines = []
        for a, b in repeats.cut(t, unit):
            own = [(a + i, a + j, p) for i, j in repeats.cut(t[a:b], "sentence") if (p := repeats.normalised(t[a + i : a + j]))]
            lines.append(("\n".join(p for _, _, p in own), own))
        seen, flat = set(), []
        repeated = lambda p: p in seen or first.get(p, d) < d  # noqa: B023, E731
        for line, own in lines:
            flags = []
            for _, _, p in own:
                flags.append(repeated(p))
                seen.add(p)
            whole = unit != "sentence" and own and any(c.isalpha() for c in line) and (repeated(line) if len(own) > 1 else flags[0])
            seen.add(line)
            flat += [(*x, f, whole) for x, f in zip(own, flags, strict=True)]
        for p in seen:
            first.setdefault(p, d)
        gone, k = set(), 0
        while k < len(flat):
            e = k
            while e < len(flat) and flat[e][3]:
                e += 1
            if e > k and sum(len(x[2].split()) for x in flat[k:e]) >= least:
                gone.update(range(k, e))
            k = max(e, k + 1)
        gone |= {k for k, x in enumerate(flat) if x[4]}
        spans = []
        for k in sorted(gone):
            if k - 1 in gone:
                spans[-1] = (spans[-1][0], flat[k][1])
            else:
                spans.append((flat[k][0], flat[k][1]))
        if spans:
            out[d] = spans
    return out


@pytest.mark.parametrize("unit", ["line", "paragraph", "sentence"])
def test_random_repeats(spark, unit):
    r = random.Random(unit)
    sentences = [" ".join(r.choice("abcdef") for _ in range(r.choice([1, 2, 3, 12]))) + r.choice([".", "!", ""]) for _ in range(25)] + ["12 3.", "--", "7"]
    rows = []
    for i in range(120):
        t = "".join(r.choice(sentences) + r.choice([" ", " ", "\n", "\n\n", " \n"]) for _ in range(r.randint(0, 9)))
        rows.append((i, t))
    got = {}
    for s in repeats.repeats(table(spark, rows), unit=unit, min_words=6).collect():
        got.setdefault(s.doc_id, []).append((s["from"], s["to"]))
    assert {d: sorted(x) for d, x in got.items()} == brute_repeats(rows, unit, 6)


def test_short_lines_go_everywhere(spark):
    line = "All rights reserved by us."
    rows = [(i, f"Own text {i} here.\n{line}\n- 1 -\nMore own text {i}.") for i in range(50)] + [(99, f"Own here, but {line} Then more.")]
    left = repeats.remove(table(spark, rows), repeats.repeats(table(spark, rows)))
    got = {r.doc_id: r.text for r in left.collect()}
    assert set(got) == set(range(1, 50)) and not any(line in t for t in got.values()) and all("- 1 -" in t for t in got.values())


def test_no_line_stays_in_two_documents(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in documents(spark, sf).collect()}
    texts |= {r.doc_id: r.text for r in repeats.op5_repeats(spark, sf).collect()}
    of = Counter(p for t in texts.values() for p in {repeats.normalised(t[i:j]) for i, j in repeats.cut(t, "line")} if any(c.isalpha() for c in p))
    several = [p for p, n in of.items() if n > 1]
    # Only what is left of lines after a passage inside them went may agree by chance.
    assert len(several) <= 0.001 * len(of), several[:5]


def test_repeats_of_documents(spark):
    rows = [(r.doc_id, r.text) for r in documents(spark, SF).collect()]
    want, texts = brute_repeats(rows, "line", repeats.MIN_WORDS), dict(rows)
    got = {r.doc_id: r for r in repeats.op5_repeats(spark, SF).collect()}
    assert {d: [tuple(map(int, s.split(":"))) for s in r.spans.split(",")] for d, r in got.items()} == want
    for d, r in got.items():
        left, at = "", 0
        for a, b in want[d]:
            left, at = left + texts[d][at:a], b
        assert r.text == left + texts[d][at:]


@pytest.mark.parametrize("unit", ["line", "paragraph", "sentence"])
def test_planted_passage(spark, unit):
    r = random.Random(1)
    passage = " ".join(" ".join(f"p{r.randint(0, 999)}" for _ in range(12)).capitalize() + "." for _ in range(5))
    sep = {"line": "\n", "paragraph": "\n\n", "sentence": " "}[unit]
    rows = [(i, sep.join([f"Own start {i} a.", passage, f"Own end {i} b."])) for i in range(4)] + [(9, "Clean text of its own. Yes."), (10, "Other text. Yes.")]
    found = repeats.repeats(table(spark, rows), unit=unit).collect()
    assert {(s.doc_id, s["from"], s["to"], s.kept_in) for s in found} == {
        (i, rows[i][1].index(passage), rows[i][1].index(passage) + len(passage), 0) for i in (1, 2, 3)}


def test_repeats_edges(spark):
    same = "A sentence of rather many words that stands twice in the table so that it is long enough to go away here."
    rows = [*EDGE, (20, same), (21, same), (21, same), (None, same), (22, f"{same} {same}")]
    spans = repeats.repeats(table(spark, rows))
    got = {(s.doc_id, s["from"], s["to"]) for s in spans.collect()}
    assert got == {(21, 0, len(same)), (22, 0, 2 * len(same) + 1)}  # the long text is one sentence without a repeat
    left = repeats.remove(table(spark, rows), spans)
    assert sorted((r.doc_id, r.text) for r in left.collect()) == [(21, ""), (21, ""), (22, "")]
    assert repeats.remove(table(spark, []), repeats.repeats(table(spark, []))).count() == 0


# --- decontamination --------------------------------------------------------------

QUESTION = "A farmer in Texas sold 12 apples for 3 dollars each and then bought 12 pears at 7 dollars each how much money did farmer Smith spend in total"
CHANGED = "A farmer in Ohio sold 45 apples for 8 dollars each and then bought 45 pears at 9 dollars each how much money did farmer Jones spend in total"
SWAPPED = "A farmer in Ohio sold 45 apples for 8 dollars each and then bought 46 pears at 9 dollars each how much money did farmer Jones spend in total"


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "'x' as doc_id", "'y' as pos")


def test_reparameterised_question(spark):
    docs = table(spark, [(1, f"Some start. {CHANGED} and an end."), (2, "Some other text of a farmer in Ohio who sold pears"), (3, QUESTION), (4, f"x {QUESTION.upper()}")])
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, bench(spark, [(10, QUESTION), (11, "short item"), (12, None), (13, "")])).collect()}
    assert {(1, 10), (3, 10)} <= set(got) and not {k for k in got if k[0] == 2}
    assert got[1, 10].n_consistent == got[1, 10].n_slots > 0


def test_inconsistent_slots(spark):
    loose = " ".join(f"w{i} 5 x{i} y{i}" for i in range(8))
    varied = " ".join(f"w{i} {i + 1} x{i} y{i}" for i in range(8))
    constant = " ".join(f"w{i} 9 x{i} y{i}" for i in range(8))
    docs = table(spark, [(1, varied), (2, constant), (3, SWAPPED)])
    assert {r.doc_id for r in decontaminate.contaminated(docs, bench(spark, [(10, loose)])).collect()} == {2}


def test_slots_without_id(spark):
    """Rows without an id are judged like others: inconsistent slots count."""
    loose = " ".join(f"w{i} 5 x{i} y{i}" for i in range(8))
    varied = " ".join(f"w{i} {i + 1} x{i} y{i}" for i in range(8))
    constant = " ".join(f"w{i} 9 x{i} y{i}" for i in range(8))
    found = lambda docs, items: {(r.doc_id, r.item_id) for r in decontaminate.contaminated(table(spark, docs), bench(spark, items)).collect()}
    assert found([(None, varied)], [(10, loose)]) == found([(7, varied)], [(10, loose)]) == set()
    assert found([(None, constant), (7, varied)], [(None, loose)]) == {(None, None)}


def test_texts_under_one_id_are_judged_apart(spark):
    """Neither text holds enough of the item, or holds it consistently, alone."""
    words = [f"w{i} 5 x{i} y{i}" for i in range(12)]
    one, two = " ".join(words[:4]).replace(" 5 ", " 7 "), " ".join(words[4:7]).replace(" 5 ", " 8 ")
    whole = " ".join(words)
    docs = lambda a, b: table(spark, [(a, one + " and more of its own"), (b, "other " * 30 + two)])
    items = bench(spark, [(10, whole)])
    apart = {r.doc_id: tuple(r)[2:] for r in decontaminate.contaminated(docs(1, 2), items).collect()}
    together = [tuple(r)[2:] for r in decontaminate.contaminated(docs(1, 1), items).collect()]
    assert together == ([max(apart.values())] if apart else [])


def test_variants_are_judged_one_by_one(spark):
    """A question beside its variant, and an item that repeats its own template."""
    other = QUESTION.replace("Texas", "Iowa").replace("12", "31").replace("3 d", "6 d").replace("Smith", "Brown")
    balls = "There are 5 red balls in the first box on the table. There are 7 red balls in the first box on the table. Count all."
    docs = table(spark, [(1, f"{QUESTION}. {CHANGED}."), (2, f"{CHANGED}. {other}. {QUESTION}."), (3, f"See: {balls}"), (4, f"{CHANGED}. {other}."),
                         (5, SWAPPED), (6, f"{SWAPPED}. Then nothing.")])
    items = bench(spark, [(10, QUESTION), (11, balls)])
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    one = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs.where("doc_id = 5"), items).collect()}
    assert got - {(5, 10), (6, 10)} == {(1, 10), (2, 10), (3, 11), (4, 10)}
    assert ((5, 10) in got) == ((6, 10) in got) == ((5, 10) in one)


def test_copies_in_another_case(spark):
    """Upper-case copies, and items of which no window has enough plain words."""
    title = "The Old Man And The Sea Was Written By Which American Author"
    names = "Alice Brown 12 kg Bob White 13 kg Carol Green 14 kg"
    docs = table(spark, [(1, f"x {QUESTION.upper()}"), (2, f"We ask: {title}? Yes."), (3, title.lower()), (4, f"so {names.upper()} so"),
                         (5, "The Young Man And The Hill Was Painted By Which Spanish Author"), (6, "Dora Black 15 kg Emil Grey 16 kg Fay Blue 17 kg")])
    items = bench(spark, [(10, QUESTION), (11, title), (12, names)])
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()} == {(1, 10), (2, 11), (3, 11), (4, 12)}


def test_passage_of_a_long_item(spark):
    r = random.Random(3)
    item = [r.choice("alpha beta gamma delta river stone cloud window".split()) + str(r.randint(0, 999)) + "x" for _ in range(600)]
    numbers = [w if i % 6 else str(i) for i, w in enumerate(item)]
    other = [str(1000 + i) if i % 6 == 0 else w for i, w in enumerate(numbers)]
    cut = lambda w, a, n: "Own words here. " + " ".join(w[a : a + n]) + " and own words again"
    docs = table(spark, [(1, cut(item, 300, 50)), (2, cut(item, 10, 20)), (3, cut(item, 10, 18)), (4, f"{cut(item, 50, 12)} {cut(item, 90, 12)}"),
                         (5, cut(numbers, 101, 50)), (6, cut(other, 101, 50)), (7, cut(other, 101, 50).replace(" 1102 ", " 1108 ").replace(" 1114 ", " 1108 "))])
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, bench(spark, [(10, " ".join(item)), (11, " ".join(numbers))])).collect()}
    assert {(1, 10), (2, 10), (5, 11), (6, 11)} <= got
    assert not {(3, 10), (4, 10)} & got


def test_leaks_of_documents(spark):
    flat = lambda t: " ".join((t or "").split())
    items = [(r.item_id, flat(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {(r.doc_id, i) for r in documents(spark, SF).collect() for i, t in items if t and t in flat(r.text)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.op6_decontaminate(spark, SF).collect()} == want


def test_decontamination_edges(spark):
    items = bench(spark, [(1, "word"), (1, "word"), (None, "no id here"), (2, "")])
    got = decontaminate.contaminated(table(spark, EDGE), items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(4, 1), (None, None)}
    assert decontaminate.contaminated(table(spark, EDGE), bench(spark, [])).count() == 0
    assert decontaminate.contaminated(table(spark, []), items).count() == 0


def test_large_benchmark_takes_the_shuffled_join(spark, monkeypatch):
    want = {tuple(r) for r in decontaminate.op6_decontaminate(spark, SF).collect()}
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert {tuple(r) for r in decontaminate.op6_decontaminate(spark, SF).collect()} == want


# --- mixing -----------------------------------------------------------------------

def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def check_mix(rows):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    want = brute_targets(sizes)
    assert all(abs(target[s] - want[s]) <= 1e-6 * max(1, want[s]) for s in sizes)
    assert all(r.source_size == sizes[r.source] for r in rows)
    return taken, want


def test_mix_of_documents(spark):
    rows = mixing.op8_mix_sources(spark, "/root/testdata/sf0.01").collect()
    taken, want = check_mix(rows)
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] for s in want)
    text = {r.doc_id: r.text for r in documents(spark, "/root/testdata/sf0.01").collect()}
    assert {r.doc_id: r.size for r in rows} == {d: len(t.split()) for d, t in text.items()}
    again = mixing.op8_mix_sources(spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


def test_newton_meets_targets(spark):
    sizes = spark.createDataFrame([(s, n, 1 + n % 3) for s in ("a", "b", None) for n in (0, 1, 5, 40, 900, 20_000)], "source string, size long, sizes_n long")
    total = sizes.groupBy("source").agg({"sizes_n": "sum"}).collect()
    n = {r[0]: r[1] for r in total}
    size = sum(k * (1 + k % 3) for k in (0, 1, 5, 40, 900, 20_000))
    wanted = spark.createDataFrame([("a", n["a"], size, 1.9999 * size), ("b", n["b"], size, 0.001 * size), (None, n[None], size, 2.0 * size)],
                                   "source string, n long, source_size long, target double")
    for r in mixing.solve(sizes, wanted).collect():
        if r.source is None:
            assert r.tilt == float("inf")
            continue
        got = sum(2 / (1 + np.exp(-r.tilt * k / r.mean)) * k * (1 + k % 3) for k in (0, 1, 5, 40, 900, 20_000))
        assert abs(got - r.target) < 1e-5 * r.target


def test_rows_without_id_meet_their_target(spark):
    """Units of thousands of rows: each row counts, not the unit as a whole."""
    rows = [(None, " ".join(["w"] * (1 + i % 3)), "s") for i in range(3000)] + [(i, f"a b {i}", "t") for i in range(5)] + [(7, "x y z", None)] * 400
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sized = docs.select("doc_id", "source", mixing.size_of(docs.text).alias("size"))
    taken = Counter()
    for r in mixing.mix(sized).collect():
        taken[r.source] += r.size * (r.m * r.copies + r.more)
        assert 0 <= r.more < r.m and r.copies + (r.more > 0) <= 2
    want = brute_targets({"s": 6000, "t": 15, None: 1200})
    assert all(abs(taken[s] - want[s]) <= max(3, 0.01 * want[s]) for s in want)
    out = mixing.mixed(docs)
    got = Counter()
    for r in out.collect():
        got[r.source] += len(r.text.split())
    assert got == taken
    assert sorted(map(str, mixing.mixed(docs).collect())) == sorted(map(str, out.collect()))


def test_mix_edges(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (2, None, "s"), (3, "", None), (4, "one two", None), (None, "x y", "ü"), (5, " w " * 5000, "s"), (6, None, "empty")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "'x' as size", "'x' as rate", "'x' as copies", "'x' as m")
    sized = docs.select("doc_id", "source", mixing.size_of(docs.text).alias("size"))
    units = mixing.mix(sized).collect()
    assert sum(r.m for r in units) == len(rows)
    assert {(r.doc_id, r.m) for r in units if r.doc_id == 1} == {(1, 2)}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    want = Counter()
    for r in units:
        want[r.doc_id] += r.m * r.copies + r.more
    assert Counter(r.doc_id for r in out.collect()) == +want
    assert mixing.mixed(docs.where("false")).count() == 0


# --- token shards -----------------------------------------------------------------

TEXTS = ["", "a  b", " a", "a ", None, "a\n b", "x \n y", "tab\t b", "\x1c a \x1d b", "it's  we'll 've <|endoftext|> x<|endoftext|> y", "  lead   multi  ",
         "1 2 3  4\r\n\r\n 5", "é è  ü", "中文 字 　 x", "a\x85 b \x85 c", "\U0001F600 \U0001F600​ a", "word " * 3000, " ", "\n",
         "end.\nNext, and; more: yes! no?\n\nWord's. 'll. x.\n y .z ,a a.,b a,1 \u00e9.\u00e9 \u2167, \u00b2. end.\n"]


def test_parts_encode_as_the_whole_text():
    e = tokens.Encoder(public_tokenizers.path(tokens.TOKENIZER))
    for some in (TEXTS, TEXTS[::-1], TEXTS):
        ids, to = e(some)
        want = [x.ids + [tokens.END_ID] for x in e.tokenizer.encode_batch([t or "" for t in some], add_special_tokens=False)]
        assert np.split(ids, to)[:-1] and [x.tolist() for x in np.split(ids, to)[:-1]] == want


def test_frequent_parts_are_encoded_once(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 60)
    e = tokens.Encoder(public_tokenizers.path(tokens.TOKENIZER))
    real, sent = e.tokenizer, []

    class Watched:
        def encode_batch_fast(self, texts, **how):
            sent.extend(texts)
            return real.encode_batch_fast(texts, **how)

    e.tokenizer = Watched()
    common = " ".join(f"kept{chr(97 + i)}" for i in range(20))
    for k in range(12):
        some = [f"{common} new{chr(97 + k)}{chr(97 + i)}" for i in range(20)]
        sent.clear()
        ids, to = e(some)
        assert [x.tolist() for x in np.split(ids, to)[:-1]] == [x.ids + [tokens.END_ID] for x in real.encode_batch(some)]
        assert sent and (k == 0 or not any("kept" in x for x in sent))


@pytest.mark.parametrize("seed,n,alphabet", [(0, 1, 3), (1, 50, 2), (2, 5000, 4), (3, 20_000, 300), (4, 3000, 1), (5, 30_000, 50_000)])
def test_grammar_round_trip(seed, n, alphabet):
    r = np.random.default_rng(seed)
    ids = r.integers(3, 3 + alphabet, n).astype(np.uint32)
    to = np.unique(np.append(r.integers(1, n + 1, 7), n))
    row = tokens.compress(ids, to)
    back, ends = tokens.decode(row)
    assert (back == ids).all() and (ends == to).all()
    for k, (a, b) in enumerate(zip([0, *to[:-1]], to, strict=True)):
        assert (tokens.decode_document(row, k) == ids[a:b]).all()
    terminals, pairs, _ = tokens._parts(row)
    lengths = tokens.expansion_lengths(len(terminals), pairs)[len(terminals):]
    assert (np.frombuffer(row["lengths"], "<u4") == lengths).all()
    assert all(len(tokens.expand(np.array([len(terminals) + k]), terminals, pairs)) == x for k, x in enumerate(lengths))


def test_random_access(spark):
    """A document, or a stretch of it, costs what it holds, not what its shard holds."""
    r = np.random.default_rng(6)
    words = [r.integers(3, 4000, r.integers(2, 9)).astype(np.uint32) for _ in range(3000)]
    docs = [np.concatenate([words[i] for i in r.zipf(1.3, 90) % 3000]) for _ in range(400)]
    ids, to = np.concatenate(docs), np.cumsum([len(d) for d in docs])
    row = tokens.compress(ids, to)
    pairs = np.frombuffer(row["rules"], "<u4").reshape(-1, 2)
    assert len(pairs) > 1000
    for k in (0, 7, 399):
        for lo, hi in ((0, None), (0, 0), (5, 6), (40, 200), (len(docs[k]) - 3, 10**9)):
            assert (tokens.decode_document(row, k, lo, hi) == docs[k][lo:hi]).all()
    s = np.frombuffer(row["symbols"], "<u4" if row["wide"] else "<u2").astype(np.int64)
    inside = np.concatenate([[True], np.ones(len(s) - 1, bool)])
    inside[np.asarray(row["symbols_to"])[:-1]] = False  # no pair spans two documents
    left = Counter(zip(s[:-1][inside[1:]].tolist(), s[1:][inside[1:]].tolist(), strict=True))
    assert max(n for (a, b), n in left.items() if a != b) < tokens.MIN_COUNT
    began = time.perf_counter()
    tokens.decode(row)
    whole, began = time.perf_counter() - began, time.perf_counter()
    for _ in range(20):
        tokens.decode_document(row, 7)
    assert (time.perf_counter() - began) / 20 < whole / 5


def brute_tokens(rows):
    t = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    out, start = [], 0
    for d, x in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, (r[1] or "").encode())):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_query(spark):
    got = sorted(tuple(r)[:4] for r in tokens.op1_token_ids(spark, SF).collect())
    assert got == brute_tokens([(r.doc_id, r.text) for r in documents(spark, SF).collect()])


def test_token_edges(spark, monkeypatch):
    monkeypatch.setattr(tokens, "SHARD_TOKENS", 64)
    rows = [*EDGE, *((100 + i, t) for i, t in enumerate(TEXTS))]
    got = sorted(tuple(r)[1:4] for r in tokens.stored(table(spark, rows)).collect())
    assert got == [r[1:] for r in brute_tokens(rows)]
    assert tokens.stored(table(spark, [])).count() == 0


# --- preference pairs -------------------------------------------------------------

def render(turns):
    return "".join(f"<|{r}|>\n{t}<|end|>\n" for r, t in turns)


def test_preference_pairs(spark):
    a = [("user", "q"), ("assistant", "yes"), ("user", "é\U0001F600"), ("assistant", "fine"), ("user", "ok")]
    b = [("user", "q"), ("assistant", "yes"), ("user", "é\U0001F600"), ("assistant", "no")]
    rows = [(1, a, b), (2, a, a), (3, a, None), (4, [], []), (5, b, a[1:])]
    df = spark.createDataFrame(rows, "id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>").selectExpr("*", "'x' as prompt", "'y' as k")
    got = {r.id: r for r in preference.format_pairs(df).collect()}
    for i, x, y in rows:
        x, y = x or [], y or []
        k = next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
        r = got[i]
        assert (r.n_prompt_turns, r.prompt, r.chosen, r.rejected) == (k, render(x[:k]), render(x[k:]), render(y[k:]))
        for text, spans, rest in ((r.chosen, r.chosen_train, x[k:]), (r.rejected, r.rejected_train, y[k:])):
            cut = [text[int(s.split(":")[0]) : int(s.split(":")[1])] for s in spans.split(",") if s]
            assert cut == [f"{t}<|end|>\n" for role, t in rest if role == "assistant"]
    assert got[1].k == "y"


def test_preference_edges(spark):
    turns = spark.createDataFrame([(1, 0, None, None), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (None, None, "user", "x"), (2, 0, "user", "long " * 20_000)],
                                  "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as turns")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in preference.gather(turns).collect()}
    assert got == {1: [("unknown", ""), ("assistant", "a"), ("assistant", "a")], None: [("user", "x")], 2: [("user", "long " * 20_000)]}
    assert preference.gather(turns.where("false")).count() == 0
