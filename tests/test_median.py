"""Distributed exact median equals the interpolated median of the values."""

import random
import statistics

import pytest

from skytrace.operators.tracks import exact_median


def test_exact_median_matches_python(spark):
    rnd = random.Random(3)
    rows = []
    for g, n in [("a", 1), ("b", 2), ("c", 1001), ("d", 4000)]:
        for _ in range(n):
            rows.append((g, round(rnd.uniform(1.0, 3.0), 4)))
    rows += [("e", 2.0)] * 500 + [("e", 2.01)] * 500  # ties across a bin edge
    df = spark.createDataFrame(rows, "g STRING, v DOUBLE")
    got = {r.g: (r.n, r.median) for r in exact_median(df, ["g"], "v").collect()}
    for g in "abcde":
        vals = sorted(v for k, v in rows if k == g)
        lo, hi = vals[(len(vals) - 1) // 2], vals[len(vals) // 2]
        assert got[g] == (len(vals), 0.5 * lo + 0.5 * hi)
        assert abs(got[g][1] - statistics.median(vals)) < 1e-12


def _check(df, rows, exact_rows):
    got = {r.g: (r.n, r.median) for r in exact_median(df, ["g"], "v", exact_rows).collect()}
    by = {}
    for g, v in rows:
        if v is not None:
            by.setdefault(g, []).append(v)
    assert got == {g: (len(vs), 0.5 * sorted(vs)[(len(vs) - 1) // 2] + 0.5 * sorted(vs)[len(vs) // 2]) for g, vs in by.items()}


@pytest.mark.parametrize("exact_rows", [1, 40, 1_000_000])
def test_brackets_are_narrowed(spark, exact_rows):
    rnd = random.Random(9)
    rows = [("wide", rnd.uniform(-5e9, 5e9)) for _ in range(4000)]
    rows += [("half", 7.25)] * 3000 + [("half", rnd.uniform(0, 1e9)) for _ in range(1500)] + [("half", rnd.uniform(-1e9, 0)) for _ in range(1500)]
    rows += [("edge", 1.0)] * 1000 + [("edge", 2.0)] * 1000  # the two middle values differ
    rows += [("one", 3.5)] * 2000 + [("tiny", 1.0), ("tiny", 4.0), ("null", None)]
    rows += [("skew", float(i**5)) for i in range(3001)]
    rnd.shuffle(rows)
    _check(spark.createDataFrame(rows, "g STRING, v DOUBLE"), rows, exact_rows)


def test_median_of_nothing(spark):
    assert exact_median(spark.createDataFrame([], "g STRING, v DOUBLE"), ["g"], "v").count() == 0
