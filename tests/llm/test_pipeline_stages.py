"""The pipeline's stages, each on its own input, and the registered queries."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as P
from skytrace.llm import queries
from skytrace.llm.common import documents

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
EDGE = [(1, "", "en", "s", 0), (2, None, None, None, None), (None, "the cat and the dog", "en", "s", 19), (3, "the cat and the dog", None, "s", 19),
        (3, "the cat and the dog", None, "s", 19), (4, "1 2 3", "en", "t", 5), (5, "the long text " * 30_000, "en", "t", 9), (6, "der hund und die katze", "de", None, 3)]


def edge(spark, rows=EDGE):
    return spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'x' as kept", "'y' as component_id", "'z' as size", "'w' as item_id")


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["language", "neardup", "decontaminate", "mix", "tokens"]
    assert P.ORACLE_SQL is None


@pytest.mark.parametrize("name,stage", P.STAGES)
@pytest.mark.parametrize("rows", [EDGE, []], ids=["edge", "empty"])
def test_stage_takes_edge_cases(spark, name, stage, rows):
    out = stage(spark, edge(spark, rows), SF)
    if name != "tokens":
        assert out.columns == edge(spark).columns
    assert len(out.collect()) <= 2 * len(rows)


def test_language_stage_rejects_texts_without_letters(spark):
    left = Counter(r.doc_id for r in P.language_stage(spark, edge(spark), SF).collect())
    assert left == Counter([None, 3, 3, 5, 6])


def test_neardup_stage_keeps_one_of_each_group(spark):
    left = sorted((r.doc_id is not None, r.doc_id or 0) for r in P.neardup_stage(spark, edge(spark), SF).collect())
    assert left == [(False, 0), (True, 1), (True, 2), (True, 3), (True, 4), (True, 5), (True, 6)]


def test_run_equals_its_stages_by_brute_force(spark):
    """Every row that a stage drops, and the tokens of what is left."""
    from test_corpus_operators import brute_components

    docs = documents(spark, SF)
    rows = [tuple(r) for r in docs.collect()]
    after = {}
    for name, stage in P.STAGES[:-1]:
        docs = P.written(stage(spark, docs, SF), name)
        after[name] = sorted(tuple(r) for r in docs.collect())
    assert after["language"] == sorted(r for r in rows if any(c.isalpha() for c in r[1] or ""))
    root = brute_components([r[:2] for r in after["language"]], P.SIMILAR)
    assert after["neardup"] == [r for r in after["language"] if root[r[0]] == r[0]]
    flat = lambda t: " ".join(t.split())
    items = [flat(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert after["decontaminate"] == [r for r in after["neardup"] if not any(i in flat(r[1]) for i in items)]
    assert set(after["mix"]) <= set(after["decontaminate"])
    assert max(Counter(after["mix"]).values()) <= 2
    total = sum(len(r[1].split()) for r in after["decontaminate"])
    assert abs(sum(len(r[1].split()) for r in after["mix"]) - 1.5 * total) < 0.02 * total
    t, start, want = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0, []
    for r in after["mix"]:
        ids = np.array([*t.encode(r[1], add_special_tokens=False).ids, 2], "<u4")
        want.append((r[0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(r)[:4] for r in P.run(spark, SF).collect()) == sorted(want)


def test_registered_queries():
    names = set(E.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    r = con.sql(queries.ORACLE_SQL[name])
    df = queries.QUERIES[name](spark, SF)
    order = sorted(df.columns)
    assert sorted(r.columns) == order
    mine = Counter(tuple(x[c] for c in order) for x in df.collect())
    assert mine == Counter(tuple(x[r.columns.index(c)] for c in order) for x in r.fetchall())
