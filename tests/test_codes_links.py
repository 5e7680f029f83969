"""Dates, release tags, asset suffix rule, link scan, archive grouping."""

from skytrace.functions import codes
from skytrace.sources.links import asset_links
from skytrace.sources.listing import archive_groups


def test_dates(spark):
    df = spark.createDataFrame([("2024.12.07",), ("2024.2.3",), ("2024.02.30",), ("2024.13.01",), ("x",)], "d STRING")
    assert [r[0] for r in df.select(codes.is_valid_date("d")).collect()] == [True, False, False, False, False]
    r = df.select(codes.release_tag("d"), codes.release_repo("d")).first()
    assert r[0] == "v2024.12.07-planes-readsb-prod-0" and r[1] == "globe_history_2024"


def test_suffix_rule(spark):
    names = ["a.tar", "a.tar.aa", "a.tar.gz", "a.zip", "a.tar.a", "a.tarball"]
    df = spark.createDataFrame([(n,) for n in names], "n STRING")
    assert [r[0] for r in df.select(codes.accepted_asset("n")).collect()] == [True, True, False, False, False, False]


def test_link_scan(spark):
    html = ('<a href="/o/r/releases/download/v1/x.tar.aa">a</a> <a href="/o/r/releases/download/v1/x.tar.gz">b</a>'
            '<a href=\'/o/r/releases/download/V1/x.tar\'>c</a><a href="/o/r/releases/download/v1/x.tar.aa">dup</a>'
            '<a href="https://e/v1/y.tar">abs</a><a href="/other/z.tar">no tag</a>')
    pages = spark.createDataFrame([(1, html)], "page_id BIGINT, html STRING")
    got = sorted(r.asset_url for r in asset_links(pages, "v1").collect())
    assert got == ["https://github.com/o/r/releases/download/V1/x.tar",
                   "https://github.com/o/r/releases/download/v1/x.tar.aa"]


def test_archive_groups(spark):
    names = ["b.tar.ab", "b.tar.aa", "a.tar", "c.tar.gz", "d.tar.aa", "e.zip"]
    files = spark.createDataFrame([(f"dl/{n}", n) for n in names], "path STRING, name STRING")
    g = {r.archive: r for r in archive_groups(files).collect()}
    assert set(g) == {"a", "b", "d"}
    assert g["b"].parts == "dl/b.tar.aa,dl/b.tar.ab" and g["b"].mode == "multipart"
    assert g["a"].mode == "standalone" and g["d"].mode == "multipart"
