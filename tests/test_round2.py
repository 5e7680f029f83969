"""Document identity, whole tracks, valid features, sinks that replace their dates."""

import gzip
import io
import json
import os
import tarfile
from collections import Counter

import duckdb
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from skytrace.operators import movement as mv
from skytrace.operators import stats, tracks
from skytrace.operators.flatten import flatten_docs
from skytrace.pipeline import ingest
from skytrace.plans import oracle, queries as Q
from skytrace.plans import params as P
from skytrace.session import TABLES, read_table
from skytrace.sinks.files import append_hourly, read_hourly, read_windows, vacuum, write_hourly, write_windows
from skytrace.sources.listing import archive_groups
from skytrace.sources.trace_docs import date_of_path
from skytrace.streaming.ingest import start_ingest, stream_points
from skytrace.sources.zones import zones_from_pairs


def doc(icao, day, entries):
    return json.dumps({"icao": icao, "timestamp": day, "trace": entries})


def entry(s, lat=1.5, lon=104.5, flags=0, alt=1000):
    return [s, lat, lon, alt, 100.0, 90.0, flags, 0, None, "adsb_icao", None, None, None, None]


DAY = 1739000000.0


@pytest.mark.parametrize("name", ["tracks", "track_features", "zone_trajectories"])
def test_several_parts_per_track(spark, monkeypatch, name):
    monkeypatch.setattr(P, "TRACK_SEGMENT_POINTS", 2)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = Q.QUERIES[name](spark, SF_SMALL)
    r = con.sql(oracle.oracle_sql()[name])
    order = sorted(df.columns)
    assert df.where("segment > 0").count() > 0
    mine = Counter(tuple(str(x[c]) for c in order) for x in df.collect())
    assert mine == Counter(tuple(str(x[r.columns.index(c)]) for c in order) for x in r.fetchall())


def test_parts_draw_the_whole_track(spark):
    p = flatten_docs(spark.createDataFrame([("a", "2025.02.08", doc("7380e5", DAY, [entry(i, lat=i / 10) for i in range(1, 8)]))], "path STRING, source_date STRING, content STRING"))
    for size in (1, 2, 3, 7, 100):
        parts = [r.path_text.split(",") for r in tracks.tracks(p, size).orderBy("segment").collect()]
        assert all(a[-1] == b[0] for a, b in zip(parts, parts[1:], strict=False))
        assert sum(len(x) for x in parts) - (len(parts) - 1) == 7


def test_every_feature_parses(spark):
    z = zones_from_pairs(spark, {'area "A" \\ b': P.ZONES_DMS[next(iter(P.ZONES_DMS))]} if isinstance(P.ZONES_DMS, dict) else [('area "A" \\ b', P.ZONES_DMS[0][1])])
    rows = tracks.track_features(Q.valid(spark, SF_SMALL), z, 2).collect()
    for r in rows:
        f = json.loads(r.feature)
        if f["geometry"]["type"] == "LineString":
            assert len(f["geometry"]["coordinates"]) >= 2
    assert 'area "A" \\ b' in {json.loads(r.feature)["properties"].get("name") for r in rows}


def test_leg_mark_without_position(spark):
    p = flatten_docs(spark.createDataFrame([("a", "2025.02.08", doc("7380e5", DAY, [
        entry(1), entry(2, lat=None, lon=None, flags=2), entry(3, lat=2.5), entry(4, lat=None, lon=None)]))], "path STRING, source_date STRING, content STRING"))
    got = [(r.leg, r.n_points, r.start_lat, r.end_lat) for r in mv.legs(p).orderBy("leg").collect()]
    assert got == [(0, 1, 1.5, 1.5), (1, 3, 2.5, 2.5)]


def test_lines_of_one_file_are_documents(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/land/source_date=2025.02.08")
    with open(f"{tmp_dir}/land/source_date=2025.02.08/x.txt", "w") as f:
        f.write("\n".join(doc(i, DAY, [entry(1), entry(2)]) for i in ("aaaaaa", "bbbbbb", "cccccc")))
    table = f"{tmp_dir}/table"
    start_ingest(stream_points(spark, f"{tmp_dir}/land", lines=True), table, f"{tmp_dir}/ckpt").awaitTermination()
    r = stats.multi_date_counts(read_hourly(spark, table)).collect()
    assert [(x.source_date, x.n_rows, x.n_docs, x.n_aircraft) for x in r] == [("2025.02.08", 6, 3, 3)]


def points(spark, date, icao, seconds):
    d = [(f"{date}-{icao}", date, doc(icao, DAY, [entry(s) for s in seconds]))]
    return flatten_docs(spark.createDataFrame(d, "path STRING, source_date STRING, content STRING"))


def rows(spark, table):
    return sorted((r.source_date, r.hour, r.icao, r.seq) for r in read_hourly(spark, table).collect())


def test_stream_then_batch_in_one_table(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    append_hourly(points(spark, "2025.02.08", "aaaaaa", [1]), table, "s1-0")
    append_hourly(points(spark, "2025.02.08", "bbbbbb", [1]), table, "s1-1")
    write_hourly(points(spark, "2025.02.09", "cccccc", [1, 2, 3]), table)
    assert len(rows(spark, table)) == 5
    append_hourly(points(spark, "2025.02.08", "bbbbbb", [1]), table, "s1-1")  # the batch again
    assert len(rows(spark, table)) == 5
    # A batch run of the streamed date leaves its streamed rows, and the other way round.
    write_hourly(points(spark, "2025.02.08", "dddddd", [1, 2]), table)
    write_hourly(points(spark, "2025.02.08", "dddddd", [1, 2, 7200]), table)
    assert Counter(r[2] for r in rows(spark, table)) == {"aaaaaa": 1, "bbbbbb": 1, "cccccc": 3, "dddddd": 3}
    # The repeated batch has rows at another date and hour now: its old ones go.
    append_hourly(points(spark, "2025.02.07", "bbbbbb", [7200]), table, "s1-1")
    assert sorted(r[:1] + r[2:3] for r in rows(spark, table) if r[2] in ("aaaaaa", "bbbbbb")) == [("2025.02.07", "bbbbbb"), ("2025.02.08", "aaaaaa")]
    n = len(rows(spark, table))
    assert vacuum(spark, table) == 3 and len(rows(spark, table)) == n and vacuum(spark, table) == 0


def test_a_failed_run_is_not_seen(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    write_hourly(points(spark, "2025.02.08", "aaaaaa", [1]), table)
    bad = points(spark, "2025.02.08", "bbbbbb", [1, 2]).withColumn("seq", F.when(F.col("seq") == 1, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("seq")))
    with pytest.raises(Exception, match="stop"):
        write_hourly(bad, table)
    assert [r[2] for r in rows(spark, table)] == ["aaaaaa"]


def test_other_runs_are_pruned(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    for _ in range(3):
        write_hourly(points(spark, "2025.02.08", "aaaaaa", [1, 2]), table)
    plan = read_hourly(spark, table)._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and len(rows(spark, table)) == 2


def test_hourly_run_replaces_its_dates(spark, tmp_dir):
    table = f"{tmp_dir}/t"
    both = points(spark, "2025.02.08", "aaaaaa", [1, 7200]).unionByName(points(spark, "2025.02.09", "bbbbbb", [1]))
    write_hourly(both, table)
    left = points(spark, "2025.02.08", "aaaaaa", [1])
    assert len(write_hourly(left, table)) == 1
    assert [r[0] for r in rows(spark, table)] == ["2025.02.08", "2025.02.09"]
    write_hourly(left, table, dates=["2025.02.08", "2025.02.09"])
    assert [r[0] for r in rows(spark, table)] == ["2025.02.08"]
    vacuum(spark, table)
    assert [r[0] for r in rows(spark, table)] == ["2025.02.08"]


def test_window_run_replaces_its_dates(spark, tmp_dir):
    base = f"{tmp_dir}/w"
    p = points(spark, "2025.02.08", "aaaaaa", [1, 7200])
    hours = sorted(r.hour for r in p.collect())
    wins = [("a", hours[0], hours[0] + 1), ("b", hours[1], hours[1] + 1)]
    write_windows(p, wins, base)
    write_windows(p, wins[1:], base)
    assert [r[0] for r in read_windows(spark, base).select("window").collect()] == ["b"]
    write_windows(p.where("false"), wins, base, dates=["2025.02.08"])
    assert read_windows(spark, base).count() == 0


def test_date_is_the_last_date_folder(spark):
    paths = ["file:/b/2024.01.01-run/2025.02.08/json/x.json", "s/2024.01.01/2025.02.08/json/x.json", "l/source_date=2025.02.08/x.txt", "a/2025.02.08"]
    got = [r[0] for r in spark.createDataFrame([(p,) for p in paths], "p string").select(date_of_path(F.col("p"))).collect()]
    assert got == ["2025.02.08"] * 3 + [""]


def test_archives_of_two_dates(spark):
    files = spark.createDataFrame([(f"b/{d}/downloaded/planes.tar", "planes.tar") for d in ("2025.02.08", "2025.02.09")], "path STRING, name STRING")
    assert sorted(r.parts for r in archive_groups(files).collect()) == ["b/2025.02.08/downloaded/planes.tar", "b/2025.02.09/downloaded/planes.tar"]


def test_ingest_keeps_what_it_cannot_read(spark, tmp_dir):
    good = gzip.compress(doc("aaaaaa", DAY, [entry(1)]).encode())
    for d in ("2025.02.08", "2025.02.09"):
        os.makedirs(f"{tmp_dir}/{d}/downloaded")
        with tarfile.open(f"{tmp_dir}/{d}/downloaded/planes.tar", "w") as tar:
            info = tarfile.TarInfo("./traces/aa/trace_full_aaaaaa.json")
            info.size = len(good)
            tar.addfile(info, io.BytesIO(good))
    with open(f"{tmp_dir}/2025.02.08/downloaded/broken.tar", "wb") as f:
        f.write(b"no archive" * 100)
    bucket = f"{tmp_dir}/2025.02.08/extracted/traces/bb"
    os.makedirs(bucket)
    for name, data in (("good", gzip.compress(doc("bbbbbb", DAY, [entry(1)]).encode())), ("bad", b"no gzip")):
        with open(f"{bucket}/trace_full_{name}.json", "wb") as f:
            f.write(data)
    r = {x.source_date: x for x in ingest(spark, tmp_dir, ["2025.02.08", "2025.02.09"], f"{tmp_dir}/table").collect()}
    assert (r["2025.02.08"].n_docs, r["2025.02.08"].failed_docs) == (4, 2)
    assert (r["2025.02.09"].n_docs, r["2025.02.09"].failed_docs) == (1, 0)
    assert read_hourly(spark, f"{tmp_dir}/table").count() == 3


def test_grown_source_is_stored_again(spark, tmp_dir):
    ev = read_table(spark, SF_SMALL, "events")
    ev.limit(50).write.parquet(f"{tmp_dir}/events.parquet")
    few, before = Q.points(spark, tmp_dir).count(), Q.key_stats(spark, tmp_dir)
    ev.write.mode("append").parquet(f"{tmp_dir}/events.parquet")
    assert Q.points(spark, tmp_dir).count() > few
    assert Q.key_stats(spark, tmp_dir) > before


def test_stream_counts_of_a_folder_of_parts(spark, tmp_dir):
    read_table(spark, SF_SMALL, "events").repartition(3).write.parquet(f"{tmp_dir}/events.parquet")
    whole = sum(r.n_rows for r in Q.QUERIES["stream_hourly_counts"](spark, SF_SMALL).collect())
    assert sum(r.n_rows for r in Q.QUERIES["stream_hourly_counts"](spark, tmp_dir).collect()) == whole > 0
