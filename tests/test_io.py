"""Sources and sinks: trace files, gzip buckets, split tars, CSV, hourly partitions, zones."""

import gzip
import io
import os
import tarfile

from conftest import SF_SMALL
from pyspark.sql import functions as F

from skytrace.operators.flatten import flatten_docs
from skytrace.plans import queries as Q
from skytrace.sinks.files import read_hourly, write_features, write_hourly, write_windows
from skytrace.sources import archives
from skytrace.sources.trace_docs import read_points_csv, read_trace_docs
from skytrace.sources.zones import read_zone_files
from skytrace.plans.params import WINDOWS, ZONES_DMS


def _sample_docs(spark, n=40):
    return Q.docs(spark, SF_SMALL).orderBy("path").limit(n).collect()


def _write_json_tree(root, docs, gz=False):
    for d in docs:
        icao = d.path.split("trace_full_")[1].split(".json")[0]
        sub = os.path.join(root, d.source_date, "extracted", "traces", icao[-2:]) if gz else os.path.join(root, d.source_date, "json")
        os.makedirs(sub, exist_ok=True)
        data = d.content.encode()
        with open(os.path.join(sub, f"trace_full_{icao}.json"), "wb") as f:
            f.write(gzip.compress(data) if gz else data)


def test_trace_files_equal_in_memory_docs(spark, tmp_dir):
    docs = _sample_docs(spark)
    _write_json_tree(tmp_dir, docs)
    dates = sorted({d.source_date for d in docs})
    files = read_trace_docs(spark, [os.path.join(tmp_dir, d, "json") for d in dates])
    assert files.count() == len(docs)
    assert set(r.source_date for r in files.collect()) == set(dates)
    a = flatten_docs(files).drop("path").collect()
    b = flatten_docs(spark.createDataFrame(docs)).drop("path").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_gzip_buckets(spark, tmp_dir):
    docs = _sample_docs(spark, 20)
    _write_json_tree(tmp_dir, docs, gz=True)
    d0 = docs[0].source_date
    bad = os.path.join(tmp_dir, d0, "extracted", "traces", "zz")
    os.makedirs(bad)
    open(os.path.join(bad, "trace_full_broken.json"), "wb").write(b"not gzip")
    os.makedirs(os.path.join(tmp_dir, d0, "extracted", "traces", "abc"))
    open(os.path.join(tmp_dir, d0, "extracted", "traces", "abc", "trace_full_x.json"), "wb").write(gzip.compress(b"{}"))
    from skytrace.sources.listing import list_trace_buckets

    listed = list_trace_buckets(spark, os.path.join(tmp_dir, d0, "extracted", "traces"))
    assert {r.bucket for r in listed.collect()} >= {"zz"} and listed.where("bucket = 'abc'").count() == 0
    g = archives.read_gzip_traces(spark, os.path.join(tmp_dir, d0, "extracted", "traces"))
    st = {r.path.rsplit("/", 1)[1]: r.status for r in g.collect()}
    assert st["trace_full_broken.json"].startswith("error")
    assert "trace_full_x.json" not in st  # three-character bucket ignored
    n_ok = sum(1 for d in docs if d.source_date == d0)
    assert sum(1 for s in st.values() if s == "ok") == n_ok


def test_split_tar_members(spark, tmp_dir):
    docs = _sample_docs(spark, 12)
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as tar:
        for d in docs:
            data = gzip.compress(d.content.encode())
            icao = d.path.split("trace_full_")[1].split(".json")[0]
            ti = tarfile.TarInfo(f"./traces/{icao[-2:]}/trace_full_{icao}.json")
            ti.size = len(data)
            tar.addfile(ti, io.BytesIO(data))
    blob = buf.getvalue()
    dl = os.path.join(tmp_dir, "2024.01.02", "downloaded")
    os.makedirs(dl)
    cut = [0, 1500, 4097, len(blob)]  # parts cut at odd offsets, inside members
    parts = []
    for i, s in enumerate(["aa", "ab", "ac"]):
        p = os.path.join(dl, f"v2024.01.02-planes-readsb-prod-0.tar.{s}")
        open(p, "wb").write(blob[cut[i]:cut[i + 1]])
        parts.append(p)
    groups = spark.createDataFrame([("v2024.01.02-planes-readsb-prod-0", ",".join(parts))], "archive STRING, parts STRING")
    idx = archives.tar_member_index(groups)
    assert idx.where("status = 'ok'").count() == len(docs)
    got = archives.tar_trace_docs(idx)
    contents = sorted(r.content for r in got.collect())
    assert contents == sorted(d.content for d in docs)


def test_hourly_sink_roundtrip_and_stale_hours(spark, tmp_dir):
    p = Q.points(spark, SF_SMALL)
    base = os.path.join(tmp_dir, "hourly")
    written = write_hourly(p, base)
    back = read_hourly(spark, base)
    assert back.count() == p.count()
    assert len(written) == p.select("source_date", "hour").distinct().count()
    from skytrace.sinks.files import hourly_file_stats

    fs = hourly_file_stats(spark, base)
    assert fs.agg(F.sum("n_rows")).first()[0] == p.count()
    assert fs.where("n_files < 1 OR n_bytes <= 0 OR size_mb < 0").count() == 0
    # Re-ingest one date without its hour-0 rows: that hour folder must go.
    d = p.select("source_date").orderBy("source_date").first()[0]
    h0 = p.where(F.col("source_date") == d).select(F.min("hour")).first()[0]
    write_hourly(p.where((F.col("source_date") == d) & (F.col("hour") != h0)), base)
    back = read_hourly(spark, base)
    assert back.where((F.col("source_date") == d) & (F.col("hour") == h0)).count() == 0
    assert back.where(F.col("source_date") != d).count() == p.where(F.col("source_date") != d).count()
    # Partition pruning on the stored table.
    plan = back.where("hour >= 1 AND hour < 4")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "hour" in plan


def test_csv_sink_and_typed_read(spark, tmp_dir):
    p = Q.points(spark, SF_SMALL)
    base = os.path.join(tmp_dir, "csv")
    write_hourly(p, base, fmt="csv")
    back = read_points_csv(spark, base + "/*/*/*/*.csv", projected=["datetime_utc", "icao", "latitude", "longitude"])
    assert back.count() == p.count()
    assert back.schema["icao"].dataType.simpleString() == "string"
    assert back.where("datetime_utc IS NULL").count() == 0


def test_window_and_feature_sinks(spark, tmp_dir):
    v = Q.valid(spark, SF_SMALL)
    write_windows(v, WINDOWS, os.path.join(tmp_dir, "win"))
    w = spark.read.parquet(os.path.join(tmp_dir, "win"))
    assert set(r[0] for r in w.select("window").distinct().collect()) <= {"0100-0400", "1100-1300"}
    write_windows(v, WINDOWS, os.path.join(tmp_dir, "wincsv"), fmt="csv")
    c = spark.read.option("header", True).csv(os.path.join(tmp_dir, "wincsv"))
    assert c.columns[:2] == ["datetime_utc", "icao"] and c.count() == w.count()
    assert c.where(~F.col("datetime_utc").endswith("+00:00")).count() == 0
    from skytrace.operators.tracks import track_features

    write_features(track_features(v, Q.zones(spark)), os.path.join(tmp_dir, "geo"))
    t = spark.read.text(os.path.join(tmp_dir, "geo"))
    assert t.count() > 0 and t.where(~F.col("value").startswith('{"type":"Feature"')).count() == 0


def test_zone_files(spark, tmp_dir):
    for name, text in ZONES_DMS.items():
        open(os.path.join(tmp_dir, f"{name}.csv"), "w").write(text)
    z = read_zone_files(spark, [os.path.join(tmp_dir, f"{n}.csv") for n in ZONES_DMS])
    assert sorted(r.zone for r in z.where("valid").collect()) == sorted(ZONES_DMS)
