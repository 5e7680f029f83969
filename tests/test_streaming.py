"""Incremental ingest equals batch; hourly stream counts equal batch counts."""

import os
from collections import Counter

from conftest import SF_SMALL
from pyspark.sql import functions as F

from skytrace.operators.flatten import flatten_docs
from skytrace.plans import queries as Q
from skytrace.streaming.ingest import read_hourly_counts, read_late_rows, start_hourly_counts, start_ingest, start_late_rows, stream_points


def test_stream_ingest_equals_batch(spark, tmp_dir):
    docs = Q.docs(spark, SF_SMALL).collect()
    src = os.path.join(tmp_dir, "src")
    for d in docs:
        folder = os.path.join(src, d.source_date, "json")
        os.makedirs(folder, exist_ok=True)
        name = d.path.rsplit("/", 1)[1]
        open(os.path.join(folder, name), "w").write(d.content)
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    q = start_ingest(stream_points(spark, src, max_files_per_trigger=50), out, ckpt)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    want = flatten_docs(spark.createDataFrame(docs))
    assert got.count() == want.count()
    cols = ["icao", "event_us", "latitude", "longitude", "altitude_ft", "hour", "source_date"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    # A second availableNow run finds nothing new (checkpointed progress).
    q2 = start_ingest(stream_points(spark, src), out, ckpt)
    q2.awaitTermination(300)
    assert spark.read.parquet(out).count() == want.count()


HOUR = 3_600_000_000


def land(spark, folder, rows):
    spark.createDataFrame([(h * HOUR + m * 60_000_000,) for h, m in rows], "event_us BIGINT").coalesce(1).write.mode("append").parquet(folder)


def run_both(spark, base):
    stream = spark.readStream.schema("event_us BIGINT").parquet(f"{base}/land")
    counts, late = start_hourly_counts(stream, f"{base}/counts", f"{base}/c1"), start_late_rows(stream, f"{base}/late", f"{base}/c2")
    counts.awaitTermination(300)
    late.awaitTermination(300)
    return [s.numRowsTotal for p in counts.recentProgress for s in p.stateOperators]


def test_late_rows_are_set_aside_and_state_is_dropped(spark, tmp_dir):
    base, kept = tmp_dir, []
    slices = [
        [(0, 5), (0, 50), (1, 10), (2, 30)],        # watermark after it: 01:30
        [(1, 59), (0, 59), (2, 40), (5, 0)],        # 00:59 is late, 01:59 is not; then 04:00
        [(3, 10), (4, 1), (1, 1), (9, 30), (9, 31)],  # 03:10 and 01:01 are late; then 08:31
        [(h, 0) for h in range(10, 60)],
        [(8, 0), (59, 30), (60, 0)],
    ]
    for rows in slices:
        land(spark, f"{base}/land", rows)
        kept += run_both(spark, base)[-1:]
    got = {r.window_start_us // HOUR: r.n_rows for r in read_hourly_counts(spark, f"{base}/counts").collect()}
    late = sorted(r.event_us // 60_000_000 for r in read_late_rows(spark, f"{base}/late").collect())
    assert late == [59, 61, 190, 480]
    every = [h * 60 + m for rows in slices for h, m in rows]
    for m in late:
        every.remove(m)
    assert got == Counter(m // 60 for m in every)
    assert max(kept) <= 3  # windows still open after each run, of 61 in all


def test_hourly_stream_counts(spark, tmp_dir):
    """Rows in the order of time: none is late, and all hours are counted."""
    points = Q.points(spark, SF_SMALL)
    points.select("event_us").write.parquet(f"{tmp_dir}/land")
    run_both(spark, tmp_dir)
    got = {r.window_start_us: r.n_rows for r in read_hourly_counts(spark, f"{tmp_dir}/counts").collect()}
    want = {r[0]: r[1] for r in points.groupBy((F.col("event_us") - F.col("event_us") % HOUR)).count().collect()}
    assert got == want and read_late_rows(spark, f"{tmp_dir}/late").count() == 0
