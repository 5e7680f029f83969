"""File pipeline: three source layouts → one hour-partitioned table → queries."""

import gzip
import io
import os
import tarfile

from conftest import SF_SMALL
from pyspark.sql import functions as F

from skytrace import pipeline
from skytrace.operators.flatten import flatten_docs
from skytrace.plans import queries as Q
from skytrace.plans.params import WINDOWS


def test_ingest_three_layouts_then_query(spark, tmp_dir):
    docs = Q.docs(spark, SF_SMALL).collect()
    dates = sorted({d.source_date for d in docs})[:3]
    plain, gz, tar = dates
    base = os.path.join(tmp_dir, "data")
    for d in docs:
        icao = d.path.split("trace_full_")[1].split(".json")[0]
        data = d.content.encode()
        if d.source_date == plain:
            folder = os.path.join(base, plain, "json")
            os.makedirs(folder, exist_ok=True)
            open(os.path.join(folder, f"trace_full_{icao}.json"), "wb").write(data)
        elif d.source_date == gz:
            folder = os.path.join(base, gz, "extracted", "traces", icao[-2:])
            os.makedirs(folder, exist_ok=True)
            open(os.path.join(folder, f"trace_full_{icao}.json"), "wb").write(gzip.compress(data))
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as t:
        for d in docs:
            if d.source_date != tar:
                continue
            icao = d.path.split("trace_full_")[1].split(".json")[0]
            blob = gzip.compress(d.content.encode())
            ti = tarfile.TarInfo(f"traces/{icao[-2:]}/trace_full_{icao}.json")
            ti.size = len(blob)
            t.addfile(ti, io.BytesIO(blob))
    raw = buf.getvalue()
    dl = os.path.join(base, tar, "downloaded")
    os.makedirs(dl)
    half = len(raw) // 2 + 7
    open(os.path.join(dl, f"v{tar}-planes-readsb-prod-0.tar.aa"), "wb").write(raw[:half])
    open(os.path.join(dl, f"v{tar}-planes-readsb-prod-0.tar.ab"), "wb").write(raw[half:])

    table = os.path.join(tmp_dir, "points")
    st = {r.source_date: r for r in pipeline.ingest(spark, base, dates, table).collect()}
    want = flatten_docs(spark.createDataFrame([d for d in docs if d.source_date in dates]))
    got = spark.read.parquet(table)
    assert got.count() == want.count()
    assert set(st) == set(dates) and sum(r.total_rows for r in st.values()) == want.count()

    z = pipeline.window_zone_counts(spark, table, dates, WINDOWS, Q.zones(spark))
    plan = z._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    ref = {(r.source_date, r.window, r.zone): r.unique_aircraft for r in Q.q_zone_unique_aircraft(spark, SF_SMALL)
           .where(F.col("source_date").isin(*dates)).collect()}
    assert {(r.source_date, r.window, r.zone): r.unique_aircraft for r in z.collect()} == ref
