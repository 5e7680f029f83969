"""Z-order layout, page skipping, and sketches of distinct aircraft."""

import random

from conftest import SF_SMALL
from pyspark.sql import functions as F

from skytrace.functions.geo import z_order
from skytrace.operators import movement as mv
from skytrace.operators import sketches
from skytrace.operators.spatial import unique_aircraft_in_zones, zone_join
from skytrace.operators.windows import tag_windows
from skytrace.plans import queries as Q
from skytrace.plans.store import write_clustered


def test_z_order_bits(spark):
    r = random.Random(2)
    pts = [(r.uniform(-90, 90), r.uniform(-180, 180)) for _ in range(200)] + [(-90.0, -180.0), (90.0, 180.0), (0.0, 0.0)]
    rows = spark.createDataFrame(pts, "lat DOUBLE, lon DOUBLE").select("lat", "lon", z_order("lat", "lon").alias("z")).collect()
    for x in rows:
        lat, lon = (min(65535, int((v - lo) * 65536 / span)) for v, lo, span in ((x.lat, -90, 180), (x.lon, -180, 360)))
        assert x.z == sum(((lon >> i & 1) << 2 * i) | ((lat >> i & 1) << 2 * i + 1) for i in range(16))
    assert spark.createDataFrame([(None, 1.0)], "lat DOUBLE, lon DOUBLE").select(z_order("lat", "lon")).first()[0] is None


def scanned(df):
    """Rows that the scan of a plan gave out."""
    ex = df._jdf.queryExecution()
    df._jdf.queryExecution().executedPlan().executeCollect()

    def rows(node):
        if node.children().isEmpty():
            inner = getattr(node, "executedPlan", None)
            m = node.metrics().get("numOutputRows")
            return m.get().value() if m.isDefined() else 0
        return sum(rows(node.children().apply(i)) for i in range(node.children().size()))

    return rows(ex.executedPlan())


def test_region_filter_skips_pages(spark, tmp_dir):
    p = Q.valid(spark, "/root/testdata/sf0.01").where("hour < 3").select("hour", "icao", "latitude", "longitude")
    write_clustered(p, f"{tmp_dir}/z", ("hour",), (z_order("latitude", "longitude"),), page_rows=50)
    write_clustered(p, f"{tmp_dir}/plain", ("hour",), (F.xxhash64("icao", "latitude"),), page_rows=50)
    box = {"lat_min": 1.5, "lat_max": 1.8, "lon_min": 104.6, "lon_max": 105.0}
    total = p.count()
    near = {k: mv.near_region(spark.read.parquet(f"{tmp_dir}/{k}"), box) for k in ("z", "plain")}
    assert near["z"].count() == near["plain"].count() > 0
    n = {k: scanned(df) for k, df in near.items()}
    assert near["z"].count() <= n["z"] < 0.5 * total and n["plain"] > 0.9 * total


def test_sketches_are_united(spark):
    p = Q.valid(spark, SF_SMALL)
    s = sketches.aircraft_sketches(p, Q.cells(spark)).cache()
    assert s.groupBy("source_date", "hour", "zone").count().where("count > 1").isEmpty()
    for wins, group in (([("day", 0, 24)], ["source_date", "zone"]), ([("a", 0, 12), ("b", 6, 18)], ["window", "zone"])):
        exact = unique_aircraft_in_zones(zone_join(tag_windows(p, wins), Q.cells(spark)), group)
        got = sketches.united(s, wins, group).where("zone <> '*'")
        both = exact.join(got.withColumnRenamed("n_points", "n"), group)
        assert both.count() == exact.count() == got.count()
        assert both.where((F.col("n") != F.col("n_points")) | ~sketches.within_bound("estimate", "unique_aircraft")).isEmpty()


def test_many_aircraft_stay_within_the_bound(spark):
    p = spark.range(60_000).selectExpr("'d' source_date", "cast(id % 24 as int) hour", "hex(id % 20000) icao", "105.0D longitude", "2.0D latitude")
    got = {r.zone: r for r in sketches.united(sketches.aircraft_sketches(p, Q.cells(spark)), [("x", 0, 24)], ["zone"]).collect()}
    assert {"*", "box"} <= set(got) and all(abs(r.estimate - 20_000) <= sketches.ERROR_BOUND * 20_000 and r.n_points == 60_000 for r in got.values())
