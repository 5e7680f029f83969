"""Polygon (zone) sources: header-less DMS text, one ``lat lon`` pair per line.

Rules: the first CSV field of each non-blank line is the pair; it must split
on whitespace into exactly two DMS values; a zone needs at least three
vertices; an open ring is closed by repeating the first vertex; vertices are
``(lon, lat)``. Vertex order is kept (``posexplode`` over the whole text).

Zones that break a rule are kept with ``valid = false`` and an ``error``
text, so a batch with one bad file still runs the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.geo import close_ring, dms_to_decimal, ring_edges, strip_ws


def zones_from_text(df: DataFrame) -> DataFrame:
    """``(zone, text)`` → one row per zone with ring, edges and bounding box."""
    lines = df.select(
        "zone", F.posexplode(F.split(F.col("text"), r"\r?\n")).alias("vid", "line")
    )
    field = strip_ws(F.substring_index(F.col("line"), ",", 1))
    lines = lines.select("zone", "vid", field.alias("field")).where(F.col("field") != "")
    parts = F.split(F.col("field"), r"\s+")
    verts = lines.select(
        "zone",
        "vid",
        "field",
        (F.size(parts) == 2).alias("two"),
        dms_to_decimal(F.get(parts, 0)).alias("lat"),
        dms_to_decimal(F.get(parts, 1)).alias("lon"),
    )
    ok = F.col("two") & F.col("lat").isNotNull() & F.col("lon").isNotNull()
    grouped = verts.groupBy("zone").agg(
        F.sort_array(F.collect_list(F.struct("vid", "lon", "lat"))).alias("v"),
        F.count_if(~ok).alias("n_bad"),
        F.min(F.when(~ok, F.col("field"))).alias("bad_field"),
    )
    ring0 = F.transform("v", lambda p: F.struct(p["lon"].alias("lon"), p["lat"].alias("lat")))
    z = grouped.select("zone", ring0.alias("ring0"), "n_bad", "bad_field")
    n = F.size("ring0")
    valid = (F.col("n_bad") == 0) & (n >= 3)
    error = (
        F.when(F.col("n_bad") > 0, F.concat(F.lit("invalid vertex: "), F.col("bad_field")))
        .when(n < 3, F.lit("need at least 3 coordinates"))
    )
    ring = close_ring(F.col("ring0"))
    lons = F.transform(ring, lambda p: p["lon"])
    lats = F.transform(ring, lambda p: p["lat"])
    return z.select(
        "zone",
        ring.alias("ring"),
        ring_edges(ring).alias("edges"),
        F.array_min(lons).alias("lon_min"),
        F.array_max(lons).alias("lon_max"),
        F.array_min(lats).alias("lat_min"),
        F.array_max(lats).alias("lat_max"),
        n.cast("int").alias("n_vertices"),
        valid.alias("valid"),
        error.alias("error"),
    )


def zones_from_pairs(spark: SparkSession, zones: dict[str, str]) -> DataFrame:
    """Zones given as ``{name: dms_text}`` (e.g. parameters of a run)."""
    rows = [(name, text) for name, text in zones.items()]
    return zones_from_text(spark.createDataFrame(rows, "zone STRING, text STRING"))


def read_zone_files(spark: SparkSession, paths) -> DataFrame:
    """Polygon files → zones; the zone name is the file stem."""
    if isinstance(paths, str):
        paths = [paths]
    raw = spark.read.option("wholetext", True).text(list(paths))
    stem = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1)
    return zones_from_text(raw.select(stem.alias("zone"), F.col("value").alias("text")))
