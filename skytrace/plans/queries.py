"""Registered queries: name → ``fn(spark, sf_dir) -> DataFrame``.

Every query reads the driver tables at ``sf_dir`` (whole tables, no
subsets): trace queries start from ``events``, turned into JSON trace
documents and parsed back (``sources.events_docs`` → ``operators.flatten``);
the small-table operators read ``orders`` and ``pages``. ``trace_flatten``
runs the parse path itself; the analytics queries read the stored point
table that this parse path writes once per source (``plans.store``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.geo import z_order
from ..functions.timefn import hour_range_label, iso_utc, ntz_from_us
from ..operators import movement as mv
from ..operators import sketches, stats, tracks, windows
from ..operators.flatten import doc_status, flatten_docs, parse_docs
from ..operators.spatial import CellIndex, cell_index, unique_aircraft_in_zones, valid_positions, zone_join
from ..session import read_table
from ..sources.events_docs import trace_docs_from_events
from ..sources.links import asset_links
from ..sources.listing import archive_groups, files_from_orders
from ..sources.zones import zones_from_pairs
from . import params as P


# ---------------------------------------------------------------------------
# shared inputs
# ---------------------------------------------------------------------------

def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trace_docs_from_events(read_table(spark, sf_dir, "events"))


def points_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points straight from the parse path (documents → flatten)."""
    return flatten_docs(docs(spark, sf_dir))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored point table (ingested once per source, see ``plans.store``)."""
    return spark.read.parquet(points_path(spark, sf_dir))


def points_path(spark: SparkSession, sf_dir: str) -> str:
    """Its folder, partitioned by hour (a window query reads its hours only)
    and in Z-order within one (a region query reads the pages near it)."""
    from .store import stored_path

    return stored_path(spark, sf_dir, "points", lambda: points_fresh(spark, sf_dir), ("hour",), (z_order("latitude", "longitude"),))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_positions(points(spark, sf_dir))


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of a known aircraft, with a position or without."""
    return points(spark, sf_dir).where(F.col("icao").isNotNull())


_ZONES: dict[str, DataFrame] = {}
_CELLS: dict[str, CellIndex] = {}


def key_stats(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """Statistics of the stored point table, computed once per session:
    rows of the largest aircraft-day and aircraft of the largest date.
    Upper bounds for every subset a query scans, so the sequence scans can
    skip their own hot-key check when these are small."""
    from .store import point_stats

    return point_stats(points(spark, sf_dir), points_path(spark, sf_dir))


def zones(spark: SparkSession) -> DataFrame:
    """The parameter zones, parsed once per session and cached (three rows;
    a lost block is recomputed from the same text)."""
    key = spark.sparkContext.applicationId
    z = _ZONES.get(key)
    if z is None:
        z = _ZONES[key] = zones_from_pairs(spark, P.ZONES_DMS).cache()
    return z


def cells(spark: SparkSession) -> CellIndex:
    """Their cell index, made once per session."""
    key = spark.sparkContext.applicationId
    c = _CELLS.get(key)
    if c is None:
        c = _CELLS[key] = cell_index(zones(spark))
    return c


def dates_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct order dates as ``YYYY.MM.DD`` plus variants made by string
    surgery: shifted 27 years (into the release years; 29 Feb may become
    invalid), month without zero padding, month 13. One scan, one distinct,
    the variants generated per row."""
    d = (
        read_table(spark, sf_dir, "orders")
        .select(F.regexp_replace(F.col("o_orderdate").cast("date").cast("string"), "-", ".").alias("d"))
        .distinct()
    )
    y = F.substring("d", 1, 4).cast("int")
    variants = [
        ("ok", F.col("d")),
        ("shifted", F.concat((y + 27).cast("string"), F.substring("d", 5, 6))),
        ("unpadded", F.concat(F.substring("d", 1, 5), F.substring("d", 6, 2).cast("int").cast("string"),
                              F.substring("d", 8, 3))),
        ("month13", F.concat(F.substring("d", 1, 5), F.lit("13"), F.substring("d", 8, 3))),
    ]
    v = F.array(*[F.struct(expr.alias("date_str"), F.lit(kind).alias("kind")) for kind, expr in variants])
    return d.select(F.inline(v))


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------

def q_trace_flatten(spark, sf_dir):
    return points_fresh(spark, sf_dir)


def q_trace_docs_scan(spark, sf_dir):
    d = parse_docs(docs(spark, sf_dir))
    return d.select(
        "path", "source_date",
        *[F.col("doc")[k].alias(k) for k in ["icao", "timestamp", "r", "t", "desc", "year", "ownOp"]],
        F.col("doc.dbFlags").try_cast("int").alias("dbFlags"),
        F.size(F.col("doc.trace")).cast("int").alias("n_entries"),
    )


def q_doc_status(spark, sf_dir):
    return doc_status(docs(spark, sf_dir)).drop("hour_mask")


def q_point_event_time(spark, sf_dir):
    p = points(spark, sf_dir)
    return p.select(
        "path", "seq", "icao", "event_us", "datetime_utc",
        iso_utc("event_us").alias("datetime_iso"), "hour", hour_range_label("hour").alias("hour_range"),
    )


def q_hourly_counts(spark, sf_dir):
    return stats.hourly_counts(points(spark, sf_dir))


def q_ingest_stats(spark, sf_dir):
    return stats.ingest_stats(doc_status(docs(spark, sf_dir)))


def q_multi_date_counts(spark, sf_dir):
    return stats.multi_date_counts(points(spark, sf_dir))


def q_window_filter(spark, sf_dir):
    s, e = P.WINDOW_FILTER
    return windows.filter_hours(points(spark, sf_dir), s, e).select(
        "path", "seq", "source_date", "icao", "event_us", "datetime_utc", "hour", "latitude", "longitude"
    )


def q_window_points(spark, sf_dir):
    wp = windows.window_points(points(spark, sf_dir), P.WINDOWS)
    return wp.select(*wp.columns[:8], "window", "source_date", "path", "seq", "event_us", "hour")


def q_window_stats(spark, sf_dir):
    return stats.window_stats(points(spark, sf_dir), P.WINDOWS)


def q_valid_positions(spark, sf_dir):
    """Rows per date, and those that ``valid_positions`` leaves of them (0 for
    a date that loses all)."""
    p = points(spark, sf_dir)
    side = lambda df, left: df.select("source_date", F.lit(left).alias("left"))
    return side(p, False).unionByName(side(valid_positions(p), True)).groupBy("source_date").agg(
        F.count_if(~F.col("left")).alias("n_rows"), F.count_if("left").alias("n_valid")
    )


def q_points_in_zone(spark, sf_dir):
    inside = zone_join(valid(spark, sf_dir), cells(spark))
    return inside.select("source_date", "zone", "icao", "path", "seq", "event_us", "latitude", "longitude")


def q_zone_unique_aircraft(spark, sf_dir):
    tagged = windows.tag_windows(valid(spark, sf_dir), P.WINDOWS)
    inside = zone_join(tagged, cells(spark))
    return unique_aircraft_in_zones(inside, ["source_date", "window", "zone"])


def q_zone_aircraft_sketch(spark, sf_dir):
    """Distinct aircraft per date, window and zone (``*``: anywhere) from the
    hourly sketches, written once, beside the exact count of the points."""
    from .store import stored_path

    made = stored_path(spark, sf_dir, "sketches", lambda: sketches.aircraft_sketches(valid(spark, sf_dir), cells(spark)))
    keys = ["source_date", "window", "zone"]
    estimated = sketches.united(spark.read.parquet(made), P.WINDOWS, keys)
    tagged = windows.tag_windows(valid(spark, sf_dir), P.WINDOWS)
    anywhere = tagged.withColumn("zone", F.lit(sketches.ANYWHERE))
    exact = unique_aircraft_in_zones(zone_join(tagged, cells(spark)).unionByName(anywhere), keys)
    both = exact.withColumnRenamed("n_points", "exact_points").join(estimated, keys)
    return both.select(*keys, "unique_aircraft", "n_points", (F.col("n_points") == F.col("exact_points")).alias("same_points"),
                       sketches.within_bound("estimate", "unique_aircraft").alias("within_bound"))


def q_map_center(spark, sf_dir):
    return tracks.map_center(valid(spark, sf_dir))


def q_track_summary(spark, sf_dir):
    return tracks.track_summary(valid(spark, sf_dir), key_stats(spark, sf_dir)[1])


def q_tracks(spark, sf_dir):
    return tracks.tracks(valid(spark, sf_dir), P.TRACK_SEGMENT_POINTS, key_stats(spark, sf_dir)[0])


def q_track_endpoints(spark, sf_dir):
    return tracks.track_endpoints(valid(spark, sf_dir))


def q_track_features(spark, sf_dir):
    ka, kd = key_stats(spark, sf_dir)
    f = tracks.track_features(valid(spark, sf_dir), zones(spark), P.TRACK_SEGMENT_POINTS, ka, kd)
    return f


def q_valid_dates(spark, sf_dir):
    d = dates_table(spark, sf_dir)
    return d.select("date_str", "kind", codes.is_valid_date("date_str").alias("valid"))


def q_release_tags(spark, sf_dir):
    d = dates_table(spark, sf_dir).where(codes.is_valid_date("date_str"))
    return d.select(
        "date_str",
        codes.release_year("date_str").alias("year"),
        codes.release_repo("date_str").alias("repo"),
        codes.release_tag("date_str").alias("tag"),
    )


def q_page_asset_links(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    return asset_links(pages, P.PAGE_LINK_TAG, P.PAGE_LINK_IGNORED, P.PAGE_LINK_ACCEPT)


def q_archive_groups(spark, sf_dir):
    return archive_groups(files_from_orders(read_table(spark, sf_dir, "orders")))


def q_flags_decode(spark, sf_dir):
    return mv.flags_decode(points(spark, sf_dir))


def q_dbflags_decode(spark, sf_dir):
    return mv.dbflags_decode(points(spark, sf_dir))


def q_near_region(spark, sf_dir):
    return mv.near_region(valid(spark, sf_dir)).select(
        "source_date", "icao", "path", "seq", "event_us", "latitude", "longitude"
    )


def q_local_windows(spark, sf_dir):
    p = points(spark, sf_dir).withColumn("local_hour", windows.local_hour())
    t = windows.tag_windows(p, P.LOCAL_WINDOWS, hour_col="local_hour")
    g = t.groupBy("source_date", "window").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.countDistinct("icao").alias("unique_aircraft"),
        F.min("event_us").alias("_t0"),
        F.max("event_us").alias("_t1"),
    )
    return g.select(
        "source_date", "window", "n_points", "unique_aircraft",
        ntz_from_us("_t0").alias("time_min"), ntz_from_us("_t1").alias("time_max"),
    )


def q_direction_counts(spark, sf_dir):
    return mv.direction_counts(points(spark, sf_dir))


def q_legs(spark, sf_dir):
    return mv.legs(located(spark, sf_dir), key_stats(spark, sf_dir)[0])


def q_movements(spark, sf_dir):
    return mv.movements(located(spark, sf_dir), key_stats(spark, sf_dir)[0])


def q_zone_membership(spark, sf_dir):
    return mv.zone_membership(valid(spark, sf_dir), cells(spark))


def q_zone_visits(spark, sf_dir):
    return mv.zone_visits(valid(spark, sf_dir), cells(spark), key_stats(spark, sf_dir)[0])


def q_zone_altitude(spark, sf_dir):
    return mv.zone_altitude(valid(spark, sf_dir), cells(spark))


def q_callsigns(spark, sf_dir):
    return mv.callsigns(points(spark, sf_dir))


def q_zone_trajectories(spark, sf_dir):
    return mv.zone_trajectories(valid(spark, sf_dir), cells(spark), P.TRACK_SEGMENT_POINTS,
                                key_stats(spark, sf_dir)[0])


def q_metadata_fields(spark, sf_dir):
    return mv.metadata_fields(points(spark, sf_dir))


def q_metadata_lists(spark, sf_dir):
    return mv.metadata_lists(points(spark, sf_dir))


def q_source_mix(spark, sf_dir):
    return mv.source_mix(points(spark, sf_dir))


def q_hourly_partitions(spark, sf_dir):
    """Points written to the hour-partitioned table (in the session's shared
    checkpoint folder) and read back: rows and files per partition."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sinks.files import hourly_file_stats, write_hourly

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/hourly-{uuid.uuid4().hex}"
    write_hourly(points(spark, sf_dir), base)
    write_hourly(points(spark, sf_dir), base)  # a second run replaces what the first wrote
    return hourly_file_stats(spark, base).select(
        "source_date", "hour", "n_rows", (F.col("n_files") > 0).alias("has_files"), (F.col("n_bytes") > 0).alias("has_bytes"))


def q_points_csv(spark, sf_dir):
    """Points written as CSV by hour and read back with the fixed schema,
    projected to the columns a study starts from."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sinks.files import write_hourly
    from ..sources.trace_docs import read_points_csv

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    write_hourly(points(spark, sf_dir), base, fmt="csv")
    return read_points_csv(spark, f"{base}/source_date=*/hour=*/run=*", projected=[
        "icao", "datetime_utc", "latitude", "longitude", "altitude_ft", "ground_speed_kts", "flags_bitfield", "source_type", "aircraft_metadata"])


def q_fresh_points(spark, sf_dir):
    """Points whose position is not stale."""
    return mv.fresh_positions(points(spark, sf_dir)).select("source_date", "icao", "path", "seq", "event_us", "latitude", "longitude")


def q_window_files(spark, sf_dir):
    """Window rows written per (date, window), written again without the rows
    of the first window, and read back: the second run replaces the first."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sinks.files import read_windows, write_windows

    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/windows-{uuid.uuid4().hex}"
    p = points(spark, sf_dir)
    write_windows(p, P.WINDOWS, base)
    write_windows(p, P.WINDOWS[1:], base, dates=[r[0] for r in p.select("source_date").distinct().collect()])
    return read_windows(spark, base).groupBy("source_date", "window").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("icao").alias("n_aircraft"), F.min("event_us").alias("first_us"))


#: The hourly stream lands in so many slices of time; of the rows whose id is
#: a multiple of LATE_EVERY, those land one slice after their own.
STREAM_SLICES, LATE_EVERY = 3, 211


def q_stream_hourly_counts(spark, sf_dir):
    """Hourly counts as a Structured Streaming query with a watermark of one
    hour: the points land as files, slice of time by slice, some of them one
    slice late; after each the stream runs on from its checkpoint
    (``availableNow``). Per hour: rows counted, and rows that came after the
    hour was closed (from the side output)."""
    import uuid

    from ..functions.timefn import US_PER_HOUR, epoch_us
    from ..session import ensure_checkpoint_dir
    from ..sources.events_docs import _fields, _raw
    from ..streaming.ingest import read_hourly_counts, read_late_rows, start_hourly_counts, start_late_rows

    f = _fields(F.col)
    pts = _raw(read_table(spark, sf_dir, "events")).select("event_id", epoch_us(f["timestamp"], f["seconds_after_timestamp"]).alias("event_us"))
    lo, hi = pts.agg(F.min("event_us"), F.max("event_us")).first()
    own = F.floor((F.col("event_us") - F.lit(lo)) * F.lit(STREAM_SLICES) / F.lit(hi - lo + 1))
    landed = F.least(own + F.when(F.col("event_id") % LATE_EVERY == 0, 1).otherwise(0), F.lit(STREAM_SLICES - 1))
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    for k in range(STREAM_SLICES):
        pts.where(landed == k).write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(pts.schema).parquet(f"{root}/landing")
        running = [start_hourly_counts(stream, f"{root}/counts", f"{root}/_counts"), start_late_rows(stream, f"{root}/late", f"{root}/_late")]
        for query in running:
            query.awaitTermination()
    late = read_late_rows(spark, f"{root}/late").groupBy((F.col("event_us") - F.pmod("event_us", F.lit(US_PER_HOUR))).alias("window_start_us")) \
        .agg(F.count(F.lit(1)).alias("n_late"))
    both = read_hourly_counts(spark, f"{root}/counts").join(late, "window_start_us", "full")
    return both.select(ntz_from_us("window_start_us").alias("hour_start"), F.coalesce("n_rows", F.lit(0)).alias("n_rows"),
                       F.coalesce("n_late", F.lit(0)).alias("n_late"))


def q_stream_ingest(spark, sf_dir):
    """Incremental ingest as a stream: the documents land as NDJSON files per
    date, a file stream flattens them into the hour-partitioned table
    (``availableNow``, checkpointed in the shared folder). Read back per date:
    rows, documents, aircraft, and rows and points of the zone membership."""
    import uuid

    from ..session import ensure_checkpoint_dir
    from ..sinks.files import read_hourly
    from ..streaming.ingest import start_ingest, stream_points

    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-ingest-{uuid.uuid4().hex}"
    docs(spark, sf_dir).select("source_date", "content").write.partitionBy("source_date").text(f"{root}/landing")
    start_ingest(stream_points(spark, f"{root}/landing", lines=True), f"{root}/points", f"{root}/_checkpoint").awaitTermination()
    p = read_hourly(spark, f"{root}/points")
    per_date = stats.multi_date_counts(p)
    inside = mv.zone_membership(valid_positions(p), cells(spark)).groupBy("source_date").agg(
        F.count(F.lit(1)).alias("n_inside"), F.sum("n_zones").alias("n_memberships"))
    return per_date.join(inside, "source_date", "left").select(
        "source_date", "n_rows", "n_aircraft", "n_docs", "n_hours",
        F.coalesce("n_inside", F.lit(0)).alias("n_inside"), F.coalesce("n_memberships", F.lit(0)).alias("n_memberships"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "trace_flatten": q_trace_flatten,
    "trace_docs_scan": q_trace_docs_scan,
    "doc_status": q_doc_status,
    "point_event_time": q_point_event_time,
    "hourly_counts": q_hourly_counts,
    "ingest_stats": q_ingest_stats,
    "multi_date_counts": q_multi_date_counts,
    "window_filter": q_window_filter,
    "window_points": q_window_points,
    "window_stats": q_window_stats,
    "valid_positions": q_valid_positions,
    "points_in_zone": q_points_in_zone,
    "zone_unique_aircraft": q_zone_unique_aircraft,
    "zone_aircraft_sketch": q_zone_aircraft_sketch,
    "map_center": q_map_center,
    "track_summary": q_track_summary,
    "tracks": q_tracks,
    "track_endpoints": q_track_endpoints,
    "track_features": q_track_features,
    "valid_dates": q_valid_dates,
    "release_tags": q_release_tags,
    "page_asset_links": q_page_asset_links,
    "archive_groups": q_archive_groups,
    "flags_decode": q_flags_decode,
    "dbflags_decode": q_dbflags_decode,
    "near_region": q_near_region,
    "local_windows": q_local_windows,
    "direction_counts": q_direction_counts,
    "legs": q_legs,
    "movements": q_movements,
    "zone_membership": q_zone_membership,
    "zone_visits": q_zone_visits,
    "zone_altitude": q_zone_altitude,
    "callsigns": q_callsigns,
    "zone_trajectories": q_zone_trajectories,
    "metadata_fields": q_metadata_fields,
    "metadata_lists": q_metadata_lists,
    "source_mix": q_source_mix,
    "hourly_partitions": q_hourly_partitions,
    "window_files": q_window_files,
    "points_csv": q_points_csv,
    "fresh_points": q_fresh_points,
    "stream_hourly_counts": q_stream_hourly_counts,
    "stream_ingest": q_stream_ingest,
}
