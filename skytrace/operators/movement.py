"""Study questions over the point table: flags, headings, legs, departures
and arrivals, zone visits and altitudes, callsigns, metadata, sources.

Rules the format leaves open (ours, stated once here):

* direction: heading = ``track_deg``, else metadata ``true_heading``; N is
  [315, 45), E [45, 135), S [135, 225), W [225, 315);
* legs: bit 2 of ``flags_bitfield`` starts a new leg; points before the first
  marker are leg 0;
* departures/arrivals: changes of a state machine over ground mark, altitude
  near 0, speed and vertical rate, per leg (``ground_state``, ``movements``);
* a zone visit starts at a point inside the zone whose previous valid point
  of that aircraft-day is not inside it (or does not exist);
* altitude: barometric first, geometric as fallback, ground points excluded;
* callsign: the latest non-null trimmed ``flight`` of the aircraft-day.

All per-aircraft sequences go through ``sequence_scan`` (skew-safe).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from .. import schema as S
from ..functions.codes import db_flag_columns, trace_flag_columns
from ..functions.timefn import ntz_from_us
from .sequence import sequence_scan, written
from .spatial import CellIndex, zone_join, zone_tags
from .tracks import TIME_ORDER, TRACK_KEYS, tracks

def flags_decode(points: DataFrame) -> DataFrame:
    """Per date: points carrying each trace flag, and fresh (not stale) points."""
    p = points.select("source_date", *trace_flag_columns())
    return p.groupBy("source_date").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.count_if("is_stale").alias("n_stale"),
        F.count_if("is_new_leg").alias("n_new_leg"),
        F.count_if("is_geom_rate").alias("n_geom_rate"),
        F.count_if("is_geom_alt").alias("n_geom_alt"),
        F.count_if(~F.col("is_stale")).alias("n_fresh"),
    )


def fresh_positions(points: DataFrame) -> DataFrame:
    """Drop stale positions (bit 1 of ``flags_bitfield``)."""
    return points.where(F.coalesce(F.col("flags_bitfield").bitwiseAND(S.FLAG_STALE) == 0, F.lit(True)))


def dbflags_decode(points: DataFrame) -> DataFrame:
    """Per date: distinct aircraft in total and per database flag.

    First one row per aircraft-day (flag set on any of its points, a partial
    aggregation), then counts per date: no per-row expansion as several
    ``countDistinct`` columns would need.
    """
    flags = ["is_military", "is_interesting", "is_pia", "is_ladd"]
    p = points.where(F.col("icao").isNotNull()).select("source_date", "icao", *db_flag_columns())
    per = p.groupBy("source_date", "icao").agg(*[F.bool_or(f).alias(f) for f in flags])
    return per.groupBy("source_date").agg(
        F.count(F.lit(1)).alias("n_aircraft"),
        *[F.count_if(f).alias("n_" + f[3:]) for f in flags],
    )


def near_region(points: DataFrame, box: dict | None = None) -> DataFrame:
    """Points inside the near-region box (inclusive bounds)."""
    b = box or S.NEAR_REGION
    return points.where(
        F.col("latitude").between(b["lat_min"], b["lat_max"])
        & F.col("longitude").between(b["lon_min"], b["lon_max"])
    )


def heading(points_meta: str = "aircraft_metadata") -> Column:
    meta_heading = F.get_json_object(F.col(points_meta), "$.true_heading").try_cast("double")
    return F.coalesce(F.col("track_deg"), meta_heading)


def cardinal(h: Column) -> Column:
    d = F.pmod(h, F.lit(360.0))
    return (
        F.when(d.isNull(), F.lit(None))
        .when((d >= 315) | (d < 45), F.lit("N"))
        .when(d < 135, F.lit("E"))
        .when(d < 225, F.lit("S"))
        .otherwise(F.lit("W"))
    )


def direction_counts(points: DataFrame) -> DataFrame:
    """Per (date, direction): points and distinct aircraft; null = no heading."""
    p = points.select("source_date", "icao", cardinal(heading()).alias("direction"))
    return p.groupBy("source_date", "direction").agg(
        F.count(F.lit(1)).alias("n_points"), F.countDistinct("icao").alias("n_aircraft")
    )


def legs(points: DataFrame, max_key_rows: int | None = None) -> DataFrame:
    """Legs per aircraft-day: points, start/end time, and the position of the
    first and the last point that has one. Points without a position count:
    a new-leg mark on one starts a leg."""
    marker = F.coalesce(F.col("flags_bitfield").bitwiseAND(S.FLAG_NEW_LEG) != 0, F.lit(False))
    scanned = sequence_scan(
        points, TRACK_KEYS, TIME_ORDER, row_number=None,
        running_sums={"leg": F.when(marker, 1).otherwise(0)}, max_key_rows=max_key_rows,
    )
    o = F.struct(*TIME_ORDER)
    pos = F.struct("latitude", "longitude")
    seen = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), o)
    g = scanned.groupBy(*TRACK_KEYS, "leg").agg(
        F.count(F.lit(1)).alias("n_points"), F.min("event_us").alias("_t0"), F.max("event_us").alias("_t1"),
        F.min_by(pos, seen).alias("_s"), F.max_by(pos, seen).alias("_e")
    )
    return g.select(
        *TRACK_KEYS,
        F.col("leg").cast("bigint").alias("leg"),
        "n_points",
        ntz_from_us("_t0").alias("start_time"),
        ntz_from_us("_t1").alias("end_time"),
        F.col("_s.latitude").alias("start_lat"),
        F.col("_s.longitude").alias("start_lon"),
        F.col("_e.latitude").alias("end_lat"),
        F.col("_e.longitude").alias("end_lon"),
    )


def ground_state() -> Column:
    """What a point says by itself: ``ground``, ``air``, or null (it keeps the
    state before it).

    Ground: the ground mark; an altitude of ``NEAR_ZERO_FT`` at most, slow and
    level where speed and vertical rate are known; without any altitude, known
    to be slow and level. Air: ``AIR_FT`` or more; or fast and climbing or
    sinking, above ``NEAR_ZERO_FT`` or without an altitude. Between the two
    lies the band in which nothing changes.
    """
    alt, speed, rate = F.col("altitude_ft_num"), F.col("ground_speed_kts"), F.abs("vertical_rate_fpm")
    mark = F.coalesce(F.col("on_ground"), F.lit(False))
    slow, level = speed <= S.SLOW_KTS, rate <= S.LEVEL_FPM
    moving = F.coalesce((speed >= S.FAST_KTS) & (rate >= S.CLIMB_FPM), F.lit(False))
    low = F.coalesce((alt <= S.NEAR_ZERO_FT) & F.coalesce(slow, F.lit(True)) & F.coalesce(level, F.lit(True)), F.lit(False))
    still = alt.isNull() & F.coalesce(slow & level, F.lit(False))
    high = F.coalesce(alt >= S.AIR_FT, F.lit(False)) | (moving & F.coalesce(alt > S.NEAR_ZERO_FT, F.lit(True)))
    return F.when(mark | low | still, F.lit("ground")).when(high, F.lit("air"))


def movements(points: DataFrame, max_key_rows: int | None = None) -> DataFrame:
    """Departures (ground → air) and arrivals (air → ground) per leg of an
    aircraft-day, over all points, with a position or without.

    A state machine with hysteresis (see ``ground_state``): each point either
    sets the state or keeps it, and a new leg begins without one. So a stretch
    of points, however long, does what its last setting point does; that point
    is all that ``sequence_scan`` carries from one part of a track to the next.
    """
    new_leg = F.coalesce(F.col("flags_bitfield").bitwiseAND(S.FLAG_NEW_LEG) != 0, F.lit(False))
    setting = points.withColumns({"_state": ground_state(), "_new_leg": new_leg}).where("_state is not null or _new_leg")
    scanned = sequence_scan(
        setting, TRACK_KEYS, TIME_ORDER, row_number=None, running_sums={"leg": F.when(F.col("_new_leg"), 1).otherwise(0)},
        lags={"_before": "_state", "prev_us": "event_us"}, max_key_rows=max_key_rows,
    )
    kind = (
        F.when((F.col("_before") == "ground") & (F.col("_state") == "air"), F.lit("departure"))
        .when((F.col("_before") == "air") & (F.col("_state") == "ground"), F.lit("arrival"))
    )
    return scanned.where(~F.col("_new_leg")).select(
        *TRACK_KEYS,
        F.col("leg").cast("bigint").alias("leg"),
        kind.alias("movement"),
        F.col("datetime_utc").alias("time"),
        ntz_from_us("prev_us").alias("prev_time"),
        "latitude",
        "longitude",
    ).where(F.col("movement").isNotNull())


def zone_membership(points: DataFrame, zones: DataFrame | CellIndex) -> DataFrame:
    """Points inside at least one zone: how many zones and which (sorted)."""
    tagged = zone_tags(points, zones, "_in").where(F.size("_in") > 0)
    return tagged.select("source_date", "icao", ntz_from_us("event_us").alias("time"),
                         F.size("_in").cast("bigint").alias("n_zones"), F.array_join("_in", ",").alias("zones"))


def zone_visits(points: DataFrame, zones: DataFrame | CellIndex, max_key_rows: int | None = None) -> DataFrame:
    """Per (date, zone, aircraft): inside points and separate visits, so a
    re-entering aircraft counts once in ``unique_aircraft`` but twice here."""
    tagged = zone_tags(points.select(*TRACK_KEYS, *TIME_ORDER, "latitude", "longitude"), zones, "_in").drop("latitude", "longitude")
    scanned = sequence_scan(tagged, TRACK_KEYS, TIME_ORDER, row_number=None, lags={"_before": "_in"}, max_key_rows=max_key_rows)
    v = scanned.select(*TRACK_KEYS, "event_us", "_before", F.explode("_in").alias("zone")).withColumn(
        "visit_start", ~F.coalesce(F.array_contains("_before", F.col("zone")), F.lit(False)))
    g = v.groupBy("source_date", "zone", "icao").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.count_if("visit_start").alias("n_visits"),
        F.min("event_us").alias("_t0"),
        F.max("event_us").alias("_t1"),
    )
    return g.select(
        "source_date", "zone", "icao", "n_points", "n_visits",
        ntz_from_us("_t0").alias("first_inside"), ntz_from_us("_t1").alias("last_inside"),
    )


def zone_altitude(points: DataFrame, zones: DataFrame | CellIndex) -> DataFrame:
    """Airborne altitude per (date, zone, aircraft): min, max, mean, samples."""
    inside = zone_join(points, zones).where(~F.coalesce(F.col("on_ground"), F.lit(False)))
    alt = F.coalesce(F.col("altitude_ft_num"), F.col("geometric_altitude_ft"))
    g = inside.withColumn("alt", alt).groupBy("source_date", "zone", "icao").agg(
        F.count("alt").alias("n_samples"),
        F.min("alt").alias("min_alt"),
        F.max("alt").alias("max_alt"),
        F.sum(F.col("alt").cast("bigint")).alias("sum_alt"),
    )
    return g.select(
        "source_date", "zone", "icao", "n_samples", "min_alt", "max_alt",
        (F.col("sum_alt").cast("double") / F.col("n_samples")).alias("avg_alt"),
    )


def callsign_col() -> Column:
    cs = F.trim(F.get_json_object(F.col("aircraft_metadata"), "$.flight"))
    return F.when(cs != "", cs)


def callsigns(points: DataFrame) -> DataFrame:
    """Latest callsign and number of distinct callsigns per aircraft-day."""
    p = points.withColumn("callsign", callsign_col()).where(F.col("callsign").isNotNull())
    g = p.groupBy(*TRACK_KEYS).agg(
        F.max_by("callsign", F.struct(*TIME_ORDER)).alias("callsign"),
        F.countDistinct("callsign").alias("n_callsigns"),
        F.count(F.lit(1)).alias("n_points"),
    )
    return g


def _snapshots(points: DataFrame) -> DataFrame:
    """Points that carry a metadata snapshot, parsed once to a variant ``m``
    (null where the text is no JSON)."""
    return points.where(F.col("aircraft_metadata").isNotNull()).withColumn("m", F.try_parse_json(F.col("aircraft_metadata")))


def _typed(field) -> Column:
    """A field of the snapshot in its documented type; null where it is missing
    or of another kind. Whole numbers may come as floats; an altitude may be a
    text (``ground``)."""
    path, kind = f"$.{field.name}", field.dataType.simpleString()
    value = F.try_variant_get(F.col("m"), path, kind)
    if field.name == "alt_baro":
        value = F.coalesce(F.try_variant_get(F.col("m"), path, "bigint").cast("string"), value)
    return (F.trim(value) if field.name == "flight" else value).alias(field.name)


def metadata_fields(points: DataFrame) -> DataFrame:
    """All documented single fields of the metadata snapshots, typed."""
    m = _snapshots(points)
    return m.select("source_date", "icao", "datetime_utc", *[_typed(f) for f in S.METADATA_SCHEMA.fields if not isinstance(f.dataType, ArrayType)])


def metadata_lists(points: DataFrame) -> DataFrame:
    """The list fields of the snapshots (autopilot modes, fields from MLAT and
    TIS-B), one row an item with its place in the list."""
    m = _snapshots(points)
    lists = [f for f in S.METADATA_SCHEMA.fields if isinstance(f.dataType, ArrayType)]
    each = F.explode(F.array(*[F.struct(F.lit(f.name).alias("field"), _typed(f).alias("items")) for f in lists]))
    return m.select("source_date", "icao", "path", "seq", each.alias("l")).select(
        "source_date", "icao", "path", "seq", F.col("l.field").alias("field"), F.posexplode("l.items").alias("place", "item"))


def source_mix(points: DataFrame) -> DataFrame:
    """Per (date, source_type): points, aircraft, points of non-ICAO (``~``) ids."""
    return points.groupBy("source_date", "source_type").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.countDistinct("icao").alias("n_aircraft"),
        F.count_if(F.col("icao").startswith("~")).alias("n_non_icao_points"),
    )


#: Aircraft-days (two short texts each) broadcast to pick points at the scan.
MAX_BROADCAST_VISITORS = 1_000_000


def zone_trajectories(points: DataFrame, zones: DataFrame | CellIndex, segment_points: int = 1000,
                      max_key_rows: int | None = None) -> DataFrame:
    """Full tracks (all points, inside or not) of the aircraft-days that enter
    a zone, as ordered segments per zone.

    The visits are found and written once. The visiting aircraft-days then
    filter the points where they are scanned, before any shuffle, as long as
    they are few enough to broadcast (counted); beyond that by a shuffled join.
    """
    visits = written(zone_join(points, zones).select("zone", *TRACK_KEYS).distinct(), "visits")
    who = visits.select(*TRACK_KEYS).distinct()
    few = visits.count() <= MAX_BROADCAST_VISITORS
    side = F.broadcast if few else (lambda d: d)
    t = tracks(points.join(side(who), TRACK_KEYS, "left_semi"), segment_points, max_key_rows)
    return t.join(side(visits), TRACK_KEYS)
