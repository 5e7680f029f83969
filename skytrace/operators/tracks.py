"""Per-aircraft tracks: centre, first/last points, ordered paths, map features.

Time order within an aircraft-day is ``(event_us, path, seq)``. No operator
here collects a whole aircraft into one row: end points use ``min_by`` /
``max_by`` (partial aggregation), and a track is emitted as consecutive
parts of at most ``segment_points`` points and the last point of the part
before, with positions from the skew-safe ``sequence_scan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.timefn import ntz_from_us
from .sequence import sequence_scan, written

TRACK_KEYS = ["source_date", "icao"]
TIME_ORDER = ["event_us", "path", "seq"]


def _order_struct() -> Column:
    return F.struct(*[F.col(c) for c in TIME_ORDER])


#: Rows that a group may have between its bracket's ends for the exact step.
EXACT_ROWS = 1_000_000
#: Parts of a quantile sketch, and its accuracy (rank error 1 in so many rows).
SKETCH_PARTS, SKETCH_ACCURACY = 100, 10_000
#: A row a group: some 100 MB at most.
MAX_BROADCAST_GROUPS = 500_000


def exact_median(df: DataFrame, group: list[str], value: str, exact_rows: int | None = None) -> DataFrame:
    """Exact interpolated median of ``value`` per group, fully distributed.

    1. Rows per group are counted; the whole range is the first bracket.
    2. While some group has more than ``exact_rows`` rows strictly inside its
       bracket, a quantile sketch of these rows (``SKETCH_PARTS`` parts) gives a
       narrower one around the middle ranks, with a part to spare on both
       sides, a hundred times the sketch's error. One pass over the values
       then counts exactly what lies below it and inside it.
    3. Values within the brackets are counted per distinct value; running
       counts give the values at the two middle ranks.

    Nothing depends on the values' range, and a value that fills half the rows
    is one entry of the last step. The median is ``0.5 * lo + 0.5 * hi`` (equal
    to ``lo`` for odd ``n``), as Spark's ``percentile(…, 0.5)`` interpolates.
    """
    exact_rows = exact_rows or EXACT_ROWS
    v = F.col(value)
    base = df.where(v.isNotNull()).select(*group, v.cast("double").alias("_v"))
    none = F.lit(None).cast("double")
    state = written(base.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).select(
        *group, "_n", none.alias("_lo"), none.alias("_hi"), F.lit(0).cast("bigint").alias("_below"), F.col("_n").alias("_inside")), "median")
    groups, largest = state.agg(F.count(F.lit(1)), F.max("_inside")).first()
    side = F.broadcast if groups <= MAX_BROADCAST_GROUPS else (lambda d: d)
    after, before = F.col("_lo").isNull() | (F.col("_v") >= F.col("_lo")), F.col("_hi").isNull() | (F.col("_v") <= F.col("_hi"))
    while groups and largest > exact_rows:
        parts = [i / SKETCH_PARTS for i in range(SKETCH_PARTS + 1)]
        open_ = (F.col("_lo").isNull() | (F.col("_v") > F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_v") < F.col("_hi")))
        within = base.join(side(state), group).where(after & before)
        sketch = within.groupBy(*group).agg(
            F.percentile_approx("_v", parts, SKETCH_ACCURACY).alias("_q"), F.count(F.lit(1)).alias("_c"),
            F.first("_n").alias("_n"), F.first("_below").alias("_below"), F.max("_inside").alias("_was"),
            F.first("_lo").alias("_old_lo"), F.first("_hi").alias("_old_hi"))
        at = lambda rank: (rank - F.col("_below")) * F.lit(float(SKETCH_PARTS)) / F.col("_c")
        lo_at = F.floor(at(F.floor((F.col("_n") - 1) / 2) + 1) - 1).cast("int")
        hi_at = F.ceil(at(F.floor(F.col("_n") / 2) + 1) + 1).cast("int")
        wide = F.col("_was") > exact_rows  # other groups keep their bracket
        lo = F.when(~wide, F.col("_old_lo")).otherwise(F.get("_q", F.greatest(lo_at, F.lit(0))))
        hi = F.when(~wide, F.col("_old_hi")).otherwise(F.get("_q", F.least(hi_at, F.lit(SKETCH_PARTS))))
        bracket = written(sketch.select(*group, "_n", lo.alias("_lo"), hi.alias("_hi")), "median")
        state = written(base.join(side(bracket), group).groupBy(*group).agg(
            F.first("_n").alias("_n"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"),
            F.count_if(F.col("_v") < F.col("_lo")).alias("_below"), F.count_if(open_).alias("_inside")), "median")
        largest = state.agg(F.max("_inside")).first()[0]
    wv = Window.partitionBy(*group).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = base.join(side(state.drop("_inside")), group).where(after & before).groupBy(*group, "_v").agg(
        F.count(F.lit(1)).alias("_c"), F.first("_n").alias("_n"), F.first("_below").alias("_below"))
    through = F.col("_below") + F.sum("_c").over(wv)
    ranked = counted.select(*group, "_v", "_n", through.alias("_through"), (through - F.col("_c")).alias("_before"))
    holds = lambda k: (F.col("_before") < k) & (F.col("_through") >= k)
    low, high = F.floor((F.col("_n") - 1) / 2) + 1, F.floor(F.col("_n") / 2) + 1
    return ranked.groupBy(*group).agg(
        F.max("_n").alias("n"),
        (F.lit(0.5) * F.max(F.when(holds(low), F.col("_v"))) + F.lit(0.5) * F.max(F.when(holds(high), F.col("_v")))).alias("median"),
    )


def map_center(points: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Exact (interpolated) median latitude and longitude per group.

    Both coordinates go through one ``exact_median`` pipeline as stacked
    (kind, value) rows, so the table is scanned once."""
    group = group or ["source_date"]
    stacked = points.select(
        *group,
        F.inline(F.array(
            F.struct(F.lit("lat").alias("_kind"), F.col("latitude").alias("_v")),
            F.struct(F.lit("lon").alias("_kind"), F.col("longitude").alias("_v")),
        )),
    )
    m = exact_median(stacked, [*group, "_kind"], "_v")
    return m.groupBy(*group).agg(
        F.max(F.when(F.col("_kind") == "lat", F.col("n"))).alias("n_points"),
        F.max(F.when(F.col("_kind") == "lat", F.col("median"))).alias("center_lat"),
        F.max(F.when(F.col("_kind") == "lon", F.col("median"))).alias("center_lon"),
    )


def track_endpoints(points: DataFrame) -> DataFrame:
    """First and last point, point count and time span per aircraft-day."""
    o = _order_struct()
    pos = F.struct("latitude", "longitude", "event_us")
    g = points.groupBy(*TRACK_KEYS).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.min_by(pos, o).alias("_first"),
        F.max_by(pos, o).alias("_last"),
    )
    return g.select(
        *TRACK_KEYS,
        "n_points",
        F.col("_first.latitude").alias("first_lat"),
        F.col("_first.longitude").alias("first_lon"),
        ntz_from_us(F.col("_first.event_us")).alias("first_time"),
        F.col("_last.latitude").alias("last_lat"),
        F.col("_last.longitude").alias("last_lon"),
        ntz_from_us(F.col("_last.event_us")).alias("last_time"),
    )


def track_summary(points: DataFrame, max_date_aircraft: int | None = None) -> DataFrame:
    """Aircraft in order of first appearance per date, with point counts and
    palette index ``(rank - 1) mod 20``; ties in first time go by icao."""
    per = points.groupBy(*TRACK_KEYS).agg(
        F.count(F.lit(1)).alias("n_points"), F.min("event_us").alias("first_us")
    )
    ranked = sequence_scan(per, ["source_date"], ["first_us", "icao"], row_number="appearance_rank",
                           max_key_rows=max_date_aircraft)
    return ranked.select(
        *TRACK_KEYS,
        "n_points",
        ntz_from_us("first_us").alias("first_time"),
        "appearance_rank",
        F.pmod(F.col("appearance_rank") - 1, F.lit(S.PALETTE_SIZE)).cast("int").alias("color_index"),
    )


def _fmt(c: str) -> Column:
    return F.format_string("%.6f", F.col(c))


def track_points(points: DataFrame, max_key_rows: int | None = None) -> DataFrame:
    """Every valid point with its 1-based position ``pos`` in its track."""
    return sequence_scan(points, TRACK_KEYS, TIME_ORDER, row_number="pos", max_key_rows=max_key_rows)


def track_parts(points: DataFrame, segment_points: int, max_key_rows: int | None = None) -> DataFrame:
    """Every valid point by part (``segment``) of its track. Part k holds
    positions ``k*segment_points+1`` to ``(k+1)*segment_points`` and, from the
    second on, first the last point of the part before: the parts' lines
    together draw the whole track."""
    p = F.col("pos") - 1
    own, last = F.floor(p / F.lit(segment_points)).cast("bigint"), F.col("pos") % segment_points == 0
    return track_points(points, max_key_rows).withColumn(
        "segment", F.explode(F.when(last, F.array(own, own + 1)).otherwise(F.array(own))))


def tracks(points: DataFrame, segment_points: int = 1000, max_key_rows: int | None = None) -> DataFrame:
    """Ordered track parts (see ``track_parts``); ``path_text`` is ``lat lon``
    pairs joined by ``,`` in time order. Each part's list is bounded by
    ``segment_points``; a part with nothing but its repeated point is none."""
    tp = track_parts(points, segment_points, max_key_rows)
    seg = tp.groupBy(*TRACK_KEYS, "segment").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.min("pos").alias("first_pos"),
        F.min("event_us").alias("_t0"),
        F.max("event_us").alias("_t1"),
        F.sort_array(
            F.collect_list(F.struct("pos", F.concat_ws(" ", _fmt("latitude"), _fmt("longitude")).alias("p")))
        ).alias("_pts"),
    ).where((F.col("segment") == 0) | (F.col("n_points") > 1))
    return seg.select(
        *TRACK_KEYS,
        "segment",
        "n_points",
        "first_pos",
        ntz_from_us("_t0").alias("start_time"),
        ntz_from_us("_t1").alias("end_time"),
        F.array_join(F.transform("_pts", lambda x: x["p"]), ",").alias("path_text"),
    )


def track_features(points: DataFrame, zones: DataFrame | None = None, segment_points: int = 1000,
                   max_key_rows: int | None = None, max_date_aircraft: int | None = None) -> DataFrame:
    """GeoJSON features (one JSON text per row): a LineString per track part
    of two positions or more, with popup ``ICAO: <id><br>Points: <n>`` and
    palette index, a start and an end Point per aircraft-day, and a Polygon
    per zone (``[lon, lat]`` order, ring closed). Texts are escaped."""
    summ = track_summary(points, max_date_aircraft).select(
        *TRACK_KEYS, F.col("n_points").alias("track_points"), "color_index")
    coord = F.concat(F.lit("["), _fmt("longitude"), F.lit(","), _fmt("latitude"), F.lit("]"))
    seg = track_parts(points, segment_points, max_key_rows).groupBy(*TRACK_KEYS, "segment").agg(
        F.sort_array(F.collect_list(F.struct("pos", coord.alias("c")))).alias("_pts")
    ).where(F.size("_pts") > 1).join(summ, TRACK_KEYS)

    def feature(geometry: str, coordinates: Column, properties: Column) -> Column:
        return F.concat(
            F.lit(f'{{"type":"Feature","geometry":{{"type":"{geometry}","coordinates":'), coordinates,
            F.lit('},"properties":'), F.to_json(properties), F.lit("}"))

    def props(kind: Column) -> Column:
        popup = F.concat(F.lit("ICAO: "), F.col("icao"), F.lit("<br>Points: "), F.col("track_points").cast("string"))
        return F.struct(kind.alias("kind"), "icao", "source_date", popup.alias("popup"), "color_index")

    path = F.concat(F.lit("["), F.array_join(F.transform("_pts", lambda x: x["c"]), ","), F.lit("]"))
    line = seg.select(
        F.lit("track").alias("feature_kind"), *TRACK_KEYS, "segment",
        feature("LineString", path, props(F.lit("track"))).alias("feature"))
    at = lambda lat, lon: F.concat(F.lit("["), _fmt(lon), F.lit(","), _fmt(lat), F.lit("]"))
    both = F.array(
        F.struct(F.lit("start").alias("feature_kind"), at("first_lat", "first_lon").alias("c")),
        F.struct(F.lit("end").alias("feature_kind"), at("last_lat", "last_lon").alias("c")))
    ends = track_endpoints(points).join(summ, TRACK_KEYS).select(*TRACK_KEYS, "track_points", "color_index", F.inline(both))
    ends = ends.select(
        "feature_kind", *TRACK_KEYS, F.lit(None).cast("bigint").alias("segment"),
        feature("Point", F.col("c"), props(F.col("feature_kind"))).alias("feature"))

    out = line.unionByName(ends)
    if zones is not None:
        pair = lambda p: F.concat(F.lit("["), F.format_string("%.6f", p["lon"]), F.lit(","), F.format_string("%.6f", p["lat"]), F.lit("]"))
        ring = F.concat(F.lit("[["), F.array_join(F.transform("ring", pair), ","), F.lit("]]"))
        zf = zones.where("valid").select(
            F.lit("zone").alias("feature_kind"),
            F.lit(None).cast("string").alias("source_date"),
            F.col("zone").alias("icao"),
            F.lit(None).cast("bigint").alias("segment"),
            feature("Polygon", ring, F.struct(F.lit("zone").alias("kind"), F.col("zone").alias("name"))).alias("feature"),
        )
        out = out.unionByName(zf)
    return out.withColumnRenamed("icao", "name")
