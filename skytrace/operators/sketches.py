"""Distinct aircraft by mergeable sketches.

One pass over the points makes a HyperLogLog sketch of the aircraft for each
(date, hour) and for each zone in it; the sketch table is a few kilobytes a
row, whatever the traffic. Any set of windows, dates or zones is then answered
by uniting sketches: an aircraft seen in two hours counts once, which sums of
hourly counts could not say, and the points are not read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spatial import CellIndex, zone_tags
from .windows import tag_windows

#: 2^LOG_K registers: a standard error of about 1.04 / 2^(LOG_K / 2), 1.6 %.
LOG_K = 12
#: Four standard errors; counts below some hundreds are exact within rounding.
ERROR_BOUND = 0.065
#: The zone name of rows about all points of an hour.
ANYWHERE = "*"


def aircraft_sketches(points: DataFrame, zones: DataFrame | CellIndex, log_k: int = LOG_K) -> DataFrame:
    """(source_date, hour, zone, n_points, sketch): one row per date, hour and
    zone with points, and one for all points of the hour (``ANYWHERE``).

    ``points`` hold valid positions. Sketches are partial aggregates: a task
    sends one per group, not its points.
    """
    tagged = zone_tags(points.select("source_date", "hour", "icao", "longitude", "latitude"), zones, "_in")
    rows = tagged.select("source_date", "hour", "icao", F.explode(F.concat(F.array(F.lit(ANYWHERE)), "_in")).alias("zone"))
    return rows.groupBy("source_date", "hour", "zone").agg(
        F.count(F.lit(1)).alias("n_points"), F.hll_sketch_agg("icao", log_k).alias("sketch"))


def united(sketches: DataFrame, windows, group: list[str]) -> DataFrame:
    """Points and estimated distinct aircraft per group (of source_date, window,
    zone) from the sketches of the windows' hours."""
    tagged = tag_windows(sketches, windows)
    return tagged.groupBy(*group).agg(
        F.sum("n_points").cast("bigint").alias("n_points"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def within_bound(estimate, exact):
    """Whether an estimate is as near as the sketch's error bound says."""
    return F.abs(F.col(estimate) - F.col(exact)) <= F.greatest(F.lit(1.0), F.lit(ERROR_BOUND) * F.col(exact))
