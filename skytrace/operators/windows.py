"""Hour windows: half-open ``start <= hour < end`` filters and window tagging.

Windows are a short parameter list, so they enter the plan as a literal
array and tagging is a narrow ``filter`` + ``explode`` — no join, no
shuffle. A static ``hour IN (...)`` conjunct is added in front so a scan of
the hour-partitioned point table prunes partitions (``PartitionFilters``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.timefn import US_PER_HOUR, hour_of_day


def _hours(windows) -> list[int]:
    hours = set()
    for _, start, end in windows:
        hours.update(range(max(start, 0), min(end, 24)))
    return sorted(hours)


def _windows_literal(windows) -> Column:
    return F.array(
        *[
            F.struct(F.lit(label).alias("label"), F.lit(s).alias("start"), F.lit(e).alias("end"))
            for label, s, e in windows
        ]
    )


def filter_hours(points: DataFrame, start: int, end: int, hour_col: str = "hour") -> DataFrame:
    """Rows with ``start <= hour < end``; no wrap past midnight (start > end → none)."""
    h = F.col(hour_col)
    return points.where(h.isNotNull() & (h >= start) & (h < end))


def tag_windows(points: DataFrame, windows, hour_col: str = "hour", keep_outside: bool = False) -> DataFrame:
    """One row per (point, window containing it) with a ``window`` label.

    ``keep_outside`` keeps points in no window once, with a null label, and
    adds ``first_tag`` (true on exactly one row per input point) so totals
    and per-window figures come from one pass.
    """
    h = F.col(hour_col)
    hits = F.filter(_windows_literal(windows), lambda w: (h >= w["start"]) & (h < w["end"]))
    if not keep_outside:
        return points.where(h.isin(*_hours(windows))).select(
            "*", F.explode(F.transform(hits, lambda w: w["label"])).alias("window")
        )
    return points.select(
        "*",
        F.posexplode_outer(F.transform(hits, lambda w: w["label"])).alias("_wpos", "window"),
    ).withColumn("first_tag", F.coalesce(F.col("_wpos") == 0, F.lit(True))).drop("_wpos")


def local_hour(us_col: str = "event_us", offset_hours: int = S.LOCAL_UTC_OFFSET_HOURS) -> Column:
    """Hour of day in a fixed-offset local time (GMT+8 for the study)."""
    return hour_of_day(F.col(us_col) + F.lit(offset_hours * US_PER_HOUR))


def reorder_window_columns(df: DataFrame) -> DataFrame:
    """The eight front columns first, the others in their existing order."""
    missing = [c for c in S.WINDOW_FRONT_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns for reorder: {missing}")
    rest = [c for c in df.columns if c not in S.WINDOW_FRONT_COLUMNS]
    return df.select(*S.WINDOW_FRONT_COLUMNS, *rest)


def require_columns(df: DataFrame, cols=tuple(S.WINDOW_REQUIRED_COLUMNS)) -> DataFrame:
    """Fail before planning when a required input column is absent."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def window_points(points: DataFrame, windows) -> DataFrame:
    """Points per window, front columns first, ordered by time.

    The order is a global range-partitioned sort on (window, event_us, icao,
    seq); written out, each file then holds a contiguous time range.
    """
    tagged = tag_windows(require_columns(points), windows)
    return reorder_window_columns(tagged).orderBy("window", "event_us", "icao", "path", "seq")
