"""Points × zones through a cell index, and the zone questions built on it.

Zones are cut by a grid of square cells once (``cell_index``). A cell is

* *inside* a zone: no edge touches it and its centre is inside, so that every
  point of it is strictly inside and needs no edge test;
* on its *boundary*: an edge touches it. The cell then carries the edges that
  can decide for one of its points: those that reach its band of latitudes
  and do not end west of it (the test's ray runs east);
* outside: not in the index.

A point looks its cell up by one number (``cell_key``) in a hash join, so it
meets the zones of its own cell only, and edges are tested near boundaries
only. The grid is the finest power of two of a degree, from ``FINEST`` on, that
cuts all zones' boxes into at most ``TARGET_CELLS`` cells; multiples of a power
of two are exact, so that a point's cell and the cell's borders agree.

The index is broadcast where its cells and edges take ``MAX_INDEX_BYTES`` at
most (computed from the index itself); beyond that it is joined by shuffling
on the cell, whose hot partitions AQE splits.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import point_in_polygon

#: Cell sizes in degrees are 2^k, from the finest k to the coarsest.
FINEST, COARSEST = -7, 4
TARGET_CELLS = 16_384
MAX_INDEX_BYTES = 64 << 20
#: Bytes of an index row without its edges (key, zone name, flag, headers) and of an edge.
ROW_BYTES, EDGE_BYTES = 96, 48
#: Cells are widened by so much of a degree before edges are tested against them.
SLACK = 1e-9
GEOMETRY = ["edges", "lon_min", "lon_max", "lat_min", "lat_max"]


def valid_positions(points: DataFrame) -> DataFrame:
    """Drop rows with a null ``icao``, ``latitude`` or ``longitude``."""
    return points.na.drop(how="any", subset=["icao", "latitude", "longitude"])


@dataclass(frozen=True)
class CellIndex:
    """``cells``: (cell, zone, inside, edges); edges are empty for inside cells."""

    cells: DataFrame
    cell_deg: float
    n_bytes: int
    box: tuple[float, float, float, float] | None  # lon, lat of all zones; None without zones

    def side(self, df: DataFrame) -> DataFrame:
        """The build side of a join: broadcast within the byte bound only."""
        return F.broadcast(df) if self.n_bytes <= MAX_INDEX_BYTES else df


def _at(c: Column, cell_deg: float) -> Column:
    return F.floor(c / F.lit(cell_deg)).cast("bigint")


def cell_key(lon: Column, lat: Column, cell_deg: float) -> Column:
    """One number for the cell of a position (null for a null position)."""
    return F.shiftleft(_at(lon, cell_deg), 32) + _at(lat, cell_deg)


def _measure(z: DataFrame) -> tuple[float, tuple[float, float, float, float] | None]:
    """The finest cell size whose cells over all boxes stay within the target,
    and the box around all zones."""
    def n(k: int) -> Column:
        d = 2.0**k
        wide = _at(F.col("lon_max"), d) - _at(F.col("lon_min"), d) + 1
        return F.sum(wide.cast("double") * (_at(F.col("lat_max"), d) - _at(F.col("lat_min"), d) + 1))

    sizes = list(range(FINEST, COARSEST + 1))
    r = z.agg(F.min("lon_min"), F.max("lon_max"), F.min("lat_min"), F.max("lat_max"), *[n(k).alias(f"n{i}") for i, k in enumerate(sizes)]).first()
    size = 2.0 ** next((k for k, c in zip(sizes, r[4:], strict=True) if (c or 0) <= TARGET_CELLS), COARSEST)
    return size, None if r[0] is None else tuple(r[:4])


def _touches(e: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> Column:
    """Whether an edge may touch a box: their boxes meet, and the box's corners
    don't all lie on one side of the edge's line."""
    def side(x: Column, y: Column) -> Column:
        return (e["x2"] - e["x1"]) * (y - e["y1"]) - (x - e["x1"]) * (e["y2"] - e["y1"])

    corners = [side(x, y) for x in (x0, x1) for y in (y0, y1)]
    return (
        (F.least(e["x1"], e["x2"]) <= x1) & (F.greatest(e["x1"], e["x2"]) >= x0)
        & (F.least(e["y1"], e["y2"]) <= y1) & (F.greatest(e["y1"], e["y2"]) >= y0)
        & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)
    )


def require_valid(zones: DataFrame) -> DataFrame:
    """The zones, or a ``ValueError`` that names the invalid ones and why."""
    bad = zones.where(~F.col("valid")).select("zone", "error").orderBy("zone").limit(20).collect()
    if bad:
        raise ValueError("invalid zones: " + "; ".join(f"{r.zone}: {r.error}" for r in bad))
    return zones


def cell_index(zones: DataFrame, cell_deg: float | None = None, strict: bool = False) -> CellIndex:
    """The cells of all valid zones, cached (recomputed from the zones where a
    block is lost), with their size in bytes. ``strict``: invalid zones are an
    error instead of being left out."""
    if strict:
        require_valid(zones)
    z = zones.where("valid").select("zone", *GEOMETRY)
    size, box = _measure(z)
    d = cell_deg or size
    axis = lambda lo, hi: F.explode(F.sequence(_at(F.col(lo), d), _at(F.col(hi), d)))
    cells = z.select("zone", "edges", "lat_min", "lat_max", axis("lon_min", "lon_max").alias("cx")) \
        .select("zone", "edges", "cx", axis("lat_min", "lat_max").alias("cy"))
    x0, y0 = F.col("cx") * F.lit(d), F.col("cy") * F.lit(d)
    x1, y1 = x0 + F.lit(d), y0 + F.lit(d)
    wide = (x0 - SLACK, x1 + SLACK, y0 - SLACK, y1 + SLACK)
    boundary = F.exists("edges", lambda e: _touches(e, *wide))
    near = F.filter("edges", lambda e: (F.least(e["y1"], e["y2"]) <= wide[3]) & (F.greatest(e["y1"], e["y2"]) >= wide[2])
                    & (F.greatest(e["x1"], e["x2"]) >= wide[0]))
    centre = point_in_polygon(x0 + F.lit(d / 2), y0 + F.lit(d / 2), F.col("edges"))
    classed = cells.select(
        (F.shiftleft("cx", 32) + F.col("cy")).alias("cell"), "zone", boundary.alias("on"), near.alias("near"), centre.alias("centre"))
    kept = classed.where("on or centre").select(
        "cell", "zone", (~F.col("on")).alias("inside"), F.when(F.col("on"), F.col("near")).otherwise(F.slice("near", 1, 0)).alias("edges")).cache()
    n_bytes = kept.agg(F.sum(F.lit(ROW_BYTES) + F.octet_length("zone") + F.size("edges") * EDGE_BYTES)).first()[0]
    return CellIndex(kept, d, int(n_bytes or 0), box)


def _index(zones: DataFrame | CellIndex) -> CellIndex:
    return zones if isinstance(zones, CellIndex) else cell_index(zones)


def zone_join(points: DataFrame, zones: DataFrame | CellIndex) -> DataFrame:
    """Points strictly inside each valid zone → points columns + ``zone``.

    ``zones`` may be an index made once for several joins.
    """
    index = _index(zones)
    cells = index.cells.select(F.col("cell").alias("_cell"), "zone", F.col("inside").alias("_inside"), F.col("edges").alias("_edges"))
    if index.box:  # reaches the scan, where pages outside are skipped
        x0, x1, y0, y1 = index.box
        points = points.where(F.col("longitude").between(x0, x1) & F.col("latitude").between(y0, y1))
    keyed = points.withColumn("_cell", cell_key(F.col("longitude"), F.col("latitude"), index.cell_deg))
    met = keyed.join(index.side(cells), "_cell")
    return met.where(F.col("_inside") | point_in_polygon("longitude", "latitude", "_edges")).drop("_cell", "_inside", "_edges")


def zone_tags(points: DataFrame, zones: DataFrame | CellIndex, name: str = "zones") -> DataFrame:
    """Every point with the sorted array of the zones it is strictly inside
    (empty for none): one row a point, and no shuffle within the byte bound."""
    index = _index(zones)
    by_cell = index.cells.groupBy(F.col("cell").alias("_cell")).agg(F.sort_array(F.collect_list(F.struct("zone", "inside", "edges"))).alias("_met"))
    keyed = points.withColumn("_cell", cell_key(F.col("longitude"), F.col("latitude"), index.cell_deg))
    met = keyed.join(index.side(by_cell), "_cell", "left")
    own = F.filter("_met", lambda c: c["inside"] | point_in_polygon("longitude", "latitude", c["edges"]))
    none = F.array().cast("array<string>")
    return met.withColumn(name, F.when(F.col("_met").isNull(), none).otherwise(F.transform(own, lambda c: c["zone"]))).drop("_cell", "_met")


def unique_aircraft_in_zones(inside: DataFrame, group: list[str]) -> DataFrame:
    """Distinct aircraft (and points) per group of zone-matched points.

    ``countDistinct`` is planned as a partial dedup of (group, icao) before
    the shuffle, so a hot aircraft sends one row per map task, not its rows.
    """
    return inside.groupBy(*group).agg(
        F.countDistinct("icao").alias("unique_aircraft"),
        F.count(F.lit(1)).alias("n_points"),
    )
