"""Geographic expressions: DMS text, polygon rings, strict point-in-polygon.

All of it is built from Catalyst expressions (regexp, higher-order array
functions): no Python on the query path. Higher-order functions, and so the
edge test and a join condition that holds it, are interpreted on the JVM, not
generated code; the bounding box in front of them is cheap either way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: DMS pattern, anchored at the start only (trailing text is
# accepted), greedy 2-3 digit degrees, then 2-digit minutes and seconds.
DMS_PATTERN = r"^(\d{2,3})(\d{2})(\d{2})([NSEW])"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_ws(x) -> Column:
    """Remove leading and trailing whitespace of any kind (``trim`` only
    removes spaces)."""
    return F.regexp_replace(_c(x), r"^\s+|\s+$", "")


def dms_to_decimal(dms) -> Column:
    """``DDMMSS[NSEW]`` / ``DDDMMSS[NSEW]`` → signed decimal degrees.

    Input is trimmed and upper-cased first; S and W are negative. Text that
    does not match gives null (the caller reports such rows as bad).
    """
    s = F.upper(strip_ws(dms))
    matched = s.rlike(DMS_PATTERN)
    deg = F.regexp_extract(s, DMS_PATTERN, 1).cast("int")
    mins = F.regexp_extract(s, DMS_PATTERN, 2).cast("int")
    secs = F.regexp_extract(s, DMS_PATTERN, 3).cast("int")
    hemi = F.regexp_extract(s, DMS_PATTERN, 4)
    value = deg + mins / F.lit(60) + secs / F.lit(3600)
    return F.when(matched, F.when(hemi.isin("S", "W"), -value).otherwise(value))


def close_ring(ring) -> Column:
    """Append the first vertex when the ring is open (first != last)."""
    r = _c(ring)
    return F.when(
        F.size(r) == 0, r
    ).when(F.element_at(r, 1) == F.element_at(r, -1), r).otherwise(
        F.concat(r, F.array(F.element_at(r, 1)))
    )


def ring_edges(ring) -> Column:
    """Closed ring of ``struct(lon, lat)`` → array of ``struct(x1, y1, x2, y2)``."""
    r = _c(ring)
    return F.transform(
        F.slice(r, 1, F.size(r) - 1),
        lambda p, i: F.struct(
            p["lon"].alias("x1"),
            p["lat"].alias("y1"),
            F.element_at(r, i + 2)["lon"].alias("x2"),
            F.element_at(r, i + 2)["lat"].alias("y2"),
        ),
    )


def _cross(e, px, py) -> Column:
    # Division-free side test of point (px, py) against edge e.
    return (e["x2"] - e["x1"]) * (py - e["y1"]) - (px - e["x1"]) * (e["y2"] - e["y1"])


def point_in_polygon(px, py, edges) -> Column:
    """Strict interior test: even-odd crossings, and false on any edge or vertex.

    For each edge (x1,y1)→(x2,y2) with ``c`` the cross product above, the ray
    to +x crosses it iff ``(y1 > py) <> (y2 > py)`` and ``c`` has the sign of
    ``y2 - y1``. The point lies on the edge iff ``c = 0`` and it is inside the
    edge's bounding box.
    """
    px, py, edges = _c(px), _c(py), _c(edges)

    def crosses(e):
        c = _cross(e, px, py)
        return ((e["y1"] > py) != (e["y2"] > py)) & (
            ((e["y2"] > e["y1"]) & (c > 0)) | ((e["y2"] < e["y1"]) & (c < 0))
        )

    def on_edge(e):
        c = _cross(e, px, py)
        return (
            (c == 0)
            & (px >= F.least(e["x1"], e["x2"]))
            & (px <= F.greatest(e["x1"], e["x2"]))
            & (py >= F.least(e["y1"], e["y2"]))
            & (py <= F.greatest(e["y1"], e["y2"]))
        )

    n_cross = F.size(F.filter(edges, crosses))
    return (F.pmod(n_cross, F.lit(2)) == 1) & ~F.exists(edges, on_edge)


def in_box(lon, lat, lon_min, lon_max, lat_min, lat_max) -> Column:
    """Inclusive bounding-box test (cheap conjunct placed before the polygon)."""
    lon, lat = _c(lon), _c(lat)
    return (
        (lon >= _c(lon_min))
        & (lon <= _c(lon_max))
        & (lat >= _c(lat_min))
        & (lat <= _c(lat_max))
    )


def _spread(x: Column) -> Column:
    """The low 16 bits of a number, a zero between each two."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return x


def z_order(lat, lon) -> Column:
    """Interleaved bits of latitude and longitude (16 each, some 300 m): rows
    sorted by it lie near each other on the map. Null for a null position."""
    cell = lambda c, low, span: F.least(
        F.greatest(F.floor((_c(c) - F.lit(low)) * F.lit(65536.0 / span)), F.lit(0)), F.lit(65535)).cast("bigint")
    both = _spread(cell(lon, -180.0, 360.0)).bitwiseOR(F.shiftleft(_spread(cell(lat, -90.0, 180.0)), 1))
    return F.when(_c(lat).isNotNull() & _c(lon).isNotNull(), both)
