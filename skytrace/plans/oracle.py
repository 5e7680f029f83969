"""DuckDB oracle SQL for the registered queries.

Independent of the Spark path: points are computed straight from ``events``
(no JSON), the polygon test runs on edges joined as rows, sequences use SQL
window functions. Column names equal the Spark outputs.
"""

from __future__ import annotations

from .. import schema as S
from . import params as P

# Points of the fixture, straight from events (same arithmetic as the
# document builder, see sources/events_docs.py).
_POINTS = r"""
ev AS (
  SELECT event_id, user_id, event_type, value, ts, epoch_us(ts) AS us,
         (epoch_us(ts) // 86400000000) * 86400 AS day_s
  FROM events
),
p0 AS (
  SELECT
    event_id, user_id, value,
    lower(lpad(to_hex(user_id), 6, '0')) AS icao,
    strftime(ts, '%Y.%m.%d') AS source_date,
    CAST(day_s AS DOUBLE) AS "timestamp",
    CAST(floor((us - day_s * 1000000) / 1e3) AS DOUBLE) / 1e3 AS seconds_after_timestamp,
    CASE WHEN event_id % 97 <> 0 THEN 1e0 + (event_id * 7919 % 20000) / 1e4 END AS latitude,
    104e0 + (event_id * 104729 % 25000) / 1e4 AS longitude,
    CASE WHEN event_type = 'error' THEN 'ground'
         ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END AS altitude_ft,
    (event_id * 13 % 6000) / 1e1 AS ground_speed_kts,
    CASE WHEN event_id % 5 <> 0 THEN (event_id * 37 % 3600) / 1e1 END AS track_deg,
    CAST(event_id % 16 AS INTEGER) AS flags_bitfield,
    CAST((event_id % 4001) - 2000 AS INTEGER) AS vertical_rate_fpm,
    CASE WHEN event_id % 3 = 0 THEN '{"flight":"FL' || CAST(user_id AS VARCHAR) || ' ","true_heading":'
         || CAST((event_id * 53 % 3600) / 1e1 AS VARCHAR)
         || CASE WHEN event_id % 30 = 0 THEN
              ',"alt_baro":' || CASE WHEN event_id % 60 = 0 THEN '"ground"' ELSE CAST(event_id % 400 * 100 AS VARCHAR) || '.0' END
              || ',"squawk":"' || lpad(CAST(event_id % 7778 AS VARCHAR), 4, '0') || '","category":"A' || CAST(event_id % 8 AS VARCHAR)
              || '","emergency":"none","nic":' || CAST(event_id % 12 AS VARCHAR) || '.0,"version":2,"rssi":-' || CAST(event_id % 40 AS VARCHAR) || '.5'
              || CASE WHEN event_id % 120 < 90 THEN ',"nav_modes":["autopilot","vnav"],"mlat":["lat","lon"],"tisb":[]' ELSE ',"nav_modes":["lnav"]' END
            ELSE '' END || '}' END AS aircraft_metadata,
    (['adsb_icao', 'mlat', 'tisb_icao', 'adsr_icao'])[event_id % 4 + 1] AS source_type,
    CAST(CASE WHEN event_id % 7 <> 0 THEN CAST(floor(value * 100) AS BIGINT) + event_id % 50 END AS INTEGER)
      AS geometric_altitude_ft,
    CAST((event_id % 3001) - 1500 AS INTEGER) AS geometric_vertical_rate_fpm,
    (event_id * 17 % 4000) / 1e1 AS indicated_airspeed_kts,
    ((event_id * 3 % 600) - 300) / 1e1 AS roll_angle_deg,
    event_id // 4096 AS block
  FROM ev
),
p1 AS (
  SELECT *,
    "timestamp" + seconds_after_timestamp AS x
  FROM p0
),
points AS (
  SELECT
    icao, "timestamp", '9V-' || upper(icao) AS r,
    (['A320', 'B738', 'A359', 'AT76'])[user_id % 4 + 1] AS t,
    CAST(NULL AS VARCHAR) AS "desc",
    CAST(user_id % 16 AS INTEGER) AS dbFlags,
    CAST(user_id % 25 + 2000 AS VARCHAR) AS year,
    CASE WHEN user_id % 2 = 0 THEN 'OPERATOR ' || CAST(user_id AS VARCHAR) END AS ownOp,
    make_timestamp(event_us) AS datetime_utc,
    seconds_after_timestamp, latitude, longitude, altitude_ft, ground_speed_kts, track_deg,
    flags_bitfield, vertical_rate_fpm, aircraft_metadata, source_type, geometric_altitude_ft,
    geometric_vertical_rate_fpm, indicated_airspeed_kts, roll_angle_deg,
    'traces/' || source_date || '/trace_full_' || icao || '-' || CAST(block AS VARCHAR) || '.json' AS path,
    source_date,
    CAST(row_number() OVER (PARTITION BY icao, source_date, block ORDER BY event_id) - 1
         + coalesce(sum(CASE WHEN event_id % 211 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY icao, source_date, block
             ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INTEGER) AS seq,
    event_id % 211 = 0 AS bad_after,
    event_us,
    CAST(((event_us - ((event_us % 3600000000) + 3600000000) % 3600000000) // 3600000000) % 24 AS INTEGER)
      AS hour,
    CASE WHEN altitude_ft = 'ground' THEN NULL ELSE CAST(floor(value * 100) AS INTEGER) END AS altitude_ft_num,
    altitude_ft = 'ground' AS on_ground
  FROM (
    SELECT *, CAST(floor(x) AS BIGINT) * 1000000 + CAST(round_even((x - floor(x)) * 1e6, 0) AS BIGINT) AS event_us
    FROM p1
  )
),
vp AS (
  SELECT * FROM points WHERE icao IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
)"""


# Documents of the fixture that fail: no JSON, and an empty trace.
_FAILED = """
fd AS (SELECT DISTINCT source_date, icao, block, (user_id + block) % 50 AS kind,
              'traces/' || source_date || '/trace_full_' || icao || '-' || CAST(block AS VARCHAR) AS stem FROM p0),
failed AS (SELECT stem || CASE WHEN kind = 3 THEN 'x' ELSE 'e' END || '.json' AS path, stem || '.json' AS beside, source_date, kind = 4 AS parsed
           FROM fd WHERE kind IN (3, 4))"""


def _dms(x: str) -> str:
    u = f"upper(trim({x}))"
    pat = r"'^(\d{2,3})(\d{2})(\d{2})([NSEW])'"
    val = (
        f"(CAST(regexp_extract({u}, {pat}, 1) AS INTEGER) + CAST(regexp_extract({u}, {pat}, 2) AS INTEGER) / 60"
        f" + CAST(regexp_extract({u}, {pat}, 3) AS INTEGER) / 3600)"
    )
    return (
        f"CASE WHEN regexp_matches({u}, {pat}) THEN "
        f"CASE WHEN regexp_extract({u}, {pat}, 4) IN ('S', 'W') THEN -{val} ELSE {val} END END"
    )


def _zones_cte() -> str:
    values = ", ".join(
        "('{}', '{}')".format(name, text.replace("\n", "' || chr(10) || '")) for name, text in P.ZONES_DMS.items()
    )
    return f"""
zone_text(zone, text) AS (VALUES {values}),
zl0 AS (
  SELECT zone, lines, unnest(generate_series(1, len(lines))) AS vid
  FROM (SELECT zone, string_split_regex(text, '\\r?\\n') AS lines FROM zone_text)
),
zl AS (
  SELECT zone, vid, trim(split_part(lines[vid], ',', 1)) AS field FROM zl0
),
zv AS (
  SELECT zone, vid, field, string_split_regex(field, '\\s+') AS parts FROM zl WHERE field <> ''
),
zv2 AS (
  SELECT zone, vid, len(parts) = 2 AS two, {_dms('parts[1]')} AS lat, {_dms('parts[2]')} AS lon FROM zv
),
zr0 AS (
  SELECT zone, list({{'lon': lon, 'lat': lat}} ORDER BY vid) AS ring0,
         sum(CASE WHEN two AND lat IS NOT NULL AND lon IS NOT NULL THEN 0 ELSE 1 END) AS n_bad
  FROM zv2 GROUP BY zone
),
zr AS (
  SELECT zone, CASE WHEN ring0[1] = ring0[-1] THEN ring0 ELSE list_append(ring0, ring0[1]) END AS ring
  FROM zr0 WHERE n_bad = 0 AND len(ring0) >= 3
),
ze0 AS (
  SELECT zone, ring, unnest(generate_series(1, len(ring) - 1)) AS k FROM zr
),
zedges AS (
  SELECT zone, ring[k].lon AS x1, ring[k].lat AS y1, ring[k + 1].lon AS x2, ring[k + 1].lat AS y2,
         list_min(list_transform(ring, lambda v: v.lon)) AS lon_min, list_max(list_transform(ring, lambda v: v.lon)) AS lon_max,
         list_min(list_transform(ring, lambda v: v.lat)) AS lat_min, list_max(list_transform(ring, lambda v: v.lat)) AS lat_max
  FROM ze0
)"""


def _inside_cte(src: str = "vp", name: str = "inside") -> str:
    c = "((e.x2 - e.x1) * (p.latitude - e.y1) - (p.longitude - e.x1) * (e.y2 - e.y1))"
    cross = (
        f"CASE WHEN ((e.y1 > p.latitude) <> (e.y2 > p.latitude)) AND "
        f"((e.y2 > e.y1 AND {c} > 0) OR (e.y2 < e.y1 AND {c} < 0)) THEN 1 ELSE 0 END"
    )
    edge = (
        f"({c} = 0 AND p.longitude >= least(e.x1, e.x2) AND p.longitude <= greatest(e.x1, e.x2)"
        f" AND p.latitude >= least(e.y1, e.y2) AND p.latitude <= greatest(e.y1, e.y2))"
    )
    return f"""
{name}_pairs AS (
  SELECT p.path, p.seq, e.zone, sum({cross}) AS n_cross, bool_or({edge}) AS on_edge
  FROM {src} p JOIN zedges e
    ON p.longitude >= e.lon_min AND p.longitude <= e.lon_max AND p.latitude >= e.lat_min AND p.latitude <= e.lat_max
  GROUP BY p.path, p.seq, e.zone
),
{name} AS (
  SELECT p.*, z.zone FROM {src} p JOIN {name}_pairs z ON p.path = z.path AND p.seq = z.seq
  WHERE z.n_cross % 2 = 1 AND NOT z.on_edge
)"""


def _windows_cte(windows, name: str = "wins") -> str:
    rows = ", ".join(f"('{label}', {s}, {e})" for label, s, e in windows)
    return f"{name}(label, ws, we) AS (VALUES {rows})"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


def _sec_text(us: str) -> str:
    return f"strftime(make_timestamp({us} - (({us} % 1000000) + 1000000) % 1000000), '%Y-%m-%d %H:%M:%S') || ' UTC'"


def _f6(x: str) -> str:
    return f"printf('%.6f', {x})"


_ORDER = "event_us, path, seq"

_DATES = r"""
od AS (SELECT DISTINCT strftime(o_orderdate, '%Y.%m.%d') AS d FROM orders),
dates AS (
  SELECT d AS date_str, 'ok' AS kind FROM od
  UNION ALL SELECT CAST(CAST(substr(d, 1, 4) AS INTEGER) + 27 AS VARCHAR) || substr(d, 5, 6), 'shifted' FROM od
  UNION ALL SELECT substr(d, 1, 5) || CAST(CAST(substr(d, 6, 2) AS INTEGER) AS VARCHAR) || substr(d, 8, 3), 'unpadded' FROM od
  UNION ALL SELECT substr(d, 1, 5) || '13' || substr(d, 8, 3), 'month13' FROM od
),
vd AS (
  SELECT date_str, kind,
         coalesce(regexp_matches(date_str, '^\d{4}\.\d{2}\.\d{2}$') AND try_strptime(date_str, '%Y.%m.%d') IS NOT NULL, false) AS valid
  FROM dates
)"""


def _track_pos() -> str:
    return f"""
tp AS (
  SELECT *, row_number() OVER (PARTITION BY source_date, icao ORDER BY {_ORDER}) AS pos FROM vp
)"""


def _parts_cte() -> str:
    """Points by part of their track; the last point of a part opens the next."""
    n = P.TRACK_SEGMENT_POINTS
    return f"""
px AS (
  SELECT *, unnest(CASE WHEN pos % {n} = 0 THEN [(pos - 1) // {n}, pos // {n}] ELSE [(pos - 1) // {n}] END) AS part FROM tp
)"""


def _tracks_sql() -> str:
    return f"""
  SELECT source_date, icao, CAST(part AS BIGINT) AS segment, count(*) AS n_points,
         min(pos) AS first_pos, make_timestamp(min(event_us)) AS start_time, make_timestamp(max(event_us)) AS end_time,
         string_agg({_f6('latitude')} || ' ' || {_f6('longitude')}, ',' ORDER BY pos) AS path_text
  FROM px GROUP BY source_date, icao, part HAVING part = 0 OR count(*) > 1"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    pts = _POINTS

    q["trace_flatten"] = _with(pts) + "\nSELECT * EXCLUDE (bad_after) FROM points"

    q["trace_docs_scan"] = _with(pts, _FAILED) + """
SELECT path, source_date, icao, "timestamp", r, t, "desc", year, ownOp, dbFlags,
       CAST(count(*) + count(*) FILTER (WHERE bad_after) AS INTEGER) AS n_entries
FROM points GROUP BY path, source_date, icao, "timestamp", r, t, "desc", year, ownOp, dbFlags
UNION ALL
SELECT f.path, f.source_date, p.icao, p."timestamp", p.r, p.t, p."desc", p.year, p.ownOp, p.dbFlags, CASE WHEN f.parsed THEN 0 END
FROM failed f LEFT JOIN (SELECT DISTINCT path, icao, "timestamp", r, t, "desc", year, ownOp, dbFlags FROM points) p
  ON f.parsed AND p.path = f.beside"""

    q["doc_status"] = _with(pts, _FAILED) + """
SELECT path, source_date, true AS parsed, CAST(count(*) + count(*) FILTER (WHERE bad_after) AS INTEGER) AS n_entries,
       CAST(count(*) FILTER (WHERE bad_after) AS INTEGER) AS n_bad_entries,
       CAST(count(*) AS INTEGER) AS n_rows, 'processed' AS status
FROM points GROUP BY path, source_date
UNION ALL SELECT path, source_date, parsed, 0, 0, 0, 'failed' FROM failed"""

    q["point_event_time"] = _with(pts) + """
SELECT path, seq, icao, event_us, datetime_utc,
       strftime(make_timestamp(event_us - event_us % 1000000), '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN event_us % 1000000 = 0 THEN '' ELSE '.' || lpad(CAST(event_us % 1000000 AS VARCHAR), 6, '0') END
         || '+00:00' AS datetime_iso,
       hour, lpad(CAST(hour AS VARCHAR), 2, '0') || '00-' || lpad(CAST(hour + 1 AS VARCHAR), 2, '0') || '00' AS hour_range
FROM points"""

    q["hourly_counts"] = _with(pts, """
counts AS (SELECT source_date, hour, count(*) AS n FROM points GROUP BY source_date, hour),
frame AS (SELECT d.source_date, h.hour FROM (SELECT DISTINCT source_date FROM counts) d,
          (SELECT CAST(unnest(generate_series(0, 23)) AS INTEGER) AS hour) h)""") + """
SELECT f.source_date, f.hour,
       lpad(CAST(f.hour AS VARCHAR), 2, '0') || '00-' || lpad(CAST(f.hour + 1 AS VARCHAR), 2, '0') || '00' AS hour_range,
       replace(f.source_date, '.', '_') || '_' || lpad(CAST(f.hour AS VARCHAR), 2, '0') || '00-'
         || lpad(CAST(f.hour + 1 AS VARCHAR), 2, '0') || '00.csv' AS file_name,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_rows
FROM frame f LEFT JOIN counts c ON f.source_date = c.source_date AND f.hour = c.hour"""

    q["ingest_stats"] = _with(pts, _FAILED, """
f AS (SELECT source_date, count(*) AS n FROM failed GROUP BY source_date)""") + """
SELECT p.source_date, count(DISTINCT path) + coalesce(any_value(f.n), 0) AS n_docs, count(DISTINCT path) AS processed_docs,
       CAST(coalesce(any_value(f.n), 0) AS BIGINT) AS failed_docs,
       count(*) FILTER (WHERE bad_after) AS bad_entries, count(*) AS total_rows, count(DISTINCT hour) AS active_hours,
       count(DISTINCT hour) AS files_created
FROM points p LEFT JOIN f ON f.source_date = p.source_date GROUP BY p.source_date"""

    q["multi_date_counts"] = _with(pts) + """
SELECT source_date, count(*) AS n_rows, count(DISTINCT icao) AS n_aircraft, count(DISTINCT path) AS n_docs,
       count(DISTINCT hour) AS n_hours
FROM points GROUP BY source_date"""

    s, e = P.WINDOW_FILTER
    q["window_filter"] = _with(pts) + f"""
SELECT path, seq, source_date, icao, event_us, datetime_utc, hour, latitude, longitude
FROM points WHERE hour >= {s} AND hour < {e}"""

    q["window_points"] = _with(pts, _windows_cte(P.WINDOWS)) + """
SELECT datetime_utc, icao, latitude, longitude, altitude_ft, geometric_altitude_ft, track_deg, flags_bitfield,
       w.label AS "window", source_date, path, seq, event_us, hour
FROM points p JOIN wins w ON p.hour >= w.ws AND p.hour < w.we"""

    q["window_stats"] = _with(pts, _windows_cte(P.WINDOWS), """
tot AS (SELECT source_date, count(*) AS rows_before FROM points GROUP BY source_date),
per AS (
  SELECT source_date, w.label AS "window", count(*) AS rows_after, count(DISTINCT icao) AS unique_aircraft,
         min(event_us) AS t0, max(event_us) AS t1
  FROM points p JOIN wins w ON p.hour >= w.ws AND p.hour < w.we GROUP BY source_date, w.label
)""") + f"""
SELECT per.source_date, "window", tot.rows_before, rows_after, unique_aircraft,
       make_timestamp(t0) AS time_min, make_timestamp(t1) AS time_max,
       {_sec_text('t0')} AS time_min_text, {_sec_text('t1')} AS time_max_text
FROM per JOIN tot ON per.source_date = tot.source_date"""

    q["valid_positions"] = _with(pts) + """
SELECT source_date, count(*) AS n_rows,
       count(*) FILTER (WHERE icao IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL) AS n_valid
FROM points GROUP BY source_date"""

    q["points_in_zone"] = _with(pts, _zones_cte(), _inside_cte()) + """
SELECT source_date, zone, icao, path, seq, event_us, latitude, longitude FROM inside"""

    q["zone_unique_aircraft"] = _with(pts, _zones_cte(), _windows_cte(P.WINDOWS), """
vpw AS (SELECT p.*, w.label AS "window" FROM vp p JOIN wins w ON p.hour >= w.ws AND p.hour < w.we)""",
                                      _inside_cte("vpw")) + """
SELECT source_date, "window", zone, count(DISTINCT icao) AS unique_aircraft, count(*) AS n_points
FROM inside GROUP BY source_date, "window", zone"""

    q["zone_aircraft_sketch"] = _with(pts, _zones_cte(), _windows_cte(P.WINDOWS), """
vpw AS (SELECT p.*, w.label AS "window" FROM vp p JOIN wins w ON p.hour >= w.ws AND p.hour < w.we)""",
                                     _inside_cte("vpw"), """
seen AS (SELECT source_date, "window", zone, icao FROM inside UNION ALL SELECT source_date, "window", '*', icao FROM vpw)""") + """
SELECT source_date, "window", zone, count(DISTINCT icao) AS unique_aircraft, count(*) AS n_points, true AS same_points, true AS within_bound
FROM seen GROUP BY source_date, "window", zone"""

    q["map_center"] = _with(pts, """
lat_o AS (SELECT source_date, latitude AS v, row_number() OVER (PARTITION BY source_date ORDER BY latitude) AS rn,
                 count(*) OVER (PARTITION BY source_date) AS n FROM vp),
lon_o AS (SELECT source_date, longitude AS v, row_number() OVER (PARTITION BY source_date ORDER BY longitude) AS rn,
                 count(*) OVER (PARTITION BY source_date) AS n FROM vp),
lat_m AS (SELECT source_date, max(n) AS n,
                 0.5 * max(v) FILTER (WHERE rn = (n - 1) // 2 + 1) + 0.5 * max(v) FILTER (WHERE rn = n // 2 + 1) AS m
          FROM lat_o GROUP BY source_date),
lon_m AS (SELECT source_date,
                 0.5 * max(v) FILTER (WHERE rn = (n - 1) // 2 + 1) + 0.5 * max(v) FILTER (WHERE rn = n // 2 + 1) AS m
          FROM lon_o GROUP BY source_date)""") + """
SELECT a.source_date, a.n AS n_points, a.m AS center_lat, b.m AS center_lon
FROM lat_m a JOIN lon_m b ON a.source_date = b.source_date"""

    q["track_summary"] = _with(pts, """
per AS (SELECT source_date, icao, count(*) AS n_points, min(event_us) AS first_us FROM vp GROUP BY source_date, icao)""") + """
SELECT source_date, icao, n_points, make_timestamp(first_us) AS first_time,
       row_number() OVER (PARTITION BY source_date ORDER BY first_us, icao) AS appearance_rank,
       CAST((row_number() OVER (PARTITION BY source_date ORDER BY first_us, icao) - 1) % 20 AS INTEGER) AS color_index
FROM per"""

    q["tracks"] = _with(pts, _track_pos(), _parts_cte()) + _tracks_sql()

    q["track_endpoints"] = _with(pts, _track_pos()) + """
SELECT source_date, icao, count(*) AS n_points,
       arg_min(latitude, pos) AS first_lat, arg_min(longitude, pos) AS first_lon,
       make_timestamp(arg_min(event_us, pos)) AS first_time,
       arg_max(latitude, pos) AS last_lat, arg_max(longitude, pos) AS last_lon,
       make_timestamp(arg_max(event_us, pos)) AS last_time
FROM tp GROUP BY source_date, icao"""

    props = (
        """'"properties":' || json_object('kind', KIND, 'icao', s.icao, 'source_date', s.source_date,
        'popup', 'ICAO: ' || s.icao || '<br>Points: ' || CAST(s.n_points AS VARCHAR), 'color_index', s.color_index)"""
    )
    q["track_features"] = _with(pts, _track_pos(), _parts_cte(), _zones_cte(), f"""
summ AS (
  SELECT source_date, icao, count(*) AS n_points,
         CAST((row_number() OVER (PARTITION BY source_date ORDER BY min(event_us), icao) - 1) % 20 AS INTEGER) AS color_index,
         arg_min(latitude, pos) AS flat, arg_min(longitude, pos) AS flon,
         arg_max(latitude, pos) AS llat, arg_max(longitude, pos) AS llon
  FROM tp GROUP BY source_date, icao
),
segs AS (
  SELECT source_date, icao, CAST(part AS BIGINT) AS segment,
         string_agg('[' || {_f6('longitude')} || ',' || {_f6('latitude')} || ']', ',' ORDER BY pos) AS coords
  FROM px GROUP BY source_date, icao, part HAVING count(*) > 1
)""") + f"""
SELECT 'track' AS feature_kind, s.source_date, s.icao AS name, g.segment,
       '{{"type":"Feature","geometry":{{"type":"LineString","coordinates":[' || g.coords || ']}},'
       || {props.replace('KIND', "'track'")} || '}}' AS feature
FROM segs g JOIN summ s ON g.source_date = s.source_date AND g.icao = s.icao
UNION ALL
SELECT 'start', s.source_date, s.icao, CAST(NULL AS BIGINT),
       '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || {_f6('s.flon')} || ',' || {_f6('s.flat')}
       || ']}},' || {props.replace('KIND', "'start'")} || '}}'
FROM summ s
UNION ALL
SELECT 'end', s.source_date, s.icao, CAST(NULL AS BIGINT),
       '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || {_f6('s.llon')} || ',' || {_f6('s.llat')}
       || ']}},' || {props.replace('KIND', "'end'")} || '}}'
FROM summ s
UNION ALL
SELECT 'zone', CAST(NULL AS VARCHAR), zone, CAST(NULL AS BIGINT),
       '{{"type":"Feature","geometry":{{"type":"Polygon","coordinates":[[' ||
       array_to_string(list_transform(ring, lambda v: '[' || {_f6('v.lon')} || ',' || {_f6('v.lat')} || ']'), ',')
       || ']]}},"properties":' || json_object('kind', 'zone', 'name', zone) || '}}'
FROM zr"""

    q["valid_dates"] = _with(_DATES) + "\nSELECT date_str, kind, valid FROM vd"

    q["release_tags"] = _with(_DATES) + """
SELECT date_str, CAST(split_part(date_str, '.', 1) AS INTEGER) AS year,
       CASE WHEN CAST(split_part(date_str, '.', 1) AS INTEGER) IN (2024, 2025)
            THEN 'globe_history_' || split_part(date_str, '.', 1) END AS repo,
       'v' || date_str || '-planes-readsb-prod-0' AS tag
FROM vd WHERE valid"""

    tag = P.PAGE_LINK_TAG
    rej = " OR ".join(f"ends_with(link, '{s}')" for s in P.PAGE_LINK_IGNORED)
    q["page_asset_links"] = f"""
WITH found AS (
  SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '(?i)href=["''](/[^"''>]*{tag}[^"''>]*)["'']', 1)) AS link
  FROM pages
)
SELECT page_id, 'https://github.com' || link AS asset_url
FROM found WHERE NOT ({rej}) AND regexp_matches(link, '{P.PAGE_LINK_ACCEPT}')"""

    sfx = ", ".join(f"'{s}'" for s in P.ARCHIVE_SUFFIXES)
    q["archive_groups"] = f"""
WITH f AS (
  SELECT DISTINCT 'v' || strftime(o_orderdate, '%Y.%m.%d') || '-' || CAST(o_orderkey % {P.ARCHIVE_BASES} AS VARCHAR)
         || ([{sfx}])[o_orderkey % {len(P.ARCHIVE_SUFFIXES)} + 1] AS name
  FROM orders
),
k AS (
  SELECT 'downloaded/' || name AS path, name FROM f
  WHERE contains(name, '.tar') AND NOT (ends_with(name, '.tar.gz') OR ends_with(name, '.zip'))
    AND regexp_matches(name, '\\.tar(\\.[a-z]{{2}})?$')
)
SELECT split_part(name, '.tar', 1) AS archive, count(*) AS n_parts, string_agg(path, ',' ORDER BY path) AS parts,
       CASE WHEN count(*) = 1 AND ends_with(max(name), '.tar') THEN 'standalone' ELSE 'multipart' END AS mode
FROM k GROUP BY split_part(name, '.tar', 1)"""

    q["flags_decode"] = _with(pts) + """
SELECT source_date, count(*) AS n_points,
       count(*) FILTER (WHERE (flags_bitfield & 1) <> 0) AS n_stale,
       count(*) FILTER (WHERE (flags_bitfield & 2) <> 0) AS n_new_leg,
       count(*) FILTER (WHERE (flags_bitfield & 4) <> 0) AS n_geom_rate,
       count(*) FILTER (WHERE (flags_bitfield & 8) <> 0) AS n_geom_alt,
       count(*) FILTER (WHERE (flags_bitfield & 1) = 0) AS n_fresh
FROM points GROUP BY source_date"""

    q["dbflags_decode"] = _with(pts) + """
SELECT source_date, count(DISTINCT icao) AS n_aircraft,
       count(DISTINCT CASE WHEN (dbFlags & 1) <> 0 THEN icao END) AS n_military,
       count(DISTINCT CASE WHEN (dbFlags & 2) <> 0 THEN icao END) AS n_interesting,
       count(DISTINCT CASE WHEN (dbFlags & 4) <> 0 THEN icao END) AS n_pia,
       count(DISTINCT CASE WHEN (dbFlags & 8) <> 0 THEN icao END) AS n_ladd
FROM points GROUP BY source_date"""

    q["near_region"] = _with(pts) + """
SELECT source_date, icao, path, seq, event_us, latitude, longitude
FROM vp WHERE latitude BETWEEN 1.5 AND 2.5 AND longitude BETWEEN 104.6 AND 106.0"""

    q["local_windows"] = _with(pts, _windows_cte(P.LOCAL_WINDOWS), """
lp AS (SELECT *, CAST((((event_us + 28800000000) - (((event_us + 28800000000) % 3600000000) + 3600000000) % 3600000000)
                        // 3600000000) % 24 AS INTEGER) AS local_hour FROM points)""") + """
SELECT source_date, w.label AS "window", count(*) AS n_points, count(DISTINCT icao) AS unique_aircraft,
       make_timestamp(min(event_us)) AS time_min, make_timestamp(max(event_us)) AS time_max
FROM lp p JOIN wins w ON p.local_hour >= w.ws AND p.local_hour < w.we GROUP BY source_date, w.label"""

    q["direction_counts"] = _with(pts, """
hd AS (SELECT source_date, icao,
              coalesce(track_deg, TRY_CAST(json_extract_string(aircraft_metadata, '$.true_heading') AS DOUBLE)) AS h
       FROM points),
hd2 AS (SELECT source_date, icao, CASE WHEN h IS NULL THEN NULL ELSE ((h % 360.0) + 360.0) % 360.0 END AS d FROM hd)""") + """
SELECT source_date,
       CASE WHEN d IS NULL THEN NULL WHEN d >= 315 OR d < 45 THEN 'N' WHEN d < 135 THEN 'E' WHEN d < 225 THEN 'S' ELSE 'W' END
         AS direction,
       count(*) AS n_points, count(DISTINCT icao) AS n_aircraft
FROM hd2 GROUP BY 1, 2"""

    q["legs"] = _with(pts, f"""
lp AS (SELECT *, row_number() OVER (PARTITION BY source_date, icao ORDER BY {_ORDER}) AS pos,
              CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN latitude END AS plat,
              CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN longitude END AS plon
       FROM points WHERE icao IS NOT NULL),
lg AS (SELECT *, sum(CASE WHEN (flags_bitfield & 2) <> 0 THEN 1 ELSE 0 END)
                   OVER (PARTITION BY source_date, icao ORDER BY {_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS leg
       FROM lp)""") + """
SELECT source_date, icao, CAST(leg AS BIGINT) AS leg, count(*) AS n_points,
       make_timestamp(arg_min(event_us, pos)) AS start_time, make_timestamp(arg_max(event_us, pos)) AS end_time,
       arg_min(plat, pos) AS start_lat, arg_min(plon, pos) AS start_lon,
       arg_max(plat, pos) AS end_lat, arg_max(plon, pos) AS end_lon
FROM lg GROUP BY source_date, icao, leg"""

    q["movements"] = _with(pts, f"""
g AS (
  SELECT *, (flags_bitfield & {S.FLAG_NEW_LEG}) <> 0 AS new_leg, altitude_ft_num AS alt, ground_speed_kts AS kts, abs(vertical_rate_fpm) AS fpm
  FROM points WHERE icao IS NOT NULL),
st AS (
  SELECT *,
    CASE WHEN on_ground
           OR (alt <= {S.NEAR_ZERO_FT} AND coalesce(kts <= {S.SLOW_KTS}, true) AND coalesce(fpm <= {S.LEVEL_FPM}, true))
           OR (alt IS NULL AND kts <= {S.SLOW_KTS} AND fpm <= {S.LEVEL_FPM}) THEN 'ground'
         WHEN alt >= {S.AIR_FT}
           OR (kts >= {S.FAST_KTS} AND fpm >= {S.CLIMB_FPM} AND coalesce(alt > {S.NEAR_ZERO_FT}, true)) THEN 'air' END AS state
  FROM g),
k AS (
  SELECT *, lag(state) OVER w AS before, lag(event_us) OVER w AS prev_us, count(*) FILTER (WHERE new_leg) OVER w AS leg
  FROM st WHERE state IS NOT NULL OR new_leg
  WINDOW w AS (PARTITION BY source_date, icao ORDER BY {_ORDER}))""") + """
SELECT source_date, icao, leg, CASE WHEN state = 'air' THEN 'departure' ELSE 'arrival' END AS movement,
       datetime_utc AS "time", make_timestamp(prev_us) AS prev_time, latitude, longitude
FROM k WHERE NOT coalesce(new_leg, false) AND ((before = 'ground' AND state = 'air') OR (before = 'air' AND state = 'ground'))"""

    q["zone_membership"] = _with(pts, _zones_cte(), _inside_cte()) + """
SELECT any_value(source_date) AS source_date, any_value(icao) AS icao, make_timestamp(any_value(event_us)) AS "time",
       count(*) AS n_zones, string_agg(zone, ',' ORDER BY zone) AS zones
FROM inside GROUP BY path, seq"""

    q["zone_visits"] = _with(pts, _zones_cte(), _inside_cte(), f"""
prev AS (SELECT path, seq, lag(path) OVER w AS ppath, lag(seq) OVER w AS pseq
         FROM vp WINDOW w AS (PARTITION BY source_date, icao ORDER BY {_ORDER})),
iv AS (
  SELECT i.source_date, i.zone, i.icao, i.event_us, pi.path IS NULL AS visit_start
  FROM inside i JOIN prev pr ON i.path = pr.path AND i.seq = pr.seq
  LEFT JOIN inside pi ON pi.path = pr.ppath AND pi.seq = pr.pseq AND pi.zone = i.zone
)""") + """
SELECT source_date, zone, icao, count(*) AS n_points, count(*) FILTER (WHERE visit_start) AS n_visits,
       make_timestamp(min(event_us)) AS first_inside, make_timestamp(max(event_us)) AS last_inside
FROM iv GROUP BY source_date, zone, icao"""

    q["zone_altitude"] = _with(pts, _zones_cte(), _inside_cte()) + """
SELECT source_date, zone, icao, count(alt) AS n_samples, min(alt) AS min_alt, max(alt) AS max_alt,
       CAST(sum(CAST(alt AS BIGINT)) AS DOUBLE) / count(alt) AS avg_alt
FROM (SELECT *, coalesce(altitude_ft_num, geometric_altitude_ft) AS alt FROM inside WHERE NOT coalesce(on_ground, false))
GROUP BY source_date, zone, icao"""

    q["callsigns"] = _with(pts, """
cs AS (SELECT *, nullif(trim(json_extract_string(aircraft_metadata, '$.flight')), '') AS callsign FROM points)""") + f"""
SELECT source_date, icao, arg_max(callsign, event_us) AS callsign, count(DISTINCT callsign) AS n_callsigns,
       count(*) AS n_points
FROM cs WHERE callsign IS NOT NULL GROUP BY source_date, icao"""

    q["zone_trajectories"] = _with(pts, _zones_cte(), _inside_cte(), """
visitors AS (SELECT DISTINCT zone, source_date, icao FROM inside)""", _track_pos(), _parts_cte(), """
trk AS (""" + _tracks_sql() + ")") + """
SELECT v.zone, t.* FROM visitors v JOIN trk t ON v.source_date = t.source_date AND v.icao = t.icao"""

    sql_type = {"string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT"}
    fields = []
    for f in S.METADATA_SCHEMA.fields:
        kind, text = f.dataType.simpleString(), f"json_extract_string(aircraft_metadata, '$.{f.name}')"
        if kind in sql_type:
            value = f"TRY_CAST({text} AS {sql_type[kind]})"
            if f.name == "alt_baro":
                value = f"coalesce(CAST(TRY_CAST({text} AS BIGINT) AS VARCHAR), {text})"
            fields.append(f'{"trim(" + value + ")" if f.name == "flight" else value} AS "{f.name}"')
    q["metadata_fields"] = _with(pts) + f"""
SELECT source_date, icao, datetime_utc, {", ".join(fields)} FROM points WHERE aircraft_metadata IS NOT NULL"""

    q["metadata_lists"] = _with(pts, """
l AS (SELECT source_date, icao, path, seq, unnest(['nav_modes', 'mlat', 'tisb']) AS field, aircraft_metadata FROM points
      WHERE aircraft_metadata IS NOT NULL),
i AS (SELECT source_date, icao, path, seq, field, CAST(json_extract(aircraft_metadata, '$.' || field) AS VARCHAR[]) AS items FROM l)""") + """
SELECT source_date, icao, path, seq, field, CAST(place - 1 AS INTEGER) AS place, items[place] AS item
FROM (SELECT *, unnest(range(1, len(items) + 1)) AS place FROM i WHERE len(items) > 0)"""

    q["source_mix"] = _with(pts) + """
SELECT source_date, source_type, count(*) AS n_points, count(DISTINCT icao) AS n_aircraft,
       count(*) FILTER (WHERE starts_with(icao, '~')) AS n_non_icao_points
FROM points GROUP BY source_date, source_type"""

    q["hourly_partitions"] = _with(pts) + """
SELECT source_date, hour, count(*) AS n_rows, true AS has_files, true AS has_bytes FROM points GROUP BY source_date, hour"""

    q["points_csv"] = _with(pts) + """
SELECT icao, datetime_utc, latitude, longitude, altitude_ft, ground_speed_kts, flags_bitfield, source_type, aircraft_metadata FROM points"""

    q["fresh_points"] = _with(pts) + """
SELECT source_date, icao, path, seq, event_us, latitude, longitude FROM points WHERE coalesce((flags_bitfield & 1) = 0, true)"""

    q["window_files"] = _with(pts, _windows_cte(P.WINDOWS[1:])) + """
SELECT source_date, w.label AS "window", count(*) AS n_rows, count(DISTINCT icao) AS n_aircraft, min(event_us) AS first_us
FROM points p JOIN wins w ON p.hour >= w.ws AND p.hour < w.we GROUP BY source_date, w.label"""

    q["stream_ingest"] = _with(pts, _zones_cte(), _inside_cte(), """
mem AS (SELECT source_date, count(DISTINCT path || '/' || CAST(seq AS VARCHAR)) AS n_inside, count(*) AS n_memberships FROM inside GROUP BY 1)""") + """
SELECT p.source_date, count(*) AS n_rows, count(DISTINCT icao) AS n_aircraft, count(DISTINCT path) AS n_docs,
       count(DISTINCT hour) AS n_hours, coalesce(max(n_inside), 0) AS n_inside, coalesce(max(n_memberships), 0) AS n_memberships
FROM points p LEFT JOIN mem m ON p.source_date = m.source_date GROUP BY p.source_date"""

    q["stream_hourly_counts"] = _with(pts, """
b AS (SELECT min(event_us) AS lo, max(event_us) AS hi FROM points),
land AS (
  SELECT event_us, least(2, (event_us - lo) * 3 // (hi - lo + 1) + CASE WHEN bad_after THEN 1 ELSE 0 END) AS slice FROM points, b),
wm AS (SELECT slice + 1 AS slice, max(max(event_us)) OVER (ORDER BY slice) // 1000 * 1000 - 3600000000 AS bound FROM land GROUP BY slice),
t AS (
  SELECT event_us // 3600000000 * 3600000000 AS h, coalesce(event_us // 3600000000 * 3600000000 + 3600000000 <= bound, false) AS late
  FROM land LEFT JOIN wm USING (slice))""") + """
SELECT make_timestamp(h) AS hour_start, count(*) FILTER (WHERE NOT late) AS n_rows, count(*) FILTER (WHERE late) AS n_late
FROM t GROUP BY h"""

    return q
