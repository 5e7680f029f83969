"""Trace documents derived from the ``events`` table (test fixture F1).

The driver tables hold no aircraft traces, so every trace query starts here:
each event becomes one trace entry, serialised to JSON text, and the entries
of one aircraft-day are assembled into one document string, which then goes
through the real parse path (``operators.flatten``).

Every derived value is plain arithmetic on event columns that DuckDB
evaluates identically, so the oracle SQL can compute the same points straight
from ``events`` (see ``plans.oracle``).

Scale: a document groups the events of one (icao, source_date) that fall in
one block of ``block_events`` consecutive event ids, so a document holds at
most ``block_events`` entries however hot a single aircraft is. The
``collect_list`` behind it is therefore bounded per group; the grouping is a
hash shuffle on (icao, source_date, block) whose partial aggregation cannot
combine rows (it builds lists), which is the cost of producing documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import US_PER_DAY, source_date_of_ntz, us_from_ntz

# Fixed values of the fixture (see FIXTURES.md, F1).
SOURCE_TYPES = ["adsb_icao", "mlat", "tisb_icao", "adsr_icao"]
AIRCRAFT_TYPES = ["A320", "B738", "A359", "AT76"]
DEFAULT_BLOCK_EVENTS = 4096
# Every event with event_id % BAD_ENTRY_EVERY == 0 is followed by a malformed
# entry (the number 7), so whole-table checks cover the bad-entry path.
BAD_ENTRY_EVERY = 211
BAD_ENTRY_TEXT = "7"
# Documents with (user_id + block) % BAD_DOC_EVERY == 3 are followed by a text
# that is no document, those with 4 by one with an empty trace.
BAD_DOC_EVERY = 50
BAD_DOC_TEXT = "no document"


def _num(c: Column) -> Column:
    """JSON number text of a column, ``null`` for null."""
    return F.coalesce(c.cast("string"), F.lit("null"))


def _str(c: Column) -> Column:
    """JSON string text of a column (no escaping needed for fixture values)."""
    return F.coalesce(F.concat(F.lit('"'), c, F.lit('"')), F.lit("null"))


def _fields(get) -> dict[str, Column]:
    """Every trace field of the fixture from raw event fields (``get(name)``:
    ``event_id``, ``user_id``, ``us``, ``event_type``, ``value``)."""
    eid = get("event_id")
    us = get("us")
    day_s = F.floor(us / F.lit(US_PER_DAY)).cast("bigint") * F.lit(86400)
    offset = F.floor((us - day_s * F.lit(1_000_000)) / F.lit(1e3)).cast("double") / F.lit(1e3)
    value_alt = F.floor(get("value") * F.lit(100)).cast("bigint")
    heading = (eid * 53 % 3600) / F.lit(1e1)
    text = lambda c: c.cast("string")
    # Every tenth snapshot has fields of all kinds: a number or "ground", whole
    # numbers sent as floats, lists (also empty, also missing).
    more = F.concat(
        F.lit(',"alt_baro":'), F.when(eid % 60 == 0, F.lit('"ground"')).otherwise(F.concat(text(eid % 400 * 100), F.lit(".0"))),
        F.lit(',"squawk":"'), F.lpad(text(eid % 7778), 4, "0"), F.lit('","category":"A'), text(eid % 8),
        F.lit('","emergency":"none","nic":'), text(eid % 12), F.lit('.0,"version":2,"rssi":-'), text(eid % 40), F.lit(".5"),
        F.when(eid % 120 < 90, F.lit(',"nav_modes":["autopilot","vnav"],"mlat":["lat","lon"],"tisb":[]')).otherwise(F.lit(',"nav_modes":["lnav"]')),
    )
    meta = F.when(
        eid % 3 == 0,
        F.concat(
            F.lit('{"flight":"FL'),
            get("user_id").cast("string"),
            F.lit(' ","true_heading":'),
            heading.cast("string"),
            F.when(eid % 30 == 0, more).otherwise(F.lit("")),
            F.lit("}"),
        ),
    )
    return {
        "timestamp": day_s.cast("double"),
        "seconds_after_timestamp": offset,
        "latitude": F.when(eid % 97 != 0, F.lit(1e0) + (eid * 7919 % 20000) / F.lit(1e4)),
        "longitude": F.lit(104e0) + (eid * 104729 % 25000) / F.lit(1e4),
        "altitude_ft": F.when(get("event_type") == "error", F.lit("ground")).otherwise(value_alt.cast("string")),
        "ground_speed_kts": (eid * 13 % 6000) / F.lit(1e1),
        "track_deg": F.when(eid % 5 != 0, (eid * 37 % 3600) / F.lit(1e1)),
        "flags_bitfield": (eid % 16).cast("int"),
        "vertical_rate_fpm": ((eid % 4001) - 2000).cast("int"),
        "aircraft_metadata": meta,
        "source_type": F.element_at(F.array(*[F.lit(x) for x in SOURCE_TYPES]), (eid % 4 + 1).cast("int")),
        "geometric_altitude_ft": F.when(eid % 7 != 0, value_alt + eid % 50).cast("int"),
        "geometric_vertical_rate_fpm": ((eid % 3001) - 1500).cast("int"),
        "indicated_airspeed_kts": (eid * 17 % 4000) / F.lit(1e1),
        "roll_angle_deg": (((eid * 3 % 600) - 300) / F.lit(1e1)),
    }


def _raw(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id", "user_id", us_from_ntz(F.col("ts")).alias("us"), "event_type", "value",
        F.lower(F.lpad(F.hex(F.col("user_id")), 6, "0")).alias("icao"),
        source_date_of_ntz(F.col("ts")).alias("source_date"),
    )


def _entry_json(f: dict[str, Column]) -> Column:
    alt = F.when(f["altitude_ft"] == "ground", F.lit('"ground"')).otherwise(f["altitude_ft"])
    return F.concat(
        F.lit("["),
        F.concat_ws(
            ",",
            _num(f["seconds_after_timestamp"]),
            _num(f["latitude"]),
            _num(f["longitude"]),
            alt,
            _num(f["ground_speed_kts"]),
            _num(f["track_deg"]),
            _num(f["flags_bitfield"]),
            _num(f["vertical_rate_fpm"]),
            F.coalesce(f["aircraft_metadata"], F.lit("null")),
            _str(f["source_type"]),
            _num(f["geometric_altitude_ft"]),
            _num(f["geometric_vertical_rate_fpm"]),
            _num(f["indicated_airspeed_kts"]),
            _num(f["roll_angle_deg"]),
        ),
        F.lit("]"),
    )


def trace_docs_from_events(events: DataFrame, block_events: int = DEFAULT_BLOCK_EVENTS) -> DataFrame:
    """``events`` → ``(path, source_date, content)``: one JSON trace document per
    (icao, source_date, event-id block), entries ordered by ``event_id``; a
    malformed entry follows every event whose id is a multiple of
    ``BAD_ENTRY_EVERY``, and some documents are followed by one that fails.

    Raw events are hash-partitioned on the document key first; the entry text
    is then built per row (whole-stage codegen, in parallel reduce tasks) and
    the grouping reuses that partitioning, so there is a single shuffle.
    """
    keys = ["icao", "source_date", "block"]
    raw = _raw(events).withColumn(
        "block", F.floor(F.col("event_id") / F.lit(block_events)).cast("bigint")
    ).repartition(*keys)
    f = _fields(F.col)
    # The entry's text is written once in the expression: with a second copy for
    # the malformed one, the generated method is too long for the JVM to compile.
    bad = F.when(F.col("event_id") % BAD_ENTRY_EVERY == 0, F.lit("," + BAD_ENTRY_TEXT)).otherwise(F.lit(""))
    entry = F.concat(_entry_json(f), bad)
    rows = raw.select(*keys, "event_id", "user_id", f["timestamp"].alias("timestamp"), entry.alias("entry"))
    docs = rows.groupBy(*keys).agg(
        F.first("user_id").alias("user_id"),
        F.first("timestamp").alias("timestamp"),
        F.sort_array(F.collect_list(F.struct("event_id", "entry"))).alias("ev"),
    )
    entries = F.transform("ev", lambda e: e["entry"])
    base_ts = F.col("timestamp")
    uid = F.col("user_id")
    header = F.concat(
        F.lit('{"icao":"'),
        F.col("icao"),
        F.lit('","timestamp":'),
        base_ts.cast("string"),
        F.lit(',"r":"9V-'),
        F.upper(F.col("icao")),
        F.lit('","t":"'),
        F.element_at(F.array(*[F.lit(t) for t in AIRCRAFT_TYPES]), (uid % 4 + 1).cast("int")),
        F.lit('","dbFlags":'),
        (uid % 16).cast("string"),
        F.lit(',"year":"'),
        (uid % 25 + 2000).cast("string"),
        F.lit('"'),
        F.when(uid % 2 == 0, F.concat(F.lit(',"ownOp":"OPERATOR '), uid.cast("string"), F.lit('"')))
        .otherwise(F.lit("")),
        F.lit(',"trace":['),
    )
    kind = (uid + F.col("block")) % BAD_DOC_EVERY
    versions = F.array_compact(F.array(
        F.struct(F.lit("").alias("mark"), F.concat(header, F.array_join(entries, ","), F.lit("]}")).alias("content")),
        F.when(kind == 3, F.struct(F.lit("x").alias("mark"), F.lit(BAD_DOC_TEXT).alias("content"))),
        F.when(kind == 4, F.struct(F.lit("e").alias("mark"), F.concat(header, F.lit("]}")).alias("content"))),
    ))
    path = F.concat(
        F.lit("traces/"),
        F.col("source_date"),
        F.lit("/trace_full_"),
        F.col("icao"),
        F.lit("-"),
        F.col("block").cast("string"),
        F.col("mark"),
        F.lit(".json"),
    )
    return docs.select("source_date", "icao", "block", F.inline(versions)).select(path.alias("path"), "source_date", "content")
