"""Trace flattening: JSON documents → typed, time-stamped point rows.

One narrow stage: parse (``from_json`` with a fixed schema) → ``posexplode``
the trace → positional projection → µs instant → hour bucket → drop rows
without a time. No shuffle, no Python.

Entry rules (bound in tests):

* a document is parsed once with its trace typed as arrays; only when an
  entry is malformed (``null``, a number, an object) its document's entries
  are parsed one by one, so the bad entry is skipped and counted and the
  others stay;
* short entries are padded with null, extra elements are ignored (``get``);
* ``[]`` is a valid entry: offset 0, every trace column null;
* index 3 is ``int | "ground" | null``: kept verbatim as text, plus
  ``altitude_ft_num`` (via DOUBLE, so ``3500.0`` parses) and ``on_ground``;
* index 8 (metadata object) stays raw JSON text with its key order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.timefn import epoch_us, hour_of_day, ntz_from_us

ENTRY_TYPE = "array<string>"



def _to_double(c: Column) -> Column:
    return c.try_cast("double")


def _to_int(c: Column) -> Column:
    return c.try_cast("double").try_cast("int")


def parse_docs(docs: DataFrame) -> DataFrame:
    """``(path, source_date, content)`` → document columns plus ``doc`` struct
    (null when the text is not a JSON object)."""
    return docs.select(
        "path", "source_date", F.from_json("content", S.DOC_SCHEMA).alias("doc")
    )


CORRUPT = {"columnNameOfCorruptRecord": "_corrupt_record"}


def _with_doc(docs: DataFrame) -> DataFrame:
    """Add the parsed document (fast schema) next to its text."""
    return docs.select("path", "source_date", "content",
                       F.from_json("content", S.DOC_SCHEMA_NESTED, CORRUPT).alias("doc"))


def _parsed() -> Column:
    """The text is a JSON object. A record the fast parse marks corrupt may
    only hold a malformed entry; the raw-entry schema decides (parsed only
    for those documents)."""
    slow = F.from_json(F.col("content"), S.DOC_SCHEMA_STATUS, CORRUPT)
    doc = F.col("doc")
    return (
        F.when(doc.isNull(), F.lit(False))
        .when(doc["_corrupt_record"].isNull(), F.lit(True))
        .otherwise(slow.isNotNull() & slow["_corrupt_record"].isNull())
    )


def _trace() -> Column:
    """Trace as ARRAY<ARRAY<STRING>> (null element = malformed entry).

    Fast path: the document was parsed once with the trace typed as arrays of
    strings. A single malformed entry makes that trace null; only for those
    documents the trace is read as raw entry texts and each entry parsed on
    its own, so the bad entry becomes a null element and the others stay.
    """
    slow = F.from_json(F.col("content"), S.DOC_SCHEMA)["trace"]
    return F.coalesce(F.col("doc")["trace"], F.transform(slow, lambda e: F.from_json(e, ENTRY_TYPE)))


def _entry_offset_arr(arr: Column) -> Column:
    """Offset of one parsed entry: element 0, or 0 for an empty entry."""
    return F.when(F.size(arr) == 0, F.lit(0.0)).otherwise(_to_double(F.get(arr, 0)))


def explode_entries(docs: DataFrame) -> DataFrame:
    """One row per trace entry: doc keys, ``seq`` position, parsed ``arr``
    (null for a malformed entry)."""
    top = [F.col("doc")[k].alias(k) for k in S.TOP_LEVEL_KEYS]
    return _with_doc(docs).select(
        "path",
        "source_date",
        *top,
        F.posexplode(_trace()).alias("seq", "arr"),
    )


def flatten_docs(docs: DataFrame) -> DataFrame:
    """Documents → point rows (23 point columns, path, source_date, seq,
    event_us, hour, altitude_ft_num, on_ground).

    Rows whose instant is null (no base timestamp, null offset, out of range)
    are dropped, as they cannot be routed to an hour.
    """
    e = explode_entries(docs).where(F.col("arr").isNotNull())
    arr = F.col("arr")
    g = lambda i: F.get(arr, i)  # noqa: E731 - null when the entry is short
    offset = _entry_offset_arr(arr)
    cols = {
        "seconds_after_timestamp": _to_double(g(0)),
        "latitude": _to_double(g(1)),
        "longitude": _to_double(g(2)),
        "altitude_ft": g(3),
        "ground_speed_kts": _to_double(g(4)),
        "track_deg": _to_double(g(5)),
        "flags_bitfield": _to_int(g(6)),
        "vertical_rate_fpm": _to_int(g(7)),
        "aircraft_metadata": g(8),
        "source_type": g(9),
        "geometric_altitude_ft": _to_int(g(10)),
        "geometric_vertical_rate_fpm": _to_int(g(11)),
        "indicated_airspeed_kts": _to_double(g(12)),
        "roll_angle_deg": _to_double(g(13)),
    }
    pts = e.select(
        "path",
        "source_date",
        "seq",
        "icao",
        F.col("timestamp"),
        "r",
        "t",
        "desc",
        _to_int(F.col("dbFlags")).alias("dbFlags"),
        "year",
        "ownOp",
        epoch_us("timestamp", offset).alias("event_us"),
        *[c.alias(n) for n, c in cols.items()],
    ).where(F.col("event_us").isNotNull())
    return pts.select(
        *S.TOP_LEVEL_KEYS,
        ntz_from_us("event_us").alias("datetime_utc"),
        *S.TRACE_COLUMNS,
        "path",
        "source_date",
        "seq",
        "event_us",
        hour_of_day("event_us").alias("hour"),
        _to_int(F.col("altitude_ft")).alias("altitude_ft_num"),
        (F.lower(F.col("altitude_ft")) == "ground").alias("on_ground"),
    )


def doc_status(docs: DataFrame) -> DataFrame:
    """Per document: parsed?, entries, bad entries, routable rows, status,
    and ``hour_mask`` (bit h set when a routable row falls in UTC hour h).

    A document is ``processed`` when it yields at least one routable row,
    else ``failed`` (bad JSON, empty trace, or no entry with a time). Bad
    entries are counted, and do not fail the document.

    Entries are exploded and their instants computed in a codegen'd
    projection (higher-order functions over the array would be
    interpreted); a partial aggregation per document then folds each
    document's entries where they already sit, so only one row per
    document is shuffled.
    """
    d = _with_doc(docs).select(
        "path", "source_date",
        _parsed().alias("parsed"),
        F.col("doc")["timestamp"].alias("_ts"),
        _trace().alias("_trace"),
    )
    n = F.coalesce(F.size("_trace"), F.lit(0))
    e = d.select("path", "source_date", "parsed", "_ts", n.alias("_n"), F.explode_outer("_trace").alias("_a"))
    us = F.when(F.col("_a").isNotNull(), epoch_us("_ts", _entry_offset_arr(F.col("_a"))))
    e = e.withColumn("_us", us)
    g = e.groupBy("path", "source_date").agg(
        F.first("parsed").alias("parsed"),
        F.first("_n").alias("_n"),
        F.count_if(F.col("_a").isNull() & (F.col("_n") > 0)).alias("_bad"),
        F.count("_us").alias("_rows"),
        F.bit_or(F.pow(F.lit(2), hour_of_day("_us")).cast("int")).alias("_mask"),
    )
    return g.select(
        "path",
        "source_date",
        "parsed",
        F.col("_n").cast("int").alias("n_entries"),
        F.col("_bad").cast("int").alias("n_bad_entries"),
        F.col("_rows").cast("int").alias("n_rows"),
        F.when(F.col("_rows") > 0, F.lit("processed")).otherwise(F.lit("failed")).alias("status"),
        F.coalesce(F.col("_mask"), F.lit(0)).alias("hour_mask"),
    )
