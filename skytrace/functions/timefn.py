"""Time expressions, all independent of ``spark.sql.session.timeZone``.

An instant is carried as ``event_us`` (BIGINT epoch microseconds, UTC) and
shown as ``datetime_utc`` (TIMESTAMP_NTZ). Neither goes through the session
time zone: NTZ values are built with ``timestampadd`` from a fixed epoch and
rendered with ``cast(... as string)``, never with ``date_format``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

US_PER_SECOND = 1_000_000
US_PER_HOUR = 3_600_000_000
US_PER_DAY = 86_400_000_000

# Seconds range of years 1..9999; outside it an instant has no calendar form.
_MIN_EPOCH_S = -62135596800.0
_MAX_EPOCH_S = 253402300800.0



def epoch_ntz() -> Column:
    """``1970-01-01 00:00:00`` as TIMESTAMP_NTZ."""
    return F.expr("timestamp_ntz'1970-01-01 00:00:00'")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_us(base_seconds, offset_seconds) -> Column:
    """``base + offset`` seconds → epoch µs, rounded half-to-even to the µs.

    Same rounding as converting the float sum to a calendar time with µs
    resolution; a plain cast truncates instead. Null when either side is null
    or the instant is outside years 1..9999.
    """
    x = _c(base_seconds) + _c(offset_seconds)
    whole = F.floor(x)
    us = whole.cast("bigint") * F.lit(US_PER_SECOND) + F.rint(
        (x - whole) * F.lit(1e6)
    ).cast("bigint")
    return F.when((x >= F.lit(_MIN_EPOCH_S)) & (x < F.lit(_MAX_EPOCH_S)), us)


def ntz_from_us(us) -> Column:
    """Epoch µs → TIMESTAMP_NTZ (UTC wall clock)."""
    return F.timestamp_add("MICROSECOND", _c(us), epoch_ntz())


def us_from_ntz(ts) -> Column:
    """TIMESTAMP_NTZ → epoch µs, read as UTC wall clock.

    Built from the wall-clock fields with an explicit UTC zone: a
    ``timestamp_diff`` would cast the NTZ value through the session time
    zone, which moves wall-clock times that do not exist there (the
    spring-forward hour) by the DST offset.
    """
    t = _c(ts)
    return F.unix_micros(
        F.make_timestamp(
            F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t),
            F.date_part(F.lit("SECOND"), t), F.lit("UTC"),
        )
    )


def floor_div(x, d: int) -> Column:
    """Integer division rounding toward minus infinity (``div`` truncates)."""
    x = _c(x)
    return F.floor((x - F.pmod(x, F.lit(d))) / F.lit(d)).cast("bigint")


def hour_of_day(us) -> Column:
    """UTC hour 0..23 of an epoch-µs instant (correct before 1970 too)."""
    return F.pmod(floor_div(us, US_PER_HOUR), F.lit(24)).cast("int")


def seconds_floor_us(us) -> Column:
    """Epoch µs truncated (toward minus infinity) to whole seconds, still in µs."""
    x = _c(us)
    return x - F.pmod(x, F.lit(US_PER_SECOND))


def iso_utc(us) -> Column:
    """ISO-8601 text ``YYYY-MM-DDTHH:MM:SS[.ffffff]+00:00``; no fraction at 0 µs."""
    x = _c(us)
    frac = F.pmod(x, F.lit(US_PER_SECOND))
    whole = ntz_from_us(x - frac).cast("string")
    frac_txt = F.when(frac == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.lpad(frac.cast("string"), 6, "0"))
    )
    return F.when(
        x.isNotNull(), F.concat(F.regexp_replace(whole, " ", "T"), frac_txt, F.lit("+00:00"))
    )


def utc_seconds_text(us) -> Column:
    """``YYYY-MM-DD HH:MM:SS UTC`` (fraction dropped, as a strftime with %S)."""
    x = _c(us)
    return F.concat(ntz_from_us(seconds_floor_us(x)).cast("string"), F.lit(" UTC"))


def hour_range_label(hour) -> Column:
    """Hour bucket label ``HH00-HH00``; hour 23 gives ``2300-2400``."""
    h = _c(hour)
    return F.concat(
        F.lpad(h.cast("string"), 2, "0"),
        F.lit("00-"),
        F.lpad((h + 1).cast("string"), 2, "0"),
        F.lit("00"),
    )


def hourly_file_name(source_date, hour, ext: str = "csv") -> Column:
    """Hourly partition file name ``YYYY_MM_DD_HH00-HH00.<ext>``."""
    return F.concat(
        F.regexp_replace(_c(source_date), r"\.", "_"),
        F.lit("_"),
        hour_range_label(hour),
        F.lit("." + ext),
    )


def source_date_of_ntz(ts) -> Column:
    """``YYYY.MM.DD`` of a TIMESTAMP_NTZ (casting NTZ to DATE ignores time zones)."""
    return F.regexp_replace(_c(ts).cast("date").cast("string"), "-", ".")
