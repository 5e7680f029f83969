"""Bit-flag decoding, date validation, release tags and asset-link rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schema as S


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def has_bit(value, bit: int) -> Column:
    """True when ``bit`` is set; null when ``value`` is null."""
    return _c(value).bitwiseAND(F.lit(bit)) != 0


def trace_flag_columns(flags="flags_bitfield") -> list[Column]:
    """The four trace flags of entry index 6 as booleans."""
    return [
        has_bit(flags, S.FLAG_STALE).alias("is_stale"),
        has_bit(flags, S.FLAG_NEW_LEG).alias("is_new_leg"),
        has_bit(flags, S.FLAG_GEOM_RATE).alias("is_geom_rate"),
        has_bit(flags, S.FLAG_GEOM_ALT).alias("is_geom_alt"),
    ]


def db_flag_columns(flags="dbFlags") -> list[Column]:
    """The four document-level database flags as booleans."""
    return [
        has_bit(flags, S.DBFLAG_MILITARY).alias("is_military"),
        has_bit(flags, S.DBFLAG_INTERESTING).alias("is_interesting"),
        has_bit(flags, S.DBFLAG_PIA).alias("is_pia"),
        has_bit(flags, S.DBFLAG_LADD).alias("is_ladd"),
    ]


def is_valid_date(date_str) -> Column:
    """Strict ``YYYY.MM.DD`` (zero-padded) that names a real calendar day."""
    d = _c(date_str)
    return F.coalesce(
        d.rlike(r"^\d{4}\.\d{2}\.\d{2}$")
        & F.try_to_date(d, "yyyy.MM.dd").isNotNull(),
        F.lit(False),
    )


def release_tag(date_str) -> Column:
    """``v<YYYY.MM.DD>-planes-readsb-prod-0``."""
    return F.concat(F.lit("v"), _c(date_str), F.lit(S.RELEASE_TAG_SUFFIX))


def release_year(date_str) -> Column:
    return F.split(_c(date_str), r"\.").getItem(0).try_cast("int")


def release_repo(date_str) -> Column:
    """Repository holding the date's release, null for an unsupported year."""
    y = release_year(date_str)
    return F.when(y.isin(*S.RELEASE_YEARS), F.concat(F.lit("globe_history_"), y.cast("string")))


def accepted_asset(path) -> Column:
    """Suffix rule: reject ``.tar.gz``/``.zip`` first, then accept ``.tar[.xx]``."""
    p = _c(path)
    rejected = F.lit(False)
    for suffix in S.ASSET_IGNORED_SUFFIXES:
        rejected = rejected | p.endswith(suffix)
    return ~rejected & p.rlike(S.ASSET_ACCEPT_PATTERN)


def archive_base(name) -> Column:
    """Archive base name: the text before the first ``.tar``."""
    return F.substring_index(_c(name), ".tar", 1)
