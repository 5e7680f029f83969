"""Release-asset link scan over HTML pages.

Per page: every root-relative ``href`` value containing the tag
(case-insensitive), de-duplicated, then filtered by suffix — rejected
suffixes first (``.tar.gz`` would otherwise pass the ``.tar.xx`` rule), then
the accept pattern — and prefixed with the host. The value may not contain
quotes or ``>``, so a match never runs from one attribute into the next.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S


def link_pattern(tag: str) -> str:
    """Java-regex: ``href="/...<tag>..."`` with the tag taken literally."""
    lit = re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", tag)
    return "(?i)href=[\"'](/[^\"'>]*" + lit + "[^\"'>]*)[\"']"


def asset_links(pages: DataFrame, tag: str, ignored=tuple(S.ASSET_IGNORED_SUFFIXES),
                accept: str = S.ASSET_ACCEPT_PATTERN, host: str = S.ASSET_HOST) -> DataFrame:
    """``pages(page_id, html)`` → distinct ``(page_id, asset_url)``."""
    found = pages.select(
        "page_id", F.explode(F.regexp_extract_all("html", F.lit(link_pattern(tag)), 1)).alias("link")
    ).distinct()
    rejected = F.lit(False)
    for suffix in ignored:
        rejected = rejected | F.col("link").endswith(suffix)
    kept = found.where(~rejected & F.col("link").rlike(accept))
    return kept.select("page_id", F.concat(F.lit(host), F.col("link")).alias("asset_url"))
