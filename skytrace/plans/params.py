"""Run parameters of the registered queries (the user-supplied inputs).

Zones are DMS text exactly as a polygon file holds it, so the DMS parser runs
on every zone query. ``box`` is the study's near-region box; ``tri`` and
``ell`` (concave) make the distinct counts discriminating.
"""

from __future__ import annotations

# Query parameters.
ZONES_DMS = {
    "box": "013000N 1043600E\n023000N 1043600E\n023000N 1060000E\n013000N 1060000E\n",
    "tri": "010600N 1041200E\n025400N 1053000E\n011200N 1061800E\n",
    "ell": (
        "011500N 1043000E\n011500N 1061500E\n014500N 1061500E\n"
        "014500N 1050000E\n024500N 1050000E\n024500N 1043000E\n"
    ),
}

# label, start hour (inclusive), end hour (exclusive), UTC.
WINDOWS = [("0100-0400", 1, 4), ("1100-1300", 11, 13)]

# Local-time (GMT+8) study windows: label, start, end local hour.
LOCAL_WINDOWS = [("0900-1200", 9, 12), ("1900-2100", 19, 21)]

# One window for the single-window filter query.
WINDOW_FILTER = (1, 4)

# Points per track part. A part also repeats the last point of the part before,
# so the parts draw the whole track; the size only bounds a row's list.
TRACK_SEGMENT_POINTS = 1000

# Link-scan parameters over the ``pages`` table. The pages hold no release
# assets, so a path fragment stands in for the release tag, and the suffix
# rule has the same shape as the asset rule (reject list first, then an
# accept pattern) with suffixes that occur in the pages.
PAGE_LINK_TAG = "th"
PAGE_LINK_IGNORED = [",", "."]
PAGE_LINK_ACCEPT = r"[a-z]{2}$"

# Number of base names the synthetic archive listing cycles over.
ARCHIVE_BASES = 7

# Suffixes the synthetic archive listing cycles over.
ARCHIVE_SUFFIXES = [".tar", ".tar.aa", ".tar.ab", ".tar.gz", ".zip"]
