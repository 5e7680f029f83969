"""Compressed trace files and split tar archives, read in Spark tasks.

* ``read_gzip_traces``: ``traces/<2 chars>/*.json`` files whose content is
  gzip (the name says ``.json``, so Spark's extension-based codecs do not
  apply). ``binaryFile`` lists and reads them, one file per row; a vectorised
  pandas UDF inflates each batch. A corrupt file gives null text and a status,
  the batch continues. Arrow batches hold
  ``spark.sql.execution.arrow.maxRecordsPerBatch`` files; for large trace
  files lower it (e.g. 256) so a batch stays within a few hundred MB.
* ``tar_member_index`` / ``read_tar_members``: an archive is one ``.tar`` or
  several parts ``.tar.aa``, ``.tar.ab``, ... whose byte concatenation is the
  tar. One task per archive walks the 512-byte headers (seeking over member
  data, not reading it) and emits ``(archive, member, offset, size)``; the
  members are then spread over tasks and each reads its byte range, which
  may cross a part boundary. Nothing is unpacked to local disk. Files are
  opened through ``pyarrow.fs`` so any URI the cluster uses works.
"""

from __future__ import annotations

import gzip
import io
import re
import tarfile
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .trace_docs import date_of_path

GUNZIP_SCHEMA = T.StructType([T.StructField("text", T.StringType()), T.StructField("status", T.StringType())])


def _inflate(blob: bytes | None) -> tuple[str | None, str]:
    if blob is None:
        return None, "missing"
    try:
        return gzip.decompress(blob).decode("utf-8"), "ok"
    except (OSError, EOFError, zlib.error, UnicodeDecodeError) as e:
        return None, f"error: {type(e).__name__}"


@F.pandas_udf(GUNZIP_SCHEMA)
def gunzip_text(content: pd.Series) -> pd.DataFrame:
    """BINARY gzip blob → (text, status) per row, one Arrow batch at a time."""
    out = [_inflate(b) for b in content]
    return pd.DataFrame(out, columns=["text", "status"])


def read_gzip_traces(spark: SparkSession, traces_dir: str) -> DataFrame:
    """``traces/??/*.json`` (gzip content) → ``(path, source_date, content, status)``."""
    raw = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.json")
        .load(f"{traces_dir.rstrip('/')}/??/")
    )
    bucket = F.regexp_extract("path", r"/([^/]{2})/[^/]*$", 1)
    g = raw.where(F.length(bucket) == 2).select("path", gunzip_text("content").alias("g"))
    return g.select(
        "path",
        date_of_path(F.col("path")).alias("source_date"),
        F.col("g.text").alias("content"),
        F.col("g.status").alias("status"),
    )


# ---------------------------------------------------------------------------
# split tar archives
# ---------------------------------------------------------------------------

class _Concat(io.RawIOBase):
    """Seekable read-only view of several files as one byte stream."""

    def __init__(self, paths: list[str]):
        from pyarrow import fs as pafs

        self._files = []
        self._starts = []
        pos = 0
        for p in paths:
            local = re.sub(r"^file:(//)?", "", p)
            if "://" in local:
                fs, inner = pafs.FileSystem.from_uri(local)
            else:
                fs, inner = pafs.LocalFileSystem(), local
            f = fs.open_input_file(inner)
            self._files.append(f)
            self._starts.append(pos)
            pos += f.size()
        self._size = pos
        self._pos = 0

    def readable(self):
        return True

    def seekable(self):
        return True

    def tell(self):
        return self._pos

    def seek(self, offset, whence=io.SEEK_SET):
        base = {io.SEEK_SET: 0, io.SEEK_CUR: self._pos, io.SEEK_END: self._size}[whence]
        self._pos = max(0, base + offset)
        return self._pos

    def readinto(self, b):
        want = len(b)
        got = 0
        while got < want and self._pos < self._size:
            i = max(j for j, s in enumerate(self._starts) if s <= self._pos)
            f = self._files[i]
            f.seek(self._pos - self._starts[i])
            chunk = f.read(min(want - got, f.size() - (self._pos - self._starts[i])))
            if not chunk:
                break
            b[got:got + len(chunk)] = chunk
            got += len(chunk)
            self._pos += len(chunk)
        return got

    def close(self):
        for f in self._files:
            f.close()
        super().close()


MEMBER_SCHEMA = "archive STRING, parts STRING, member STRING, offset BIGINT, size BIGINT, status STRING"


def _index_archives(batches):
    for pdf in batches:
        rows = []
        for archive, parts in zip(pdf["archive"], pdf["parts"]):
            paths = parts.split(",")
            try:
                with _Concat(paths) as stream, tarfile.open(fileobj=stream, mode="r:") as tar:
                    for m in tar:
                        if m.isfile():
                            rows.append((archive, parts, m.name, m.offset_data, m.size, "ok"))
            except (tarfile.TarError, OSError, ValueError) as e:
                rows.append((archive, parts, None, None, None, f"error: {type(e).__name__}"))
        yield pd.DataFrame(rows, columns=["archive", "parts", "member", "offset", "size", "status"])


def tar_member_index(groups: DataFrame) -> DataFrame:
    """``(archive, parts)`` (parts = comma-joined ordered paths) → one row per
    file member; a failing archive yields one error row and the others go on."""
    return groups.select("archive", "parts").repartition("archive").mapInPandas(_index_archives, MEMBER_SCHEMA)


CONTENT_SCHEMA = "archive STRING, parts STRING, member STRING, content BINARY"


MAX_BATCH_BYTES = 64 << 20


def _read_members(batches):
    """Member byte ranges → contents, emitted in batches of at most
    ``MAX_BATCH_BYTES`` so a task never holds many members at once."""
    cols = ["archive", "parts", "member", "content"]
    for pdf in batches:
        out, held = [], 0
        streams: dict[str, _Concat] = {}  # parts opened once per batch
        try:
            for archive, parts, member, offset, size in zip(
                pdf["archive"], pdf["parts"], pdf["member"], pdf["offset"], pdf["size"]
            ):
                stream = streams.get(parts)
                if stream is None:
                    stream = streams[parts] = _Concat(parts.split(","))
                stream.seek(int(offset))
                out.append((archive, parts, member, stream.read(int(size))))
                held += int(size)
                if held >= MAX_BATCH_BYTES:
                    yield pd.DataFrame(out, columns=cols)
                    out, held = [], 0
        finally:
            for stream in streams.values():
                stream.close()
        if out:
            yield pd.DataFrame(out, columns=cols)


def read_tar_members(index: DataFrame, member_glob: str = r"(^|/)traces/[^/]{2}/[^/]+\.json$") -> DataFrame:
    """Member rows → member bytes, members spread over tasks (``rebalance``)."""
    m = index.where((F.col("status") == "ok") & F.col("member").rlike(member_glob))
    # Members of one archive stay together in offset order (fewer opens,
    # forward reads); large archives still spread over several tasks.
    m = m.repartitionByRange("archive", "offset").sortWithinPartitions("archive", "offset")
    return m.mapInPandas(_read_members, CONTENT_SCHEMA)


def tar_trace_docs(index: DataFrame, source_date: str | None = None) -> DataFrame:
    """Gzip trace members of archives → ``(path, source_date, content, status)``."""
    raw = read_tar_members(index)
    g = raw.select("archive", "parts", "member", gunzip_text("content").alias("g"))
    parts = F.col("parts")  # the archive's date folder; else the date in its name
    name = F.regexp_extract("archive", r"(\d{4}\.\d{2}\.\d{2})", 1)
    date = F.lit(source_date) if source_date else F.coalesce(F.nullif(date_of_path(parts), F.lit("")), name)
    read = g.select(
        F.concat_ws("!", F.substring_index("parts", ",", 1), "member").alias("path"),
        date.alias("source_date"),
        F.col("g.text").alias("content"),
        F.col("g.status").alias("status"),
    )
    # An archive that cannot be read is one failed document.
    broken = index.where(F.col("status") != "ok").select(
        F.substring_index("parts", ",", 1).alias("path"), date.alias("source_date"), F.lit(None).cast("string").alias("content"), "status")
    return read.unionByName(broken)
