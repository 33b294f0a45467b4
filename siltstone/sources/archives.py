"""Archive files as a Spark data source: `spark.read.format("warc")`.

One partition for each file; .gz files are read member by member. Records are parsed by their lengths, so that nothing in
a payload is mistaken for a record; a record without a readable length is a row of type "malformed" (S19), after which
reading goes on at the next line that begins a record. Files are opened through Arrow's file systems, so any store that
these know (local, HDFS, S3, GCS) will do.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import os
import re
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "file string, offset long, type string, url string, ip string, date14 string, length long, digest string, status int, mime string, charset string, truncated boolean, payload binary"
#: Bytes of a payload that are kept by default, as in the crawler's settings.
LIMIT = 1 << 20


def _headers(stream) -> dict[str, str]:
    out: dict[str, str] = {}
    while (line := stream.readline()).strip():
        name, _, value = line.decode("utf-8", "replace").partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def split_http(block: bytes) -> tuple[int, dict[str, str], bytes]:
    """Status, headers and body; -1 where there is no status line."""
    if not block.startswith(b"HTTP/"):
        return -1, {}, block
    stream = io.BytesIO(block)
    status = re.match(rb"HTTP/\S+\s+(\d{3})", stream.readline())
    headers = _headers(stream)
    return int(status[1]) if status else -1, headers, stream.read()


def charset_of(mime: str, body: bytes) -> str:
    """What the header says, else a meta tag near the start, else UTF-8; unknown names are UTF-8."""
    found = re.search(r"charset=[\"']?([\w.:-]+)", mime, re.I)
    if not found:
        meta = re.search(rb"<meta[^>]+charset=[\"']?([\w.:-]+)", body[:4096], re.I)
        name = meta[1].decode("ascii", "replace") if meta else "utf-8"
    else:
        name = found[1]
    try:
        "".encode(name)
        return name.lower()
    except LookupError:
        return "utf-8"


def _row(file: str, offset: int, kind: str, head: dict[str, str], block: bytes, limit: int) -> tuple:
    status, http, body = split_http(block) if kind == "response" else (-1, {}, block)
    mime = http.get("content-type", head.get("content-type", ""))
    digest = head.get("warc-payload-digest") or "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()
    date = re.sub(r"\D", "", head.get("warc-date", ""))[:14]
    return file, offset, kind, head.get("warc-target-uri", "").strip("<>"), head.get("warc-ip-address"), date, len(body), digest, status, mime.split(";")[0].strip().lower(), charset_of(mime, body), len(body) > limit, body[:limit]


def warc_records(stream, file: str, limit: int = LIMIT) -> Iterator[tuple]:
    """Every record of a WARC stream."""
    while True:
        offset = stream.tell()
        line = stream.readline()
        if not line:
            return
        if not line.startswith(b"WARC/"):
            continue
        head = _headers(stream)
        said = head.get("content-length", "0") or "0"
        if not re.fullmatch(r"\d{1,18}", said):
            yield _row(file, offset, "malformed", head, b"", limit)
            continue
        length = int(said)
        block = stream.read(length)
        yield _row(file, offset, head.get("warc-type", ""), head, block, limit)
        if len(block) < length:
            return


def arc_records(stream, file: str, limit: int = LIMIT) -> Iterator[tuple]:
    """Every record of an ARC stream but the file's own header: url, ip, date, type and length on one line."""
    while True:
        offset = stream.tell()
        line = stream.readline()
        if not line:
            return
        part = line.decode("utf-8", "replace").split()
        if len(part) < 5 or not part[-1].isdigit() or "://" not in part[0]:
            continue
        block = stream.read(int(part[-1]))
        if not part[0].startswith("filedesc://"):
            head = {"warc-target-uri": part[0], "warc-ip-address": part[1], "warc-date": part[2], "content-type": part[3]}
            yield _row(file, offset, "response", head, block, limit)


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.limit, self.pattern = options["path"], int(options.get("limit", LIMIT)), options.get("pattern", r"\.w?arc(\.gz)?$")

    def _store(self):
        uri = self.path if re.match(r"^[a-z][a-z0-9+.-]*:/", self.path) else f"file://{os.path.abspath(self.path)}"
        return pafs.FileSystem.from_uri(re.sub("^file:/+", "file:///", uri))

    def partitions(self):
        store, path = self._store()
        if store.get_file_info(path).type == pafs.FileType.File:
            return [InputPartition(path)]
        found = store.get_file_info(pafs.FileSelector(path, recursive=True))
        return [InputPartition(f.path) for f in sorted(found, key=lambda f: f.path) if f.is_file and re.search(self.pattern, f.base_name)]

    def read(self, partition):
        file, (store, _) = partition.value, self._store()
        with store.open_input_file(file) as raw:
            stream = io.BufferedReader(gzip.GzipFile(fileobj=raw) if file.endswith(".gz") else raw, 1 << 20)
            yield from (arc_records if re.search(r"\.arc(\.gz)?$", file) else warc_records)(stream, file, self.limit)


class WarcSource(DataSource):
    """format("warc"): options path, limit (bytes of a payload) and pattern (of file names)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def read_archives(spark: SparkSession, path: str, limit: int = LIMIT, pattern: str | None = None) -> DataFrame:
    spark.dataSource.register(WarcSource)
    reader = spark.read.format("warc").option("limit", limit)
    return (reader.option("pattern", pattern) if pattern else reader).load(path)


def _decoded(payload: Column, charset: Column) -> Column:
    """Bytes in any charset that Python knows; what does not fit becomes U+FFFD. Null stays null."""

    @F.pandas_udf("string")
    def run(payloads: pd.Series, charsets: pd.Series) -> pd.Series:
        return pd.Series([None if p is None else bytes(p).decode(c or "utf-8", "replace") for p, c in zip(payloads, charsets)], dtype=object)

    return run(payload, charset)


def responses(records: DataFrame, statuses: str = "200-299") -> DataFrame:
    """Key and html of responses with an accepted status."""
    from ..functions.urls import page_key, status_in

    kept = records.where((F.col("type") == "response") & status_in(F.col("status"), statuses))
    plain = F.col("charset").isin("utf-8", "utf8", "us-ascii", "ascii")
    text = F.when(plain, F.make_valid_utf8(F.col("payload").cast("string"))).otherwise(_decoded(F.when(~plain, F.col("payload")), F.col("charset")))
    return kept.select(page_key(F.col("url"), F.col("date14")).alias("page_id"), text.alias("html"))
