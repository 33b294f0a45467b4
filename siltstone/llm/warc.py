"""Writing pages as WARC archives and reading archives back by boundary chains.

Reading trusts no magic by itself, as a payload may hold one. Spark's text reader cuts the files at every magic, whatever
split it lies in; each task emits the candidate records of its splits with the offset where the next record must begin,
and follows the chains inside a split. Pointer jumping over the entries of splits, from offset 0 of each file, then keeps
the records that a chain from the file's start reaches.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import scratch, stored

MAGIC = "WARC/1.0\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
#: Revisits up to this number are broadcast to the writers (24 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 200_000
_ID = "urn:page:"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of a column's SHA-1, from groups of 20 bits."""
    h = F.sha1(payload)
    digits = [F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _records(pages: DataFrame, date: str, min_bytes: int) -> DataFrame:
    """One column, the text of a record without its last line end."""
    digests = stored(pages.where(F.octet_length("_html") >= min_bytes).select("_id", base32_sha1(F.col("_html").cast("binary")).alias("_digest")), "digests")
    latest = digests.groupBy("_digest").agg(F.max("_id").alias("_of"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    revisits = stored(digests.join(latest, "_digest").where("_id < _of or (_id is null and _of is not null)").select("_id", "_of", "_digest").distinct(), "revisits")
    small = revisits.count() <= BROADCAST_ROWS
    key = F.col("_digest")
    rows = pages.withColumn("_digest", base32_sha1(F.col("_html").cast("binary")))
    rows = rows.join(F.broadcast(revisits) if small else revisits, (rows["_id"].eqNullSafe(revisits["_id"])) & (rows["_digest"] == revisits["_digest"]), "left").select(rows["_id"], rows["_url"], rows["_html"], rows["_digest"], revisits["_of"])
    again = F.col("_of").isNotNull()
    size = F.octet_length("_html")
    urn = lambda c: F.concat(F.lit(f"<{_ID}"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    lines = [
        F.concat(F.lit("WARC-Type: "), F.when(again, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), urn(F.col("_id"))),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace("_url", r"[\r\n]", "")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), key),
        F.concat(F.lit("X-Payload-Length: "), size.cast("string")),
        F.when(again, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), urn(F.col("_of")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.when(again, 0).otherwise(size) + len(HTTP)).cast("string")),
    ]
    block = F.concat(F.lit(HTTP), F.when(again, "").otherwise(F.col("_html")))
    return rows.select(F.concat(F.lit(MAGIC), F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"), block, F.lit("\r\n")).alias("value"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2020-01-01T00:00:00Z", min_bytes: int = 0, records_per_file: int = 50_000) -> None:
    """A WARC record per row, one or more archives per task, committed by Spark.

    Payload: the html in UTF-8, nothing for null. Of records with equal payloads of at least min_bytes, that with the
    largest id is a response and the others, which carry no payload, revisit it; null ids count as smallest. A null url
    gives no target line; line ends in a url are dropped. Other columns may have any name; no rows, no records.
    """
    source = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("_html"))
    _records(source, date, min_bytes).write.option("lineSep", "\r\n").option("maxRecordsPerFile", records_per_file).mode("errorifexists").text(path)


#: A length of 19 digits or more is none: such a header is rejected as a candidate.
_LENGTH = re.compile(rb"^content-length:[ \t]*(\d{1,18})[ \t]*\r?$", re.I | re.M)
_FIELD = re.compile(rb"^([!-9;-~]+):[ \t]*(.*?)[ \t]*\r?$", re.M)
_SCHEMA = "file string, split long, at long, seg long, body long, next long, exit long, type string, record string, target string, refers string, declared string, n long, digest string"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _candidate(seg: bytes, at: int) -> dict:
    """What follows a magic at offset `at` of its split: header fields, offset of the next record, digest of a whole payload."""
    row = dict.fromkeys((x.split()[0] for x in _SCHEMA.split(", ")), None) | {"at": at, "seg": len(seg)}
    head = seg.find(b"\r\n\r\n")
    length = _LENGTH.search(seg, 0, head + 2) if head >= 0 else None
    if not length:
        return row
    body, size = head + 4, int(length[1])
    fields = {k.lower(): v.decode("utf-8", "replace") for k, v in _FIELD.findall(seg[:head])}
    row |= {"body": at + len(MAGIC) + body, "next": at + len(MAGIC) + body + size + 4, "type": fields.get(b"warc-type"), "record": fields.get(b"warc-record-id"), "target": fields.get(b"warc-target-uri"), "refers": fields.get(b"warc-refers-to"), "declared": fields.get(b"x-payload-length")}
    if row["type"] == "revisit":
        row |= {"digest": fields.get(b"warc-payload-digest", "").removeprefix("sha1:") or None}
    elif body + size <= len(seg):
        payload = _payload(seg[body : body + size], fields.get(b"content-type", ""))
        row |= {"n": len(payload), "digest": digest_of(payload)}
    return row


def _payload(block: bytes, kind: str) -> bytes:
    """The block without its HTTP header, if it has one."""
    if kind.startswith("application/http"):
        end = block.find(b"\r\n\r\n")
        return block[end + 4 :] if end >= 0 else b""
    return block


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidates of each split of this task, by offset from the split's first segment, and one row with its size (at = -1)."""
    names = [x.split()[0] for x in _SCHEMA.split(", ")]
    types = [{"string": pa.string(), "long": pa.int64()}[x.split()[1]] for x in _SCHEMA.split(", ")]
    key, at, rows, first = None, 0, [], False

    def done() -> pa.RecordBatch:
        after = {r["at"]: r for r in rows}
        for r in reversed(rows):  # a chain only goes forward
            to = after.get(r["next"])
            r["exit"] = to["exit"] if to is not None and to["exit"] is not None else r["next"]
        rows.append(dict.fromkeys(names) | {"at": -1, "seg": at})
        for r in rows:
            r["file"], r["split"] = key
        return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in zip(names, types)], names)

    for batch in batches:
        for seg, file, split in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if (file, split) != key:
                if key is not None:
                    yield done()
                key, at, rows, first = (file, split), 0, [], split == 0
            raw = seg.as_py() or b""
            if first and at == 0:  # what stands before the first magic of the file; empty if it begins with one
                at += len(raw)
                first = False
            else:
                rows.append(_candidate(raw, at))
                at += len(MAGIC) + len(raw)
    if key is not None:
        yield done()


def _segments(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(F.col("value").cast("binary"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))


def _reached(entries: DataFrame) -> DataFrame:
    """Entries (file, at) that jumps from offset 0 reach; entries: file, at, exit. The jumps double in every round."""
    jump = entries.select("file", "at", F.col("exit").alias("to")).where("to is not null")
    reached, n = stored(entries.where("at = 0").select("file", "at"), "reached"), -1
    while (now := reached.count()) != n:
        n = now
        more = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = stored(reached.union(more).distinct(), "reached")
        step = jump.select("file", F.col("at").alias("to"), F.col("to").alias("far"))
        jump = stored(jump.join(step, ["file", "to"], "left").select("file", "at", F.coalesce("far", "to").alias("to")), "jump")
    return reached


def _walk(table: pa.Table) -> pa.Table:
    """Of a split's candidates, those on a chain from one of its entries."""
    at, to = table.column("at").to_pylist(), dict(zip(table.column("at").to_pylist(), table.column("next").to_pylist()))
    kept: set[int] = set()
    for start, entry in zip(at, table.column("entry").to_pylist()):
        while entry and start in to and start not in kept:
            kept.add(start)
            start = to[start]
    return table.filter(pa.array([x in kept for x in at], pa.bool_()))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives in a folder: file, at (offset), type, record, target, refers, n, digest.

    Only records that a chain of lengths from the start of their file reaches count; magic in a payload, and all after a
    damaged record, is left out. n and digest (bare base32 SHA-1) are of the payload, for a revisit as it declares them.
    A folder without records gives no rows.
    """
    found = stored(_segments(spark, path).mapInArrow(_scan, _SCHEMA), "candidates")
    # A split's own first segment lies where the segments of the file's earlier splits end. Past the first split, its size begins with a magic.
    base = found.where("at = -1").selectExpr("file", "split", "coalesce(sum(seg) over (partition by file order by split rows between unbounded preceding and 1 preceding), 0) as base")
    real = found.where("at >= 0").join(base, ["file", "split"])
    real = real.select("file", "split", *((F.col(c) + F.col("base")).alias(c) for c in ("at", "body", "next", "exit")), "seg", "type", "record", "target", "refers", "declared", "n", "digest")
    targets = real.select("file", F.col("exit").alias("at")).where("at is not null").union(real.where("at = 0").select("file", "at")).distinct()
    entries = stored(real.join(targets, ["file", "at"], "left_semi").select("file", "at", "exit"), "entries")
    flagged = real.join(_reached(entries).withColumn("entry", F.lit(True)), ["file", "at"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    chain = flagged.groupBy("file", "split").applyInArrow(_walk, flagged.schema).drop("entry")
    kept = stored(chain.withColumn("n", F.when(F.col("type") == "revisit", F.col("declared").try_cast("long")).otherwise(F.col("n"))), "records")
    whole = kept.where("digest is not null or type = 'revisit'").select("file", "at", "type", "record", "target", "refers", "n", "digest")
    cut = kept.where("digest is null and type <> 'revisit'")
    return whole if cut.isEmpty() else whole.unionByName(_stitched(spark, path, base, cut))


def _stitched(spark: SparkSession, path: str, base: DataFrame, cut: DataFrame) -> DataFrame:
    """Records whose payload holds a magic, so that it lies in several segments: only their files are read again."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, at, first = None, 0, False
        for batch in batches:
            ats, raws = [], []
            for seg, file, split in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if (file, split) != key:
                    key, at, first = (file, split), 0, split == 0
                raw = seg.as_py() or b""
                raw = raw if first and at == 0 else MAGIC.encode() + raw
                first = False
                ats.append(at)
                raws.append(raw)
                at += len(raw)
            yield pa.RecordBatch.from_arrays([pa.array(raws, pa.binary()), batch.column(1), batch.column(2), pa.array(ats, pa.int64())], ["raw", "file", "split", "at"])

    segments = _segments(spark, path).mapInArrow(place, "raw binary, file string, split long, at long")
    segments = segments.join(base, ["file", "split"]).select("file", (F.col("at") + F.col("base")).alias("lo"), "raw").withColumn("hi", F.col("lo") + F.octet_length("raw"))
    wanted = cut.select("file", "at", "type", "record", "target", "refers", "body", (F.col("next") - 4).alias("end"))
    joined = segments.join(wanted, (segments["file"] == wanted["file"]) & (segments["lo"] < wanted["end"]) & (segments["hi"] > wanted["body"])).drop(segments["file"])
    part = joined.withColumn("part", F.expr("substring(raw, cast(greatest(body - lo, 0) + 1 as int), cast(least(end, hi) - greatest(body, lo) as int))"))
    blocks = part.groupBy("file", "at", "type", "record", "target", "refers").agg(F.expr("transform(array_sort(collect_list(struct(lo, part))), x -> x.part)").alias("parts"), F.first(F.col("end") - F.col("body")).alias("size"))
    raw = blocks.withColumn("raw", F.expr("aggregate(parts, cast('' as binary), (a, x) -> concat(a, x))")).where("octet_length(raw) = size")
    head = F.instr(F.decode(F.substring("raw", 1, 1 << 16), "ISO-8859-1"), "\r\n\r\n")
    payload = F.when(F.decode(F.substring("raw", 1, 5), "ISO-8859-1") == "HTTP/", F.expr("substring(raw, h + 4)")).otherwise(F.col("raw"))
    raw = raw.withColumn("h", head).withColumn("payload", payload)
    return raw.select("file", "at", "type", "record", "target", "refers", F.octet_length("payload").cast("long").alias("n"), base32_sha1(F.col("payload")).alias("digest"))


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write the pages as archives, read these back: id, payload_bytes, payload_digest, record_type, refers_to."""
    path = scratch(pages.sparkSession, "warc")
    write_archives(pages, path, id_col, url_col, html_col)
    number = lambda c: F.regexp_extract(c, rf"^<{_ID}(-?\d+)>$", 1).try_cast("long")
    return read_archives(pages.sparkSession, path).select(number(F.col("record")).alias(id_col), F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.col("type").alias("record_type"), number(F.col("refers")).alias("refers_to"))
