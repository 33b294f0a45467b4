"""Byte-level BPE encoding and decoding by the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters after which a long text is cut at the next safe boundary, and of white space that the pattern is not run on.
CHUNK, BLANK = 1 << 16, 1 << 12
#: A match of the pattern ends where white space follows something else, so encoding either side alone gives the same ids.
_SAFE = re.compile(r"[^\s](?=[ \t\r\n])")
#: Unicode's White_Space, which is the pattern's \s (Python's holds four more characters).
WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


@functools.lru_cache(maxsize=4)
def encoding(path: str, pattern: str):
    """The encoding of a rank file: lines of a base64 token and its rank."""
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def pieces(text: str, size: int = CHUNK) -> Iterator[str]:
    """The text in parts of about `size` characters, cut at safe boundaries only."""
    at = 0
    while len(text) - at > size:
        found = _SAFE.search(text, at + size - 1)
        if not found:
            break
        yield text[at : found.end()]
        at = found.end()
    if at < len(text) or at == 0:
        yield text[at:] if at else text


@functools.lru_cache(maxsize=4)
def _runs(blank: int) -> re.Pattern:
    return re.compile(f"{WHITE}{{{blank},}}")


def stretches(text: str, blank: int = BLANK) -> Iterator[tuple[str, bool]]:
    """The text in parts; True: a part is one match of the pattern, most of a run of `blank` or more white characters.

    The library's regex engine tries a run again from its end and overflows on long ones. What it would match is known: the
    run but for its last character, which goes with what follows; at the end of the text, all of it.
    """
    at = 0
    for run in _runs(blank).finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        if run.start() > at:
            yield text[at : run.start()], False
        if end > run.start():
            yield text[run.start() : end], True
        at = end
    if at < len(text):
        yield text[at:], False


def encode(text: str, path: str, pattern: str, size: int = CHUNK, blank: int = BLANK) -> list[int]:
    """Token ids of the whole text, special strings as ordinary text."""
    code = encoding(path, pattern)
    if len(text) <= min(size, blank):
        return code.encode_ordinary(text)
    ids: list[int] = []
    for stretch, white in stretches(text, blank):
        if white:
            ids += code._encode_single_piece(stretch)
        else:
            for part in pieces(stretch, size):
                ids += code.encode_ordinary(part)
    return ids


def decode(ids, path: str, pattern: str) -> bytes:
    """The raw bytes of the ids; part of a character stays as it is."""
    return encoding(path, pattern).decode_bytes(list(ids))


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ids array<int>, decoded binary. Map side only.

    Null and empty texts have no ids and decode to no bytes; a repeated row is encoded again; an empty table gives no
    rows. Only the id and text columns are read, so others may have any name. Long texts are encoded in parts,
    long runs of white space as the single matches that they are, so neither grows with the square of a length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = [encode(t or "", ranks, pattern) for t in part.column(1).to_pylist()]
                raw = [decode(i, ranks, pattern) for i in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(raw, pa.binary())], [id_col, "ids", "decoded"])

    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return source.mapInArrow(run, f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, ids array<int>, decoded binary")


def encode_digests(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As encode_documents, odd rows included, but with digests in place of the ids and bytes, so that only a short row
    leaves the worker: id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers), decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, of_ids, of_bytes = [], [], []
            for value in batch.column(1):
                ids = encode(value.as_py() or "", ranks, pattern)
                n.append(len(ids))
                of_ids.append(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
                of_bytes.append(hashlib.sha256(decode(ids, ranks, pattern)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    return source.mapInArrow(run, f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
