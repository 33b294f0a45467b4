"""Token counts of whole texts by a two-tier lookup.

Tier 1 is a broadcast table of word hash -> token count for frequent words, tier 2 a cache in each Python worker; the
library encodes what neither knows. Only word hashes are looked up, on the map side: no word is ever shuffled.

Counting by words gives the library's count as no token of such a tokenizer crosses white space: its pre-tokenizer drops
it, its special strings hold none, and composition and lower-casing act within a word.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import words

#: Entries of tier 1 (16 bytes each, so 1 MB is broadcast at most), and bytes of text that a task reads to find them.
TABLE_ENTRIES, TABLE_BYTES = 1 << 16, 8 << 20
#: Entries of each of the two generations of tier 2.
CACHE_ENTRIES = 1 << 19

_cache: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}


@functools.lru_cache(maxsize=4)
def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encode_lengths(path: str, texts: list[str]) -> np.ndarray:
    """The library's own counts, without begin, end or added special tokens."""
    return np.array([len(e.ids) for e in _library(path).encode_batch(texts, add_special_tokens=False)], np.int64)


def _find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, out: np.ndarray) -> None:
    """Fill out[i] < 0 where the sorted table has keys[i]."""
    if len(table[0]):
        todo = np.flatnonzero(out < 0)
        at = np.minimum(np.searchsorted(table[0], keys[todo]), len(table[0]) - 1)
        hit = table[0][at] == keys[todo]
        out[todo[hit]] = table[1][at[hit]]


def _merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([a[0], b[0]]), return_index=True)
    return keys, np.concatenate([a[1], b[1]])[at]


_EMPTY = (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _lengths(block, path: str, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Token count of each word of the block."""
    keys, at, inverse = np.unique(block.hash, return_index=True, return_inverse=True)
    out = np.full(len(keys), -1, np.int64)
    _find(table, keys, out)
    young, old = _cache.setdefault(path, [_EMPTY, _EMPTY])
    _find(young, keys, out)
    found_old = out < 0
    _find(old, keys, out)
    found_old &= out >= 0
    miss = np.flatnonzero(out < 0)
    if len(miss):
        raw = block.data.tobytes()
        out[miss] = encode_lengths(path, [raw[s:e].decode("utf-8", "replace") for s, e in zip(block.start[at[miss]], block.end[at[miss]])])
    fresh = np.concatenate([miss, np.flatnonzero(found_old)])
    if len(fresh):
        fresh.sort()
        young = _merged(young, (keys[fresh], out[fresh]))
        _cache[path] = [_EMPTY, young] if len(young[0]) > CACHE_ENTRIES else [young, old]
    return out[inverse]


def _batch_counts(column, path: str, table: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    counts = np.zeros(len(column), np.int64)
    for block in words(column):
        if len(block.hash):
            counts[block.first : block.first + block.n] = np.bincount(block.doc, _lengths(block, path, table), block.n).astype(np.int64)
    return counts


def _frequent(docs: DataFrame, text: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Tier 1: the most frequent words of the first texts of a partition, enough partitions to fill the table."""

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        room = TABLE_BYTES
        for batch in batches:
            for value in batch.column(0).fill_null(""):
                if room <= 0:
                    break
                raw = value.as_py()[:room]
                room -= len(raw) + 1
                for word in raw.encode().split():
                    seen[word] = seen.get(word, 0) + 1
        best = [w.decode("utf-8", "replace") for w, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))[:TABLE_ENTRIES] if len(w) <= 256]
        if best:
            column = pa.array(best, pa.string())
            hashes = np.concatenate([b.hash for b in words(column)])
            yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(encode_lengths(path, best))], ["h", "n"])

    rows = docs.select(F.col(text)).mapInArrow(top, "h long, n long").limit(TABLE_ENTRIES).collect()
    if not rows:
        return _EMPTY
    keys, at = np.unique(np.array([r[0] for r in rows], np.int64).view(np.uint64), return_index=True)
    return keys, np.array([r[1] for r in rows], np.int64)[at]


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit.

    Only the id and text columns are read, so others may have any name. A null or empty text has 0 bytes and 0 tokens;
    repeated rows are counted each; an empty table gives none. Texts of any length are counted whole: their words pass
    the lookup in slices. Words are known by 64-bit hashes (an error is likely only from about 10^9 different words).
    """
    source = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_text"))
    table = docs.sparkSession.sparkContext.broadcast(_frequent(source, "_text", tokenizer))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(1)
            size = pa.compute.fill_null(pa.compute.binary_length(text), 0).cast(pa.int64())
            n = _batch_counts(text, tokenizer, table.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n), pa.array(n > limit)], [id_col, "n_bytes", "n_tokens", "over_limit"])

    kind = source.schema[id_col].dataType.simpleString()
    return source.mapInArrow(count, f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean")
