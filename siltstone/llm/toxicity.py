"""Toxicity by a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

1. Over a bounded sample of labelled training rows, executors count the documents of either class with each n-gram.
2. The n-grams whose log-count ratio r stands out most (by its standard error) become features of value r.
3. A ridge logistic regression over the sample's feature rows gives their weights.
4. Every whole text is scored on the map side: the features it holds, once each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bucket_of, fit_logistic, labelled_sample, sigmoid
from .words import SLICE, buffers, mix

ORDERS = (3, 4, 5, 6)
BUCKETS = 1 << 20


def _codes(text: bytes) -> np.ndarray:
    """Code points; white space of any kind is one blank."""
    codes = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    codes[(codes >= 9) & (codes <= 13)] = 32
    return codes


def _grams(codes: np.ndarray, n: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each place."""
    m = len(codes) - n + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    h = np.full(m, n, np.uint64)
    for i in range(n):
        h = h * np.uint64(0x100000001B3) + codes[i : i + m]
    return (mix(h) & np.uint64(BUCKETS - 1)).astype(np.int64)


def hits(column, wanted: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Groups of whole texts: first row, then the row in the group and value of each n-gram, distinct by text.

    wanted: BUCKETS values, the value of a bucket or -1; None: the bucket itself. Long texts go slice by slice with an overlap.
    """
    data, offs = buffers(pc.utf8_lower(column))
    at, n = 0, len(offs) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + SLICE, "right")) - 1)
        found: list[np.ndarray] = []
        for low in range(int(offs[at]), int(offs[to]), 4 * SLICE):
            high = min(int(offs[to]), low + 4 * SLICE + 64)
            while low > offs[at] and low < high and data[low] & 0xC0 == 0x80:
                low += 1
            part = data[low:high]
            codes = _codes(part.tobytes())
            begins = np.concatenate([[0], np.cumsum((part & 0xC0) != 0x80)])[np.clip(offs[at : to + 1] - low, 0, len(part))]
            for order in ORDERS:
                g = _grams(codes, order)
                if wanted is None:
                    place, value = np.arange(len(g)), g
                else:
                    value = wanted[g]
                    place = np.flatnonzero(value >= 0)
                    value = value[place]
                doc = np.searchsorted(begins[1:], place, "right")
                inside = place + order <= begins[np.minimum(doc + 1, len(begins) - 1)]
                found.append(np.unique(doc[inside] * BUCKETS + value[inside]))
        both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        yield at, both // BUCKETS, both % BUCKETS
        at = to


def _class_counts(sample: DataFrame) -> DataFrame:
    """bucket, positive and negative documents with it. sample: _text, _y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for first, doc, gram in hits(batch.column(0)):
                for c in (0, 1):
                    counts[c] += np.bincount(gram[y[first + doc] == c], minlength=BUCKETS)
        some = np.flatnonzero(counts.sum(0) > 0)
        for at in range(0, len(some), 1 << 16):
            part = some[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(counts[1][part]), pa.array(counts[0][part])], ["g", "p", "q"])

    return sample.mapInArrow(run, "g long, p long, q long").groupBy("g").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))


def _select(counts: DataFrame, p_docs: int, q_docs: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and ratios of the features: the largest |r| in standard errors."""
    r = F.log((F.col("p") + 0.5) / (p_docs + 1.0)) - F.log((F.col("q") + 0.5) / (q_docs + 1.0))
    z = F.abs(r) / F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("q") + 0.5))
    rows = counts.where(F.col("p") + F.col("q") >= 3).select("g", r.alias("r"), z.alias("z")).orderBy(F.desc("z"), "g").limit(features).collect()
    return np.array([x.g for x in rows], np.int64), np.array([x.r for x in rows])


def _wanted(grams: np.ndarray) -> np.ndarray:
    wanted = np.full(BUCKETS, -1, np.int16)
    wanted[grams] = np.arange(len(grams))
    return wanted


def _rows(sample: DataFrame, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sample's 0/1 feature rows and labels: at most max_labels rows of features / 8 bytes reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _wanted(grams)
        for batch in batches:
            x = np.zeros((batch.num_rows, len(grams)), bool)
            for first, doc, f in hits(batch.column(0), wanted):
                x[first + doc, f] = True
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([row.tobytes() for row in np.packbits(x, axis=1)], pa.binary())], ["y", "x"])

    rows = sample.mapInArrow(run, "y int, x binary").collect()
    rows.sort(key=lambda r: (r.y, bytes(r.x)))  # the fit then does not depend on the order of tasks
    bits = np.frombuffer(b"".join(bytes(r.x) for r in rows), np.uint8).reshape(len(rows), -1)
    return np.unpackbits(bits, axis=1)[:, : len(grams)].astype(np.float32), np.array([r.y for r in rows], np.float64)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", folds: int = 5, max_labels: int = 12_000, features: int = 1024) -> tuple[np.ndarray, np.ndarray, float]:
    """Buckets, weights and intercept, learnt from at most max_labels labelled rows outside the held-out fold."""
    keep = bucket_of(F.col("doc_id"), folds) != 0
    ids = labelled_sample(labels.select("doc_id", label), label, max_labels, keep=keep)
    sample = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(ids), "_id").select("_text", "_y")
    sizes = {r[0]: r[1] for r in sample.groupBy("_y").count().collect()}
    p, q = sizes.get(1, 0), sizes.get(0, 0)
    grams, ratios = _select(_class_counts(sample), p, q, features) if p and q else (np.zeros(0, np.int64), np.zeros(0))
    if not len(grams):
        return grams, ratios, float(np.log((p + 0.5) / (q + 0.5)))
    x, y = _rows(sample, grams)
    w, b = fit_logistic(x * ratios.astype(np.float32), y, l2=3.0)
    return grams, w * ratios, b


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 5, **fit) -> DataFrame:
    """One row per input row: id, held_out, score in [0, 1], predicted.

    Every text is scored whole, a null one as an empty one (no n-gram: the intercept's score). Rows with equal texts get
    equal scores; a null id counts as the text "" in the fold. Without labels of both classes the score is their share,
    smoothed. An empty table gives no rows. Only id and text are read of docs, so other columns may have any name.
    """
    grams, weights, intercept = fit_toxicity(docs, labels, id_col, text_col, folds=folds, **fit)
    model = docs.sparkSession.sparkContext.broadcast((grams, weights, intercept))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, weights, intercept = model.value
        wanted = _wanted(grams)
        for batch in batches:
            total = np.full(batch.num_rows, intercept)
            for first, doc, f in hits(batch.column(2), wanted):
                if len(doc):
                    total += np.bincount(first + doc, weights[f], batch.num_rows)
            score = sigmoid(total)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], [id_col, "held_out", "score", "predicted"])

    source = docs.select(F.col(id_col), (bucket_of(F.col(id_col), folds) == 0).alias("_held"), F.col(text_col).cast("string").alias("_text"))
    return source.mapInArrow(run, f"`{id_col}` {source.schema[id_col].dataType.simpleString()}, held_out boolean, score double, predicted int")
