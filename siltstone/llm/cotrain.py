"""A quality classifier by co-training: a text-content view and a page-metadata view teach each other.

Each view is a naive Bayes model, over binned measures and, for content, over the presence of words, so that training is a sum of counts over all documents, however many. In each round a view learns from the labelled documents
and from those unlabelled ones on which the other view is confident. A labelled fold of its own calibrates the views and,
at the end, their combination. The views have no feature in common: metadata is the page's source and language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rules import measure
from .shared import arrow_map, bucket_of, fit_logistic, sigmoid, stored
from .words import words

CONTENT = ("size", "word_length", "symbols", "dup_lines", "repeats", "capitals", "same_words", "stops", "line_length")
META = ("source", "lang", "source_lang")
BINS = 256
#: Buckets that words are hashed to (a power of two), and those of them whose presence is a feature.
BUCKETS, PRESENT = 1 << 18, 1024
#: Weight of a word against a measure: words of a text depend on each other, as naive Bayes supposes they don't.
TEMPER = 0.1
#: Steps of the histogram of logits that calibration uses, and their width in each view.
STEPS, WIDTH = 64, (0.5, 0.25)


def buckets(column) -> Iterator[tuple[int, np.ndarray]]:
    """Row and distinct buckets of the words of each text."""
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    for block in words(column, lower=True):
        bounds = block.bounds()
        for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:])):
            yield block.first + i, np.unique(block.hash[lo:hi] >> shift).astype(np.int64)


def vocabulary(table: DataFrame) -> np.ndarray:
    """The PRESENT buckets, in order, whose presence varies most over all texts: df * (n - df) is largest. Each task adds
    up its own counts; what reaches the driver is as long as the buckets, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(BUCKETS + 1, np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, found in buckets(batch.column(0)):
                df[found] += 1
        df[BUCKETS] = n
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], ["bucket", "df"])

    got = table.select("_text").mapInArrow(run, "bucket long, df long").groupBy("bucket").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(BUCKETS + 1, np.int64)
    df[got.column("bucket").to_numpy()] = got.column("df").to_numpy()
    n = int(df[BUCKETS])
    spread = df[:BUCKETS].astype(float) * (n - df[:BUCKETS])
    best = np.lexsort((np.arange(BUCKETS), -spread))[:PRESENT]
    return np.sort(best[spread[best] > 0])


def presence(column, chosen: np.ndarray) -> np.ndarray:
    """Bits of the chosen buckets in each text, eight to a byte."""
    out = np.zeros((len(column), PRESENT), bool)
    for row, found in buckets(column):
        at = np.searchsorted(chosen, found)
        hit = (at < len(chosen)) & (chosen[np.minimum(at, max(len(chosen) - 1, 0))] == found) if len(chosen) else np.zeros(len(found), bool)
        out[row, at[hit]] = True
    return np.packbits(out, axis=1)


def content_bins(column) -> np.ndarray:
    """One row of bins for each text of an Arrow column, from its whole text."""
    m = {k: v.astype(np.float64) for k, v in measure(column).items()}
    words, chars, lines = np.maximum(m["n_words"], 1), np.maximum(m["word_chars"], 1), np.maximum(m["n_lines"], 1)
    ratio = lambda a, b: np.ceil(np.sqrt(np.clip(a / b, 0, 1)) * 48)  # noqa: E731  finer near 0
    columns = [
        np.log2(m["n_words"] + 1),
        np.minimum(4 * m["word_chars"] / words, BINS - 1),
        ratio(m["n_symbols"], words),
        ratio(m["n_dup_lines"], lines),
        ratio(m["n_repeat_words"], words),
        ratio(m["n_upper"], chars),
        ratio(words - m["n_distinct"], words),
        ratio(m["n_stops"], words),
        np.log2(words / lines + 1) * 2,
    ]
    return np.stack(columns, 1).astype(np.int64).clip(0, BINS - 1).astype(np.uint8)


class View:
    """Naive Bayes over bins and bits: log-count ratios, and a calibrating slope and shift."""

    def __init__(self, features: int, bits: int = 0):
        self.weights, self.bit_weights = np.zeros((features, BINS)), np.zeros(bits)
        self.prior, self.base, self.scale = 0.0, 0.0, (1.0, 0.0)

    def learn(self, bins: np.ndarray, bits: np.ndarray) -> None:
        """bins: class, feature, bin -> documents; bits: class, bit -> documents that have it."""
        share = (bins + 0.5) / (bins.sum(2, keepdims=True) + 0.5 * BINS)
        self.weights = np.log(share[1]) - np.log(share[0])
        n = bins[:, 0].sum(1)
        self.prior = float(np.log(n[1] + 0.5) - np.log(n[0] + 0.5))
        has = (bits + 0.5) / (n[:, None] + 1.0)
        absent = np.log1p(-has[1]) - np.log1p(-has[0])
        self.bit_weights, self.base = TEMPER * (np.log(has[1]) - np.log(has[0]) - absent), TEMPER * float(absent.sum())

    def raw(self, data: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        bins, bits = data
        return self.prior + self.base + self.weights[np.arange(bins.shape[1]), bins].sum(1) + bits @ self.bit_weights

    def probability(self, data: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        return sigmoid(self.scale[0] * self.raw(data) + self.scale[1])


def _features(batch: pa.RecordBatch, view: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins and bits (0.0 or 1.0) of each row in a view."""
    width = len((CONTENT, META)[view])
    bins = np.frombuffer(b"".join(batch.column(("content", "meta")[view]).to_pylist()), np.uint8).reshape(-1, width)
    if view:
        return bins, np.zeros((len(bins), 0))
    packed = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint8).reshape(-1, PRESENT // 8)
    return bins, np.unpackbits(packed, axis=1).astype(np.float64)


def _slices(batches: Iterator[pa.RecordBatch], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Batches of bounded size, as bits take eight bytes each when they are used."""
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def _counts(rows: DataFrame, views: list[View] | None, confident: float, trust: float) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per view the counts (class, feature, bin) and (class, bit) it learns from: labels, and what the other view is confident of."""
    held = rows.sparkSession.sparkContext.broadcast(views)
    shapes = [((2, len(CONTENT), BINS), (2, PRESENT)), ((2, len(META), BINS), (2, 0))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [tuple(np.zeros(s) for s in shape) for shape in shapes]
        for batch in _slices(batches):
            y = batch.column("y").fill_null(-1).to_numpy()
            data = [_features(batch, v) for v in (0, 1)]
            for v in (0, 1):
                weight, label = (y >= 0).astype(float), np.maximum(y, 0)
                if held.value is not None:
                    p = held.value[1 - v].probability(data[1 - v])
                    sure = (y < 0) & ((p >= confident) | (p <= 1 - confident))
                    weight, label = np.where(sure, trust, weight), np.where(sure, (p > 0.5).astype(int), label)
                bins, bits = data[v]
                for f in range(bins.shape[1]):
                    total[v][0][:, f] += np.bincount(label * BINS + bins[:, f], weight, 2 * BINS).reshape(2, BINS)
                for c in (0, 1):
                    total[v][1][c] += (weight * (label == c)) @ bits
        for v in (0, 1):
            flat = np.concatenate([x.ravel() for x in total[v]])
            at = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), v)), pa.array(at), pa.array(flat[at])], ["v", "at", "n"])

    summed = rows.mapInArrow(run, "v long, at long, n double").groupBy("v", "at").agg(F.sum("n").alias("n")).toArrow()
    out = []
    for v, (of_bins, of_bits) in enumerate(shapes):
        mine = summed.filter(pa.array(summed.column("v").to_numpy() == v))
        flat = np.zeros(int(np.prod(of_bins) + np.prod(of_bits)))
        flat[mine.column("at").to_numpy()] = mine.column("n").to_numpy()
        out.append((flat[: int(np.prod(of_bins))].reshape(of_bins), flat[int(np.prod(of_bins)) :].reshape(of_bits)))
    return out


def _grid(rows: DataFrame, views: list[View]) -> np.ndarray:
    """Rows (content step, meta step, label, count): the calibrating fold's raw logits, STEPS by STEPS."""
    held = rows.sparkSession.sparkContext.broadcast(views)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(2 * STEPS * STEPS)
        for batch in _slices(batches):
            a, b = (_step(view.raw(_features(batch, v)), v) for v, view in enumerate(held.value))
            total += np.bincount((a * STEPS + b) * 2 + batch.column("y").to_numpy(), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    got = rows.mapInArrow(run, "at long, n double").groupBy("at").agg(F.sum("n").alias("n")).orderBy("at").toArrow()
    at = got.column("at").to_numpy()
    return np.stack([at // 2 // STEPS, at // 2 % STEPS, at % 2, got.column("n").to_numpy()], 1)


def _step(raw: np.ndarray, view: int) -> np.ndarray:
    return np.clip(np.floor(raw / WIDTH[view] + STEPS / 2), 0, STEPS - 1).astype(np.int64)


def _calibrate(grid: np.ndarray, views: list[View]) -> tuple[float, float, float]:
    """Set each view's slope and shift; the weights of both views' calibrated logits and the intercept of the combination."""
    middle = (grid[:, :2] + 0.5 - STEPS / 2) * np.array(WIDTH)
    y, n = grid[:, 2], grid[:, 3]
    unit = 10 * np.array(WIDTH)  # steps of a like size for the fit
    for v, view in enumerate(views):
        w, b = fit_logistic(middle[:, v : v + 1] / unit[v], y, 1.0, 300, n)
        view.scale = (max(float(w[0]), 0.0) / unit[v], b)
    w, b = fit_logistic(middle / unit, y, 1.0, 300, n)
    return float(w[0]) / unit[0], float(w[1]) / unit[1], b


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    meta_cols: tuple[str, str] = ("source", "lang"),
    rounds: int = 3,
    confident: float = 0.98,
    trust: float = 0.5,
    folds: int = 5,
) -> DataFrame:
    """One row per input row: id, held_out, content_score, meta_score, score (0 to 1, higher: better), kept (score >= 0.5).

    Of labelled rows, fold 0 (by crc32 of the id as text) is held out, fold 1 calibrates, the others train. Null metadata
    are values of their own; a null or empty text has zero counts and no words. Repeated rows are scored and learnt each; a null id has
    no label; labels of one id that differ count as 0. Without labels all scores are 0.5. An empty table gives no rows.
    Other columns may have any name.
    """
    source, lang = meta_cols
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("\0"))
    hashed = lambda c: F.pmod(F.crc32(c.cast("binary")), F.lit(BINS)).cast("int")
    both = F.concat_ws("\x01", text_of(source), text_of(lang))
    table = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"), hashed(text_of(source)).alias("m0"), hashed(text_of(lang)).alias("m1"), hashed(both).alias("m2"))
    chosen = docs.sparkSession.sparkContext.broadcast(vocabulary(table))

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        meta = np.stack([batch.column(c).to_numpy() for c in ("m0", "m1", "m2")], 1).astype(np.uint8)
        pack = lambda x: pa.array([r.tobytes() for r in x], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), pack(content_bins(batch.column(1))), pack(presence(batch.column(1), chosen.value)), pack(meta)], ["_id", "content", "bits", "meta"])

    kind = table.schema["_id"].dataType.simpleString()
    found = arrow_map(table, features, f"_id {kind}, content binary, bits binary, meta binary")
    known = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_l")).agg(F.min("quality").cast("int").alias("y"))
    rows = stored(found.join(known, F.col("_id") == F.col("_l"), "left").select("_id", "content", "bits", "meta", "y", bucket_of(F.col("_id"), folds).alias("fold")), "features")
    training = rows.select("content", "bits", "meta", F.when(F.col("fold") > 1, F.col("y")).alias("y"))
    calibrating = rows.where("fold = 1 and y is not null").select("content", "bits", "meta", "y")
    views, together = [View(len(CONTENT), PRESENT), View(len(META))], (0.0, 0.0, 0.0)
    for turn in range(rounds + 1):
        for view, counts in zip(views, _counts(training, views if turn else None, confident, trust)):
            view.learn(*counts)
        together = _calibrate(_grid(calibrating, views), views)
    model = docs.sparkSession.sparkContext.broadcast((views, together))

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        views, (a, b, c) = model.value
        each: list[list[np.ndarray]] = [[np.zeros(0)], [np.zeros(0)], [np.zeros(0)]]
        for part in _slices(iter([batch])):
            data = [_features(part, v) for v in (0, 1)]
            raw = [view.raw(x) for view, x in zip(views, data)]
            for held, x in zip(each, (views[0].probability(data[0]), views[1].probability(data[1]), sigmoid(a * raw[0] + b * raw[1] + c))):
                held.append(x)
        content, meta, p = (np.concatenate(x) for x in each)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(x) for x in (content, meta, p)), pa.array(p >= 0.5)], [id_col, "held_out", "content_score", "meta_score", "score", "kept"])

    return arrow_map(rows.select("_id", (F.col("fold") == 0).alias("held_out"), "content", "bits", "meta"), score, f"`{id_col}` {kind}, held_out boolean, content_score double, meta_score double, score double, kept boolean")
