"""Small helpers of the llm operators: shared folders, Arrow maps, bounded labelled samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..tables import remove, shared_folder


#: Folders of stored tables in the order in which they were made.
_made: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh path in the cluster's shared folder, removed by `release` or when the driver ends."""
    path = shared_folder(spark, what)
    _made.append((spark, path))
    return path


def held() -> int:
    """How many tables have been stored and not released."""
    return len(_made)


def release(since: int) -> None:
    """Delete the tables stored after the first `since`, but for the newest: what led to it is not read again."""
    for spark, path in _made[since:-1]:
        remove(spark, path)
    del _made[since:-1]


def stored(df: DataFrame, what: str, partition_by: str | None = None) -> DataFrame:
    """`df` written once as a table in the shared folder and read again: what follows recomputes nothing, whatever executor is lost."""
    spark = df.sparkSession
    path = scratch(spark, what)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Map each Arrow batch; a batch is the unit of memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)

    return df.mapInArrow(run, schema)


def bucket_of(column, buckets: int):
    """The crc32 of a column as text, modulo `buckets`."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(buckets))


def labelled_sample(labels: DataFrame, label: str, max_rows: int, id_col: str = "doc_id", keep=None) -> DataFrame:
    """At most `max_rows` (id, label) rows with a label, the same ones in every run: those of smallest hash.

    The bound makes the result safe to broadcast: max_rows times 12 bytes.
    """
    rows = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    if keep is not None:
        rows = rows.where(keep)
    rows = rows.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label)).cast("int").alias("_y"))
    return rows.orderBy(F.xxhash64("_id"), "_id").limit(max_rows)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(x: np.ndarray, y: np.ndarray, l2: float = 1.0, steps: int = 200, weight: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Weights and intercept of a ridge logistic regression by accelerated gradient steps; one class only gives a constant."""
    n, d = x.shape
    w, b = np.zeros(d), 0.0
    if n == 0:
        return w, b
    s = np.ones(n) if weight is None else weight
    total = s.sum()
    p = np.clip((s @ y) / total, 1e-3, 1 - 1e-3)
    b = float(np.log(p / (1 - p)))
    if y.min() == y.max():
        return w, b
    v = np.random.default_rng(7).normal(size=d)
    for _ in range(12):  # the largest eigenvalue gives the step
        v = x.T @ (s * (x @ v))
        v /= max(np.linalg.norm(v), 1e-12)
    top = float(np.linalg.norm(x.T @ (s * (x @ v)))) / total + 1.0
    step = 1.0 / (0.25 * top + l2 / total)
    zw, zb, t = w.copy(), b, 1.0
    for _ in range(steps):
        g = s * (sigmoid(x @ zw + zb) - y) / total
        nw, nb = zw - step * (x.T @ g + l2 / total * zw), zb - step * float(g.sum())
        nt = (1 + (1 + 4 * t * t) ** 0.5) / 2
        zw, zb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b
