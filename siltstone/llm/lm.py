"""Language-model scores by a weighted backoff automaton over the corpus's own n-grams.

States are words (what was read last) and a root. A state v has an arc for each word w that followed it in the training
texts, of weight log10((c(vw) + k p(w)) / (c(v) + k)), and a failure arc to the root of weight log10(k / (c(v) + k)); the
root has an arc of weight log10 p(w) for every w. So the weights of all paths from a state sum to one (Dirichlet
smoothing), and one left-to-right pass carries the state and adds weights up. k is chosen by leave-one-out likelihood.

The automaton of a large corpus fits no machine. Texts are stored in blocks of bounded size; a block asks for the counts
of its own distinct n-grams, in one array for each range of hashes, and gets the part of the automaton that it can visit.
N-grams are known by 64-bit hashes. The most frequent ones, which every block would ask for, are counted by each task for
itself and added up; their totals, a bounded table, are broadcast, so that no range gets a row of them from every block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pyarrow.ipc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bucket_of, stored
from .words import mix, words

#: Bytes of text in a block (more only if one text is longer), and of text for each range of hashes.
BLOCK_BYTES, RANGE_BYTES = 6 << 20, 16 << 20
#: N-grams that are broadcast with their counts (24 bytes each), and those that a task puts up for that.
HOT, TASK_HOT = 1 << 16, 1 << 14
#: Strengths of smoothing that leave-one-out likelihood chooses from.
STRENGTHS = (4.0, 16.0, 64.0, 256.0, 1024.0, 4096.0, 65536.0)
_END = np.uint64(0x5EED5EED5EED5EED)


def _zip(a: np.ndarray) -> bytes:
    """Byte planes of an array, compressed: the high bytes of sorted or small numbers cost little."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.itemsize).T.tobytes()
    return len(planes).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(planes, asbytes=True) if planes else b""


def _unzip(raw: bytes, kind) -> np.ndarray:
    if not raw:
        return np.zeros(0, kind)
    size = int.from_bytes(raw[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(raw[8:], size, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (block, bytes, table): the texts of a task in blocks."""
    part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

    def done() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=1))) as writer:
            for x in held:
                writer.write_batch(x)
        return pa.RecordBatch.from_arrays([pa.array([part << 32 | seq]), pa.array([size]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["block", "bytes", "texts"])

    for batch in batches:
        length = pa.compute.fill_null(pa.compute.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False)
        at = 0
        while at < batch.num_rows:
            room = np.cumsum(length[at:], dtype=np.int64)
            to = at + max(int(np.searchsorted(room, BLOCK_BYTES - size, "right")), 0 if held else 1)
            if to > at:
                held.append(batch.slice(at, to - at))
                size += int(room[to - at - 1])
            at = to
            if at < batch.num_rows:
                yield done()
                seq, held, size = seq + 1, [], 0
    if held:
        yield done()


class _Block:
    """A block's token sequence and its distinct n-grams, in order of hash."""

    def __init__(self, texts: bytes):
        with pa.ipc.open_stream(texts) as reader:
            self.rows = reader.read_all().combine_chunks()
        n = self.rows.num_rows
        docs, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for w in words(self.rows.column("_text"), lower=True):
            docs.append(w.doc + w.first)
            hashes.append(w.hash)
        doc, h = np.concatenate(docs), np.concatenate(hashes)
        self.length = np.bincount(doc, minlength=n) + 1
        seq = np.full(len(h) + n, _END)
        seq[np.arange(len(h)) + doc] = h
        self.doc = np.repeat(np.arange(n), self.length)
        self.train = ~self.rows.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
        self.word, self.at = np.unique(seq, return_inverse=True)
        self.before = np.concatenate([self.at[-1:], self.at[:-1]])  # each text ends with the end, which also stands before the next
        self.pair, self.pair_at = np.unique(mix(seq[np.arange(len(seq)) - 1] * np.uint64(0xC2B2AE3D27D4EB4F) + seq), return_inverse=True)

    def counts(self, which: np.ndarray, n: int) -> np.ndarray:
        return np.bincount(which[self.train[self.doc]], minlength=n).astype(np.uint32)


def _ranges(keys: np.ndarray, n: int) -> np.ndarray:
    """Where each of n equal ranges of hashes begins in the sorted keys; n + 1 numbers."""
    part = ((keys >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    return np.searchsorted(part, np.arange(n + 1, dtype=np.uint64))


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch in batches:
        for texts in batch.column("texts"):
            yield _Block(texts.as_py())


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams that a task's blocks hold most often, (pair, key, n). Any are right; good ones keep ranges small."""
    held = [(np.zeros(0, np.uint64), np.zeros(0, np.int64)) for _ in (0, 1)]
    for b in _texts(batches):
        for i, (keys, which) in enumerate(((b.word, b.at), (b.pair, b.pair_at))):
            n = np.bincount(which, minlength=len(keys))
            some = n >= 8
            every, at = np.unique(np.concatenate([held[i][0], keys[some]]), return_inverse=True)
            total = np.bincount(at, np.concatenate([held[i][1], n[some]]), len(every)).astype(np.int64)
            top = np.argsort(-total, kind="stable")[: 4 * TASK_HOT]
            held[i] = every[top], total[top]
    for i, (keys, n) in enumerate(held):
        top = np.argsort(-n, kind="stable")[:TASK_HOT]
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(top), bool(i))), pa.array(keys[top].view(np.int64)), pa.array(n[top])], ["pair", "key", "n"])


def _hot_keys(blocks: DataFrame) -> list[np.ndarray]:
    """Sorted keys of the HOT most frequent n-grams at most: words, then pairs."""
    counts = blocks.select("texts").mapInArrow(_candidates, "pair boolean, key long, n long").groupBy("pair", "key").agg(F.sum("n").alias("n"))
    rows = counts.orderBy(F.desc("n"), "pair", "key").limit(HOT).select("pair", "key").toArrow()
    pair, key = rows.column("pair").to_numpy().astype(bool), rows.column("key").to_numpy().view(np.uint64)
    return [np.sort(key[~pair]), np.sort(key[pair])]


def _hot_counts(blocks: DataFrame, keys: list[np.ndarray]) -> list[np.ndarray]:
    """Their training counts over all blocks: a sum for each task, added up by number."""
    held, split = blocks.sparkSession.sparkContext.broadcast(keys), len(keys[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(sum(map(len, held.value)), np.int64)
        for b in _texts(batches):
            for first, hot, mine, which in ((0, held.value[0], b.word, b.at), (split, held.value[1], b.pair, b.pair_at)):
                at, there = _find(hot, mine)
                np.add.at(total, first + at[there], b.counts(which, len(mine))[there])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["at", "n"])

    rows = blocks.select("texts").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(sum(map(len, keys)), np.int64)
    out[rows.column("at").to_numpy()] = rows.column("n").to_numpy()
    return [out[:split], out[split:]]


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each wanted key in the sorted keys, and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def _requests(ranges: int, hot):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, texts in zip(batch.column(0).to_pylist(), batch.column(1)):
                b = _Block(texts.as_py())
                rest = []
                for known, keys, which in ((hot.value[0], b.word, b.at), (hot.value[1], b.pair, b.pair_at)):
                    rare = ~_find(known, keys)[1]
                    rest += [keys[rare], b.counts(which, len(keys))[rare]]
                rw, rp = _ranges(rest[0], ranges), _ranges(rest[2], ranges)
                some = [i for i in range(ranges) if rw[i + 1] > rw[i] or rp[i + 1] > rp[i]]
                for lot in (some[i : i + 64] for i in range(0, len(some), 64)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(lot, pa.int64()), pa.array([name] * len(lot), pa.int64())] + [pa.array([_zip(a[r[i] : r[i + 1]]) for i in lot], pa.binary()) for a, r in zip(rest, (rw, rw, rp, rp))],
                        ["range", "block", "word", "cw", "pair", "cp"],
                    )

    return run


def _answer(table: pa.Table) -> pa.Table:
    """Total counts for every request of one range, in the requests' order; its share of the distinct and of all tokens."""
    table = table.combine_chunks()
    out, share = {}, [0, 0]
    for keys, counts in (("word", "cw"), ("pair", "cp")):
        asked = [_unzip(x.as_py(), np.uint64) for x in table.column(keys)]
        ends = np.cumsum([len(a) for a in asked])
        distinct, at = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(at, np.concatenate([_unzip(x.as_py(), np.uint32) for x in table.column(counts)]), len(distinct)).astype(np.int64)
        out[counts] = [_zip(total[x]) for x in np.split(at, ends[:-1])]
        if keys == "word":
            share = [int((total > 0).sum()), int(total.sum())]
    n = table.num_rows
    return pa.table({"block": table.column("block"), "range": table.column("range"), "cw": pa.array(out["cw"], pa.binary()), "cp": pa.array(out["cp"], pa.binary()), "v": pa.array([share[0]] + [0] * (n - 1), pa.int64()), "n": pa.array([share[1]] + [0] * (n - 1), pa.int64())})


def arc_weights(c_pair, c_before, p_root, strength: float):
    """Weight of one step from a state with c_before visits: by its arc if c_pair > 0, else by the failure arc and the root's arc."""
    fail = np.log10(strength / (c_before + strength)) + np.log10(p_root)
    arc = np.log10(np.maximum(c_pair + strength * p_root, 1e-300) / (c_before + strength))
    return np.where(c_pair > 0, arc, fail)


def _all_counts(keys: np.ndarray, hot: np.ndarray, counts: np.ndarray, answers) -> np.ndarray:
    """Counts of a block's sorted keys: of the hot ones from their table, of the rest from the answers, in order of range."""
    at, there = _find(hot, keys)
    out = np.zeros(len(keys), np.int64)
    out[there] = counts[at[there]] if len(counts) else 0
    out[~there] = np.concatenate([np.zeros(0, np.int64), *(_unzip(x.as_py(), np.int64) for x in answers)])
    return out


def _traverse(total: int, distinct: int, kind: pa.DataType, hot):
    """Scores of a block's texts: the states visited are known from the text, so all steps are weighed at once."""
    base = total + 0.1 * (distinct + 1)

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        parts = []
        answers = answers.sort_by("range")
        for raw in texts.column("texts"):
            b = _Block(raw.as_py())
            n = b.rows.num_rows
            cw, cp = (_all_counts(keys, hot.value[0][i], hot.value[1][i], answers.column(c)) for i, (keys, c) in enumerate(((b.word, "cw"), (b.pair, "cp"))))
            c, before, pair = cw[b.at], cw[b.before], cp[b.pair_at]
            add = lambda x, b=b, n=n: np.bincount(b.doc, x, n)
            root = (c + 0.1) / base
            scores = [add(arc_weights(pair, before, root, k)) for k in STRENGTHS]
            own = b.train[b.doc]
            less = np.maximum(c - own + 0.1, 0.1) / max(base - 1, 0.1)
            loo = [add(np.where(own, arc_weights(pair - own, np.maximum(before - own, 0), less, k), 0.0)) for k in STRENGTHS]
            parts.append(
                pa.table(
                    {
                        "_id": b.rows.column("_id"),
                        "held_out": b.rows.column("held_out"),
                        "n_tokens": pa.array(b.length.astype(np.int64)),
                        "n_known": pa.array(add(c > 0).astype(np.int64)),
                        "base_score": pa.array(add(np.log10(root))),
                        "scores": pa.array(list(np.stack(scores, 1)), pa.list_(pa.float64())),
                        "loo": pa.array(list(np.stack(loo, 1)), pa.list_(pa.float64())),
                    }
                )
            )
        return pa.concat_tables(parts) if parts else pa.schema([("_id", kind), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("scores", pa.list_(pa.float64())), ("loo", pa.list_(pa.float64()))]).empty_table()

    return run


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10 probabilities).

    Tokens: words with A-Z lower-cased, then one end. A null or empty text is the end alone. All rows outside the
    held-out fold train the model, repeated ones each time; a null id counts as the text "" in the fold. Where nothing
    trains, every token has the root's weight. An empty table gives no rows. Other columns may have any name.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    source = docs.select(F.col(id_col).alias("_id"), (bucket_of(F.col(id_col), folds) == 0).alias("held_out"), F.col(text_col).cast("string").alias("_text"))
    kind = source.schema["_id"].dataType
    blocks = stored(source.mapInArrow(_blocks, "block long, bytes long, texts binary"), "blocks")
    size = blocks.agg(F.sum("bytes")).first()[0] or 0
    ranges = max(4, -(-size // RANGE_BYTES))
    keys = _hot_keys(blocks)
    counts = _hot_counts(blocks, keys)
    context = docs.sparkSession.sparkContext
    asked = blocks.select("block", "texts").mapInArrow(_requests(ranges, context.broadcast(keys)), "range long, block long, word binary, cw binary, pair binary, cp binary")
    answers = stored(asked.groupBy("range").applyInArrow(_answer, "block long, range long, cw binary, cp binary, v long, n long"), "answers")
    distinct, total = answers.agg(F.coalesce(F.sum("v"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    distinct, total = distinct + int((counts[0] > 0).sum()), total + int(counts[0].sum())
    walk = _traverse(total, distinct, to_arrow_type(kind), context.broadcast((keys, counts)))
    schema = f"_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, base_score double, scores array<double>, loo array<double>"
    rows = stored(blocks.select("block", "texts").groupBy("block").cogroup(answers.select("block", "range", "cw", "cp").groupBy("block")).applyInArrow(walk, schema), "scores")
    fit = rows.agg(*(F.sum(F.col("loo")[i]) for i in range(len(STRENGTHS)))).first()
    best = max(range(len(STRENGTHS)), key=lambda i: (fit[i] if fit[i] is not None else 0.0, i))
    return rows.select(F.col("_id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", F.col("scores")[best].alias("score"))
