"""Exact n-gram Jaccard self-join of documents by count-vector R-trees.

A document is the set of hashes of its k-word shingles. Hashing these into GROUPS groups gives a vector of counts, a point;
two sets share at most the sum of the coordinate-wise minima of their points.

1. Equal sets form a class; only one text of a class goes on.
2. A class is filed under its first shingles in one global order, very frequent ones last, so many that two similar sets
   must meet under one of them. Those under one shingle form a cell.
3. In a first round each class is compared with the two that it meets most often, as the first of its size or as its
   neighbour in a cell. What is verified joins components, so that a large group of near copies costs few pairs.
4. In cells with more than one component, rows without a partner that fits by place in the order and by number of common
   cells (two exact conditions, see admissible) go first. An R-tree over the points of what stays finds the pairs of
   different components whose bound reaches the threshold; cells over TILE are dealt out as pairs of tiles. While rounds with only the closest pair of any
   two components find links, they go on; a last one with all pairs finds whatever is left.
5. All rounds verify pairs on the whole texts. The components of all links are the result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import arrow_map, stored
from .words import mix, windows, words

#: Coordinates of a point; most classes of a cell that one task compares; most rows of a broadcast table (16 bytes each).
GROUPS, TILE, BROADCAST_ROWS = 256, 20_000, 500_000
#: Most shingles that are ordered last as frequent (16 bytes each), and most that a task puts up for that.
FREQUENT, TASK_FREQUENT = 1 << 19, 1 << 16
#: Cells of up to so many classes are compared directly.
SMALL = 24
LEAF = 16
#: Pairs whose points are compared at once (some kilobytes each).
PAIRS = 8192
_MOST = 65535


def shingle_sets(column, k: int = 5) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text: all its words as one if it has fewer than k, none without words."""
    for block in words(column, lower=True):
        bounds, w = block.bounds(), windows(block.hash, k)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= k:
                yield np.unique(w[a : b - k + 1])
            elif b > a:
                yield mix(windows(block.hash[a:b], int(b - a)) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def point(shingles: np.ndarray) -> np.ndarray:
    """Counts by group. A long text has more groups, an eighth of its shingles at least; each splits one of the coarser point."""
    bits = max(8, int(len(shingles)).bit_length() - 3)
    return np.bincount((shingles >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint16)


def coarse(fine: np.ndarray, groups: int = GROUPS) -> np.ndarray:
    """A point with fewer groups."""
    return fine.reshape(groups, -1).sum(1) if len(fine) > groups else fine


def _narrow(counts: np.ndarray) -> np.ndarray:
    """A coarse point in 16 bits. One that does not fit (of some 16 million shingles) is as large as can be in all groups,
    which `reachable` takes for any overlap."""
    return counts.astype(np.uint16) if counts.max() <= _MOST else np.full(len(counts), _MOST, np.uint16)


def _name(shingles: np.ndarray) -> int:
    """64-bit name of a class; with the set's size it identifies the set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def need(n, m, t: float):
    """Fewest shared shingles of linked sets of n and m."""
    return np.ceil(t * (n + m) / (100 + t) - 1e-9)


def reachable(n, m, t: float):
    """The bound that points of linked sets reach at least; never more than full points give."""
    return np.minimum(need(n, m, t), GROUPS * _MOST)


def admissible(i: dict, j: dict, t: int) -> np.ndarray:
    """Whether two postings of a cell can be the first shingle that linked sets share: the places before it hold only
    shingles that the other lacks, the sets meet in more cells than either lies in, and their components differ."""
    least = need(i["n"], j["n"], t)
    meetings = least - np.ceil(t * np.maximum(i["n"], j["n"]) / 100 - 1e-9) + 1
    return (i["component"] != j["component"]) & (i["place"] <= i["n"] - least) & (j["place"] <= j["n"] - least) & (np.minimum(i["cells"], j["cells"]) >= meetings)


def linked(common: int, n: int, m: int, t: int) -> bool:
    return 100 * common >= t * (n + m - common)


_ROWS = [("n", pa.int64()), ("cls", pa.int64()), ("point", pa.binary()), ("vec", pa.binary()), ("hash", pa.int64()), ("often", pa.int64())]


def _rows(k: int):
    """Per text (id, text, hash) its size, class and point; per task its frequent shingles, as rows of cls and often alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys, counts, pending, width, kind = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0, pa.int64()

        def fold(keys, counts):
            """Add what is pending up; what is rare so far is forgotten."""
            every, at = np.unique(np.concatenate([keys, *pending]), return_inverse=True)
            total = np.bincount(at, np.concatenate([counts, np.ones(len(at) - len(counts), np.int64)]), len(every)).astype(np.int64)
            held = total >= 2
            return every[held], total[held]

        for batch in batches:
            kind = batch.schema.field(0).type
            n, name, vec, low = [], [], [], []
            for s in shingle_sets(batch.column(1), k):
                c, fine = _name(s), point(s)
                n.append(len(s))
                name.append(c)
                vec.append(fine.tobytes() if len(s) else None)
                low.append(_narrow(coarse(fine)).tobytes() if len(s) else None)
                if len(s) and c not in seen:
                    seen.add(c)
                    pending.append(s)
                    width += len(s)
                    if width > 2_000_000:
                        keys, counts = fold(keys, counts)
                        pending, width = [], 0
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(name, pa.int64()), pa.array(low, pa.binary()), pa.array(vec, pa.binary()), batch.column(2), pa.nulls(len(n), pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, ["_id", *(c for c, _ in _ROWS)])
        keys, counts = fold(keys, counts)
        often = np.argsort(-counts, kind="stable")[:TASK_FREQUENT]
        often = often[counts[often] >= 3]
        if len(often):
            m = len(often)
            cols = [pa.nulls(m, kind), pa.nulls(m, pa.int64()), pa.array(keys[often].view(np.int64)), pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()), pa.nulls(m, pa.int64()), pa.array(counts[often])]
            yield pa.RecordBatch.from_arrays(cols, ["_id", *(c for c, _ in _ROWS)])

    return run


def _ordered(shingles: np.ndarray, frequent: np.ndarray, at_least: int) -> np.ndarray:
    """The first at_least shingles in the global order: infrequent ones by hash, then frequent ones by rank."""
    if not len(frequent):
        return shingles[:at_least]
    keys = frequent["key"]
    at = np.minimum(np.searchsorted(keys, shingles), len(keys) - 1)
    hot = keys[at] == shingles
    first = shingles[~hot][:at_least]
    if len(first) < at_least:
        last = shingles[hot]
        first = np.concatenate([first, last[np.argsort(frequent["rank"][at[hot]], kind="stable")][: at_least - len(first)]])
    return first


def _postings(k: int, t: int, frequent):
    """(shingle, class, code) rows, once for each class of a task. code: size << 32 | place in the global order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            keys, names, codes, size = [], [], [], 0
            for s in shingle_sets(batch.column(0), k):
                n, c = len(s), _name(s)
                if not n or (c, n) in seen:
                    continue
                seen.add((c, n))
                prefix = _ordered(s, frequent.value, n - -(-t * n // 100) + 1)
                keys.append(prefix.view(np.int64))
                names.append(np.full(len(prefix), c))
                codes.append((n << 32) + np.arange(len(prefix)))
                size += len(prefix)
                if size > 100_000:
                    yield _batch(keys, names, codes)
                    keys, names, codes, size = [], [], [], 0
            if size:
                yield _batch(keys, names, codes)

    return run


def _batch(keys, names, codes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (keys, names, codes)], ["key", "cls", "code"])


def _cells(t: int):
    """From postings in order of shingle, size and class: those that share their shingle with another class, with the first
    class of about their size in the cell (lead) and the one before (prev). A single posting is kept between batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = np.log(100 / t)
        last = None  # key, cls and code of the last posting; whether it shares with the one before; its lead and prev
        for batch in batches:
            key, name, code = (batch.column(i).to_numpy() for i in range(3))
            if last is not None:
                key, name, code = np.append(last[0], key), np.append(last[1], name), np.append(last[2], code)
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (name[1:] != name[:-1]) | (code[1:] != code[:-1])])  # copies met in several tasks
            key, name, code = key[new], name[new], code[new]
            same = key[1:] == key[:-1]
            size = np.floor(np.log(code >> 32) / ratio)
            begins = np.concatenate([[True], ~same | (size[1:] != size[:-1])])
            at = np.maximum.accumulate(np.where(begins, np.arange(len(key)), 0))
            left = np.concatenate([[False], same])
            lead, prev = name[at], np.where(left, np.concatenate([name[:1], name[:-1]]), name)
            if last is not None:
                left[0], prev[0] = last[3], last[5]
                lead[at == 0] = last[4]
            keep = np.flatnonzero(left[:-1] | same)
            if len(keep):
                yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in (key, name, code, lead, prev)], ["key", "cls", "code", "lead", "prev"])
            last = (key[-1], name[-1], code[-1], bool(left[-1]), lead[-1], prev[-1])
        if last is not None and last[3]:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (last[0], last[1], last[2], last[4], last[5])], ["key", "cls", "code", "lead", "prev"])

    return run


class CountTree:
    """A packed R-tree over count vectors: a node knows the largest coordinates and the range of sizes below it."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, component: np.ndarray):
        spread = points.var(axis=0).argsort()[::-1][:2] if len(points) else np.zeros(2, int)
        slabs = max(1, int(np.sqrt(len(points) / LEAF)))
        by_size = np.argsort(sizes, kind="stable")
        order = np.concatenate([part[np.lexsort((points[part, spread[1]], points[part, spread[0]]))] for part in np.array_split(by_size, slabs)])
        self.points, self.sizes, self.component, self.order = points[order].astype(np.int32), sizes[order], component[order], order
        starts = np.arange(0, len(order), LEAF)
        self.levels = [self._level(self.points, self.sizes, self.sizes, self.component, self.component, starts)]
        while len(self.levels[-1][0]) > LEAF:
            top, low, high, c_low, c_high = self.levels[-1]
            self.levels.append(self._level(top, low, high, c_low, c_high, np.arange(0, len(top), LEAF)))

    @staticmethod
    def _level(top, low, high, c_low, c_high, starts):
        return np.maximum.reduceat(top, starts), np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts), np.minimum.reduceat(c_low, starts), np.maximum.reduceat(c_high, starts)

    def pairs(self, t: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of points of different components whose bound reaches the threshold."""
        level = len(self.levels) - 1
        n = len(self.levels[level][0])
        a, b = np.triu_indices(n)
        todo = [(level, a, b)]
        while todo:
            level, a, b = todo.pop()
            if len(a) > 4096:
                todo += [(level, a[i : i + 4096], b[i : i + 4096]) for i in range(0, len(a), 4096)]
                continue
            top, low, high, c_low, c_high = self.levels[level]
            bound = np.minimum(top[a], top[b]).sum(1)
            ok = (bound >= reachable(low[a], low[b], t)) & (100 * high[a] >= t * low[b]) & (100 * high[b] >= t * low[a])
            ok &= ~((c_low[a] == c_high[a]) & (c_low[b] == c_high[b]) & (c_low[a] == c_low[b]))
            a, b = a[ok], b[ok]
            if not len(a):
                continue
            size = len(self.levels[level - 1][0]) if level else len(self.points)
            i = (a[:, None] * LEAF + np.arange(LEAF))[:, :, None]
            j = (b[:, None] * LEAF + np.arange(LEAF))[:, None, :]
            i, j = (x.ravel() for x in np.broadcast_arrays(i, j))
            inside = (i < size) & (j < size) & ((i <= j) if level else (i < j))
            i, j = i[inside], j[inside]
            if level:
                todo.append((level - 1, i, j))
            else:
                for lo in range(0, len(i), PAIRS):
                    x, y = i[lo : lo + PAIRS], j[lo : lo + PAIRS]
                    differ = self.component[x] != self.component[y]
                    x, y = x[differ], y[differ]
                    good = np.minimum(self.points[x], self.points[y]).sum(1) >= reachable(self.sizes[x], self.sizes[y], t)
                    yield self.order[x[good]], self.order[y[good]]


def _points(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, GROUPS)


def _grouped(cells):
    """Run `cells` on tables of whole cells (key, s1, s2) of a sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if held is None else pa.concat_tables([held, now]).combine_chunks()
            last = [now.column(c)[-1].as_py() for c in ("key", "s1", "s2")]
            open_ = np.logical_and.reduce([now.column(c).to_numpy() == v for c, v in zip(("key", "s1", "s2"), last)])
            cut = int(np.argmax(open_))
            if cut:
                yield from cells(now.slice(0, cut))
            held = now.slice(cut)
        if held is not None and held.num_rows:
            yield from cells(held)

    return run


class _Cells:
    """A table of whole cells as arrays; rows come in order of cell, size and class."""

    def __init__(self, table: pa.Table):
        self.table = table
        self.key = np.stack([table.column(c).to_numpy() for c in ("key", "s1", "s2")])
        code = table.column("code").to_numpy()
        self.salt = table.column("salt").to_numpy()
        self.of = {"n": code >> 32, "place": code & 0xFFFFFFFF, "component": table.column("component").to_numpy(), "cells": table.column("cells").to_numpy()}
        self.begins = np.flatnonzero(np.concatenate([[True], (self.key[:, 1:] != self.key[:, :-1]).any(0)]))
        self.length = np.diff(np.append(self.begins, len(code)))
        self.cell = np.repeat(np.arange(len(self.begins)), self.length)

    def at(self, rows: np.ndarray) -> dict:
        return {k: v[rows] for k, v in self.of.items()}

    def admissible(self, i: np.ndarray, j: np.ndarray, t: int) -> np.ndarray:
        return admissible(self.at(i), self.at(j), t) & ((self.key[1][i] == self.key[2][i]) | (self.salt[i] != self.salt[j]))

    def shifted(self, t: int, most: int | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Admissible pairs (i, j) of cells of up to `most` rows, a distance at a time; sizes grow with it, so that a cell
        is done when its sizes are too far apart."""
        alive = np.flatnonzero((self.length <= most)[self.cell]) if most else np.arange(len(self.cell))
        shift = 1
        while len(alive):
            alive = alive[alive + shift < len(self.cell)]
            alive = alive[self.cell[alive + shift] == self.cell[alive]]
            alive = alive[100 * self.of["n"][alive] >= t * self.of["n"][alive + shift]]
            ok = self.admissible(alive, alive + shift, t)
            yield alive[ok], alive[ok] + shift
            shift += 1


def _with_partner(t: int):
    """The rows of a cell that have an admissible partner in it, before any point is fetched; large cells stay whole."""

    def cells(table: pa.Table) -> Iterator[pa.RecordBatch]:
        c = _Cells(table)
        keep = (c.length > SMALL)[c.cell]
        for i, j in c.shifted(t, SMALL):
            keep[i] = keep[j] = True
        yield from table.filter(pa.array(keep)).combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, passing = None, None
        for batch in batches:
            now = pa.Table.from_batches([batch])
            now = now if held is None else pa.concat_tables([held, now]).combine_chunks()
            key, last = now.column("key").to_numpy(), now.column("key")[-1].as_py()
            lead = int(np.argmin(np.append(key == passing, False))) if passing is not None else 0
            if lead:  # the rest of a large cell: no need to hold it
                yield from now.slice(0, lead).combine_chunks().to_batches()
            cut = max(lead, int(np.argmax(key == last)))
            if cut > lead:
                yield from cells(now.slice(lead, cut - lead))
            held = now.slice(cut)
            if held.num_rows > SMALL:
                yield from held.combine_chunks().to_batches()
                held, passing = None, last
            elif not held.num_rows:
                held = None
        if held is not None:
            yield from cells(held)

    return run


def _tree_join(t: int, best: bool):
    """Candidate pairs of each cell with their components and how far the bound is over the threshold; best: of two
    components only the pair where it is farthest."""

    def cells(table: pa.Table) -> Iterator[pa.RecordBatch]:
        c = _Cells(table)
        name, vec, n, comp = table.column("cls").to_numpy(), _points(table.column("point")), c.of["n"], c.of["component"]
        bound = lambda i, j: np.concatenate([np.zeros(0, np.int64), *(np.minimum(vec[i[x : x + PAIRS]], vec[j[x : x + PAIRS]]).sum(1, dtype=np.int64) for x in range(0, len(i), PAIRS))])
        over = lambda i, j: bound(i, j) / reachable(n[i], n[j], t)
        out: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for i, j in c.shifted(t, SMALL):
            ok = over(i, j) >= 1
            out.append((i[ok], j[ok]))
        for g in np.flatnonzero(c.length > SMALL):
            at = np.arange(c.begins[g], c.begins[g] + c.length[g])
            for a, b in CountTree(vec[at], n[at], comp[at]).pairs(t):
                i, j = np.minimum(at[a], at[b]), np.maximum(at[a], at[b])
                ok = c.admissible(i, j, t)
                out.append((i[ok], j[ok]))
        i, j = (np.concatenate(x) for x in zip(*out))
        low, high = np.minimum(comp[i], comp[j]), np.maximum(comp[i], comp[j])
        close = over(i, j) if best and len(i) else np.ones(len(i))
        order = np.lexsort((name[j], name[i], -close, high, low))
        same = (low[order][1:] == low[order][:-1]) & (high[order][1:] == high[order][:-1])
        if not best:
            same &= (name[i[order]][1:] == name[i[order]][:-1]) & (name[j[order]][1:] == name[j[order]][:-1])
        order = order[np.concatenate([[True], ~same])] if len(order) else order
        cols = [name[i], name[j], low, high, close]
        for lo in range(0, len(order), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[order[lo : lo + 100_000]]) for x in cols], ["a", "b", "low", "high", "close"])

    return _grouped(cells)


def _verify(k: int, t: int):
    """Of rows (a, b, text_a, text_b), in order of a, the pairs that are linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, left = None, np.zeros(0, np.uint64)
        for batch in batches:
            good = []
            names = batch.column(0).to_pylist()
            for i, (other, first) in enumerate(zip(shingle_sets(batch.column(3), k), names)):
                if first != name:
                    name, left = first, next(shingle_sets(batch.column(2).slice(i, 1), k))
                common = len(np.intersect1d(left, other, assume_unique=True))
                good.append(linked(common, len(left), len(other), t))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a stored table of a few numbers a row if it is within the bound; else Spark joins it by a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _texts_of(k: int):
    """Of rows (class, text), one for each class of a task whose text is of that class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            keep = []
            for c, s in zip(batch.column(0).to_pylist(), shingle_sets(batch.column(1), k)):
                keep.append(c not in seen and _name(s) == c)
                if keep[-1]:
                    seen.add(c)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def _links(source: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, t: int) -> DataFrame:
    """Verified (a, b) of candidate pairs; only one text of each class in a pair is shuffled."""
    wanted = stored(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(classes.select("cls", "hash"), "cls"), "wanted")
    found = source.select("_text", "_hash").join(_maybe_broadcast(wanted), F.col("_hash") == F.col("hash")).select("cls", "_text")
    texts = stored(found.mapInArrow(_texts_of(k), "cls long, text string").dropDuplicates(["cls"]), "texts")
    both = pairs.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b").join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    return stored(both.select("a", "b", "text_a", "text_b").sortWithinPartitions("a").mapInArrow(_verify(k, t), "a long, b long"), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Two rows are linked if 100 * |A and B| >= percent * |A or B| of their sets of k-word shingles (A-Z lower-cased; with
    fewer words, all of them as one shingle). component_id is the smallest id that links reach. A null or empty text, or
    one of white space, has no shingle and no link: its component is its own id. Copies and repeated rows form one
    component; a row with a null id has its class's component, null if no row of that has an id. An empty table gives
    no rows. Other columns of docs may have any name. No pair is left out: there is no cap on cells, and a link can
    only be missed where 64-bit hashes of different shingles are equal.
    """
    spark, t = docs.sparkSession, percent
    source = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("_text")).withColumn("_hash", F.xxhash64("_text"))
    kind = source.schema["_id"].dataType.simpleString()
    measured = stored(source.mapInArrow(_rows(k), f"_id {kind}, n long, cls long, point binary, vec binary, hash long, often long"), "rows")
    rows = measured.where("n is not null").select("_id", "n", "cls")
    classes = stored(measured.where("n > 0").groupBy("cls").agg(F.min("_id").alias("rep"), F.min("n").alias("n"), F.min("hash").alias("hash"), F.first("point").alias("point"), F.first("vec").alias("vec")), "classes")
    frequent = spark.sparkContext.broadcast(_frequent(measured))

    postings = source.select("_text").mapInArrow(_postings(k, t, frequent), "key long, cls long, code long")
    cells = postings.repartition("key").sortWithinPartitions("key", "code", "cls").mapInArrow(_cells(t), "key long, cls long, code long, lead long, prev long")
    filed = stored(cells, "cells")
    filed = stored(_fitting(filed, t), "fitting")

    candidates, found = _partners(filed), None
    while True:
        links = _links(source, classes, stored(_bounded(candidates, classes, t), "pairs"), k, t)
        if found is not None and links.isEmpty():
            break
        known = stored(components(links if found is None else found.union(links)), "known")
        found = known.select(F.col("node").alias("a"), F.col("component").alias("b"))
        candidates = _candidates(filed, classes, known, t, best=True)
    late = _links(source, classes, stored(_bounded(_candidates(filed, classes, known, t, best=False), classes, t), "pairs"), k, t)
    final = components(found.union(late))

    in_class = classes.select("cls", "rep").join(final, classes["cls"] == final["node"], "left").select("cls", "rep", F.coalesce("component", "cls").alias("component"))
    least = in_class.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = in_class.join(least, "component").select(F.col("cls").alias("_cls"), "component_id")
    out = rows.withColumn("_key", F.when(F.col("n") > 0, F.col("cls")).otherwise(F.xxhash64("_id"))).join(named, (F.col("_key") == F.col("_cls")) & (F.col("n") > 0), "left")
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"))


def _partners(filed: DataFrame) -> DataFrame:
    """For each class the lead and the neighbour that it shares most cells with: at most two pairs (a, b) a class."""
    met = [filed.where(F.col("cls") != F.col(c)).groupBy("cls", F.col(c).alias("other")).agg(F.count("*").alias("n")).groupBy("cls").agg(F.max(F.struct("n", "other")).alias("best")) for c in ("lead", "prev")]
    both = met[0].union(met[1]).select("cls", F.col("best.other").alias("other"))
    return both.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct()


def _fitting(filed: DataFrame, t: int) -> DataFrame:
    """The rows of cells that have a partner which fits, with the number of cells that their class lies in. Later rounds
    read only these. Large cells stay whole."""
    rows = filed.join(filed.groupBy("cls").agg(F.count("*").alias("cells")), "cls")
    zero = F.lit(0)
    rows = rows.select("key", zero.alias("s1"), zero.alias("s2"), zero.alias("salt"), "cls", "code", F.col("cls").alias("component"), "cells", "lead", "prev")
    kept = rows.repartition("key").sortWithinPartitions("key", F.shiftright("code", 32), "cls").mapInArrow(_with_partner(t), rows.schema)
    return kept.select("key", "cls", "code", "cells", "lead", "prev")


def _candidates(filed: DataFrame, classes: DataFrame, known: DataFrame, t: int, best: bool) -> DataFrame:
    """Pairs (a, b) of different components by the tree join of all cells with more than one component."""
    labels = _maybe_broadcast(known)
    marked = filed.join(labels, filed["cls"] == known["node"], "left").select("key", "cls", "code", "cells", F.coalesce("component", "cls").alias("component"))
    mixed = stored(marked.groupBy("key").agg(F.count("*").alias("size"), F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key", F.ceil(F.col("size") / TILE).cast("int").alias("tiles")), "mixed")
    open_ = marked.join(_maybe_broadcast(mixed), "key")
    open_ = open_.withColumn("salt", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    open_ = open_.select("key", F.least("salt", "other").alias("s1"), F.greatest("salt", "other").alias("s2"), "salt", "cls", "code", "component", "cells")
    sort = ("key", "s1", "s2", F.shiftright("code", 32), "cls")
    open_ = open_.join(classes.select("cls", "point"), "cls").repartition("key", "s1", "s2").sortWithinPartitions(*sort)
    pairs = open_.select("key", "s1", "s2", "salt", "cls", "code", "component", "cells", "point").mapInArrow(_tree_join(t, best), "a long, b long, low long, high long, close double")
    if best:
        return pairs.groupBy("low", "high").agg(F.max(F.struct("close", "a", "b")).alias("p")).select("p.a", "p.b")
    return pairs.select("a", "b").distinct()


def _frequent(measured: DataFrame) -> np.ndarray:
    """The FREQUENT most frequent shingles at most, with their rank, sorted by hash. Any set is right; a good one makes
    cells small. All counts of one power of two are taken or none, so that no sort is needed."""
    counts = measured.where("n is null").groupBy("cls").agg(F.sum("often").alias("c"))
    counts = stored(counts.withColumn("size", F.floor(4 * F.log2("c")).cast("int")), "frequent")
    room, least = FREQUENT, None
    for size, n in counts.groupBy("size").count().orderBy(F.desc("size")).collect():
        if n > room:
            break
        room, least = room - n, size
    rows = counts.where(F.col("size") >= least if least is not None else F.lit(False)).select("cls", "c").toArrow()
    keys, c = rows.column("cls").to_numpy().view(np.uint64), rows.column("c").to_numpy()
    rank = np.empty(len(keys), np.int64)
    rank[np.lexsort((keys, c))] = np.arange(len(keys))
    out = np.empty(len(keys), [("key", np.uint64), ("rank", np.int64)])
    out["key"], out["rank"] = keys, rank
    return np.sort(out, order="key")


def _bounded(pairs: DataFrame, classes: DataFrame, t: int) -> DataFrame:
    """The pairs whose points, in as many groups as both have, allow the threshold."""
    left, right = (classes.select(F.col("cls").alias(c), F.col("n").alias(f"n_{c}"), F.col("vec").alias(f"vec_{c}")) for c in ("a", "b"))

    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        least = need(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), t)
        good = []
        for a, b, enough in zip(batch.column("vec_a"), batch.column("vec_b"), least):
            a, b = np.frombuffer(a.as_py(), np.uint16), np.frombuffer(b.as_py(), np.uint16)
            groups = min(len(a), len(b))
            good.append(int(np.minimum(coarse(a, groups), coarse(b, groups)).sum()) >= enough)
        return batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return arrow_map(pairs.join(left, "a").join(right, "b"), keep, "a long, b long")
