"""Benchmark decontamination by latent semantic retrieval.

1. One scan of the texts keeps, of each, the places of words that the benchmark uses.
2. Passages of PASSAGE words give document frequencies and, with the benchmark's own items, a TF-IDF matrix. A randomised
   SVD (a Gaussian sketch, one power iteration, a Rayleigh-Ritz step) finds its leading right singular vectors: executors
   add up the products of their passages, the driver only holds words times RANK numbers.
   Only informative words count: those that are rare in the corpus, and the rarest of each item.
3. Windows of each text are compared with the items by the cosine of their latent vectors; beside that, places where a
   run of words long enough for the verdict is the same are looked up exactly.
4. Of each text and item, candidates are judged by falling cosine until one passes: the longest common subsequence holds
   enough of the item's words and its answer (the item's end) is found too, or a long run of words is the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import arrow_map, stored
from .words import PUNCTUATION, buffers, words

PASSAGE, RANK, OVERSAMPLE = 32, 256, 16
#: Words of the windows that are compared, and the cosine of a candidate.
WINDOWS, COSINE = (24, 64), 0.35
#: A word in more than this part of the passages says nothing, unless an item would have less than LEAST others.
COMMON, LEAST = 0.002, 8
#: Rows of texts that are judged together.
LOT = 2048
#: Items compared by one SVD, and items whose words are looked up in one scan of the texts.
ITEMS, SCAN_ITEMS = 200, 20_000


@dataclass
class Verdict:
    """What a candidate needs: shares of the item's and of its answer's words, or a run of equal words."""

    lcs: float = 0.6
    answer: float = 0.5
    run: int = 13


def split_words(column) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of each word, without case and punctuation."""
    docs, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for w in words(pc.utf8_lower(column), space=PUNCTUATION):
        docs.append(w.doc + w.first)
        hashes.append(w.hash)
    return np.concatenate(docs), np.concatenate(hashes)


def answer_of(item: np.ndarray) -> np.ndarray:
    """The last quarter of an item's words, three at least."""
    return item[-max(3, len(item) // 4) :]


def _numbered(item: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Each word of the item, and of the texts, by its number among the item's different words; how many those are, which stands for all others.

    Words are numbers of a vocabulary, -1 where none is known, so one look at a table tells each.
    """
    known, place = np.unique(item, return_inverse=True)
    table = np.full(max(int(known[-1]), int(texts.max(initial=-1))) + 2, len(known), np.min_scalar_type(len(known)))
    table[known] = np.arange(len(known))
    return place, table.take(texts, mode="wrap"), len(known)


def shared_words(item: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Words that the item and each row of texts have in common, repeated ones as often as both have them: lcs is no more."""
    if not len(item) or not texts.size:
        return np.zeros(len(texts), np.int64)
    place, at, size = _numbered(item, texts)
    hit = np.flatnonzero(at != size)
    met = np.bincount(hit // at.shape[1] * size + at.ravel()[hit], minlength=len(texts) * size).reshape(len(texts), size)
    return np.minimum(met, np.bincount(place)).sum(1)


def lcs(item: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of the item with each row of texts.

    Bit-parallel: bit i of a row's vector is 0 where the row of the dynamic programme grows at word i of the item; each
    word of the texts that the item has is an addition with carry over the item's words, 64 at a time, for all rows at once.
    """
    rows, m = len(texts), len(item)
    if not m or not texts.size:
        return np.zeros(rows, np.int64)
    place, at, size = _numbered(item, texts)
    masks = np.zeros((size + 1, -(-m // 64)), np.uint64)
    np.bitwise_or.at(masks, (place, np.arange(m) // 64), np.uint64(1) << (np.arange(m) % 64).astype(np.uint64))
    hit = np.flatnonzero(at != size)
    row = hit // at.shape[1]
    begins = np.searchsorted(row, np.arange(rows))
    order = np.arange(len(row)) - begins[row]
    met = np.full((int(order.max(initial=-1)) + 1, rows), size)
    met[order, row] = at.ravel()[hit]
    state = np.full((masks.shape[1], rows), ~np.uint64(0))
    for word in met:
        carry = np.zeros(rows, np.uint64)
        for k in range(len(state)):
            old = state[k]
            same = old & masks[word, k]
            grown = old + same
            if len(state) > 1:
                over = grown < old
                grown = grown + carry
                carry = (over | (grown < carry)).astype(np.uint64)
            state[k] = grown | (old ^ same)
    if m % 64:
        state[-1] |= ~np.uint64(0) << np.uint64(m % 64)
    return 64 * len(state) - np.bitwise_count(state).sum(0, dtype=np.int64)


def longest_run(item: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Most successive words of the item that stand so in each row of texts."""
    if not len(item) or not texts.size:
        return np.zeros(len(texts), np.int32)
    place, at, _ = _numbered(item, texts)
    kind = np.min_scalar_type(len(item))
    best, row = np.zeros(at.shape, kind), np.zeros((len(at), at.shape[1] + 1), kind)
    for x in place:
        row[:, 1:] = (row[:, :-1] + kind.type(1)) * (at == x)
        np.maximum(best, row[:, 1:], out=best)
    return best.max(1).astype(np.int32)


def judge(item: np.ndarray, texts: np.ndarray, verdict: Verdict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For rows of texts: is it the item, shares of the item and of its answer in the common subsequence, longest run.

    Each is worked out (else 0) only where what is known before it lets it matter: the shared words bound the subsequence,
    and that bounds the run.
    """
    n, least = len(texts), min(verdict.lcs * len(item), verdict.run)
    common, answer, run = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.int32)
    may = np.flatnonzero(shared_words(item, texts) >= least) if len(item) else np.zeros(0, np.int64)
    common[may] = lcs(item, texts[may])
    share = common / max(len(item), 1)
    may = may[(share[may] >= verdict.lcs) | (common[may] >= verdict.run)]
    if len(may):
        part = answer_of(item)
        answer[may], run[may] = lcs(part, texts[may]) / len(part), longest_run(item, texts[may])
    return (((share >= verdict.lcs) & (answer >= verdict.answer)) | (run >= verdict.run)) & (len(item) > 0), share, answer, run


def run_hashes(word: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of the `length` words from each start."""
    h = np.full(len(starts), 14695981039346656037, np.uint64)
    for k in range(length):
        h = (h ^ word[starts + k].astype(np.uint64)) * np.uint64(1099511628211)
        h ^= h >> np.uint64(29)
    return h


def item_runs(items: list[np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash, in order, and item of every run of `length` words of the items."""
    hashes = [np.unique(run_hashes(w, np.arange(max(0, len(w) - length + 1)), length)) for w in items]
    h, j = np.concatenate(hashes), np.repeat(np.arange(len(items)), [len(x) for x in hashes])
    order = np.argsort(h, kind="stable")
    return h[order], j[order]


def _run_starts(row: np.ndarray, place: np.ndarray, word: np.ndarray, runs: tuple[np.ndarray, np.ndarray], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hits at which a run of an item begins, and the item; where runs follow each other, the first."""
    n = max(0, len(row) - length + 1)
    starts = np.flatnonzero((row[:n] == row[len(row) - n :]) & (place[len(row) - n :] - place[:n] == length - 1))
    h = run_hashes(word, starts, length)
    low, high = np.searchsorted(runs[0], h), np.searchsorted(runs[0], h, "right")
    count = high - low
    at, item = np.repeat(starts, count), runs[1][np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())]
    order = np.lexsort((at, item))
    at, item = at[order], item[order]
    new = np.concatenate([[True], (item[1:] != item[:-1]) | (at[1:] != at[:-1] + 1)])[: len(at)]
    return at[new], item[new]


def _binary(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    """The bytes of values[cut[i] : cut[i + 1]] for each i; cut begins at 0."""
    offsets = pa.array(cut * values.itemsize, pa.int32())
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, offsets.buffers()[1], pa.py_buffer(np.ascontiguousarray(values))])


def _places(vocabulary):
    """id, n_words, places (int32) and words (int32 numbers in the vocabulary) of each text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        doc, h = split_words(batch.column(1))
        keys = vocabulary.value
        at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
        hit = np.flatnonzero(keys[at] == h) if len(keys) else np.zeros(0, np.int64)
        first = np.searchsorted(doc, np.arange(batch.num_rows + 1))
        cut = np.searchsorted(hit, first)
        place, word = (hit - first[doc[hit]]).astype(np.int32), at[hit].astype(np.int32)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(first)), _binary(place, cut), _binary(word, cut)], ["_id", "n", "place", "word"])

    return run


def _flat(batch: pa.RecordBatch, names: tuple[str, str] = ("place", "word")) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place and word of every hit of a batch."""
    place, word = (np.frombuffer(buffers(batch.column(c))[0], np.int32) for c in names)
    length = pc.binary_length(batch.column(names[0])).to_numpy() // 4
    return np.repeat(np.arange(batch.num_rows), length), place, word


def _passages(batch: pa.RecordBatch, size: int, names: tuple[str, str] = ("place", "word")) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (passage, word) with its count, in order of passage. size: words of the vocabulary."""
    row, place, word = _flat(batch, names)
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    passage = place // PASSAGE
    number = np.concatenate([[0], np.cumsum((row[1:] != row[:-1]) | (passage[1:] != passage[:-1]))])
    key = np.sort(number * size + word)
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[begins] // size, key[begins] % size, np.diff(np.append(begins, len(key)))


def _frequencies(places: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """Passages with each word, and all passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(size, np.int64)
        for batch in batches:
            count += np.bincount(_passages(batch, size)[1], minlength=size)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], ["word", "df"])

    table = places.select("place", "word").mapInArrow(run, "word long, df long").groupBy("word").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(size, np.int64)
    df[table.column("word").to_numpy()] = table.column("df").to_numpy()
    return df, places.agg(F.sum(F.ceil(F.col("n") / PASSAGE))).first()[0] or 0


def _weighted(key: np.ndarray, word: np.ndarray, count: np.ndarray, idf: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Informative entries of unit TF-IDF rows: where each passage begins, passage number, column, value."""
    good = column[word] >= 0
    key, word, count = key[good], word[good], count[good]
    begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    value = (1 + np.log(count)) * idf[word]
    which = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(key))))
    norm = np.sqrt(np.bincount(which, value * value, len(begins)))
    return begins, which, column[word], value / norm[which] if len(key) else value


def _sums(rows: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sum of the rows from each of begins to the next: the k-th rows of all that have so many are added at once."""
    count = np.diff(np.append(begins, len(rows)))
    out, k = rows[begins], 1
    some = np.flatnonzero(count > k)
    while len(some):
        out[some] += rows[begins[some] + k]
        k += 1
        some = some[count[some] > k]
    return out


def _gram(entries, basis: np.ndarray, out: np.ndarray) -> None:
    """out += A^T (A basis) for rows given by entries, as many at a time as stay in a core's cache."""
    begins, which, column, value = entries
    for lo in range(0, len(begins), 512):
        a, b = begins[lo], begins[lo + 512] if lo + 512 < len(begins) else len(column)
        c, v = column[a:b], value[a:b, None].astype(np.float32)
        x = basis[c]
        x *= v
        y = _sums(x, begins[lo : lo + 512] - a)
        order = np.argsort(c, kind="stable")
        c = c[order]
        first = np.flatnonzero(np.concatenate([[True], c[1:] != c[:-1]]))
        x = y[which[a:b][order] - lo]
        x *= v[order]
        out[c[first]] += _sums(x, first)


def _product(places: DataFrame, basis: np.ndarray, idf: np.ndarray, column: np.ndarray) -> np.ndarray:
    """A^T (A basis) over all passages: a sum for each task and word, added up by word."""
    held = places.sparkSession.sparkContext.broadcast((basis.astype(np.float32), idf, column))
    width = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, idf, column = held.value
        out = np.zeros(basis.shape, np.float32)
        for batch in batches:
            _gram(_weighted(*_passages(batch, len(column), ("i_place", "i_word")), idf, column), basis, out)
        some = np.flatnonzero(np.abs(out).sum(1))
        for part in (some[i : i + 1024] for i in range(0, len(some), 1024)):
            yield pa.RecordBatch.from_arrays([pa.array(part), _binary(out[part], np.arange(len(part) + 1) * width)], ["c", "x"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            rows = np.frombuffer(buffers(batch.column("x"))[0], np.float32).reshape(-1, width)
            for c, x in zip(batch.column("c").to_pylist(), rows):
                if c in total:
                    total[c] += x
                else:
                    total[c] = x.astype(np.float64)
        words = np.fromiter(total, np.int64, len(total))
        for part in (words[i : i + 1024] for i in range(0, len(words), 1024)):
            yield pa.RecordBatch.from_arrays([pa.array(part), _binary(np.stack([total[c] for c in part.tolist()]), np.arange(len(part) + 1) * width)], ["c", "x"])

    sums = places.select("i_place", "i_word").where("octet_length(i_place) > 0").mapInArrow(run, "c long, x binary")
    rows = sums.repartition("c").mapInArrow(add, "c long, x binary").toArrow()
    out = np.zeros(basis.shape)
    if rows.num_rows:
        out[rows.column("c").to_numpy()] = np.frombuffer(b"".join(rows.column("x").to_pylist()), np.float64).reshape(-1, width)
    return out


def _items_matrix(items: list[np.ndarray], idf: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Unit TF-IDF rows of the items."""
    out = np.zeros((len(items), int(column.max(initial=-1)) + 1))
    for i, item in enumerate(items):
        word, count = np.unique(item, return_counts=True)
        good = column[word] >= 0
        out[i, column[word[good]]] = (1 + np.log(count[good])) * idf[word[good]]
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def informative(items: list[np.ndarray], df: np.ndarray, passages: int) -> tuple[np.ndarray, np.ndarray]:
    """Inverse document frequency of each word, and its column in the matrix of a block of items (-1: none)."""
    idf = np.log((passages + len(items) + 1) / (df + 1.0)) + 1e-3
    column = np.full(len(df), -1, np.int64)
    for item in items:
        word = np.unique(item)
        rare = word[np.argsort(df[word], kind="stable")]
        column[rare[:LEAST]] = 0
        column[rare[df[rare] <= COMMON * passages]] = 0
    column[column == 0] = np.arange(int((column == 0).sum()))
    return idf, column


def _chosen(model, least: int, length: int):
    """_id, n and the informative hits (i_place, i_word) of each text; all its hits too if a window can hold an item or a run is there."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column, runs = model.value
        row, place, word = _flat(batch)
        good = np.flatnonzero(column[word] >= 0)
        at = row[good].astype(np.int64) << 32 | place[good]
        near = np.flatnonzero(np.searchsorted(at, at + max(WINDOWS)) - np.arange(len(at)) >= least)
        full = np.zeros(batch.num_rows, bool)
        full[row[good[near]]] = True
        full[row[_run_starts(row, place, word, runs, length)[0]]] = True
        cut = np.searchsorted(row[good], np.arange(batch.num_rows + 1))
        keep = pa.array(full)
        some = lambda c: pc.if_else(keep, batch.column(c), pa.scalar(b"", pa.binary()))
        return pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("n"), _binary(place[good], cut), _binary(word[good], cut), some("place"), some("word")], ["_id", "n", "i_place", "i_word", "place", "word"])

    return run


def latent_space(hits: DataFrame, items: list[np.ndarray], idf: np.ndarray, column: np.ndarray) -> np.ndarray:
    """RANK singular vectors by column, scaled by idf: what a word adds to a latent vector."""
    size = int(column.max(initial=-1)) + 1
    by_column = np.zeros(size)
    by_column[column[column >= 0]] = idf[column >= 0]
    own = _items_matrix(items, idf, column)
    basis = np.random.default_rng(11).normal(size=(size, min(size, RANK + OVERSAMPLE)))
    for _ in range(2):
        basis = np.linalg.qr(_product(hits, basis, idf, column) + own.T @ (own @ basis))[0]
    image = _product(hits, basis, idf, column) + own.T @ (own @ basis)
    energy, vectors = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
    top = np.argsort(energy)[::-1][:RANK]
    return basis @ vectors[:, top[energy[top] > 1e-9]] * by_column[:, None]


def _spans(at: np.ndarray, place: np.ndarray, word: np.ndarray, row: np.ndarray, lo: np.ndarray, width: int) -> np.ndarray:
    """Words of `width` places from lo of each row, -1 where none is known. at: row and place of every hit, in order."""
    texts = np.full((len(row), width), -1, np.int32)
    a, b = np.searchsorted(at, row << 32 | lo), np.searchsorted(at, (row << 32 | lo) + width)
    which = np.repeat(np.arange(len(row)), b - a)
    hit = np.arange(len(which)) + np.repeat(a - np.cumsum(b - a) + b - a, b - a)
    texts[which, place[hit] - lo[which]] = word[hit]
    return texts


def _search(model, verdict: Verdict, least: int):
    """_id, item, cosine, lcs, answer, run, start, end (words) of each item found in a text, at the best window that passes."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        items, numbers, column, loading, query, runs = model.value
        row, place, word = _flat(batch)
        i_row, i_place, i_word = _flat(batch, ("i_place", "i_word"))
        at = i_row.astype(np.int64) << 32 | i_place
        found = [np.zeros((0, 4))]
        wide = np.searchsorted(at, at + max(WINDOWS))
        starts = np.flatnonzero(wide - np.arange(len(at)) >= least)
        narrow = [(w, np.searchsorted(at, at + w)) for w in WINDOWS if w < max(WINDOWS)]
        for s in (starts[lo : lo + 2048] for lo in range(0, len(starts), 2048)):
            low, high = int(s[0]), int(wide[s[-1]])
            total = np.zeros((high - low + 1, loading.shape[1]), np.float32)
            for before, vector, after in zip(total, loading[column[i_word[low:high]]], total[1:]):
                np.add(before, vector, out=after)
            # a narrow window with the same hits as the wide one is the same vector
            for ends, mine in [(wide, s), *((e, s[(e[s] - s >= least) & (e[s] < wide[s])]) for _, e in narrow)]:
                x = total[ends[mine] - low] - total[mine - low]
                cosine = (x @ query) / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                i, j = np.divmod(np.flatnonzero(cosine >= COSINE), len(items))
                found.append(np.stack([i_row[mine[i]], j, cosine[i, j], i_place[mine[i]]], 1))
        hit, j = _run_starts(row, place, word, runs, verdict.run)
        key = row[hit].astype(np.int64) << 32 | place[hit]
        cosine = np.zeros(len(hit))
        for k, (a, b) in enumerate(zip(np.searchsorted(at, key), np.searchsorted(at, key + max(WINDOWS)))):
            x = loading[column[i_word[a:b]]].sum(0)
            cosine[k] = x @ query[:, j[k]] / max(np.linalg.norm(x), 1e-12)
        found.append(np.stack([row[hit], j, cosine, place[hit]], 1))
        every = np.concatenate(found)
        every = every[np.lexsort((every[:, 3], -every[:, 2], every[:, 0], every[:, 1]))]
        all_at, n = row.astype(np.int64) << 32 | place, batch.column("n").to_numpy()
        out = [[()] * 8]
        for part in np.split(every, np.flatnonzero(np.diff(every[:, 1])) + 1) if len(every) else []:
            item = items[int(part[0, 1])]
            r, lo = part[:, 0].astype(np.int64), np.maximum(part[:, 3].astype(np.int64) - len(item), 0)
            width = max(WINDOWS) + 2 * len(item)
            look = lambda r, lo, width: judge(item, _spans(all_at, place, word, r, lo, width), verdict)
            _, one = np.unique(r << 32 | lo, return_index=True)
            one.sort()
            cells, cell = np.unique(r[one] << 32 | lo[one] // max(WINDOWS), return_inverse=True)
            may = np.zeros(len(cells), bool)  # a window passes only if the stretch around it does
            for x in range(0, len(cells), LOT):
                c = cells[x : x + LOT]
                may[x : x + LOT] = look(c >> 32, (c & 0xFFFFFFFF) * max(WINDOWS), width + max(WINDOWS))[0]
            left, size = one[may[cell]], 1
            while len(left):  # of each text the windows of largest cosine first, until one passes
                begins = np.flatnonzero(np.concatenate([[True], r[left][1:] != r[left][:-1]]))
                rank = np.arange(len(left)) - np.repeat(begins, np.diff(np.append(begins, len(left))))
                now, done = left[rank < size], []
                for lot in (now[x : x + LOT] for x in range(0, len(now), LOT)):
                    good, *shares = look(r[lot], lo[lot], width)
                    done.append(np.stack([lot[good], *(c[good] for c in shares)], 1))
                done = np.concatenate(done)
                done = done[np.unique(r[done[:, 0].astype(np.int64)], return_index=True)[1]]
                w = done[:, 0].astype(np.int64)
                out.append([r[w], part[w, 1], part[w, 2], *done[:, 1:].T, lo[w], np.minimum(lo[w] + width, n[r[w]])])
                left = left[(rank >= size) & ~np.isin(r[left], r[w])]
                size *= 4
        r, j, *rest = (np.concatenate(c) for c in zip(*out))
        kinds = (pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64(), pa.int64())
        cols = [batch.column("_id").take(pa.array(r.astype(np.int64))), pa.array([numbers[int(x)] for x in j], pa.int64()), *(pa.array(c, pa.float64()).cast(k) for c, k in zip(rest, kinds))]
        return pa.RecordBatch.from_arrays(cols, ["_id", "item", "cosine", "lcs", "answer", "run", "start", "end"])

    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", verdict: Verdict | None = None) -> DataFrame:
    """Rows (id, item_id, cosine, lcs, answer, run, start, end): an item found in a text, once at the best window (words) that passes.

    Whole texts are searched, with all items, in blocks of ITEMS. Null, empty and wordless texts or items match nothing;
    an item of one or two words needs as many hits as it has words to be looked at, and is found where they stand;
    repeated rows match each; copies of an item match under each id, a null item id too. Empty tables give no rows. Only
    id and text are read of either table, so other columns may have any name. The benchmark is read in slices of
    SCAN_ITEMS, so that what is broadcast is bounded by an item's length.
    """
    verdict, spark = verdict or Verdict(), docs.sparkSession
    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = source.schema["_id"].dataType.simpleString()
    items = benchmark.select(F.col(item_id).cast("long").alias("item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text"))
    slices = max(1, -(-items.count() // SCAN_ITEMS))
    schema = f"_id {kind}, item long, cosine double, lcs double, answer double, run long, start long, end long"
    found = spark.createDataFrame([], schema)
    for part in range(slices):
        rows = sorted(items.where(F.pmod(F.xxhash64("item", "text"), F.lit(slices)) == part).collect(), key=lambda r: (r.item is None, r.item, r.text))
        doc, h = split_words(pa.array([r.text for r in rows], pa.string()))
        keys, word = np.unique(h, return_inverse=True)
        numbered = [(r.item, w) for r, w in zip(rows, np.split(word, np.searchsorted(doc, np.arange(1, len(rows))))) if len(w)] if rows else []
        if not numbered:
            continue
        places = stored(arrow_map(source, _places(spark.sparkContext.broadcast(keys)), f"_id {kind}, n long, place binary, word binary"), "places")
        df, passages = _frequencies(places, len(keys))
        for lo in range(0, len(numbered), ITEMS):
            block = [w for _, w in numbered[lo : lo + ITEMS]]
            idf, column = informative(block, df, passages)
            least = max(1, min(3, *(int(np.ceil(verdict.lcs * len(w))) for w in block)))
            runs = item_runs(block, verdict.run)
            hits = stored(arrow_map(places, _chosen(spark.sparkContext.broadcast((column, runs)), least, verdict.run), f"_id {kind}, n long, i_place binary, i_word binary, place binary, word binary"), "hits")
            loading = latent_space(hits, block, idf, column).astype(np.float32)
            query = np.stack([loading[column[w[column[w] >= 0]]].sum(0) for w in block])
            query /= np.maximum(np.linalg.norm(query, axis=1, keepdims=True), 1e-12)
            model = spark.sparkContext.broadcast(([w.astype(np.int32) for w in block], [i for i, _ in numbered[lo : lo + ITEMS]], column, loading, query.T, runs))
            found = found.unionByName(arrow_map(hits.where("octet_length(place) > 0"), _search(model, verdict, least), schema))
    return found.select(F.col("_id").alias(id_col), F.col("item").alias("item_id"), "cosine", "lcs", "answer", "run", "start", "end")
