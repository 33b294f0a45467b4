import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import jaccard
from siltstone.llm.components import components
from siltstone.tables import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k=5):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < k else {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()


def brute(rows, t=75):
    sets = [shingles(x) for _, x in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= t * max(len(a), len(b)):
                c = len(a & b)
                if 100 * c >= t * (len(a) + len(b) - c):
                    up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[root(i)] = min(least.get(root(i), d), d)
    return sorted(((d, len(s), least.get(root(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=repr)


def corpus(seed, n):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    common = " ".join(r.choice(vocabulary) for _ in range(60))
    texts = []
    for _ in range(n):
        kind = r.random()
        if kind < 0.45 and texts:
            w = (r.choice(texts) or "").split(" ")
            for _ in range(r.randrange(0, 2 + len(w) // 40)):
                w[r.randrange(len(w))] = r.choice(vocabulary)
            texts.append(" ".join(w[: len(w) - r.randrange(0, 1 + len(w) // 6)]))
        elif kind < 0.55:
            texts.append(r.choice(["", None, "A b", "a B", "one two three four five", " \t", common.upper()]))
        else:
            own = " ".join(r.choice(vocabulary) for _ in range(r.choice([8, 30, 90, 300])))
            texts.append(f"{own} {common}" if r.random() < 0.4 else own)
    return texts


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed,tile,small,frequent", [(1, 20_000, 24, 1 << 19), (2, 7, 3, 40)])
def test_equals_all_pairs(spark, monkeypatch, seed, tile, small, frequent):
    for name, value in (("TILE", tile), ("SMALL", small), ("FREQUENT", frequent)):
        monkeypatch.setattr(jaccard, name, value)
    rows = [(i, t) for i, t in enumerate(corpus(seed, 400))] + [(None, "a b"), (None, "lone row here"), (5, "x " * 50), (5, "y z " * 30)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, component_id int").repartition(3)
    assert rows_of(jaccard.near_duplicates(docs)) == brute(rows)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    assert rows_of(jaccard.near_duplicates(docs)) == brute([tuple(r) for r in docs.collect()])


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.near_duplicates(docs).count() == 0
    assert rows_of(jaccard.near_duplicates(spark.createDataFrame([(3, None)], "doc_id long, text string"))) == [(3, 0, 3)]


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10_000))
def test_tree_finds_all_bounded_pairs(seed):
    r = np.random.default_rng(seed)
    base = r.integers(0, 12, (20, jaccard.GROUPS))
    points = np.concatenate([np.maximum(base + r.integers(-1, 2, base.shape) * (r.random(base.shape) < 0.2), 0) for _ in range(8)])
    sizes, comp = points.sum(1), r.integers(0, 30, len(points))
    got = {tuple(sorted(p)) for a, b in jaccard.CountTree(points, sizes, comp).pairs(75) for p in zip(a.tolist(), b.tolist())}
    want = {(i, j) for i in range(len(points)) for j in range(i + 1, len(points)) if comp[i] != comp[j] and np.minimum(points[i], points[j]).sum() >= jaccard.need(sizes[i], sizes[j], 75)}
    assert want <= got and all(comp[i] != comp[j] for i, j in got)


def test_points_too_large_for_their_bits():
    wide = jaccard._narrow(np.array([70_000] + [3] * (jaccard.GROUPS - 1)))
    assert wide.min() == 65535 and wide.astype(np.int64).sum() >= jaccard.reachable(30_000_000, 30_000_000, 75)
    assert jaccard._narrow(np.arange(jaccard.GROUPS)).tolist() == list(range(jaccard.GROUPS))


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(50)] + [(100, x) for x in range(101, 140)] + [(r.randrange(200, 260), r.randrange(200, 260)) for _ in range(40)] + [(None, 3), (300, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    up = {x: x for e in edges if None not in e for x in e}
    for _ in range(300):
        for a, b in edges:
            if a is not None:
                up[a] = up[b] = min(up[a], up[b])
    assert got == up
    assert len(list(jaccard.shingle_sets(pa.array([None, "", "a"])))) == 3
