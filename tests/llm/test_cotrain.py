import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from siltstone.llm import cotrain
from siltstone.llm.shared import fit_logistic
from siltstone.tables import table


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = cotrain.score_quality(docs, labels)
    assert got.count() == docs.count()
    got = got.join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 500 and (got.kept == (got.quality == 1)).mean() > 0.93
    assert got[got.quality == 1].kept.mean() > 0.97
    assert got.score.between(0, 1).all() and got[got.quality == 0].score.mean() < 0.4 < got[got.quality == 1].score.mean()


def test_odd_rows(spark):
    rows = [(1, None, None, None, None, 1.0), (2, "", "s", "en", 0, 1.0), (None, "x y z", "s", "en", -3, 1.0), (2, "a " * 400_000, "s", "en", 9, 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, score double")
    labels = spark.createDataFrame([(1, None, 0), (None, 1, 1), (2, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    got = cotrain.score_quality(docs, labels).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert cotrain.score_quality(docs.limit(0), labels).count() == 0
    assert all(abs(r.score - 0.5) < 1e-9 for r in cotrain.score_quality(docs, labels.limit(0)).collect())


def test_view_learns():
    counts = np.zeros((2, 1, cotrain.BINS))
    counts[1, 0, 3], counts[0, 0, 4] = 50, 50
    view = cotrain.View(1, 2)
    view.learn(counts, np.array([[0, 25], [40, 25]]))
    raw = lambda b, *bits: view.raw((np.array([[b]], np.uint8), np.array([bits], float)))
    assert raw(3, 0, 0) > 0 > raw(4, 0, 0) and raw(3, 1, 0) > raw(3, 0, 0) and abs(raw(3, 0, 1) - raw(3, 0, 0)) < 1e-9


def by_hand(rows, labels, rounds, confident=0.98, trust=0.5):
    """Co-training with counters over single documents. rows: id, text, source, lang."""
    known = {}
    for i, q in labels:
        if i is not None and q is not None:
            known[i] = min(known.get(i, 1), q)
    fold = [zlib.crc32(str(i).encode()) % 5 for i, *_ in rows]
    label = [known.get(i) if i is not None else None for i, *_ in rows]
    found = [set(next(cotrain.buckets(pa.array([t or ""])))[1].tolist()) for _, t, _, _ in rows]
    df = Counter(b for x in found for b in x)
    chosen = sorted(sorted((b for b in df if df[b] < len(rows)), key=lambda b: (-df[b] * (len(rows) - df[b]), b))[: cotrain.PRESENT])
    bins = cotrain.content_bins(pa.array([t for _, t, _, _ in rows], pa.string()))
    crc = lambda x: zlib.crc32(x.encode()) % 256
    meta = [(crc(s or "\0"), crc(g or "\0"), crc((s or "\0") + "\x01" + (g or "\0"))) for _, _, s, g in rows]
    views = [([tuple(b) for b in bins.tolist()], [[b for b in chosen if b in x] for x in found], chosen), (meta, [[] for _ in rows], [])]

    def learn(view, weights):
        data, bits, every = view
        n = [sum(w for w, y in weights if y == c) for c in (0, 1)]
        at, has = [Counter(), Counter()], [Counter(), Counter()]
        for (w, y), features, words in zip(weights, data, bits):
            if w:
                for f, b in enumerate(features):
                    at[y][f, b] += w
                for b in words:
                    has[y][b] += w
        share = lambda c, f, b: (at[c][f, b] + 0.5) / (n[c] + 128)
        p = lambda c, b: (has[c][b] + 0.5) / (n[c] + 1)
        base = math.log(n[1] + 0.5) - math.log(n[0] + 0.5) + cotrain.TEMPER * sum(math.log(1 - p(1, b)) - math.log(1 - p(0, b)) for b in every)
        gain = {b: cotrain.TEMPER * (math.log(p(1, b) / (1 - p(1, b))) - math.log(p(0, b) / (1 - p(0, b)))) for b in every}
        return [base + sum(math.log(share(1, f, b) / share(0, f, b)) for f, b in enumerate(x)) + sum(gain[b] for b in words) for x, words in zip(data, bits)]

    training = [y if f > 1 else None for y, f in zip(label, fold)]
    prob = None
    for _ in range(rounds + 1):
        raws = []
        for v in (0, 1):
            weights = []
            for k, y in enumerate(training):
                sure = y is None and prob is not None and (prob[1 - v][k] >= confident or prob[1 - v][k] <= 1 - confident)
                weights.append((trust, int(prob[1 - v][k] > 0.5)) if sure else (0, 0) if y is None else (1, y))
            raws.append(learn(views[v], weights))
        step = lambda x, v: min(max(math.floor(x / cotrain.WIDTH[v] + 32), 0), 63)
        grid = Counter((step(raws[0][k], 0), step(raws[1][k], 1), y) for k, y in enumerate(label) if fold[k] == 1 and y is not None)
        cells = sorted(grid)
        x = np.array([[(c[v] + 0.5 - 32) / 10 for v in (0, 1)] for c in cells])
        y, n = np.array([c[2] for c in cells], float), np.array([grid[c] for c in cells], float)
        prob = []
        for v in (0, 1):
            w, b = fit_logistic(x[:, v : v + 1], y, 1.0, 300, n)
            prob.append([1 / (1 + math.exp(-min(max(max(w[0], 0) / 10 / cotrain.WIDTH[v] * r + b, -40), 40))) for r in raws[v]])
        w, b = fit_logistic(x, y, 1.0, 300, n)
    return [1 / (1 + math.exp(-min(max(w[0] / 10 / cotrain.WIDTH[0] * r + w[1] / 10 / cotrain.WIDTH[1] * m + b, -40), 40))) for r, m in zip(*raws)]


@pytest.mark.parametrize("rounds", [0, 2])
def test_equals_co_training_by_hand(spark, rounds):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents").repartition(3), table(spark, sf, "labels")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "source", "lang").collect()]
    want = dict(zip((r[0] for r in rows), by_hand(rows, [(r.doc_id, r.quality) for r in labels.collect()], rounds)))
    got = {r.doc_id: r.score for r in cotrain.score_quality(docs, labels, rounds=rounds).collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in got) < 1e-6


def test_rounds_beat_one_view(spark):
    """Few labels, words of either class that most labelled texts lack, and a source that tells the class: what metadata is
    sure of teaches the content view words that no label shows."""
    r = random.Random(8)
    rows, truth = [], {}
    for i in range(3000):
        good = r.random() < 0.5
        text = " ".join([f"{'g' if good else 'b'}{r.randrange(150)}" for _ in range(2)] + [f"w{r.randrange(40)}" for _ in range(25)])
        rows.append((i, text, f"{'clean' if good else 'junk'}{r.randrange(3)}" if r.random() < 0.99 else "any", "en"))
        truth[i] = int(good)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, truth[i], 0) for i in range(150)], "doc_id long, quality int, toxic int")
    order = {}  # share of pairs of a good and a bad document that the score puts right
    for rounds in (0, 3):
        got = cotrain.score_quality(docs, labels, rounds=rounds, confident=0.9).where("doc_id >= 150").collect()
        for c in ("content_score", "score"):
            good, bad = (np.sort([x[c] for x in got if truth[x.doc_id] == t]) for t in (1, 0))
            order[rounds, c] = (np.searchsorted(bad, good).sum() + np.searchsorted(bad, good, "right").sum()) / 2 / len(good) / len(bad)
    assert order[3, "content_score"] > order[0, "content_score"] + 0.05 and order[3, "score"] > order[0, "score"] - 0.005 and order[3, "score"] > order[3, "content_score"]


def test_views_share_nothing():
    assert not set(cotrain.CONTENT) & set(cotrain.META) and "length" not in cotrain.META
