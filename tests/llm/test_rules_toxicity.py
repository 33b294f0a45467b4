import math
import re
import zlib
from collections import Counter
from math import comb

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from siltstone.llm import rules, toxicity
from siltstone.llm.shared import fit_logistic
from siltstone.tables import table

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    runs = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    inside = {i + j for i in range(len(w) - 7) if runs[tuple(w[i : i + 8])] > 1 for j in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)]


FIVE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab é\n\t#|\x1c日"), max_size=80) | st.lists(st.sampled_from(["a", "b"]), max_size=40).map(" ".join), max_size=5))
def test_measures_equal_brute_force(texts):
    got = rules.measure(pa.array(texts, pa.string()))
    assert [[int(got[c][i]) for c in FIVE] for i in range(len(texts))] == [brute(t) for t in texts]


def test_exact_binomial():
    for n, p in ((30, 0.1), (200, 0.03), (7, 0.5)):
        for k in range(0, n, 3):
            assert abs(rules.binomial_at_most(k, n, p) - sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))) < 1e-9
    assert 0 < rules.binomial_at_most(990_000, 10**8, 0.01) < 1e-12


def test_steps_are_safe_in_order():
    assert rules.choose_step(np.array([0, 0, 2, 18, 280, 600]), 1000, 0.05, 0.01) == 4
    assert rules.choose_step(np.array([0]), 10, 0.05, 0.01) == 0 and rules.choose_step(np.array([0]), 0, 0.05, 0.01) == 0
    n = rules.least_holdout(0.05, 0.0125)
    assert rules.binomial_at_most(0, n, 0.05) <= 0.0125 < rules.binomial_at_most(0, n - 1, 0.05)


def test_path_turns_bad_documents_away_first():
    rng = np.random.default_rng(3)
    good = rng.random(4000) < 0.85
    bins = rng.integers(0, 60, (4000, 3))
    bins[~good, 1] += 200
    bins[~good & (rng.random(4000) < 0.3), 1] = 30
    path = rules.fit_path(bins, good)
    index = path[np.arange(3), bins].min(1)
    early = index < rules.LATE
    assert early[~good].mean() > 0.65 and early[good].mean() < 0.02
    for row in path:  # a higher score is never turned away later
        assert (np.diff(row) <= 0).all()
    assert len(np.unique(path[path < rules.LATE])) == (path < rules.LATE).sum()
    assert (rules.fit_path(bins, np.ones(4000, bool)) == rules.LATE).all() and (rules.fit_path(bins[:0], good[:0]) == rules.LATE).all()


def exact_at_most(k, n, p):
    return sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_rules_over_the_whole_table(spark):
    """Production parameters on the largest table: counts by brute force, cutoffs by trying every cutoff of each path."""
    sf = "/root/testdata/sf0.1"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    rows = {r.doc_id: r for r in rules.quality_rules(docs, labels).collect()}
    texts = {r.doc_id: (r.text, r.lang) for r in docs.collect()}
    assert set(rows) == set(texts)
    for i, r in rows.items():
        if i % 10 == 0:
            assert [r[c] for c in FIVE] == brute(texts[i][0])
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert r.kept == (not r.base_failed and not r.broken)
    quality = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    scores = lambda r: [
        min(1, r.n_symbols / max(r.n_words, 1)), r.n_dup_lines / max(r.n_lines, 1), r.n_repeat_words / max(r.n_words, 1), min(1, r.n_upper / max(r.word_chars, 1)),
        min(1, r.word_chars / max(r.n_words, 1) / 32), 1 - r.n_distinct / max(r.n_words, 1), min(1, r.n_stops / max(r.n_words, 1) / 2),
    ]
    grid = {i: [int(-(-x * rules.BINS // 1)) for x in scores(r)] for i, r in rows.items() if not r.base_failed}
    design = {i for i in grid if i in quality and zlib.crc32(str(i).encode()) % 4 == 0}
    of = lambda ids: (np.array([grid[i] for i in ids]), np.array([quality[i] == 1 for i in ids]))
    strata = sorted({lang for _, lang in texts.values()})
    holdout = {s: [i for i in grid if quality.get(i) == 1 and i not in design and texts[i][1] == s] for s in strata}
    level = 0.05 / sum(0.95 ** len(h) <= 0.05 for h in holdout.values())
    for s in strata:
        mine = [i for i in design if texts[i][1] == s]
        path = rules.fit_path(*of(mine if len(mine) >= 100 else list(design)))
        step = {i: min(path[k][b] for k, b in enumerate(grid[i])) for i in grid if texts[i][1] == s}
        safe = 0
        for t in range(int(path[path < rules.LATE].max()) + 1):
            if exact_at_most(sum(step[i] <= t for i in holdout[s]), len(holdout[s]), 0.05) > level:
                break
            safe = t + 1
        assert {i for i, x in step.items() if x < safe} == {i for i in step if rows[i].broken}, s
        turned = [bool(rows[i].broken) for i in holdout[s]]
        assert np.mean(turned) <= 0.05 and any(rows[i].broken for i in step)
        assert np.mean([bool(rows[i].broken) for i in step if quality.get(i) == 0]) > 0.8


def test_rules_odd_rows(spark):
    rows = [(1, None, None, 1), (2, "", "en", 1), (None, "word " * 30, "en", 1), (3, " ".join(f"w{i}" for i in range(50)), "xx", 1), (3, " ".join(f"w{i}" for i in range(50)), "xx", 1), (4, "long " * 300_000, "en", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, kept int")
    labels = spark.createDataFrame([(3, 1, None), (None, 1, 0), (4, None, 1)], "doc_id long, quality int, toxic int")
    got = rules.quality_rules(docs, labels).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.kept) for r in got) == [(0, 30, False), (1, 0, False), (2, 0, False), (3, 50, True), (3, 50, True), (4, 300_000, False)]
    assert rules.quality_rules(docs.limit(0), labels).count() == 0
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0
    assert all(0 <= r.score <= 1 for r in toxicity.score_toxicity(docs, labels).collect())


def test_toxicity_held_out(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    got = toxicity.score_toxicity(docs, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert len(got) > 500
    hit = got.predicted == got.toxic
    assert hit.mean() > 0.96 and got[got.predicted == 1].toxic.mean() > 0.95 and got[got.toxic == 1].predicted.mean() > 0.75


def toxicity_by_hand(rows, labels, features=1024):
    """Scores by counters over n-grams as strings; a bucket is the hash of one of them."""
    known = {}
    for i, y in labels:
        if i is not None and y is not None and zlib.crc32(str(i).encode()) % 5:
            known[i] = max(known.get(i, 0), y)
    bucket_of = {}

    def buckets(text):
        text = re.sub("[\t-\r]", " ", (text or "").lower())
        found = set()
        for n in toxicity.ORDERS:
            for gram in {text[k : k + n] for k in range(len(text) - n + 1)}:
                if gram not in bucket_of:
                    bucket_of[gram] = int(toxicity._grams(toxicity._codes(gram.encode()), n)[0])
                found.add(bucket_of[gram])
        return found

    has = [buckets(t) for _, t in rows]
    train = [(k, known[i]) for k, (i, _) in enumerate(rows) if i in known]
    counts = [Counter(b for k, y in train if y == c for b in has[k]) for c in (0, 1)]
    q, p = (sum(y == c for _, y in train) for c in (0, 1))
    every = []
    for b in counts[0] | counts[1]:
        a, z = counts[1][b], counts[0][b]
        if a + z >= 3:
            r = math.log((a + 0.5) / (p + 1)) - math.log((z + 0.5) / (q + 1))
            every.append((-abs(r) / math.sqrt(1 / (a + 0.5) + 1 / (z + 0.5)), b, r))
    every.sort()
    chosen = [(b, r) for _, b, r in every[:features]]
    data = sorted(((y, [b in has[k] for b, _ in chosen]) for k, y in train), key=lambda x: (x[0], np.packbits(x[1]).tobytes()))
    x = np.array([f for _, f in data], np.float32) * np.array([r for _, r in chosen], np.float32)
    w, b0 = fit_logistic(x, np.array([y for y, _ in data], float), l2=3.0)
    gain = {b: wi * r for (b, r), wi in zip(chosen, w)}
    return [1 / (1 + math.exp(-min(max(b0 + sum(gain[b] for b in found if b in gain), -40), 40))) for found in has]


def test_toxicity_equals_brute_force(spark):
    docs, labels = table(spark, SF, "documents").repartition(3), table(spark, SF, "labels")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = dict(zip((i for i, _ in rows), toxicity_by_hand(rows, [(r.doc_id, r.toxic) for r in labels.collect()])))
    got = {r.doc_id: (r.score, r.predicted, r.held_out) for r in toxicity.score_toxicity(docs, labels).collect()}
    assert got.keys() == want.keys() and max(abs(got[i][0] - want[i]) for i in want) < 1e-4
    assert all(p == (s >= 0.5) and h == (zlib.crc32(str(i).encode()) % 5 == 0) for i, (s, p, h) in got.items())


def test_grams_in_slices(monkeypatch):
    texts = ["abc déf " * 20, "", "x" * 9, None, "Größe idiot"]
    whole = [(f + d).tolist() and list(zip((f + d).tolist(), v.tolist())) for f, d, v in toxicity.hits(pa.array(texts))]
    monkeypatch.setattr(toxicity, "SLICE", 40)
    cut = [(f + d).tolist() and list(zip((f + d).tolist(), v.tolist())) for f, d, v in toxicity.hits(pa.array(texts))]
    assert sorted(x for g in whole for x in g) == sorted(x for g in cut for x in g)
