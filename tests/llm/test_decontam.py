import random
import re
import time

import numpy as np

from siltstone.llm import decontam
from siltstone.tables import table

SF = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\x00-\x20!-/:-@\[-`{-~]+", (text or "").lower())


def brute(texts, items, verdict=decontam.Verdict()):
    """Every window of every text against every item, by plain comparisons."""
    number = {}
    code = lambda w: np.array([number.setdefault(x, len(number)) for x in w], np.int64)
    coded = {i: code(words(t)) for i, t in items}
    out = set()
    for d, t in texts:
        w = code(words(t))
        have = set(w.tolist())
        for i, item in coded.items():
            if len(item) and sum(x in have for x in item.tolist()) >= min(verdict.run, verdict.lcs * len(item)):
                for s in range(0, max(1, len(w)), len(item)):
                    if decontam.judge(item, w[None, max(0, s - len(item)) : s + 2 * len(item)], verdict)[0][0]:
                        out.add((d, i))
    return out


def test_lcs_and_run():
    r = random.Random(2)
    for _ in range(50):
        a, b = ([r.randrange(4) for _ in range(r.randrange(1, 9))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        run = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
                run[i + 1][j + 1] = run[i][j] + 1 if x == y else 0
        assert decontam.lcs(np.array(a), np.array([b]))[0] == t[-1][-1]
        assert decontam.longest_run(np.array(a), np.array([b]))[0] == max(map(max, run))


def test_whole_table_and_paraphrases(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(r.item_id, r.text) for r in bench.collect()]
    r = random.Random(1)
    planted = []
    for k, (i, t) in enumerate(items):
        w = t.upper().split()
        w = [x for x in w if r.random() > 0.15]
        w.insert(len(w) // 2, "however")
        before = r.choice(texts)[1]
        planted.append((10_000 + k, f"{before}\n{' -- '.join(w)}; {r.choice(texts)[1]}"))
    texts += planted
    got = decontam.find_contamination(spark.createDataFrame(texts, "doc_id long, text string"), bench)
    pairs = {(x.doc_id, x.item_id) for x in got.collect()}
    want = brute(texts, items)
    assert len(pairs - want) == 0 and len(want - pairs) <= 0.02 * len(want)
    assert {(10_000 + k, i) for k, (i, _) in enumerate(items)} <= pairs


def test_odd_rows(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    docs = spark.createDataFrame([(1, None, 0), (2, "", 0), (3, item, 0), (3, item, 0), (None, f"x {item} y " * 2000, 0), (4, "?!", 0)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(7, item, 1), (7, item, 1), (8, "", 1), (None, item.upper(), 1), (9, None, 1)], "item_id long, text string, cosine int")
    got = sorted(((r.doc_id or 0, r.item_id or 0) for r in decontam.find_contamination(docs, bench).collect()))
    assert got == sorted([(d, i) for d in (0, 3, 3) for i in (0, 7, 7)])
    assert decontam.find_contamination(docs.limit(0), bench).count() == 0
    assert decontam.find_contamination(docs, bench.limit(0)).count() == 0


def test_every_run_of_13_to_20_words(spark):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    filler = [r.text for r in table(spark, SF, "documents").limit(300).collect()]
    r, planted, want = random.Random(5), [], set()
    for i, t in items:
        w = words(t)
        for n in (13, 16, 20):
            for s in range(0, len(w) - n + 1, 3):
                planted.append((len(planted), f"{r.choice(filler)}\n{' '.join(w[s : s + n])}\n{r.choice(filler)}"))
                want.add((len(planted) - 1, i))
    got = decontam.find_contamination(spark.createDataFrame(planted, "doc_id long, text string"), table(spark, SF, "benchmark"))
    assert len(want) > 900 and not want - {(x.doc_id, x.item_id) for x in got.collect()}


def test_decoys_do_not_hide_a_copy(spark):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").limit(20).collect()]
    between = " ".join(f"filler{k}" for k in range(300))
    docs, want = [], set()
    for i, t in items:
        w = words(t)
        question, copy = w[: len(w) - len(w) // 4 - 1], w[: len(w) // 2] + "aside of some words here".split() + w[len(w) // 2 :]
        for decoy in (question[:12], sorted(set(w), reverse=True)):
            docs.append((len(docs), " ".join(decoy * 2) + f" {between} " + " ".join(copy) + f" {between} " + " ".join(decoy)))
            want.add((len(docs) - 1, i))
    got = decontam.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), table(spark, SF, "benchmark"))
    assert not want - {(x.doc_id, x.item_id) for x in got.collect()}


def test_short_items(spark):
    docs = spark.createDataFrame([(1, "we saw a zebra quagga there"), (2, "an okapi"), (3, "nothing here"), (4, None), (5, "quagga first then zebra " * 3)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "Zebra, quagga!"), (2, "okapi"), (3, ""), (4, None)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_contamination(docs, bench).collect()}
    assert got == {(1, 1), (2, 2), (5, 1)}


def least_cpu(run):
    """CPU seconds of the best of some runs."""
    times = []
    for _ in range(7):
        begin = time.process_time()
        run()
        times.append(time.process_time() - begin)
    return min(times)


def test_words_of_a_lot_are_looked_up_not_searched():
    r = np.random.default_rng(4)
    item, texts = r.integers(0, 4000, 38).astype(np.int32), r.integers(-1, 4000, (decontam.LOT, 230)).astype(np.int32)
    table = np.zeros(4001, np.int64)
    assert least_cpu(lambda: decontam.shared_words(item, texts)) < 12 * least_cpu(lambda: table[texts])


def test_long_items_and_unknown_words():
    r = np.random.default_rng(6)
    for n in (1, 64, 65, 254, 255, 256, 300):
        item = r.permutation(n).astype(np.int32)
        texts = np.full((4, n + 9), -1, np.int32)
        texts[0, 5 : n + 5], texts[1, :n], texts[2, 9:] = item, item[::-1], n + 7
        assert decontam.lcs(item, texts).tolist() == [n, decontam.lcs(item, item[None, ::-1])[0], 0, 0]
        assert decontam.longest_run(item, texts).tolist() == [n, 1, 0, 0]
        assert decontam.shared_words(item, texts).tolist() == [n, n, 0, 0]
        assert decontam.judge(item, texts, decontam.Verdict())[0].tolist() == [True, n == 1, False, False]
    twice = np.array([3, 3, 5], np.int32)
    assert decontam.shared_words(twice, np.array([[3, 5, 5, 9], [3, 3, 3, -1]], np.int32)).tolist() == [2, 2]


def test_gram_of_passages():
    r = np.random.default_rng(7)
    rows = np.where(r.random((1500, 40)) < 0.08, r.random((1500, 40)), 0)
    rows[:, 3], rows[700:, 5] = 0.5, 0  # a word of every passage, and one of single entries
    rows[1200:] = 0
    rows[np.arange(1200, 1500), r.integers(0, 40, 300)] = 1
    which, column = np.nonzero(rows)
    basis, out = r.normal(size=(40, 9)).astype(np.float32), np.ones((40, 9), np.float32)
    decontam._gram((np.searchsorted(which, np.arange(1500)), which, column, rows[which, column]), basis, out)
    assert np.allclose(out, 1 + rows.T @ (rows @ basis), rtol=1e-4, atol=1e-3)
