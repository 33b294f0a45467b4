import math
import re
import zlib
from collections import Counter

import pytest

from siltstone.llm import lm
from siltstone.tables import table


def toks(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute(rows):
    """Scores by an explicit automaton: dicts of arcs, failure weights and one pass over each text."""
    held = [zlib.crc32(str(i).encode() if i is not None else b"") % 10 == 0 for i, _ in rows]
    one, two = Counter(), Counter()
    for (_, t), h in zip(rows, held):
        if not h:
            s = toks(t)
            one.update(s)
            two.update(zip([None, *s[:-1]], s))
    n, v = sum(one.values()), len(one)
    p = lambda w: (one[w] + 0.1) / (n + 0.1 * (v + 1))
    loo = Counter()
    for (_, t), h in zip(rows, held):
        state = None
        for w in toks(t) if not h else ():
            root = (one[w] - 1 + 0.1) / (n - 1 + 0.1 * (v + 1))
            for k in lm.STRENGTHS:
                loo[k] += math.log10((two[state, w] - 1 + k * root) / (one[state] - 1 + k))
            state = w
    k = max(lm.STRENGTHS, key=lambda k: (loo[k], k))
    out = []
    for (i, t), h in zip(rows, held):
        s, state, score = toks(t), None, 0.0
        for w in s:
            if two[state, w]:
                score += math.log10((two[state, w] + k * p(w)) / (one[state] + k))
            else:
                score += math.log10(k / (one[state] + k)) + math.log10(p(w))
            state = w
        out.append((i, h, len(s), sum(one[w] > 0 for w in s), n, sum(math.log10(p(w)) for w in s), score))
    return out


def same(got, want):
    got = sorted(got, key=lambda r: (r[0] is None, r[0], r[2]))
    want = sorted(want, key=lambda r: (r[0] is None, r[0], r[2]))
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert tuple(g[:5]) == w[:5] and g[5] == pytest.approx(w[5], abs=1e-6) and g[6] == pytest.approx(w[6], abs=1e-6), (g, w)


@pytest.mark.parametrize("block", [8 << 20, 700])
def test_equals_automaton_by_dicts(spark, monkeypatch, block):
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    rows = [(i, f"The cat {i % 7} sat on the MAT é{i % 3}\x1cx" if i % 4 else ["", None, "the the the cat", "zz " * 400][i // 4 % 4]) for i in range(120)] + [(None, "the cat"), (5, "the cat"), (5, "the cat")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double").repartition(3)
    same(lm.score_texts(docs).collect(), brute(rows))
    assert lm.score_texts(docs.limit(0)).count() == 0


def test_nothing_trains(spark):
    docs = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    (r,) = lm.score_texts(docs).collect()
    assert (r.n_known, r.train_tokens, r.base_score) == (0, 0, 0.0)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    got = lm.score_texts(docs).collect()
    same(got, brute([tuple(r) for r in docs.collect()]))
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
