import hashlib

import public_tokenizers as P

import corpus_pipeline
from siltstone.llm import bpe
from siltstone.tables import table
from tests.llm import test_decontam, test_jaccard, test_secrets

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    steps = [(None, docs)]
    for name, stage in corpus_pipeline.STAGES:
        steps.append((name, stage(spark, steps[-1][1], SF).cache()))
    start, good, single, clean, safe, ids = (d for _, d in steps)
    assert all(d.columns == columns for d in (good, single, clean, safe))
    text = lambda d: {r.doc_id: r.text for r in d.collect()}
    a, b, c, e, f = map(text, (start, good, single, clean, safe))
    assert set(b) < set(a) and len(b) > 0.75 * len(a)
    groups = {i: g for i, _, g in test_jaccard.brute(sorted(b.items()))}
    assert set(c) == {i for i in b if groups[i] == i}
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert set(c) - set(e) == {d for d, _ in test_decontam.brute(sorted(c.items()), items)}
    assert set(f) == set(e)
    for i, t in f.items():
        spans = test_secrets.brute(e[i])[4]
        assert (t != e[i]) == bool(spans)
        assert sum(test_secrets.brute(t)[:3]) == 0
    assert all(r.n_chars == len(f[r.doc_id]) for r in safe.collect() if f[r.doc_id] != e[r.doc_id])
    code = bpe.encoding(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    rows = ids.collect()
    assert len(rows) == len(f)
    for r in rows:
        assert r.ids == code.encode_ordinary(f[r.doc_id]) and r.n_tokens == len(r.ids)
        assert r.decoded_sha256 == hashlib.sha256(f[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark):
    own = " ".join(f"alpha{i} beta{i}" for i in range(40))
    rows = [(1, own, "en", "s", 1), (1, own, "en", "s", 1), (2, own, "en", "s", 1), (None, own, "en", None, None), (3, None, None, None, None), (4, "", "en", "s", 0), (5, "token = abcdefgh12345 " + " ".join(f"word{i}" for i in range(60)), "en", "s", 99)]
    docs = spark.createDataFrame(rows, table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    got = {r.doc_id: r for r in docs.collect()}
    assert docs.count() == 2 and set(got) == {1, 5} and got[5].text.startswith("[secret] word0") and got[5].n_chars == len(got[5].text)
    empty = spark.createDataFrame([], docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_rows_stand_on_their_own(spark):
    schema = table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").schema
    item = table(spark, SF, "benchmark").first().text
    long = lambda w: " ".join(f"{w}{i} {w}x{i}" for i in range(60))
    frame = lambda rows: spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema)
    texts = lambda d: sorted(((r.doc_id or 0), r.text) for r in d.collect())
    a, b, c = long("alpha"), long("beta"), long("gamma")
    assert texts(corpus_pipeline.quality(spark, frame([(None, a), (None, "short"), (7, b), (7, "short")]), SF)) == [(0, a), (7, b)]
    assert texts(corpus_pipeline.decontaminate(spark, frame([(None, a), (None, item), (7, b), (7, item)]), SF)) == [(0, a), (7, b)]
    near = frame([(1, a), (None, a + " more"), (None, b), (None, b + " more"), (7, c), (7, a + " again")])
    got = texts(corpus_pipeline.near_duplicates(spark, near, SF))
    assert [i for i, _ in got] == [0, 1, 7] and got[0][1] in (b, b + " more") and got[1:] == [(1, a), (7, c)]
