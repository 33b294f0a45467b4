"""What steps make of shared names, repeated addresses and odd values: as many rows as their results need, and the same results."""

import random

import pytest
from pyspark.sql import functions as F

from siltstone.operators import entities as E

_REGISTRY = "id_per long, first_name string, last_name string, id_org long, name_org string, row_hash string"


def test_shared_names_are_not_met_one_by_one(spark):
    registry = spark.createDataFrame([(i, "Mari", "Tamm", 1000 + i, f"Firma {i} AS", str(i)) for i in range(300)], _REGISTRY)
    mentions = spark.createDataFrame([(p, n) for p in range(40) for n in ("Mari Tamm", f"Firma {p} AS")], "page long, name string")
    parts = E.resolve(mentions, registry, spark.createDataFrame([], "name string, tag1 string, synonym string"))
    assert parts["candidates"].count() == 80  # a row for each name of a page, not for each of its 300 bearers
    assert sorted((r.page, r.id) for r in parts["cross"].collect()) == [(p, p) for p in range(40)]


def test_large_pages_resolve_as_small_ones(spark, monkeypatch):
    dice = random.Random(3)
    registry = spark.createDataFrame([(p, f"A{p % 9}", "B", o, f"Firma {o % 7} AS", f"{p},{o}") for p, o in {(dice.randrange(14), dice.randrange(11)) for _ in range(40)}], _REGISTRY)
    mentions = spark.createDataFrame([(dice.randrange(30), dice.choice([f"A{dice.randrange(9)} B", f"Firma {dice.randrange(7)} AS"])) for _ in range(150)], "page long, name string")
    none = spark.createDataFrame([], "name string, tag1 string, synonym string")
    found = []
    for hub in (1000, 0):
        monkeypatch.setattr(E, "HUB", hub)
        found.append(sorted(map(str, E.outcomes(E.resolve(mentions, registry, none)).collect())))
    assert found[0] == found[1] and any("'cross'" in row for row in found[0])


def test_annotations_leave_in_small_batches(spark, monkeypatch):
    import pyarrow as pa

    from siltstone.functions.annotate import annotate, slices

    parts = [p.to_pylist() for p in slices(pa.array(["abc", None, "de", "f" * 9, "g", ""]), 5)]
    assert parts == [["abc", None, "de"], ["f" * 9], ["g", ""]]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([None, " ", "Here is Mari Tamm", "x " * 50, "a"])], "i int, t string").coalesce(1)
    got = {r.i: r.a for r in rows.select("i", annotate(F.col("t"), size=10).alias("a")).collect()}
    assert [got[i].status for i in range(5)] == ["NO_TEXT", "NO_TEXT", "OK", "OK", "OK"]
    assert got[2].names == ["Mari Tamm"] and got[2].labels == ["PER"] and got[3].tokens == ["x"] * 50 and got[0].tokens is None


def test_linked_names_are_not_held(spark):
    registry = spark.createDataFrame([(1, "Mari", "Tamm", 9, "Firma AS", "a"), (2, "Mari", "Tamm", 8, "Firma AS", "b"), (3, "", "Tamm", 8, "Muu AS", "c")], _REGISTRY)
    names = spark.createDataFrame([(1, "PER", "Mari Tamm"), (1, "PER", "Mari Tamm"), (2, "ORG", "Mari Tamm, Firma AS"), (3, "PER", None), (4, "LOC", "Mari Tamm"), (5, "PER", "Muu AS")], "page long, label string, entity string")
    linked = E.simple_link(names, registry)
    assert sorted((r.page, r.label, r.ident) for r in linked.collect()) == [(1, "PER", 1), (1, "PER", 2), (2, "ORG", 8), (2, "ORG", 9)]
    plan = linked._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() == "Project":
        plan = plan.children().head()
    assert plan.nodeName() == "Join"  # nothing gathers the result's rows


def test_sentences_keep_their_digits(spark):
    from siltstone.operators import text as T

    row = spark.createDataFrame([("0a. 1b1. 22! 3c3",)], "t string").select(T.sentences(F.col("t")).alias("s")).first()
    assert row.s == ["0a", "1b1", "22", "3c3"]


def test_scores_round_as_in_sql(spark):
    import duckdb

    from siltstone.plans import graph

    prices = [258481.5, 32072.5, 130232.5, 261467.5, 259421.5, 257866.5, 60520.5, 4005.004]
    got = spark.createDataFrame([(p,) for p in prices], "p double").select(graph._thousandths(F.col("p") / 1000).alias("s")).collect()
    want = [duckdb.sql(f"select round({p}::double / 1000, 3)").fetchall()[0][0] for p in prices]
    assert [r.s for r in got] == want


def _twice(spark, tmp_path):
    """Pages of which two pairs have one address."""
    page = "<html><head><title>T {0}</title></head><body>a {0} <a href='/b'>x</a></body></html>"
    rows = [(i, f"http://a.example.org/{u}", page.format(i)) for i, u in enumerate(("a", "b", "a", "c", "d", "b", "e"))]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path)


def _sql(name, folder):
    import duckdb

    from siltstone import catalog

    with duckdb.connect() as con:
        con.execute(f"create view pages as select * from '{folder}/pages.parquet/*.parquet'")
        return con.execute(catalog.oracle_sql()[name]).fetchall()


def test_assembly_of_repeated_addresses(spark, tmp_path):
    from siltstone import catalog

    folder = _twice(spark, tmp_path)
    got = catalog.queries()["index_assembly"](spark, folder).collect()
    assert sorted(map(tuple, got)) == sorted(_sql("index_assembly", folder))


def test_fields_of_repeated_addresses(spark, tmp_path):
    from siltstone import catalog

    folder = _twice(spark, tmp_path)
    got = {r.url: tuple(r) for r in catalog.queries()["basic_fields"](spark, folder).collect()}
    want = {r[0]: r for r in _sql("basic_fields", folder)}
    assert got.keys() == want.keys()
    at = "http://a.example.org/"
    # a is the address of 0, which flips, and 2; b that of 1 and 5, of which the SQL's order leaves either: the larger score of its own
    assert got[at + "a"] == want[at + "a"] == (at + "a", at + "a", "t2", "s2", 2.0)
    assert got[at + "b"] == (at + "b", at + "b", "t5", "s1", 5.0) and want[at + "b"][4] == 5.0


def test_order_of_repeated_addresses(spark, tmp_path):
    from siltstone import catalog

    folder = _twice(spark, tmp_path)
    spark.read.parquet(f"{folder}/pages.parquet").orderBy(F.desc("page_id")).coalesce(1).write.parquet(f"{tmp_path}/turned/pages.parquet")
    found = [sorted(map(tuple, catalog.queries()["fetch_order"](spark, f).collect())) for f in (folder, f"{tmp_path}/turned")]
    assert found[0] == found[1]


def test_centuries_by_weekday(spark):
    from siltstone.sources import files

    headers = {"Saturday, 02-Jan-16 03:04:05 GMT": "2016-01-02", "Friday, 07-Mar-17 00:00:00 GMT": "2217-03-07", "Friday, 01-Jan-00 00:00:00 GMT": "2100-01-01", "Sunday, 06-Nov-94 08:49:37 GMT": "1994-11-06", "Tuesday, 29-Feb-00 00:00:00 GMT": "2000-02-29", "Monday, 02-Jan-16 03:04:05 GMT": "2016-01-02"}
    rows = spark.createDataFrame([(h,) for h in headers], "h string").select("h", F.date_format(files.last_modified(F.col("h")), "yyyy-MM-dd").alias("d")).collect()
    assert {r.h: r.d for r in rows} == headers


def test_indexes_by_name(spark):
    from pyspark.sql import functions as F

    rows = [(1, "Mari", "Tamm", 9, "Firma AS", "a" * 32), (1, "Mari", "Tamm", 9, "Firma AS", "a" * 32), (1, "Mari", "Tamm", 8, "'Mari' TAMM", "b" * 32), (2, "OÜ", "Tere", 7, "oü tere", "x"), (2, "OÜ", "Tere", 7, "Tere OÜ", "y"), (3, "", "Tamm", 7, "Tere OÜ", "z")]
    registry = spark.createDataFrame(rows, _REGISTRY)
    assert sorted(map(tuple, E.person_index(registry).collect())) == [("mari tamm", 1, "Mari Tamm", 2), ("oü tere", 2, "OÜ Tere", 2)]
    assert sorted(map(tuple, E.org_index(registry).collect())) == [("as firma", 9, "Firma AS", 1), ("oü tere", 7, "Tere OÜ", 2)]
    names = spark.createDataFrame([(5, "mari tamm"), (6, "mari tamm"), (6, "no one")], "page long, key string")
    known = E.known_relations(names, E.person_relations(registry), F.size("relations"))
    assert sorted(map(tuple, known.collect())) == [(5, "mari tamm", 1, 2), (6, "mari tamm", 1, 2)]
    assert "collect_set" not in known._jdf.queryExecution().optimizedPlan().toString()


def test_names_are_normalised_once_for_each_entity(spark):
    registry = spark.createDataFrame([(1, "Mari", "Tamm", 9, "Firma AS", "a")], _REGISTRY)
    plan = E.person_index(registry)._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Aggregate" and "transform" not in plan.children().head().toString()


def test_languages_by_either_way(spark):
    from siltstone.operators import text as T

    texts = [(1, "en", "The cat and the dog"), (2, "de", "Der Hund und die Katze"), (3, "en", None), (4, "de", "12 34"), (5, "de", "und der"), (1, "en", "the end"), (6, "fr", "\u0130 \u03a3\u039f\u03a3 \u00e9t\u00e9 und")]
    docs = spark.createDataFrame(texts, "doc_id long, lang string, text string")
    profiles = T.language_profiles(docs, top=40)
    quick, joined = (sorted(map(tuple, T.identify(docs, profiles, broadcast_rows=n).collect())) for n in (10_000, 0))
    assert [(i, g, round(s, 8)) for i, g, s in quick] == [(i, g, round(s, 8)) for i, g, s in joined] and {i for i, _, _ in quick} == {1, 2, 5, 6}
    quick = T.identify(docs, profiles)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in quick and "array_sort" not in quick  # n-grams of a text are neither sorted nor exploded


def test_web_graph_by_hand(spark):
    from siltstone.operators import graph as G

    dice = random.Random(5)
    address = lambda: f"http://h{dice.randrange(3)}.d{dice.randrange(3)}.com/{dice.randrange(3)}"
    links = list({(address(), address(), f"a{dice.randrange(3)}", dice.randrange(3)) for _ in range(150)}) + [("http://h0.d0.com/0", "http://h1.d1.com/0", "a", None)]
    frame = spark.createDataFrame(links, "from_url string, to_url string, anchor string, ts long")
    host = lambda u: u.split("/")[2]
    domain = lambda u: host(u).split(".", 1)[1]
    last = {}
    for a, _, _, t in links:
        last[a] = max(last.get(a, -1), -1 if t is None else t)
    for internal in (False, True):
        for by in (False, True):
            want = {}
            for a, b, n, t in sorted((x for x in links if x[3] is not None), key=lambda x: x[1:3]):
                if t == last[a] and a != b and not (internal and host(a) == host(b)):
                    want.setdefault((a, domain(b) if by else b), (a, b, n, t))
            got = G.web_graph(frame, ignore_internal_host=internal, limit_domain=by)
            assert sorted(map(tuple, got.collect())) == sorted(want.values())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Window") :]  # windows see a row of each group, not every link


def test_links_are_gathered_once(spark, monkeypatch):
    from siltstone.operators import graph as G

    once = G.once_for_each_source(spark.createDataFrame([("http://a.b.com/1?x", "t"), ("http://a.b.com/1?a", "t"), ("http://c.b.com/0", "t")], "from_url string, to_url string"))
    assert [tuple(r) for r in once.collect()] == [("http://a.b.com/1?a", "t")]
    assert once._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    kept, written = [], G.written
    monkeypatch.setattr(G, "written", lambda df, what, *by: kept.append(what) or written(df, what, *by))
    ranks = {r.url: r["rank"] for r in G.link_rank(spark.createDataFrame([("a", "b"), ("a", "b"), ("a", "c"), ("b", "c")], "from_url string, to_url string"), 1).collect()}
    assert kept[0] == "links" and ranks == pytest.approx({"a": 0.15 + 0.85 / 3, "b": 0.15 + 0.85 * (1 / 3 + 0.5), "c": 0.15 + 0.85 * (1 / 3 + 1.5)})


def test_bounded_files_are_written_by_all_cores(spark, tmp_path):
    from siltstone.sources import files

    files.write_new(spark.range(1000).coalesce(1), str(tmp_path / "t"), max_records=100)
    held = spark.read.parquet(str(tmp_path / "t"))
    sizes = [r["n"] for r in held.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n")).collect()]
    tasks = {name.name.split("-")[1] for name in (tmp_path / "t").glob("part-*")}
    assert sum(sizes) == 1000 and max(sizes) <= 100 and len(tasks) == 4


def test_fields_are_read_in_one_pass(spark):
    from siltstone.operators import search as S

    docs = spark.createDataFrame([(1, "a b a", None), (1, "a b a", "x"), (2, "", "b")], "doc_id long, t string, u string")
    index = S.postings(docs, {"content": F.col("t"), "title": F.col("u")})
    got = sorted((r.doc_id, r.field, r.term, r.positions, r.length) for r in index.collect())
    assert got == [(1, "content", "a", [0, 2], 3), (1, "content", "b", [1], 3), (1, "title", "x", [0], 1), (2, "title", "b", [0], 1)]
    assert "Union" not in index._jdf.queryExecution().optimizedPlan().toString()
