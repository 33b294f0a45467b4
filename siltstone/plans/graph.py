"""Queries over links and crawl records, and their SQL.

Page links come from the pages' HTML; the denser graph of ranks and loops has suppliers as pages, and links to those with
the numbers of the parts that they sell.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import crawl as C
from ..operators import graph as G
from ..operators import web as P
from ..tables import table, written
from .web import _LINKS


def _links(spark, sf):
    found = P.outlinks(table(spark, sf, "pages"))
    return found.select(F.col("url").alias("from_url"), P.resolve(F.col("url"), F.col("href")).alias("to_url"), "anchor", F.col("page_id").alias("ts"))


def _graph(spark, sf):
    lines = table(spark, sf, "lineitem")
    name = lambda c: F.concat(F.lit("http://h"), c % 23, F.lit(".d"), c % 7, F.lit(".com/"), c)
    n = table(spark, sf, "supplier").agg(F.max("s_suppkey").alias("n"))
    rows = lines.crossJoin(F.broadcast(n)).groupBy("l_suppkey", (F.col("l_partkey") % F.col("n") + 1).alias("to")).agg(F.max(F.col("l_quantity").cast("bigint")).alias("q"))
    return rows.select(name(F.col("l_suppkey")).alias("from_url"), name(F.col("to")).alias("to_url"), F.concat(F.lit("part "), F.col("q") % 5).alias("anchor"), (F.col("l_suppkey") + F.col("q") * 0).alias("ts"))


def inlink_counts(spark, sf):
    return G.inlink_counts(_links(spark, sf))


def pageranker_threshold(spark, sf):
    return G.page_ranker(_graph(spark, sf), 5)


def linkdb_invert(spark, sf):
    return G.invert(_links(spark, sf)).select("to_url", F.array_join(F.transform("inlinks", lambda x: F.concat_ws(" ", x["from_url"], x["anchor"])), ";").alias("inlinks"))


def anchors_distinct(spark, sf):
    return G.distinct_anchors(_links(spark, sf))


def webgraph_outlinks(spark, sf):
    return G.web_graph(_graph(spark, sf)).select("from_url", "to_url", "anchor")


def webgraph_nodes(spark, sf):
    return G.nodes(_graph(spark, sf))


def node_topn(spark, sf):
    return G.top_nodes(G.nodes(_graph(spark, sf)), "inlinks", 10)


def link_loops(spark, sf):
    return G.loops(G.web_graph(_graph(spark, sf), ignore_internal_host=False))


def link_rank(spark, sf):
    return G.link_rank(_graph(spark, sf)).select("url", F.round("rank", 6).alias("rank"))


def link_dump(spark, sf):
    g = written(_graph(spark, sf), "graph")  # read twice
    return G.link_dump(g, G.link_rank(g, 1).select("url", F.round("rank", 6).alias("rank"))).select("to_url", "from_url", "rank", F.col("place").cast("bigint").alias("place"))


def top_anchors(spark, sf):
    g = written(_graph(spark, sf), "graph")  # read three times
    ranks = G.link_rank(g, 1).select("url", F.round("rank", 6).alias("rank"))
    return G.top_anchors(g.select(F.col("from_url").alias("url")), g, ranks).select("url", "anchor", "from_url", F.col("place").cast("bigint").alias("place"))


def score_update(spark, sf):
    pages = table(spark, sf, "supplier").select(F.concat(F.lit("http://h"), F.col("s_suppkey") % 23, F.lit(".d"), F.col("s_suppkey") % 7, F.lit(".com/"), F.col("s_suppkey")).alias("url"), F.lit(1.0).alias("score"))
    return G.update_scores(pages, G.link_rank(_graph(spark, sf), 1)).select("url", F.round("score", 6).alias("score"))


def opic_scores(spark, sf):
    g = _graph(spark, sf)
    return G.opic(g.select(F.col("from_url").alias("url"), F.lit(1.0).alias("score")).distinct(), g, internal=0.5).select("url", F.round("score", 6).alias("score"))


def index_boosts(spark, sf):
    n = G.nodes(_graph(spark, sf))
    b = G.boosts(F.col("outlinks"), F.col("inlinks") + 1, F.col("inlinks") + F.col("outlinks"))
    return n.select("url", *(F.round(c, 6).alias(k) for k, c in b.items()), F.round(G.product_of([b["index_boost"], F.nullif(F.col("inlinks").cast("double"), F.lit(0.0))]), 6).alias("boost"))


def _thousandths(x):
    """Rounded as DuckDB does it: the double itself times 1000, not the decimal digits that it is shown with."""
    return F.round(x * 1000, 0) / 1000


def _crawl(spark, sf):
    """Orders as crawl records: several of a customer's are of its one url."""
    o = table(spark, sf, "orders")
    kinds = F.element_at(F.array(*map(F.lit, (1, 2, 3, 6, 0x21, 0x22, 0x23, 0x24, 0x25, 0x26, 0x43, 0x41))), (F.col("o_orderkey") % 12 + 1).cast("int"))
    return o.select(
        F.concat(F.lit("http://h"), F.col("o_custkey") % 31, F.lit(".org/"), F.col("o_custkey")).alias("url"), kinds.cast("bigint").alias("status"), F.unix_timestamp("o_orderdate").alias("fetch_time"),
        (F.lit(86400.0) * (F.col("o_orderkey") % 30 + 1)).alias("fetch_interval"), (F.col("o_orderkey") % 4).alias("retries"), _thousandths(F.col("o_totalprice") / 1000).alias("score"),
        F.when(F.col("o_orderkey") % 5 > 0, F.md5((F.col("o_custkey") % 9).cast("string"))).alias("signature"), (F.col("o_orderkey") % 3).alias("modified"), "o_orderkey",
    )


def crawldb_update(spark, sf):
    return C.update(_crawl(spark, sf))


def crawldb_inject(spark, sf):
    c = _crawl(spark, sf)
    old = c.where("status < 6").groupBy("url").agg(F.max("score").alias("score"))
    return C.inject(old, c.select("url").distinct().withColumn("score", F.lit(1.0)))


def crawldb_merge(spark, sf):
    c = _crawl(spark, sf)
    meta = F.create_map(F.concat(F.lit("k"), F.col("o_orderkey") % 3), F.col("o_orderkey").cast("string"))
    return C.merge(c.select("url", (F.col("fetch_time") * 1_000_000 + F.col("o_orderkey")).alias("fetch_time"), "status", meta.alias("meta")))


def segment_merge(spark, sf):
    c = _crawl(spark, sf).select(F.col("url").alias("key"), F.concat(F.lit("part"), F.col("o_orderkey") % 4).alias("part"), F.concat(F.lit("seg"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("segment"), "score")
    return C.segment_merge(c)


def crawldb_stats(spark, sf):
    return C.stats(_crawl(spark, sf).withColumn("host", U.host(F.col("url"))))


def _stats_by(key):
    return lambda spark, sf: C.domain_stats(_crawl(spark, sf), key(F.col("url")))


def generate_fetchlist(spark, sf):
    c = _crawl(spark, sf).groupBy("url").agg(F.max("score").alias("score"), F.max("fetch_time").alias("fetch_time"), F.max(F.when(F.col("o_orderkey") % 7 == 0, F.col("fetch_time"))).alias("generated"))
    return C.fetch_list(c, 1_000_000_000, 100, 5, U.host(F.col("url")), 10.0).select("url", "host", "score")


def crawldb_topn(spark, sf):
    return C.top_scores(_crawl(spark, sf).select("url", "score").distinct(), 50, 1.0)


def adaptive_schedule(spark, sf):
    i = F.col("fetch_interval")
    return _crawl(spark, sf).select("o_orderkey", F.round(C.adaptive(i, F.col("modified"), low=100_000.0, high=2_000_000.0), 3).alias("next"), F.round(C.gone_interval(i, 2_000_000.0), 3).alias("gone"), C.retry_time(F.col("fetch_time")).alias("retry"))


def _docs(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.concat(F.lit("http://x/"), F.col("doc_id") % 700).alias("url"), F.md5("text").alias("digest"), (F.col("n_chars") % 50).alias("boost"), (F.col("doc_id") % 17).alias("tstamp"))


def dedup_url(spark, sf):
    return C.newest_by_url(_docs(spark, sf)).select("doc_id", "url")


def dedup_content(spark, sf):
    return C.best_by_digest(C.newest_by_url(_docs(spark, sf))).select("doc_id", "digest")


def dedup_newest(spark, sf):
    return C.best_by_digest(_docs(spark, sf), newer=True).select("doc_id", "digest")


def dedup_delete_list(spark, sf):
    return C.delete_list(_docs(spark, sf)).select("doc_id")


def incremental_unprocessed(spark, sf):
    paths = table(spark, sf, "pages").select(F.col("url").alias("path"))
    return C.unprocessed(paths, paths.where(F.contains("path", F.lit("page="))))


def hash_sample(spark, sf):
    return C.sampled(table(spark, sf, "pages").select("page_id", "url"), 4)


_D = "d as (select doc_id, 'http://x/' || (doc_id % 700) as url, md5(text) as digest, n_chars % 50 as boost, doc_id % 17 as tstamp from documents)"
_A = f"{_LINKS}, l as (select url as from_url, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href as to_url, anchor from outl)"
_N = lambda c: f"'http://h' || ({c} % 23) || '.d' || ({c} % 7) || '.com/' || ({c})"
_G = f"e0 as (select l_suppkey as f, l_partkey % (select max(s_suppkey) from supplier) + 1 as t, max(cast(l_quantity as bigint)) as q from lineitem group by all), g as (select {_N('f')} as from_url, {_N('t')} as to_url, 'part ' || (q % 5) as anchor, f, t from e0)"
_H = lambda c: f"regexp_extract({c}, '://([^/]*)', 1)"
_DOM = lambda c: f"regexp_extract({c}, '([^./]+\\.[^./]+)/', 1)"
_NODES = "nodes as (select url, cast(sum(i) as bigint) as inlinks, cast(sum(o) as bigint) as outlinks from (select from_url as url, 0 as i, 1 as o from g union all select to_url, 1, 0 from g) group by url)"
_ONE = lambda host: f"one as (select * from (select * from g where from_url <> to_url{f' and {_H("from_url")} <> {_H("to_url")}' if host else ''}) qualify row_number() over (partition by from_url, {_DOM('to_url')} order by to_url, anchor) = 1)"


def _rank_sql(rounds: int) -> str:
    out = f"{_G}, urls as (select from_url as url from g union select to_url from g), e as (select distinct from_url, to_url from g), deg as (select from_url, count(*) as n from e group by 1), r0 as (select url, 1.0::double as rank from urls)"
    for i in range(rounds):
        out += f", r{i + 1} as (select u.url, 0.15 + 0.85 * (1.0 / (select count(*) from urls) + coalesce(s, 0)) as rank from urls u left join (select to_url as url, sum(rank / n) as s from e join deg using (from_url) join r{i} on r{i}.url = e.from_url group by 1) x using (url))"
    return out


_C = "c as (select 'http://h' || (o_custkey % 31) || '.org/' || o_custkey as url, cast([1, 2, 3, 6, 33, 34, 35, 36, 37, 38, 67, 65][o_orderkey % 12 + 1] as bigint) as status, cast(epoch(o_orderdate) as bigint) as fetch_time, 86400.0::double * (o_orderkey % 30 + 1) as fetch_interval, o_orderkey % 4 as retries, round(o_totalprice / 1000, 3) as score, case when o_orderkey % 5 > 0 then md5(cast(o_custkey % 9 as varchar)) end as signature, o_orderkey % 3 as modified, o_orderkey from orders)"
_REC = "struct_pack(fetch_time := fetch_time, status := status, fetch_interval := fetch_interval, retries := retries, score := score, signature := signature, modified := modified)"

QUERIES = {f.__name__: f for f in (inlink_counts, pageranker_threshold, linkdb_invert, anchors_distinct, webgraph_outlinks, webgraph_nodes, node_topn, link_loops, link_rank, link_dump, top_anchors, score_update, opic_scores, index_boosts, crawldb_update, crawldb_inject, crawldb_merge, segment_merge, crawldb_stats, generate_fetchlist, crawldb_topn, adaptive_schedule, dedup_url, dedup_content, dedup_newest, dedup_delete_list, incremental_unprocessed, hash_sample)} | {"domain_stats_host": _stats_by(U.host), "domain_stats_domain": _stats_by(U.domain)}
SQL = {
    "inlink_counts": f"with {_A} select to_url, count(*) as inlinks from l group by 1",
    "pageranker_threshold": f"with {_G} select to_url, count(*) as inlinks from g group by 1 having count(*) >= 5",
    "linkdb_invert": f"with {_A} select to_url, string_agg(from_url || ' ' || anchor, ';' order by from_url, anchor) as inlinks from (select distinct * from l) group by 1",
    "anchors_distinct": f"with {_A} select distinct to_url, lower(regexp_extract(from_url, '://([^/?#:]*)', 1)) as host, anchor from l where anchor <> ''",
    "webgraph_outlinks": f"with {_G}, {_ONE(True)} select from_url, to_url, anchor from one",
    "webgraph_nodes": f"with {_G}, {_NODES} select * from nodes",
    "node_topn": f"with {_G}, {_NODES} select * from nodes order by inlinks desc, url limit 10",
    "link_loops": f"""with {_G}, {_ONE(False)}, e as (select distinct from_url as a, to_url as b from one), two as (select x.a, x.b from e x join e y on x.b = y.a and y.b = x.a),
three as (select x.a, x.b, y.b as c from e x join e y on x.b = y.a join e z on z.a = y.b and z.b = x.a) select a as url, b as other from two union select a, b from three union select a, c from three""",
    "link_rank": f"with {_rank_sql(10)} select url, round(rank, 6) as rank from r10",
    "link_dump": f"with {_rank_sql(1)} select to_url, from_url, round(rank, 6) as rank, place from (select to_url, from_url, rank, row_number() over (partition by to_url order by round(rank, 6) desc, from_url) as place from e join r1 on r1.url = e.from_url) where place <= 50000",
    "top_anchors": f"with {_rank_sql(1)} select url, anchor, from_url, place from (select to_url as url, anchor, from_url, row_number() over (partition by to_url order by round(rank, 6) desc, from_url, anchor) as place from g join r1 on r1.url = g.from_url where to_url in (select from_url from g)) where place <= 3",
    "score_update": f"with {_rank_sql(1)} select {_N('s_suppkey')} as url, round(coalesce(rank, 0), 6) as score from supplier left join r1 on r1.url = {_N('s_suppkey')}",
    "opic_scores": f"with {_G}, e as (select distinct from_url, to_url from g), deg as (select from_url, count(*) as n from e group by 1), gift as (select to_url as url, sum(1.0 / n * case when {_H('from_url')} = {_H('to_url')} then 0.5 else 1.0 end) as gift from e join deg using (from_url) group by 1), s as (select distinct from_url as url, 1.0 as score from g) select url, round((coalesce(score, 0) + coalesce(gift, 0))::double, 6) as score from s full join gift using (url)",
    "index_boosts": f"with {_G}, {_NODES} select url, round(sqrt(outlinks), 6) as index_boost, round(log10(inlinks + 1) + 1, 6) as rank_boost, round(1.0::double / (inlinks + outlinks), 6) as norm_url, round(1.0::double / ln(2.718281828459045::double + inlinks + outlinks), 6) as norm_anchor, round(1 / sqrt(greatest(inlinks + outlinks, 1000)), 6) as norm_content, round(1 / sqrt(inlinks + outlinks), 6) as norm_other, round(sqrt(outlinks) * (case when inlinks = 0 then 1 else inlinks end), 6) as boost from nodes",
    "crawldb_update": f"""with {_C}, g as (select url, max(case when status <= 6 then {_REC} end) as old, max(case when status between 33 and 38 then {_REC} end) as fe, min(case when status = 67 then {_REC} end) as link, max(case when status = 65 then signature end) as sig, sum(case when status = 67 then score else 0 end) as gift from c group by url),
h as (select *, coalesce(fe, link) as nw, coalesce(sig, coalesce(fe, link).signature) as s2 from g where old is not null or fe is not null or link is not null),
k as (select *, case when nw.status = 38 then 2 when old.signature is not null and s2 is not null then (case when old.signature <> s2 then 1 else 2 end) else 0 end as ch, coalesce(nw.status in (33, 35, 36, 38), false) as ok, nw is null or (nw.status = 67 and old is not null) as keep, nw.status = 67 and old is null as fst from h),
m as (select *, case when nw.status = 34 then nw.retries + 1 when ok then 0 else nw.retries end as rt, case when keep then old.fetch_interval when ok then greatest(60, least(31536000, case ch when 1 then nw.fetch_interval * 0.8::double when 2 then nw.fetch_interval * 1.2::double else nw.fetch_interval end)) when nw.status = 37 then nw.fetch_interval * 1.5::double else nw.fetch_interval end as iv from k)
select url, case when keep then old.status when fst then 1 when ok and ch = 2 then 6 when ok then case nw.status when 33 then 2 when 36 then 5 when 35 then 4 end when nw.status = 34 then (case when rt < 3 then 1 else 3 end) else 3 end as status,
cast(case when keep then old.fetch_time when fst then nw.fetch_time when nw.status = 34 then nw.fetch_time + 86400 else nw.fetch_time + floor(iv) end as bigint) as fetch_time, round(iv, 3) as fetch_interval, case when keep then old.retries else rt end as retries,
round((case when fst then 0 else coalesce(old.score, 0) end) + gift, 6) as score, case when keep then old.signature when fst then null when ok and ch <> 2 then s2 else old.signature end as signature from m""",
    "crawldb_inject": f"with {_C}, old as (select url, max(score) as score from c where status < 6 group by 1) select * from old union all select distinct url, 1.0 from c where url not in (select url from old)",
    "crawldb_merge": f"""with {_C}, r as (select url, fetch_time * 1000000 + o_orderkey as ft, status, 'k' || (o_orderkey % 3) as k, o_orderkey as v from c), m as (select url, k, max_by(v, ft) as v from r group by all)
select url, max(ft) as fetch_time, max_by(status, ft) as status, (select string_agg(k || '=' || v, ',' order by k) from m where m.url = r.url) as meta from r group by url""",
    "segment_merge": f"with {_C} select url as key, 'part' || (o_orderkey % 4) as part, 'seg' || lpad(cast(o_orderkey as varchar), 9, '0') as segment, score from c qualify row_number() over (partition by url, o_orderkey % 4 order by o_orderkey desc) = 1",
    "crawldb_stats": f"with {_C}, h as (select *, {_H('url')} as host from c) select status, retries, host, count(*) as n, cast(floor(min(score) * 1000) as bigint) as score_min, cast(floor(max(score) * 1000) as bigint) as score_max, cast(sum(cast(floor(score * 1000) as bigint)) as bigint) as score_sum from h group by grouping sets ((), (status), (retries), (status, host))",
    "domain_stats_host": f"with {_C} select {_H('url')} as name, count(*) as n, count(*) filter (status in (2, 6)) as fetched, count(*) filter (status not in (2, 6)) as not_fetched from c group by 1",
    "domain_stats_domain": f"with {_C} select {_H('url')} as name, count(*) as n, count(*) filter (status in (2, 6)) as fetched, count(*) filter (status not in (2, 6)) as not_fetched from c group by 1",
    "generate_fetchlist": f"""with {_C}, u as (select url, max(score) as score, max(fetch_time) as fetch_time, max(case when o_orderkey % 7 = 0 then fetch_time end) as generated from c group by 1)
select url, host, score from (select *, {_H('url')} as host from u where fetch_time <= 1000000000 and (generated is null or generated + 604800 <= 1000000000) and score >= 10 qualify row_number() over (partition by {_H('url')} order by score desc, url) <= 5) order by score desc, url limit 100""",
    "crawldb_topn": f"with {_C} select distinct url, score from c where score >= 1 order by score desc, url limit 50",
    "adaptive_schedule": f"with {_C} select o_orderkey, round(greatest(100000, least(2000000, case modified when 1 then fetch_interval * 0.8::double when 2 then fetch_interval * 1.2::double else fetch_interval end)), 3) as next, round(case when fetch_interval * 1.5 > 2000000 then 1800000 else fetch_interval * 1.5::double end, 3) as gone, fetch_time + 86400 as retry from c",
    "dedup_url": f"with {_D} select doc_id, url from d qualify row_number() over (partition by url order by tstamp desc, doc_id) = 1",
    "dedup_content": f"with {_D}, k as (select * from d qualify row_number() over (partition by url order by tstamp desc, doc_id) = 1) select doc_id, digest from k qualify row_number() over (partition by digest order by boost desc, length(url), doc_id) = 1",
    "dedup_newest": f"with {_D} select doc_id, digest from d qualify row_number() over (partition by digest order by boost desc, tstamp desc, doc_id) = 1",
    "dedup_delete_list": f"with {_D}, k as (select * from d qualify row_number() over (partition by url order by tstamp desc, doc_id) = 1), b as (select doc_id from k qualify row_number() over (partition by digest order by boost desc, length(url), doc_id) = 1) select doc_id from d where doc_id not in (select doc_id from b)",
    "incremental_unprocessed": "select url as path from pages where not contains(url, 'page=')",
    "hash_sample": "select page_id, url from pages where cast('0x' || substr(md5(url), 1, 8) as bigint) % 4 = 0",
}
