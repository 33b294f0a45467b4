"""Queries of index assembly, hit details, dates, limited ranks and the experimental matcher, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as N
from ..functions import plugins as R
from ..functions import text_parts as X
from ..functions import urls as U
from ..operators import entities as E
from ..operators import graph as G
from ..operators import indexing as D
from ..operators import web as P
from ..tables import table, written
from . import inputs as I
from .entities import _NAMES, _REGISTRY, _RESOLVE, _norm, _parts
from .graph import _G, _NODES, _graph
from .web import _TEXT, _TITLE


def _pages(spark, sf):
    return table(spark, sf, "pages")


def _canonical(url):
    return F.lower(F.regexp_replace(url, "^https?://|[?#].*$", ""))


def basic_fields(spark, sf):
    """Pages under the address that stands for them: every third page flips to its host's root."""
    p = _pages(spark, sf)
    root = F.concat(U.part(F.col("url"), "scheme"), F.lit("://"), U.host(F.col("url")), F.lit("/"))
    fetches = p.select("page_id", F.lit(1).alias("fetch_time"), F.lit("s1").alias("segment")).union(p.where("page_id % 2 = 0").select("page_id", F.lit(2), F.lit("s2")))
    nodes = p.select("page_id", "url", (F.col("page_id") % 17).cast("double").alias("score"))
    flips = p.where("page_id % 3 = 0").select("page_id", root.alias("url"))
    return D.basic_fields(p.select("page_id", "url", F.concat(F.lit("t"), F.col("page_id")).alias("title")), nodes, fetches, flips, "page_id")


def date_backfill(spark, sf):
    """Two dates of every page; records add dates by canonical address and digest, a few of them malformed."""
    p = _pages(spark, sf)
    docs = p.select("page_id", "url", F.md5("html").alias("digest"), F.array(F.lit("20140101"), F.concat(F.lit("201501"), F.lpad((F.col("page_id") % 28 + 1).cast("string"), 2, "0"))).alias("dates"))
    records = p.where("page_id % 2 = 0").select(_canonical(F.col("url")).alias("url"), F.md5("html").alias("digest"), F.when(F.col("page_id") % 5 > 0, F.lit("20160202")).alias("date14"))
    records = records.union(p.where("page_id % 4 = 0").select(_canonical(F.col("url")), F.md5("html"), F.lit("20140101")))
    return D.backfill_dates(docs, records, _canonical(F.col("url"))).select("page_id", F.array_join("dates", " ").alias("dates"))


def index_sorted(spark, sf):
    """Every supplier page's number in an index sorted by its inlinks."""
    n = G.nodes(_graph(spark, sf)).select("url", F.col("inlinks").cast("double").alias("boost"))
    return D.sort_by_boost(n, "boost", "url").select("url", "number")


def hit_details(spark, sf):
    """Hits on a third of the nodes with their stored row and anchors."""
    g = _graph(spark, sf)
    stored = g.select(F.xxhash64("from_url").alias("doc_id"), F.col("from_url").alias("url"), F.lit("t").alias("title"), F.concat(F.lit("<p>"), "from_url").alias("html")).distinct()
    hits = stored.where(F.rlike("url", F.lit("[147]$"))).select("doc_id", F.length("url").cast("double").alias("score"))
    return D.hit_details(hits, stored, g).select("url", "title", "score", "cached", F.array_join("anchors", "; ").alias("anchors"))


def field_injectors(spark, sf):
    """The fields that all injectors give a page, under the headers of its fetch."""
    p, h = _pages(spark, sf), F.col("html")
    day = F.timestamp_seconds(F.lit(1451606400) + F.col("page_id") * 86400)
    rows = p.select("page_id", "url", "html", P.text(h).alias("text"), P.title(h).alias("title"), F.lit("Text/HTML; charset=utf-8").alias("mime"), day.alias("modified"), F.octet_length("html").cast("bigint").alias("length"))
    out = D.inject_fields(rows)
    return out.select("url", "host", "site", F.md5("content").alias("content"), "short_title", "cache", F.array_join("type", " ").alias("type"), "date", "content_length", "tld", "licence")


def response_lines(spark, sf):
    """X11: nodes as JSON and XML responses, read back by Spark's own parsers."""
    n = G.nodes(_graph(spark, sf)).select("url", F.col("inlinks").cast("int").alias("inlinks"))
    schema = "url string, inlinks int"
    json = D.as_json(n).select(F.from_json("value", schema).alias("x")).select("x.*", F.lit("json").alias("form"))
    xml = D.as_xml(n).select(F.from_xml("value", schema).alias("x")).select("x.*", F.lit("xml").alias("form"))
    return json.union(xml).select("form", "url", F.col("inlinks").cast("bigint").alias("inlinks"))


def person_relations(spark, sf):
    """A5: persons with their relations."""
    return E.person_relations(I.registry(spark, sf)).select("key", "id", F.array_join(F.transform("relations", lambda r: r["id_org"].cast("string")), " ").alias("orgs"))


def ngram_index(spark, sf):
    """A5: n-gram keys of the persons' normalised names, with the number of names of each."""
    return E.ngram_index(E.person_index(I.registry(spark, sf))).groupBy("gram").agg(F.count("*").alias("names"))


def known_relations(spark, sf):
    """Names on pages that are known persons, with the number of their relations."""
    names = I.names(spark, sf).where("label = 'PER'").select("page", "entity")
    read = names.select("entity").distinct().select("entity", F.explode(N.name_keys(F.col("entity"))).alias("key"))
    keys = names.join(read, "entity").select("page", "key").distinct()
    n = F.size("relations").cast("bigint")
    return E.known_relations(keys, E.person_relations(I.registry(spark, sf)), n).select("page", "key", "id", F.col("relations").alias("n"))


def page_hits(spark, sf):
    """Hits of both types by page, on pages that have either."""
    names = I.names(spark, sf)
    per = names.where("label = 'PER' and page % 3 > 0").select("page")
    org = names.where("label = 'ORG' and page % 2 = 0").select("page")
    return E.hits_by_page(per, org)


def inlinks_once(spark, sf):
    """Inlinks of each node, one for each source domain."""
    return G.once_for_each_source(_graph(spark, sf).select("from_url", "to_url")).groupBy("to_url").agg(F.count("*").alias("n"), F.min("from_url").alias("first"))


def link_rank_limited(spark, sf):
    """Two rounds of link rank without the links of loops of two, an inlink counted once for each source domain."""
    g = written(_graph(spark, sf), "graph")  # read three times
    two = g.select(F.col("from_url").alias("url"), F.col("to_url").alias("other")).intersect(g.select("to_url", "from_url")).where("url <> other")
    return G.link_rank(g, iterations=2, skip=two, limit_page=True, limit_domain=True).select("url", F.round("rank", 6).alias("rank"))


def rank_apply(spark, sf):
    """Page scores times the boost of their rank; pages without a rank keep their score."""
    g = _graph(spark, sf)
    n = G.nodes(g).select("url", "inlinks")
    return n.join(n.where("inlinks > 3").select("url", F.col("inlinks").alias("rank")), "url", "left").select("url", F.round(X.rank_norm(F.lit(2.0), F.coalesce("rank", F.lit(0))), 6).alias("score"))


def org_lemma_keys(spark, sf):
    """T4: organisations under their own key and that of their stemmed words."""
    lemmas = lambda words: R.transform_chain("analyzer", F.transform(words, F.lower), include="light")
    return E.org_index_with_lemmas(I.registry(spark, sf), lemmas).select("key", "id")


def exploded_names(spark, sf):
    """Matched names as lines."""
    return E.exploded_names(_parts(spark, sf))


def parallel_indexes(spark, sf):
    """Two indexes of the same documents side by side; those with a licence."""
    d = table(spark, sf, "documents")
    licence = F.when(F.rlike(F.lower("text"), F.lit("creativecommons|licen[cs]e")), "cc")
    return D.licensed(D.parallel(d.select("doc_id", "lang"), d.select("doc_id", licence.alias("licence"))))


_PAGE = "p as (select *, lower(regexp_extract(url, '://([^/?#:]*)', 1)) as host, regexp_extract(url, '^([a-z]+)://', 1) as scheme from pages)"
_E = "e as (select distinct from_url as a, to_url as b from g)"
_LIGHT = "coalesce(nullif(regexp_extract(w, '^(.*?\\p{L}{4})(?:ern|em|er|en|es|e|s)$', 1), ''), w)"

QUERIES = {f.__name__: f for f in (basic_fields, date_backfill, index_sorted, hit_details, field_injectors, response_lines, person_relations, ngram_index, known_relations, page_hits, inlinks_once, link_rank_limited, rank_apply, org_lemma_keys, exploded_names, parallel_indexes)}
SQL = {
    "basic_fields": f"""with {_PAGE}, r as (select case when page_id % 3 = 0 then scheme || '://' || host || '/' else url end as shown, url, 't' || page_id as title, case when page_id % 2 = 0 then 's2' else 's1' end as segment, (page_id % 17)::double as score from p),
b as (select r.*, greatest(r.score, coalesce(s.page_id % 17, 0))::double as boost from r left join pages s on s.url = r.shown) select shown as url, url as orig_url, title, segment, boost from b qualify row_number() over (partition by shown order by boost desc, url) = 1""",
    "date_backfill": """with d as (select page_id, lower(regexp_replace(url, '^https?://|[?#].*$', '', 'g')) as c, md5(html) as h, page_id % 28 + 1 as dd from pages),
r as (select c, h, '20160202' as x from d where page_id % 2 = 0 and page_id % 5 > 0 union all select c, h, '20140101' from d where page_id % 4 = 0),
u as (select page_id, '20140101' as x from d union select page_id, '201501' || lpad(dd::varchar, 2, '0') from d union select d.page_id, r.x from d join r on d.c = r.c and d.h = r.h) select page_id, string_agg(x, ' ' order by x) as dates from u group by 1""",
    "index_sorted": f"with {_G}, {_NODES} select url, row_number() over (order by inlinks desc, url) - 1 as number from nodes",
    "hit_details": f"with {_G} select s.url, 't' as title, length(s.url)::double as score, '<p>' || s.url as cached, coalesce((select string_agg(distinct anchor, '; ' order by anchor) from g where g.to_url = s.url), '') as anchors from (select distinct from_url as url from g) s where regexp_matches(url, '[147]$')",
    "field_injectors": f"""with {_PAGE} select url, host, regexp_replace(host, '^www\\.', '') as site, md5({_TEXT}) as content, {_TITLE}[:100] as short_title, case when regexp_matches(html, '(?i)noarchive') then 'content' else 'all' end as cache, 'text/html text html' as type,
strftime(timestamp '2016-01-01' + to_days(cast(page_id as integer)), '%Y%m%d') as date, strlen(html) as content_length, regexp_extract(host, '([a-z]+)$', 1) as tld, null::varchar as licence from p""",
    "response_lines": f"with {_G}, {_NODES} select form, url, inlinks from nodes, (select unnest(['json', 'xml']) as form)",
    "person_relations": f"with {_REGISTRY} select {_norm("first_name || ' ' || last_name")} as key, id_per as id, array_to_string(list_transform(list_sort(list(distinct id_org)), lambda x: x::varchar), ' ') as orgs from (select distinct first_name, last_name, id_per, id_org from reg) group by all",
    "ngram_index": f"""with {_REGISTRY}, k as (select distinct {_norm("first_name || ' ' || last_name")} as key from reg), s as (select key, unnest(range(greatest(cast(floor(length(key) * 0.8) as bigint), 1), length(key) + 1)) as n from k),
x as (select distinct key, substr(key, i, n) as gram from s, range(1, 200) r(i) where i + n - 1 <= length(key)) select gram, count(*) as names from x group by 1""",
    "known_relations": f"""with {_REGISTRY}, {_NAMES}, k as (select distinct page, unnest([{_norm("split_part(entity, '|', 1)")}, {_norm("case when contains(entity, '|') then regexp_replace(entity, '[^ ]*\\|', '') else entity end")}]) as key from names where label = 'PER'),
a as (select {_norm("first_name || ' ' || last_name")} as key, id_per as id, count(distinct id_org) as n from reg group by all) select distinct page, key, id, n from k join a using (key)""",
    "page_hits": "with a as (select o_orderkey as page, count(*) as n_per from orders where o_orderkey % 3 > 0 group by 1), b as (select l_orderkey as page, count(*) as n_org from lineitem where l_orderkey % 2 = 0 group by 1) select coalesce(a.page, b.page) as page, coalesce(n_per, 0) as n_per, coalesce(n_org, 0) as n_org from a full join b on a.page = b.page",
    "inlinks_once": f"with {_G}, d as (select to_url, regexp_extract(from_url, '(d[0-9]\\.com)/', 1) as dom, min(from_url) as f from g group by all) select to_url, count(*) as n, min(f) as first from d group by 1",
    "link_rank_limited": f"""with {_G}, {_E}, k as (select a, b from e where not exists (select 1 from e r where r.a = e.b and r.b = e.a and e.a <> e.b)), dg as (select a, count(*) as n from k group by 1),
o as (select b, min(a) as a from k group by b, regexp_extract(a, '(d[0-9]\\.com)/', 1)), u as (select a as url from e union select b from e), c as (select count(*) as n from u),
r1 as (select url, 0.15 + 0.85 * (1 / (select n from c) + coalesce((select sum(1.0 / dg.n) from o join dg using (a) where o.b = u.url), 0)) as rank from u),
r2 as (select url, 0.15 + 0.85 * (1 / (select n from c) + coalesce((select sum(r1.rank / dg.n) from o join dg using (a) join r1 on r1.url = o.a where o.b = u.url), 0)) as rank from u) select url, round(rank, 6) as rank from r2""",
    "rank_apply": f"with {_G}, {_NODES} select url, round(2.0::double * case when inlinks > 3 then log10(inlinks) + 1 else 1 end, 6) as score from nodes",
    "org_lemma_keys": f"""with {_REGISTRY}, n as (select distinct name_org, id_org as id from reg), s as (select *, array_to_string(list_transform(string_split(lower(name_org), ' '), lambda w: {_LIGHT}), ' ') as stemmed from n)
select distinct key, id from (select {_norm("name_org")} as key, id from s union all select {_norm("stemmed")}, id from s)""",
    "exploded_names": _RESOLVE + "select page || '::' || key as value, key || ',' || id as line from outcomes where outcome in ('single', 'cross')",
    "parallel_indexes": "select doc_id, lang, 'cc' as licence from documents where regexp_matches(lower(text), 'creativecommons|licen[cs]e')",
}
