"""Queries of feeds, extension chains, digests, norms and lookups, and their SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import plugins as R
from ..functions import text_parts as X
from ..functions import urls as U
from ..operators import graph as G
from ..operators import text as T
from ..tables import table
from .graph import _G, _NODES, _graph


def feed_entries(spark, sf):
    """Every whole document as a feed of two entries, through the parser of its media type."""
    head = F.regexp_replace("text", "\\]\\]>", "]]]]><![CDATA[>")
    xml = F.concat(F.lit("<rss><item><title>"), F.col("source"), F.lit("</title><link>http://x/"), F.col("doc_id"), F.lit("</link><description><![CDATA["), head, F.lit("]]></description></item><entry><title>"), F.col("lang"), F.lit('</title><link href="http://y/"/></entry></rss>'))
    rows = table(spark, sf, "documents").select("doc_id", xml.alias("xml"))
    return rows.select("doc_id", R.parse_by_type(F.col("xml"), F.lit("application/rss+xml")).alias("parsed"), X.feed_entries(F.col("xml"))[0]["body"].alias("body"))


def payload_digest(spark, sf):
    """H2, H4, T22."""
    h = F.col("html").cast("binary")
    return table(spark, sf, "pages").select("page_id", X.sha1_base32(h).alias("digest"), F.md5(F.concat("html", "url")).alias("signature"), X.to_hex(F.col("url")).alias("hex"), X.from_hex(X.to_hex(F.col("url"))).cast("string").alias("back"))


def analyzed_terms(spark, sf):
    """Light stems of German and French texts, plain tokens of others."""
    d = table(spark, sf, "documents").select("doc_id", "lang", T.tokens(F.col("text")).alias("t"))
    return d.select("doc_id", F.array_join(F.when(F.col("lang").isin("de", "fr"), R.transform_chain("analyzer", F.col("t"), include="light")).otherwise(F.col("t")), " ").alias("terms"))


def norms_and_scores(spark, sf):
    """N6, N7."""
    n = G.nodes(_graph(spark, sf))
    s = X.link_score(F.lit(0.5), F.col("inlinks"), 2.0)
    return n.select("url", F.round(X.rank_norm(1 / F.sqrt(F.col("outlinks") + 1), F.col("inlinks")), 6).alias("norm"), *(F.round(c, 6).alias(k) for k, c in s.items()))


def node_lookup(spark, sf):
    """The number of nodes, and one node's links either way."""
    g = _graph(spark, sf)
    n = G.nodes(g)
    url = n.agg(F.min("url").alias("url"), F.count("*").alias("nodes"))
    into = g.join(F.broadcast(url), g["to_url"] == url["url"]).agg(F.count_distinct("from_url").alias("inlinks"))
    return url.join(into).join(g.join(F.broadcast(url), g["from_url"] == url["url"]).agg(F.count_distinct("to_url").alias("outlinks")))


def fetch_order(spark, sf):
    """Every page with its place in its host's order, which only a hash decides; captures of one address by number."""
    p = table(spark, sf, "pages").select("page_id", "url", U.host(F.col("url")).alias("host"))
    spread = X.by_host(p, F.col("host"), 8).withColumn("n", F.row_number().over(W.partitionBy("host").orderBy(F.md5("url"), "page_id")))
    return spread.select("page_id", "host", F.col("n").cast("bigint").alias("n"))


def validity_at_capture(spark, sf):
    """The range join that heuristics 3a and 3b ask for: registry relations valid on the day of a page's capture.

    Customers are the equal key, so the range is only tested within one: an order's relation holds for 30 days.
    """
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    valid = o.select(F.col("o_custkey").alias("person"), F.col("o_orderdate").alias("start"), (F.col("o_orderdate") + F.expr("interval 30 days")).alias("end"), F.col("o_orderkey").alias("relation"))
    met = o.join(valid, (F.col("o_custkey") == F.col("person")) & (F.col("o_orderdate") >= F.col("start")) & (F.col("o_orderdate") <= F.col("end")) & (F.col("o_orderkey") != F.col("relation")))
    return met.select("o_orderkey", "relation")


QUERIES = {f.__name__: f for f in (feed_entries, payload_digest, analyzed_terms, norms_and_scores, node_lookup, fetch_order, validity_at_capture)}
SQL = {
    "feed_entries": "select doc_id, source || ' http://x/' || doc_id || chr(10) || lang || ' http://y/' as parsed, trim(text, ' ') as body from documents",
    "payload_digest": "select page_id, 'sha1:' || array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((cast('0x' || substr(sha1(html), cast(1 + 5 * i as bigint), 5) as bigint) >> b) % 32 + 1 as bigint), 1)), '')), '') as digest, md5(html || url) as signature, lower(hex(encode(url))) as hex, url as back from pages",
    "analyzed_terms": f"with t as (select doc_id, lang, list_transform(regexp_extract_all(text, '{T.TOKEN}'), lambda t: lower(replace(t, '.', ''))) as t from documents) select doc_id, array_to_string(case when lang in ('de', 'fr') then list_transform(t, lambda w: coalesce(nullif(regexp_extract(w, '^(.*?\\p{{L}}{{4}})(?:ern|em|er|en|es|e|s)$', 1), ''), w)) else t end, ' ') as terms from t",
    "norms_and_scores": f"with {_G}, {_NODES} select url, round(1.0::double / sqrt(outlinks + 1) * case when inlinks >= 1 then log10(inlinks) + 1 else 1 end, 6) as norm, round(inlinks * 0.5::double, 6) as sort_key, round(inlinks * 2.0::double, 6) as index_score from nodes",
    "node_lookup": f"with {_G}, {_NODES}, u as (select min(url) as url, count(*) as nodes from nodes) select url, nodes, (select count(distinct from_url) from g where to_url = url) as inlinks, (select count(distinct to_url) from g where from_url = url) as outlinks from u",
    "fetch_order": "select page_id, host, row_number() over (partition by host order by md5(url)) as n from (select page_id, url, lower(regexp_extract(url, '://([^/?#:]*)', 1)) as host from pages)",
    "validity_at_capture": "select a.o_orderkey, b.o_orderkey as relation from orders a join orders b on a.o_custkey = b.o_custkey and a.o_orderkey <> b.o_orderkey and a.o_orderdate between b.o_orderdate and b.o_orderdate + interval 30 day",
}
