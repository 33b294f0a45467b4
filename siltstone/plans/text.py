"""Queries over documents, search and index assembly, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import graph as G
from ..operators import indexing as X
from ..operators import search as S
from ..operators import text as T
from ..operators import web as P
from ..tables import table, written
from .graph import _A, _links
from .web import _TEXT, _TITLE

QUERY = 'the "of the" -title:der'


def _docs(spark, sf):
    return table(spark, sf, "documents")


def tokenize(spark, sf):
    return _docs(spark, sf).select("doc_id", F.array_join(T.tokens(F.col("text")), " ").alias("tokens"))


def tokenize_sentences(spark, sf):
    d = _docs(spark, sf)
    return d.select("doc_id", F.size(T.sentences(F.col("text"))).cast("bigint").alias("sentences"), F.md5(F.array_join(T.sentences(F.col("text")), "|")).alias("digest"), F.size(T.paragraphs(F.col("text"))).cast("bigint").alias("paragraphs"))


def common_grams(spark, sf):
    return _docs(spark, sf).select("doc_id", F.array_join(T.common_grams(T.tokens(F.col("text")), ["the", "of", "de", "la"]), " ").alias("grams"))


def text_profile_signature(spark, sf):
    return T.text_profile(_docs(spark, sf))


def high_freq_terms(spark, sf):
    return T.term_frequencies(_docs(spark, sf), 20)


def uniq_field_values(spark, sf):
    return _docs(spark, sf).select("source", "lang").distinct()


def field_stats(spark, sf):
    """Rows and distinct values of fields."""
    return _docs(spark, sf).agg(F.count("*").alias("docs"), F.count("text").alias("with_text"), F.count_distinct("lang").alias("langs"), F.count_distinct("source").alias("sources"))


def lang_profile(spark, sf):
    return T.language_profiles(_docs(spark, sf), top=1000).select("lang", "gram", F.round("freq", 9).alias("freq"))


def lang_identify(spark, sf):
    d = _docs(spark, sf)
    return T.identify(d, T.language_profiles(d, top=1000)).select("doc_id", "guess", F.round("score", 6).alias("score"))


def profile_distance(spark, sf):
    return T.profile_distance(T.language_profiles(_docs(spark, sf), top=1000)).select("a", "b", F.round("distance", 6).alias("distance"))


def language_field(spark, sf):
    p = table(spark, sf, "pages")
    return p.select("page_id", T.language_field(F.when(F.col("page_id") % 3 > 0, P.language(F.col("html"))), F.when(F.col("page_id") % 2 == 0, F.lit("xx")), F.lit(None).cast("string")).alias("lang"))


def _index(spark, sf):
    p = table(spark, sf, "pages").withColumnRenamed("page_id", "doc_id")
    h = F.col("html")
    anchors = _links(spark, sf).groupBy(F.col("to_url").alias("url")).agg(F.array_join(F.array_sort(F.collect_set("anchor")), " ").alias("anchor"))
    p = p.join(anchors, "url", "left")
    index = S.postings(p, {"title": P.title(h), "content": P.text(h), "host": U.host(F.col("url")), "url": F.col("url"), "anchor": F.col("anchor")})
    return written(index, "postings", "part")


def search_terms(spark, sf):
    return S.search(_index(spark, sf), "the example").select("doc_id", F.round("score", 6).alias("score"))


def search_phrase(spark, sf):
    return S.search(_index(spark, sf), QUERY).select("doc_id", F.round("score", 6).alias("score"))


def search_per_site(spark, sf):
    site = table(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), U.domain(F.col("url")).alias("site"))
    hits = S.search(_index(spark, sf), "content:the").select("doc_id", F.round("score", 6).alias("score")).join(site, "doc_id")
    return S.per_site(hits, 3).select("doc_id", "site", "score", F.col("place").cast("bigint").alias("place"))


def search_top(spark, sf):
    return S.top(S.search(_index(spark, sf), "content:of").select("doc_id", F.round("score", 6).alias("score")), 10)


def search_filters(spark, sf):
    """Date and group filters side by side."""
    d = F.concat(F.lit("2014"), F.lpad((F.col("page_id") % 12 + 1).cast("string"), 2, "0"), F.lit("15000000"))
    return table(spark, sf, "pages").select("page_id", S.date_range(d, "201405").alias("may"), S.date_range(d, "2014-2015").alias("years"), S.date_range(d, "20140101-201406").alias("half"), S.group_filter(U.suffix(F.col("url")), "com, org").alias("grouped"))


def index_prune(spark, sf):
    return S.prune(_index(spark, sf), ["content:der", "host:m"]).groupBy("doc_id").agg(F.sum(F.size("positions")).alias("tokens"))


def index_config(spark, sf):
    d = _docs(spark, sf)
    return S.static_fields(S.index_fields(d, ["lang:false:true:true:false:language", "source:true:true", "n_chars:false:false"]), "collection=web -none").select("doc_id", "language", "source", "collection")


def summaries(spark, sf):
    """X7 over whole texts; brute force in the tests."""
    return S.summaries(_docs(spark, sf), 'the "of that"')


def index_assembly(spark, sf):
    """Pages with text, data, record and fetch, and the boost of their inlinks; captures of one address
    are known by their number."""
    p, h = table(spark, sf, "pages"), F.col("html")
    text = p.select("page_id", "url", F.length(P.text(h)).cast("bigint").alias("text_length"))
    data = p.where(P.title(h) != "").select("page_id", P.title(h).alias("title"), F.md5("html").alias("signature"), F.concat(F.lit("s"), F.col("page_id") % 4).alias("segment"))
    db = p.select("page_id", (F.col("page_id") % 6 + 1).alias("status"))
    fetch = p.where(~F.contains("url", F.lit("ref="))).select("page_id", (F.col("page_id") * 10).alias("fetched"))
    inlinks = G.inlink_counts(_links(spark, sf)).select(F.col("to_url").alias("url"), "inlinks")
    docs = X.assemble(text, data, db, fetch, inlinks, "page_id")
    return X.archive_documents(docs.drop("segment", "signature", "title"), data, "page_id").select("url", "title", "segment", "signature", "status", "fetched", "inlinks", "text_length")


def custom_fields(spark, sf):
    p = table(spark, sf, "pages")
    lines = p.select(F.concat_ws("\t", "url", F.lit("tag"), "url", F.when(F.col("page_id") % 2 == 0, (F.col("page_id") / 4).cast("string"))).alias("value")).union(p.select(F.concat_ws("\t", "url", F.lit("short"))))
    return X.custom_fields(lines, p.where(F.startswith("url", F.lit("https"))).select("url")).select("url", "name", "content", F.round("score", 6).alias("score"))


def segment_listing(spark, sf):
    p = table(spark, sf, "pages").select(F.concat(F.lit("seg"), F.col("page_id") % 3).alias("segment"), F.when(F.col("page_id") % 2 == 0, "content").otherwise("parse_text").alias("part"), F.col("url").alias("key"))
    return X.segment_listing(p)


_TOK = f"list_transform(regexp_extract_all(text, '{T.TOKEN}'), lambda t: lower(replace(t, '.', '')))"
_GRAMS = "select {key}, substr(w, cast(i as bigint), 3) as gram from (select {key}, '_' || unnest(regexp_extract_all(lower(text), '\\p{{L}}+')) || '_' as w from documents) z, lateral (select unnest(range(1, greatest(length(w) - 1, 2))) as i)"
_PROFILE = lambda top: f"pc as (select lang, gram, count(*) as c from ({_GRAMS.format(key='lang')}) group by all), prof as (select lang, gram, c / sum(c) over (partition by lang) as freq from pc qualify row_number() over (partition by lang order by c desc, gram) <= {top})"
_POST = rf"""{_A}, an as (select to_url as url, array_to_string(list_sort(list_distinct(list(anchor))), ' ') as anchor from l group by 1), pg as (select page_id as doc_id, unnest(['title', 'content', 'host', 'url', 'anchor']) as field, unnest([{_TITLE},
{_TEXT}, lower(regexp_extract(url, '://([^/?#:]*)', 1)), url, anchor]) as text from pages left join an using (url)),
tk as (select doc_id, field, {_TOK} as t from pg), post as (select doc_id, field, i - 1 as pos, t[i] as term from tk, range(1, 200000) r(i) where i <= len(t)), lens as (select doc_id, field, count(*) as n from post group by all)"""
_BOOST = "case field when 'url' then 4.0::double when 'anchor' then 2 when 'content' then 1 when 'title' then 1.5 when 'host' then 2 end"
_HIT = lambda i, term, field="": f"select doc_id, field, count(*) as tf, {i} as clause from post where term = '{term}'{f" and field = '{field}'" if field else ''} group by all"
_SCORE = lambda n: f"select doc_id, round(sum({_BOOST} * sqrt(tf) / sqrt(n)), 6) as score from hits join lens using (doc_id, field) group by doc_id having count(distinct clause) = {n}"

QUERIES = {f.__name__: f for f in (tokenize, tokenize_sentences, common_grams, text_profile_signature, high_freq_terms, uniq_field_values, field_stats, lang_profile, lang_identify, profile_distance, language_field, search_terms, search_phrase, search_per_site, search_top, search_filters, index_prune, index_config, summaries, index_assembly, custom_fields, segment_listing)}
SQL = {
    "tokenize": f"select doc_id, array_to_string({_TOK}, ' ') as tokens from documents",
    "tokenize_sentences": r"""with s as (select doc_id, list_filter(list_transform(string_split_regex(text, '[.!?]+\s+'), lambda x: trim(x)), lambda x: length(x) > 0) as s, list_filter(string_split_regex(text, '\n\s*\n'), lambda x: length(trim(x)) > 0) as p from documents)
select doc_id, len(s) as sentences, md5(array_to_string(s, '|')) as digest, len(p) as paragraphs from s""",
    "common_grams": f"with t as (select doc_id, {_TOK} as w from documents) select doc_id, array_to_string(list_filter(list_transform(range(1, len(w)), lambda i: case when w[i] in ('the', 'of', 'de', 'la') or w[i + 1] in ('the', 'of', 'de', 'la') then w[i] || '-' || w[i + 1] end), lambda x: x is not null), ' ') as grams from t",
    "text_profile_signature": r"""with w as (select doc_id, t, count(*) as c from (select doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]{3,}')) as t from documents) group by all), m as (select *, max(c) over (partition by doc_id) as m from w),
q as (select *, case when round(m * 0.01) < 2 then (case when m > 1 then 2 else 1 end) else round(m * 0.01) end as q from m), k as (select doc_id, t, cast(floor(c / q) * q as bigint) as k from q where floor(c / q) * q >= q),
p as (select doc_id, string_agg(t || ' ' || k, chr(10) order by k desc, t) as profile from k group by 1) select doc_id, coalesce(profile, '') as profile, md5(coalesce(profile, text)) as signature from documents left join p using (doc_id)""",
    "high_freq_terms": f"select term, count(*) as docs from (select doc_id, unnest(list_distinct({_TOK})) as term from documents) group by 1 having count(*) >= 20",
    "uniq_field_values": "select distinct source, lang from documents",
    "field_stats": "select count(*) as docs, count(text) as with_text, count(distinct lang) as langs, count(distinct source) as sources from documents",
    "lang_profile": f"with {_PROFILE(1000)} select lang, gram, round(freq, 9) as freq from prof",
    "lang_identify": f"with {_PROFILE(1000)}, g as (select doc_id, gram, count(*) as c from ({_GRAMS.format(key='doc_id')}) group by all), s as (select doc_id, gram, c / sum(c) over (partition by doc_id) as own from g), x as (select doc_id, lang, round(sum(own + freq), 9) as score from s join prof using (gram) group by all) select doc_id, lang as guess, round(score, 6) as score from x qualify row_number() over (partition by doc_id order by score desc, lang) = 1",
    "profile_distance": f"with {_PROFILE(1000)}, names as (select distinct lang from prof), pairs as (select x.lang as a, y.lang as b from names x join names y on x.lang < y.lang), grams as (select distinct gram from prof) select a, b, round(sum(abs(coalesce(p.freq, 0) - coalesce(q.freq, 0))), 6) as distance from pairs cross join grams left join prof p on p.lang = a and p.gram = grams.gram left join prof q on q.lang = b and q.gram = grams.gram group by all",
    "language_field": """select page_id, coalesce(case when page_id % 3 > 0 then nullif(lower(regexp_extract(html, '(?i)<html[^>]+lang=["'']([A-Za-z]{2})', 1)), '') end, case when page_id % 2 = 0 then 'xx' end, 'unknown') as lang from pages""",
    "search_terms": f"with {_POST}, hits as ({_HIT(0, 'example')}) {_SCORE(1)}",
    "search_phrase": f"with {_POST}, hits as (select a.doc_id, a.field, count(*) as tf, 1 as clause from post a join post b on a.doc_id = b.doc_id and a.field = b.field and b.pos = a.pos + 1 where a.term = 'of' and b.term = 'the' group by all), s as ({_SCORE(1)}) select * from s where doc_id not in (select doc_id from post where field = 'title' and term = 'der')",
    "search_per_site": f"with {_POST}, hits as ({_HIT(0, 'the', 'content')}), s as ({_SCORE(1)}) select doc_id, site, score, place from (select doc_id, site, score, row_number() over (partition by site order by score desc, doc_id) as place from s join (select page_id as doc_id, regexp_extract(lower(regexp_extract(url, '://([^/?#:]*)', 1)), '([^.]+\\.[^.]+)$', 1) as site from pages) using (doc_id)) where place <= 3",
    "search_top": f"with {_POST}, hits as ({_HIT(0, 'of', 'content')}) {_SCORE(1)} order by score desc, doc_id limit 10",
    "search_filters": "select page_id, d between '20140500000000' and '20140599999999' as may, d between '20140000000000' and '20150000000000' as years, d between '20140101000000' and '20140600000000' as half, suffix in ('com', 'org') as grouped from (select page_id, '2014' || lpad(cast(page_id % 12 + 1 as varchar), 2, '0') || '15000000' as d, regexp_extract(url, '://[^/?#:]*\\.([^/?#:.]+)', 1) as suffix from pages)",
    "index_prune": f"with {_POST} select doc_id, count(*) as tokens from post where doc_id not in (select doc_id from post where (field = 'content' and term = 'der') or (field = 'host' and term = 'm')) group by 1",
    "index_config": "select doc_id, lang as language, lower(source) as source, 'web' as collection from documents",
    "index_assembly": rf"""with {_A}, i as (select to_url as url, count(*) as inlinks from l group by 1) select p.url, {_TITLE} as title, 's' || (page_id % 4) as segment, md5(html) as signature, page_id % 6 + 1 as status, page_id * 10 as fetched, coalesce(inlinks, 0) as inlinks,
length({_TEXT}) as text_length from pages p left join i on p.url = i.url where not contains(p.url, 'ref=') and regexp_matches(html, '(?is)<title[^>]*>.*?</title>')""",
    "custom_fields": "select url, 'tag' as name, url as content, round(case when page_id % 2 = 0 then page_id / 4 else 0 end, 6) as score from pages where starts_with(url, 'https')",
    "segment_listing": "select 'seg' || (page_id % 3) as segment, case when page_id % 2 = 0 then 'content' else 'parse_text' end as part, count(*) as n, min(url) as first_key, max(url) as last_key from pages group by all",
}
