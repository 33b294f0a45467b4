"""Queries over pages and URLs, and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import urls as U
from ..operators import web as P
from ..tables import table

RULES = [(False, "^(file|ftp|mailto):"), (False, r"\.(gif|jpg|png|css|zip)$"), (False, "[*!@]"), (True, "example")]
PREFIXES = ["http://", "https://m."]
SUFFIXES = ["#top", "x", "5"]
DOMAINS = ["example.com", "net"]

_DATE = lambda: F.concat(F.lit("20160101"), *(F.lpad((F.col("page_id") % m).cast("string"), 2, "0") for m in (24, 60, 59)))


def _pages(spark, sf):
    return table(spark, sf, "pages")


def _messy(spark, sf):
    """Every URL in a form that the normalisers change."""
    u = F.col("url")
    messy = F.concat(F.lit(" "), F.upper(F.regexp_extract(u, "^([a-z]+)://", 1)), F.lit("://"), F.upper(U.part(u, "authority")), F.when(F.startswith(u, F.lit("https")), ":443").otherwise(":8080"), F.lit("/a/../x//b/./../c/../"), F.regexp_replace(U.part(u, "path"), "^/", ""), F.lit("?&q=1&&jsessionid=ab12&z=2#frag "))
    return _pages(spark, sf).select("page_id", messy.alias("raw"))


def page_key(spark, sf):
    k = U.page_key(F.col("url"), _DATE())
    return _pages(spark, sf).select("page_id", k.alias("key"), U.short_key(k).alias("short_key"))


def url_parts(spark, sf):
    u = F.col("url")
    return _pages(spark, sf).select("page_id", U.host(u).alias("host"), U.page(u).alias("page"), U.domain(u).alias("domain"), U.suffix(u).alias("suffix"), U.site(u).alias("site"), U.part(u, "query").alias("query"), U.part(u, "fragment").alias("fragment"))


def url_normalize_basic(spark, sf):
    return _messy(spark, sf).select("page_id", "raw", U.normalize_basic(F.col("raw")).alias("normal"))


def url_normalize_regex(spark, sf):
    return _messy(spark, sf).select("page_id", U.normalize_regex(F.trim("raw")).alias("normal"))


def url_filters(spark, sf):
    u = F.col("url")
    f = {
        "rules": U.first_rule(u, RULES),
        "not_denied": U.not_denied(u, [r".*\?.*ref=x", r"https://.*#top"]),
        "prefix": U.has_prefix(u, PREFIXES),
        "suffix_ok": U.suffix_filter(u, SUFFIXES, accept=True),
        "path_suffix": U.suffix_filter(u, ["5", "A"], path_only=True, ignore_case=True),
        "in_domain": U.in_domains(u, DOMAINS),
        "valid": U.is_valid(u),
    }
    return _pages(spark, sf).select("page_id", *(c.alias(n) for n, c in f.items()), U.all_of(f["rules"], f["prefix"], f["valid"]).alias("chain"))


def exclusion_triple(spark, sf):
    """pages whose (canonical url, digest, date) is not listed; the list holds every page of two domains."""
    pages = _pages(spark, sf).select("page_id", U.normalize_basic(F.col("url")).alias("canonical"), F.sha1(F.col("html").cast("binary")).alias("digest"), _DATE().alias("date14"))
    listed = pages.where(F.regexp_like("canonical", F.lit(r"\.(net|org)/"))).select("canonical", "digest", "date14")
    return pages.join(listed, ["canonical", "digest", "date14"], "left_anti").select("page_id", "canonical")


def status_filter(spark, sf):
    """events as fetches with a status; the parsed ranges all count."""
    status = F.element_at(F.array(*(F.lit(x) for x in (200, 206, 304, 404, 500, -1))), (F.col("event_id") % 6 + 1).cast("int"))
    rows = table(spark, sf, "events").select("event_id", status.alias("status"))
    return rows.where(U.status_in(F.col("status"), "200-299 304 unknown")).select("event_id", F.col("status").cast("bigint").alias("status"))


def subcollection(spark, sf):
    return _pages(spark, sf).select("page_id", P.in_collection(F.col("url"), ["/en", "/de"], ["?page", "example.org"]).alias("member"))


def html_fields(spark, sf):
    h = F.col("html")
    r = P.robots(h)
    return _pages(spark, sf).select("page_id", P.title(h).alias("title"), P.base(h).alias("base"), P.language(h).alias("lang"), P.licence(h).alias("licence"), F.array_join(P.rel_tags(h), ",").alias("tags"), *(r[k].alias(k) for k in ("noindex", "nofollow", "noarchive", "no_cache", "refresh")))


def html_text(spark, sf):
    return _pages(spark, sf).select("page_id", P.text(F.col("html")).alias("text"))


def html_outlinks(spark, sf):
    return P.outlinks(_pages(spark, sf)).select("page_id", "pos", "tag", "href", "anchor")


def html_outlinks_all_tags(spark, sf):
    """P4 over pages with one link tag of every kind more, quoted, unquoted and not to be followed; with base and resolution."""
    n = F.col("page_id").cast("string")
    more = F.concat(F.lit("<base href='../b/c?x'><area href='/ar"), n, F.lit("'><img src=pic.png alt='&lt;a&gt;'><a href=un/quoted?a=1&amp;b=2>un <i>quoted</i></a><iframe src='//cdn.x/../y/./z'></iframe><frame src='../z'><link rel='x' href='#top'><script src=\"?q=1\">'<a href=\"/no\">no</a>'</script><a href='/gone' rel=nofollow>gone</a><!-- <a href='/off'>off</a> --><form method=post action='/p'></form><form action='/g'>go</form><a href='/empty'></a><a href='/last'>last &copy;</a>"))
    pages = _pages(spark, sf).select("page_id", "url", F.concat(more, "html").alias("html"))
    links = P.outlinks(pages, use_form_action=True).join(pages.select("page_id", P.base(F.col("html")).alias("base")), "page_id")
    return links.where("pos < 13").select("page_id", "pos", "tag", "anchor", P.resolve(P.resolve(F.col("url"), F.col("base")), F.col("href")).alias("to_url"))


def outlink_policy(spark, sf):
    return P.outlink_policy(P.outlinks(_pages(spark, sf)), cap=100)


def text_urls(spark, sf):
    h = F.col("html")
    return _pages(spark, sf).select("page_id", F.array_join(P.urls_in_text(F.concat_ws(" ", "url", P.text(h))), " ").alias("urls"), F.array_join(P.urls_in_script(P.scripts(h)), " ").alias("script_urls"), P.scripts(h).alias("scripts"))


def mime_dispatch(spark, sf):
    kinds = F.element_at(F.array(*map(F.lit, ("text/html; charset=utf-8", "Application/XHTML+xml", "application/rss+xml", "text/javascript;x", "text/plain", "image/png"))), (F.col("page_id") % 6 + 1).cast("int"))
    m = U.mime(kinds)
    return _pages(spark, sf).select("page_id", m.alias("mime"), F.array_join(U.mime_terms(m), " ").alias("terms"), P.parser_for(m).alias("parser"))


def redirect_representative(spark, sf):
    """Every page as if it redirected to its host's root, by turns for good and for a while."""
    u = F.col("url")
    root = F.concat(U.part(u, "scheme"), F.lit("://www."), U.host(u), F.lit("/"))
    return _pages(spark, sf).select("page_id", U.choose_representative(u, root, F.col("page_id") % 2 == 0).alias("shown"))


def main_text(spark, sf):
    return _pages(spark, sf).select("page_id", P.main_text_column(F.col("html"), ["the", "of", "and", "de", "la", "der", "die", "en", "el", "que", "is", "in"]).alias("body"))


_P = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_HOST = f"lower(regexp_replace(regexp_replace(regexp_extract(url, '{_P}', 2), '^.*@', ''), ':\\d*$', ''))"
_D14 = "'20160101' || lpad(cast(page_id % 24 as varchar), 2, '0') || lpad(cast(page_id % 60 as varchar), 2, '0') || lpad(cast(page_id % 59 as varchar), 2, '0')"
_RAW = f"select page_id, ' ' || upper(regexp_extract(url, '{_P}', 1)) || '://' || upper(regexp_extract(url, '{_P}', 2)) || case when starts_with(url, 'https') then ':443' else ':8080' end || '/a/../x//b/./../c/../' || regexp_replace(regexp_extract(url, '{_P}', 3), '^/', '') || '?&q=1&&jsessionid=ab12&z=2#frag ' as raw from pages"
_DECODED = lambda x: f"replace(replace(replace(replace({x}, '&middot;', '·'), '&copy;', '©'), '&quot;', '\"'), '&amp;', '&')"  # noqa: E731  the references that occur
_TITLE = rf"trim(regexp_replace({_DECODED("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")}, '\s+', ' ', 'g'))"
_TEXT = r"trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"
_TEXT = _DECODED(_TEXT)
_META = lambda n: rf"""regexp_extract(html, '(?is)<meta[^>]+(?:name|http-equiv)=["'']{n}["''][^>]*content=["'']([^"'']*)["'']', 1)"""
_LINKS = rf"""links as (select page_id, url, i - 1 as pos, tags[i] as tag from (select page_id, url, regexp_extract_all(html, '(?is)<a[^>]+href=["''][^"'']*["''][^>]*>.*?</a>') as tags from pages where not regexp_matches(lower({_META('robots')}), 'none|nofollow')) p, range(1, 100000) r(i) where i <= len(tags)),
outl as (select page_id, url, pos, {_DECODED("""regexp_extract(tag, '(?is)href=["'']([^"'']*)["'']', 1)""")} as href, trim(regexp_replace({_DECODED("regexp_replace(tag, '(?s)<[^>]*>', ' ', 'g')")}, '\s+', ' ', 'g')) as anchor from links)"""
_SCRIPTS = "array_to_string(regexp_extract_all(html, '(?is)<script[^>]*>(.*?)</script>', 1), chr(10))"

QUERIES = {f.__name__: f for f in (page_key, url_parts, url_normalize_basic, url_normalize_regex, url_filters, exclusion_triple, status_filter, subcollection, html_fields, html_text, html_outlinks, html_outlinks_all_tags, outlink_policy, text_urls, mime_dispatch, redirect_representative, main_text)}
SQL = {
    "page_key": f"select page_id, proto || '::' || host || '::' || path || '::' || q || '::' || d as key, host || '::' || path || '::' || d as short_key from (select page_id, lower(regexp_extract(url, '{_P}', 1)) as proto, {_HOST} as host, regexp_extract(url, '{_P}', 3) as path, case when contains(url, '?') then regexp_extract(url, '{_P}', 4) else 'null' end as q, {_D14} as d from pages)",
    "url_parts": f"select page_id, host, lower(regexp_replace(url, '[?#].*$', '')) as page, regexp_extract(host, '([^.]+\\.[^.]+)$', 1) as domain, regexp_extract(host, '\\.([^.]+)$', 1) as suffix, regexp_replace(host, '^www\\.', '') as site, regexp_extract(url, '{_P}', 4) as query, regexp_extract(url, '{_P}', 5) as fragment from (select page_id, url, {_HOST} as host from pages)",
    "url_normalize_basic": f"""with m as ({_RAW}) select page_id, raw, lower(regexp_extract(trim(raw), '{_P}', 1)) || '://' || lower(regexp_replace(regexp_extract(trim(raw), '{_P}', 2), ':\\d+$', '')) || case when ends_with(regexp_extract(trim(raw), '{_P}', 2), ':443') then '' else ':8080' end
|| regexp_replace(regexp_extract(trim(raw), '{_P}', 3), '^/a/\\.\\./x//b/\\./\\.\\./c/\\.\\./', '/x/b/./../') || '?' || regexp_extract(trim(raw), '{_P}', 4) as normal from m""",
    "url_normalize_regex": f"with m as ({_RAW}) select page_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(raw), 'jsessionid=[^?&#]*', '', 'g'), '#[^?&]*', '', 'g'), '\\?&', '?', 'g'), '&{{2,}}', '&', 'g') as normal from m",
    "url_filters": f"""with f as (select page_id, url, not regexp_matches(url, '^(file|ftp|mailto):') and not regexp_matches(url, '\\.(gif|jpg|png|css|zip)$') and not regexp_matches(url, '[*!@]') and contains(url, 'example') as rules,
not regexp_full_match(url, '.*\\?.*ref=x|https://.*#top') as not_denied, starts_with(url, 'http://') or starts_with(url, 'https://m.') as prefix, not (ends_with(url, '#top') or ends_with(url, 'x') or ends_with(url, '5')) as suffix_ok,
regexp_matches(lower(regexp_extract(url, '{_P}', 3)), '[5a]$') as path_suffix, regexp_matches({_HOST}, '(^|\\.)example\\.com$|\\.net$') as in_domain,
regexp_matches(url, '^(https?|ftp|file)://([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\\.)+[A-Za-z]{{2,}}(:\\d{{1,5}})?(/[A-Za-z0-9:@&=+,.!/~*''%$_;()-]*)?(\\?[^#\\s]*)?(#.*)?$') as valid from pages)
select page_id, rules, not_denied, prefix, suffix_ok, path_suffix, in_domain, valid, rules and prefix and valid as chain from f""",
    "exclusion_triple": f"select page_id, canonical from (select page_id, lower(regexp_extract(url, '{_P}', 1)) || '://' || {_HOST} || case when regexp_extract(url, '{_P}', 3) = '' then '/' else regexp_extract(url, '{_P}', 3) end || case when contains(regexp_replace(url, '#.*$', ''), '?') then '?' || regexp_extract(url, '{_P}', 4) else '' end as canonical from pages) where not regexp_matches(canonical, '\\.(net|org)/')",
    "status_filter": "select event_id, status from (select event_id, cast([200, 206, 304, 404, 500, -1][event_id % 6 + 1] as bigint) as status from events) where status between 200 and 299 or status in (304, -1)",
    "subcollection": "select page_id, not (contains(url, '?page') or contains(url, 'example.org')) and (contains(url, '/en') or contains(url, '/de')) as member from pages",
    "html_fields": rf"""select page_id, {_TITLE} as title, regexp_extract(html, '(?i)<base[^>]+href=["'']([^"'']*)["'']', 1) as base,
lower(coalesce(nullif(regexp_extract(html, '(?i)<html[^>]+lang=["'']([A-Za-z]{{2}})', 1), ''), nullif({_META('dc.language')}, ''), nullif({_META('content-language')}, ''))) as lang,
coalesce(nullif(regexp_extract(html, '(?i)<license[^>]+rdf:resource=["'']([^"'']+)["'']', 1), ''), nullif(regexp_extract(html, '(?i)rel=["'']license["''][^>]*href=["'']([^"'']+)["'']', 1), ''), nullif(regexp_extract(html, '(?i)href=["''](https?://(?:www\.)?creativecommons\.org/licenses/[^"'']+)["'']', 1), '')) as licence,
array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all(html, '(?i)<a[^>]+rel=["'']tag["''][^>]*href=["'']([^"'']+)["'']', 1), lambda x: regexp_extract(x, '([^/]+)/?$', 1)))), ',') as tags,
regexp_matches(lower({_META('robots')}), 'none|noindex') as noindex, regexp_matches(lower({_META('robots')}), 'none|nofollow') as nofollow, regexp_matches(lower({_META('robots')}), 'none|noarchive') as noarchive, contains(lower({_META('pragma')}), 'no-cache') as no_cache, {_META('refresh')} as refresh from pages""",
    "html_text": f"select page_id, {_TEXT} as text from pages",
    "html_outlinks": f"with {_LINKS} select page_id, pos, 'a' as tag, href, anchor from outl",
    "html_outlinks_all_tags": f"""with {_LINKS}, u as (select page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) as root, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) as path from pages where not regexp_matches(lower({_META("robots")}), 'none|nofollow')),
b as (select page_id, root, case when len(s) > 3 then array_to_string(s[1:len(s) - 2], '/') || '/b/' else '/b/' end as folder from (select page_id, root, string_split(case when path = '' then '/' else path end, '/') as s from u)),
m as (select page_id, unnest([0, 1, 2, 3, 4, 5, 6, 9, 11]) as pos, unnest(['area', 'img', 'a', 'iframe', 'frame', 'link', 'script', 'form', 'a']) as tag, unnest(['', '', 'un quoted', '', '', '', '', '', 'last ©']) as anchor,
unnest([root || '/ar' || page_id, root || folder || 'pic.png', root || folder || 'un/quoted?a=1&b=2', split_part(root, ':', 1) || '://cdn.x/y/z', root || regexp_replace(folder, 'b/$', '') || 'z', root || folder || 'c?x#top', root || folder || 'c?q=1', root || '/g', root || '/last']) as to_url from b)
select page_id, cast(pos as bigint) as pos, tag, anchor, to_url from m union all select page_id, pos + 12, 'a', anchor, root || href from outl join b using (page_id) where pos + 12 < 13""",
    "outlink_policy": f"with {_LINKS} select page_id, pos, to_url, anchor[:100] as anchor from (select page_id, pos, case when starts_with(href, '/') then regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || href else href end as to_url, anchor, url from outl) where to_url <> url qualify row_number() over (partition by page_id order by pos) <= 100",
    "text_urls": rf"""select page_id, array_to_string(regexp_extract_all(url || ' ' || {_TEXT}, '(?:https?|ftp|file)://[A-Za-z0-9$_.+!*''(),;/?:@&~=%#-]+'), ' ') as urls, array_to_string(regexp_extract_all({_SCRIPTS}, '["'']((?:https?://|/)[^"''\s<>\\]+)["'']', 1), ' ') as script_urls, {_SCRIPTS} as scripts from pages""",
    "mime_dispatch": """select page_id, mime, mime || ' ' || split_part(mime, '/', 1) || ' ' || split_part(mime, '/', 2) as terms, case when mime in ('text/html', 'application/xhtml+xml') then 'html' when contains(mime, 'rss') then 'feed' when contains(mime, 'javascript') then 'script' when starts_with(mime, 'text/') then 'text' else 'none' end as parser
from (select page_id, ['text/html', 'application/xhtml+xml', 'application/rss+xml', 'text/javascript', 'text/plain', 'image/png'][page_id % 6 + 1] as mime from pages)""",
    "redirect_representative": f"""select page_id, case when path in ('', '/') then url else root end as shown
from (select page_id, url, regexp_extract(url, '{_P}', 3) as path, regexp_extract(url, '{_P}', 1) || '://www.' || {_HOST} || '/' as root from pages)""",
}
