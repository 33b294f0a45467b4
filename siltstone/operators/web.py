"""What a page's HTML says, by built-in functions and by parsers where a tree is needed."""

from __future__ import annotations

import html as _html
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text_parts import unescape
from ..functions.urls import host, let, without_dots


#: Tags with links and the attribute that holds them.
LINKS = {"a": "href", "area": "href", "form": "action", "frame": "src", "iframe": "src", "script": "src", "link": "href", "img": "src"}


def _collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


_VALUE = r"""\s*=\s*(?:"([^">]*)"|'([^'>]*)'|([^\s"'>]+))"""
#: A tag with the attribute that holds its link, and the value.
_LINK = "(?is)^<(?:" + "|".join(rf"""{tag}(?=[\s/])[^>]*?[\s/"']{attribute}""" for tag, attribute in LINKS.items()) + ")" + _VALUE


def _value(tag: Column, pattern: str) -> Column:
    """The value that a pattern with _VALUE finds in a tag, references decoded; empty if it finds none."""
    return F.trim(unescape(F.concat(*(F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)))))


def title(html: Column) -> Column:
    """The first title, references decoded, white space collapsed."""
    return _collapsed(unescape(F.regexp_extract(html, r"(?is)<title(?:\s[^>]*)?>(.*?)</title>", 1)))


def base(html: Column) -> Column:
    """The base address, empty if none."""
    return _value(F.regexp_extract(html, r"(?is)<base\s[^>]*>", 0), r"""(?is)[\s/"']href""" + _VALUE)


def text(html: Column) -> Column:
    """Text without scripts, styles, comments and tags, character references decoded, white space collapsed."""
    bare = F.regexp_replace(html, r"(?is)<script(?:\s[^>]*)?>.*?</script>|<style(?:\s[^>]*)?>.*?</style>|<!--.*?-->", " ")
    return _collapsed(unescape(F.regexp_replace(bare, r"(?s)<[^>]*>", " ")))


def outlinks(pages: DataFrame, use_form_action: bool = False) -> DataFrame:
    """page_id, url, pos, tag, href, anchor of the links of a, area, frame, iframe, script, link and img tags, and of
    forms if so asked, in page order; pos counts link tags. nofollow pages and links, and forms that post, have none.

    The anchor of an a tag is its text up to the next a tag or its end; one with nothing inside is no link. A tag ends at
    its first `>`. Comments and the code of scripts hold no links. A null page has none.
    """
    html = F.regexp_replace(F.regexp_replace("html", r"(?s)<!--.*?-->", ""), r"(?is)(<script(?:\s[^>]*)?>).*?(</script)", "$1$2")
    names = "|".join(n for n in LINKS if use_form_action or n != "form")
    found = F.regexp_extract_all(html, F.lit(rf"(?i)<(?:{names})(?=[\s/>])[^>]*>"), F.lit(0))
    found = F.filter(found, lambda t: F.rlike(t, F.lit(r"(?i)^<a[\s/>]|[\s/\"'](?:href|src|action)\s*=")))
    tags = F.transform(found, lambda t, i: F.struct(i.cast("bigint").alias("pos"), t.alias("tag")))
    anchors = F.regexp_extract_all(html, F.lit(r"(?is)<a(?=[\s/>])[^>]*>(.*?)(?=<a[\s/>]|</a\s*>|$)"), F.lit(1))
    is_a = lambda t: F.rlike(t["tag"], F.lit(r"(?i)^<a[\s/>]"))
    with_text = F.zip_with(F.filter(tags, is_a), anchors, lambda t, inside: F.struct(t["pos"].alias("pos"), t["tag"].alias("tag"), inside.alias("inside")))
    plain = F.transform(F.filter(tags, lambda t: ~is_a(t)), lambda t: F.struct(t["pos"].alias("pos"), t["tag"].alias("tag"), F.lit("-").alias("inside")))
    rows = pages.where(~F.coalesce(robots(F.col("html"))["nofollow"], F.lit(False))).select("page_id", "url", F.explode(F.concat(with_text, plain)).alias("l"))
    tag, name = F.col("l.tag"), F.lower(F.regexp_extract("l.tag", "^<([A-Za-z]+)", 1))
    no_follow = F.rlike(tag, F.lit(r"""(?i)[\s/"']rel\s*=\s*["']?nofollow["'\s/>]"""))
    posts = (name == "form") & F.rlike(tag, F.lit(r"""(?i)[\s/"']method\s*=\s*["']?post["'\s/>]"""))
    kept = rows.where(F.rlike(tag, F.lit(_LINK)) & ~no_follow & ~posts & (F.length("l.inside") > 0))
    anchor = F.when(name == "a", _collapsed(unescape(F.regexp_replace("l.inside", r"(?s)<[^>]*>", " ")))).otherwise("")
    return kept.select("page_id", "url", F.col("l.pos").alias("pos"), name.alias("tag"), _value(tag, _LINK).alias("href"), anchor.alias("anchor"))


def resolve(url: Column, href: Column) -> Column:
    """The absolute address of a link on the page `url` (or its base address), by the rules of RFC 3986: 5.2.

    Decided otherwise than by some crawlers: parameters (`;x`) of the page's address are part of its last segment, and a
    link of a query alone keeps that segment.
    """
    page = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?"
    parts = F.struct(*(F.regexp_extract(url, page, i).alias(n) for i, n in ((1, "scheme"), (2, "host"), (3, "path"), (4, "query"))), *(F.regexp_extract(href, r"^(//[^/?#]*)?([^?#]*)(.*)$", i).alias(n) for i, n in ((1, "to_host"), (2, "to"), (3, "rest"))))

    def joined(p: Column) -> Column:
        root = F.concat(p["scheme"], F.lit(":"), p["host"])
        merged = F.when(F.startswith(p["to"], F.lit("/")), p["to"]).otherwise(F.concat(F.regexp_replace(F.regexp_replace(p["path"], "^$", "/"), "[^/]*$", ""), p["to"]))
        same = (p["to_host"] == "") & (p["to"] == "")
        path = F.when(same, p["path"]).when(p["to_host"] != "", p["to"]).otherwise(merged)
        query = F.when(same & ~F.startswith(p["rest"], F.lit("?")), p["query"]).otherwise("")
        return F.concat(F.when(p["to_host"] != "", F.concat(p["scheme"], F.lit(":"), p["to_host"])).otherwise(root), F.when(same, path).otherwise(without_dots(path)), query, p["rest"])

    return F.when(F.rlike(href, F.lit("^[A-Za-z][A-Za-z0-9+.-]*:")), href).otherwise(let(parts, joined))


def outlink_policy(links: DataFrame, cap: int = 100, external_only: bool = False) -> DataFrame:
    """page_id, pos, to_url, anchor: no link to the page itself, none inside the host if so asked, at most `cap` by
    page in order of place. The cap is a setting of the crawler. Links go from the column base, if there is one with a
    value, else from url."""
    start = F.coalesce(F.nullif(F.col("base"), F.lit("")), F.col("url")) if "base" in links.columns else F.col("url")
    out = links.withColumn("to_url", resolve(start, F.col("href"))).where(F.col("to_url") != F.col("url"))
    if external_only:
        out = out.where(host(F.col("to_url")) != host(F.col("url")))
    return out.withColumn("n", F.row_number().over(W.partitionBy("page_id").orderBy("pos"))).where(F.col("n") <= cap).select("page_id", "pos", "to_url", F.substring("anchor", 1, 100).alias("anchor"))


def meta(html: Column, name: str) -> Column:
    """The content of a meta tag by its name or http-equiv, empty if none."""
    return F.regexp_extract(html, rf"""(?is)<meta[^>]+(?:name|http-equiv)=["']{name}["'][^>]*content=["']([^"']*)["']""", 1)


def robots(html: Column) -> dict[str, Column]:
    """P5: noindex, nofollow, noarchive, no_cache flags, the refresh as it stands, its seconds (null if none) and target."""
    said = F.lower(meta(html, "robots"))
    none = F.contains(said, F.lit("none"))
    has = lambda w: none | F.contains(said, F.lit(w))
    refresh = meta(html, "refresh")
    return {
        "noindex": has("noindex"),
        "nofollow": has("nofollow"),
        "noarchive": has("noarchive"),
        "no_cache": F.contains(F.lower(meta(html, "pragma")), F.lit("no-cache")),
        "refresh": refresh,
        "refresh_seconds": F.regexp_extract(refresh, r"^\s*(\d+)", 1).try_cast("int"),
        "refresh_url": F.regexp_extract(refresh, r"(?i);\s*url\s*=\s*['\"]?([^'\"]*)", 1),
    }


def language(html: Column) -> Column:
    """The lang attribute, else dc.language, else content-language; null if none."""
    attribute = F.regexp_extract(html, r"""(?i)<html[^>]+lang=["']([A-Za-z]{2})""", 1)
    first = lambda c: F.lower(F.when(c != "", F.substring(c, 1, 2)))
    return F.coalesce(first(attribute), first(meta(html, "dc.language")), first(meta(html, "content-language")))


def licence(html: Column) -> Column:
    """The licence address in embedded RDF, else of a rel link, else of any link; null if none."""
    where = (r"""(?i)<license[^>]+rdf:resource=["']([^"']+)["']""", r"""(?i)rel=["']license["'][^>]*href=["']([^"']+)["']""", r"""(?i)href=["'](https?://(?:www\.)?creativecommons\.org/licenses/[^"']+)["']""")
    return F.coalesce(*(F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in where))


def rel_tags(html: Column) -> Column:
    """Last path segments of rel=tag links, sorted."""
    links = F.regexp_extract_all(html, F.lit(r"""(?i)<a[^>]+rel=["']tag["'][^>]*href=["']([^"']+)["']"""), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(links, lambda x: F.regexp_extract(x, r"([^/]+)/?$", 1))))


def urls_in_text(content: Column) -> Column:
    """Addresses in plain text."""
    return F.regexp_extract_all(content, F.lit(r"(?:https?|ftp|file)://[A-Za-z0-9$_.+!*'(),;/?:@&~=%#-]+"), F.lit(0))


def urls_in_script(code: Column) -> Column:
    """Quoted strings that look like addresses."""
    return F.regexp_extract_all(code, F.lit(r"""["']((?:https?://|/)[^"'\s<>\\]+)["']"""), F.lit(1))


def scripts(html: Column) -> Column:
    """The code of a page's script tags, joined."""
    return F.array_join(F.regexp_extract_all(html, F.lit(r"(?is)<script[^>]*>(.*?)</script>"), F.lit(1)), "\n")


def parser_for(kind: Column) -> Column:
    """The parser of a media type; unknown types are text if they are text, else none."""
    return F.when(kind.isin("text/html", "application/xhtml+xml"), "html").when(kind.contains("rss") | kind.contains("atom"), "feed").when(kind.contains("javascript"), "script").when(F.startswith(kind, F.lit("text/")), "text").otherwise("none")


def in_collection(value: Column, white: list[str], black: list[str]) -> Column:
    """no blacklisted part and a whitelisted one."""
    any_of = lambda words: F.exists(F.array(*map(F.lit, words)), lambda w: F.contains(value, w)) if words else F.lit(False)
    return F.when(any_of(black), False).otherwise(any_of(white))


class _Paragraphs(HTMLParser):
    """Paragraphs with their length, linked length and text."""

    BREAKS = {"p", "div", "td", "li", "h1", "h2", "h3", "h4", "h5", "h6", "br", "article", "section", "nav", "header", "footer", "table", "tr", "ul", "ol", "body"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.now, self.linked, self.skip, self.link = [], [], 0, 0, 0

    def flush(self):
        words = " ".join("".join(self.now).split())
        if words:
            self.out.append((words, self.linked))
        self.now, self.linked = [], 0

    def handle_starttag(self, tag, attrs):
        self.skip += tag in ("script", "style", "noscript")
        self.link += tag == "a"
        if tag in self.BREAKS:
            self.flush()

    def handle_endtag(self, tag):
        self.skip -= tag in ("script", "style", "noscript") and self.skip > 0
        self.link -= tag == "a" and self.link > 0
        if tag in self.BREAKS:
            self.flush()

    def handle_data(self, data):
        if not self.skip:
            self.now.append(data)
            self.linked += len(data.strip()) * bool(self.link)


def main_text(page: str, stop_words: frozenset[str], max_link: float = 0.3, short: int = 70, stops: float = 0.1) -> str | None:
    """Paragraphs that are long enough, little linked and have stop words, joined by line ends; none: null."""
    tree = _Paragraphs()
    tree.feed(page or "")
    tree.flush()
    good = []
    for words, linked in tree.out:
        parts = words.lower().split()
        density = sum(w.strip(".,") in stop_words for w in parts) / max(1, len(parts))
        if linked <= max_link * len(words) and len(words) >= short and density >= stops:
            good.append(_html.unescape(words))
    return "\r\n".join(good) or None


def main_text_column(html: Column, stop_words: list[str]) -> Column:
    """P6 as a vectorised function of a column."""
    words = frozenset(stop_words)

    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: main_text(p, words))

    return run(html)
