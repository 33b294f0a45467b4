"""URL functions and filters as Column expressions. Regular expressions only: any string is accepted."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
#: Default ports by scheme.
PORTS = {"http": "80", "https": "443", "ftp": "21"}
#: The substitutions of the regex normaliser, in order (session ids, fragments, stray separators), and the
#: optional one of default pages, which goes after the first.
SUBSTITUTIONS = (
    (r"([;_]?((?i)l|j|bv_)?((?i)sid|phpsessid|sessionid)=.*?)(\?|&|#|$)", "$4"),
    (r"#.*?(\?|&|$)", "$1"),
    (r"\?&", "?"),
    (r"&{2,}", "&"),
    (r"[\?&\.]$", ""),
)
DEFAULT_PAGES = (r"/((?i)index|default)\.((?i)js[pf]{1}?[afx]?|cgi|cfm|asp[x]?|[psx]?htm[l]?|php[3456]?)(\?|&|#|$)", "/$3")
#: Second labels that make a public suffix with a country's two letters; further suffixes are a parameter.
SECOND = "ac|co|com|edu|gob|go|gov|govt|gv|ltd|mil|ne|net|nom|or|org|plc|sch"


def part(url: Column, name: str) -> Column:
    """scheme, authority, path, query or fragment; empty where it is missing."""
    return F.regexp_extract(url, PARTS, {"scheme": 1, "authority": 2, "path": 3, "query": 4, "fragment": 5}[name])


def host(url: Column) -> Column:
    """Lower-cased host without user and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(part(url, "authority"), "^.*@", ""), r":\d*$", ""))


def page(url: Column) -> Column:
    """The lower-cased URL without query and fragment."""
    return F.lower(F.regexp_replace(url, r"[?#].*$", ""))


def _suffix_pattern(more: tuple[str, ...]) -> str:
    listed = "".join(rf"{re.escape(x)}|" for x in sorted(more, key=len, reverse=True))
    return rf"(?:{listed}(?:{SECOND})\.[a-z]{{2}}|[^.\d][^.]*)"


_NUMERIC = r"^(\d{1,3}\.){3}\d{1,3}$"


def domain(url: Column, more: tuple[str, ...] = ()) -> Column:
    """The label before the public suffix with it; a numeric host whole; what is only a suffix whole. more: further
    suffixes of several labels."""
    name = F.regexp_replace(host(url), r"\.$", "")
    return F.when(F.rlike(name, F.lit(_NUMERIC)), name).otherwise(F.regexp_extract(name, rf"(?:^|\.)((?:[^.]+\.)?{_suffix_pattern(more)})$", 1))


def suffix(url: Column, more: tuple[str, ...] = ()) -> Column:
    """The public suffix: the last label, or two where a country has second labels; empty for a numeric host."""
    name = F.regexp_replace(host(url), r"\.$", "")
    return F.when(F.rlike(name, F.lit(_NUMERIC)), "").otherwise(F.regexp_extract(name, rf"(?:^|\.)({_suffix_pattern(more)})$", 1))


def site(url: Column) -> Column:
    """The host without a leading www."""
    return F.regexp_replace(host(url), r"^www\.", "")


def page_key(url: Column, date14: Column) -> Column:
    """Scheme::host::path::query::date, the query "null" if there is none."""
    query = F.when(F.contains(url, F.lit("?")), part(url, "query")).otherwise("null")
    return F.concat_ws("::", F.lower(part(url, "scheme")), host(url), part(url, "path"), query, date14)


def short_key(key: Column) -> Column:
    """Host::path::date of a five-part key."""
    bits = F.split(key, "::")
    return F.concat_ws("::", bits[1], bits[2], bits[4])


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), where value is worked out once however often `use` mentions it, and is written once in the plan."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _fewer(segments: Column) -> Column:
    return F.slice(segments, 1, F.greatest(F.size(segments) - 1, F.lit(0)))


def _folded(path: Column, step: Callable[[Column, Column], Column], finish: Callable[[Column, Column], Column]) -> Column:
    """An absolute path whose segments but the last go through `step`; `finish` joins what is left and the last."""
    every = F.split(path, "/")
    none = F.array().cast("array<string>")
    return let(every, lambda e: finish(F.aggregate(F.slice(e, 2, F.greatest(F.size(e) - 2, F.lit(0))), none, step), F.element_at(e, -1)))


def without_dots(path: Column) -> Column:
    """A path without `.` and `..` segments, however nested (RFC 3986: 5.2.4)."""
    step = lambda done, s: F.when(s == "..", _fewer(done)).when(s == ".", done).otherwise(F.concat(done, F.array(s)))

    def finish(kept: Column, last: Column) -> Column:
        end = F.array(F.when(last.isin(".", ".."), "").otherwise(last))
        return F.concat(F.lit("/"), F.array_join(F.when(last == "..", F.concat(_fewer(kept), end)).otherwise(F.concat(kept, end)), "/"))

    return let(path, lambda p: F.when(F.startswith(p, F.lit("/")) & F.contains(p, F.lit("/.")), _folded(p, step, finish)).otherwise(p))


def _climbed(path: Column) -> Column:
    """A path without `x/../`, where x is more than dots, and without `/../` at its beginning."""
    real = lambda done: F.rlike(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit("")), F.lit("[^.]"))
    step = lambda done, s: F.when((s == "..") & (F.size(done) == 0), done).when((s == "..") & real(done), _fewer(done)).otherwise(F.concat(done, F.array(s)))
    finish = lambda kept, last: F.concat(F.lit("/"), F.array_join(F.concat(kept, F.array(last)), "/"))
    return let(path, lambda p: F.when(F.contains(p, F.lit("/../")), _folded(p, step, finish)).otherwise(p))


def normalize_basic(url: Column) -> Column:
    """Trimmed, scheme and host lower-cased, no default port, no fragment, a path, no `x/../` or double slash in it.

    `.` segments stay, and so does `/..` at the end. What is no URL stays but for the trimming.
    """
    text = F.regexp_replace(url, r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    scheme = F.lower(part(text, "scheme"))
    port = F.regexp_extract(part(text, "authority"), r":(\d+)$", 1)
    default = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in PORTS.items() for x in kv)), scheme), F.lit(""))
    path = F.regexp_replace(part(text, "path"), "^$", "/")
    path = _climbed(F.regexp_replace(path, "/{2,}", "/"))
    query = F.when(F.contains(F.regexp_replace(text, "#.*$", ""), F.lit("?")), F.concat(F.lit("?"), part(text, "query"))).otherwise("")
    full = F.concat(scheme, F.lit("://"), host(text), F.when((port == "") | (port == default), "").otherwise(F.concat(F.lit(":"), port)), path, query)
    return F.when(F.regexp_like(text, F.lit(PARTS)), full).otherwise(text)


def normalize_regex(url: Column, default_pages: bool = False) -> Column:
    """The substitutions, in order; default pages (index.html and such) are cut only if so asked."""
    rules = SUBSTITUTIONS[:1] + ((DEFAULT_PAGES,) if default_pages else ()) + SUBSTITUTIONS[1:]
    return reduce(lambda c, rule: F.regexp_replace(c, *rule), rules, url)


def first_rule(url: Column, rules: list[tuple[bool, str]]) -> Column:
    """the sign of the first rule whose pattern is found; none: rejected."""
    out = None
    for sign, pattern in rules:
        hit = F.regexp_like(url, F.lit(pattern))
        out = F.when(hit, F.lit(sign)) if out is None else out.when(hit, F.lit(sign))
    return out.otherwise(False) if out is not None else F.lit(False)


def not_denied(url: Column, denied: list[str]) -> Column:
    """no denying pattern matches the whole URL."""
    return ~F.regexp_like(url, F.lit("^(?:" + "|".join(denied) + ")$")) if denied else F.lit(True)


def has_prefix(url: Column, prefixes: list[str]) -> Column:
    """F6."""
    return reduce(lambda a, b: a | b, (F.startswith(url, F.lit(p)) for p in prefixes), F.lit(False))


def suffix_filter(url: Column, suffixes: list[str], accept: bool = False, path_only: bool = False, ignore_case: bool = False) -> Column:
    """accept says what becomes of a URL with none of the suffixes; one with a suffix gets the opposite."""
    target = F.regexp_extract(url, r"^[^:]+://[^/?#]*([^?#]*)", 1) if path_only else url
    target = F.lower(target) if ignore_case else target
    hit = reduce(lambda a, b: a | b, (F.endswith(target, F.lit(s.lower() if ignore_case else s)) for s in suffixes), F.lit(False))
    return ~hit if accept else hit


def in_domains(url: Column, names: list[str]) -> Column:
    """F8: suffix, domain or host is listed."""
    return suffix(url).isin(names) | domain(url).isin(names) | host(url).isin(names)


def is_valid(url: Column) -> Column:
    """scheme, dotted or numeric host, port, path and query by their alphabets; no empty or `..` segment that climbs out."""
    authority = part(url, "authority")
    name = F.regexp_like(authority, F.lit(r"^(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}(?::\d{1,5})?$"))
    octet = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
    numeric = F.regexp_like(authority, F.lit(rf"^(?:{octet}\.){{3}}{octet}(?::\d{{1,5}})?$"))
    path = F.regexp_like(part(url, "path"), F.lit(r"^(?:/[A-Za-z0-9:@&?=+,.!/~*'%$_;()-]*)?$")) & ~F.contains(part(url, "path"), F.lit("//"))
    query = F.regexp_like(part(url, "query"), F.lit(r"^\S*$"))
    return F.lower(part(url, "scheme")).isin("http", "https", "ftp", "file") & (name | numeric) & path & query


def all_of(*filters: Column) -> Column:
    """a chain accepts what every filter accepts."""
    return reduce(lambda a, b: a & b, filters, F.lit(True))


def status_ranges(text: str) -> list[tuple[int, int]]:
    """"200-299 304 unknown" as ranges; unknown is -1."""
    out = []
    for word in text.split():
        low, _, high = ("-1", "", "") if word == "unknown" else word.partition("-")
        out.append((int(low), int(high or low)))
    return out


def status_in(status: Column, text: str) -> Column:
    """within any of the ranges."""
    return reduce(lambda a, b: a | b, (status.between(*r) for r in status_ranges(text)), F.lit(False))


def choose_representative(source: Column, target: Column, temporary: Column) -> Column:
    """The URL that stands for a redirect: a permanent one's target unless that is no root in the same domain; a
    temporary one's source if it is a root or of another domain, else the shorter host wins."""
    root = lambda u: part(u, "path").isin("", "/")
    same = domain(source) == domain(target)
    dots = lambda u: F.length(host(u)) - F.length(F.replace(host(u), F.lit("."), F.lit("")))
    kept = F.when(~same, F.when(temporary, source).otherwise(target))
    kept = kept.when(~temporary, F.when(root(source), source).otherwise(target))
    kept = kept.when(root(source) & ~root(target), source).when(root(target) & ~root(source), target)
    return kept.when(dots(source) < dots(target), source).when(dots(source) > dots(target), target).when(F.length(source) <= F.length(target), source).otherwise(target)


def mime(kind: Column) -> Column:
    """The type before a semicolon."""
    return F.lower(F.trim(F.substring_index(kind, ";", 1)))


def mime_terms(kind: Column) -> Column:
    """The type and its two halves."""
    return F.array(kind, F.split(kind, "/")[0], F.split(kind, "/")[1])
