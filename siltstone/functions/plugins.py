"""Extension points: a registry of named column and table functions.

Kinds are parser, html_filter, url_filter, url_normalizer, indexing_filter, field_filter, query_filter, scoring_filter,
analyzer, summarizer, annotator. A chain applies the chosen ones of a kind in order, as columns, so that Catalyst sees
one expression.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text_parts import feed_entries, stem_light

_KINDS = ("parser", "html_filter", "url_filter", "url_normalizer", "indexing_filter", "field_filter", "query_filter", "scoring_filter", "analyzer", "summarizer", "annotator")
_registry: dict[str, dict[str, Callable]] = {k: {} for k in _KINDS}


def register(kind: str, name: str, function: Callable) -> None:
    """Add a function; a name of a kind can be given anew."""
    if kind not in _registry:
        raise ValueError(f"no such extension point: {kind}")
    _registry[kind][name] = function


def chosen(kind: str, include: str = ".*", order: list[str] | None = None) -> list[Callable]:
    """The functions of a kind whose names match a pattern: listed ones first, then by name."""
    names = [n for n in _registry[kind] if re.fullmatch(include, n)]
    listed = [n for n in order or [] if n in names]
    return [_registry[kind][n] for n in [*listed, *sorted(set(names) - set(listed))]]


def filter_chain(kind: str, value: Column, **choice) -> Column:
    """True where all chosen filters accept."""
    out = F.lit(True)
    for f in chosen(kind, **choice):
        out = out & f(value)
    return out


def transform_chain(kind: str, value: Column, **choice) -> Column:
    """The value after all chosen functions."""
    for f in chosen(kind, **choice):
        value = f(value)
    return value


def parse_by_type(content: Column, mime: Column) -> Column:
    """The parser named like the media type, by a chain of conditions; null if there is none."""
    out = None
    for name, parser in sorted(_registry["parser"].items()):
        out = F.when(mime == name, parser(content)) if out is None else out.when(mime == name, parser(content))
    return out if out is not None else F.lit(None).cast("string")


register("parser", "application/rss+xml", lambda c: F.array_join(F.transform(feed_entries(c), lambda e: F.concat_ws(" ", e["title"], e["link"])), "\n"))
register("parser", "text/plain", lambda c: c)
register("analyzer", "light", stem_light)
