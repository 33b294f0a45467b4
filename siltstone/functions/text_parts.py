"""Feeds, stems, hex and keys."""

from __future__ import annotations

import json
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Character references by name: those of HTML 4 and the apostrophe.
NAMED = {**name2codepoint, "apos": 39}
_REFERENCE = r"&(?:#\d{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]*);|&|[^&]+"


def _element(xml: Column, name: str) -> Column:
    """Trimmed text of the first element of a name, CDATA opened; empty if none."""
    raw = F.regexp_extract(xml, rf"(?is)<{name}(?:\s[^>]*)?>(.*?)</{name}>", 1)
    return F.trim(F.regexp_replace(raw, r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1"))


def feed_entries(xml: Column) -> Column:
    """Title, link and text of each item or entry of a feed."""
    items = F.regexp_extract_all(xml, F.lit(r"(?is)<(item|entry)(?:\s[^>]*)?>.*?</\1>"), F.lit(0))

    def entry(x: Column) -> Column:
        link = _element(x, "link")
        body = F.coalesce(F.nullif(_element(x, "description"), F.lit("")), F.nullif(_element(x, "summary"), F.lit("")), _element(x, "content"))
        return F.struct(_element(x, "title").alias("title"), F.when(link == "", F.regexp_extract(x, r"""(?i)<link[^>]+href=["']([^"']*)["']""", 1)).otherwise(link).alias("link"), body.alias("body"))

    return F.transform(items, entry)


def stem_light(tokens: Column) -> Column:
    """Tokens without a plural or case ending of up to three letters, if four letters stay. External stemmers take its place by the registry."""
    return F.transform(tokens, lambda t: F.regexp_replace(t, r"(?<=\p{L}{4})(?:ern|em|er|en|es|e|s)$", ""))


def to_hex(value: Column) -> Column:
    """Lower-case hex."""
    return F.lower(F.hex(value))


def from_hex(value: Column) -> Column:
    """The bytes of a hex text; null if it is none."""
    return F.try_to_binary(value, F.lit("hex"))


def sha1_base32(payload: Column) -> Column:
    """H4: sha1: and the base32 of the digest, from groups of 20 bits."""
    h = F.sha1(payload)
    digits = F.concat(*(F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)))
    return F.concat(F.lit("sha1:"), F.translate(digits, "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"))


def by_host(rows: DataFrame, host: Column, partitions: int, seed: int = 0) -> DataFrame:
    """H5: rows of a host together, where the seed says."""
    return rows.repartition(partitions, F.xxhash64(host, F.lit(seed)))


def link_score(initial: Column, score: Column, normalize: float = 1.0) -> dict[str, Column]:
    """Sort key and index score."""
    return {"sort_key": score * initial, "index_score": F.lit(normalize) * score}


def rank_norm(norm: Column, rank: Column) -> Column:
    """A length norm times the boost of a rank; ranks under one do not change it."""
    return norm * F.when(rank >= 1, F.log10(rank) + 1).otherwise(1.0)


def _character(code: Column) -> Column:
    """The character of a code point; U+FFFD if there is none."""
    valid = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).otherwise("\ufffd")


def unescape(text: Column) -> Column:
    """Text with its character references (named, decimal, hexadecimal; each ended by a semicolon) decoded once. Unknown
    names and lone ampersands stay; null stays null."""
    names = F.from_json(F.lit(json.dumps({name: chr(code) for name, code in NAMED.items()})), "map<string,string>")

    def one(part: Column) -> Column:
        inside = F.substr(part, F.lit(2), F.length(part) - 2)
        number = F.substr(inside, F.lit(2))
        hexa = F.conv(F.substr(number, F.lit(2)), 16, 10).cast("long")
        known = F.when(F.rlike(inside, F.lit("^#[xX]")), _character(hexa)).when(F.startswith(inside, F.lit("#")), _character(number.try_cast("long"))).otherwise(F.try_element_at(names, inside))
        return F.when(F.startswith(part, F.lit("&")) & F.endswith(part, F.lit(";")), F.coalesce(known, part)).otherwise(part)

    decoded = F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0)), one), "")
    return F.when(F.contains(text, F.lit("&")), decoded).otherwise(text)
