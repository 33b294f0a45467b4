"""Name functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Organisation types and their short forms.
ORG_TYPES = {"aktsiaselts": "as", "korteriühistu": "kü", "osaühing": "oü", "mittetulundusühing": "mtü", "sihtasutus": "sa"}
#: Tags of the exclusion table that exclude, and that give synonyms.
EXCLUDE_TAGS = ("event", "loc", "product", "nan", "famous_per", "famous_org")
SYNONYM_TAGS = ("synonym",)


def _unquoted(c: Column) -> Column:
    """Without runs of single, then double quotes at either end."""
    return F.regexp_replace(F.regexp_replace(c, "^'+|'+$", ""), '^"+|"+$', "")


def normalize_name(name: Column, drop_short: bool = False, org_types: bool = True) -> Column:
    """Lower-cased words without quotes; the short form of the last organisation type goes first.

    drop_short drops words of up to two characters and makes a result of up to two null. Inner double blanks stay
    unless words are dropped. Null stays null.
    """
    words = F.transform(F.split(_unquoted(name), " "), F.lower)
    types = F.lit(False)
    kind = F.lit(None).cast("string")
    if org_types:
        short = F.create_map(*(F.lit(x) for k, v in ORG_TYPES.items() for x in (k, v)), *(F.lit(x) for v in ORG_TYPES.values() for x in (v, v)))
        kind = F.try_element_at(F.filter(words, lambda w: F.try_element_at(short, w).isNotNull()), F.lit(-1))
        kind = F.try_element_at(short, kind)
        types = short
    keep = (lambda w: F.try_element_at(types, w).isNull()) if org_types else (lambda w: F.lit(True))
    body = F.filter(words, lambda w: keep(w) & (F.length(w) > 2) if drop_short else keep(w))
    text = F.trim(F.array_join(F.transform(body, _unquoted), " "))
    full = F.trim(F.when(kind.isNotNull(), F.concat(kind, F.lit(" "), text)).otherwise(text))
    return F.when(F.length(full) > 2, full) if drop_short else full


def alternatives(name: Column) -> Column:
    """Every reading of a name whose words list their forms with |, in order."""
    return F.aggregate(
        F.transform(F.split(name, " "), lambda w: F.split(w, r"\|")),
        F.array(F.lit("")),
        lambda done, forms: F.flatten(F.transform(done, lambda d: F.transform(forms, lambda f: F.when(d == "", f).otherwise(F.concat_ws(" ", d, f))))),
    )


def name_keys(name: Column) -> Column:
    """The distinct normalised readings, sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(alternatives(name), lambda x: normalize_name(x)), lambda x: x.isNotNull())))


def ngram_keys(name: Column, share: float = 0.8) -> Column:
    """T5: all substrings of at least floor(share * length) characters, and the name; distinct, sorted."""
    n = F.length(name)
    least = F.greatest(F.floor(n * share).cast("int"), F.lit(1))
    of = lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(name, i, k))
    return F.when(n > 0, F.array_sort(F.array_distinct(F.flatten(F.transform(F.sequence(least, n), of))))).otherwise(F.array(name))


def without_subnames(names: Column) -> Column:
    """distinct upper-cased names in order, without those that a later one contains."""
    names = F.array_sort(F.array_distinct(F.transform(names, F.upper)))
    return F.filter(names, lambda x, i: ~F.exists(F.slice(names, i + 2, F.greatest(F.size(names), F.lit(1))), lambda y: F.contains(y, x)))


def nearest_distance(key: Column, forms: Column) -> Column:
    """Least edit distance to any of the forms."""
    return F.array_min(F.transform(forms, lambda f: F.levenshtein(key, f)))


def surface(text: Column, start: Column, end: Column) -> Column:
    """The text of a span."""
    return F.substring(text, start + 1, end - start)


def registry_date(text: Column) -> Column:
    """The zero date is null."""
    return F.nullif(text, F.lit("0000-00-00"))


def birth_date(code: Column) -> Column:
    """Dd.mm.yyyy of an 11-digit national code (its first digit tells the century) or a 13-character one with the
    full year; else null. F20: other lengths are not valid."""
    century = F.floor((F.substring(code, 1, 1).try_cast("int") - 1) / 2 + 18).cast("int").cast("string")
    short = F.concat_ws(".", F.substring(code, 6, 2), F.substring(code, 4, 2), F.concat(century, F.substring(code, 2, 2)))
    long = F.concat_ws(".", F.substring(code, 9, 2), F.substring(code, 7, 2), F.substring(code, 3, 4))
    return F.when(F.regexp_like(code, F.lit(r"^\d{11}$")), short).when(F.regexp_like(code, F.lit(r"^\d{2}\d{8}.{3}$")), long)


def valid_code(code: Column) -> Column:
    """eleven digits."""
    return F.coalesce(F.regexp_like(code, F.lit(r"^\d{11}$")), F.lit(False))


def row_hash(line: Column) -> Column:
    """H1: MD5 of a registry line."""
    return F.md5(line)


def key_line(*columns: Column) -> Column:
    """A comma-joined line."""
    return F.concat_ws(",", *columns)
