"""Keyword search over postings.

Query language: +required -prohibited field:term "a phrase" com-pound; anything else is required too.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .text import CJK, tokens

#: Fields that a plain term is looked for in, and their boosts.
FIELD_BOOSTS = {"url": 4.0, "anchor": 2.0, "content": 1.0, "title": 1.5, "host": 2.0}
#: Words that do not count when they stand alone, without field or sign.
STOP_WORDS = frozenset(
    (
        "a", "and", "are", "as", "at", "be", "but", "by",
        "for", "if", "in", "into", "is", "it",
        "no", "not", "of", "on", "or", "s", "such",
        "t", "that", "the", "their", "then", "there", "these",
        "they", "this", "to", "was", "will", "with",
    )
)
_TERM = rf"(?:(?:[^\W\d_]\.){{2,}}|[cC](?:\+\+|\#)|[{CJK}]|(?:(?![{CJK}])[\w&])+)"
#: An optional sign, an optional field, then a phrase (up to its quote or the end) or terms joined by infix characters.
_CLAUSE = re.compile(rf"""([+-])?(?:([\w&]+):)?(?:"([^"]*)(?:"|$)|({_TERM}(?:[-+:/.@']+{_TERM})*))""")
_EACH = re.compile(_TERM)


@dataclass(frozen=True)
class Clause:
    terms: tuple[str, ...]
    field: str = ""
    required: bool = True
    prohibited: bool = False


def parse(query: str) -> list[Clause]:
    """The clauses of a query, in order. Acronyms lose their dots, ideographs and kana are terms of their own, a quote
    that is not closed reaches to the end; lone signs and other characters are skipped."""
    out = []
    for sign, field, phrase, word in _CLAUSE.findall(query):
        terms = tuple(t.replace(".", "").lower() for t in _EACH.findall(phrase or word))
        if not terms or (len(terms) == 1 and not sign and not field and word and terms[0] in STOP_WORDS):
            continue
        out.append(Clause(terms, field.lower(), sign != "-", sign == "-"))
    return out


def canonical(clauses: list[Clause]) -> str:
    """The query again, in one form; what has no sign is required."""
    return " ".join(("-" if c.prohibited else "") + (f"{c.field}:" if c.field else "") + (f'"{" ".join(c.terms)}"' if len(c.terms) > 1 else c.terms[0]) for c in clauses)


def postings(docs: DataFrame, fields: dict[str, Column], parts: int = 16, salts: int = 8) -> DataFrame:
    """part, doc_id, field, term, positions, length: a row for each term of a field, with all its places and the field's length.

    A document's fields are read in one pass. One shuffle, by part (a hash of the term) and a salt of the document, so that a frequent term is no hot key; written
    with partitionBy("part"), a search reads the parts of its terms only. A null field has no postings; a repeated
    document's places are counted once.
    """
    each = F.array(*(F.struct(F.lit(f).alias("field"), c.alias("text")) for f, c in fields.items()))
    rows = docs.select("doc_id", F.explode(each).alias("f")).select("doc_id", "f.field", tokens(F.col("f.text")).alias("t")).select("doc_id", "field", F.size("t").alias("length"), F.posexplode("t").alias("pos", "term"))
    rows = rows.withColumn("part", _part(F.col("term"), parts)).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)))
    found = rows.repartition("part", "salt").groupBy("part", "salt", "doc_id", "field", "term").agg(F.array_sort(F.collect_set("pos")).alias("positions"), F.max("length").alias("length"))
    return found.select("part", "doc_id", "field", "term", "positions", "length")


def _part(term: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


def search(index: DataFrame, query: str, parts: int = 16) -> DataFrame:
    """doc_id, score: every required clause matches in some field, no prohibited one does.

    A match adds the field's boost times the square root of its frequency over the square root of the field's length.
    Only postings of the query's terms are read, in one scan and one aggregation by document; phrases are runs of places.
    A query without required clauses finds nothing.
    """
    clauses = parse(query)
    if not any(not c.prohibited for c in clauses):
        return index.select("doc_id", F.lit(0.0).alias("score")).where("false")
    wanted = sorted({(t, f) for c in clauses for t in c.terms for f in ((c.field,) if c.field else FIELD_BOOSTS)})
    terms = sorted({t for t, _ in wanted})
    read = index.where(F.col("part").isin(sorted({r[0] for r in _parts_of(index, terms, parts)})) & F.col("term").isin(terms) & F.col("field").isin(sorted({f for _, f in wanted})))
    name = {x: f"p{i}" for i, x in enumerate(wanted)}
    here = lambda t, f: (F.col("term") == t) & (F.col("field") == f)
    lengths = {f: f"n{i}" for i, f in enumerate(sorted({f for _, f in wanted}))}
    docs = read.groupBy("doc_id").agg(*(F.max(F.when(here(*x), F.col("positions"))).alias(n) for x, n in name.items()), *(F.max(F.when(F.col("field") == f, F.col("length"))).alias(n) for f, n in lengths.items()))
    found, score = F.lit(True), F.lit(0.0)
    for c in clauses:
        matched, gain = F.lit(False), F.lit(0.0)
        for f in (c.field,) if c.field else FIELD_BOOSTS:
            tf = F.coalesce(F.size(reduce(F.array_intersect, (_moved(F.col(name[t, f]), j) for j, t in enumerate(c.terms)))), F.lit(0))
            matched = matched | (tf > 0)
            gain = gain + F.when(tf > 0, FIELD_BOOSTS.get(f, 1.0) * F.sqrt(tf) / F.sqrt(F.col(lengths[f]))).otherwise(0.0)
        found, score = (found & ~matched, score) if c.prohibited else (found & matched, score + gain)
    return docs.where(found).select("doc_id", score.alias("score"))


def _moved(places: Column, by: int) -> Column:
    return F.transform(places, lambda p: p - by)


def _parts_of(index: DataFrame, terms: list[str], parts: int) -> list:
    """The parts of the terms, by the same hash as the index's."""
    return index.sparkSession.createDataFrame([(t,) for t in terms], "t string").select(_part(F.col("t"), parts)).collect()


def per_site(hits: DataFrame, most: int = 2) -> DataFrame:
    """The best hits of each site."""
    return hits.withColumn("place", F.row_number().over(W.partitionBy("site").orderBy(F.desc("score"), "doc_id"))).where(F.col("place") <= most)


def top(hits: DataFrame, n: int) -> DataFrame:
    """O7, O9."""
    return hits.orderBy(F.desc("score"), "doc_id").limit(n)


def date_range(date14: Column, spec: str) -> Column:
    """D3: a prefix of a date covers it whole; in a range low-high both ends are filled up with zeros."""
    low, dash, high = spec.partition("-")
    return date14.between(low.ljust(14, "0"), high.ljust(14, "0") if dash else low.ljust(14, "9"))


def group_filter(value: Column, spec: str, delimiter: str = ",") -> Column:
    """One of the listed values."""
    return value.isin([x.strip() for x in spec.split(delimiter) if x.strip()])


def prune(index: DataFrame, queries: list[str]) -> DataFrame:
    """postings of documents that no query finds."""
    return reduce(lambda d, q: d.join(search(index, q).select("doc_id"), "doc_id", "left_anti"), queries, index)


def index_fields(docs: DataFrame, specs: list[str]) -> DataFrame:
    """Columns by "source:lower:store:index:exclusive:dest"; what is not stored is left out."""
    cols = []
    for spec in specs:
        source, lower, store, _, _, dest = (spec.split(":") + [""] * 6)[:6]
        if store != "false":
            value = F.col(source).cast("string")
            cols.append((F.lower(value) if lower == "true" else value).alias(dest or source))
    return docs.select("doc_id", *cols)


def static_fields(docs: DataFrame, spec: str) -> DataFrame:
    """X12: "key=value" sets a column, "-key" drops one; parted by blanks."""
    for item in spec.split():
        key, eq, value = item.partition("=")
        docs = docs.withColumn(key.split(":")[0], F.lit(value)) if eq else docs.drop(key.lstrip("-"))
    return docs


def summaries(docs: DataFrame, query: str, context: int = 5, budget: int = 20) -> DataFrame:
    """doc_id, summary: fragments of `context` words around hits, those with most different terms first, until the
    budget of words is spent, in order of place; without hits the first words. Array functions only.

    Null texts have an empty summary. Hits whose fragments meet are one fragment; its words beyond the budget are cut.
    """
    terms = F.array(*(F.lit(t) for t in sorted({t for c in parse(query) if not c.prohibited for t in c.terms}))).cast("array<string>")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"\s+"), lambda w: F.length(w) > 0)
    plain = F.transform("w", lambda w: F.lower(F.regexp_replace(w, r"[^\p{L}\p{N}_]+", "")))
    rows = docs.select("doc_id", words.alias("w")).withColumn("p", plain)
    spots = F.filter(F.sequence(F.lit(0), F.size("w")), lambda i: F.array_contains(terms, F.coalesce(F.get("p", i), F.lit(""))))
    rows = rows.withColumn("s", spots)
    # a fragment begins at a hit whose fragment does not meet that of the hit before, and ends at the last hit before the next
    begins = F.filter(F.transform("s", lambda x, i: F.when((i == 0) | (x - F.get("s", i - 1) > 2 * context + 1), i)), lambda i: i.isNotNull())
    rows = rows.withColumn("b", begins)

    def fragment(i: Column, k: Column) -> Column:
        after = F.coalesce(F.get("b", k + 1), F.size("s"))
        low = F.greatest(F.get("s", i) - context, F.lit(0))
        high = F.least(F.get("s", after - 1) + context + 1, F.size("w"))
        different = F.size(F.array_intersect(F.slice("p", low + 1, high - low), terms))
        return F.struct((-different).alias("d"), low.alias("lo"), high.alias("hi"))

    rows = rows.withColumn("f", F.array_sort(F.transform("b", fragment)))
    size = lambda x: x["hi"] - x["lo"]
    spent = F.aggregate("f", F.struct(F.lit(budget).alias("left"), F.array().cast("array<struct<lo:int,hi:int>>").alias("out")), lambda a, x: F.struct((a["left"] - size(x)).alias("left"), F.when(a["left"] > 0, F.concat(a["out"], F.array(F.struct(x["lo"].alias("lo"), F.least(x["hi"], x["lo"] + a["left"]).alias("hi"))))).otherwise(a["out"]).alias("out")))
    parts = F.transform(F.array_sort(spent["out"]), lambda x: F.array_join(F.slice("w", x["lo"] + 1, x["hi"] - x["lo"]), " "))
    text = F.when(F.size("f") > 0, F.array_join(parts, " ... ")).otherwise(F.array_join(F.slice("w", 1, budget), " "))
    return rows.select("doc_id", text.alias("summary"))
