"""Tokens, profiles, signatures and languages of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.urls import let
from ..tables import written

#: Letters or digits with _ and &, dotted acronyms, c++ and c#, single ideographs.
TOKEN = r"(?:\p{L}\.){2,}|[cC](?:\+\+|#)|[\p{L}\p{N}_&]+"
#: Ranges of characters that are tokens of their own (kana, jamo, ideographs).
CJK = "\u3040-\u318f\u3300-\u337f\u3400-\u3d2d\u4e00-\u9fff\uf900-\ufaff"
_IDEOGRAPH = f"([{CJK}])"


def tokens(text: Column) -> Column:
    """Lower-cased tokens; an acronym loses its dots."""
    return F.transform(F.regexp_extract_all(F.regexp_replace(text, _IDEOGRAPH, " $1 "), F.lit(TOKEN), F.lit(0)), lambda t: F.lower(F.replace(t, F.lit("."), F.lit(""))))


def sentences(text: Column) -> Column:
    """Sentences end with . ! or ? before white space. (transform gives a function of two arguments the place as well,
    which F.trim would take for the characters to trim.)"""
    return F.filter(F.transform(F.split(text, r"[.!?]+\s+"), lambda s: F.trim(s)), lambda s: F.length(s) > 0)


def paragraphs(text: Column) -> Column:
    """Paragraphs are parted by empty lines."""
    return F.filter(F.split(text, r"\n\s*\n"), lambda s: F.length(F.trim(s)) > 0)


def common_grams(words: Column, common: list[str]) -> Column:
    """Pairs of successive words of which one is common, joined by a hyphen."""
    stop = F.array(*map(F.lit, common))
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.when(b.isNotNull() & (F.array_contains(stop, a) | F.array_contains(stop, F.coalesce(b, F.lit("")))), F.concat(a, F.lit("-"), b)))
    return F.array_compact(pairs)


def _runs(items: Column) -> Column:
    """From a sorted array, (item, times) of each different item, in order; nulls are left out beforehand."""
    begins = lambda a: F.filter(F.sequence(F.lit(0), F.size(a)), lambda i: (i < F.size(a)) & ((i == 0) | (F.get(a, i) != F.get(a, F.greatest(i - 1, F.lit(0))))))
    return let(items, lambda a: let(begins(a), lambda b: F.transform(b, lambda at, k: F.struct(F.get(a, at).alias("t"), (F.coalesce(F.get(b, k + 1), F.size(a)) - at).alias("c")))))


def text_profile(docs: DataFrame, rate: float = 0.01, least: int = 2) -> DataFrame:
    """doc_id, profile and its MD5. Runs of more than two letters or digits are counted, counts quantised, rare
    ones dropped, the rest sorted by count, then token. Without any, the MD5 of the text stands in (H2). All within the row:
    no shuffle. A null or empty text has an empty profile and the MD5 of the empty text; repeated rows get a row each."""
    counted = _runs(F.array_sort(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"[\p{L}\p{N}]{3,}"), F.lit(0))))

    def lines(counts: Column) -> Column:
        most = F.array_max(F.transform(counts, lambda x: x["c"]))
        quant = F.round(most * rate).cast("int")
        step = F.when(quant < least, F.when(most > 1, F.lit(least)).otherwise(F.lit(1))).otherwise(quant)
        kept = let(step, lambda q: F.filter(F.transform(counts, lambda x: F.struct((-F.floor(x["c"] / q) * q).cast("int").alias("n"), x["t"].alias("t"))), lambda x: -x["n"] >= q))
        return F.array_join(F.transform(F.array_sort(kept), lambda x: F.concat_ws(" ", x["t"], (-x["n"]).cast("string"))), "\n")

    profile = F.coalesce(let(counted, lines), F.lit(""))
    return docs.select("doc_id", "text", profile.alias("profile")).select("doc_id", "profile", F.md5(F.coalesce(F.nullif("profile", F.lit("")), "text", F.lit(""))).alias("signature"))


def term_frequencies(docs: DataFrame, least: int = 1) -> DataFrame:
    """Terms by the documents that hold them."""
    return docs.select("doc_id", F.explode(F.array_distinct(tokens(F.col("text")))).alias("term")).groupBy("term").agg(F.count("*").alias("docs")).where(F.col("docs") >= least)


def letter_runs(text: Column) -> Column:
    """The lower-cased runs of letters of a text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def ngrams(text: Column, n: int = 3) -> Column:
    """N-grams of the letter runs of a text, each run between underscores."""
    words = F.transform(letter_runs(text), lambda w: F.concat(F.lit("_"), w, F.lit("_")))
    return F.flatten(F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - n + 1, F.lit(1))), lambda i: F.substring(w, i, n))))


def language_profiles(docs: DataFrame, n: int = 3, top: int = 1000) -> DataFrame:
    """Lang, gram, freq: the most frequent n-grams of each language's texts, shares of all its n-grams.

    Words are counted first, so that each different one is cut once."""
    words = docs.select("lang", F.explode(letter_runs(F.col("text"))).alias("w")).groupBy("lang", "w").agg(F.count("*").alias("k"))
    grams = words.select("lang", "k", F.explode(ngrams(F.col("w"), n)).alias("gram")).groupBy("lang", "gram").agg(F.sum("k").alias("c"))
    share = grams.withColumn("freq", F.col("c") / F.sum("c").over(W.partitionBy("lang")))
    return share.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(F.desc("c"), "gram"))).where(F.col("r") <= top).select("lang", "gram", "freq")


def _scores(rows: list[tuple[str, int, float]], langs: list[str], n: int):
    """From the letter runs of texts, a row for each text and language that share an n-gram; rows: n-gram, place of its
    language, frequency."""
    place = {gram: i for i, gram in enumerate({r[0] for r in rows})}
    of_gram, of_lang, freq = np.array([place[r[0]] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows])

    def cut(word: str) -> tuple[int, list[int]]:
        w = f"_{word}_"
        grams = [w[i : i + n] for i in range(max(len(w) - n + 1, 1))]
        return len(grams), [place[g] for g in grams if g in place]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts: dict[str, tuple[int, list[int]]] = {}  # of words met before; only to save time
        for batch in batches:
            ids, of, score = [], [], []
            for k, words in enumerate(batch.column(1)):
                total, met = 0, []
                for word in words.values.to_pylist():
                    found = cuts.get(word)
                    if found is None:
                        found = cut(word)
                        if len(cuts) < 100_000:
                            cuts[word] = found
                    total += found[0]
                    met += found[1]
                if not met:
                    continue
                counts = np.bincount(np.array(met, np.int64), minlength=len(place))[of_gram]
                shared = counts > 0
                sums = np.bincount(of_lang[shared], counts[shared] / total + freq[shared], minlength=len(langs))
                for lang in np.flatnonzero(np.bincount(of_lang[shared], minlength=len(langs))).tolist():
                    ids.append(k)
                    of.append(langs[lang])
                    score.append(float(sums[lang]))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(ids, pa.int32())), pa.array(of, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang", "part"])

    return run


def identify(docs: DataFrame, profiles: DataFrame, n: int = 3, broadcast_rows: int = 200_000) -> DataFrame:
    """L2: doc_id, guess: the language whose shared n-grams have the largest sum of both frequencies; ties: first by name.

    Profiles of at most `broadcast_rows` rows (some 60 bytes each) go to every task, which counts a text's n-grams in memory
    and gives a row for each language; larger ones meet the n-grams of the texts by a join. Null texts and texts without
    letters have no row; rows of one id add up.
    """
    profiles = written(profiles, "profiles")  # read twice
    source = docs.where("text is not null")
    if profiles.count() <= broadcast_rows:
        rows = profiles.where("lang is not null").collect()
        langs = sorted({r["lang"] for r in rows})
        known = [(r["gram"], langs.index(r["lang"]), r["freq"]) for r in rows]
        parts = source.select("doc_id", letter_runs(F.col("text")).alias("words")).mapInArrow(_scores(known, langs, n), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang string, part double")
    else:
        grams = source.select("doc_id", F.array_sort(ngrams(F.col("text"), n)).alias("g"))
        each = F.transform("g", lambda x, i: F.struct(x.alias("gram"), ((i == 0) | (x != F.get("g", F.greatest(i - 1, F.lit(0))))).alias("first")))
        rows = grams.select("doc_id", (1 / F.size("g")).alias("own"), F.explode(each).alias("x")).select("doc_id", "own", "x.gram", "x.first")
        parts = rows.join(profiles, "gram").select("doc_id", "lang", (F.col("own") + F.when(F.col("first"), F.col("freq")).otherwise(0.0)).alias("part"))
    score = parts.groupBy("doc_id", "lang").agg(F.round(F.sum("part"), 9).alias("score"))
    best = score.groupBy("doc_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "lang")).alias("b"))
    return best.select("doc_id", F.col("b.lang").alias("guess"), (-F.col("b.s")).alias("score"))


def profile_distance(profiles: DataFrame) -> DataFrame:
    """L3: distance of every two languages: absolute differences of shared n-grams, whole frequencies of the others."""
    a, b = profiles.toDF("a", "gram", "fa"), profiles.toDF("b", "gram", "fb")
    names = profiles.select("lang").distinct()
    pairs = names.toDF("a").crossJoin(F.broadcast(names.toDF("b"))).where("a < b")  # languages, not texts
    left = pairs.join(a, "a").join(b, ["b", "gram"], "left").select("a", "b", F.abs(F.col("fa") - F.coalesce("fb", F.lit(0.0))).alias("d"))
    right = pairs.join(b, "b").join(a, ["a", "gram"], "left_anti").select("a", "b", F.col("fb").alias("d"))
    return left.union(right).groupBy("a", "b").agg(F.sum("d").alias("distance"))


def language_field(html_lang: Column, header: Column, guess: Column) -> Column:
    """L4: what the page says, else its header, else the guess, else unknown."""
    return F.coalesce(F.nullif(html_lang, F.lit("")), F.nullif(header, F.lit("")), guess, F.lit("unknown"))
