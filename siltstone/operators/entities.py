"""Resolution of names against a registry of persons and organisations.

mentions: page, name. registry: id_per, first_name, last_name, id_org, name_org, row_hash (one row for each relation).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.names import EXCLUDE_TAGS, SYNONYM_TAGS, alternatives, key_line, name_keys, nearest_distance, ngram_keys, normalize_name
from ..tables import written

#: Multis of a page up to which all its singles are compared with them; on larger pages these meet through their relations.
HUB = 1_000


def person_index(registry: DataFrame) -> DataFrame:
    """A3: key, id, name of each person with both names (F19), and the number of its rows."""
    rows = registry.where((F.length("first_name") > 0) & (F.length("last_name") > 0))
    name = F.concat_ws(" ", "first_name", "last_name")
    return _with_key(_row_counts(rows, F.col("id_per"), name))


def _row_counts(rows: DataFrame, ident: Column, name: Column) -> DataFrame:
    """id, name, number of different rows. MD5 sums go as the bytes that they are, in half the space; other hashes stay."""
    row = F.when(F.rlike("row_hash", F.lit("^[0-9a-f]{32}$")), F.unhex("row_hash")).otherwise(F.col("row_hash").cast("binary"))
    return rows.groupBy(ident.alias("id"), name.alias("name")).agg(F.count_distinct(row).alias("n_rows"))


def _with_key(counted: DataFrame) -> DataFrame:
    """The key depends on the name alone, so it is made after the rows are counted, once for each entity."""
    return counted.select(normalize_name(F.col("name")).alias("key"), "id", "name", "n_rows")


def org_index(registry: DataFrame) -> DataFrame:
    """A4: as person_index for organisations; rows whose person has the organisation's name do not count."""
    person, org = F.concat_ws(" ", "first_name", "last_name"), F.col("name_org")
    plain = lambda c: normalize_name(c, org_types=False)
    letters = lambda c: F.translate(F.lower(c), "'\" ", "")
    # names that are plainly the same have the same letters, which are quicker to compare
    same = (letters(person) == letters(org)) & plain(person).eqNullSafe(plain(org))
    return _with_key(_row_counts(registry.where((F.length("name_org") > 0) & ~same), F.col("id_org"), org))


def relations(registry: DataFrame) -> DataFrame:
    """Pairs (per, org) that share a registry row: all that the cross-match needs of the rows."""
    return registry.where("id_per is not null and id_org is not null").select(F.col("id_per").alias("per"), F.col("id_org").alias("org")).distinct()


def exclusion_sets(table: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Keys to exclude, names that no person may have (F16), synonyms key -> long form."""
    excluded = table.where(F.col("tag1").isin(*EXCLUDE_TAGS))
    synonyms = table.where(F.col("tag1").isin(*SYNONYM_TAGS) & (F.length("synonym") > 0))
    return (
        excluded.select(normalize_name(F.col("name")).alias("key")).where("key is not null").distinct(),
        excluded.select("name").distinct(),
        synonyms.groupBy(normalize_name(F.col("name")).alias("key")).agg(F.max(normalize_name(F.col("synonym"))).alias("long_form")),
    )


def excluded_keys(excluded: DataFrame, persons: DataFrame) -> DataFrame:
    """the excluded keys and the first word of every person's key."""
    return excluded.union(persons.select(F.split("key", " ")[0])).distinct()


def mention_keys(names: DataFrame, excluded_names: DataFrame) -> DataFrame:
    """Name, per_ok, key of distinct names, one row for each key; per_ok (F16) if no raw reading is excluded."""
    readings = names.select("name", F.explode(alternatives(F.col("name"))).alias("reading"))
    barred = readings.join(excluded_names.withColumnRenamed("name", "reading"), "reading", "left_semi").select("name").distinct()
    return names.join(barred.withColumn("barred", F.lit(True)), "name", "left").select("name", F.col("barred").isNull().alias("per_ok"), F.explode(name_keys(F.col("name"))).alias("key"))


class _Parts(dict):
    """Tables by name, each made when it is first asked for: a query of one outcome does not wait for the others."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        super().__init__()
        self._makers = makers

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._makers[name]()
        return self[name]


def resolve(mentions: DataFrame, registry: DataFrame, exclusions: DataFrame, lone_first_names: bool = True) -> dict[str, DataFrame]:
    """The whole resolution: excluded, matchless (both in one table as idle, with their state), single, cross and noncross
    as DataFrames, each made when it is asked for.

    Exclusion tests the key as it is, synonyms replace it after (R3). A key with one entity of a type is single, with
    more multi; a multi's candidate is cross-matched if it shares a registry row with exactly one single match of the
    other type on its page, counted by mention and key (R1). Multis without such a candidate are noncross.

    Keys, exclusions, synonyms and the number of a key's entities depend on the name alone, so they are found once for each
    distinct name; pages only join their result. A page's row of a key stands for all its entities: they are told apart only
    where a single is related to them. What several outcomes read is written once to the shared folder.
    """
    persons, orgs = person_index(registry), org_index(registry)
    excluded, barred, synonyms = exclusion_sets(exclusions)
    if lone_first_names:
        excluded = excluded_keys(excluded, persons)
    pages = mentions.where(F.length("name") > 0).select("page", "name").distinct()
    names = mentions.where(F.length("name") > 0).select("name").distinct()
    keys = mention_keys(names, barred)
    kept = keys.join(excluded, "key", "left_anti").join(synonyms, "key", "left").select("name", "per_ok", F.coalesce("long_form", "key").alias("key")).distinct()
    index = written(persons.select(F.lit("PER").alias("type"), "key", "id", F.col("name").alias("entity")).union(orgs.select(F.lit("ORG"), "key", "id", "name")), "index")
    # n: entities of a key; id and entity tell which if there is one
    sizes = index.groupBy("type", "key").agg(F.count("*").alias("n"), F.min(F.struct("id", "entity")).alias("e"))
    met = kept.join(sizes, "key", "left").select("name", F.when(F.col("type").isNotNull() & ((F.col("type") == "ORG") | F.col("per_ok")), F.struct("type", "key", "n", "e")).alias("hit"))
    # each name with its hits; a name that is not there has none of its keys left
    known = written(names.join(met.groupBy("name").agg(F.collect_set("hit").alias("hits")), "name", "left"), "names")
    parts = _Parts({})

    def candidates() -> DataFrame:
        rows = pages.join(known.select("name", F.explode("hits").alias("h")), "name")
        return written(rows.groupBy("page", "h.type", "h.key").agg(F.count("*").alias("mentions"), F.first("h.n").alias("n"), F.first("h.e").alias("e")), "candidates")

    def idle() -> DataFrame:
        none = known.where("hits is null or size(hits) = 0").select("name", F.when(F.col("hits").isNull(), "excluded").otherwise("matchless").alias("state"))
        return pages.join(none, "name").select("page", "name", "state")

    def state(name: str) -> Callable[[], DataFrame]:
        return lambda: parts["idle"].where(F.col("state") == name).drop("state")

    def lone() -> DataFrame:
        return parts["candidates"].where("n = 1").select("page", "type", "key", "e.id", "e.entity", "mentions")

    def multi() -> DataFrame:
        return parts["candidates"].where("n > 1").select("page", "type", "key")

    def cross() -> DataFrame:
        several = index.join(sizes.where("n > 1").select("type", "key"), ["type", "key"], "left_semi")
        return written(_cross(multi(), lone(), several, relations(registry)), "cross")

    def noncross() -> DataFrame:
        return multi().join(parts["cross"].select("page", "type", "key").distinct(), ["page", "type", "key"], "left_anti")

    single = lambda: lone().drop("mentions")
    parts._makers |= {"candidates": candidates, "idle": idle, "excluded": state("excluded"), "matchless": state("matchless"), "single": single, "cross": cross, "noncross": noncross}
    return parts


def _cross(multi: DataFrame, single: DataFrame, several: DataFrame, pairs: DataFrame) -> DataFrame:
    """The entities of multis (page, type, key) that share a registry row with one single of the other type on their
    page; several: type, key, id, entity of all keys with more than one.

    links has, once for each single entity, the entities it is related to by their key. Singles meet the multis of their
    page; on pages with more than HUB multis only those keys that they have links to. What they meet alone is looked up.
    """
    both = pairs.select(F.lit("PER").alias("o_type"), F.col("per").alias("o_id"), F.lit("ORG").alias("type"), F.col("org").alias("id"))
    both = both.union(pairs.select(F.lit("ORG"), "org", F.lit("PER"), "per"))
    ones = single.select(F.col("type").alias("o_type"), F.col("id").alias("o_id"))
    links = written(both.join(ones.distinct(), ["o_type", "o_id"]).join(several, ["type", "id"]), "links")
    beside = single.select("page", F.col("type").alias("o_type"), F.col("id").alias("o_id"), "mentions")
    large = multi.groupBy("page").count().where(F.col("count") > HUB).select("page")
    near = beside.join(multi.join(large, "page", "left_anti"), "page").where("type <> o_type")
    linked = links.select("o_type", "o_id", "type", "key").distinct()
    far = beside.join(large, "page", "left_semi").join(linked, ["o_type", "o_id"]).join(multi, ["page", "type", "key"])
    columns = ["page", "o_type", "o_id", "mentions", "type", "key"]
    met = near.select(*columns).union(far.select(*columns)).join(links, ["o_type", "o_id", "type", "key"])
    return met.groupBy("page", "type", "key", "id", "entity").agg(F.sum("mentions").alias("n")).where("n = 1").drop("n")


def outcomes(parts: dict[str, DataFrame]) -> DataFrame:
    """Long form of resolve(): page, outcome, type, key, id."""
    none = F.lit(None)
    rows = [parts[k].select("page", F.lit(k).alias("outcome"), "type", "key", "id") for k in ("single", "cross")]
    rows.append(parts["noncross"].select("page", F.lit("noncross").alias("outcome"), "type", "key", none.cast("bigint").alias("id")))
    rows.append(parts["idle"].select("page", F.col("state").alias("outcome"), none.cast("string").alias("type"), F.col("name").alias("key"), none.cast("bigint").alias("id")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def per_page(parts: dict[str, DataFrame]) -> DataFrame:
    """SURVEY 1.5: one row by page with sorted lists of each outcome; notMatchableNames is always empty."""
    rows = outcomes(parts).groupBy("page").agg(
        *(F.array_sort(F.collect_set(F.when(F.col("outcome") == k, F.concat_ws(":", "type", "key", "id")))).alias(k) for k in ("single", "cross", "noncross", "excluded", "matchless"))
    )
    return rows.withColumn("not_matchable", F.array().cast("array<string>"))


def _contained(texts: DataFrame, names: DataFrame, name: str) -> DataFrame:
    """entity, `name`: the names (distinct, not empty) that a text holds. Each text is cut into its parts of the lengths
    that occur, which meet the names by equality."""
    lengths = sorted(r[0] for r in names.select(F.length(name)).distinct().collect())  # as many as the longest name has characters at most
    parts = [F.transform(F.sequence(F.lit(1), F.length("entity") - n + 1), _part_of(n)) for n in lengths]
    cut = [F.when(F.length("entity") >= n, p).otherwise(F.array().cast("array<string>")) for n, p in zip(lengths, parts)]
    every = F.explode(F.array_distinct(F.concat(*cut))) if cut else F.explode(F.array().cast("array<string>"))
    return texts.select("entity").distinct().select("entity", every.alias(name)).join(names, name)


def _part_of(n: int):
    return lambda i: F.substring(F.col("entity"), i, n)


def simple_link(names: DataFrame, registry: DataFrame) -> DataFrame:
    """Page, label, ident, entity of PER and ORG names (F17) that hold a registry row's first and last name, or its organisation.

    names: page, label, entity. Containment becomes equality with the entity's parts; first and last names are found each
    for itself and meet by entity, so that a common first name is never paired with all its bearers. Registry rows with an
    empty name are left out (S9). Null entities link with nothing.

    The result has a row for each bearer of a name on each page, which grows faster than either table. So both sides are
    made distinct before they meet: no row of the result is sorted, shuffled or held.
    """
    wanted = names.where(F.col("label").isin("PER", "ORG") & F.col("entity").isNotNull()).select("page", "label", "entity").distinct()
    people = written(registry.where((F.length("first_name") > 0) & (F.length("last_name") > 0) & (F.length("name_org") > 0)).select("first_name", "last_name", "name_org", "id_per", "id_org"), "people")
    texts = written(names.where(F.col("label").isin("PER", "ORG") & F.col("entity").isNotNull()).select("label", "entity").distinct(), "texts")
    first, last, org = (_contained(texts, people.select(c).distinct(), c) for c in ("first_name", "last_name", "name_org"))
    by_name, by_org = first.join(last, "entity"), org
    found = []
    for label, ident in (("PER", "id_per"), ("ORG", "id_org")):
        of_label = texts.where(F.col("label") == label)
        for held, keys in ((by_name, ["first_name", "last_name"]), (by_org, ["name_org"])):
            bearers = people.select(*keys, F.col(ident).alias("ident")).distinct()
            found.append(of_label.join(held, "entity").join(bearers, keys).select("label", "entity", "ident"))
    idents = written(found[0].union(found[1]).union(found[2]).union(found[3]).distinct(), "idents")
    return wanted.join(idents, ["label", "entity"]).select("page", "label", "ident", "entity")


def mention_stats(names: DataFrame) -> DataFrame:
    """A1, A2: name, label, its mentions and pages."""
    return names.groupBy("entity", "label").agg(F.count("*").alias("mentions"), F.count_distinct("page").alias("pages"))


def fuzzy_nearest(names: DataFrame, entities: DataFrame, share: float = 0.8) -> DataFrame:
    """For each name, the entities that share its longest n-gram key and of these the nearest; ties stay.

    names: name. entities: id, form. Keys are exploded on both sides and met by equality.
    """
    left = names.select("name").distinct().withColumn("gram", F.explode(ngram_keys(F.col("name"), share)))
    right = entities.select("id", "form").distinct().withColumn("gram", F.explode(ngram_keys(F.col("form"), share)))
    met = left.join(right, "gram").groupBy("name", "id", "form").agg(F.max(F.length("gram")).alias("size"))
    longest = met.withColumn("top", F.max("size").over(W.partitionBy("name"))).where("size = top")
    near = longest.withColumn("distance", nearest_distance(F.col("name"), F.array("form"))).withColumn("least", F.min("distance").over(W.partitionBy("name"))).where("distance = least")
    return near.select("name", "id", "form", F.col("size").cast("bigint").alias("gram_size"), F.col("distance").cast("bigint").alias("distance"))


def evaluate(predicted: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """One row of retrieved, relevant, tp, fp, fn, precision, recall, f over distinct keys."""
    p, g = predicted.select(*keys).distinct().withColumn("p", F.lit(1)), gold.select(*keys).distinct().withColumn("g", F.lit(1))
    both = p.join(g, keys, "full_outer").agg(F.count("p").alias("retrieved"), F.count("g").alias("relevant"), F.count(F.col("p") + F.col("g")).alias("tp"))
    precision, recall = F.try_divide("tp", "retrieved"), F.try_divide("tp", "relevant")
    return both.select("retrieved", "relevant", "tp", (F.col("retrieved") - F.col("tp")).alias("fp"), (F.col("relevant") - F.col("tp")).alias("fn"), F.round(precision, 6).alias("precision"), F.round(recall, 6).alias("recall"), F.round(F.try_divide(2 * precision * recall, precision + recall), 6).alias("f"))


def person_relations(registry: DataFrame) -> DataFrame:
    """A5: key, id, name of each person with both names, and its relations (id_org, name_org) as a set in order."""
    rows = registry.where((F.length("first_name") > 0) & (F.length("last_name") > 0))
    name = F.concat_ws(" ", "first_name", "last_name")
    held = rows.groupBy(F.col("id_per").alias("id"), name.alias("name")).agg(F.array_sort(F.collect_set(F.struct("id_org", "name_org"))).alias("relations"))
    return held.select(normalize_name(F.col("name")).alias("key"), "id", "name", "relations")


def ngram_index(keys: DataFrame, share: float = 0.8) -> DataFrame:
    """A5: gram, key: every n-gram key of the distinct normalised names. A posting table in place of lists, as a common
    n-gram may have any number of names."""
    return keys.select("key").where("key is not null").distinct().select(F.explode(ngram_keys(F.col("key"), share)).alias("gram"), "key").distinct()


def known_relations(names: DataFrame, index: DataFrame, relations: Column | None = None) -> DataFrame:
    """Names (page, key) that are a known key, with each entity's id and relations. The result has a row for each bearer
    of a page's name; relations: what is wanted of an entity's ones, found once for each entity instead of on each page."""
    what = F.col("relations") if relations is None else relations
    return names.join(written(index.select("key", "id", what.alias("relations")), "relations"), "key").select("page", "key", "id", "relations")


def hits_by_page(persons: DataFrame, orgs: DataFrame, one_sided: bool = True) -> DataFrame:
    """Page, n_per, n_org: the hits of either type of a page side by side. Pages with hits of one type only are kept
    with none of the other; one_sided=False leaves them out, as the experimental matcher did."""
    per, org = persons.groupBy("page").agg(F.count("*").alias("n_per")), orgs.groupBy("page").agg(F.count("*").alias("n_org"))
    return per.join(org, "page", "full_outer" if one_sided else "inner").select("page", *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("n_per", "n_org")))


def org_index_with_lemmas(registry: DataFrame, lemmas: Callable[[Column], Column]) -> DataFrame:
    """T4: org_index with, beside each name's key, that of its lemmatised words; rows as in org_index, a key once."""
    rows = written(org_index(registry), "orgs")  # read twice
    other = F.array_join(lemmas(F.split("name", r"\s+")), " ")
    every = rows.union(rows.select(normalize_name(other).alias("key"), "id", "name", "n_rows").where("key is not null"))
    return every.distinct()


def exploded_names(parts: dict[str, DataFrame]) -> DataFrame:
    """Value: a line `page::key` for each single or cross match, and `key,id` beside it."""
    rows = parts["single"].select("page", "key", "id").union(parts["cross"].select("page", "key", "id"))
    return rows.select(F.concat_ws("::", F.col("page").cast("string"), "key").alias("value"), key_line(F.col("key"), F.col("id").cast("string")).alias("line"))
