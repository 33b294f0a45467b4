"""Entity queries and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names as N
from ..operators import entities as E
from ..tables import table
from . import inputs as I


def _parts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    mentions = I.names(spark, sf).select("page", F.col("entity").alias("name"))
    return E.resolve(mentions, I.registry(spark, sf), I.exclusions(spark, sf))


def resolution(spark, sf):
    return E.outcomes(_parts(spark, sf))


def resolution_pages(spark, sf):
    return E.per_page(_parts(spark, sf)).select("page", *(F.array_join(k, ";").alias(k) for k in ("single", "cross", "noncross", "excluded", "matchless")))


def _outcome(name, *cols):
    return lambda spark, sf: _parts(spark, sf)[name].select(*cols)


def _of(name, kind):
    return lambda spark, sf: _parts(spark, sf)[name].where(F.col("type") == kind).select("page", "key", "id", "entity")


def simple_link(spark, sf):
    return E.simple_link(I.names(spark, sf), I.registry(spark, sf))


def mention_stats(spark, sf):
    return E.mention_stats(I.names(spark, sf))


def _words(spark, sf):
    return I.names(spark, sf).select("entity").distinct()


def name_normalize(spark, sf):
    return _words(spark, sf).select("entity", N.normalize_name(F.col("entity")).alias("key"), N.normalize_name(F.col("entity"), drop_short=True).alias("short_key"))


def name_alternatives(spark, sf):
    return _words(spark, sf).select("entity", F.array_join(N.alternatives(F.col("entity")), ";").alias("readings"), F.array_join(N.name_keys(F.col("entity")), ";").alias("keys"))


def known_person_index(spark, sf):
    return E.person_index(I.registry(spark, sf))


def known_org_index(spark, sf):
    return E.org_index(I.registry(spark, sf))


def subname_filter(spark, sf):
    names = I.names(spark, sf).groupBy("page").agg(F.collect_set("entity").alias("names"))
    return names.select("page", F.array_join(N.without_subnames(F.col("names")), ";").alias("kept"))


def eval_prf(spark, sf):
    parts = _parts(spark, sf)
    predicted = parts["single"].unionByName(parts["cross"]).where("type = 'PER'").select("page", "id")
    gold = table(spark, sf, "orders").select(F.col("o_orderkey").alias("page"), F.col("o_custkey").alias("id"))
    return E.evaluate(predicted, gold, ["page", "id"])


def birthdate_from_id(spark, sf):
    code = F.concat((F.col("c_custkey") % 4 + 3).cast("string"), F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0"), F.lpad((F.col("c_custkey") % 12 + 1).cast("string"), 2, "0"), F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0"), F.lit("1234"))
    return table(spark, sf, "customer").select("c_custkey", code.alias("code"), N.birth_date(code).alias("born"), N.valid_code(code).alias("valid"))


def ngram_keys(spark, sf):
    parts = table(spark, sf, "part").select("p_name").distinct()
    return parts.select("p_name", F.explode(N.ngram_keys(F.col("p_name"))).alias("gram"))


def fuzzy_nearest(spark, sf):
    parts = table(spark, sf, "part").groupBy("p_name").agg(F.min("p_partkey").alias("id"))
    typed = parts.select(F.concat(F.col("p_name"), F.lit("s")).alias("name"))
    return E.fuzzy_nearest(typed, parts.select("id", F.col("p_name").alias("form")))


#: SQL of the inputs, in the order of plans.inputs.
_REGISTRY = """registry as (select distinct o_custkey as id_per, l_suppkey as id_org from lineitem join orders on l_orderkey = o_orderkey),
reg as (select id_per, id_org, 'Mari' || (id_per % 97) as first_name, 'Tamm' || (id_per % 13) as last_name, 'Firma ' || (id_org % 71) || case when id_org % 3 = 0 then ' Osaühing' else ' AS' end as name_org from registry)"""
_NAMES = """names as (select o_orderkey as page, 'PER' as label, 'Mari' || (o_custkey % 97) || ' Tamm' || (o_custkey % 13) || case when o_custkey % 5 = 0 then '|Tammo' else '' end as entity from orders
union all select l_orderkey, 'ORG', case when l_suppkey % 3 = 0 then 'OÜ ' else '' end || 'Firma ' || (l_suppkey % 71) || case when l_suppkey % 3 = 0 then '' else ' AS' end from lineitem
union all select l_orderkey, 'LOC', p_name from lineitem join part on l_partkey = p_partkey)"""
_TYPES = "case lower(w) when 'aktsiaselts' then 'as' when 'as' then 'as' when 'korteriühistu' then 'kü' when 'kü' then 'kü' when 'osaühing' then 'oü' when 'oü' then 'oü' when 'mittetulundusühing' then 'mtü' when 'mtü' then 'mtü' when 'sihtasutus' then 'sa' when 'sa' then 'sa' end"


def _norm(expr: str, short: bool = False) -> str:
    words = f"string_split({expr}, ' ')"
    body = f"list_filter({words}, lambda w: {_TYPES} is null{' and length(w) > 2' if short else ''})"
    text = f"trim(array_to_string(list_transform({body}, lambda w: lower(w)), ' '))"
    kind = f"list_filter(list_transform({words}, lambda w: {_TYPES}), lambda k: k is not null)"
    full = f"trim(case when len({kind}) > 0 then {kind}[-1] || ' ' || {text} else {text} end)"
    return f"case when length({full}) > 2 then {full} end" if short else full


_READ = """readings as (select distinct entity, trim(a || ' ' || b || case when c = '' then '' else ' ' || c end) as reading from
 (select entity, unnest(string_split(string_split(entity, ' ')[1], '|')) as a, unnest(string_split(coalesce(string_split(entity, ' ')[2], ''), '|')) as b, coalesce(string_split(entity, ' ')[3], '') as c from (select distinct entity from names)
  where not contains(string_split(entity, ' ')[2], '|') or string_split(entity, ' ')[2] is null
  union all select entity, string_split(entity, ' ')[1], unnest(string_split(string_split(entity, ' ')[2], '|')), '' from (select distinct entity from names) where contains(string_split(entity, ' ')[2], '|')))"""
_RESOLVE = f"""with {_REGISTRY}, {_NAMES}, {_READ},
persons as (select distinct {_norm("first_name || ' ' || last_name")} as key, id_per as id, first_name || ' ' || last_name as entity from reg),
orgs as (select distinct {_norm('name_org')} as key, id_org as id, name_org as entity from reg),
excl as (select distinct p_name as name, length(p_name) % 4 as n from part),
gone_keys as (select {_norm('name')} as key from excl where n = 0 union select string_split(key, ' ')[1] from persons),
syn as (select {_norm('name')} as key, {_norm("'Firma 7 AS'")} as long_form from excl where n = 1 group by all),
keyed as (select distinct page, n.entity as name, {_norm('reading')} as key, not exists (select 1 from readings r2 join excl on r2.reading = excl.name and excl.n = 0 where r2.entity = n.entity) as per_ok
 from (select distinct page, entity from names where length(entity) > 0) n join readings r on r.entity = n.entity),
alive as (select * from keyed where key not in (select key from gone_keys)),
kept as (select distinct page, name, per_ok, coalesce(long_form, a.key) as key from alive a left join syn on a.key = syn.key),
hits as (select page, name, k.key, type, id, entity from kept k join (select 'PER' as type, * from persons union all select 'ORG', * from orgs) i on i.key = k.key where type = 'ORG' or per_ok),
cand as (select page, type, key, id, entity, count(distinct name) as mentions from hits group by all),
numbered as (select *, count(*) over (partition by page, type, key) as n from cand),
single as (select * from numbered where n = 1), multi as (select * from numbered where n > 1),
crossed as (select m.page, m.type, m.key, m.id, m.entity from multi m join single s on m.page = s.page and m.type <> s.type
 join registry r on r.id_per = case when m.type = 'PER' then m.id else s.id end and r.id_org = case when m.type = 'ORG' then m.id else s.id end group by all having sum(s.mentions) = 1),
excluded as (select distinct page, name from keyed k where not exists (select 1 from alive a where a.page = k.page and a.name = k.name)),
matchless as (select distinct page, name from kept k where not exists (select 1 from hits h where h.page = k.page and h.name = k.name)),
noncross as (select distinct page, type, key from multi m where not exists (select 1 from crossed c where c.page = m.page and c.type = m.type and c.key = m.key)),
outcomes as (select page, 'single' as outcome, type, key, id from single union all select page, 'cross', type, key, id from crossed union all select page, 'noncross', type, key, null from noncross
 union all select page, 'excluded', null, name, null from excluded union all select page, 'matchless', null, name, null from matchless) """


def _pages_sql() -> str:
    lists = ", ".join(f"coalesce(array_to_string(list_sort(list_distinct(list(case when outcome = '{k}' then concat_ws(':', type, key, id) end) filter (outcome = '{k}'))), ';'), '') as \"{k}\"" for k in ("single", "cross", "noncross", "excluded", "matchless"))
    return _RESOLVE + f"select page, {lists} from outcomes group by page"


QUERIES = {
    "resolution": resolution,
    "resolution_pages": resolution_pages,
    "match_single_per": _of("single", "PER"),
    "match_single_org": _of("single", "ORG"),
    "match_cross_per": _of("cross", "PER"),
    "match_cross_org": _of("cross", "ORG"),
    "match_noncross": _outcome("noncross", "page", "type", "key"),
    "match_matchless": _outcome("matchless", "page", "name"),
    "match_excluded": _outcome("excluded", "page", "name"),
    "simple_link": simple_link,
    "entity_mention_stats": mention_stats,
    "name_normalize": name_normalize,
    "name_alternatives": name_alternatives,
    "known_person_index": known_person_index,
    "known_org_index": known_org_index,
    "subname_filter": subname_filter,
    "eval_prf": eval_prf,
    "birthdate_from_id": birthdate_from_id,
    "ngram_keys": ngram_keys,
    "fuzzy_nearest": fuzzy_nearest,
}
SQL = {
    "resolution": _RESOLVE + "select * from outcomes",
    "resolution_pages": _pages_sql(),
    "match_single_per": _RESOLVE + "select page, key, id, entity from single where type = 'PER'",
    "match_single_org": _RESOLVE + "select page, key, id, entity from single where type = 'ORG'",
    "match_cross_per": _RESOLVE + "select page, key, id, entity from crossed where type = 'PER'",
    "match_cross_org": _RESOLVE + "select page, key, id, entity from crossed where type = 'ORG'",
    "match_noncross": _RESOLVE + "select page, type, key from noncross",
    "match_matchless": _RESOLVE + "select page, name from matchless",
    "match_excluded": _RESOLVE + "select page, name from excluded",
    "simple_link": f"""with {_REGISTRY}, {_NAMES} select distinct page, label, case when label = 'PER' then id_per else id_org end as ident, entity
from (select * from names where label in ('PER', 'ORG')) n join (select distinct entity as e, label as l, id_per, id_org from (select distinct entity, label from names where label in ('PER', 'ORG')) t
join reg on (contains(entity, first_name) and contains(entity, last_name)) or contains(entity, name_org)) m on n.entity = m.e and n.label = m.l""",
    "entity_mention_stats": f"with {_NAMES} select entity, label, count(*) as mentions, count(distinct page) as pages from names group by all",
    "name_normalize": f"with {_NAMES} select entity, {_norm('entity')} as key, {_norm('entity', True)} as short_key from (select distinct entity from names)",
    "name_alternatives": f"""with {_NAMES}, {_READ} select entity, string_agg(reading, ';' order by contains(entity, '|') and reading like '%Tammo') as readings,
array_to_string(list_sort(list_distinct(list({_norm('reading')}))), ';') as keys from readings group by entity""",
    "known_person_index": f"with {_REGISTRY} select {_norm("first_name || ' ' || last_name")} as key, id_per as id, first_name || ' ' || last_name as name, count(*) as n_rows from reg group by all",
    "known_org_index": f"with {_REGISTRY} select {_norm('name_org')} as key, id_org as id, name_org as name, count(*) as n_rows from reg group by all",
    "subname_filter": f"""with {_NAMES}, lists as (select page, list_sort(list_distinct(list(upper(entity)))) as l from names group by page)
select page, array_to_string(list_filter(l, lambda x, i: len(list_filter(l[i + 1:], lambda y: contains(y, x))) = 0), ';') as kept from lists""",
    "eval_prf": _RESOLVE
    + """, predicted as (select distinct page, id from outcomes where outcome in ('single', 'cross') and type = 'PER'), gold as (select o_orderkey as page, o_custkey as id from orders),
counts as (select (select count(*) from predicted) as retrieved, (select count(*) from gold) as relevant, (select count(*) from predicted join gold using (page, id)) as tp)
select retrieved, relevant, tp, retrieved - tp as fp, relevant - tp as fn, round(tp / retrieved, 6) as precision, round(tp / relevant, 6) as recall, round(2 * (tp / retrieved) * (tp / relevant) / (tp / retrieved + tp / relevant), 6) as f from counts""",
    "birthdate_from_id": """select c_custkey, code, substr(code, 6, 2) || '.' || substr(code, 4, 2) || '.' || cast(floor((cast(code[1] as int) - 1) / 2 + 18) as int) || substr(code, 2, 2) as born, true as valid
from (select c_custkey, (c_custkey % 4 + 3) || lpad(cast(c_custkey % 100 as varchar), 2, '0') || lpad(cast(c_custkey % 12 + 1 as varchar), 2, '0') || lpad(cast(c_custkey % 28 + 1 as varchar), 2, '0') || '1234' as code from customer)""",
    "ngram_keys": """select distinct p_name, substr(p_name, i, k) as gram from (select distinct p_name, unnest(range(cast(floor(length(p_name) * 0.8) as bigint), length(p_name) + 1)) as k from part), range(1, 200) r(i) where i + k - 1 <= length(p_name)""",
    "fuzzy_nearest": """with parts as (select p_name as form, min(p_partkey) as id from part group by 1), typed as (select form || 's' as name from parts),
a as (select name, substr(name, i, k) as gram from (select name, unnest(range(cast(floor(length(name) * 0.8) as bigint), length(name) + 1)) as k from typed), range(1, 200) r(i) where i + k - 1 <= length(name)),
b as (select id, form, substr(form, i, k) as gram from (select id, form, unnest(range(cast(floor(length(form) * 0.8) as bigint), length(form) + 1)) as k from parts), range(1, 200) r(i) where i + k - 1 <= length(form)),
met as (select name, id, form, max(length(gram)) as size from a join b using (gram) group by all), longest as (select * from met qualify size = max(size) over (partition by name)),
near as (select *, levenshtein(name, form) as d from longest) select name, id, form, size as gram_size, d as distance from near qualify d = min(d) over (partition by name)""",
}
