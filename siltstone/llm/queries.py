"""The llm queries over the standard tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..tables import table
from . import bpe, cotrain, decontam, jaccard, lm, rules, secrets, tokens, toxicity, warc


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.encode_digests(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents"))


def benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(table(spark, sf_dir, "documents"))


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotrain.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": token_counts,
        "op2_toxicity": toxicity_scores,
        "op3_bpe_round_trip": bpe_round_trip,
        "op4_ngram_jaccard_join": ngram_jaccard_join,
        "op5_warc_round_trip": warc_round_trip,
        "op6_benchmark_decontamination": benchmark_decontamination,
        "op7_quality_rules": quality_rules,
        "op8_secret_scans": secret_scans,
        "op9_quality_classifier": quality_classifier,
        "op10_lm_scores": lm_scores,
    }


_WARC_SQL = """with p as (select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as h from pages),
d as (select *, array_to_string(list_transform(range(0, 8), lambda i: array_to_string(list_transform([15, 10, 5, 0], lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast((cast('0x' || substr(h, cast(1 + 5 * i as bigint), 5) as bigint) >> b) % 32 + 1 as bigint), 1)), '')), '') as payload_digest, max(page_id) over (partition by payload) as last from p)
select page_id, strlen(payload) as payload_bytes, payload_digest, case when page_id = last then 'response' else 'revisit' end as record_type, case when page_id <> last then last end as refers_to from d"""

_JACCARD_SQL = """with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as materialized (select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[i:i + 4], ' ') end as sh from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from w where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by 1), c as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.sh = b.sh and a.doc_id <> b.doc_id group by all),
l as materialized (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
r as (select doc_id as a, doc_id as b from documents union select r.a, l.b from r join l on r.b = l.a)
select d.doc_id, coalesce(n, 0) as n_shingles, m as component_id from documents d left join n using (doc_id) join (select a, min(b) as m from r group by a) on a = d.doc_id"""


def _spans_sql() -> str:
    """The spans of every kind by splitting and extracting, the links by a join within the scope."""
    tests = {"assign": r"length(regexp_replace(v, '^[A-Za-z_-]+[\"'']?\x20*[:=]\x20*[\"'']?', '')) >= 6", "access": "length(v) >= 20", "key_id": r"length(regexp_replace(v, '^[A-Za-z_-]+[\"'']?\x20*[:=]\x20*[\"'']?', '')) >= 4", "opaque": "regexp_matches(v, '[0-9]') and regexp_matches(v, '[A-Z]') and regexp_matches(v, '[a-z]')"}
    parts = []
    for rank, (kind, (pattern, _)) in enumerate({**secrets.BASE, **secrets.WEAK}.items(), 1):
        p = pattern.replace("'", "''")
        parts.append(
            f"select doc_id, {rank} as rank, '{kind}' as kind, s, s + length(v) as e from (select doc_id, ms[i] as v, list_sum(list_transform(gs[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) as s from "
            f"(select doc_id, ms, gs, unnest(range(1, len(ms) + 1)) as i from (select doc_id, regexp_extract_all(text, '{p}') as ms, string_split_regex(text, '{p}') as gs from documents where regexp_matches(text, '{p}')))) where {tests.get(kind, 'true')}"
        )
    return f"""with sp as ({" union all ".join(parts)}), j as (select w.doc_id, w.rank, w.kind, w.s, w.e, o.s < w.e and o.e > w.s as over, o.rank as o from sp w join sp o on w.doc_id = o.doc_id and o.s <= w.e + 300 and o.e >= w.s - 300 where w.rank > 3),
f as (select doc_id, rank, kind, s, e, bool_or(over and (o <= 3 or (kind = 'opaque' and o in (4, 6)))) as covered, bool_or(not over and o in (2, 4)) as id, bool_or(not over and o in (1, 3, 5)) as secret, bool_or(not over and o = 6) as endpoint from j group by all),
a as (select doc_id, rank, kind, s, e from sp where rank <= 3 union all select doc_id, rank, kind, s, e from f where not covered and case kind when 'opaque' then id or endpoint when 'key_id' then secret else id and secret end),
g as (select doc_id, count(*) filter (rank = 1) as n1, count(*) filter (rank = 2) as n2, count(*) filter (rank = 3) as n3, string_agg(kind || ':' || cast(s as bigint) || ':' || cast(e as bigint), ',' order by s, rank) as spans, coalesce(string_agg(kind || ':' || cast(s as bigint) || ':' || cast(e as bigint), ',' order by s, rank) filter (rank <= 3), '') as base from a group by 1)
select doc_id, coalesce(n1, 0) as n_assign, coalesce(n2, 0) as n_access, coalesce(n3, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from documents left join g using (doc_id)"""


def oracle_sql() -> dict[str, str]:
    """SQL where it can express a query; tokenizers, fitted models and retrieval have brute-force tests instead."""
    return {"op4_ngram_jaccard_join": _JACCARD_SQL, "op5_warc_round_trip": _WARC_SQL, "op8_secret_scans": _spans_sql()}
