"""Secret scans with DataFrame functions only: certain secrets by pattern, weak ones by the parts they co-occur with.

A multipart credential is an identifier, a secret and perhaps an endpoint near each other. Identifiers, opaque strings and
endpoints are too common to report alone; an interval join of the spans within a scope keeps those with a complement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

#: Base kinds: pattern, and the test of a match. Then the weak kinds, likewise.
BASE = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", r"""["':=\x20][A-Za-z0-9+/_.=-]{6,}$"""),
    "access": (r"AKIA[A-Z0-9]+", r"^.{20,}$"),
    "hex": (r"[0-9a-f]{24,}", r"."),
}
WEAK = {
    "key_id": (r"""(?i:(?:access|client|account)[_-]?(?:key[_-]?)?id|user[_-]?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]+""", r"""["':=\x20][A-Za-z0-9+/_.@-]{4,}$"""),
    "opaque": (r"[A-Za-z0-9+/_=-]{32,}", r"^(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z])"),
    "endpoint": (r"""(?i:https?|ftps?|postgres|postgresql|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]+""", r"."),
}
KINDS = [*BASE, *WEAK]
#: What each kind is a part of a credential as.
ROLE = {"assign": "secret", "hex": "secret", "opaque": "secret", "access": "id", "key_id": "id", "endpoint": "endpoint"}


def _found(text: Column, pattern: str) -> tuple[Column, Column]:
    """Lengths between the leftmost non-overlapping matches, and the matches; empty where there is none."""
    p = F.lit(pattern)
    hit = F.regexp_like(text, p)
    gaps = F.when(hit, F.transform(F.split(text, pattern, -1), lambda x: F.length(x)))
    return F.coalesce(gaps, F.array().cast("array<int>")), F.coalesce(F.when(hit, F.regexp_extract_all(text, p, F.lit(0))), F.array().cast("array<string>"))


def _checked(kind: Column, value: Column) -> Column:
    """Whether a match passes its kind's test. The value of an assignment is what follows its first : or =."""
    tests = {**BASE, **WEAK}
    out = F.lit(False)
    for name, (_, test) in tests.items():
        if name in ("assign", "key_id"):
            least = 6 if name == "assign" else 4
            tail = F.regexp_replace(value, r"""^[A-Za-z_-]+["']?\x20*[:=]\x20*["']?""", "")
            out = F.when(kind == name, F.length(tail) >= least).otherwise(out)
        else:
            out = F.when(kind == name, F.regexp_like(value, F.lit(test))).otherwise(out)
    return out


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def find_parts(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: _id, _key (digest of a text with any match, else a value of its own), _hits: kind, gaps, matches."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    found = {k: _found(F.col("_text"), p) for k, (p, _) in {**BASE, **WEAK}.items()}
    hits = F.filter(F.array(*(F.struct(F.lit(k).alias("kind"), g.alias("gaps"), m.alias("matches")) for k, (g, m) in found.items())), lambda x: F.size(x["matches"]) > 0)
    rows = source.select("_id", "_text", hits.alias("_hits"))
    return rows.select("_id", F.when(F.size("_hits") > 0, F.sha2("_text", 256)).otherwise(F.concat(F.lit("-"), F.coalesce(F.col("_id").cast("string"), F.lit("")))).alias("_key"), "_hits")


def spans_of(parts: DataFrame) -> DataFrame:
    """_key, kind, start, end (code points, end exclusive) of all matches that pass their test, once for each text."""
    hit = parts.select("_key", F.explode("_hits").alias("h")).select("_key", "h.kind", F.posexplode(F.arrays_zip(F.expr("slice(h.gaps, 1, size(h.matches))").alias("gap"), F.col("h.matches").alias("value"))).alias("i", "m"))
    one = hit.select("_key", "kind", "i", F.col("m.gap").alias("gap"), F.col("m.value").alias("value"), F.length("m.value").alias("size")).distinct()
    at = one.selectExpr("_key", "kind", "value", "size", "sum(gap + size) over (partition by _key, kind order by i) as end")
    return at.where(_checked(F.col("kind"), F.col("value"))).select("_key", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def linked(spans: DataFrame, scope: int = 300) -> DataFrame:
    """The weak spans to report: those that overlap no stronger span and have their complement within `scope` code points.

    An opaque string needs an identifier or an endpoint, an identifier a secret, an endpoint both others. The join is by
    text and cell of `scope` code points, so that no cell holds more spans than fit into it.
    """
    cells = lambda lo, hi: F.explode(F.sequence(F.floor(lo / scope), F.floor(hi / scope)))
    role = F.element_at(F.create_map(*(F.lit(x) for kv in ROLE.items() for x in kv)), F.col("kind"))
    weak = F.col("kind").isin(list(WEAK))
    near = spans.where(weak).select("_key", "kind", "start", "end", cells(F.greatest(F.col("start") - scope, F.lit(0)), F.col("end") + scope).alias("cell"))
    other = spans.select("_key", F.col("kind").alias("o_kind"), role.alias("role"), F.col("start").alias("o_start"), F.col("end").alias("o_end"), cells(F.col("start"), F.col("end") - 1).alias("cell"))
    both = near.join(other, ["_key", "cell"]).where((F.col("o_start") <= F.col("end") + scope) & (F.col("o_end") >= F.col("start") - scope))
    overlap = (F.col("o_start") < F.col("end")) & (F.col("o_end") > F.col("start"))
    stronger = overlap & (F.col("o_kind").isin(list(BASE)) | ((F.col("kind") == "opaque") & (F.col("o_kind").isin("key_id", "endpoint"))))
    seen = both.groupBy("_key", "kind", "start", "end").agg(
        F.max(stronger).alias("covered"),
        *(F.max(~overlap & (F.col("role") == r)).alias(r) for r in ("id", "secret", "endpoint")),
    )
    needs = F.when(F.col("kind") == "opaque", F.col("id") | F.col("endpoint")).when(F.col("kind") == "key_id", F.col("secret")).otherwise(F.col("id") & F.col("secret"))
    return seen.where(~F.col("covered") & needs).select("_key", "kind", "start", "end")


def _joined(rows: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    return F.array_join(F.transform(rows, lambda x: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), x["rank"].cast("int")), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _per_text(parts: DataFrame, scope: int) -> DataFrame:
    """_k (key of a text), _s and _b: its spans (start, rank, end), all and base ones."""
    spans = stored(spans_of(parts), "spans")
    all_spans = spans.where(F.col("kind").isin(list(BASE))).unionByName(linked(spans, scope))
    packed = F.struct(F.col("start").cast("long").alias("start"), _rank(F.col("kind")).alias("rank"), F.col("end").cast("long").alias("end"))
    per_text = all_spans.groupBy(F.col("_key").alias("_k")).agg(F.array_sort(F.collect_list(packed)).alias("_s"))
    return per_text.select("_k", "_s", F.filter("_s", lambda x: x["rank"] <= len(BASE)).alias("_b"))


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 300) -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base_sha256, spans (kind:start:end by start, then kind).

    Base spans stay whatever the linking says. A null or empty text has no spans; repeated rows and copies of a text get
    the same spans, which are worked out once; an empty table gives no rows. Texts are searched whole. Only id and text
    are read, so other columns may have any name.
    """
    parts = stored(find_parts(docs, text_col, id_col), "parts")
    per_text = _per_text(parts, scope)
    result = per_text.select(
        "_k",
        *(F.expr(f"cast(size(filter(_b, x -> x.rank = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(BASE, 1)),
        F.sha2(_joined(F.col("_b")), 256).alias("base_sha256"),
        _joined(F.col("_s")).alias("spans"),
    )
    rows = parts.select("_id", "_key").join(result, F.col("_key") == F.col("_k"), "left")
    return rows.select(
        F.col("_id").alias(id_col),
        *(F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in BASE),
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


#: Most bytes of spans (about 80 each with its digest) that are broadcast to the texts; more are joined by a shuffle.
BROADCAST_BYTES = 16 << 20


def redact_secrets(docs: DataFrame, text_col: str = "text", scope: int = 300, mark: str = "[secret]") -> DataFrame:
    """The rows with every span of scan_secrets, overlapping ones as one, replaced by a mark; all else stays as it is.

    Spans are found once for each text and joined by its digest, so repeated rows and null ids need no care. Null and
    empty texts stay. A column n_chars of the table is set anew where the text changes.
    """
    parts = stored(find_parts(docs.select(text_col).withColumn("_none", F.lit(None).cast("long")), text_col, "_none").where(F.size("_hits") > 0), "parts")
    merged = F.aggregate(
        "_s",
        F.array().cast("array<struct<start: bigint, end: bigint>>"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] > x["start"]),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(F.element_at(done, -1)["start"].alias("start"), F.greatest(F.element_at(done, -1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(done, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))),
    )
    found = stored(_per_text(parts, scope).select(F.col("_k").alias("_digest"), F.when(F.size("_s") > 0, merged).alias("_cut")), "cuts")
    room = found.agg(F.count("*") + F.coalesce(F.sum(F.size("_cut")), F.lit(0))).first()[0]
    text = F.col(text_col)
    rows = docs.withColumn("_of", F.sha2(F.coalesce(text, F.lit("")), 256)).join(F.broadcast(found) if room * 80 <= BROADCAST_BYTES else found, F.col("_of") == F.col("_digest"), "left")
    pieces = F.expr(f"transform(_cut, (x, i) -> substring(`{text_col}`, cast(if(i = 0, 0, _cut[i - 1].end) + 1 as int), cast(x.start - if(i = 0, 0, _cut[i - 1].end) as int)))")
    rest = F.expr(f"substring(`{text_col}`, cast(element_at(_cut, -1).end + 1 as int))")
    clean = F.concat(F.array_join(F.transform(pieces, lambda x: F.concat(x, F.lit(mark))), ""), rest)
    changed = F.col("_cut").isNotNull()
    out = rows.withColumn("_new", F.when(changed, clean).otherwise(text))
    return out.select(*(F.when(changed, F.length("_new").cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name) if f.name == "n_chars" else (F.col("_new").alias(f.name) if f.name == text_col else F.col(f.name)) for f in docs.schema))
