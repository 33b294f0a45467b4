"""Queries that run a stream to its end, and annotation baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.annotate import annotate
from ..streaming import ingest as N
from ..tables import shared_folder, table


def stream_ingest_counts(spark, sf):
    """Events through an ingesting stream, counted by type from the table it wrote."""
    base = shared_folder(spark, "stream")
    N.ingest(N.first_only(N.stream(spark, sf)), f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(N.EVENTS).parquet(f"{base}/out").groupBy("event_type").agg(F.count("*").alias("n"))


def hourly_counts(spark, sf):
    """The windowed aggregation over all events, as a batch."""
    return N.windowed_counts(table(spark, sf, "events"), "1 hour")


def user_sessions(spark, sf):
    return N.sessions(table(spark, sf, "events")).select("user_id", "start", "end", "n")


def annotate_baseline(spark, sf):
    """Tokens, lemmas, tags and names of every document by the rule baseline."""
    a = annotate(F.col("text"))
    rows = table(spark, sf, "documents").select("doc_id", a.alias("a"))
    return rows.select("doc_id", F.size("a.tokens").cast("bigint").alias("n_tokens"), F.size("a.names").cast("bigint").alias("n_names"), F.col("a.status").alias("status"))


QUERIES = {f.__name__: f for f in (stream_ingest_counts, hourly_counts, user_sessions, annotate_baseline)}
SQL = {
    "stream_ingest_counts": "select event_type, count(*) as n from events group by 1",
    "hourly_counts": "select date_trunc('hour', ts) as start, event_type, count(*) as n from events group by all",
    "user_sessions": """with o as (select *, lag(ts) over (partition by user_id order by ts) as p from events), s as (select *, sum(case when p is null or ts >= p + interval 30 minute then 1 else 0 end) over (partition by user_id order by ts, event_id rows unbounded preceding) as k from o)
select user_id, min(ts) as start, max(ts) + interval 30 minute as "end", count(*) as n from s group by user_id, k""",
}
