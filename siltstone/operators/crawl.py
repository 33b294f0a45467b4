"""Crawl database.

Records: url, status (byte), fetch_time and fetch_interval (seconds), retries, score, signature, modified.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Status numbers of the record format.
DB_UNFETCHED, DB_FETCHED, DB_GONE, DB_REDIR_TEMP, DB_REDIR_PERM, DB_NOTMODIFIED = 1, 2, 3, 4, 5, 6
FETCH_SUCCESS, FETCH_RETRY, FETCH_REDIR_TEMP, FETCH_REDIR_PERM, FETCH_GONE, FETCH_NOTMODIFIED = 0x21, 0x22, 0x23, 0x24, 0x25, 0x26
SIGNATURE, INJECTED, LINKED = 0x41, 0x42, 0x43
NAMES = {1: "db_unfetched", 2: "db_fetched", 3: "db_gone", 4: "db_redir_temp", 5: "db_redir_perm", 6: "db_notmodified"}


def status_name(status: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in NAMES.items() for x in kv)), status.cast("int"))


def adaptive(interval: Column, modified: Column, inc: float = 0.2, dec: float = 0.2, low: float = 60.0, high: float = 31_536_000.0) -> Column:
    """A shorter interval after a change, a longer one without, within bounds. modified: 1 changed, 2 not, 0 unknown."""
    changed = F.when(modified == 1, interval * (1 - dec)).when(modified == 2, interval * (1 + inc)).otherwise(interval)
    return F.greatest(F.lit(low), F.least(F.lit(high), changed))


def gone_interval(interval: Column, high: float = 0.0) -> Column:
    """Half as much again; with a maximum, nine tenths of that where it would be passed."""
    longer = interval * 1.5
    return F.when(longer > high, F.lit(0.9 * high)).otherwise(longer) if high > 0 else longer


def retry_time(fetch_time: Column) -> Column:
    """A day later."""
    return fetch_time + 86_400


def should_fetch(fetch_time: Column, now: int, max_interval: int = 0) -> Column:
    """due, or so far ahead that it cannot be right."""
    due = fetch_time <= now
    return due | (fetch_time - now > max_interval) if max_interval > 0 else due


def not_generated(generated: Column, now: int, delay: int = 7 * 86_400) -> Column:
    """not in a list of the last days."""
    return generated.isNull() | (generated + delay <= now)


def update(records: DataFrame, additions: bool = True, retry_max: int = 3, initial_score: float = 0.0) -> DataFrame:
    """The next record of each url from its old, fetched, linked and signature records, in one aggregation.

    The latest old and fetch records count (ties: the larger record); without a fetch, a link stands in. Link scores add up.
    """
    s = F.col("status")
    db, fetch, link = s.between(1, 6), s.between(0x21, 0x26), s == LINKED
    rec = F.struct("fetch_time", "status", "fetch_interval", "retries", "score", "signature", "modified")
    g = records.groupBy("url").agg(
        F.max(F.when(db, rec)).alias("old"),
        F.max(F.when(fetch, rec)).alias("fetch"),
        F.min(F.when(link, rec)).alias("link"),
        F.max(F.when(s == SIGNATURE, F.col("signature"))).alias("sig"),
        F.sum(F.when(link, F.col("score")).otherwise(0.0)).alias("gift"),
    )
    g = g.where(F.col("old").isNotNull() | F.lit(additions)).where("old is not null or fetch is not null or link is not null")
    old, new = F.col("old"), F.coalesce("fetch", "link")
    signature = F.coalesce("sig", new["signature"])
    changed = F.when(new["status"] == FETCH_NOTMODIFIED, 2).when(old["signature"].isNotNull() & signature.isNotNull(), F.when(old["signature"] != signature, 1).otherwise(2)).otherwise(0)
    success = new["status"].isin(FETCH_SUCCESS, FETCH_REDIR_TEMP, FETCH_REDIR_PERM, FETCH_NOTMODIFIED)
    retry, gone = new["status"] == FETCH_RETRY, new["status"] == FETCH_GONE
    keep = new.isNull() | ((new["status"] == LINKED) & old.isNotNull())
    first = (new["status"] == LINKED) & old.isNull()
    retries = F.when(retry, new["retries"] + 1).otherwise(F.when(success, 0).otherwise(new["retries"]))
    kind = F.when(new["status"] == FETCH_SUCCESS, DB_FETCHED).when(new["status"] == FETCH_REDIR_PERM, DB_REDIR_PERM).when(new["status"] == FETCH_REDIR_TEMP, DB_REDIR_TEMP)
    status = F.when(keep, old["status"]).when(first, DB_UNFETCHED).when(success & (changed == 2), DB_NOTMODIFIED).when(success, F.coalesce(kind, old["status"], F.lit(DB_UNFETCHED)))
    status = status.when(retry, F.when(retries < retry_max, DB_UNFETCHED).otherwise(DB_GONE)).otherwise(DB_GONE)
    interval = F.when(keep, old["fetch_interval"]).when(success, adaptive(new["fetch_interval"], changed)).when(gone, gone_interval(new["fetch_interval"])).otherwise(new["fetch_interval"])
    time = F.when(keep, old["fetch_time"]).when(first, new["fetch_time"]).when(retry, retry_time(new["fetch_time"])).otherwise(new["fetch_time"] + F.floor(interval).cast("bigint"))
    mark = F.when(keep, old["signature"]).when(first, F.lit(None)).when(success & (changed != 2), signature).otherwise(old["signature"])
    score = F.when(first, F.lit(initial_score)).otherwise(F.coalesce(old["score"], F.lit(0.0))) + F.col("gift")
    return g.select("url", status.cast("bigint").alias("status"), time.cast("bigint").alias("fetch_time"), F.round(interval, 3).cast("double").alias("fetch_interval"), F.when(keep, old["retries"]).otherwise(retries).cast("bigint").alias("retries"), F.round(score, 6).alias("score"), mark.alias("signature"))


def inject(db: DataFrame, seeds: DataFrame) -> DataFrame:
    """The database with the seeds it lacks."""
    return db.unionByName(seeds.join(db.select("url"), "url", "left_anti").dropDuplicates(["url"]))


def merge(records: DataFrame) -> DataFrame:
    """The latest record of each url with the metadata of all, newer values over older ones. records: url, fetch_time, status, meta."""
    g = records.groupBy("url").agg(F.array_sort(F.collect_list(F.struct("fetch_time", "status", F.map_entries("meta").alias("m")))).alias("all"))
    entries = F.flatten(F.transform("all", lambda r: r["m"]))
    keys = F.array_sort(F.array_distinct(F.transform(entries, lambda e: e["key"])))
    meta = F.transform(keys, lambda k: F.concat(k, F.lit("="), F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]))
    return g.select("url", F.element_at("all", -1)["fetch_time"].alias("fetch_time"), F.element_at("all", -1)["status"].alias("status"), F.array_join(meta, ",").alias("meta"))


def segment_merge(parts: DataFrame) -> DataFrame:
    """Of each key and part the row of the last segment."""
    return parts.withColumn("_n", F.row_number().over(W.partitionBy("key", "part").orderBy(F.desc("segment")))).where("_n = 1").drop("_n")


def stats(db: DataFrame) -> DataFrame:
    """Totals, and by status, retries, and status with host, in one pass over grouping sets; scores times 1000."""
    status, retries, host = F.col("status"), F.col("retries"), F.col("host")
    scaled = F.floor(F.col("score") * 1000).cast("bigint")
    sets = db.groupingSets([[], [status], [retries], [status, host]], status, retries, host)
    return sets.agg(F.count("*").alias("n"), F.min(scaled).alias("score_min"), F.max(scaled).alias("score_max"), F.sum(scaled).alias("score_sum"))


def domain_stats(db: DataFrame, key: Column) -> DataFrame:
    """Records by host, domain or suffix, with the fetched and the other ones."""
    fetched = F.col("status").isin(DB_FETCHED, DB_NOTMODIFIED)
    return db.groupBy(key.alias("name")).agg(F.count("*").alias("n"), F.count_if(fetched).alias("fetched"), F.count_if(~fetched).alias("not_fetched"))


def fetch_list(db: DataFrame, now: int, top: int, per_host: int, host: Column, min_score: float = 0.0) -> DataFrame:
    """The `top` best due records, at most `per_host` of a host; exact over all partitions, ties by url."""
    due = db.where(should_fetch(F.col("fetch_time"), now) & not_generated(F.col("generated"), now) & (F.col("score") >= min_score))
    few = due.withColumn("host", host).withColumn("_n", F.row_number().over(W.partitionBy("host").orderBy(F.desc("score"), "url"))).where(F.col("_n") <= per_host)
    return few.drop("_n").orderBy(F.desc("score"), "url").limit(top)


def top_scores(db: DataFrame, n: int, least: float = 0.0) -> DataFrame:
    """O2, F23."""
    return db.where(F.col("score") >= least).orderBy(F.desc("score"), "url").limit(n)


def newest_by_url(docs: DataFrame) -> DataFrame:
    """K1: the newest document of each url; ties: the smallest id."""
    return docs.withColumn("_n", F.row_number().over(W.partitionBy("url").orderBy(F.desc("tstamp"), "doc_id"))).where("_n = 1").drop("_n")


def best_by_digest(docs: DataFrame, newer: bool = False) -> DataFrame:
    """K2: of equal signatures the highest boost, then the shortest url, then the smallest id; K4 (newer): then the newest."""
    order = [F.desc("boost"), F.desc("tstamp"), "doc_id"] if newer else [F.desc("boost"), F.length("url"), "doc_id"]
    return docs.withColumn("_n", F.row_number().over(W.partitionBy("digest").orderBy(*order))).where("_n = 1").drop("_n")


def delete_list(docs: DataFrame) -> DataFrame:
    """K3: what the two steps leave out."""
    return docs.join(best_by_digest(newest_by_url(docs)).select("doc_id"), "doc_id", "left_anti")


def unprocessed(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Paths not in the ledger."""
    return listed.join(ledger.select("path"), "path", "left_anti")


def sampled(urls: DataFrame, denominator: int, skew: int = 0) -> DataFrame:
    """The urls whose MD5 falls into one of so many parts."""
    return urls.where(F.pmod(F.conv(F.substring(F.md5("url"), 1, 8), 16, 10).cast("bigint") + skew, F.lit(denominator)) == 0)
