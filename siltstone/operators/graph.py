"""Link database, web graph and link rank."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.urls import domain, host, page
from ..tables import written


def inlink_counts(links: DataFrame) -> DataFrame:
    """Links to each address; partial sums on the map side."""
    return links.groupBy("to_url").agg(F.count("*").alias("inlinks"))


def page_ranker(links: DataFrame, threshold: int = 10) -> DataFrame:
    """addresses of the web with at least `threshold` inlinks."""
    return inlink_counts(links).where((F.col("inlinks") >= threshold) & F.startswith("to_url", F.lit("http")))


def invert(links: DataFrame, cap: int = 10_000) -> DataFrame:
    """to_url with its distinct inlinks (from, anchor), in order, `cap` at most (a setting of the link database).

    The cap is applied by a window, so that no task gathers more than that for one address.
    """
    pairs = links.groupBy("to_url", "from_url", "anchor").agg(F.count("*").alias("_n"))
    top = pairs.withColumn("n", F.row_number().over(W.partitionBy("to_url").orderBy("from_url", "anchor"))).where(F.col("n") <= cap)
    return top.groupBy("to_url").agg(F.array_sort(F.collect_list(F.struct("from_url", "anchor"))).alias("inlinks"))


def distinct_anchors(links: DataFrame) -> DataFrame:
    """Anchors of each address, one for each source host."""
    return links.where(F.length("anchor") > 0).select("to_url", host(F.col("from_url")).alias("host"), "anchor").distinct()


def web_graph(links: DataFrame, ignore_internal_host: bool = True, ignore_internal_domain: bool = False, limit_page: bool = True, limit_domain: bool = True) -> DataFrame:
    """Outlinks of each page's latest fetch; one link by target page and by target domain, the first in order.

    links: from_url, to_url, anchor, ts (a number or timestamp). One aggregation finds each group's first link of its latest
    time, and that time; only those rows, a few for each page, are compared with the page's latest fetch. Partial results are
    made where the links are read.
    """
    counts = F.col("ts").isNotNull() & (F.col("from_url") != F.col("to_url"))
    if ignore_internal_host:
        counts &= host(F.col("from_url")) != host(F.col("to_url"))
    if ignore_internal_domain:
        counts &= domain(F.col("from_url")) != domain(F.col("to_url"))
    time = F.unix_micros("ts") if links.schema["ts"].dataType.typeName() == "timestamp" else F.col("ts")
    rest = [c for c in links.columns if c not in ("from_url", "to_url", "anchor", "ts")]
    row = F.struct((-time).alias("_t"), "to_url", "anchor", "ts", *rest)
    group = domain(F.col("to_url")) if limit_domain else F.col("to_url")  # the first of a domain is the first of its page
    best = links.groupBy("from_url", group.alias("_g")).agg(F.max("ts").alias("_m"), F.min(F.when(counts, row)).alias("_r"))
    last = best.withColumn("_last", F.max("_m").over(W.partitionBy("from_url"))).where("_r is not null and _r.ts = _last")
    return last.select(*(F.col(c) if c == "from_url" else F.col("_r")[c].alias(c) for c in links.columns))


def nodes(edges: DataFrame) -> DataFrame:
    """Url with its inlinks and outlinks; both ends are counted in one aggregation."""
    ends = edges.select(F.col("from_url").alias("url"), F.lit(0).alias("i"), F.lit(1).alias("o")).union(edges.select("to_url", F.lit(1), F.lit(0)))
    return ends.groupBy("url").agg(F.sum("i").alias("inlinks"), F.sum("o").alias("outlinks"))


def loops(edges: DataFrame) -> DataFrame:
    """(url, other) on a cycle of two or three links through url.

    A cycle of three is found once, from its page with fewest links (ties by address): one link comes to it and one goes
    from it, both between it and pages with more, and a third closes them. So a hub's links are never paired with each other,
    and the pairs made are at most the number of links to the power of 1.5.
    """
    e = edges.select("from_url", "to_url").where("from_url <> to_url").distinct()
    ends = e.select(F.col("from_url").alias("url")).union(e.select("to_url")).groupBy("url").agg(F.count("*").alias("links"))
    ranked = e.join(ends.toDF("from_url", "f"), "from_url").join(ends.toDF("to_url", "t"), "to_url").select("from_url", "to_url", (F.struct("f", "from_url") < F.struct("t", "to_url")).alias("up"))
    two = e.intersect(e.select(F.col("to_url").alias("from_url"), F.col("from_url").alias("to_url")))
    wedges = ranked.where("not up").select(F.col("from_url").alias("u"), F.col("to_url").alias("v")).join(ranked.where("up").select(F.col("from_url").alias("v"), F.col("to_url").alias("w")), "v").where("u <> w")
    three = wedges.join(e.select(F.col("from_url").alias("w"), F.col("to_url").alias("u")), ["w", "u"], "left_semi")
    pairs = three.select(F.explode(F.array(*(F.struct(F.col(a).alias("url"), F.col(b).alias("other")) for a in "uvw" for b in "uvw" if a != b))).alias("p")).select("p.*")
    return two.toDF("url", "other").union(pairs).distinct()


def once_for_each_source(edges: DataFrame, limit_page: bool = True, limit_domain: bool = True) -> DataFrame:
    """Of each target's inlinks one from a source page (address without query) and one from a source domain; the first
    by address. A domain's first is the first of one of its pages, so with both limits the domain's one does for both."""
    if not (limit_page or limit_domain):
        return edges
    key = domain(F.col("from_url")) if limit_domain else page(F.col("from_url"))
    return edges.groupBy("to_url", key.alias("_k")).agg(F.min("from_url").alias("from_url")).select("from_url", "to_url")


def link_rank(edges: DataFrame, iterations: int = 10, damping: float = 0.85, skip: DataFrame | None = None, checkpoint_every: int = 5, limit_page: bool = False, limit_domain: bool = False) -> DataFrame:
    """Url, rank after so many rounds of rank = (1 - d) + d * (1 / N + sum of rank / outdegree over inlinks).

    skip: loop pairs (url, other) whose edges do not count (J16). limit_page, limit_domain: see once_for_each_source. Links
    are made distinct once and written; what else is needed of them is read from there. Edges carry their source's outdegree and are written once; each round joins the ranks, which are as many as nodes, and sums
    by target. Ranks are written to the shared folder every few rounds, which cuts the lineage.
    """
    every = written(edges.select("from_url", "to_url").distinct(), "links")
    e = every
    if skip is not None:
        e = e.join(skip.select(F.col("url").alias("from_url"), F.col("other").alias("to_url")), ["from_url", "to_url"], "left_anti")
    urls = written(every.select(F.col("from_url").alias("url")).distinct().union(every.select("to_url").distinct()).distinct(), "urls")
    degree = e.groupBy("from_url").agg(F.count("*").alias("degree"))
    if limit_page or limit_domain:  # a page still gives its rank to all its links
        e = once_for_each_source(e, limit_page, limit_domain)
    weighted = written(e.join(degree, "from_url"), "edges")
    # the joined side is one row, the number of nodes
    ranks = urls.crossJoin(F.broadcast(urls.agg(F.count("*").alias("n")))).withColumn("rank", F.lit(1.0))
    for i in range(1, iterations + 1):
        given = weighted.join(ranks.select(F.col("url").alias("from_url"), "rank"), "from_url").groupBy(F.col("to_url").alias("url")).agg(F.sum(F.col("rank") / F.col("degree")).alias("given"))
        ranks = ranks.select("url", "n").join(given, "url", "left").select("url", "n", (F.lit(1 - damping) + damping * (1 / F.col("n") + F.coalesce("given", F.lit(0.0)))).alias("rank"))
        if i % checkpoint_every == 0 and i < iterations:
            ranks = written(ranks, "ranks")
    return ranks.select("url", "rank")


def update_scores(crawl: DataFrame, ranks: DataFrame, clear: float = 0.0) -> DataFrame:
    """Crawl records with the node's rank as score; without one, `clear`."""
    return crawl.drop("score").join(ranks.select("url", F.col("rank").alias("score")), "url", "left").withColumn("score", F.coalesce("score", F.lit(clear)))


def top_nodes(table: DataFrame, by: str, n: int) -> DataFrame:
    """O3: the n nodes with most of something; exact, ties by url."""
    return table.orderBy(F.desc(by), "url").limit(n)


def link_dump(edges: DataFrame, ranks: DataFrame, cap: int = 50_000) -> DataFrame:
    """Of each address its inlinking pages with their rank, best first, at most `cap`."""
    e = edges.select("from_url", "to_url").distinct().join(ranks.select(F.col("url").alias("from_url"), "rank"), "from_url")
    return e.withColumn("place", F.row_number().over(W.partitionBy("to_url").orderBy(F.desc("rank"), "from_url"))).where(F.col("place") <= cap)


def top_anchors(fields: DataFrame, edges: DataFrame, ranks: DataFrame, k: int = 3) -> DataFrame:
    """Of each known page the k anchors with the highest-ranked source."""
    e = edges.where(F.length("anchor") > 0).select(F.col("to_url").alias("url"), "from_url", "anchor").distinct()
    e = e.join(fields.select("url").distinct(), "url", "left_semi").join(ranks.select(F.col("url").alias("from_url"), "rank"), "from_url")
    return e.withColumn("place", F.row_number().over(W.partitionBy("url").orderBy(F.desc("rank"), "from_url", "anchor"))).where(F.col("place") <= k)


def opic(scores: DataFrame, links: DataFrame, internal: float = 1.0, external: float = 1.0) -> DataFrame:
    """Url, old score plus what linking pages give: their score over their outlinks, times a factor by kind of link."""
    e = links.select("from_url", "to_url").distinct()
    out = e.groupBy("from_url").agg(F.count("*").alias("n"))
    factor = F.when(host(F.col("from_url")) == host(F.col("to_url")), internal).otherwise(external)
    gift = e.join(out, "from_url").join(scores.select(F.col("url").alias("from_url"), "score"), "from_url").groupBy(F.col("to_url").alias("url")).agg(F.sum(F.col("score") / F.col("n") * factor).alias("gift"))
    return scores.join(gift, "url", "full_outer").select("url", (F.coalesce("score", F.lit(0.0)) + F.coalesce("gift", F.lit(0.0))).alias("score"))


def boosts(score: Column, rank: Column, terms: Column) -> dict[str, Column]:
    """Index boost, rank boost, length norms of url, anchor, content and other fields."""
    return {
        "index_boost": F.pow(score, 0.5),
        "rank_boost": F.log10(rank) + 1,
        "norm_url": 1 / terms,
        "norm_anchor": 1 / F.log(F.lit(2.718281828459045) + terms),
        "norm_content": 1 / F.sqrt(F.greatest(terms, F.lit(1000))),
        "norm_other": 1 / F.sqrt(terms),
    }


def product_of(columns: list[Column]) -> Column:
    """Product of boosts, missing ones count as 1."""
    return reduce(lambda a, b: a * b, (F.coalesce(c, F.lit(1.0)) for c in columns), F.lit(1.0))
