"""Which pages a crawl would reach: level-wise search over the link graph."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.urls import kb_id, normalized_url
from corpusloom.session import written


@dataclass(frozen=True)
class CrawlConfig:
    """What a crawl starts from and how far it goes: search words with the depth of each, and the most pages to fetch."""

    keywords: tuple[tuple[str, int], ...] = ()
    max_articles: int = 1000


def legacy_pages(articles: DataFrame) -> DataFrame:
    """(id): articles under the older kind of key (`KB` and digits), which a crawl skips."""
    return articles.where(kb_id(F.col("url")).startswith("KB")).select("id")


def latest_metadata(found: DataFrame, order: str, columns: list[str]) -> DataFrame:
    """(name, columns): for each normalized URL of `found` (url, order, columns) the last row by `order`."""
    rows = found.select(normalized_url(F.col("url")).alias("name"), F.struct(order, *columns).alias("row")).where("name is not null")
    return rows.groupBy("name").agg(F.max("row").alias("row")).select("name", *[F.col(f"row.{c}").alias(c) for c in columns])


def with_metadata(pages: DataFrame, metadata: DataFrame, columns: list[str]) -> DataFrame:
    """`pages` (url, ...) with the columns of latest_metadata(); null where the URL is not among the results."""
    side = metadata.select("name", *[F.col(c).alias(f"found_{c}") for c in columns])
    return pages.withColumn("name", normalized_url(F.col("url"))).join(side, "name", "left").drop("name")


def reach_by_keywords(links: DataFrame, articles: DataFrame, config: CrawlConfig, skip: DataFrame | None = None) -> DataFrame:
    """(id, depth): articles within reach of those whose title holds a keyword, each keyword to its own depth; `skip` (id) are never met.

    Keywords of one depth are one search, so the searches are as many as the depths in the configuration.
    """
    title, met = F.lower("title"), None
    edges = links if skip is None else links.join(skip.select(F.col("id").alias("target_id")), "target_id", "left_anti")
    for depth in sorted({d for _, d in config.keywords}):
        words = [k.lower() for k, d in config.keywords if d == depth]
        seeds = articles.where(F.exists(F.array(*map(F.lit, words)), lambda k: F.contains(title, k))).select("id")
        seeds = seeds if skip is None else seeds.join(skip.select("id"), "id", "left_anti")
        found = reach(edges, seeds, depth)
        met = found if met is None else met.unionByName(found)
    if met is None:
        return articles.select("id", F.lit(0).alias("depth")).limit(0)
    return met.groupBy("id").agg(F.min("depth").alias("depth"))


def next_pages(met: DataFrame, articles: DataFrame, config: CrawlConfig) -> DataFrame:
    """(id, depth): the pages to fetch next, nearest first, `max_articles` at most."""
    todo = articles.where(~F.coalesce(F.col("content") != "", F.lit(False))).select("id")
    return met.join(todo, "id", "left_semi").orderBy("depth", "id").limit(config.max_articles)


def reach(links: DataFrame, seeds: DataFrame, max_depth: int) -> DataFrame:
    """(id, depth): articles within `max_depth` links of `seeds` (id), each at its least depth.

    Each level is one join of the frontier with the distinct links and an anti-join with what was met; levels are written
    to the shared folder. A hub met once is never expanded again.
    """
    edges = links.select("source_id", "target_id").where("source_id <> target_id").distinct()
    frontier = written(seeds.select("id").where("id is not null").distinct().withColumn("depth", F.lit(0)), "frontier")
    met = frontier
    for depth in range(1, max_depth + 1):
        step = frontier.join(edges, frontier.id == edges.source_id).select(F.col("target_id").alias("id")).distinct()
        frontier = written(step.join(met.select("id"), "id", "left_anti").withColumn("depth", F.lit(depth)), "frontier")
        if frontier.isEmpty():
            break
        met = met.unionByName(frontier)
    return met


def frontier_stats(met: DataFrame) -> DataFrame:
    """(depth, pages) of reach()."""
    return met.groupBy("depth").agg(F.count("*").alias("pages"))


def plan(met: DataFrame, articles: DataFrame, max_depth: int) -> DataFrame:
    """(id, depth, fetch, expand): whether a reached page still has to be fetched, and whether its links are followed."""
    a = articles.select("id", (F.coalesce(F.col("content") != "", F.lit(False))).alias("crawled"))
    return met.join(a, "id").select("id", "depth", (~F.col("crawled")).alias("fetch"), (F.col("depth") < max_depth).alias("expand"))
