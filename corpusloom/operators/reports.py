"""JSON and Markdown reports, and the flattening of search replies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(top: DataFrame) -> DataFrame:
    """A limited, ordered frame with `rank` by total_articles and id; meant for reports of a few rows."""
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("total_articles"), "id")))


def search_results(replies: DataFrame, column: str) -> DataFrame:
    """(id, title, link, number, can_read) of each knowledge hit in replies of the form data.results.results[]; missing values get defaults."""
    schema = "data struct<results:struct<results:array<struct<id:string,link:string,meta:struct<source:string,title:struct<display_value:string>,number:string,can_read:string>>>>>"
    hits = replies.select(F.inline(F.from_json(column, schema)["data"]["results"]["results"])).where("meta.source = 'knowledge'")
    text = lambda c, d: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(d))
    return hits.select("id", F.coalesce("meta.title.display_value", F.lit("")).alias("title"), "link", text("meta.number", "").alias("number"), text("meta.can_read", "Public").alias("can_read"))


def sidebar_json(side: DataFrame) -> DataFrame:
    """(category, json): each category with its entries in order. A category has at most as many entries as its list."""
    entry = F.struct("place", "entry", "topic_id", "article_count")
    by = side.groupBy("category").agg(F.max("category_count").alias("article_count"), F.array_sort(F.collect_list(entry)).alias("children"))
    return by.select("category", F.to_json(F.struct("category", "article_count", "children")).alias("json"))


def issues_json(issues: DataFrame) -> DataFrame:
    """(topic_id, json): one JSON line for each topic with issues; a topic has at most three."""
    by = issues.groupBy("topic_id").agg(F.array_sort(F.collect_list(F.struct("issue", "severity"))).alias("issues"))
    return by.select("topic_id", F.to_json(F.struct("topic_id", "issues")).alias("json"))


def markdown(topics: DataFrame, issues: DataFrame, side: DataFrame, most: int = 10) -> DataFrame:
    """(section, place, line): the lines of a Markdown report; sections are aggregates, top lists, and the alphabetical appendix."""
    total = topics.agg(F.count("*").alias("n"), F.sum("total_articles").alias("a")).select(
        F.lit(1).alias("section"), F.lit(0).cast("bigint").alias("place"), F.format_string("# Report\n\n%d topics, %d articles", "n", F.coalesce("a", F.lit(0))).alias("line")
    )
    sections = side.groupBy("category").agg(F.max("category_count").alias("n")).select(F.lit(2), -F.col("n"), F.format_string("* %s: %d articles", "category", "n"))
    found = issues.groupBy("severity", "issue").agg(F.count("*").alias("n")).select(F.lit(3), -F.col("n"), F.format_string("* %s (%s): %d", "issue", "severity", "n"))
    top = topics.orderBy(F.desc("total_articles"), "id").limit(most).select(F.lit(4), -F.col("total_articles").cast("bigint"), F.format_string("* %s: %d", "normalized_name", "total_articles"))
    appendix = topics.select(F.lit(5), F.col("id").cast("bigint"), F.concat(F.lit("* "), "normalized_name", F.lit(": "), F.coalesce(F.concat_ws(", ", F.transform(F.array_sort(F.map_entries("intent_distribution")), lambda e: F.concat(e["key"], F.lit(" "), e["value"].cast("string")))), F.lit("N/A"))))
    return total.union(sections).union(found).union(top).union(appendix)
