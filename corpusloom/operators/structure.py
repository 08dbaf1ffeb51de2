"""Navigation trees and structural issues of a topic graph."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.operators.names import holding
from corpusloom.operators.topics import adjacency
from corpusloom.session import written


def issues_orphan(edges: DataFrame, topics: DataFrame) -> DataFrame:
    """(topic_id, issue, severity): topics without parents, children and outgoing related edges."""
    a = adjacency(edges, topics).where("parents = 0 and children = 0 and related = 0")
    return a.select("topic_id", F.lit("orphan").alias("issue"), F.lit("medium").alias("severity"))


def issues_overloaded(topics: DataFrame, most: int = 50, far: int = 100) -> DataFrame:
    """Topics of more than `most` articles; high above `far`."""
    t = topics.where(F.col("total_articles") > most)
    return t.select(F.col("id").alias("topic_id"), F.lit("overloaded").alias("issue"), F.when(F.col("total_articles") > far, "high").otherwise("medium").alias("severity"))


def issues_mixed(topics: DataFrame, share: float = 0.7, least: int = 5) -> DataFrame:
    """Topics of two intents or more, `least` counts or more, none of which has `share` of them."""
    counts = F.map_values("intent_distribution")
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda s, v: s + v)
    t = topics.where(F.size(counts) >= 2).select("id", total.alias("total"), F.array_max(counts).alias("top"))
    t = t.where((F.col("total") >= least) & (F.col("top") < share * F.col("total")))
    return t.select(F.col("id").alias("topic_id"), F.lit("mixed_intent").alias("issue"), F.lit("low").alias("severity"))


def issues(edges: DataFrame, topics: DataFrame) -> DataFrame:
    return issues_orphan(edges, topics).unionByName(issues_overloaded(topics)).unionByName(issues_mixed(topics))


def top_level(edges: DataFrame, topics: DataFrame, least: int = 3, parent_first: bool = True) -> DataFrame:
    """(topic_id, score, total_articles): how well each topic of `least` articles or more suits as an entry point.

    3 a article, 2 an incoming edge, 1.5 a child; less 10 a parent and 5 a prerequisite. `parent_first`: the source of a
    subtopic edge is the parent, as in the test tables; else it is the child.
    """
    a = adjacency(edges, topics, parent_first)
    t = topics.where(F.col("total_articles") >= least).select(F.col("id").alias("topic_id"), "total_articles", "indegree", "prerequisite_count")
    score = 3.0 * F.col("total_articles") + 2.0 * F.col("indegree") - 10.0 * F.col("parents") - 5.0 * F.col("prerequisite_count") + 1.5 * F.col("children")
    return t.join(a.select("topic_id", "parents", "children"), "topic_id").select("topic_id", score.alias("score"), "total_articles")


def _first_visits(candidates: pd.DataFrame) -> pd.DataFrame:
    """The rows of one tree that a depth-first walk meets first: `path` and `order` have the topics and their ranks from the root on."""
    seen: set[int] = set()
    placed: set[tuple] = set()
    keep = []
    rows = sorted(zip(candidates["order"].map(tuple), candidates["path"].map(tuple), range(len(candidates))))
    for _, path, at in rows:
        if path[-1] not in seen and (len(path) == 1 or path[:-1] in placed):
            seen.add(path[-1])
            placed.add(path)
            keep.append(at)
    return candidates.iloc[keep]


def auto_sidebar(edges: DataFrame, topics: DataFrame, roots: int = 10, fan_out: int = 10, depth: int = 3, parent_first: bool = True) -> DataFrame:
    """(topic_id, parent_id, root_id, depth, article_count): a tree below the best entry points, as a depth-first walk meets them.

    Of each topic the `fan_out` largest children are looked at, the lowest ids first among equals; a topic stands where the
    walk meets it first. article_count adds up the subtree. Each level is a join of the frontier with the edges; the
    candidates of all levels are at most roots * fan_out ** (depth - 1) paths, from which a small helper takes first visits.
    """
    size = topics.select(F.col("id").alias("child_id"), "total_articles")
    best = top_level(edges, topics, parent_first=parent_first).orderBy(F.desc("score"), F.desc("total_articles"), "topic_id").limit(roots)
    rank = F.row_number().over(Window.orderBy(F.desc("score"), F.desc("total_articles"), "topic_id"))  # of at most `roots` rows
    frontier = written(best.select(F.array("topic_id").alias("path"), F.array(rank).alias("order"), "total_articles"), "sidebar")
    levels = frontier
    up, down = ("source_id", "target_id") if parent_first else ("target_id", "source_id")
    child = edges.where("relation = 'subtopic_of'").select(F.col(up).alias("parent_id"), F.col(down).alias("child_id")).where("parent_id <> child_id").distinct()
    for _ in range(1, depth):
        ends = frontier.select(F.element_at("path", -1).alias("parent_id")).distinct()
        place = F.row_number().over(Window.partitionBy("parent_id").orderBy(F.desc("total_articles"), "child_id"))
        largest = child.join(ends, "parent_id", "left_semi").join(size, "child_id").withColumn("place", place).where(F.col("place") <= fan_out)
        next_ = frontier.select("path", "order", F.element_at("path", -1).alias("parent_id")).join(largest, "parent_id")
        frontier = written(next_.select(F.concat("path", F.array("child_id")).alias("path"), F.concat("order", F.array("place")).alias("order"), "total_articles"), "sidebar")
        levels = levels.unionByName(frontier)
    kind = topics.schema["id"].dataType.simpleString()
    schema = f"path array<{kind}>, order array<int>, total_articles {topics.schema['total_articles'].dataType.simpleString()}"
    placed = written(levels.groupBy().applyInPandas(_first_visits, schema), "placed")
    total = placed.select(F.explode("path").alias("topic_id"), "total_articles").groupBy("topic_id").agg(F.sum("total_articles").alias("article_count"))
    rows = placed.select(F.element_at("path", -1).alias("topic_id"), F.get("path", F.size("path") - 2).alias("parent_id"), F.get("path", F.lit(0)).alias("root_id"), (F.size("path") - 1).alias("depth"))
    return rows.join(total, "topic_id").select("topic_id", "parent_id", "root_id", "depth", "article_count")


def tree_counts(tree: DataFrame) -> DataFrame:
    """(root_id, nodes, deepest) of each section of auto_sidebar(), and with a null root_id of all of them."""
    return tree.rollup("root_id").agg(F.count("*").alias("nodes"), F.max("depth").alias("deepest"))


def topic_match(entries: DataFrame, topics: DataFrame) -> DataFrame:
    """(category, entry, topic_id, kind): for each entry the topic of its name, else the largest whose name holds it or is held by it.

    Equal names meet by an equi-join; the others by a rare part of the shorter name, at any place in the longer one.
    """
    e = entries.select("category", "entry", F.lower("entry").alias("low")).distinct()
    t = topics.select("topic_id", "total_articles", F.lower("normalized_name").alias("name"))
    exact = e.join(t, e.low == t.name).select("category", "entry", "topic_id", "total_articles", F.lit(1).alias("kind"))
    low, name = e.select(F.col("low").alias("name")).distinct(), t.select("name").distinct()
    a, b = low.select(F.col("name").alias("a"), "name"), name.select(F.col("name").alias("b"), "name")
    swap = lambda df, old, new: df.select(F.col(old).alias(new), "name")
    held = holding(a, b).select(F.col("a").alias("low"), F.col("b").alias("name")).union(holding(swap(b, "b", "a"), swap(a, "a", "b")).select(F.col("b").alias("low"), F.col("a").alias("name")))
    fuzzy = held.where("low <> name").distinct().join(e, "low").join(t, "name").select("category", "entry", "topic_id", "total_articles", F.lit(2).alias("kind"))
    found = exact.unionByName(fuzzy)
    best = found.groupBy("category", "entry").agg(F.min(F.struct("kind", (-F.col("total_articles")).alias("neg"), "topic_id")).alias("b"))
    return best.select("category", "entry", "b.topic_id", F.when(F.col("b.kind") == 1, "exact").otherwise("fuzzy").alias("kind"))


def sidebar(entries: DataFrame, topics: DataFrame, placed: DataFrame | None = None) -> DataFrame:
    """(category, entry, topic_id, article_count, category_count, place): the entries that found a topic with articles, under their categories.

    With `placed` (category, articles), the articles that hold a keyword of each category, an entry without a topic stands for
    these articles, with a null topic_id.
    """
    match = topic_match(entries, topics)
    rows = match.join(topics.select("topic_id", "total_articles"), "topic_id").select("category", "entry", "topic_id", "total_articles")
    if placed is not None:
        rest = entries.select("category", "entry").distinct().join(match.select("category", "entry"), ["category", "entry"], "left_anti").join(placed, "category")
        rows = rows.unionByName(rest.select("category", "entry", F.lit(None).cast(topics.schema["topic_id"].dataType).alias("topic_id"), F.col("articles").alias("total_articles")))
    by = Window.partitionBy("category")
    return rows.where("total_articles > 0").select(
        "category", "entry", "topic_id", F.col("total_articles").alias("article_count"), F.sum("total_articles").over(by).alias("category_count"),
        F.row_number().over(by.orderBy(F.desc("total_articles"), "topic_id", "entry")).alias("place"),
    )


def keyword_counts(keywords: DataFrame, articles: DataFrame, topic_articles: DataFrame) -> DataFrame:
    """(category, articles): distinct articles of any topic whose title holds a keyword of the category."""
    known = articles.join(topic_articles.select(F.col("article_id").alias("id")), "id", "left_semi")
    return keyword_articles(keywords, known).groupBy("category").agg(F.countDistinct("article_id").alias("articles"))


def keyword_articles(keywords: DataFrame, articles: DataFrame, most: int = 5000) -> DataFrame:
    """(category, article_id): articles whose title holds a keyword of the category.

    Up to `most` keywords are part of the plan, and titles are only scanned; more of them meet titles by their rare parts.
    """
    words = keywords.select("category", F.lower("keyword").alias("keyword")).where("keyword <> '' and category is not null").distinct()
    rows = words.limit(most + 1).collect()
    title = F.lower("title")
    if len(rows) > most:
        words = written(words, "keywords")
        titles = articles.where("title is not null").select(title.alias("name")).distinct()
        held = holding(words.select(F.col("keyword").alias("a"), F.col("keyword").alias("name")).distinct(), titles.select(F.col("name").alias("b"), "name"))
        found = held.join(words, held.a == words.keyword).select("category", F.col("b").alias("low")).distinct()
        return found.join(articles.select(title.alias("low"), F.col("id").alias("article_id")), "low").select("category", "article_id")
    by: dict[str, list[str]] = {}
    for r in rows:
        by.setdefault(r.category, []).append(r.keyword)
    holds: list[Column] = [F.when(F.exists(F.array(*map(F.lit, sorted(k))), lambda x: F.contains(title, x)), F.lit(c)) for c, k in sorted(by.items())]
    if not holds:
        return articles.select(F.lit("").alias("category"), F.col("id").alias("article_id")).limit(0)
    return articles.where("title is not null").select(F.explode(F.array_compact(F.array(*holds))).alias("category"), F.col("id").alias("article_id"))
