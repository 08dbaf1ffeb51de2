"""Filters, joins, counts, deduplication and upserts of articles and their links.

Windows over a title or key keep narrow rows only, and Spark cuts each task's rows to the first of each group before
the shuffle where only the first is wanted, so hot groups stay small. Ties are always broken by id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions import rules
from corpusloom.functions.urls import kb_id, normalized_url
from corpusloom.operators.numbering import numbered
from corpusloom.session import broadcast_if_small

MARKS = ("[BROKEN ARTICLE:", "[MINIMAL CONTENT:")


def has_content(content: str = "content") -> Column:
    """Crawled at all: neither null nor empty; markers count."""
    return F.coalesce(F.col(content) != "", F.lit(False))


def has_valid_content(content: str = "content") -> Column:
    """Crawled, and no marker of a failed crawl."""
    return has_content(content) & ~F.col(content).startswith(MARKS[0]) & ~F.col(content).startswith(MARKS[1])


def quality(title: str = "title", content: str = "content", listed: Column | None = None, least: int = 100) -> Column:
    """What a crawl stores: `skip`, a marker of a broken or minimal article, or `ok`. `listed`: search results know the title."""
    generic = F.col(title).isin([t for t in rules.GENERIC_TITLES if t != "Pending"])
    length = F.coalesce(F.length(content), F.lit(0))
    return (
        F.when(generic & (listed if listed is not None else F.lit(False)), "skip")
        .when(generic, F.concat(F.lit("[BROKEN ARTICLE: "), F.col(title), F.lit("]")))
        .when(length < least, F.concat(F.lit("[MINIMAL CONTENT: "), length.cast("string"), F.lit(" chars]")))
        .otherwise("ok")
    )


def outlinks(links: DataFrame, articles: DataFrame) -> DataFrame:
    """(source_id, target_id, url): links with the URL of their target; links to unknown articles are left out."""
    target = articles.select(F.col("id").alias("target_id"), "url")
    return links.select("source_id", "target_id").join(target, "target_id").select("source_id", "target_id", "url")


def unenriched(articles: DataFrame, enrichment: DataFrame) -> DataFrame:
    """(id, title, url) of articles with valid content that no enrichment names."""
    todo = articles.where(has_valid_content()).select("id", "title", "url")
    return todo.join(enrichment.select(F.col("article_id").alias("id")), "id", "left_anti")


def unenriched_batch(articles: DataFrame, enrichment: DataFrame, n: int) -> DataFrame:
    """The first `n` of unenriched() by id: the next batch for an extractor."""
    return unenriched(articles, enrichment).orderBy("id").limit(n)


def enriched(enrichment: DataFrame, articles: DataFrame) -> DataFrame:
    """Enrichments with the title and URL of their article."""
    a = articles.select(F.col("id").alias("article_id"), "title", "url")
    return enrichment.join(a, "article_id").select("id", "article_id", "canonical_topic", "intent", "audience", "complexity", "title", "url")


def link_network(links: DataFrame, articles: DataFrame) -> DataFrame:
    """(source_id, target_id, source_title, target_title) of distinct links between known articles."""
    s = articles.select(F.col("id").alias("source_id"), F.col("title").alias("source_title"))
    t = articles.select(F.col("id").alias("target_id"), F.col("title").alias("target_title"))
    return links.select("source_id", "target_id").distinct().join(s, "source_id").join(t, "target_id").select("source_id", "target_id", "source_title", "target_title")


def most_linked(links: DataFrame, articles: DataFrame, n: int = 10) -> DataFrame:
    """The n articles with most distinct sources. Counted before the join, so the hottest target costs one row."""
    counts = links.select("source_id", "target_id").distinct().groupBy("target_id").agg(F.count("*").alias("link_count"))
    a = articles.select(F.col("id").alias("target_id"), "title")
    return counts.join(a, "target_id").orderBy(F.desc("link_count"), "target_id").limit(n)


def stats(articles: DataFrame, links: DataFrame, enrichment: DataFrame, topics: DataFrame, relationships: DataFrame) -> DataFrame:
    """(metric, value): the counters of a knowledge base, each a partial aggregate of its own table."""
    a = articles.agg(F.count("*").alias("total_articles"), F.count_if(has_valid_content()).alias("crawled_articles"))
    e = enrichment.agg(F.count("*").alias("enriched_articles"))
    counts = [
        a.selectExpr("stack(2, 'total_articles', total_articles, 'crawled_articles', crawled_articles) as (metric, value)"),
        e.selectExpr("'enriched_articles' as metric", "enriched_articles as value"),
        *(df.agg(F.count("*").alias("value")).select(F.lit(n).alias("metric"), "value") for n, df in (("total_links", links), ("total_topics", topics), ("total_relationships", relationships))),
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    # the derived counters come from the six rows above
    at = {m: F.max(F.when(F.col("metric") == m, F.col("value"))) for m in ("total_articles", "crawled_articles", "enriched_articles")}
    more = out.agg((at["total_articles"] - at["crawled_articles"]).alias("p"), (at["crawled_articles"] - at["enriched_articles"]).alias("u"))
    return out.unionByName(more.selectExpr("stack(2, 'pending_articles', p, 'unenriched_articles', u) as (metric, value)"))


def duplicate_groups(rows: DataFrame, by: str, title: str | None = None) -> DataFrame:
    """(by, copies, first_title): values of `by` that two or more rows have."""
    extra = [F.min(title).alias("first_title")] if title else []
    return rows.groupBy(by).agg(F.count("*").alias("copies"), *extra).where("copies > 1")


def canonical(rows: DataFrame, by: str, order: list[Column]) -> DataFrame:
    """(by, canonical_id): the first row of each value of `by` in the order given."""
    first = Window.partitionBy(by).orderBy(*order)
    return rows.withColumn("_r", F.row_number().over(first)).where("_r = 1").select(by, F.col("id").alias("canonical_id"))


def titled(articles: DataFrame) -> DataFrame:
    """Rows that take part in deduplication by title, with the columns it orders by."""
    rows = articles.where("title is not null and title <> '' and title <> 'Pending'")
    return rows.select("id", "title", has_content().alias("filled"), "updated_at", "crawled_at")


def title_canonical(articles: DataFrame) -> DataFrame:
    """(title, canonical_id): with content first, then latest update, latest crawl, highest id."""
    return canonical(titled(articles), "title", [F.desc("filled"), F.desc_nulls_last("updated_at"), F.desc_nulls_last("crawled_at"), F.desc("id")])


def keyed(articles: DataFrame) -> DataFrame:
    """Rows with an article key, their own or the one in their URL."""
    key = F.coalesce(F.nullif("sys_kb_id", F.lit("")), kb_id(F.col("url")))
    return articles.select("id", key.alias("key"), has_content().alias("filled"), F.coalesce(F.col("title") != "Pending", F.lit(False)).alias("named")).where("key is not null")


def key_canonical(articles: DataFrame) -> DataFrame:
    """(key, canonical_id): with content first, then with a title other than `Pending`, then lowest id."""
    return canonical(keyed(articles), "key", [F.desc("filled"), F.desc("named"), F.asc("id")])


def mapping(rows: DataFrame, by: str, first: DataFrame) -> DataFrame:
    """(duplicate_id, canonical_id) of every row that isn't the canonical one of its value of `by`."""
    return rows.join(first, by).where("id <> canonical_id").select(F.col("id").alias("duplicate_id"), "canonical_id")


def title_mapping(articles: DataFrame) -> DataFrame:
    return mapping(titled(articles), "title", title_canonical(articles))


def key_mapping(articles: DataFrame) -> DataFrame:
    return mapping(keyed(articles), "key", key_canonical(articles))


def rewrite_links(links: DataFrame, replaced: DataFrame) -> DataFrame:
    """(source_id, target_id, created_at): ends replaced by their canonical article, one row a pair with its earliest date.

    Links are reduced to distinct pairs before and after; loops that arise are kept. The mapping is narrow, and where it is
    small enough to be broadcast, the rows of a hot target stay where they are.
    """
    replaced = broadcast_if_small(replaced.select("duplicate_id", "canonical_id"), name="replaced")
    pairs = links.groupBy("source_id", "target_id").agg(F.min("created_at").alias("created_at"))
    s = replaced.select(F.col("duplicate_id").alias("source_id"), F.col("canonical_id").alias("s"))
    t = replaced.select(F.col("duplicate_id").alias("target_id"), F.col("canonical_id").alias("t"))
    moved = pairs.join(s, "source_id", "left").join(t, "target_id", "left")
    return moved.groupBy(F.coalesce("s", "source_id").alias("source_id"), F.coalesce("t", "target_id").alias("target_id")).agg(F.min("created_at").alias("created_at"))


def survivors(articles: DataFrame, replaced: DataFrame) -> DataFrame:
    """Articles that no other one replaces."""
    return articles.join(replaced.select(F.col("duplicate_id").alias("id")), "id", "left_anti")


def best_attributes_by_key(articles: DataFrame) -> DataFrame:
    """Canonical articles of each key, empty fields filled from the lowest id of the key that has them.

    Each field is a partial aggregate (`min_by`), so no group is sorted or held; content is compared by its id only.
    """
    rows = articles.select(F.coalesce(F.nullif("sys_kb_id", F.lit("")), kb_id(F.col("url"))).alias("key"), "id", "title", "number", "display_number", "snippet").where("key is not null")
    fields = ["title", "number", "display_number", "snippet"]
    full = {f: (F.col(f) != "") & (F.col(f) != "Pending") for f in fields}
    best = rows.groupBy("key").agg(*[F.min_by(F.when(full[f], F.col(f)), F.when(full[f], F.col("id"))).alias(f"best_{f}") for f in fields])
    first = key_canonical(articles).join(rows.withColumnRenamed("id", "canonical_id").drop("key"), "canonical_id").join(best, "key")
    return first.select("key", "canonical_id", *[F.when(full[f], F.col(f)).otherwise(F.coalesce(f"best_{f}", f)).alias(f) for f in fields])


def best_attributes_by_title(articles: DataFrame) -> DataFrame:
    """Canonical articles of each title; numbers that are null or empty come from the latest update of the title (null dates first) that has them, null content from the longest."""
    rows = articles.where("title is not null and title <> '' and title <> 'Pending'").select("id", "title", "number", "display_number", "updated_at", F.length("content").alias("size"))
    fields = ["number", "display_number"]
    # null dates first, then latest, then lowest id
    late = F.struct(F.col("updated_at").isNull(), "updated_at", -F.col("id"))
    long = F.struct("size", F.col("updated_at").isNull(), "updated_at", -F.col("id"))
    full = {f: F.coalesce(F.col(f) != "", F.lit(False)) for f in fields}
    best = rows.groupBy("title").agg(*[F.max_by(F.when(full[f], F.col(f)), F.when(full[f], late)).alias(f"best_{f}") for f in fields], F.max_by(F.when(F.col("size") > 0, F.col("id")), F.when(F.col("size") > 0, long)).alias("longest_id"))
    first = title_canonical(articles).join(rows.select(F.col("id").alias("canonical_id"), *fields, "size"), "canonical_id").join(best, "title")
    return first.select("title", "canonical_id", *[F.when(full[f], F.col(f)).otherwise(F.coalesce(f"best_{f}", f)).alias(f) for f in fields], F.when(F.col("size").isNull(), F.col("longest_id")).otherwise(F.col("canonical_id")).alias("content_id"))


def latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The last row of each value of `keys` by `order`."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).where("_r = 1").drop("_r")


def upsert_latest(old: DataFrame, new: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of `old` replaced by the last of `new` (by `order`) with the same keys; rows of new keys are added. Idempotent."""
    last = latest(new, keys, order)
    return old.join(last.select(*keys), keys, "left_anti").unionByName(last, allowMissingColumns=True)


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """`old` with the rows of `new` whose keys it lacks, one for each; rows with a null key are left out. Idempotent."""
    add = new.dropna(subset=keys).dropDuplicates(keys).join(old.select(*keys), keys, "left_anti")
    return old.unionByName(add, allowMissingColumns=True)


def deduplicated(articles: DataFrame, links: DataFrame, enrichment: DataFrame, topic_articles: DataFrame, replaced: DataFrame, best: DataFrame) -> dict[str, DataFrame]:
    """The four tables without the articles that `replaced` (duplicate_id, canonical_id) names.

    Links move to the canonical articles, enrichments and topic rows of the duplicates go with them. `best` (canonical_id and
    columns of articles) has the merged values of the canonical articles, `content_id` the row that the content comes from.
    """
    kept = survivors(articles, replaced)
    filled = [c for c in best.columns if c in articles.columns and c not in ("id", "content")]
    new = best.select(F.col("canonical_id").alias("id"), *[F.col(c).alias("_" + c) for c in filled], *(["content_id"] if "content_id" in best.columns else []), F.lit(True).alias("_merged"))
    rows = kept.join(new, "id", "left")
    content = F.col("content")
    if "content_id" in best.columns:
        # only texts that move are fetched
        moved = best.where("content_id <> canonical_id").select(F.col("content_id").alias("from_id"), F.col("canonical_id").alias("id"))
        texts = articles.select(F.col("id").alias("from_id"), F.col("content").alias("_content")).join(moved, "from_id").select("id", "_content")
        rows, content = rows.join(texts, "id", "left"), F.coalesce("content", "_content")
    merged = {c: F.when(F.col("_merged"), F.col("_" + c)).otherwise(F.col(c)) for c in filled} | {"content": content}
    gone = replaced.select(F.col("duplicate_id").alias("article_id"))
    return {
        "articles": rows.select(*[merged.get(c, F.col(c)).alias(c) for c in articles.columns]),
        "links": rewrite_links(links, replaced),
        "article_enrichment": enrichment.join(gone, "article_id", "left_anti"),
        "topic_articles": topic_articles.join(gone, "article_id", "left_anti"),
    }


def deduplicated_by_key(articles: DataFrame, links: DataFrame, enrichment: DataFrame, topic_articles: DataFrame) -> dict[str, DataFrame]:
    """deduplicated() by article key: empty fields and contents come from the lowest id of the key that has them."""
    rows = articles.select("id", F.coalesce(F.nullif("sys_kb_id", F.lit("")), kb_id(F.col("url"))).alias("key"), (has_content() & (F.col("content") != "Pending")).alias("filled")).where("key is not null")
    source = rows.groupBy("key").agg(F.min(F.when(F.col("filled"), F.col("id"))).alias("first"))
    best = best_attributes_by_key(articles).join(source, "key").join(rows.select(F.col("id").alias("canonical_id"), "filled"), "canonical_id")
    best = best.withColumn("content_id", F.when(F.col("filled"), F.col("canonical_id")).otherwise(F.coalesce("first", "canonical_id"))).drop("first", "filled", "key")
    return deduplicated(articles, links, enrichment, topic_articles, key_mapping(articles), best)


def deduplicated_by_title(articles: DataFrame, links: DataFrame, enrichment: DataFrame, topic_articles: DataFrame) -> dict[str, DataFrame]:
    """deduplicated() by title."""
    best = best_attributes_by_title(articles).drop("title").withColumn("content_id", F.coalesce("content_id", "canonical_id"))
    return deduplicated(articles, links, enrichment, topic_articles, title_mapping(articles), best)


def upsert_articles(old: DataFrame, incoming: DataFrame, ingest: str = "ingest_order") -> DataFrame:
    """Incoming articles merged into `old` in three tiers; the last one by ingest order wins each target.

    An incoming row updates the article of its key; else the article of its title (if that isn't generic, and the row
    brings a key the article lacks or content above 100 signs, otherwise the row is dropped); else the title, content and key
    of the article of its URL; else it is added. Rows of one batch that meet only through each other are reduced in order by their own key or URL.
    """
    new = incoming.withColumn("key", F.coalesce(F.nullif("sys_kb_id", F.lit("")), kb_id(F.col("url"))))
    by_key = old.where("sys_kb_id is not null").groupBy("sys_kb_id").agg(F.min("id").alias("key_id")).withColumnRenamed("sys_kb_id", "key")
    by_title = old.where(F.col("title").isNotNull() & ~F.col("title").isin(rules.GENERIC_TITLES) & (F.col("title") != "")).groupBy("title").agg(
        F.min_by(F.struct("id", "sys_kb_id"), "id").alias("same")
    )
    by_url = old.where("url is not null").groupBy("url").agg(F.min("id").alias("url_id"))
    found = new.join(by_key, "key", "left").join(by_title, "title", "left").join(by_url, "url", "left")
    tier = (
        F.when(F.col("key_id").isNotNull(), 1)
        .when(F.col("same.id").isNotNull() & ((F.col("key").isNotNull() & F.col("same.sys_kb_id").isNull()) | (F.length("content") > 100)), 2)
        .when(F.col("same.id").isNotNull(), 0)
        .when(F.col("url_id").isNotNull(), 4)
        .otherwise(3)
    )
    found = found.withColumn("tier", tier).where("tier > 0").withColumn("target", F.when(F.col("tier") == 1, F.col("key_id")).when(F.col("tier") == 2, F.col("same.id")).when(F.col("tier") == 4, F.col("url_id")))
    ident = F.coalesce(F.col("target").cast("string"), F.concat(F.lit("k:"), "key"), F.concat(F.lit("u:"), "url"), F.concat(F.lit("r:"), F.col(ingest).cast("string")))
    last = found.withColumn("_r", F.row_number().over(Window.partitionBy(ident).orderBy(F.desc(ingest)))).where("_r = 1")
    top = old.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]
    added = numbered(last.where("tier = 3").drop("id"), [ingest, "url"], "id", top + 1)
    payload = [c for c in old.columns if c not in ("id", "url", "sys_kb_id", "title")]
    updated = old.alias("o").join(last.where("tier <> 3").alias("n"), F.col("o.id") == F.col("n.target"))
    updated = updated.select(
        "o.id",
        F.when(F.col("n.tier") == 2, F.col("n.url")).otherwise(F.col("o.url")).alias("url"),
        F.when(F.col("n.tier") == 2, F.coalesce("n.key", "o.sys_kb_id")).when(F.col("n.tier") == 4, F.col("n.key")).otherwise(F.col("o.sys_kb_id")).alias("sys_kb_id"),
        F.when(F.col("n.tier") == 2, F.col("o.title")).otherwise(F.coalesce("n.title", F.lit(""))).alias("title"),
        *[(F.when(F.col("n.tier") == 4, F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")) if c != "content" else F.col("n.content")).alias(c) for c in payload],
    )
    kept = old.join(last.where("tier <> 3").select(F.col("target").alias("id")), "id", "left_anti")
    return kept.unionByName(updated).unionByName(added.select("id", "url", F.col("key").alias("sys_kb_id"), "title", *payload))


def upsert_links(articles: DataFrame, links: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Articles and links after adding `found` (source_id, target_url): targets are met by key, else URL; unknown ones become `Pending` stubs."""
    want = found.where("source_id is not null and target_url is not null").select("source_id", "target_url", normalized_url(F.col("target_url")).alias("name")).distinct()
    # an article is known by its key and by its URL
    names = F.array_compact(F.array(F.concat(F.lit("sys_kb_id:"), F.col("sys_kb_id")), normalized_url(F.col("url"))))
    known = articles.select("id", F.explode(names).alias("name")).groupBy("name").agg(F.min("id").alias("target_id"))
    met = want.join(known, "name", "left")
    top = articles.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]
    new = met.where("target_id is null").groupBy("name").agg(F.min("target_url").alias("url"))
    stubs = numbered(new, ["name"], "id", top + 1).select("id", "name", "url", kb_id(F.col("url")).alias("sys_kb_id"), F.lit("Pending").alias("title"), F.lit(0).alias("depth"))
    every = met.join(stubs.select("name", F.col("id").alias("stub_id")), "name", "left").select("source_id", F.coalesce("target_id", "stub_id").alias("target_id"))
    merged = links.select("source_id", "target_id").union(every).distinct()
    return articles.unionByName(stubs.drop("name"), allowMissingColumns=True), merged
