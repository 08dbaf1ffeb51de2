"""Registered queries of the core, each with the SQL that checks it where SQL can express it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import pages as P
from corpusloom.functions import replies as R
from corpusloom.functions import rules
from corpusloom.functions.topics import fallback_category, normalized_topic
from corpusloom.functions.urls import denormalized_url, is_article_link, kb_id, normalized_url
from corpusloom.operators import articles as A
from corpusloom.operators import crawl as C
from corpusloom.operators import hierarchy as H
from corpusloom.operators import reports as RP
from corpusloom.operators import structure as S
from corpusloom.operators import topics as T
from corpusloom.plans import sql as Q
from corpusloom.session import shared_folder, written
from corpusloom.sources.exports import read_csv, write_csv
from corpusloom.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of a folder as attributes."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self._spark, self._folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self._spark, self._folder, name)


def query(sql: str | None = None):
    """Registers a function of Tables as a query of its name."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = lambda spark, d: f(Tables(spark, d))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# scans, filters, projections


@query("select id, url, title, depth, length(content) as size from articles")
def scan_articles(t):
    return t.articles.select("id", "url", "title", "depth", F.length("content").alias("size"))


@query(f"select id, title from articles where {Q.VALID}")
def crawled_articles(t):
    return t.articles.where(A.has_valid_content()).select("id", "title")


@query(f"select id, url from articles where not {Q.FILLED}")
def uncrawled_articles(t):
    return t.articles.where(~A.has_content()).select("id", "url")


@query(f"select id, url from articles where {Q.FILLED}")
def crawled_urls(t):
    return t.articles.where(A.has_content()).select("id", "url")


@query("select id, url, title from articles where sys_kb_id = (select max(sys_kb_id) from articles)")
def lookup_by_key(t):
    last = t.articles.agg(F.max("sys_kb_id").alias("sys_kb_id"))
    return t.articles.join(F.broadcast(last), "sys_kb_id").select("id", "url", "title")  # one row is broadcast


@query("select id, title from articles where url = (select max(url) from articles)")
def lookup_by_url(t):
    last = t.articles.agg(F.max("url").alias("url"))
    return t.articles.join(F.broadcast(last), "url").select("id", "title")  # one row is broadcast


@query("select id, canonical_topic, intent from article_enrichment where article_id = (select max(article_id) from article_enrichment)")
def lookup_enrichment(t):
    last = t.article_enrichment.agg(F.max("article_id").alias("article_id"))
    return t.article_enrichment.join(F.broadcast(last), "article_id").select("id", "canonical_topic", "intent")  # one row is broadcast


@query("select id, name, total_articles from topics where normalized_name = (select min(normalized_name) from topics)")
def lookup_topic(t):
    first = t.topics.agg(F.min("normalized_name").alias("normalized_name"))
    return t.topics.join(F.broadcast(first), "normalized_name").select("id", "name", "total_articles")  # one row is broadcast


@query("select id, relationship_type, weight from topic_relationships where source_topic_id = 3 or target_topic_id = 3")
def topic_relationships_for(t):
    return t.topic_relationships.where((F.col("source_topic_id") == 3) | (F.col("target_topic_id") == 3)).select("id", "relationship_type", "weight")


@query(f"select id, title from articles where title in ({', '.join(map(Q._q, rules.GENERIC_TITLES))})")
def generic_title_filter(t):
    return t.articles.where(F.col("title").isin(rules.GENERIC_TITLES)).select("id", "title")


@query(
    "select id, case when title in ('Login', 'Page Not Found', 'Access Denied') then '[BROKEN ARTICLE: ' || title || ']' when coalesce(length(content), 0) < 100 "
    "then '[MINIMAL CONTENT: ' || coalesce(length(content), 0) || ' chars]' else 'ok' end as outcome from articles"
)
def crawl_quality_gate(t):
    return t.articles.select("id", A.quality().alias("outcome"))


@query(
    "select id, url from (select id, url, lower(coalesce(nullif(regexp_extract(trim(url), '\\?([^#]*)', 1), ''), '')) || ' ' || lower(regexp_extract(trim(url), '^[a-zA-Z]+://[^/?#]*([^?#]*)', 1)) as p from articles) "
    "where (contains(p, 'id=kb_article') or contains(p, 'sys_kb_id=')) and contains(url, '.example')"
)
def kb_link_filter(t):
    return t.articles.where(is_article_link(F.trim("url"))).select("id", "url")


@query(f"select id, {Q.kb_id('url')} as kb_id from articles")
def extract_kb_id(t):
    return t.articles.select("id", kb_id(F.col("url")).alias("kb_id"))


@query(f"select id, {Q.normal_url('url')} as normal from articles")
def normalize_url(t):
    return t.articles.select("id", normalized_url(F.col("url")).alias("normal"))


@query(f"select id, case when starts_with(n, 'sys_kb_id:') then 'https://kb.example/kb?id=kb_article_view&sys_kb_id=' || substr(n, 11) else n end as url from (select id, {Q.normal_url('url')} as n from articles)")
def denormalize_url(t):
    return t.articles.select("id", denormalized_url(normalized_url(F.col("url"))).alias("url"))


# joins


@query("select source_id, target_id, url from links join articles on id = target_id")
def article_outlinks(t):
    return A.outlinks(t.links, t.articles)


@query(f"select id, title, url from articles where {Q.VALID} and id not in (select article_id from article_enrichment where article_id is not null)")
def unenriched_articles(t):
    return A.unenriched(t.articles, t.article_enrichment)


@query(f"select id, title, url from articles where {Q.VALID} and id not in (select article_id from article_enrichment where article_id is not null) order by id limit 50")
def next_unenriched(t):
    return A.unenriched_batch(t.articles, t.article_enrichment, 50)


@query("select e.id, article_id, canonical_topic, intent, audience, complexity, title, url from article_enrichment e join articles a on a.id = e.article_id")
def all_enrichments(t):
    return A.enriched(t.article_enrichment, t.articles)


@query("select r.id, s.name as source, x.name as target, relationship_type, weight from topic_relationships r join topics s on s.id = source_topic_id join topics x on x.id = target_topic_id")
def named_relationships(t):
    s = t.topics.select(F.col("id").alias("source_topic_id"), F.col("name").alias("source"))
    x = t.topics.select(F.col("id").alias("target_topic_id"), F.col("name").alias("target"))
    return t.topic_relationships.join(s, "source_topic_id").join(x, "target_topic_id").select("id", "source", "target", "relationship_type", "weight")


@query("select distinct topic_id, article_id, title from topic_articles join articles on id = article_id")
def articles_by_topic(t):
    return t.topic_articles.distinct().join(t.articles.select(F.col("id").alias("article_id"), "title"), "article_id").select("topic_id", "article_id", "title")


@query("select source_id, target_id, a.title as source_title, b.title as target_title from (select distinct source_id, target_id from links) join articles a on a.id = source_id join articles b on b.id = target_id")
def link_network(t):
    return A.link_network(t.links, t.articles)


@query("select target_id, title, count(*) as link_count from (select distinct source_id, target_id from links) join articles on id = target_id group by 1, 2 order by 3 desc, 1 limit 10")
def most_linked(t):
    return A.most_linked(t.links, t.articles).select("target_id", "title", "link_count")


@query(f"with {Q.TITLE_FIRST} select distinct title, canonical_id from tf")
def dedup_title_canonical(t):
    return A.title_canonical(t.articles)


@query(f"with {Q.KEY_FIRST} select distinct key, canonical_id from kf")
def dedup_key_canonical(t):
    return A.key_canonical(t.articles)


@query(f"with {Q.TITLE_FIRST} select id as duplicate_id, canonical_id from tf where id <> canonical_id")
def dedup_title_mapping(t):
    return A.title_mapping(t.articles)


@query(f"with {Q.KEY_FIRST} select id as duplicate_id, canonical_id from kf where id <> canonical_id")
def dedup_key_mapping(t):
    return A.key_mapping(t.articles)


@query(
    f"with {Q.KEY_FIRST}, m as (select id as d, canonical_id as c from kf where id <> canonical_id) select coalesce(a.c, source_id) as source_id, coalesce(b.c, target_id) as target_id, min(created_at) as created_at "
    "from links left join m a on a.d = source_id left join m b on b.d = target_id group by 1, 2"
)
def rewrite_links(t):
    return A.rewrite_links(t.links, A.key_mapping(t.articles))


@query(f"with {Q.KEY_FIRST} select id, title from articles where id not in (select id from kf where id <> canonical_id)")
def dedup_survivors(t):
    return A.survivors(t.articles, A.key_mapping(t.articles)).select("id", "title")


@query(
    f"with {Q.KEY_FIRST}, "
    + "v as (select key, "
    + ", ".join(f"arg_min({f}, id) filter (where {f} <> '' and {f} <> 'Pending') as best_{f}" for f in ("title", "number", "display_number", "snippet"))
    + " from kf group by 1) select kf.key, id as canonical_id, "
    + ", ".join(f"case when {f} <> '' and {f} <> 'Pending' then {f} else coalesce(best_{f}, {f}) end as {f}" for f in ("title", "number", "display_number", "snippet"))
    + " from kf join v on v.key = kf.key where id = canonical_id"
)
def merge_best_attributes_key(t):
    return A.best_attributes_by_key(t.articles)


@query(
    f"with {Q.TITLE_FIRST}, "
    + "".join(f"o_{f} as (select title, {f} as v from (select *, row_number() over (partition by title order by updated_at desc nulls first, id) as r from tr where {f} <> '') where r = 1), " for f in ("number", "display_number"))
    + "l as (select title, id as longest from (select *, row_number() over (partition by title order by length(content) desc, updated_at desc nulls first, id) as r from tr where length(content) > 0) where r = 1) "
    "select tf.title, tf.id as canonical_id, case when number <> '' then number else coalesce(a.v, number) end as number, case when display_number <> '' then display_number else coalesce(b.v, display_number) end as display_number, "
    "case when content is null then longest else tf.id end as content_id from tf left join o_number a on a.title = tf.title left join o_display_number b on b.title = tf.title left join l on l.title = tf.title where tf.id = canonical_id"
)
def merge_best_attributes_title(t):
    return A.best_attributes_by_title(t.articles)


_RUN = (
    "ll as (select coalesce(a.c, source_id) as source_id, coalesce(b.c, target_id) as target_id from links left join m a on a.d = source_id left join m b on b.d = target_id group by 1, 2), r as (select 'articles' as metric, count(*) as value from kept "
    "union all select 'titles', count(distinct title) from kept union all select 'numbers', count(distinct number) from kept union all select 'characters', cast(sum(length(content)) as bigint) from kept union all select 'links', count(*) from ll "
    "union all select 'enrichments', count(*) from article_enrichment where article_id is null or article_id not in (select d from m) union all select 'topic_rows', count(*) from topic_articles where article_id is null or article_id not in (select d from m)) select * from r"
)


def _run(tables):
    a = tables["articles"]
    counts = a.agg(F.count("*").alias("articles"), F.countDistinct("title").alias("titles"), F.countDistinct("number").alias("numbers"), F.sum(F.length("content")).alias("characters"))
    out = counts.unpivot([], counts.columns, "metric", "value")
    for name, metric in (("links", "links"), ("article_enrichment", "enrichments"), ("topic_articles", "topic_rows")):
        out = out.unionByName(tables[name].agg(F.lit(metric).alias("metric"), F.count("*").alias("value")))
    return out


@query(
    f"with {Q.KEY_FIRST}, m as (select id as d, canonical_id as c from kf where id <> canonical_id), v as (select key, arg_min(content, id) filter (where content <> '' and content <> 'Pending') as best_content, "
    + ", ".join(f"arg_min({f}, id) filter (where {f} <> '' and {f} <> 'Pending') as best_{f}" for f in ("title", "number"))
    + " from kf group by 1), kept as (select a.id, case when v.key is null or a.content <> '' and a.content <> 'Pending' then a.content else coalesce(best_content, a.content) end as content, "
    + ", ".join(f"case when v.key is null or a.{f} <> '' and a.{f} <> 'Pending' then a.{f} else coalesce(best_{f}, a.{f}) end as {f}" for f in ("title", "number"))
    + f" from articles a left join kf on kf.id = a.id left join v on v.key = kf.key where a.id not in (select d from m)), {_RUN}"
)
def dedup_key_run(t):
    return _run(A.deduplicated_by_key(t.articles, t.links, t.article_enrichment, t.topic_articles))


@query(
    f"with {Q.TITLE_FIRST}, m as (select id as d, canonical_id as c from tf where id <> canonical_id), o as (select title, number as v from (select *, row_number() over (partition by title order by updated_at desc nulls first, id) as r from tr where number <> '') where r = 1), "
    "l as (select title, content as longest from (select *, row_number() over (partition by title order by length(content) desc, updated_at desc nulls first, id) as r from tr where length(content) > 0) where r = 1), "
    "kept as (select a.id, a.title, coalesce(a.content, longest) as content, case when tf.id is null or a.number <> '' then a.number else coalesce(o.v, a.number) end as number from articles a left join tf on tf.id = a.id left join o on o.title = tf.title left join l on l.title = tf.title where a.id not in (select d from m)), "
    + _RUN
)
def dedup_title_run(t):
    return _run(A.deduplicated_by_title(t.articles, t.links, t.article_enrichment, t.topic_articles))


@query("select id, normalized_name from topics where id not in (select source_topic_id from topic_relationships where source_topic_id is not null union select target_topic_id from topic_relationships where target_topic_id is not null)")
def isolated_topics(t):
    r = t.topic_relationships
    ends = r.select(F.col("source_topic_id").alias("id")).union(r.select("target_topic_id"))
    return t.topics.select("id", "normalized_name").join(ends, "id", "left_anti")


# aggregates


@query(
    f"with a as (select count(*) as n, count(*) filter (where {Q.VALID}) as c from articles), e as (select count(*) as n from article_enrichment) select 'total_articles' as metric, n as value from a union all select 'crawled_articles', c from a "
    "union all select 'enriched_articles', n from e union all select 'total_links', count(*) from links union all select 'total_topics', count(*) from topics union all select 'total_relationships', count(*) from topic_relationships "
    "union all select 'pending_articles', n - c from a union all select 'unenriched_articles', a.c - e.n from a, e"
)
def kb_stats(t):
    return A.stats(t.articles, t.links, t.article_enrichment, t.topics, t.topic_relationships)


@query(f"select count(*) as articles, count(e.article_id) as enriched, round(count(e.article_id) * 100.0 / count(*), 6) as percent from (select id from articles where {Q.VALID}) a left join (select distinct article_id from article_enrichment) e on e.article_id = a.id")
def pipeline_status(t):
    done = t.article_enrichment.select(F.col("article_id").alias("id")).distinct().withColumn("done", F.lit(1))
    a = t.articles.where(A.has_valid_content()).select("id").join(done, "id", "left").agg(F.count("*").alias("articles"), F.count("done").alias("enriched"))
    return a.select("articles", "enriched", F.round(F.when(F.col("articles") > 0, F.col("enriched") * 100 / F.col("articles")).otherwise(0.0), 6).alias("percent"))


@query("select depth, count(*) as total, count(*) filter (where crawled_at is not null) as crawled, count(*) filter (where crawled_at is null) as pending from articles group by 1")
def crawl_progress(t):
    return t.articles.groupBy("depth").agg(F.count("*").alias("total"), F.count_if(F.col("crawled_at").isNotNull()).alias("crawled"), F.count_if(F.col("crawled_at").isNull()).alias("pending"))


@query("select coalesce(llm_model, '') as model, count(*) as enriched, count(distinct article_id) as articles, min(enriched_at) as first, max(enriched_at) as last from article_enrichment group by 1")
def enrichment_progress(t):
    return t.article_enrichment.groupBy(F.coalesce("llm_model", F.lit("")).alias("model")).agg(
        F.count("*").alias("enriched"), F.countDistinct("article_id").alias("articles"), F.min("enriched_at").alias("first"), F.max("enriched_at").alias("last")
    )


@query("select count(*) as articles, count(distinct nullif(title, 'Pending')) as titles, count(distinct sys_kb_id) as keys from articles")
def dedup_final_stats(t):
    return t.articles.agg(F.count("*").alias("articles"), F.countDistinct(F.nullif("title", F.lit("Pending"))).alias("titles"), F.countDistinct("sys_kb_id").alias("keys"))


@query(f"with {Q.TITLED} select title, count(*) as copies from tr group by 1 having count(*) > 1")
def duplicate_titles(t):
    return A.duplicate_groups(A.titled(t.articles), "title")


@query("select sys_kb_id, count(*) as copies, min(title) as first_title from articles where sys_kb_id is not null group by 1 having count(*) > 1 order by 2 desc, 1 limit 10")
def top_duplicate_keys(t):
    return A.duplicate_groups(t.articles.where("sys_kb_id is not null"), "sys_kb_id", "title").orderBy(F.desc("copies"), "sys_kb_id").limit(10)


@query("select sys_kb_id, count(*) as copies, min(title) as first_title from articles where sys_kb_id is not null group by 1 having count(*) > 1")
def duplicate_keys(t):
    return A.duplicate_groups(t.articles.where("sys_kb_id is not null"), "sys_kb_id", "title")


@query(f"with {Q.TITLED} select count(*) as groups, cast(sum(n - 1) as bigint) as surplus from (select count(*) as n from tr group by title having count(*) > 1)")
def duplicate_title_summary(t):
    return A.duplicate_groups(A.titled(t.articles), "title").agg(F.count("*").alias("groups"), F.sum(F.col("copies") - 1).alias("surplus"))


@query("select count(*) as topics, cast(sum(total_articles) as bigint) as articles, round(avg(total_articles), 6) as mean, min(total_articles) as least, max(total_articles) as most from topics")
def topic_stats(t):
    n = F.col("total_articles")
    return t.topics.agg(F.count("*").alias("topics"), F.sum(n).alias("articles"), F.round(F.avg(n), 6).alias("mean"), F.min(n).alias("least"), F.max(n).alias("most"))


@query("select round(count(distinct article_id) * 1.0 / (select count(*) from article_enrichment), 6) as coverage from topic_articles")
def topic_coverage(t):
    placed = t.topic_articles.agg(F.countDistinct("article_id").alias("value"), F.lit(0).alias("part"))
    every = t.article_enrichment.agg(F.count("*").alias("value"), F.lit(1).alias("part"))
    both = placed.unionByName(every).agg(F.max(F.when(F.col("part") == 0, F.col("value"))).alias("p"), F.max(F.when(F.col("part") == 1, F.col("value"))).alias("e"))
    return both.select(F.round(F.when(F.col("e") > 0, F.col("p") / F.col("e")), 6).alias("coverage"))


@query("select relationship_type, count(*) as n, round(avg(weight), 4) as mean_weight from (select lower(trim(relationship_type, ' ')) as relationship_type, weight from topic_relationships) group by 1")
def relationship_summary(t):
    return t.topic_relationships.groupBy(T.relation(F.col("relationship_type")).alias("relationship_type")).agg(F.count("*").alias("n"), F.round(F.avg("weight"), 4).alias("mean_weight"))


@query("select id, normalized_name, total_articles from topics order by total_articles desc, id")
def all_topics(t):
    return t.topics.select("id", "normalized_name", "total_articles").orderBy(F.desc("total_articles"), "id")


@query("select id, normalized_name, total_articles from topics order by total_articles desc, id limit 10")
def top_topics(t):
    return t.topics.select("id", "normalized_name", "total_articles").orderBy(F.desc("total_articles"), "id").limit(10)


@query("select cast(row_number() over (order by total_articles desc, id) as integer) as rank, id, normalized_name from topics order by total_articles desc, id limit 10")
def top_topics_ranked(t):
    return RP.ranked(t.topics.orderBy(F.desc("total_articles"), "id").limit(10)).select("rank", "id", "normalized_name")


@query("select normalized_name, total_articles from topics order by normalized_name, id")
def topic_appendix(t):
    return t.topics.select("id", "normalized_name", "total_articles").orderBy("normalized_name", "id").select("normalized_name", "total_articles")


# topics


@query("with " + Q.normalized("article_enrichment", "id", "canonical_topic") + " select id, norm as topic from norm")
def normalize_topic(t):
    return t.article_enrichment.select("id", normalized_topic(F.col("canonical_topic"), organisation=Q.ORGANISATION).alias("topic"))


@query("with " + Q.normalized("article_enrichment", "id", "canonical_topic") + ", " + Q.categories("norm", "norm") + " select topic, fallback from cat")
def fallback_topic(t):
    return t.article_enrichment.select(normalized_topic(F.col("canonical_topic"), organisation=Q.ORGANISATION).alias("topic")).distinct().select("topic", fallback_category(F.col("topic")).alias("fallback"))


@query(f"with {Q.TOPICS_BUILT} select topic_id, normalized_name, name, total_articles from built")
def build_topics(t):
    return T.build_topics(_assigned(t))


def _assigned(t):
    return T.assigned(t.article_enrichment, organisation=Q.ORGANISATION)


def _graph(t):
    """The built topics (id, normalized_name, total_articles) and their articles."""
    rows = written(_assigned(t), "rows")
    built = written(T.build_topics(rows), "built")
    return built.withColumnRenamed("topic_id", "id"), T.placed_articles(rows, built)


@query(f"with {Q.ASSIGNED}, u as (select topic, 'intent' as dimension, intent as value from assigned union all select topic, 'complexity', complexity from assigned union all select topic, 'audience', audience from assigned) select topic, dimension, value, count(*) as n from u where value <> '' group by 1, 2, 3")
def topic_distributions(t):
    return T.distributions(_assigned(t))


@query(
    f"with {Q.TOPICS_BUILT} select normalized_name, name, total_articles, 0 as indegree, 0 as outdegree, 0 as prerequisite_count from built union all select normalized_name, name, total_articles, indegree, outdegree, prerequisite_count from topics where normalized_name not in (select normalized_name from built)"
)
def upsert_topics(t):
    zero = [F.lit(0).alias(c) for c in ("indegree", "outdegree", "prerequisite_count")]  # a build knows no edges yet
    built = T.build_topics(_assigned(t)).select("normalized_name", "name", "total_articles", *zero, F.lit(0).alias("_order"))
    stored = t.topics.select("normalized_name", "name", "total_articles", "indegree", "outdegree", "prerequisite_count", F.lit(0).alias("_order"))
    return A.upsert_latest(stored, built, ["normalized_name"], "_order").drop("_order")


_SUBSETS = "from tw p, tw c where p.id < c.id and len(p.words) < len(c.words) and len(p.words) > 0 and list_has_all(c.words, p.words)"


@query(f"with {Q.TOPICS_BUILT}, {Q.BUILT_WORDS} select p.id as source_id, c.id as target_id, len(p.words) * 1.0 / len(c.words) as weight {_SUBSETS}")
def subtopic_edges(t):
    return T.subtopic_edges(_graph(t)[0])


_MAT = ", mat as (select a.topic_id as s, b.topic_id as t, count(*) as n, count(distinct source_id) as sources from fl join sa a on a.article_id = source_id join fa b on b.article_id = target_id where a.topic_id <> b.topic_id group by 1, 2)"
_MATRIX = Q.LINKED + _MAT


@query(
    f"with {_MATRIX}, {Q.EDGES} select s as source_id, t as target_id, least(n / 10.0, 1.0) as weight, cast(n as bigint) as link_count from mat m where n >= 3 and not exists (select 1 from ed where rel in ('subtopic_of', 'prerequisite_of') and ((ed.s = m.s and ed.t = m.t) or (ed.s = m.t and ed.t = m.s))) "
    "and not exists (select 1 from mat o where o.n >= 3 and o.s = m.t and o.t = m.s and o.s < m.s)"
)
def link_pattern_edges(t):
    known = T.known_edges(t.topic_relationships, t.topics).where("relation in ('subtopic_of', 'prerequisite_of')")
    return T.link_pattern_edges(t.links, t.topic_articles, known)


@query(f"with {_MATRIX} select s as source_id, t as target_id, sources from mat where sources >= 3")
def cooccurrence_edges(t):
    return T.cooccurrence_edges(t.links, t.topic_articles)


@query(
    f"with {Q.TOPICS_BUILT}, {Q.PLACED}, c as (select topic_id, count(*) as n from ta group by 1), p as (select a.topic_id as s, b.topic_id as t, count(*) as shared from ta a join ta b on a.article_id = b.article_id and a.topic_id < b.topic_id group by 1, 2) "
    "select s as source_id, t as target_id, shared, shared * 1.0 / (x.n + y.n - shared) as weight from p join c x on x.topic_id = s join c y on y.topic_id = t"
)
def article_overlap_edges(t):
    return T.overlap_edges(_graph(t)[1])


_PREREQ = (
    Q.normalized("article_enrichment", "id, prerequisites", "canonical_topic", "a1")
    + ", pr as (select norm as target_name, unnest(prerequisites) as p from a1), "
    + Q.normalized("pr", "target_name", "p", "a2")
    + ", pe as (select s.topic_id as source_id, x.topic_id as target_id, count(*) as mentions from a2 join built s on s.normalized_name = a2.norm join built x on x.normalized_name = target_name group by 1, 2)"
)


@query(f"with {Q.TOPICS_BUILT}, {_PREREQ} select source_id, target_id, mentions, least(mentions / 5.0, 1.0) as weight from pe")
def prerequisite_edges(t):
    return T.prerequisite_edges(t.article_enrichment, _graph(t)[0], organisation=Q.ORGANISATION)


@query(
    f"with {Q.TOPICS_BUILT}, {_PREREQ}, {Q.BUILT_LINKED}{_MAT}, {Q.BUILT_WORDS}, u as (select p.id as source_id, c.id as target_id, 'subtopic_of' as relation, round(len(p.words) * 1.0 / len(c.words), 6) as weight, 0 as support, 0 as family from tw p, tw c where p.id < c.id and len(p.words) < len(c.words) and len(p.words) > 0 and list_has_all(c.words, p.words) "
    "union all select source_id, target_id, 'prerequisite_of', round(least(mentions / 5.0, 1.0), 6), mentions, 1 from pe union all select s, t, 'related_to', round(least(n / 10.0, 1.0), 6), n, 2 from mat m where n >= 3 and not exists (select 1 from mat o where o.n >= 3 and o.s = m.t and o.t = m.s and o.s < m.s)), "
    "f as (select * from u where family < 2 union all select * from u r where family = 2 and not exists (select 1 from u x where x.family < 2 and ((x.source_id = r.source_id and x.target_id = r.target_id) or (x.source_id = r.target_id and x.target_id = r.source_id)))) "
    "select source_id, target_id, relation, weight, cast(support as bigint) as support from f"
)
def topic_relationships(t):
    topics, placed = _graph(t)
    placed = written(placed, "placed")
    sub = T.subtopic_edges(topics).select("source_id", "target_id", F.lit("subtopic_of").alias("relation"), F.round("weight", 6).alias("weight"), F.lit(0).cast("bigint").alias("support"))
    pre = T.prerequisite_edges(t.article_enrichment, topics, organisation=Q.ORGANISATION).select("source_id", "target_id", F.lit("prerequisite_of").alias("relation"), F.round("weight", 6).alias("weight"), F.col("mentions").alias("support"))
    both = sub.unionByName(pre)
    rel = T.link_pattern_edges(t.links, placed, both).select("source_id", "target_id", F.lit("related_to").alias("relation"), F.round("weight", 6).alias("weight"), F.col("link_count").alias("support"))
    return T.upsert_relationships([sub, pre, rel])


@query(
    "select source_topic_id as source_id, target_topic_id as target_id, relation, weight from (select *, lower(trim(relationship_type, ' ')) as relation, row_number() over (partition by source_topic_id, target_topic_id, lower(trim(relationship_type, ' ')) order by coalesce(created_at >= timestamp '2025-01-01', false) desc, id desc) as r from topic_relationships) where r = 1"
)
def upsert_relationships(t):
    late = F.coalesce(F.col("created_at") >= F.lit("2025-01-01").cast("timestamp_ntz"), F.lit(False)).alias("late")
    rows = t.topic_relationships.select(F.col("source_topic_id").alias("source_id"), F.col("target_topic_id").alias("target_id"), T.relation(F.col("relationship_type")).alias("relation"), "weight", "id", late)
    keys = ["source_id", "target_id", "relation"]
    return A.upsert_latest(A.latest(rows.where("not late"), keys, "id"), rows.where("late"), keys, "id").drop("id", "late")


@query(
    "select id, article_id, canonical_topic from (select *, row_number() over (partition by article_id order by (enriched_at >= timestamp '2025-01-01') desc, id desc) as r from article_enrichment where enriched_at is not null) where r = 1"
)
def upsert_enrichment(t):
    rows = t.article_enrichment.where("enriched_at is not null").select("id", "article_id", "canonical_topic", (F.col("enriched_at") >= F.lit("2025-01-01").cast("timestamp_ntz")).alias("late"))
    stored = A.latest(rows.where("not late"), ["article_id"], "id")
    return A.upsert_latest(stored, rows.where("late"), ["article_id"], "id").drop("late")


_TOPIC_ROWS = Q.normalized("article_enrichment", "article_id", "canonical_topic", "te")


@query(f"with {_TOPIC_ROWS} select topic_id, article_id from topic_articles union all (select x.id, te.article_id from te join topics x on x.normalized_name = te.norm where te.article_id is not null except select topic_id, article_id from topic_articles)")
def insert_topic_articles(t):
    named = t.article_enrichment.select("article_id", normalized_topic(F.col("canonical_topic"), organisation=Q.ORGANISATION).alias("normalized_name"))
    new = named.join(t.topics.select(F.col("id").alias("topic_id"), "normalized_name"), "normalized_name").select("topic_id", "article_id")
    return A.insert_ignore(t.topic_articles, new, ["topic_id", "article_id"])


@query("select id, name, normalized_name, total_articles, coalesce(intent_distribution['how-to'], 0) as how_to, coalesce(len(map_keys(audience_distribution)), -1) as audiences, updated_at from topics")
def topics_csv_round_trip(t):
    path = f"{shared_folder(t._spark)}/corpusloom/{t._spark.sparkContext.applicationId}/topics-{uuid.uuid4().hex}"
    write_csv(t.topics, path)
    back = read_csv(t._spark, path, "topics")
    how_to = F.coalesce(F.try_element_at("intent_distribution", F.lit("how-to")), F.lit(0))
    return back.select("id", "name", "normalized_name", "total_articles", how_to.alias("how_to"), F.coalesce(F.size(F.map_keys("audience_distribution")), F.lit(-1)).alias("audiences"), "updated_at")


_GENERIC = ", ".join(map(Q._q, rules.GENERIC_TITLES))


@query(
    f"with old as (select * from articles where coalesce(crawled_at < timestamp '2025-01-01', true)), new as (select *, coalesce(nullif(sys_kb_id, ''), {Q.kb_id('url')}) as key from articles where crawled_at >= timestamp '2025-01-01'), bk as (select sys_kb_id as key, min(id) as key_id from old where sys_kb_id is not null group by 1), "
    f"bt as (select title, id as same_id, sys_kb_id as same_key from (select *, row_number() over (partition by title order by id) as r from old where title is not null and title <> '' and title not in ({_GENERIC})) where r = 1), bu as (select url, min(id) as url_id from old where url is not null group by 1), "
    "f as (select n.*, key_id, same_id, url_id, case when key_id is not null then 1 when same_id is not null and ((n.key is not null and same_key is null) or length(content) > 100) then 2 when same_id is not null then 0 when url_id is not null then 4 else 3 end as tier "
    "from new n left join bk on bk.key = n.key left join bt on bt.title = n.title left join bu on bu.url = n.url), g as (select *, case tier when 1 then key_id when 2 then same_id when 4 then url_id end as target from f where tier > 0), "
    "la as (select * from (select *, row_number() over (partition by coalesce(cast(target as varchar), 'k:' || key, 'u:' || url, 'r:' || id) order by id desc) as r from g) where r = 1) "
    "select o.id, case when tier = 2 then la.url else o.url end as url, case when tier = 2 then coalesce(la.key, o.sys_kb_id) when tier = 4 then la.key else o.sys_kb_id end as sys_kb_id, case when tier = 2 then o.title when tier in (1, 4) then coalesce(la.title, '') else o.title end as title, "
    "case when tier is null then length(o.content) else length(la.content) end as size from old o left join la on la.target = o.id union all "
    "select cast((select coalesce(max(id), 0) from old) + row_number() over (order by id, url) as integer), url, key, title, length(content) from la where tier = 3"
)
def upsert_articles(t):
    early = F.coalesce(F.col("crawled_at") < F.lit("2025-01-01").cast("timestamp_ntz"), F.lit(True))
    new = t.articles.where(~early).withColumn("ingest_order", F.col("id"))
    return A.upsert_articles(t.articles.where(early), new).select("id", "url", "sys_kb_id", "title", F.length("content").alias("size"))


@query(
    f"with n as (select id, 'sys_kb_id:' || sys_kb_id as name from articles where sys_kb_id is not null union all select id, {Q.normal_url('url')} from articles), k as (select name, min(id) as first from n group by 1), f as (select source_id, {Q.normal_url('url')} as name from links join articles on id = target_id where source_id is not null), "
    "m as (select source_id, first as target_id from f join k using (name)) select source_id, target_id from links union select source_id, target_id from m"
)
def upsert_links(t):
    urls = t.articles.select(F.col("id").alias("target_id"), F.col("url").alias("target_url"))
    return A.upsert_links(t.articles, t.links, t.links.join(urls, "target_id").select("source_id", "target_url"))[1]


@query(f"with {Q.EDGES} select id as topic_id, count(*) filter (where rel = 'subtopic_of' and t = id) as indegree, count(*) filter (where rel = 'subtopic_of' and s = id) as outdegree, count(*) filter (where rel = 'prerequisite_of' and s = id) as prerequisite_count from topics left join ed on s = id or t = id group by 1")
def topic_degrees(t):
    return T.degrees(T.known_edges(t.topic_relationships, t.topics), t.topics)


@query(f"with {Q.ADJACENT} select topic_id, incoming as parents, outgoing as children, related, prerequisites, dependents from adj")
def topic_adjacency(t):
    return T.adjacency(T.known_edges(t.topic_relationships, t.topics), t.topics)


def _cos(d: str) -> str:
    norm = lambda side: f"sqrt(list_sum([cast(v as double) * v for v in map_values({side}.{d}_distribution)]))"
    return f"coalesce(list_sum([cast(coalesce(a.{d}_distribution[k], 0) as double) * coalesce(b.{d}_distribution[k], 0) for k in map_keys(a.{d}_distribution)]) / nullif({norm('a')} * {norm('b')}, 0), 0)"


@query(
    f"with {Q.EDGES} select s as source_id, t as target_id, round(0.5 * {_cos('audience')} + 0.3 * {_cos('intent')} + 0.2 * {_cos('complexity')}, 6) as similarity from ed join topics a on a.id = s join topics b on b.id = t where rel = 'related_to'"
)
def profile_similarity(t):
    pairs = T.known_edges(t.topic_relationships, t.topics).where("relation = 'related_to'").select("source_id", "target_id")
    return T.profile_similarity(pairs, t.topics).select("source_id", "target_id", F.round("similarity", 6).alias("similarity"))


_SIMILAR = f"p as (select a.id as source_id, b.id as target_id, 0.5 * {_cos('audience')} + 0.3 * {_cos('intent')} + 0.2 * {_cos('complexity')} as similarity from topics a join topics b on a.id <> b.id where a.id % 100 = 0)"


def _asked(t):
    return t.topics.where("id % 100 = 0").select("id")


@query(f"with {_SIMILAR} select source_id, target_id, round(similarity, 6) as similarity from p where round(similarity, 9) >= 0.7")
def similar_profiles(t):
    return T.similar_profiles(t.topics, _asked(t)).withColumn("similarity", F.round("similarity", 6))


@query(f"with {Q.EDGES}, {_SIMILAR} select source_id, target_id, round(similarity, 6) as similarity from p anti join (select s as source_id, t as target_id from ed union select t, s from ed) using (source_id, target_id) where round(similarity, 9) >= 0.7")
def related_by_profile(t):
    return T.related_by_profile(t.topics, T.known_edges(t.topic_relationships, t.topics), _asked(t)).withColumn("similarity", F.round("similarity", 6))


@query(
    f"with {Q.WORDS}, lo as (select * from tw where total_articles < 3 and name <> ''), hi as (select * from tw where total_articles >= 3 and name <> ''), p as (select l.id as topic_id, h.id as target_id, case when contains(l.name, h.name) or contains(h.name, l.name) then 10 when len(list_intersect(l.words, h.words)) * 1.0 / len(l.words) >= 0.6 then 5 else 2 end as score "
    "from lo l, hi h where len(list_intersect(l.words, h.words)) > 0 or contains(l.name, h.name) or contains(h.name, l.name)), best as (select topic_id, target_id, score from (select *, row_number() over (partition by topic_id order by score desc, target_id) as r from p) where r = 1), "
    "g as (select l.id as a, m.id as b, length(m.name) as size from lo l, lo m where l.id not in (select topic_id from best) and (l.id = m.id or len(list_intersect(l.words, m.words)) * 1.0 / least(len(l.words), len(m.words)) >= 0.5)), "
    "c as (select a, arg_max(b, size * 1000000000 - b) as target_id from g group by 1 having count(*) > 1) select * from best union all (select distinct b, target_id, 1 from g join c using (a) where b <> target_id)"
)
def suggest_merges(t):
    return T.suggest_merges(t.topics)


# structure


@query(f"with {Q.ISSUES} select * from iss where issue = 'orphan'")
def issues_orphan(t):
    return S.issues_orphan(T.known_edges(t.topic_relationships, t.topics), t.topics)


@query(f"with {Q.ISSUES} select * from iss where issue = 'overloaded'")
def issues_overloaded(t):
    return S.issues_overloaded(t.topics)


@query(f"with {Q.ISSUES} select * from iss where issue = 'mixed_intent'")
def issues_mixed_intent(t):
    return S.issues_mixed(t.topics)


@query(f"with {Q.ISSUES} select * from iss")
def ia_issues(t):
    return S.issues(T.known_edges(t.topic_relationships, t.topics), t.topics)


@query(f"with {Q.ISSUES} select issue, severity, count(*) as n from iss group by 1, 2")
def issue_summary(t):
    return S.issues(T.known_edges(t.topic_relationships, t.topics), t.topics).groupBy("issue", "severity").agg(F.count("*").alias("n"))


@query(f"with {Q.SCORED} select * from score order by score desc, total_articles desc, topic_id limit 10")
def top_level_topics(t):
    return S.top_level(T.known_edges(t.topic_relationships, t.topics), t.topics).orderBy(F.desc("score"), F.desc("total_articles"), "topic_id").limit(10)


@query(f"with {Q.TREE} select * from tree")
def auto_sidebar(t):
    return S.auto_sidebar(T.known_edges(t.topic_relationships, t.topics), t.topics)


@query(f"with {Q.TREE} select root_id, count(*) as nodes, max(depth) as deepest from tree group by rollup (root_id)")
def tree_node_counts(t):
    return S.tree_counts(S.auto_sidebar(T.known_edges(t.topic_relationships, t.topics), t.topics))


def _entries(t):
    return t.topic_catalog.where("category is not null").select("category", F.col("name").alias("entry"))


def _built(t):
    return T.build_topics(_assigned(t))


def _keywords(t):
    return t.topic_catalog.where("category is not null").select("category", F.explode(F.split(F.lower("name"), " ")).alias("keyword"))


def _sidebar(t):
    topics, placed = _graph(t)
    return S.sidebar(_entries(t), topics.withColumnRenamed("id", "topic_id"), S.keyword_counts(_keywords(t), t.articles, placed))


@query(f"with {Q.MATCHED} select category, entry, topic_id, case when kind = 1 then 'exact' else 'fuzzy' end as kind from matched")
def sidebar_topic_match(t):
    return S.topic_match(_entries(t), _built(t))


@query(f"with {Q.SIDEBAR} select category, entry, topic_id, article_count, category_count, cast(place as integer) as place from side")
def sidebar_tree(t):
    return _sidebar(t)


@query(f"with {Q.SIDEBAR} select category, cast(sum(article_count) as bigint) as articles, count(*) as entries from side group by 1")
def sidebar_categories(t):
    return _sidebar(t).groupBy("category").agg(F.sum("article_count").alias("articles"), F.count("*").alias("entries"))


@query(f"with {Q.SIDEBAR} select category, cast(sum(article_count) as bigint) as articles from side group by 1 order by 2 desc, 1 limit 3")
def largest_sections(t):
    return _sidebar(t).groupBy("category").agg(F.sum("article_count").alias("articles")).orderBy(F.desc("articles"), "category").limit(3)


@query(f"with {Q.KEYWORDS} select distinct category, id as article_id from articles, kw where contains(lower(title), keyword) and keyword <> ''")
def keyword_articles(t):
    return S.keyword_articles(_keywords(t), t.articles)


# crawl


_REACH = "with recursive e as (select distinct source_id, target_id from links where source_id <> target_id), s as (select distinct id from articles where depth = 0), w(id, d) as (select id, 0 from s union select e.target_id, w.d + 1 from w join e on e.source_id = w.id where w.d < 2), met as (select id, min(d) as depth from w group by 1)"


def _reach(t):
    return C.reach(t.links, t.articles.where("depth = 0").select("id"), 2)


@query(f"{_REACH} select id, depth from met where id is not null")
def frontier_bfs(t):
    return _reach(t)


@query(f"{_REACH} select depth, count(*) as pages from met where id is not null group by 1")
def frontier_stats(t):
    return C.frontier_stats(_reach(t))


@query(f"{_REACH} select m.id, m.depth, not {Q.FILLED} as fetch, m.depth < 2 as expand from met m join articles a on a.id = m.id")
def crawl_plan(t):
    return C.plan(_reach(t), t.articles, 2)


@query(f"select coalesce(starts_with({Q.kb_id('url')}, 'KB'), false) as legacy, count(*) as pages from articles group by 1")
def legacy_page_counts(t):
    marked = C.legacy_pages(t.articles).withColumn("legacy", F.lit(True))
    return t.articles.select("id").join(marked, "id", "left").groupBy(F.coalesce("legacy", F.lit(False)).alias("legacy")).agg(F.count("*").alias("pages"))


_CRAWL = C.CrawlConfig((("portal", 1), ("printer", 2), ("gateway", 2)), 200)


def _keyword_reach(t):
    return C.reach_by_keywords(t.links, t.articles, _CRAWL, C.legacy_pages(t.articles))


_KEYWORD_REACH = (
    f"with recursive sk as (select id from articles where starts_with({Q.kb_id('url')}, 'KB')), e as (select distinct source_id, target_id from links where source_id <> target_id and target_id not in (select id from sk)), "
    "s as (select id, 1 as most from articles where contains(lower(title), 'portal') union select id, 2 from articles where contains(lower(title), 'printer') or contains(lower(title), 'gateway')), "
    "w(id, d, most) as (select id, 0, most from s where id not in (select id from sk) union select e.target_id, w.d + 1, most from w join e on e.source_id = w.id where w.d < most), met as (select id, min(d) as depth from w group by 1)"
)


@query(f"{_KEYWORD_REACH} select id, depth from met")
def keyword_frontier(t):
    return _keyword_reach(t)


@query(f"{_KEYWORD_REACH} select id, depth from met where id in (select id from articles where not {Q.FILLED}) order by depth, id limit 200")
def next_pages(t):
    return C.next_pages(_keyword_reach(t), t.articles, _CRAWL)


@query(
    f"with f as (select {Q.normal_url('url')} as name, max(id) as last from articles where url is not null group by 1) select l.source_id, l.target_id, m.title as found_title, m.can_read as found_can_read "
    f"from links l join articles a on a.id = l.target_id left join f on f.name = {Q.normal_url('a.url')} left join articles m on m.id = f.last"
)
def link_metadata(t):
    found = C.latest_metadata(t.articles.select("id", "url", "title", "can_read"), "id", ["title", "can_read"])
    targets = C.with_metadata(t.articles.select(F.col("id").alias("target_id"), "url"), found, ["title", "can_read"])
    return t.links.select("source_id", "target_id").join(targets.drop("url"), "target_id").select("source_id", "target_id", "found_title", "found_can_read")


# pages, search results, prompts and replies, made by Spark from the tables


def _pages(t):
    cell = lambda c: F.replace(F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    body = F.array_join(F.transform(F.split(cell("content"), "\n"), lambda x: F.concat(F.lit("<p>"), x, F.lit("</p>"))), "")
    html = F.concat(
        F.lit("<html><head><title>"), cell("title"), F.lit("</title></head><body><nav><a href='/'>Home</a></nav><article><h1>"), cell("title"), F.lit("</h1>"), body,
        F.lit("<a href='?id=kb_article&amp;sys_kb_id="), F.coalesce("sys_kb_id", F.lit("0")), F.lit("'>again</a><a href='#top'>top</a></article><footer>Imprint</footer></body></html>"),
    )
    return t.articles.select("id", F.trim("url").alias("url"), html.alias("html"))


_SPACE = "[\\s\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+"


def _stripped(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_SPACE}', ''), '{_SPACE}$', '')"


@query(
    f"with p as (select id, {_stripped('coalesce(title, \'\')')} as title, [x for x in [{_stripped('y')} for y in string_split(coalesce(content, ''), chr(10))] if x <> ''] as lines from articles), "
    "b as (select *, list_concat(case when title <> '' then [title] else [] end, lines, ['again', 'top']) as parts from p) "
    "select id, case when title = '' then 'Untitled Article' else title end as title, cast(list_sum([length(x) for x in parts]) + len(parts) - 1 as integer) as size, 2 as links from b"
)
def parse_pages(t):
    return P.parse_pages(_pages(t)).select("id", "title", F.length("content").alias("size"), F.size("links").alias("links"))


@query(
    "with p as (select id, trim(coalesce(url, ''), ' ') as url, coalesce(sys_kb_id, '0') as key from articles), r as (select id, regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*') as root, regexp_replace(url, '[?#].*$', '') as bare, key from p) "
    "select id, unnest([root || '/', bare || '?id=kb_article&sys_kb_id=' || key]) as link from r"
)
def page_links(t):
    return P.parse_pages(_pages(t)).select("id", F.explode("links").alias("link"))


@query("select id, trim(regexp_replace(replace(replace(coalesce(title, ''), '&', '&amp;'), '<', '&lt;'), '\\s+', ' ', 'g'), ' ') as title from articles")
def page_titles(t):
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    return _pages(t).select("id", F.regexp_replace(F.regexp_replace(title, r"\s+", " "), "^ | $", "").alias("title"))


@query("select cast(id as varchar) as id, coalesce(title, '') as title, url as link, coalesce(number, '') as number, coalesce(nullif(can_read, ''), 'Public') as can_read from articles")
def flatten_search_results(t):
    meta = F.struct(F.lit("knowledge").alias("source"), F.struct(F.col("title").alias("display_value")).alias("title"), "number", "can_read")
    hit = F.struct(F.col("id").cast("string").alias("id"), F.col("url").alias("link"), meta.alias("meta"))
    page = F.floor(F.col("id") / 50)  # a reply has a page of at most 50 hits
    replies = t.articles.groupBy(page.alias("page")).agg(F.to_json(F.struct(F.struct(F.struct(F.collect_list(hit).alias("results")).alias("results")).alias("data"))).alias("reply"))
    return RP.search_results(replies, "reply")


@query(
    "select id, 'Classify the article below. Reply with JSON: canonical_topic, keywords, intent, audience, prerequisites, complexity.' || chr(10) || 'Title: ' || coalesce(title, '') || chr(10) || 'Text: ' || coalesce(regexp_replace(substr(content, 1, 500), '^\\s+|\\s+$', '', 'g'), '') as prompt from articles"
)
def enrichment_prompt(t):
    return t.articles.select("id", R.prompt(F.col("title"), F.col("content")).alias("prompt"))


def _replies(t):
    e = t.article_enrichment
    reply = F.to_json(F.struct(F.concat(F.lit(" "), "canonical_topic").alias("canonical_topic"), "intent", "audience", "complexity", "keywords", F.array_join("prerequisites", ", ").alias("prerequisites")), {"ignoreNullFields": "false"})
    return e.select("id", reply.alias("reply"))


def _enum(c: str, domain: list[str]) -> str:
    v = f"case when lower({c}) = 'howto' then 'how-to' else lower({c}) end"
    return f"case when {v} in ({', '.join(map(Q._q, domain))}) then {v} else 'unknown' end"


_OK = "(coalesce(trim(canonical_topic, ' ') <> '', false) and intent is not null and audience is not null and complexity is not null)"


@query(
    f"select id, {_OK} as ok, case when {_OK} then trim(canonical_topic, ' ') end as canonical_topic, case when {_OK} then {_enum('intent', rules.INTENTS)} end as intent, case when {_OK} then {_enum('audience', rules.AUDIENCES)} end as audience, "
    f"case when {_OK} then {_enum('complexity', rules.COMPLEXITIES)} end as complexity, case when {_OK} then coalesce(array_to_string(keywords, '|'), '') end as keywords, case when {_OK} then coalesce(array_to_string(prerequisites, '|'), '') end as prerequisites from article_enrichment"
)
def parse_enrichment(t):
    r = R.parse_replies(_replies(t))
    return r.withColumns({c: F.when(F.col("ok"), F.array_join(c, "|")) for c in ("keywords", "prerequisites")})


@query(f"select {_OK} as ok, count(*) as n from article_enrichment group by 1")
def enrichment_outcome(t):
    return R.parse_replies(_replies(t)).groupBy("ok").agg(F.count("*").alias("n"))


# reports


@query(
    f"with {Q.SIDEBAR} select category, '{{\"category\":' || to_json(category) || ',\"article_count\":' || max(category_count) || ',\"children\":[' || string_agg('{{\"place\":' || place || ',\"entry\":' || to_json(entry) || case when topic_id is null then '' else ',\"topic_id\":' || topic_id end || ',\"article_count\":' || article_count || '}}', ',' order by place) || ']}}' as json from side group by category"
)
def sidebar_json(t):
    return RP.sidebar_json(_sidebar(t))


@query(f"with {Q.ISSUES} select topic_id, '{{\"topic_id\":' || topic_id || ',\"issues\":[' || string_agg('{{\"issue\":\"' || issue || '\",\"severity\":\"' || severity || '\"}}', ',' order by issue, severity) || ']}}' as json from iss group by topic_id")
def issues_json(t):
    return RP.issues_json(S.issues(T.known_edges(t.topic_relationships, t.topics), t.topics))


@query()
def report_markdown(t):
    return RP.markdown(t.topics, S.issues(T.known_edges(t.topic_relationships, t.topics), t.topics), _sidebar(t))


# problem 7


def _topic_tree(t):
    return H.hierarchy(H.clean_edges(t.topic_relationships, t.topics, "subtopic_of", "source_topic_id", "target_topic_id", "relationship_type", "id"))


_TREE = """
with recursive e as (
  select distinct source_topic_id as p, target_topic_id as c from topic_relationships
  where lower(trim(relationship_type, ' ')) = 'subtopic_of' and source_topic_id in (select id from topics) and target_topic_id in (select id from topics)),
n as (select p as id from e union select c from e),
t(id, root, depth, path) as (
  select id, id, 0, cast(id as varchar) from n where id not in (select c from e)
  union all select e.c, t.root, t.depth + 1, t.path || '/' || cast(e.c as varchar) from t join e on e.p = t.id)
"""


@query(_TREE + "select id as topic_id, root as root_id, depth, path from t union all select id, -1, -1, 'cycle' from n where id not in (select id from t)")
def p7_found(t):
    path = F.coalesce(F.array_join(F.col("path").cast("array<string>"), "/"), F.lit("cycle"))
    return _topic_tree(t).select(F.col("node").alias("topic_id"), F.col("root").alias("root_id"), "depth", path.alias("path"))


@query(
    _TREE
    + "select cast(a.v as integer) as topic_id, t.id as descendant_id, cast(len(string_split(path, '/')) - a.i as integer) as distance "
    "from t, lateral (select unnest(string_split(path, '/')) as v, unnest(range(1, len(string_split(path, '/')) + 1)) as i) a where a.i < len(string_split(path, '/'))"
)
def p7_descendants(t):
    return H.ancestor_pairs(_topic_tree(t)).select(F.col("ancestor").alias("topic_id"), F.col("node").alias("descendant_id"), "distance")
