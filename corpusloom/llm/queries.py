"""Registered queries of this subpackage and the SQL to check them by, where SQL can express them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import boilerplate, canonical, leakage, ledger, mojibake, neardup, packing, residue, survivor
from corpusloom.session import broadcast_if_small, shared_folder, written
from corpusloom.sources.tables import table

#: Crawls before this day form the stored ledger of p6, later ones the new batch.
LEDGER_DAY = "2025-01-01"


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    articles = table(spark, d, "articles")
    units = written(residue.text_units(articles), "units")
    lines = boilerplate.boilerplate_lines(articles, boilerplate.fit(articles, units))
    out = residue.residue(articles, units).where("field = 'content'").select("id")
    return lines.join(broadcast_if_small(out), "id", "left_anti").select("id", "line_no")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.similar_articles(table(spark, d, "articles"))


def p2_document_classes(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    return neardup.classes(written(neardup.sketches(docs), "sketches")).select(F.col("id").alias("doc_id"), "class_id", "links")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical.map_values(table(spark, d, "article_enrichment"), table(spark, d, "topic_catalog"))


def p3_unmatched(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "article_enrichment").select("id", F.col("canonical_topic").alias("value"))
    found = canonical.match_values(rows, table(spark, d, "topic_catalog")).where("ref_id = -1").select("value")
    return rows.join(found, "value", "left_semi").unionByName(rows.where("value is null")).groupBy("value").agg(F.count("*").alias("n"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return survivor.surviving_articles(table(spark, d, "articles"))


def p4_records(spark: SparkSession, d: str) -> DataFrame:
    return survivor.surviving_records(table(spark, d, "articles"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return residue.residue(table(spark, d, "articles"))


def _keyed(articles: DataFrame) -> DataFrame:
    records = articles.select("id", "title", "url", F.coalesce(F.col("crawled_at") < F.lit(LEDGER_DAY).cast("timestamp_ntz"), F.lit(True)).alias("early"))
    return written(ledger.keyed(records, keep=("early",)), "keyed")


def _ledger(articles: DataFrame) -> tuple[DataFrame, DataFrame]:
    keyed = _keyed(articles)
    stored = ledger.batch_counts(keyed.where("early"))
    return keyed, ledger.merge_ledger(stored, keyed.where("not early"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    keyed, book = _ledger(table(spark, d, "articles"))
    return ledger.copies(keyed, book)


def p6_ledger(spark: SparkSession, d: str) -> DataFrame:
    """The ledger on disk after two batches."""
    path = f"{shared_folder(spark)}/corpusloom/{spark.sparkContext.applicationId}/book-{uuid.uuid4().hex}"
    keyed = _keyed(table(spark, d, "articles"))
    for batch in (keyed.where("early"), keyed.where("not early")):
        ledger.apply_batch(path, batch)
    return spark.read.parquet(path).select("first_id", "copies")


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_texts(table(spark, d, "documents"), table(spark, d, "pack_limits"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    by = p8_containers(spark, d).groupBy("capacity", "container").agg(F.sum("tokens").alias("tokens"))
    return by.groupBy("capacity").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.sum(F.col("capacity") - F.col("tokens")).alias("unused"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_items(spark: SparkSession, d: str) -> DataFrame:
    return p9_found(spark, d).groupBy("item_id").agg(F.count("*").alias("documents"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return mojibake.restored(table(spark, d, "documents")).select("doc_id", "restored_md5")


QUERIES = {
    "p1_found": p1_found,
    "p2_found": p2_found,
    "p2_document_classes": p2_document_classes,
    "p3_found": p3_found,
    "p3_unmatched": p3_unmatched,
    "p4_found": p4_found,
    "p4_records": p4_records,
    "p5_found": p5_found,
    "p6_found": p6_found,
    "p6_ledger": p6_ledger,
    "p8_containers": p8_containers,
    "p8_fill": p8_fill,
    "p9_found": p9_found,
    "p9_items": p9_items,
    "p10_found": p10_found,
}

_KEYED = r"""
with k as (
  select id, regexp_replace(lower(coalesce(title, '')), '[^\p{L}\p{N}]+', '', 'g') as t,
    regexp_replace(lower(url_decode(split_part(coalesce(url, ''), '?', 1))), '[^\p{L}\p{N}]+', '', 'g') as u,
    case when strpos(url, '?') > 0 then array_to_string(list_sort([x for x in [regexp_replace(lower(url_decode(f)), '[^\p{L}\p{N}]+', '', 'g')
      for f in string_split(substr(url, strpos(url, '?') + 1), '&')] if x <> '']), '&') else '' end as q
  from articles)
"""
SQL = {
    "p6_found": _KEYED + "select first_id as group_id, id from (select id, min(id) over w as first_id, count(*) over w as copies from k window w as (partition by t, u, q)) where copies > 1",
    "p6_ledger": _KEYED + "select min(id) as first_id, count(*) as copies from k group by t, u, q",
}
