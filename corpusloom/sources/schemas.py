"""Schemas of the tables of a knowledge base, and frames brought to them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, FloatType, IntegerType, LongType, MapType, StringType, StructField, StructType, TimestampNTZType

_KINDS: dict[str, DataType] = {
    "int": IntegerType(), "string": StringType(), "float": FloatType(), "timestamp_ntz": TimestampNTZType(), "array<string>": ArrayType(StringType()), "map<string,bigint>": MapType(StringType(), LongType()),
}
_COUNTS = "map<string,bigint>"
#: Every table with its columns, in order.
SCHEMAS: dict[str, StructType] = {
    name: StructType([StructField(column.split(" ")[0], _KINDS[column.split(" ")[1]]) for column in columns.split(", ")])
    for name, columns in {
        "articles": "id int, url string, sys_kb_id string, title string, content string, number string, display_number string, snippet string, score float, can_read string, depth int, crawled_at timestamp_ntz, updated_at timestamp_ntz",
        "links": "source_id int, target_id int, created_at timestamp_ntz",
        "article_enrichment": "id int, article_id int, canonical_topic string, keywords array<string>, intent string, audience string, prerequisites array<string>, complexity string, enriched_at timestamp_ntz, llm_model string",
        "topics": f"id int, name string, normalized_name string, total_articles int, indegree int, outdegree int, prerequisite_count int, intent_distribution {_COUNTS}, complexity_distribution {_COUNTS}, audience_distribution {_COUNTS}, created_at timestamp_ntz, updated_at timestamp_ntz",
        "topic_articles": "topic_id int, article_id int",
        "topic_relationships": "id int, source_topic_id int, target_topic_id int, relationship_type string, weight float, supporting_article_count int, link_count int, created_at timestamp_ntz",
    }.items()
}


def conformed(df: DataFrame, name: str) -> DataFrame:
    """`df` with exactly the columns of the table `name`: cast, in order, null where `df` lacks one; others are dropped."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[name].fields])
