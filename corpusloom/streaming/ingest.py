"""Streams of newly crawled articles: an extension, since the batch operators cover the same work."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from corpusloom.functions.urls import normalized_url


def first_crawls(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """The first row of each page within the watermark; state is dropped once rows of its time can no longer come."""
    return stream.withColumn("page", normalized_url(F.col("url"))).withWatermark("crawled_at", late).dropDuplicatesWithinWatermark(["page"]).drop("page")


def crawls_per_window(stream: DataFrame, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """(start, host, pages): crawled pages of each host and window of time, with late rows up to the watermark."""
    host = F.regexp_extract("url", "://([^/?#]+)", 1)
    by = stream.withWatermark("crawled_at", late).groupBy(F.window("crawled_at", window).alias("w"), host.alias("host")).agg(F.count("*").alias("pages"))
    return by.select(F.col("w.start").alias("start"), "host", "pages")


def upserting(stream: DataFrame, merge: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    """A writer that hands each micro-batch to `merge` (rows, batch number), which must be idempotent by batch number."""
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
