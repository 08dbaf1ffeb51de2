"""Problem 6: duplicates hidden by formatting, counted in an incremental ledger.

A ledger has one row per canonical key: (bucket, key, copies, first_id). A batch is aggregated (map-side first) to the
same form and joined to the ledger's matching buckets by a full outer join; counts add up and the earliest
representative stays. Only 16-byte keys, ids and counts are shuffled, never titles or urls.

Defined cases: null title or url counts as empty; an empty table gives an empty ledger; repeated rows count as copies;
columns besides those named are ignored, whatever their names; texts of any length are reduced to one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import written

#: Buckets of the ledger: with a stored ledger, a batch reads and rewrites only the buckets that it touches.
BUCKETS = 64


def bare(c: Column) -> Column:
    """Letters and digits of the text, lower-cased."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", "")


def unescaped(c: Column) -> Column:
    """Percent-escapes as what they stand for; a stray % stays."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25")), c)


def url_key(url: Column) -> Column:
    """Letters and digits before the first `?`, then the sorted bare fields after it."""
    url = F.coalesce(url, F.lit(""))
    head, tail = F.substring_index(url, "?", 1), F.regexp_extract(url, r"(?s)\?(.*)$", 1)
    fields = F.array_sort(F.filter(F.transform(F.split(tail, "&"), lambda f: bare(unescaped(f))), lambda f: f != ""))
    return F.concat(bare(unescaped(head)), F.lit("?"), F.array_join(fields, "&"))


def canonical_key(title: Column, url: Column) -> Column:
    """16 bytes that are the same for records that differ in formatting only."""
    return F.unhex(F.md5(F.concat(bare(F.coalesce(title, F.lit(""))), F.lit("\n"), url_key(url))))


def keyed(records: DataFrame, id_col: str = "id", title: str = "title", url: str = "url", keep: tuple[str, ...] = (), buckets: int = BUCKETS) -> DataFrame:
    """(bucket, key, id) of each record, and the columns named in `keep`. A ledger keeps its number of buckets; a large one should have more."""
    key = canonical_key(F.col(title), F.col(url))
    return records.select(key.alias("key"), F.col(id_col).alias("id"), *keep).select(
        F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int").alias("bucket"), "key", "id", *keep
    )


def batch_counts(batch: DataFrame) -> DataFrame:
    """A keyed batch in the ledger's form; a hot key is combined in each task before the shuffle."""
    return batch.groupBy("bucket", "key").agg(F.count("*").alias("copies"), F.min("id").alias("first_id"))


def merge_ledger(ledger: DataFrame, batch: DataFrame) -> DataFrame:
    """The ledger after a keyed batch: full outer join on bucket and key, counts added, earliest representative kept."""
    old = ledger.select("bucket", "key", F.col("copies").alias("old_copies"), F.col("first_id").alias("old_first"))
    return old.join(batch_counts(batch), ["bucket", "key"], "full_outer").select(
        "bucket",
        "key",
        (F.coalesce("old_copies", F.lit(0)) + F.coalesce("copies", F.lit(0))).alias("copies"),
        F.least("old_first", "first_id").alias("first_id"),
    )


def apply_batch(path: str, batch: DataFrame) -> None:
    """Merge a keyed batch into the ledger stored at `path`, partitioned by bucket; buckets the batch lacks are neither read nor written.

    The merged buckets are written to the shared folder first, so the ledger is only replaced by what is complete.
    """
    spark = batch.sparkSession
    batch = written(batch, "batch")
    touched = [r.bucket for r in batch.select("bucket").distinct().collect()]  # one row a bucket
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        merged = merge_ledger(spark.read.schema(batch_counts(batch).schema).parquet(path).where(F.col("bucket").isin(touched)), batch)
    else:
        merged = batch_counts(batch)
    written(merged, "ledger").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def copies(records: DataFrame, ledger: DataFrame) -> DataFrame:
    """(group_id, id) of every keyed record whose key has two or more copies."""
    several = ledger.where("copies > 1").select("bucket", "key", F.col("first_id").alias("group_id"))
    return records.join(several, ["bucket", "key"]).select("group_id", "id")
