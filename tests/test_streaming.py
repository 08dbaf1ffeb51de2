import datetime as dt

from corpusloom.streaming import ingest


def test_first_crawls(spark, tmp_path):
    rows = [(1, "https://h/a", dt.datetime(2024, 1, 1, 10)), (2, "https://h/a/", dt.datetime(2024, 1, 1, 11)), (3, "https://h/b", dt.datetime(2024, 1, 1, 12))]
    df = spark.createDataFrame(rows, "id int, url string, crawled_at timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    seen = []
    stream = ingest.first_crawls(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    ingest.upserting(stream, lambda b, n: seen.extend(r.url.rstrip("/") for r in b.collect()), str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(seen) == ["https://h/a", "https://h/b"]
    counts = ingest.crawls_per_window(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    got = []
    counts.writeStream.outputMode("update").foreachBatch(lambda b, n: got.extend(b.collect())).option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start().awaitTermination()
    assert sum(r.pages for r in got) == 3
