import datetime as dt

from pyspark.sql import functions as F

from corpusloom.functions.urls import kb_id, normalized_url
from corpusloom.operators import articles as A
from corpusloom.operators import crawl as C
from corpusloom.operators.numbering import numbered

SCHEMA = "id int, url string, sys_kb_id string, title string, content string, number string, display_number string, snippet string, crawled_at timestamp_ntz, updated_at timestamp_ntz"


def rows(spark, data):
    full = [(d.get("id"), d.get("url", f"https://h/{d.get('id')}"), d.get("key"), d.get("title"), d.get("content"), d.get("number"), None, None, d.get("crawled"), d.get("updated")) for d in data]
    return spark.createDataFrame(full, SCHEMA)


def test_key_dedup(spark):
    a = rows(spark, [dict(id=1, key="k1", title="Pending", content="", number=""), dict(id=2, key="k1", title="A", content="text", number=""), dict(id=3, key="k1", title="A2", content="t2", number="N3"), dict(id=4, title="B", content="t", number="N4")])
    replaced = A.key_mapping(a)
    assert {tuple(r) for r in replaced.collect()} == {(1, 2), (3, 2)}
    links = spark.createDataFrame([(1, 4, dt.datetime(2024, 1, 2)), (2, 4, dt.datetime(2024, 1, 1)), (4, 3, None), (2, 3, None)], "source_id int, target_id int, created_at timestamp_ntz")
    moved = {(r.source_id, r.target_id): r.created_at for r in A.rewrite_links(links, replaced).collect()}
    assert moved == {(2, 4): dt.datetime(2024, 1, 1), (4, 2): None, (2, 2): None}
    assert {r.id for r in A.survivors(a, replaced).collect()} == {2, 4}
    assert A.best_attributes_by_key(a).first()["number"] == "N3"


def test_title_dedup(spark):
    a = rows(spark, [dict(id=10, title="T", content="x", updated=dt.datetime(2024, 1, 1)), dict(id=11, title="T", content="", updated=dt.datetime(2024, 2, 1)), dict(id=12, title="T", content="y", number="N")])
    assert A.title_canonical(a).first()["canonical_id"] == 10
    assert A.best_attributes_by_title(a).first()["number"] == "N"
    assert A.title_canonical(a.limit(0)).isEmpty()


def test_upserts(spark):
    old = rows(spark, [dict(id=1, key="k1", title="A", content="a"), dict(id=2, title="B", content="b")])
    new = rows(spark, [dict(url="https://x/1?sys_kb_id=k1", key="k1", title="A9", content="new"), dict(url="https://x/2", title="B", content="z" * 101), dict(url="https://x/3", title="B", content="short"), dict(url="https://x/4", title="C", content="c")])
    new = new.withColumn("ingest_order", F.monotonically_increasing_id())
    got = {r.id: r for r in A.upsert_articles(old, new).collect()}
    assert set(got) == {1, 2, 3}
    assert got[1].title == "A9" and got[1].content == "new" and got[1].url == "https://h/1"
    assert got[2].url == "https://x/2" and len(got[2].content) == 101 and got[3].title == "C"
    latest = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k int, v string, o int")
    once = A.upsert_latest(latest.limit(0), latest, ["k"], "o")
    assert [tuple(r) for r in A.upsert_latest(once, latest, ["k"], "o").collect()] == [(1, "b", 2)]
    more, links = A.upsert_links(old, spark.createDataFrame([], "source_id int, target_id int"), spark.createDataFrame([(2, "https://z/?sys_kb_id=k1".replace("k1", "ab1")), (2, "https://h/1"), (None, "https://h/1")], "source_id int, target_url string"))
    assert {tuple(r) for r in links.collect()} == {(2, 3), (2, 1)} and more.where("title = 'Pending'").first()["sys_kb_id"] == "ab1"


def test_upsert_by_url(spark):
    old = rows(spark, [dict(id=1, url="https://h/1", title="A", content="a", number="N")])
    new = rows(spark, [dict(url="https://h/1", key="k7", title="Quite another", content="b"), dict(url=None, title="C", content="c"), dict(url=None, title="D", content="d")])
    got = {r.title: r for r in A.upsert_articles(old, new.withColumn("ingest_order", F.monotonically_increasing_id())).collect()}
    # title, content and key are taken, the rest stays; rows that nothing identifies are all added
    assert set(got) == {"Quite another", "C", "D"} and (got["Quite another"].id, got["Quite another"].number, got["Quite another"].sys_kb_id) == (1, "N", "k7")


def test_insert_ignore(spark):
    pairs = lambda x: spark.createDataFrame(x, "topic_id int, article_id int")
    once = A.insert_ignore(pairs([(1, 1)]), pairs([(1, 1), (1, 2), (1, 2), (None, 3)]), ["topic_id", "article_id"])
    assert sorted(map(tuple, once.collect())) == [(1, 1), (1, 2)]
    assert sorted(map(tuple, A.insert_ignore(once, once, ["topic_id", "article_id"]).collect())) == [(1, 1), (1, 2)]


def test_whole_deduplication(spark):
    a = rows(spark, [dict(id=1, key="k1", title="Pending", content="first"), dict(id=2, key="k1", title="A", content="", number=""), dict(id=3, key="k1", title="A2", content="third", number="N3"), dict(id=4, title="A2", content=None, updated=dt.datetime(2025, 1, 1))])
    links = spark.createDataFrame([(1, 4, None), (3, 4, None), (2, 1, None)], "source_id int, target_id int, created_at timestamp_ntz")
    enrichment = spark.createDataFrame([(7, 1), (8, 3), (9, 4)], "id int, article_id int")
    placed = spark.createDataFrame([(5, 2), (5, 3)], "topic_id int, article_id int")
    by_key = A.deduplicated_by_key(a, links, enrichment, placed)
    left = {r.id: r for r in by_key["articles"].collect()}
    assert set(left) == {3, 4} and (left[3].title, left[3].content, left[3].number) == ("A2", "third", "N3")
    assert {tuple(r)[:2] for r in by_key["links"].collect()} == {(3, 4), (3, 3)}
    assert {r.id for r in by_key["article_enrichment"].collect()} == {8, 9} and {r.article_id for r in by_key["topic_articles"].collect()} == {3}
    by_title = A.deduplicated_by_title(a, links, enrichment, placed)
    assert {r.id: r.content for r in by_title["articles"].collect()} == {1: "first", 2: "", 3: "third"}
    assert by_key["articles"].columns == a.columns == by_title["articles"].columns


def test_next_batch(spark):
    a = rows(spark, [dict(id=i, title="t", content="x" if i != 3 else "") for i in range(1, 8)])
    done = spark.createDataFrame([(2,)], "article_id int")
    assert [r.id for r in A.unenriched_batch(a, done, 3).collect()] == [1, 4, 5]


def test_urls(spark):
    cases = [("https://h/kb?id=x&sys_kb_id=AbC123&x=1", "AbC123", "sys_kb_id:AbC123"), ("https://h/kb?sysparm_article=kb0012", "kb0012", "sys_kb_id:kb0012"), ("https://h/a/", None, "https://h/a"), ("https://h/a/#top", None, "https://h/a/"), (None, None, None)]
    df = spark.createDataFrame([(c[0],) for c in cases], "u string")
    assert [tuple(r) for r in df.select("u", kb_id(F.col("u")), normalized_url(F.col("u"))).collect()] == cases


def test_quality(spark):
    df = spark.createDataFrame([("Login", "x", True), ("Login", "x", False), ("Guide", "y" * 99, False), ("Guide", "y" * 100, False), (None, None, False)], "title string, content string, listed boolean")
    assert [r.q for r in df.select(A.quality(listed=F.col("listed")).alias("q")).collect()] == ["skip", "[BROKEN ARTICLE: Login]", "[MINIMAL CONTENT: 99 chars]", "ok", "[MINIMAL CONTENT: 0 chars]"]


def test_reach_and_numbers(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (2, 2), (1, 3), (None, 9)], "source_id int, target_id int")
    seeds = spark.createDataFrame([(1,), (1,), (None,)], "id int")
    assert {tuple(r) for r in C.reach(links, seeds, 2).collect()} == {(1, 0), (2, 1), (3, 1), (4, 2)}
    n = numbered(spark.range(1000).withColumn("x", 1000 - F.col("id")), ["x"], "n", 5)
    assert n.where("n = x + 4").count() == 1000
