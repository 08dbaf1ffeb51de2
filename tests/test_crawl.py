from corpusloom.operators import crawl as C

ARTICLES = [(1, "https://h/?sysparm_article=KB01", "Old portal", "x"), (2, "https://h/?sys_kb_id=aa", "Portal", ""), (3, "https://h/a#x", "Third", None), (4, "https://h/b", "Printer", "y"), (5, "https://h/c", None, None), (6, "https://h/d", "Sixth", None)]
LINKS = [(2, 3), (3, 5), (4, 6), (6, 5), (4, 1), (1, 3), (2, 2)]


def tables(spark):
    return spark.createDataFrame(ARTICLES, "id int, url string, title string, content string"), spark.createDataFrame(LINKS, "source_id int, target_id int")


def test_keywords_go_to_their_own_depths(spark):
    a, links = tables(spark)
    skip = C.legacy_pages(a)
    assert [r.id for r in skip.collect()] == [1]
    config = C.CrawlConfig((("PORTAL", 1), ("printer", 2)), 3)
    met = C.reach_by_keywords(links, a, config, skip)
    assert {(r.id, r.depth) for r in met.collect()} == {(2, 0), (3, 1), (4, 0), (6, 1), (5, 2)}
    assert [(r.id, r.depth) for r in C.next_pages(met, a, config).collect()] == [(2, 0), (3, 1), (6, 1)]
    assert C.reach_by_keywords(links, a, C.CrawlConfig()).isEmpty() and C.reach_by_keywords(links.limit(0), a.limit(0), config).isEmpty()


def test_metadata_by_normalized_url(spark):
    found = spark.createDataFrame([(1, "https://h/a/", "old"), (2, "https://h/a", "new"), (3, None, "none")], "n int, url string, title string")
    meta = C.latest_metadata(found, "n", ["title"])
    pages = spark.createDataFrame([("https://h/a#top",), ("https://h/z",), (None,)], "url string")
    assert {(r.url, r.found_title) for r in C.with_metadata(pages, meta, ["title"]).collect()} == {("https://h/a#top", "new"), ("https://h/z", None), (None, None)}
