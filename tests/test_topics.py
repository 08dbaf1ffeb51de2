import pytest
from pyspark.sql import functions as F

from corpusloom.functions.topics import fallback_category, normalized_topic
from corpusloom.operators import topics as T

NAMES = [
    ("3D Printing", "3d Printing", "General"), ("Academic Planning", "Academic Planning", "Student Services"), ("Supercomputer Access", "Supercomputer", "Computing"),
    ("Network Configuration", "Network", "Infrastructure"), ("Data Backup", "Data", "Data Management"), ("Google Drive Storage", "Google Drive", "Google Workspace"),
    ("Student Email", "Student Email", "Communication"), ("Troubleshooting Guide", "Troubleshooting", "It Support"), ("Canvas LMS", "Canvas Lms", "Canvas"),
    ("Database Administration", "Database", "Data Management"), ("", "General", "General"), (None, "General", "General"), ("Zoom", "Video Conferencing", "Video Conferencing"),
    ("Managing Two-Step Login", "Authentication", "Authentication"), ("Using My Drive", "My Drive", "Storage"), ("Active Directory Services (ADS)", "Active Directory Services", "General"),
    ("SSL Certificate Policy", "Ssl Certificate", "Security"), ("Setup", "Setup", "General"), ("C++ Compiler Tools", "C++ Compiler", "Development"), ("  Exchange   Email  ", "Email", "Communication"),
]


def test_names(spark):
    df = spark.createDataFrame([(i, n[0]) for i, n in enumerate(NAMES)], "i int, raw string").select("i", normalized_topic(F.col("raw")).alias("n"))
    got = {r.i: (r.n, r.f) for r in df.select("i", "n", fallback_category(F.col("n")).alias("f")).collect()}
    assert [got[i] for i in range(len(NAMES))] == [n[1:] for n in NAMES]


ROWS = [(1, 101, "Unix"), (2, 102, "Unix Setup"), (3, 103, "Disk Quotas"), (4, 104, "Storage"), (5, 105, "Top Hat")]


@pytest.mark.parametrize("strict", [False, True])
def test_build(spark, strict):
    e = spark.createDataFrame([(*r, "how-to", None, "") for r in ROWS], "id int, article_id int, canonical_topic string, intent string, complexity string, audience string")
    rows = T.assigned(e, strict=strict)
    built = {r.normalized_name: (r.name, r.total_articles) for r in T.build_topics(rows).collect()}
    assert built["Unix"] == ("Unix", 2) and built["Storage"] == ("Storage", 1)
    assert built["General"] == ("General", 2 if strict else 1)  # article 104 is lost unless strict
    assert {(r.dimension, r.n) for r in T.distributions(rows).where("topic = 'Unix'").collect()} == {("intent", 2)}


def test_links(spark):
    links = [(i, 100 + i) for i in range(4)] + [(110 + i, 10 + i) for i in range(3)] + [(0, 200), (1, 200)]
    where = [(1, i) for i in range(20)] + [(2, i) for i in range(100, 120)] + [(3, 200), (3, 200)]
    a, b = spark.createDataFrame(links, "source_id int, target_id int"), spark.createDataFrame(where, "topic_id int, article_id int")
    assert [tuple(r) for r in T.link_pattern_edges(a, b).collect()] == [(1, 2, 0.4, 4)]
    known = spark.createDataFrame([(2, 1)], "source_id int, target_id int")
    assert T.link_pattern_edges(a, b, known).isEmpty()


def test_subsets_and_cosine(spark):
    t = spark.createDataFrame([(1, "Unix"), (2, "Unix Shell"), (3, "shell unix tools"), (4, ""), (5, None), (6, "Unix")], "id int, normalized_name string")
    assert {(r.source_id, r.target_id) for r in T.subtopic_edges(t).collect()} == {(1, 2), (1, 3), (2, 3)}
    maps = spark.createDataFrame([({"a": 1, "b": 1}, {"a": 1}), ({}, {"a": 1}), (None, {"a": 2})], "x map<string,bigint>, y map<string,bigint>")
    assert [round(r.c, 4) for r in maps.select(T.cosine(F.col("x"), F.col("y")).alias("c")).collect()] == [0.7071, 0.0, 0.0]


def test_profiles_are_searched_among_all_pairs(spark, monkeypatch):
    from corpusloom.operators import topics as T

    m = "map<string,bigint>"
    rows = [(1, {"a": 1}, {"x": 2}, {"s": 1}), (2, {"a": 3}, {"x": 1}, {"s": 2}), (3, {"a": 1}, {"x": 2}, {"s": 1}), (4, {"b": 1}, {"x": 2}, {"s": 1}), (5, None, {}, None), (6, {"a": 1}, {"y": 1}, {"s": 9})]
    topics = spark.createDataFrame(rows, f"id int, audience_distribution {m}, intent_distribution {m}, complexity_distribution {m}")
    edges = spark.createDataFrame([(3, 2)], "source_id int, target_id int")
    every = {(1, 2): 1.0, (1, 3): 1.0, (1, 6): 0.7, (2, 6): 0.7, (3, 6): 0.7, (2, 3): 1.0}
    both = lambda pairs: {**pairs, **{(b, a): v for (a, b), v in pairs.items()}}
    ask = lambda df: {(r.source_id, r.target_id): round(r.similarity, 6) for r in df.collect()}
    for block in (5000, 1):
        monkeypatch.setattr(T, "PROFILE_BLOCK", block)
        assert ask(T.similar_profiles(topics, topics)) == both(every)
        assert ask(T.similar_profiles(topics, topics.where("id = 2"))) == {(2, 1): 1.0, (2, 3): 1.0, (2, 6): 0.7}
        assert ask(T.related_by_profile(topics, edges, topics)) == {k: v for k, v in both(every).items() if set(k) != {2, 3}}
    assert T.similar_profiles(topics.limit(0), topics.limit(0)).isEmpty()


def test_merges(spark):
    rows = [(1, "Print", 9), (2, "Network Storage", 9), (3, "printing", 1), (4, "Storage Quotas Disk", 1), (5, "network storage area", 2), (6, "Zebra Crossing", 1), (7, "zebra", 1), (8, "Zebra Crossing Lights", 1), (9, "lonely", 1), (10, "", 1), (11, None, 1), (12, "Disk Storage", 9)]
    t = spark.createDataFrame(rows, "id int, normalized_name string, total_articles int")
    got = {(r.topic_id, r.target_id, r.score) for r in T.suggest_merges(t).collect()}
    # 3 holds 1 without a common word; 4 shares two of its three words with 12; 5 holds 2; 6, 7 and 8 have no larger topic
    assert got == {(3, 1, 10), (4, 12, 5), (5, 2, 10), (6, 8, 1), (7, 8, 1)}
    assert T.suggest_merges(t.limit(0)).isEmpty()


def test_organisation_is_a_parameter(spark):
    df = spark.createDataFrame([("Mail at Norwick College",), ("Norwick Mail",)], "raw string")
    assert [r.n for r in df.select(normalized_topic(F.col("raw"), organisation=("norwick college", "norwick")).alias("n")).collect()] == ["Mail", "Mail"]
    assert [r.n for r in df.select(normalized_topic(F.col("raw")).alias("n")).collect()] == ["Mail At Norwick College", "Norwick Mail"]


def test_graph_of_built_topics(spark):
    e = spark.createDataFrame([(i, i, "Disk" if i % 2 else "Disk Quotas", ["Disk"], "how-to", "", "") for i in range(8)], "id int, article_id int, canonical_topic string, prerequisites array<string>, intent string, complexity string, audience string")
    rows = T.assigned(e)
    built = T.build_topics(rows)
    t = built.withColumnRenamed("topic_id", "id")
    ids = {r.normalized_name: r.topic_id for r in built.collect()}
    placed = T.placed_articles(rows, built)
    assert placed.count() == 8
    pre = {(r.source_id, r.target_id, r.mentions) for r in T.prerequisite_edges(e, t).collect()}
    assert pre == {(ids["Disk"], ids["Disk"], 4), (ids["Disk"], ids["Disk Quotas"], 4)}
