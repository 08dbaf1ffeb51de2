from corpusloom.operators import reports as RP
from corpusloom.operators import structure as S

TOPICS = [(1, "Unix", 120, 0), (2, "Unix Shell", 9, 0), (3, "Mail", 60, 0), (4, "Unix Disk", 4, 0), (5, "Backup", 2, 0), (6, None, 1, 0)]


def topics(spark):
    rows = [(i, n, t, 0, p, {"how-to": 3, "policy": 3} if i == 3 else {"how-to": t}) for i, n, t, p in TOPICS]
    return spark.createDataFrame(rows, "id int, normalized_name string, total_articles int, indegree int, prerequisite_count int, intent_distribution map<string,bigint>")


def edges(spark):
    return spark.createDataFrame([(2, 1, "subtopic_of"), (4, 1, "subtopic_of"), (1, 2, "subtopic_of"), (5, 4, "subtopic_of"), (3, 3, "related_to")], "source_id int, target_id int, relation string")


def test_issues(spark):
    got = {(r.topic_id, r.issue, r.severity) for r in S.issues(edges(spark), topics(spark)).collect()}
    assert got == {(6, "orphan", "medium"), (1, "overloaded", "high"), (3, "overloaded", "medium"), (3, "mixed_intent", "low")}
    assert S.issues(edges(spark).limit(0), topics(spark).limit(0)).isEmpty()
    lines = {r.topic_id: r.json for r in RP.issues_json(S.issues(edges(spark), topics(spark))).collect()}
    assert lines[6] == '{"topic_id":6,"issues":[{"issue":"orphan","severity":"medium"}]}'


def test_auto_sidebar(spark):
    e, t = edges(spark), topics(spark)
    down = e.where("relation = 'subtopic_of'").selectExpr("target_id as source_id", "source_id as target_id", "relation").unionByName(e.where("relation <> 'subtopic_of'"))
    # the same trees, whichever end of an edge is the parent
    for frame, first in ((e, False), (down, True)):
        got = {r.topic_id: (r.parent_id, r.root_id, r.depth, r.article_count) for r in S.auto_sidebar(frame, t, roots=1, parent_first=first).collect()}
        assert got == {1: (None, 1, 0, 135), 2: (1, 1, 1, 9), 4: (1, 1, 1, 6), 5: (4, 1, 2, 2)}
        assert {r.topic_id for r in S.auto_sidebar(frame, t, roots=1, fan_out=1, parent_first=first).collect()} == {1, 2}
    assert S.auto_sidebar(e.limit(0), t.limit(0)).isEmpty()
    counts = {r.root_id: (r.nodes, r.deepest) for r in S.tree_counts(S.auto_sidebar(down, t, roots=1)).collect()}
    assert counts == {1: (4, 2), None: (4, 2)}


def test_a_topic_stands_where_the_walk_meets_it_first(spark):
    """2 is a child of 1 and of 1's first child 3, so the walk meets it below 3; the root 4 was met before its turn."""
    rows = [(1, "a", 50, 9, 0), (2, "b", 5, 0, 0), (3, "c", 30, 0, 0), (4, "d", 20, 0, 0)]
    t = spark.createDataFrame([(*r, {"x": 1}) for r in rows], "id int, normalized_name string, total_articles int, indegree int, prerequisite_count int, intent_distribution map<string,bigint>")
    e = spark.createDataFrame([(1, 2, "subtopic_of"), (1, 3, "subtopic_of"), (3, 2, "subtopic_of"), (3, 4, "subtopic_of"), (2, 4, "subtopic_of")], "source_id int, target_id int, relation string")
    got = {r.topic_id: (r.parent_id, r.depth) for r in S.auto_sidebar(e, t, roots=4).collect()}
    assert got == {1: (None, 0), 3: (1, 1), 4: (3, 2), 2: (3, 2)}


def test_match_and_report(spark):
    built = topics(spark).where("normalized_name is not null").selectExpr("id as topic_id", "normalized_name", "total_articles")
    entries = spark.createDataFrame([("A", "unix"), ("A", "Shell"), ("B", "Unix Disk Quotas"), ("B", "Nothing")], "category string, entry string")
    got = {(r.entry, r.topic_id, r.kind) for r in S.topic_match(entries, built).collect()}
    assert got == {("unix", 1, "exact"), ("Shell", 2, "fuzzy"), ("Unix Disk Quotas", 1, "fuzzy")}
    whole = S.sidebar(entries, built, spark.createDataFrame([("B", 7), ("A", 3)], "category string, articles bigint"))
    assert [(r.entry, r.topic_id, r.article_count) for r in whole.where("category = 'B'").orderBy("place").collect()] == [("Unix Disk Quotas", 1, 120), ("Nothing", None, 7)]
    print_ = spark.createDataFrame([("A", "Print")], "category string, entry string")
    assert S.topic_match(print_, spark.createDataFrame([(9, "Printing", 1)], "topic_id int, normalized_name string, total_articles int")).first().topic_id == 9
    side = S.sidebar(entries, built)
    assert [(r.entry, r.place) for r in side.where("category = 'A'").orderBy("place").collect()] == [("unix", 1), ("Shell", 2)]
    text = [r.line for r in RP.markdown(topics(spark), S.issues(edges(spark), topics(spark)), side).orderBy("section", "place").collect()]
    assert text[0].startswith("# Report\n\n6 topics, 196 articles") and "* Mail: how-to 3, policy 3" in text


def test_keywords(spark):
    words = spark.createDataFrame([("A", "unix"), ("A", "mail"), ("B", "x"), (None, "unix"), ("C", "")], "category string, keyword string")
    arts = spark.createDataFrame([(1, "Unix mail"), (2, None), (3, "other")], "id int, title string")
    assert {tuple(r) for r in S.keyword_articles(words, arts).collect()} == {("A", 1), ("B", 1)}
    assert {tuple(r) for r in S.keyword_articles(words, arts, most=1).collect()} == {("A", 1), ("B", 1)}  # the way beyond the bound
    placed = spark.createDataFrame([(5, 1), (6, 1)], "topic_id int, article_id int")
    assert {tuple(r) for r in S.keyword_counts(words, arts, placed).collect()} == {("A", 1), ("B", 1)}
    assert S.keyword_articles(words.limit(0), arts).isEmpty()
