from corpusloom.sources.exports import read_csv, write_csv
from corpusloom.sources.schemas import SCHEMAS, conformed


def test_round_trip(spark, tmp_path):
    rows = [(1, ' A "quoted", name ', "a", 3, 0, 0, 0, {"how-to": 2, 'x "y"': 1}, {}, None), (2, "line\nbreak \\n kept", "b", None, None, None, None, None, None, None), (3, "", None, 1, 1, 1, 1, {}, {}, {"é": 5})]
    ddl = "id int, name string, normalized_name string, total_articles int, indegree int, outdegree int, prerequisite_count int, intent_distribution map<string,bigint>, complexity_distribution map<string,bigint>, audience_distribution map<string,bigint>"
    topics = conformed(spark.createDataFrame(rows, ddl), "topics")
    assert topics.columns == SCHEMAS["topics"].fieldNames()
    path = str(tmp_path / "topics")
    write_csv(topics, path)
    back = read_csv(spark, path, "topics")
    assert back.schema.simpleString() == topics.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, topics.collect()))


def test_exported_file(spark, tmp_path):
    """A file as a database writes it: quotes doubled, maps as JSON, other names of columns."""
    (tmp_path / "t.csv").write_text('id,topic_name,normalized_name,total_articles,indegree,outdegree,prerequisite_count,intent_distribution,complexity_distribution,audience_distribution,created_at,updated_at\n7,"Mail, new",Mail,4,0,1,2,"{""how-to"": 3, ""policy"": 1}",{},,2025-01-02T03:04:05,\n')
    r = read_csv(spark, str(tmp_path), "topics", escaped=False, rename={"name": "topic_name"}).first()
    assert (r.id, r.name, r.total_articles, r.intent_distribution, r.complexity_distribution, r.audience_distribution) == (7, "Mail, new", 4, {"how-to": 3, "policy": 1}, {}, None)
    assert str(r.created_at) == "2025-01-02 03:04:05" and r.updated_at is None


def test_conformed(spark):
    df = conformed(spark.createDataFrame([("5", "x")], "id string, other string"), "links")
    assert df.columns == ["source_id", "target_id", "created_at"] and df.first().source_id is None
