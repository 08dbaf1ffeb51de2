import os
from types import SimpleNamespace

import pytest

import __spark_entry__
from corpusloom import session

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_entry_runs(spark):
    rows = __spark_entry__.entry(spark)
    assert rows.columns == ["topic_id", "root_id", "depth", "path"] and rows.count() > 0


def unset(master):
    conf = SimpleNamespace(get=lambda name, default=None: default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master, applicationId="app-" + master))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "k8s://https://host", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(unset(master))


def test_local_mode_has_a_folder_of_its_own():
    assert session.shared_folder(unset("local[2]")).startswith("file://")


def test_written_tables_are_deleted(spark):
    other = spark.newSession()
    table = session.written(other.range(3), "three")
    path = table.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and table.count() == 3
    os.makedirs(os.path.join(session._written_folder(other).removeprefix("file://"), "x"), exist_ok=True)
    session.delete_written(other)
    assert not os.path.exists(path)


def test_broadcasts_are_size_checked(spark):
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(session.broadcast_if_small(spark.range(3), 3))
    assert not hinted(session.broadcast_if_small(spark.range(4), 3))


def test_import_needs_no_session():
    """The entry module is imported before a session exists."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = "import __spark_entry__ as e; q = e.queries(); assert set(e.oracle_sql()) <= set(q); assert 'p7_found' in q; e.entry"
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, timeout=120).returncode == 0


def test_buckets_are_read_without_a_shuffle_and_tables_deleted_by_name(spark):
    rows = spark.range(200).selectExpr("id % 50 as k", "id as v")
    kept, by = session.written(rows, "kept"), session.written_by(rows, "by", "k")
    both = by.hint("merge").join(spark.range(50).withColumnRenamed("id", "k"), "k")
    assert both._jdf.queryExecution().toString().split("== Physical Plan ==")[1].count("Exchange") == 1 and both.count() == 200
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("by_")]
    folder = by.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    assert os.path.exists(folder)
    session.delete_frame(by)
    assert not os.path.exists(folder) and kept.count() == 200
