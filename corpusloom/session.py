"""Session helpers: the shared folder, written intermediate tables, package shipping, size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its measured size is below this bound; else Spark shuffles both sides.
BROADCAST_ROWS = 200_000

_own_folder: dict[str, str] = {}
_shipped: set[str] = set()


def is_local(master: str) -> bool:
    """True where driver and executors are one process, so that a folder of this machine is a shared one."""
    return master == "local" or master.startswith("local[")


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where the session names none, a temporary one in local mode, an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not is_local(spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_folder:
        _own_folder[app] = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
    return _own_folder[app]


def _written_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/corpusloom/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a parquet table in the shared folder: cuts the lineage and survives the loss of an executor."""
    spark = df.sparkSession
    path = f"{_written_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, name: str, key: str) -> DataFrame:
    """`df` as written(), in as many buckets by `key` as a shuffle has partitions: joins on `key` read it without shuffling it again."""
    spark, made = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    # the catalog's entry is dropped at once, as the frame has what it says; the files have a path of their own and stay
    df.write.option("compression", "zstd").option("path", f"{_written_folder(spark)}/{made}").bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).sortBy(key).saveAsTable(made)
    out = spark.table(made)
    spark.sql(f"drop table {made}")
    return out


def together(frames: list[DataFrame]) -> DataFrame:
    """The rows of frames of one schema that written() made, as one table: one scan in few tasks, where a union has a scan and a task for each."""
    folders = dict.fromkeys(x.rpartition("/")[0] for df in frames for x in df.inputFiles())
    return frames[0].sparkSession.read.schema(frames[0].schema).parquet(*folders)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def delete_frame(df: DataFrame) -> None:
    """Delete the table that written() made for `df`, which was read for the last time; other folders are let alone."""
    name = _written_folder(df.sparkSession).rpartition("/corpusloom/")[2]
    for folder in {x.rpartition("/")[0] for x in df.inputFiles()}:
        if f"/corpusloom/{name}/" in folder:
            _delete(df.sparkSession, folder)


def delete_written(spark: SparkSession) -> None:
    """Delete the tables that this application has written; frames made from them can't be read any more."""
    _delete(spark, _written_folder(spark))


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors of a cluster, once per application, for functions that run in Python workers."""
    sc = spark.sparkContext
    if is_local(sc.master) or sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="corpusloom-"), "corpusloom_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("corpusloom", os.path.relpath(full, root)))
    sc.addPyFile(target)
    _shipped.add(sc.applicationId)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS, name: str = "side") -> DataFrame:
    """`df`, written once, with a broadcast hint if it has at most `rows` narrow rows; without one beyond."""
    side = written(df, name)
    return F.broadcast(side) if side.count() <= rows else side
