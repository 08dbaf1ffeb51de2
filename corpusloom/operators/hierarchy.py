"""Parent-child rows to full hierarchies: level-wise frontier joins from the roots.

Each level is one join of the frontier with the edges. A node is settled once all of its parents are, so a node on a
cycle, or below one, is never settled and is reported as such. The levels are written to the shared folder, so the
plan of a level does not contain those before it and a lost executor costs one level at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import together, written


def clean_edges(
    relationships: DataFrame, nodes: DataFrame, label: str, parent: str, child: str, kind: str, node_id: str
) -> DataFrame:
    """Distinct (parent, child) of the rows whose label is `label` (case and outer spaces aside) and whose ends are both nodes.

    Null ends or labels never match; repeated rows count once; extra columns are ignored.
    """
    known = nodes.select(F.col(node_id).alias("known")).where("known is not null").distinct()
    edges = (
        relationships.where(F.lower(F.trim(F.col(kind))) == label)
        .select(F.col(parent).alias("parent"), F.col(child).alias("child"))
        .distinct()
    )
    return edges.join(known, edges.parent == known.known, "left_semi").join(known, edges.child == known.known, "left_semi")


def _level(reached: DataFrame) -> DataFrame:
    return reached.select(F.col("child").alias("node"), "best.root", F.col("best.col1").alias("depth"), F.col("best.col2").alias("path"))


def hierarchy(edges: DataFrame) -> DataFrame:
    """(node, root, depth, path array) for every end of `edges` (parent, child); -1, -1 and null path on a cycle or below one.

    A node with several parents is settled after the last of them and takes the smallest (depth, path) among them.
    Self-loops are cycles. An empty table gives an empty result.
    """
    edges = written(edges.where("parent is not null and child is not null").distinct(), "edges")
    degree = edges.groupBy("child").agg(F.count("*").alias("parents"))
    nodes = edges.select(F.col("parent").alias("node")).union(edges.select("child")).distinct()
    nodes = written(nodes.join(degree, nodes.node == degree.child, "left").select("node", F.coalesce("parents", F.lit(0)).alias("parents")), "nodes")
    many = nodes.where("parents > 1")
    several = not many.isEmpty()
    frontier = written(
        nodes.where("parents = 0").select("node", F.col("node").alias("root"), F.lit(0).alias("depth"), F.array("node").alias("path")),
        "level",
    )
    # of nodes with several parents, what is written of a level also has those that still wait
    levels, steps, waiting = [frontier], [], None
    counted = edges.join(nodes.select(F.col("node").alias("child"), "parents"), "child") if several else edges.withColumn("parents", F.lit(1))
    counted = written(counted.select("parent", "child", "parents"), "counted")
    while not frontier.isEmpty():
        reached = frontier.join(counted, frontier.node == counted.parent).select(
            "child", "parents", F.lit(1).alias("seen"), F.struct(F.col("depth") + 1, F.concat("path", F.array("child")), "root").alias("best")
        )
        if several:
            if waiting is not None:
                reached = reached.unionByName(waiting)
            reached = written(
                reached.groupBy("child").agg(F.max("parents").alias("parents"), F.sum("seen").cast("int").alias("seen"), F.min("best").alias("best")), "reached"
            )
            steps.append(reached)
            waiting = reached.where("seen < parents")
            reached = reached.where("seen >= parents")
        frontier = _level(reached)
        # where nodes have several parents, the level is written already
        if not several:
            frontier = written(frontier, "level")
            levels.append(frontier)
    settled = together(levels)
    if steps:
        settled = settled.unionByName(_level(together(steps).where("seen >= parents")))
    rest = nodes.join(settled.select("node"), "node", "left_anti").select(
        "node", F.lit(-1).cast(dict(nodes.dtypes)["node"]).alias("root"), F.lit(-1).alias("depth"), F.lit(None).cast(settled.schema["path"].dataType).alias("path")
    )
    return settled.unionByName(rest)


def ancestor_pairs(tree: DataFrame) -> DataFrame:
    """(ancestor, node, distance) of every node of hierarchy(), itself excluded: the descendants of each ancestor, one row each."""
    return tree.where("path is not null").select(
        F.posexplode(F.expr("slice(path, 1, size(path) - 1)")).alias("at", "ancestor"), "node", "depth"
    ).select("ancestor", "node", (F.col("depth") - F.col("at")).alias("distance"))
