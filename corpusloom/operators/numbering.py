"""Consecutive numbers over a total order, without one task that sees every row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import written


def numbered(df: DataFrame, order: list[Column | str], name: str, start: int = 1, kind: str = "int") -> DataFrame:
    """`df` with column `name` of type `kind`, counting from `start` in the order given, which must leave no ties.

    A number beyond the range of `kind` raises.

    Rows are range-partitioned by the order; each part is numbered by itself and shifted by the sizes of those before it.
    """
    if df.isEmpty():
        return df.withColumn(name, F.lit(None).cast(kind))
    parts = written(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    sizes = parts.groupBy("_part").count().orderBy("_part").collect()  # one row a partition
    shift, at = [], start - 1
    for r in sizes:
        shift += [F.lit(r["_part"]), F.lit(at).cast("bigint")]
        at += r["count"]
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.withColumn(name, (within + F.element_at(F.create_map(*shift), F.col("_part"))).cast(kind)).drop("_part")
