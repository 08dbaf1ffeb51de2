"""Names that hold one another, met by rare parts instead of all pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Length of the parts that names are filed under.
GRAM = 3


def _grams(c: str, lengths: str) -> Column:
    """Distinct parts of column `c` of each of the lengths that the SQL expression gives."""
    return F.expr(f"array_distinct(flatten(transform({lengths}, n -> transform(sequence(1, greatest(length({c}) - n + 1, 1)), i -> substring({c}, i, n)))))")


def holding(short: DataFrame, long: DataFrame) -> DataFrame:
    """(a, b) of the pairs of `short` (a, name) and `long` (b, name) whose long name holds the short one, at any place; empty names are held by none.

    Each short name is filed under the rarest of its parts, a name shorter than a part under itself; each long name looks
    under all of its own. So a part that many names have gathers only short names that have no rarer one.
    """
    s = short.where("name <> ''").select("a", F.col("name").alias("short"), F.explode(_grams("name", f"array(least(length(name), {GRAM}))")).alias("gram"))
    t = long.where("name <> ''").select("b", F.col("name").alias("long"), F.explode(_grams("name", f"sequence(1, least(length(name), {GRAM}))")).alias("gram"))
    wanted = s.select("gram").distinct()
    freq = t.join(wanted, "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("df"))
    filed = s.join(freq, "gram", "left").groupBy("a", "short").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram"))["gram"].alias("gram"))
    return t.join(filed, "gram").where(F.contains("long", "short")).select("a", "b").distinct()
