import random

from corpusloom.operators.names import holding


def test_against_all_pairs(spark):
    rng = random.Random(4)
    name = lambda n: "".join(rng.choice("ab c") for _ in range(n))
    short = [(i, name(rng.randrange(0, 6))) for i in range(60)] + [(100, None), (101, "")]
    long = [(i, name(rng.randrange(0, 14))) for i in range(60)] + [(100, None), (101, "x" * 50_000 + "abc")]
    got = {(r.a, r.b) for r in holding(spark.createDataFrame(short, "a int, name string"), spark.createDataFrame(long, "b int, name string")).collect()}
    assert got == {(a, b) for a, s in short for b, t in long if s and t and s in t}
    empty = spark.createDataFrame([], "a int, name string")
    assert holding(empty, spark.createDataFrame(long, "b int, name string")).isEmpty()
