import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusloom.llm import packing as P


def least_containers(sizes, capacity):
    best = [len(sizes)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rooms)
            return
        for k in {r: n for n, r in enumerate(rooms)}.values():
            if rooms[k] >= sizes[i]:
                go(i + 1, rooms[:k] + [rooms[k] - sizes[i]] + rooms[k + 1 :])
        go(i + 1, [*rooms, capacity - sizes[i]])

    go(0, [])
    return best[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_reduction_keeps_the_optimum(sizes):
    left = P.Sizes(Counter(sizes))
    fixed = P.reduce(left, 20)
    assert all(sum(b) <= 20 for b in fixed)
    rest = sorted((s for s, n in left.n.items() for _ in range(n)), reverse=True)
    assert len(fixed) + (least_containers(rest, 20) if rest else 0) == least_containers(sorted(sizes, reverse=True), 20)
    boxes = P.pack(Counter(sizes), 20)
    assert Counter(s for b in boxes for s in b) == Counter(sizes) and max(map(sum, boxes)) <= 20


def test_waste_is_small():
    rng = random.Random(1)
    sizes = [rng.randrange(30, 900) for _ in range(5000)]
    boxes = P.pack(Counter(sizes), 2048)
    assert len(boxes) <= -(-sum(sizes) // 2048) * 1.01


def test_texts(spark):
    rows = [(1, 5, 0), (2, 10, 0), (3, 25, 0), (4, None, 0), (5, 0, 0), (6, 5, 0), (6, 5, 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, n_tokens int, container int")
    limits = spark.createDataFrame([(1, 10), (2, 100), (3, None), (4, 0)], "limit_id int, capacity int")
    got = P.pack_texts(docs, limits).collect()
    fill = Counter()
    for r in got:
        fill[r.limit_id, r.container] += r.tokens
    assert all(v <= {1: 10, 2: 100}[k] for (k, _), v in fill.items()) and len([k for k in fill if k[0] == 1]) == 5
    for k in (1, 2):
        assert Counter((r.doc_id, r.tokens) for r in got if r.limit_id == k) == Counter({1: [(1, 5), (2, 10), (3, 10), (3, 10), (3, 5), (6, 5), (6, 5)], 2: [(1, 5), (2, 10), (3, 25), (6, 5), (6, 5)]}[k])
    assert P.pack_texts(docs.limit(0), limits).isEmpty() and P.pack_texts(docs, limits.limit(0)).isEmpty()


def test_any_number_of_capacities(spark):
    docs = spark.createDataFrame([(1, 5), (2, 10)], "doc_id bigint, n_tokens int")
    limits = spark.range(1500).selectExpr("cast(id as int) limit_id", "cast(20 + id as int) capacity")
    got = P.pack_texts(docs, limits).groupBy("limit_id").count().collect()
    assert len(got) == 1500 and all(r["count"] == 2 for r in got)
