import random

import numpy as np

from corpusloom.llm import neardup as N
from corpusloom.llm.words import WORD


def texts(n=60, seed=2):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(n):
        base = [rng.choice(vocab) for _ in range(rng.randrange(60, 200))]
        out.append(" ".join(base))
        for _ in range(rng.randrange(3)):
            edit = list(base)
            for _ in range(rng.randrange(1, 6)):
                edit[rng.randrange(len(edit))] = rng.choice(vocab)
            out.append(" ".join(edit) if rng.random() < 0.8 else " ".join(base).upper() + " !!")
    return out


def runs(t, k):
    w = WORD.findall((t or "").lower())
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def test_against_brute_force(spark):
    rows = list(enumerate(texts())) + [(900, None), (901, ""), (902, "two words"), (903, "long " * 3 + "word " * 50000), (904, "long " * 3 + "word " * 50000)]
    df = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "id int, text string, node int, bands int")
    for run, threshold in ((3, 0.5), (5, 0.8)):
        s = N.sketches(df, run).cache()
        got = {tuple(r) for r in N.expand(N.similar_nodes(s, threshold), s).collect()}
        sets = {i: runs(t, run) for i, t in rows}
        want = {(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])}
        assert len(want) > 20 and got == want
    classes = {r.id: r for r in N.classes(s, 0.8).collect()}
    assert classes[904].class_id == 903 and set(classes) == {i for i in sets if sets[i]}
    assert all(classes[j].class_id == classes[i].class_id for i, j in want)


def test_runs_are_distinct_and_sorted_without_hashing(monkeypatch):
    rows = [t or "" for t in texts()] + ["", "one", "a b c a b c a b c"]
    monkeypatch.setattr(np, "unique", None)  # hashes every value before it sorts, a third of the CPU time of a sketch
    h, d, _ = N.Sketcher(3).runs(rows)
    assert np.bincount(d, minlength=len(rows)).tolist() == [len(runs(t, 3)) for t in rows]
    assert sorted(zip(d.tolist(), h.tolist())) == list(zip(d.tolist(), h.tolist()))


def test_empty(spark):
    df = spark.createDataFrame([], "id bigint, text string")
    s = N.sketches(df)
    assert s.isEmpty() and N.similar_nodes(s, 0.5).isEmpty() and N.classes(s).isEmpty()


def test_hot_group(spark):
    base = [f"v{i}" for i in range(80)]
    rows = [(i, " ".join([*base, f"x{i}"])) for i in range(40)]
    s = N.sketches(spark.createDataFrame(rows, "id int, text string"))
    assert N.star_edges(s).count() <= 39 * 3 and len({r.class_id for r in N.classes(s).collect()}) == 1


def test_copies_meet_buckets_once(spark):
    rows = [(i, "one two three four five six seven eight nine ten") for i in range(500)] + [(1000, "one two three four five six seven eight nine ten eleven")]
    s = N.sketches(spark.createDataFrame(rows, "id int, text string"))
    assert N.met(s).groupBy("bucket").count().where("count > 1").isEmpty()
    got = {r.id: (r.class_id, r.links) for r in N.classes(s).collect()}
    assert len(got) == 501 and {v for i, v in got.items() if i < 1000} == {(0, 1)} and got[1000] == (0, 1)


def test_buckets_are_shuffled_packed(spark):
    # 90 nodes, each in a bucket of its own and in one that all share; the shuffle has no row for each of them
    s = sketched(spark, {k: range(k, k + 3) for k in range(90)})
    met = N.met(s)
    assert {tuple(r) for r in met.collect()} == {(7, 0, k) for k in range(1, 90)}
    # rows were shuffled by bucket and sorted in the JVM, one for each node and band
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(part" in plan and "Generate" not in plan


def test_recall_on_chains_of_edits(spark):
    """Chains in which neighbours are similar and ends are not: pairs found against brute force, for both uses."""
    rng = random.Random(9)
    rows = []
    for c in range(25):
        words = [f"c{c}v{i}" for i in range(150)]
        for _ in range(14):
            rows.append((len(rows), " ".join(words)))
            for _ in range(2):
                words[rng.randrange(150)] = f"n{rng.random()}"
    df = spark.createDataFrame(rows, "id int, text string")
    for run, threshold in ((3, 0.5), (5, 0.8)):
        sets = {i: runs(t, run) for i, t in rows}
        close = {(i, j) for i in sets for j in range(i + 1, min(i + 14, len(rows))) if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])}
        s = N.sketches(df, run)
        got = {tuple(r) for r in N.expand(N.similar_nodes(s, threshold), s).collect()}
        assert got <= close and len(got) >= 0.99 * len(close) > 200
    links = {r.id: r.links for r in N.classes(s, 0.8).collect()}
    assert sum(links.values()) >= 0.99 * 2 * len(close)


def test_large_component_in_blocks(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"v{i}" for i in range(120)]
    rows = []
    for i in range(150):
        edit = list(base)
        for k in range(rng.randrange(1, 5)):
            edit[rng.randrange(len(edit))] = f"x{i}y{k}"
        rows.append((i, " ".join(edit)))
    monkeypatch.setattr(N, "BLOCK_RUNS", 3000)
    s = N.sketches(spark.createDataFrame(rows, "id int, text string")).cache()
    sets = {i: runs(t, 5) for i, t in rows}
    want = {(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.5 * len(sets[i] | sets[j])}
    pairs = N.similar_nodes(s, 0.5)
    assert {tuple(r) for r in N.expand(pairs, s).collect()} == want and pairs.count() == len(want)
    links = {i: sum(i in p for p in want) for i in sets}
    assert {r.id: r.links for r in N.classes(s, 0.5).collect()} == links and len(set(links.values())) > 1


def test_proved_pairs_are_not_compared(spark, monkeypatch):
    base = [f"v{i}" for i in range(400)]
    rows = [(i, " ".join([*base, f"x{i}"])) for i in range(3000)]
    seen = []

    def spy(members, grams, threshold, bound=-1, counts=False):
        seen.append(members.where(f"2 * far > {bound}").count())
        return made(members, grams, threshold, bound, counts)

    made = N.block_pairs
    monkeypatch.setattr(N, "block_pairs", spy)
    s = N.sketches(spark.createDataFrame(rows, "id int, text string"))
    got = N.classes(s).collect()
    assert len(got) == 3000 and {(r.class_id, r.links) for r in got} == {(0, 2999)} and seen == [0]


def sketched(spark, sets):
    rows = [(node, node, len(g), [7, 1000 + node], sorted(g)) for node, g in sets.items()]
    return spark.createDataFrame(rows, "id bigint, node bigint, n int, bands array<int>, grams array<int>")


def test_pairs_whose_bucket_has_an_unlike_first_text(spark, monkeypatch):
    # node 1 is first of the one bucket and similar to none; 2 and 3 are, 4 is similar to 3 only, the others are alone
    sets = {1: range(0, 20), 2: range(10, 40), 3: range(14, 46), 4: range(22, 56)} | {k: [*range(5), *range(100 * k, 100 * k + 20)] for k in range(5, 90)}
    sets = {k: set(v) for k, v in sets.items()}
    want = {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.5 * len(sets[a] | sets[b])}
    assert want == {(2, 3), (3, 4)}
    for part in ({k: sets[k] for k in range(1, 9)}, sets):
        s = sketched(spark, part)
        assert {(r.a, r.b) for r in N.similar_nodes(s, 0.5).collect()} == want
    monkeypatch.setattr(N, "BLOCK_RUNS", 200)
    got = {r.id: (r.class_id, r.links) for r in N.classes(s, 0.5).collect()}
    assert {k: v for k, v in got.items() if v != (k, 0)} == {2: (2, 1), 3: (2, 2), 4: (2, 1)}


def test_every_article_takes_part_and_sketches_are_off_the_disk_after(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    pages = [[" ".join(word() for _ in range(10)).capitalize() + "." for _ in range(8)] for _ in range(30)]
    # a page and its copy, far from each other in the table; one word of the last line differs
    rows = [(i, f"https://h{i % 7}.example/{word()}", f"On {word()} and {word()}", "\n".join([*p[:-1], p[-1][:-1] + f" {word()}."])) for i, p in enumerate(pages * 2)]
    got = N.similar_articles(spark.createDataFrame(rows, "id int, url string, title string, content string"))
    assert {tuple(r) for r in got.collect()} == {(i, i + 30) for i in range(30)}
    assert not [f for f in got.inputFiles() if "/sketches-" in f or "/units-" in f]
