import itertools

import numpy as np
import pytest

from corpusloom.llm import boilerplate as B

# Furniture and articles of an invented site; none of these words is in the library.
CRUMBS = ["This hall keeps {} crumbs and counts them for you. Fine by me", "We scatter {} crumbs so that the doors know you."]
PAIRS = ["tiny", "warm", "stale", "sweet"]
ROOMS = ["Larder", "Attic", "Cellar", "Porch", "Pantry", "Stable", "Orchard", "Mill"]
WORDS = "boat oar rope sail mast keel hull deck net hook line buoy tide quay pier rudder anchor winch lamp chart".split()
VERBS = "lift drop fold mend wash paint carry count open close".split()


def page(rng, k):
    """A page as (title, lines, truth) with furniture of its host, and the article's own title as its first heading."""
    w = lambda: str(rng.choice(WORDS))
    v = lambda: str(rng.choice(VERBS))
    title = f"How to {v()} the {w()} {w()} of {w()} {k}{chr(97 + k % 26)}"
    host = k % 7
    rooms = [ROOMS[(host + i) % 8] for i in range(5)]
    lines = [(" · ".join(rooms) if host % 2 else "\n".join(rooms), 0), (f"{rooms[0]} > {rooms[1]} > {title}", 0), (title, 1)]
    if rng.random() < 0.6:
        lines.insert(int(rng.integers(0, 2)), (CRUMBS[host % 2].format(rng.choice(PAIRS)), 0))
    for part in range(int(rng.integers(1, 4))):
        if part:
            lines.append((str(rng.choice(["What you need", "In the rain", "Afterwards"])), 1))
        for _ in range(int(rng.integers(2, 5))):
            mark = str(rng.choice(["", "- ", "Step 1: "]))
            lines.append((f"{mark}{v().capitalize()} the {w()} before the {w()} of the {w()} {v()}s {k} times and the {w()} {w()} {v()}s.", 1))
        if rng.random() < 0.4:
            lines.append((str(rng.choice(["Whistle to the keeper", "Fold this leaf"])), 0))
    lines += [("Doors nearby", 0)] + [(f"How to {v()} a {w()} {w()} {int(rng.integers(0, 9999))}{chr(97 + k % 26)}", 0) for _ in range(3)]
    lines += [(f"{int(rng.integers(1, 999))} footprints", 0), (f"Hall of {rooms[0]} | Lost keys | House rules", 0)]
    flat = [(x, y) for text, y in lines for x in text.split("\n")]
    return title, [x for x, _ in flat], [y for _, y in flat]


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(3)
    return [page(rng, k) for k in range(700)]


def frame(spark, pages, start=0):
    rows = [(start + i, f"https://h{i % 7}.example/{i}", t, "\n".join(x), 7) for i, (t, x, _) in enumerate(pages)]
    return spark.createDataFrame(rows, "id int, url string, title string, content string, line_no int")


@pytest.fixture(scope="module")
def model(spark, corpus):
    return B.fit(frame(spark, corpus), pages=200)


def test_marginals_are_exact():
    rng = np.random.default_rng(1)
    m = B.Model()
    for a in m.arrays():
        a[...] = rng.normal(size=a.shape)
    kinds = np.array([B.LEAD, B.SENTENCE, B.LEAD, B.TITLE, B.LEAD, B.SENTENCE, B.PARTS])
    b = B.Batch(kinds, np.array([0, 5, 7]), np.zeros(7, dtype=int))
    own = rng.normal(size=7)
    got, pair = B.marginals(m, b, own, edges=True)
    unary = B._score(m, b, own)
    weight = np.zeros(7)
    total = np.zeros(2)
    for page_no, nodes in enumerate((range(5), range(5, 7))):
        for ys in itertools.product((0, 1), repeat=len(nodes)):
            y = dict(zip(nodes, ys))
            s = sum(unary[i] * y[i] + m.edge[kinds[i], b.parent_kind[i], b.distance[i], y[b.parent[i]] if b.parent[i] >= 0 else 0, y[i]] for i in nodes)
            total[page_no] += np.exp(s)
            for i in nodes:
                weight[i] += np.exp(s) * y[i]
    expect = weight / total[[0] * 5 + [1] * 2]
    assert np.allclose(got, expect) and np.allclose(pair.sum(axis=(1, 2)), 1)


def test_labelled_nodes_need_not_cover_a_page():
    """The gradient of the log-likelihood with hidden labels against a finite difference."""
    pages, titles = ["A b c d e.\nMenu\nWho is it now."], [None]
    lines, starts, titled = B.split_pages(pages, titles)
    kinds = np.array([B.kind_of(x) for x in lines[0]])
    b = B.Batch(kinds, starts, titled)
    rng = np.random.default_rng(2)
    m = B.Model()
    m.edge[...] = rng.normal(size=m.edge.shape)
    own, y = rng.normal(size=3), np.array([1, -1, 0])

    def loglik(own):
        weight = lambda ys: sum(own[i] * ys[i] + B._score(m, b, np.zeros(3))[i] * ys[i] + m.edge[kinds[i], b.parent_kind[i], b.distance[i], ys[b.parent[i]] if b.parent[i] >= 0 else 0, ys[i]] for i in range(3))
        every = [ys for ys in itertools.product((0, 1), repeat=3)]
        fit = [ys for ys in every if all(k < 0 or k == v for k, v in zip(y, ys))]
        return np.log(sum(np.exp(weight(ys)) for ys in fit)) - np.log(sum(np.exp(weight(ys)) for ys in every))

    known = np.where(y < 0, 0.0, np.where(y > 0, B.CERTAIN, -B.CERTAIN))
    g = B.marginals(m, b, own + known) - B.marginals(m, b, own)
    for i in range(3):
        step = np.zeros(3)
        step[i] = 1e-5
        assert abs(g[i] - (loglik(own + step) - loglik(own - step)) / 2e-5) < 1e-4


def test_held_out_pages_with_furniture_that_no_list_names(spark, model, corpus):
    rng = np.random.default_rng(99)
    pages = [page(rng, k) for k in range(5000, 5200)]
    got = {(r.id, r.line_no) for r in B.boilerplate_lines(frame(spark, pages), model).collect()}
    truth = {(i, k + 1) for i, (_, _, y) in enumerate(pages) for k, v in enumerate(y) if v == 0}
    both = len(got & truth)
    assert both / len(truth) >= 0.97 and both / len(got) >= 0.97
    headings = [(i, k + 1) for i, (t, x, _) in enumerate(pages) for k, line in enumerate(x) if line == t]
    assert sum(h in got for h in headings) <= 0.05 * len(headings)


def test_all_words_of_a_long_line_count():
    a = "We know that the doors of the hall are open and that the keeper counts the crumbs of each guest of the long night."
    b = a.replace("keeper counts the crumbs", "rudder turns the keel")
    assert {*B.line_features(a)[0]} - {*B.line_features(b)[0]} == {"wkeeper", "wcounts", "wcrumbs"}


def test_lines(spark, model, corpus):
    title, lines, truth = corpus[3]
    text = "\n".join(lines)
    last = max(k for k, y in enumerate(truth) if y)
    long = "\n".join(x[:-1] + " boat" * 20000 + "." if k == last else x for k, x in enumerate(lines))
    rows = [(1, title, text, 7), (2, None, None, 7), (3, None, "", 7), (4, title, text, 7), (4, title, text, 7), (5, "", long, 7)]
    df = spark.createDataFrame(rows, "id int, title string, content string, line_no int")
    got = B.boilerplate_lines(df, model).collect()
    by = {i: sorted(r.line_no for r in got if r.id == i) for i in range(1, 6)}
    assert by[1] == [k + 1 for k, y in enumerate(truth) if not y] and by[2] == by[3] == []
    assert by[4] == sorted(by[1] * 2) and last + 1 not in by[5]
    bodies = {r.id: r.body for r in B.main_bodies(df, model).collect()}
    assert set(bodies) == {1, 4, 5}
    empty = df.limit(0).selectExpr("*", "'' as url")
    assert B.boilerplate_lines(empty).isEmpty()
    assert B.fit(df.selectExpr("*", "cast(null as string) as url")).arrays()[0].shape == (B.SPACE,)


def test_scores_are_sums_over_the_features():
    m = B.Model()
    m.node[:] = np.random.default_rng(3).normal(size=B.SPACE)
    s = B.Scorer(m)
    for line in ("", "  ", "Home > Labs 12 > Printing", "$ ls -l 42", "SHORT", "© 2024 Ébène | help?", "Step 3: press the key and wait until 15 of the 20 lamps of this long row are lit again.") * 2:
        names, kind = B.line_features(line)
        score, k = s.line(line)
        assert k == kind and abs(score - sum(m.node[B._hash(x)] for x in names)) < 1e-9
