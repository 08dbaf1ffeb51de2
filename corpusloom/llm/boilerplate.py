"""Problem 1: main body of a page, by sum-product over a tree of its lines.

A page becomes a tree: its root holds the lead lines (short lines without a closing mark, such as section titles and
menu heads) as a chain of sections, and each other line hangs on the lead line above it. Every node is main body or
not. Node potentials come from hashed features of the line and its neighbours, edge potentials from the kinds and the
distance of parent and child. One upward and one downward sum-product pass, for all pages of a batch at once, give
exact marginals; a line is boilerplate where its marginal is below one half. Weights are fitted by gradient ascent on
the exact log-likelihood of labelled pages.

No page in the tables is labelled, so a bounded sample of pages (LABEL_PAGES, those with the smallest id hashes) is
labelled by statistics of the whole corpus, not by any phrase: a sentence that stands under very many titles is
furniture, one that doesn't is main body; another line that stands under very many titles is a heading if it mostly
stands between sentences, else furniture; a line that no sentence follows is no heading, a short one between two is. Doubtful lines stay without a label and
are summed over (the gradient is the difference of the marginals with and without the labels). The fitted model, not
the labels, decides on every line of every page.

Defined cases: null and empty contents give no lines; a title may be null; empty lines are nodes like others; an empty
table gives an untrained model and no rows; extra columns are ignored; lines and pages of any length are read whole.
"""

from __future__ import annotations

import gc
import re
import zlib
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm import residue
from corpusloom.llm.words import Kept
from corpusloom.session import broadcast_if_small, ship_package, written

#: Bound of the labelled sample.
LABEL_PAGES = 2500
#: Hashed node features.
SPACE = 1 << 15
EPOCHS = 80
#: A line recurs if it stands under so many titles, as a share of the pages, and under so many at least.
RECURS, LEAST_TITLES = 0.0008, 5
#: Share of its places at which a heading has a sentence before it, and after it.
HEADING = 0.45
CERTAIN = 60.0
#: Pages whose messages are passed at once.
PAGES_AT_ONCE = 2000

EMPTY, SENTENCE, STEP, LEAD, TITLE, PARTS, COMMAND, OTHER = KINDS = range(8)
ROOT = len(KINDS)
DISTANCES = 4
#: Neighbour features: kinds of two lines before and after, place from top and bottom, relation to the page's title.
OFFSETS = (-2, -1, 1, 2)
PLACES = 8

_PARTS = re.compile(r"\s[|·•]\s|\s»\s|\s::\s|\s/\s|\s>\s|\s-\s.*\s-\s|\S\s{2,}\S")
_STEP = re.compile(r"(?:[-*•]\s|\d+[.)]\s|step \d+[:.]\s|(?:note|tip|warning|important|caution):)", re.I)
_DIGITS = re.compile(r"\d+")
_TRAIL = re.compile(residue.TRAIL)
_QUOTES = "\"'”’)"
_SIGNS = ("|", "·", "»", "::", " > ", " / ", "©", "?", '"', "(")


def kind_of(line: str, n_words: int | None = None) -> int:
    """The kind of a line by its shape: sentence, step, lead, title-like, parts with separators, command, other, empty."""
    s = line.strip()
    if not s:
        return EMPTY
    if s[0] == "$" and s[1:2] == " ":
        return COMMAND
    n = len(s.split()) if n_words is None else n_words
    closed = s[-1] in ".!:…" or (s[-1] in _QUOTES and s[-2:-1] in ".!:…" and len(s) > 1)
    if closed and n >= 5:
        return STEP if _STEP.match(s) else SENTENCE
    if _PARTS.search(s):
        return PARTS
    if n >= 12 and 2 * sum(x[:1].islower() for x in s.split()) > n:
        return SENTENCE
    if n <= 4 and not closed and s[0] not in "•*-":
        return LEAD
    return OTHER if closed else TITLE


def _crc(text: str, prefix: int = 0) -> int:
    """CRC of the text behind a prefix of that CRC."""
    return zlib.crc32(text.encode("utf-8", "surrogatepass"), prefix)


def _hash(text: str) -> int:
    return _crc(text) % SPACE


_TWO, _THREE, _WHOLE, _LAST = _crc("g"), _crc("h"), _crc("l"), [_crc(f"{k}z") for k in KINDS]


def line_features(line: str) -> tuple[list[str], int]:
    """Features of a line by itself, from all of its words, and its kind."""
    low = _DIGITS.sub("0", line.lower())
    w = low.split()
    n = len(w)
    k = kind_of(line, n)
    out = [f"k{k}", f"{k}n{min(n, 13)}", "upper" if line.isupper() else "mixed"]
    if w:
        out += ["f" + w[0], "g" + " ".join(w[:2]), "h" + " ".join(w[:3]), f"{k}z{' '.join(w[-2:])}"]
        out += ["w" + x for x in w]
    if n <= 12:
        # a long line is hardly ever the same twice, and any of these signs stands in some
        low = " ".join(w)
        out += [f"{k}e{low[-1:]}", f"{k}b{low[:1]}", "l" + low]
        out += ["c" + c for c in _SIGNS if c in low]
    return out, k


class Model:
    """Weights of the node, neighbour and edge features; log potentials in favour of main body."""

    def __init__(self) -> None:
        self.node = np.zeros(SPACE)
        self.near = np.zeros((len(OFFSETS), len(KINDS) + 1, len(KINDS)))
        self.top, self.end = np.zeros((PLACES, len(KINDS))), np.zeros((PLACES, len(KINDS)))
        self.titled = np.zeros((3, len(KINDS)))
        # [kind of child, kind of parent or root, distance, state of parent, state of child]
        self.edge = np.zeros((len(KINDS), len(KINDS) + 1, DISTANCES, 2, 2))

    def arrays(self) -> list[np.ndarray]:
        return [self.node, self.near, self.top, self.end, self.titled, self.edge]


class Batch:
    """The trees of some pages as flat arrays; node 0 of no page is special, each page's first parent is its root."""

    def __init__(self, kinds: np.ndarray, starts: np.ndarray, titled: np.ndarray) -> None:
        n = len(kinds)
        sizes = np.diff(starts)
        self.kinds, self.starts, self.titled = kinds, starts, titled
        page = np.repeat(np.arange(len(sizes)), sizes)
        at = np.arange(n) - starts[:-1][page]
        self.page = page
        # parent: the last lead line before the node, else the root
        lead = np.where(kinds == LEAD, np.arange(n), -1)
        before = np.maximum.accumulate(lead) if n else lead
        before = np.concatenate([[-1], before[:-1]]) if n else before
        self.parent = np.where(before >= starts[:-1][page], before, -1)
        gap = np.where(self.parent >= 0, np.arange(n) - self.parent, at + 1)
        self.distance = np.minimum(np.where(gap <= 2, gap - 1, np.where(gap <= 6, 2, 3)), DISTANCES - 1)
        self.parent_kind = np.where(self.parent >= 0, kinds[self.parent], ROOT)
        left = sizes[page] - 1 - at
        self.top = np.minimum(at, PLACES - 1)
        self.end = np.minimum(left, PLACES - 1)
        self.near = []
        for o in OFFSETS:
            j = np.arange(n) + o
            ok = (at + o >= 0) & (left - o >= 0)
            self.near.append(np.where(ok, kinds[np.clip(j, 0, max(n - 1, 0))], len(KINDS)))
        # leads form a chain; depth by position among the page's leads
        is_lead = (kinds == LEAD).astype(np.int64)
        upto = np.cumsum(is_lead) - is_lead
        first = upto[starts[:-1][page]] if n else upto
        self.depth = upto - first
        order = np.argsort(self.depth, kind="stable")
        cuts = np.searchsorted(self.depth[order], np.arange(int(self.depth.max()) + 2)) if n else np.zeros(1, int)
        self.levels = [order[cuts[i] : cuts[i + 1]] for i in range(len(cuts) - 1)]
        self.rooted = self.parent < 0
        self.children = [level[~self.rooted[level]] for level in self.levels]


def _score(model: Model, b: Batch, own: np.ndarray) -> np.ndarray:
    s = own + model.top[b.top, b.kinds] + model.end[b.end, b.kinds] + model.titled[b.titled, b.kinds]
    for o in range(len(OFFSETS)):
        s = s + model.near[o][b.near[o], b.kinds]
    return s


def marginals(model: Model, b: Batch, own: np.ndarray, edges: bool = False):
    """P(main body) of each node by one upward and one downward pass; with `edges`, also the pair marginals of parent and child.

    The two states have an array each: numpy is slow along an axis of two.
    """
    n = len(b.kinds)
    psi = model.edge[b.kinds, b.parent_kind, b.distance]  # n, parent state, child state
    p00, p01, p10, p11 = (psi[:, i, j] for i in (0, 1) for j in (0, 1))
    p10, p11 = np.where(b.rooted, p00, p10), np.where(b.rooted, p01, p11)  # the root has one state
    up0, up1, below0, below1 = np.zeros(n), np.zeros(n), np.zeros(n), _score(model, b, own)
    for level, child in zip(reversed(b.levels), reversed(b.children)):
        b0, b1 = below0[level], below1[level]
        for up, p, q in ((up0, p00, p01), (up1, p10, p11)):
            x, y = p[level] + b0, q[level] + b1
            top = np.maximum(x, y)
            up[level] = top + np.log(np.exp(x - top) + np.exp(y - top))
        np.add.at(below0, b.parent[child], up0[child])
        np.add.at(below1, b.parent[child], up1[child])
    belief0, belief1 = np.zeros(n), np.zeros(n)
    pair = np.zeros((n, 2, 2)) if edges else None
    for level in b.levels:
        p, rooted, b0, b1 = b.parent[level], b.rooted[level], below0[level], below1[level]
        a0, a1 = np.where(rooted, 0.0, belief0[p] - up0[level]), np.where(rooted, -1e9, belief1[p] - up1[level])
        joint = [a0 + p00[level] + b0, a0 + p01[level] + b1, a1 + p10[level] + b0, a1 + p11[level] + b1]
        top = np.maximum(np.maximum(joint[0], joint[1]), np.maximum(joint[2], joint[3]))
        e = [np.exp(j - top) for j in joint]
        total = e[0] + e[1] + e[2] + e[3]
        e = [x / total for x in e]
        if edges:
            pair[level] = np.stack(e, axis=1).reshape(-1, 2, 2)
        belief0[level] = np.log(np.maximum(e[0] + e[2], 1e-12))
        belief1[level] = np.log(np.maximum(e[1] + e[3], 1e-12))
    main = np.exp(belief1)
    return (main, pair) if edges else main


def split_pages(contents: list[str], titles: list[str | None]):
    """Lines of each page, offsets of the pages, and how each line relates to its page's title (0 not, 1 within, 2 the same)."""
    pages = [c.split("\n") for c in contents]
    starts = np.zeros(len(pages) + 1, dtype=np.int64)
    np.cumsum([len(p) for p in pages], out=starts[1:])
    titled = np.zeros(int(starts[-1]), dtype=np.int64)
    for i, (lines, title) in enumerate(zip(pages, titles)):
        # the page is lower-cased at once, not line by line
        if (t := title.strip().lower() if title else "") and t in (whole := contents[i].lower()):
            for k, low in enumerate(whole.split("\n")):
                if t in low and len(t) <= len(lines[k]):
                    titled[starts[i] + k] = 2 if low.strip(" •*-") == t else 1
    return pages, starts, titled


def label_lines(lines: list[str], title: str | None, seen: list[tuple[int, float, float]], least: int, leads: set[str]) -> np.ndarray:
    """1 for main body, 0 for furniture, -1 where in doubt.

    `seen`: under how many titles each line stands, and how often a sentence is before and after it; lines of `least` titles
    or more recur. `leads`: first words of recurring sentences; a sentence that begins like one, but doesn't recur, is in doubt, as is
    one that begins like a page trail.
    """
    kinds = [kind_of(x) for x in lines]
    own = title.strip().lower() if title else ""
    reads = np.array([k in (SENTENCE, STEP, COMMAND) for k in kinds], dtype=bool)
    y = np.full(len(lines), -1)
    for i in np.flatnonzero(reads):
        y[i] = 0 if seen[i][0] >= least else -1 if lead_of(lines[i]) in leads or _TRAIL.match(lines[i]) else 1
    full = [i for i, k in enumerate(kinds) if k != EMPTY]
    body = {i for i in full if reads[i] and y[i] == 1}
    for before, i, after in zip([None, *full[:-1]], full, [*full[1:], None]):
        if reads[i]:
            continue
        titles, *beside = seen[i]
        line = lines[i].strip()
        short = kinds[i] in (LEAD, TITLE) and ". " not in line
        if own and line.lower() == own:
            y[i] = 1 if after in body else -1
        elif titles >= least:
            y[i] = 1 if short and min(beside) >= HEADING else 0
        elif after not in body:
            y[i] = 0
        elif kinds[i] == LEAD and before in body:
            y[i] = 1
    return y


def lead_of(line: str) -> str:
    """The first three words."""
    return " ".join(_DIGITS.sub("0", line.lower()).split()[:3])


def train(contents: list[str], titles: list[str | None], labels: list[np.ndarray], epochs: int = EPOCHS) -> Model:
    """A model fitted to pages by Adam on the exact gradient of the log-likelihood of their labels (1, 0, or -1 for none)."""
    model = Model()
    if not contents:
        return model
    pages, starts, titled = split_pages(contents, titles)
    # equal lines have one set of features
    number: dict[str, int] = {}
    line_of = np.array([number.setdefault(line, len(number)) for lines in pages for line in lines])
    feats, kinds = [], []
    for line in number:
        f, k = line_features(line)
        feats.append([_hash(x) for x in f])
        kinds.append(k)
    y = np.concatenate(labels)
    b = Batch(np.array(kinds)[line_of], starts, titled)
    owner = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    flat = np.concatenate([np.array(f) for f in feats])
    state = [(np.zeros_like(a), np.zeros_like(a)) for a in model.arrays()]
    n = len(y)
    # a label is a potential that no other can outweigh
    known = np.where(y < 0, 0.0, np.where(y > 0, CERTAIN, -CERTAIN))
    # sums by feature are counts over one flat index each
    summed = lambda a, at, g: np.bincount(at, weights=g, minlength=a.size).reshape(a.shape)
    near_at = [x * len(KINDS) + b.kinds for x in b.near]
    top_at, end_at, titled_at = b.top * len(KINDS) + b.kinds, b.end * len(KINDS) + b.kinds, b.titled * len(KINDS) + b.kinds
    edge_at = np.ravel_multi_index((b.kinds, b.parent_kind, b.distance), model.edge.shape[:3])
    for t in range(1, epochs + 1):
        rate = 0.15 if 2 * t < epochs else 0.05
        own = np.bincount(owner, weights=model.node[flat], minlength=len(feats))[line_of]
        main, pair = marginals(model, b, own, edges=True)
        main_known, pair_known = marginals(model, b, own + known, edges=True)
        g = main_known - main
        grads = [np.bincount(flat, weights=np.bincount(line_of, weights=g, minlength=len(feats))[owner], minlength=SPACE)]
        near = np.stack([summed(x, at, g) for x, at in zip(model.near, near_at)])
        top, end, tit = summed(model.top, top_at, g), summed(model.end, end_at, g), summed(model.titled, titled_at, g)
        change = pair_known - pair
        edge = np.stack([np.stack([summed(model.edge[..., i, j], edge_at, change[:, i, j]) for j in (0, 1)], axis=-1) for i in (0, 1)], axis=-2)
        for a, (m, v), d in zip(model.arrays(), state, [*grads, near, top, end, tit, edge]):
            d = d - 0.02 * a
            m *= 0.9
            m += 0.1 * d
            v *= 0.999
            v += 0.001 * d * d
            a += rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return model


class Scorer:
    """Applies a model to batches of pages; the scores of lines seen before are kept, as furniture recurs."""

    KEEP = 100_000

    def __init__(self, model: Model) -> None:
        self.model = model
        self.known: dict[str, tuple[float, int]] = {}
        self.node = node = model.node.tolist()
        self.masks = Kept(lambda w: _DIGITS.sub("0", w), self.KEEP)
        self.words = Kept(lambda w: node[_hash("w" + _DIGITS.sub("0", w))], self.KEEP)
        # of features that recur; the others are hashed each time
        self.weights = Kept(lambda x: node[_hash(x)], self.KEEP)
        # sums for shapes, first words and last words, which recur
        self.shapes, self.begins, self.ends = Kept(self._shape, self.KEEP), Kept(self._begin, self.KEEP), Kept(self._end, self.KEEP)

    def _shape(self, shape: tuple[int, int, bool]) -> float:
        k, n, upper = shape
        return self.weights[f"k{k}"] + self.weights[f"{k}n{n}"] + self.weights["upper" if upper else "mixed"]

    def _begin(self, words: tuple[str, ...]) -> float:
        first = [self.masks[x] for x in words]
        return self.weights["f" + first[0]] + self.node[_crc(" ".join(first[:2]), _TWO) % SPACE] + self.node[_crc(" ".join(first), _THREE) % SPACE]

    def _end(self, words: tuple) -> float:
        k, *last = words
        return self.node[_crc(" ".join([self.masks[x] for x in last]), _LAST[k]) % SPACE]

    def line(self, line: str) -> tuple[float, int]:
        """The sum of the weights of line_features(), and the kind; digits are masked in single words."""
        w = line.lower().split()
        n = len(w)
        k = kind_of(line, n)
        weights, mask = self.weights, self.masks.__getitem__
        score = self.shapes[k, min(n, 13), line.isupper()]
        if w:
            score += self.begins[tuple(w[:3])]
            score += self.ends[(k, *w[-2:])] + sum(map(self.words.__getitem__, w))
        if n <= 12:
            low = " ".join([mask(x) for x in w])
            score += weights[f"{k}e{low[-1:]}"] + weights[f"{k}b{low[:1]}"] + self.node[_crc(low, _WHOLE) % SPACE]
            for c in _SIGNS:
                if c in low:
                    score += weights["c" + c]
        if len(line) < 100:
            if len(self.known) >= self.KEEP:
                self.known.clear()
            self.known[line] = score, k
        return score, k

    def main_body(self, contents: list[str], titles: list[str | None]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
        """Lines of the pages, their offsets, and whether each line is main body."""
        pages, starts, titled = split_pages(contents, titles)
        known, line_of = self.known, self.line
        scored = [known.get(x) or line_of(x) for p in pages for x in p]
        own, kinds = np.array([s[0] for s in scored]), np.array([s[1] for s in scored], dtype=np.int64)
        return pages, starts, marginals(self.model, Batch(kinds, starts, titled), own) >= 0.5


def line_statistics(units: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(id, hashes) of the lines of `pages` (id), and (h, titles, before, after) of these lines over all of `units` (residue.text_units).

    `titles`: the titles under which a line stands; `before`, `after`: how often a sentence is the line before and after it.
    """
    contents = units.where("field = 'content'")
    mine = written(contents.join(pages, "id", "left_semi").select("id", "at", "h"), "labelled")
    wanted = broadcast_if_small(mine.select("h").distinct(), name="wanted")
    per_title = contents.join(wanted, "h", "left_semi").groupBy("h", "title").agg(F.count("*").alias("n"), F.sum(residue.flag(residue.PREV)).alias("prev"), F.sum(residue.flag(residue.NEXT)).alias("next"))
    # of repeated rows one counts
    mine = mine.dropDuplicates(["id", "at"]).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("at", "h"))).alias("lines")).select("id", F.col("lines.h").alias("hashes"))
    return mine, per_title.groupBy("h").agg(F.count("*").alias("titles"), (F.sum("prev") / F.sum("n")).alias("before"), (F.sum("next") / F.sum("n")).alias("after"))


def fit(articles: DataFrame, units: DataFrame | None = None, pages: int = LABEL_PAGES) -> Model:
    """A model fitted to `pages` pages of `articles` (id, url, title, content), labelled by the lines of all articles. `units`: their written text_units()."""
    units = written(residue.text_units(articles), "units") if units is None else units
    have = articles.where("content is not null and content <> ''")
    h = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    total = have.count()
    cut = (1 << 30) if total <= pages else int((1 << 30) * pages / total)
    sample = have.where(h < cut).select(h.alias("h"), "id", "title", "content").limit(2 * pages).collect()
    sample = sorted({r.id: r for r in sample}.values(), key=lambda r: (r.h, r.id))[:pages]
    if not sample:
        return Model()
    ids = articles.sparkSession.createDataFrame([(r.id,) for r in sample], f"id {articles.schema['id'].dataType.simpleString()}")
    mine, stats = line_statistics(units, F.broadcast(ids))  # at most `pages` ids
    # as many rows as the sample has lines
    seen = {r.h: (r.titles, r.before, r.after) for r in stats.collect()}
    hashes = {r.id: r.hashes for r in mine.collect()}
    least = max(LEAST_TITLES, int(RECURS * total))
    lines = {r.id: r.content.split("\n") for r in sample}
    of = {i: [seen.get(x, (0, 0.0, 0.0)) for x in hashes[i]] for i in lines}
    leads = {lead_of(x) for i, page in lines.items() for x, (titles, *_) in zip(page, of[i]) if titles >= least and kind_of(x) in (SENTENCE, STEP)}
    return train([r.content for r in sample], [r.title for r in sample], [label_lines(lines[r.id], r.title, of[r.id], least, leads) for r in sample])


@contextmanager
def _uncollected() -> Iterator[None]:
    """Without Python's search for reference cycles, which walks the tables of scores again and again; they have none."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


def _in_batches(model: Model, emit: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        with _uncollected():
            for whole in batches:
                for at in range(0, whole.num_rows, PAGES_AT_ONCE):
                    part = whole.slice(at, PAGES_AT_ONCE)
                    contents, titles = part.column("content").to_pylist(), part.column("title").to_pylist()
                    yield emit(part, titles, *scorer.main_body(contents, titles))

    return run


def page_map(articles: DataFrame, emit: Callable, schema: str, model: Model) -> DataFrame:
    """What `emit` makes of the scored pages of `articles` (id, title, content), batch by batch; null and empty contents are left out."""
    ship_package(articles.sparkSession)
    pages = articles.where("content is not null and content <> ''").select("id", "title", "content")
    return pages.mapInArrow(_in_batches(model, emit), schema)


def boilerplate_lines(articles: DataFrame, model: Model | None = None) -> DataFrame:
    """(id, line_no): the lines, counted from 1, that are not main body, of every article with content."""
    kind = articles.schema["id"].dataType.simpleString()

    def emit(part: pa.RecordBatch, titles, pages, starts, main) -> pa.RecordBatch:
        out = np.flatnonzero(~main)
        page = np.searchsorted(starts, out, side="right") - 1
        return pa.RecordBatch.from_arrays([part.column("id").take(pa.array(page)), pa.array((out - starts[page] + 1).astype(np.int32))], names=["id", "line_no"])

    return page_map(articles, emit, f"id {kind}, line_no int", model or fit(articles))


def main_bodies(articles: DataFrame, model: Model | None = None) -> DataFrame:
    """(id, body): the main body of every article with content, its lines joined again."""
    kind = articles.schema["id"].dataType.simpleString()

    def emit(part: pa.RecordBatch, titles, pages, starts, main) -> pa.RecordBatch:
        bodies = ["\n".join(x for x, ok in zip(p, main[s:]) if ok) for p, s in zip(pages, starts)]
        return pa.RecordBatch.from_arrays([part.column("id"), pa.array(bodies)], names=["id", "body"])

    return page_map(articles, emit, f"id {kind}, body string", model or fit(articles))
