"""Problem 2: near-duplicate articles, by one-permutation hashing with optimal densification.

Each text becomes its set of hashed word runs. One hash pass spreads the set over BANDS x ROWS bins and keeps the least
value of each; empty bins borrow from bins drawn by a fixed hash until a full one is met (optimal densification). Rows
of bins form bands; texts that agree on a whole band share a bucket, and each member of a bucket is paired with one
text of the bucket only, its hub (a star), so a bucket of n texts gives n - 1 candidates. Candidates are verified on the full
sets. Verified stars are joined to components; members of a bucket that are then in different components are compared
too, as the hub may be similar to none of them, so every pair that shares a bucket is settled. What these add is
joined to the components, and the texts of a component are compared with each other: those of
small components by a join, those of larger ones in blocks of bounded size, so that no key and no task holds more than
two blocks. Where only the number of similar texts is wanted, pairs that the distances to a common hub prove similar
(the Jaccard distance is a metric) are counted by a running window and not compared at all.

Texts with the same words are one node, before the buckets and until the very end. Buckets are dealt to parts, four to a
partition of a shuffle, and read part by part, 16 bytes for each text of a bucket; which text is the hub changes no result, as every pair that shares a bucket is settled. Defined cases: a null title counts as empty; null or empty contents take no part; a text of fewer words
than a run has no runs and no pairs; an empty table gives no rows; extra columns are ignored; whole texts are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm import boilerplate, residue
from corpusloom.llm.words import WordHasher, mix, run_hashes
from corpusloom.session import broadcast_if_small, delete_frame, ship_package, written, written_by

#: 48 bands of 4 rows find a pair of similarity 0.58 with probability 0.996, one of 0.05 with 0.0003.
BANDS, ROWS = 48, 4
BINS = BANDS * ROWS
#: Bins that an empty bin may be sent to before the first full one of all is taken.
PROBES = 24
#: Components of more texts are compared in blocks of so many word runs (a text with more is a block of its own).
SMALL, BLOCK_RUNS = 64, 2_000_000
#: Word runs of pairs that are compared at once.
COMPARED_RUNS = 2_000_000
#: Distances are rounded up to whole multiples of 1 / UNITS, so that sums are compared exactly.
UNITS = 10**9
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_FULL = np.uint32(0xFFFFFFFF)
#: Texts that are sketched at once, below 2048.
BATCH = 1000
_LOW = np.uint64((1 << 53) - 1)


def _probes() -> np.ndarray:
    at = np.arange(BINS, dtype=np.uint64)[None, :] + np.uint64(BINS) * np.arange(1, PROBES + 1, dtype=np.uint64)[:, None]
    return (mix(at * _GOLDEN) % np.uint64(BINS)).astype(np.int64)


class Sketcher:
    """Word runs, bins and bands of batches of texts."""

    def __init__(self, run: int) -> None:
        self.run, self.hasher, self.probes = run, WordHasher(), _probes()

    def runs(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct run hashes (53 bits) of the texts one after another, their text numbers, and a hash of each text's words."""
        flat, doc, sizes = self.hasher(texts)
        key = np.zeros(len(texts), dtype=np.uint64)
        place = np.arange(len(flat), dtype=np.uint64) - np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.uint64), sizes)
        np.add.at(key, doc, mix(flat ^ mix(place + np.uint64(1))))
        h, d = run_hashes(flat, doc, self.run)
        if not len(h):
            return h, d, key
        # text number and 53 bits of hash in one word, sorted at once; np.unique would hash them before it sorts
        both = (d.astype(np.uint64) << np.uint64(53)) | (h >> np.uint64(11))
        both.sort()
        both = both[np.concatenate([[True], both[1:] != both[:-1]])]
        return both & _LOW, (both >> np.uint64(53)).astype(np.int64), key

    def bands(self, h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
        """Band hashes (n texts x BANDS) of the runs h of texts d."""
        bins = np.full((n, BINS), _FULL, dtype=np.uint32)
        # one flat index, for which numpy is faster than for two
        np.minimum.at(bins.reshape(-1), d * BINS + (h % np.uint64(BINS)).astype(np.int64), np.minimum((h >> np.uint64(21)).astype(np.uint32), _FULL - np.uint32(1)))
        own = bins.copy()
        row, bin_ = np.nonzero(bins == _FULL)
        for p in self.probes:
            if not len(row):
                break
            found = own[row, p[bin_]]
            full = found != _FULL
            bins[row[full], bin_[full]] = found[full]
            row, bin_ = row[~full], bin_[~full]
        least = own.min(axis=1)
        bins = np.where(bins == _FULL, least[:, None], bins)
        x = np.zeros((n, BANDS), dtype=np.uint64)
        for r in range(ROWS):
            x = mix(x * _GOLDEN + bins[:, r::ROWS].astype(np.uint64))
        return (x >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def sketch(self, ids: pa.Array, texts: list[str]) -> pa.RecordBatch:
        h, d, key = self.runs(texts)
        counts = np.bincount(d, minlength=len(texts))
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        bands = self.bands(h, d, len(texts))
        # 4 bytes a run: binary values are copied whole where lists are read and written element by element
        values = (h >> np.uint64(16)).astype(np.uint32)
        grams = pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(4 * offsets), pa.py_buffer(values)])
        band_lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), pa.array(bands.ravel()))
        keep = pa.array(counts > 0)
        return pa.RecordBatch.from_arrays([ids, pa.array(key.view(np.int64)), pa.array(counts.astype(np.int32)), band_lists, grams], names=["id", "node", "n", "bands", "grams"]).filter(keep)


def _schema(kind: str) -> str:
    return f"id {kind}, node bigint, n int, bands array<int>, grams binary"


def sketches(texts: DataFrame, run: int = 5) -> DataFrame:
    """(id, node, n, bands, grams: 4 bytes a run) of each row of `texts` (id, text) that has a run of `run` words; null texts have none."""
    ship_package(texts.sparkSession)

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Sketcher(run)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                part = whole.slice(at, BATCH)
                yield s.sketch(part.column("id"), [t or "" for t in part.column("text").to_pylist()])

    return texts.select("id", "text").mapInArrow(go, _schema(texts.schema["id"].dataType.simpleString()))


def article_sketches(articles: DataFrame, run: int = 3, model: boilerplate.Model | None = None) -> DataFrame:
    """Sketches of title and main body of every article with content, in the pass that finds the main body."""

    def emitter() -> Callable:
        made: list[Sketcher] = []

        def emit(part: pa.RecordBatch, titles, pages, starts, main) -> pa.RecordBatch:
            if not made:
                made.append(Sketcher(run))
            texts = [(t or "") + "\n" + "\n".join(x for x, ok in zip(p, main[s:]) if ok) for t, p, s in zip(titles, pages, starts)]
            return made[0].sketch(part.column("id"), texts)

        return emit

    return boilerplate.page_map(articles, emitter(), _schema(articles.schema["id"].dataType.simpleString()), model or boilerplate.fit(articles))


def _packed(parts: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From (node, bands) to (part, pairs): bucket and node of each band as 16 bytes, those of the same part of the buckets in one value."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bands = batch.column("bands")
            sizes = pc.list_value_length(bands).to_numpy()
            ends = np.cumsum(sizes)
            if not len(ends) or not ends[-1]:
                continue
            band = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
            bucket = (band << 32) + bands.flatten().to_numpy()
            part = (mix(bucket.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
            order = np.argsort(part, kind="stable")
            pairs = np.stack([bucket[order], np.repeat(batch.column("node").to_numpy(), sizes)[order]], axis=1)
            bounds = np.searchsorted(part[order], np.arange(parts + 1))
            values = pa.BinaryArray.from_buffers(pa.binary(), parts, [None, pa.py_buffer((16 * bounds).astype(np.int32)), pa.py_buffer(pairs)])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(parts, dtype=np.int32)), values], names=["part", "pairs"]).filter(pa.array(np.diff(bounds) > 0))

    return go


def _hubs(values: list[bytes]) -> pa.RecordBatch:
    """(bucket, a, b) of the pairs of one part: the least node a of each bucket with every other one."""
    pairs = np.frombuffer(b"".join(values), np.int64).reshape(-1, 2)
    order = np.argsort(pairs[:, 0])
    bucket, node = pairs[order, 0], pairs[order, 1]
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    hub = np.repeat(np.minimum.reduceat(node, starts), np.diff(np.append(starts, len(node))))
    other = node != hub
    return pa.RecordBatch.from_arrays([pa.array(bucket[other]), pa.array(hub[other]), pa.array(node[other])], names=["bucket", "a", "b"])


def met(sketch: DataFrame) -> DataFrame:
    """(bucket, a, b): the least node a of each bucket with every other node of the bucket.

    Buckets are dealt to four times as many parts as a shuffle has partitions; a task holds 16 bytes of each pair of one part at a time.
    """
    ship_package(sketch.sparkSession)
    # copies are one node before they meet any bucket, so a bucket has each node once
    rows = sketch.select(F.col("node").cast("long"), "bands").dropDuplicates(["node"])
    # several to a partition, so that partitions are of about the same size
    parts = 4 * int(sketch.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, values = None, []
        for batch in batches:
            for part, pairs in zip(batch.column("part").to_pylist(), batch.column("pairs").to_pylist()):
                if values and part != last:
                    yield _hubs(values)
                    values = []
                values.append(pairs)
                last = part
        if values:
            yield _hubs(values)

    packed = rows.mapInArrow(_packed(parts), "part int, pairs binary")
    return packed.repartition("part").sortWithinPartitions("part").mapInArrow(go, "bucket bigint, a bigint, b bigint")


def star_edges(sketch: DataFrame) -> DataFrame:
    """(a, b), a < b: candidate pairs of nodes, one node of each bucket with every other node of the bucket."""
    return _ordered(met(sketch)).distinct()


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def crossing_pairs(buckets: DataFrame, group: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of the similar pairs of nodes that share a bucket, are not its hub and are in different components."""
    rows = buckets.join(group, F.col("b") == group.node, "left").select(F.col("bucket").alias("g"), F.col("b").alias("node"), F.coalesce("component", "b").alias("home"))
    rows = written(rows, "homes")
    mixed = rows.groupBy("g").agg(F.count("*").alias("size"), F.min("home").alias("least"), F.max("home").alias("most")).where("least < most").select("g", "size")
    rows = written(rows.join(mixed, "g"), "crossing")
    few = rows.where(F.col("size") <= SMALL)
    x, y = few.select("g", F.col("node").alias("a"), F.col("home").alias("h")), few.select("g", F.col("node").alias("b"), F.col("home").alias("k"))
    pairs = verified(x.join(y, "g").where("a < b and h <> k").select("a", "b").distinct(), grams, threshold)
    large = rows.where(F.col("size") > SMALL)
    if not large.isEmpty():
        # all are at distance 0 of their component, so that pairs of one component are left out
        pairs = pairs.unionByName(block_pairs(large.select("g", "node", "home", F.lit(0).cast("long").alias("far")), grams, threshold, 0)).dropDuplicates(["a", "b"])
    return pairs


def _values(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a column of grams, as lists or as bytes."""
    if pa.types.is_list(lists.type):
        return lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy().view(np.uint32)
    kind = np.int64 if pa.types.is_large_binary(lists.type) else np.int32
    _, offsets, data = lists.buffers()
    at = np.frombuffer(offsets, kind, len(lists) + 1, lists.offset * kind().itemsize).astype(np.int64) // 4
    return at, np.frombuffer(data, np.uint32, at[-1]) if data and at[-1] else np.zeros(0, np.uint32)


def _shared(left: pa.Array, right: pa.Array) -> np.ndarray:
    """How many values the lists of each row of `left` and `right` have in common; rows are compared COMPARED_RUNS values at a time, one at least."""
    (x, a), (y, b) = _values(left), _values(right)
    out = np.zeros(len(left), dtype=np.int64)
    total = (x - x[0]) + (y - y[0])
    at = 0
    while at < len(left):
        end = max(at + 1, int(np.searchsorted(total, total[at] + COMPARED_RUNS, "right")) - 1)
        row = np.arange(end - at, dtype=np.uint64) << np.uint64(32)
        both = np.concatenate([np.repeat(row, np.diff(x[at : end + 1])) | a[x[at] : x[end]], np.repeat(row, np.diff(y[at : end + 1])) | b[y[at] : y[end]]])
        both.sort()
        twice = both[1:][both[1:] == both[:-1]] >> np.uint64(32)
        out[at:end] = np.bincount(twice.astype(np.int64), minlength=end - at)
        at = end
    return out


def verified(pairs: DataFrame, grams: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of the pairs whose sets of runs are at least so similar."""
    a = grams.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("grams").alias("ga"))
    b = grams.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("grams").alias("gb"))
    both = pairs.join(a, "a").join(b, "b").where(F.least("na", "nb") >= threshold * F.greatest("na", "nb"))

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            shared = _shared(part.column("ga"), part.column("gb")).astype(np.float64)
            similarity = shared / (part.column("na").to_numpy().astype(np.float64) + part.column("nb").to_numpy() - shared)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(similarity)], names=["a", "b", "similarity"]).filter(pa.array(similarity >= threshold))

    return both.select("a", "b", "na", "nb", "ga", "gb").mapInArrow(go, "a bigint, b bigint, similarity double")


def components(edges: DataFrame) -> DataFrame:
    """(node, component): least node reachable over the edges (a, b), by rounds of least neighbour and pointer jumping."""
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "both")
    labels = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("m"))
        near = near.join(labels, near.a == labels.node).select("node", "component", F.least("m", "component").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("component").alias("far"))
        moved = written(near.join(jump, "next", "left").select("node", F.coalesce("far", "next").alias("component"), (F.coalesce("far", "next") != F.col("component")).alias("changed")), "labels")
        labels = moved.select("node", "component")
        if moved.where("changed").isEmpty():
            return labels


def _compared(table: pa.Table, threshold: float, bound: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers and similarities of the similar pairs of one block (all of side 0) or of two blocks (side 0 with side 1).

    Pairs of one `home` whose distances to it add up to at most `bound` are left out (none are if it is negative).
    """
    n, side = table.column("n").to_numpy(), table.column("side").to_numpy()
    home, far = table.column("home").to_numpy(), table.column("far").to_numpy()
    offsets, values = _values(table.column("grams").combine_chunks())
    sizes = np.diff(offsets)
    gram = np.unique(values[offsets[0] : offsets[-1]], return_inverse=True)[1].astype(np.int64)
    width = int(gram.max()) + 1
    cell = np.unique(np.repeat(np.arange(len(n), dtype=np.int64), sizes) * width + gram)
    row, gram = cell // width, cell % width
    starts = np.searchsorted(row, np.arange(len(n) + 1))
    two, mark = bool(side.any()), np.zeros(width, dtype=np.int32)
    left = np.flatnonzero(side == 0)
    right = np.flatnonzero(side == 1) if two else left
    by_size = right[np.argsort(n[right], kind="stable")]
    ordered = n[by_size]
    out: list[list[np.ndarray]] = [[], [], []]
    for x in left:
        near = by_size[np.searchsorted(ordered, threshold * n[x] * (1 - 1e-9)) : np.searchsorted(ordered, n[x] / threshold * (1 + 1e-9), "right")]
        near = near if two else near[near > x]
        near = np.sort(near[(home[near] != home[x]) | (far[near] + far[x] > bound)])
        if not len(near):
            continue
        own = gram[starts[x] : starts[x + 1]]
        mark[own] = 1
        width_of = starts[near + 1] - starts[near]
        at = np.repeat(starts[near] - np.concatenate([[0], np.cumsum(width_of)[:-1]]), width_of) + np.arange(width_of.sum())
        shared = np.add.reduceat(mark[gram[at]], np.concatenate([[0], np.cumsum(width_of)[:-1]])).astype(np.float64)
        mark[own] = 0
        similarity = shared / (n[x] + n[near].astype(np.int64) - shared)
        good = similarity >= threshold
        out[0].append(np.full(int(good.sum()), x))
        out[1].append(near[good])
        out[2].append(similarity[good])
    return tuple(np.concatenate(o) if o else np.zeros(0, dtype=np.float64 if k == 2 else np.int64) for k, o in enumerate(out))


def block_pairs(members: DataFrame, grams: DataFrame, threshold: float, bound: int = -1, counts: bool = False) -> DataFrame:
    """(a, b, similarity), a < b, of the similar nodes of each group of `members` (g, node, home, far); with `counts`, (node, links) in parts.

    Groups are cut into blocks of BLOCK_RUNS word runs; a task compares one block with one other or with itself. Block pairs are
    left out where sizes, or distances to one home, settle all pairs of them.
    """
    place = ["home", "far", "node"] if bound >= 0 else ["n", "node"]
    running = Window.partitionBy("g").orderBy(*place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sized = members.join(grams.select("node", "n"), "node").withColumn("block", F.floor(F.sum(F.col("n").cast("long")).over(running) / BLOCK_RUNS))
    sized = written(sized, "blocks")
    kinds = sized.groupBy("g", "block").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("home").alias("h0"), F.max("home").alias("h1"), F.max("far").alias("far"))
    x = kinds.select("g", *[F.col(c).alias(c + "_x") for c in kinds.columns[1:]])
    y = kinds.select("g", *[F.col(c).alias(c + "_y") for c in kinds.columns[1:]])
    settled = (F.col("h0_x") == F.col("h1_x")) & (F.col("h0_x") == F.col("h0_y")) & (F.col("h0_y") == F.col("h1_y")) & (F.col("far_x") + F.col("far_y") <= bound)
    # a little wider than the bound, as products with it are rounded
    tasks = x.join(y, "g").where((F.col("block_x") <= F.col("block_y")) & (F.col("hi_x") >= 0.999 * threshold * F.col("lo_y")) & (F.col("hi_y") >= 0.999 * threshold * F.col("lo_x")) & ~settled)
    tasks = written(tasks.select("g", F.col("block_x").alias("i"), F.col("block_y").alias("j")), "tasks")
    full = sized.join(grams.select("node", "grams"), "node")
    side = lambda t, at, k: full.join(t, (full.g == t.g) & (full.block == t[at])).select(t.g, "i", "j", F.lit(k).alias("side"), "node", "n", "home", "far", "grams")
    rows = side(tasks, "i", 0).unionByName(side(tasks.where("i < j"), "j", 1))

    def go(table: pa.Table) -> pa.Table:
        left, right, similarity = _compared(table, threshold, bound)
        node = table.column("node").to_numpy()
        if counts:
            at, many = np.unique(np.concatenate([left, right]), return_counts=True)
            return pa.table({"node": node[at], "links": many.astype(np.int64)})
        a, b = node[left], node[right]
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "similarity": similarity})

    return rows.groupBy("g", "i", "j").applyInArrow(go, "node bigint, links bigint" if counts else "a bigint, b bigint, similarity double")


def _stars(sketch: DataFrame, threshold: float, read: Callable[[], None] = lambda: None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Verified stars and crossing pairs (a, b, similarity), grams of the nodes that are candidates, and components with their size (component, node, size).

    `read` is called when `sketch` was read for the last time.
    """
    buckets = written(met(sketch), "buckets")
    candidates = written(_ordered(buckets).distinct(), "stars")
    ends = candidates.select(F.col("a").alias("node")).union(candidates.select("b")).distinct()
    grams = sketch.select("node", "n", "grams").join(broadcast_if_small(ends), "node", "left_semi").dropDuplicates(["node"])
    grams = written_by(grams, "grams", "node")
    read()
    stars = written(verified(candidates, grams, threshold), "verified")
    group = components(stars)
    more = written(crossing_pairs(buckets, group, grams, threshold), "crossed")
    if not more.isEmpty():
        stars = written(stars.unionByName(more.join(stars.select("a", "b"), ["a", "b"], "left_anti")), "verified")
        group = components(stars)
    return stars, grams, written(group.join(group.groupBy("component").agg(F.count("*").alias("size")), "component"), "components")


def _small_pairs(stars: DataFrame, grams: DataFrame, group: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity) of the similar pairs of components of at most SMALL nodes."""
    few = group.where(F.col("size") <= SMALL)
    x, y = few.select("component", F.col("node").alias("a")), few.select("component", F.col("node").alias("b"))
    more = x.join(y, "component").where("a < b").select("a", "b").join(stars.select("a", "b"), ["a", "b"], "left_anti")
    return stars.join(few.select(F.col("node").alias("a")), "a", "left_semi").unionByName(verified(more, grams, threshold))


def similar_nodes(sketch: DataFrame, threshold: float, read: Callable[[], None] = lambda: None) -> DataFrame:
    """(a, b, similarity), a < b, of the different texts that are at least so similar and met by way of the bands. `read`: as for _stars()."""
    stars, grams, group = _stars(sketch, threshold, read)
    pairs = _small_pairs(stars, grams, group, threshold)
    many = group.where(F.col("size") > SMALL)
    if many.isEmpty():
        return pairs
    return pairs.unionByName(block_pairs(many.select(F.col("component").alias("g"), "node", F.col("node").alias("home"), F.lit(0).cast("long").alias("far")), grams, threshold))


def hub_links(members: DataFrame, bound: int) -> DataFrame:
    """(node, links): for each row of (home, node, far) the other rows of its home with far + far of at most `bound`, by a running count."""
    points = members.select("home", F.col("far").alias("v"), F.lit(1).alias("one"), F.lit(None).cast("bigint").alias("node"), F.lit(0).alias("self"))
    asked = members.select("home", (bound - F.col("far")).alias("v"), F.lit(0).alias("one"), "node", (2 * F.col("far") <= bound).cast("int").alias("self"))
    # points come first among equals, so rows can be counted one by one
    running = Window.partitionBy("home").orderBy("v", F.desc("one")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return points.unionByName(asked).withColumn("links", F.sum("one").over(running) - F.col("self")).where("one = 0").select("node", "links")


def _many_links(stars: DataFrame, grams: DataFrame, many: DataFrame, threshold: float) -> DataFrame:
    """(node, links) in parts, of the nodes of large components: pairs proved by a common hub are counted, the others compared."""
    bound = int((1 - threshold) * UNITS) - 2
    # each node's home is the least hub that it is similar to, its own where it has none
    homes = stars.groupBy(F.col("b").alias("node")).agg(F.min(F.struct("a", F.ceil((1 - F.col("similarity")) * UNITS).alias("far"))).alias("hub"))
    members = many.select(F.col("component").alias("g"), "node").join(homes, "node", "left")
    members = written(members.select("g", "node", F.coalesce("hub.a", "node").alias("home"), F.coalesce("hub.far", F.lit(0).cast("long")).alias("far")), "homes")
    return hub_links(members, bound).unionByName(block_pairs(members, grams, threshold, bound, counts=True))


def classes(sketch: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(id, class_id, links): one row per document with its class (least id) and the number of other texts that are similar to its own."""
    stars, grams, group = _stars(sketch, threshold)
    pairs = written(_small_pairs(stars, grams, group, threshold), "pairs")
    links = pairs.select(F.col("a").alias("node"), F.lit(1).cast("long").alias("links")).unionByName(pairs.select(F.col("b").alias("node"), F.lit(1).cast("long").alias("links")))
    many = group.where(F.col("size") > SMALL)
    if not many.isEmpty():
        links = links.unionByName(_many_links(stars, grams, many, threshold))
    links = links.groupBy("node").agg(F.sum("links").alias("links"))
    member = sketch.select("id", "node").join(group.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = member.groupBy("component").agg(F.min("id").alias("class_id"))
    return member.join(least, "component").join(links, "node", "left").select("id", "class_id", F.coalesce("links", F.lit(0)).alias("links"))


def expand(pairs: DataFrame, sketch: DataFrame) -> DataFrame:
    """(id_a, id_b), smaller id first: every pair of rows of two similar texts, and of the same text."""
    member = sketch.select("node", "id")
    a, b = member.select(F.col("node").alias("a"), F.col("id").alias("x")), member.select(F.col("node").alias("b"), F.col("id").alias("y"))
    between = pairs.select("a", "b").join(a, "a").join(b, "b").select("x", "y")
    several = member.groupBy("node").agg(F.count("*").alias("copies")).where("copies > 1")
    copies = member.join(several, "node", "left_semi")
    same = copies.select("node", F.col("id").alias("x")).join(copies.select("node", F.col("id").alias("y")), "node").where("x < y").select("x", "y")
    return between.unionByName(same).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def similar_articles(articles: DataFrame, threshold: float = 0.5, run: int = 3) -> DataFrame:
    """(id_a, id_b): every pair of articles that are at least so similar in title and main body; residue takes no part."""
    units = written(residue.text_units(articles), "units")
    made = written(article_sketches(articles, run, boilerplate.fit(articles, units)), "sketches")
    bad = residue.residue(articles, units).select("id").distinct()
    sketch = made.join(broadcast_if_small(bad), "id", "left_anti")
    # what was read for the last time needn't stay on disk
    delete_frame(units)
    member = written(sketch.select("id", "node"), "members")
    return expand(written(similar_nodes(sketch, threshold, lambda: delete_frame(made)), "pairs"), member)
