"""Problem 8: texts into containers of fixed capacity.

Texts are spread over shards by a hash of their id, so many that a shard holds about SHARD_ITEMS texts whatever the
input; a shard leaves at most one container partly filled beyond what packing loses, so nothing is gained by larger
ones. Within a shard, Martello-Toth dominance reduction is applied to the counts of equal sizes: from the largest size
down, a container is fixed for good where one companion provably does at least as well as any other set of companions.
What remains is packed best-fit, largest first. Texts above the capacity are cut into full containers and a rest.

Defined cases: sizes that are null or not positive take no container; a text as large as the capacity fills one; ties
between equal sizes are broken by id; an empty table gives no rows; capacities that are null or not positive are
ignored; extra columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import broadcast_if_small, ship_package

#: Texts in a shard, on average.
SHARD_ITEMS = 20_000


def _at_most(mask: int, size: int) -> int:
    """The largest size in the set `mask` that is at most `size`, or 0."""
    return max((mask & ((1 << (size + 1)) - 1)).bit_length() - 1, 0) if size > 0 else 0


def _at_least(mask: int, size: int) -> int:
    """The smallest size in the set `mask` that is at least `size`, or -1."""
    x = mask >> size
    return (x & -x).bit_length() - 1 + size if x else -1


class Sizes:
    """How many items there are of each size, and the set of sizes as bits."""

    def __init__(self, counts: dict[int, int]) -> None:
        self.n = dict(counts)
        self.mask = sum(1 << s for s, c in counts.items() if c)

    def take(self, size: int) -> None:
        self.n[size] -= 1
        if not self.n[size]:
            self.mask &= ~(1 << size)

    def put(self, size: int) -> None:
        self.n[size] = self.n.get(size, 0) + 1
        self.mask |= 1 << size

    def smallest(self, k: int) -> list[int]:
        out, mask = [], self.mask
        while mask and len(out) < k:
            s = (mask & -mask).bit_length() - 1
            out += [s] * min(self.n[s], k - len(out))
            mask &= mask - 1
        return out

    def best_pair(self, room: int) -> int:
        """The largest sum of two items that is at most `room`, or 0."""
        best, big = 0, _at_most(self.mask, room)
        while 2 * big >= best and big:
            other = _at_most(self.mask, min(room - big, big))
            if other == big and self.n[big] < 2:
                other = _at_most(self.mask, big - 1)
            if other:
                best = max(best, big + other)
            if best == room:
                break
            big = _at_most(self.mask, big - 1)
        return best


def reduce(sizes: Sizes, capacity: int) -> list[list[int]]:
    """Containers that are fixed by dominance, as lists of sizes; they are taken out of `sizes`."""
    fixed: list[list[int]] = []
    size = sizes.mask.bit_length() - 1
    while size > 0:
        while sizes.n.get(size, 0):
            sizes.take(size)
            room = capacity - size
            mate = _at_most(sizes.mask, room)
            if not mate:
                fixed.append([size])
                continue
            least = sizes.smallest(3)
            # a companion that fills the container, or is the largest where only one fits, or no less than any two
            if mate == room or len(least) < 2 or least[0] + least[1] > room or ((len(least) < 3 or sum(least) > room) and mate >= sizes.best_pair(room)):
                sizes.take(mate)
                fixed.append([size, mate])
                continue
            sizes.put(size)
            break
        size = _at_most(sizes.mask, size - 1)
    return fixed


def best_fit(sizes: Sizes, capacity: int) -> list[list[int]]:
    """The items of `sizes`, largest first, each to the fullest container that holds it."""
    done: list[list[int]] = []
    open_: dict[int, list[list[int]]] = {}
    rooms = 0
    while sizes.mask:
        size = sizes.mask.bit_length() - 1
        sizes.take(size)
        room = _at_least(rooms, size)
        if room < 0:
            box, room = [], capacity
            done.append(box)
        else:
            box = open_[room].pop()
            if not open_[room]:
                rooms &= ~(1 << room)
        box.append(size)
        if left := room - size:
            open_.setdefault(left, []).append(box)
            rooms |= 1 << left
    return done


def pack(counts: dict[int, int], capacity: int) -> list[list[int]]:
    """Containers for items of sizes 1 to `capacity`, given how many there are of each size."""
    sizes = Sizes(counts)
    return reduce(sizes, capacity) + best_fit(sizes, capacity)


def _pack_shard(rows: pd.DataFrame) -> pd.DataFrame:
    capacity, shard = int(rows["capacity"].iloc[0]), int(rows["shard"].iloc[0])
    rows = rows.sort_values(["tokens", "doc_id", "piece"])
    waiting: dict[int, list[int]] = {}
    for at, size in enumerate(rows["tokens"].tolist()):
        waiting.setdefault(size, []).append(at)
    container = [0] * len(rows)
    for number, box in enumerate(pack({s: len(v) for s, v in waiting.items()}, capacity)):
        for size in box:
            container[waiting[size].pop()] = number
    rows = rows.assign(container=[(shard << 32) + c for c in container])
    return rows[["limit_id", "capacity", "container", "doc_id", "piece", "tokens"]]


def pack_texts(documents: DataFrame, limits: DataFrame) -> DataFrame:
    """(limit_id, capacity, container, doc_id, piece, tokens) of each text or piece of `documents` (doc_id, n_tokens) for each of `limits` (limit_id, capacity)."""
    ship_package(documents.sparkSession)
    docs = documents.where("n_tokens > 0").select("doc_id", "n_tokens")
    shards = max(1, -(-docs.count() // SHARD_ITEMS))
    docs = docs.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).cast("int"))
    # each shard meets each capacity by its number
    wanted = limits.where("capacity > 0").select("limit_id", "capacity").distinct().withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    kind = lambda df, c: df.schema[c].dataType.simpleString()
    each = docs.join(broadcast_if_small(wanted, name="capacities"), "shard")
    pieces = F.expr("sequence(0, cast((n_tokens - 1) div capacity as int))")
    each = each.select("limit_id", "capacity", "shard", "doc_id", "n_tokens", F.explode(pieces).alias("piece"))
    each = each.withColumn("tokens", F.least(F.col("capacity"), F.col("n_tokens") - F.col("piece") * F.col("capacity")).cast("int")).drop("n_tokens")
    schema = f"limit_id {kind(limits, 'limit_id')}, capacity {kind(limits, 'capacity')}, container bigint, doc_id {kind(documents, 'doc_id')}, piece int, tokens int"
    return each.groupBy("limit_id", "capacity", "shard").applyInPandas(_pack_shard, schema)
