"""Near duplicates by SimHash, with a self-join of binary tries of fingerprints.

A fingerprint has 64 bits; bit i is set if it is set in over half of the XXH64 hashes of the
text's word shingles, repeats included. Documents link when their fingerprints differ in at
most ``errors`` bits.

Equal fingerprints are one before anything is compared. Fingerprints are the leaves of a binary
trie, and the join walks down pairs of nodes: a pair has as its errors the bits in which the
two ways down differ, and is left as soon as they are more than allowed. Of five blocks of bits
two linked fingerprints agree in one at least, so there are five tries, each with another block
of bits on top, and in each only nodes that agree in the first ``top`` bits are paired: these
pairs are the units that Spark deals out, and a fingerprint is sent five times. A unit of more
than ``unit_rows`` fingerprints is taken four levels down, into units of its children, by joins
of Spark's, until it is small enough; one common block is so never one task.

In a task, a trie is its sorted fingerprints and a node a range of them. Pairs of nodes go down
level by level as arrays. Pairs whose nodes hold few fingerprints are compared at once; pairs
that cannot exceed the errors any more are linked as a whole; pairs of nodes that are wholly of
one component already are left, so a crowd of near copies costs a tree of links, not its pairs.

Defined results: a text without words, null or empty, has fingerprint 0, which links like any
other; null ids take part and come back as null, and are no component's name if it has another
id; repeated rows are linked; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import doc_columns, flat, map_batches, sent, slices, table
from tidewire.llm.components import components
from tidewire.llm.shingles import mix
from tidewire.plans.durable import durable

BITS = 64


@dataclass(frozen=True)
class Settings:
    words: int = 4
    seed: int = 42
    errors: int = 4
    # Levels of a trie above its units, and fingerprints that a unit, and a task at once, holds.
    top: int = 12
    unit_rows: int = 1 << 20
    held_rows: int = 1 << 20
    # Pairs of nodes taken down a level at once, and pairs of fingerprints compared at once.
    pairs_at_once: int = 1 << 16
    few: int = 32

    def turns(self) -> list[int]:
        """How far fingerprints are turned so that each block of bits comes on top once."""
        blocks = self.errors + 1
        return [BITS * i // blocks for i in range(blocks)]


# --- fingerprints ---------------------------------------------------------------------------

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def shingle_hashes(text: bytes, settings: Settings) -> Iterator[np.ndarray]:
    """Hashes of all shingles of a text, repeats included, in arrays of bounded length."""
    words = text.translate(_LOWER).split()
    # split() parts at what the contract parts at: blank, tab, line ends and their like.
    hashed, seed, k = xxhash.xxh64_intdigest, settings.seed, settings.words
    if len(words) < k:
        if words:
            yield np.array([hashed(b" ".join(words), seed)], np.uint64)
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    for a in range(0, len(words) - k + 1, 1 << 16):
        some = zip(starts[a : min(a + (1 << 16), len(words) - k + 1)].tolist(), ends[a + k - 1 :].tolist())
        yield np.array([hashed(joined[s:e], seed) for s, e in some], np.uint64)


def fingerprint(text: bytes, settings: Settings = Settings()) -> int:
    ones, count = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text, settings):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
        count += len(hashes)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, value): the fingerprint of every row, as a signed number."""

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                raw, offsets = flat(part.column("text"))
                data, at = raw.tobytes(), offsets.tolist()
                found = np.array([fingerprint(data[a:b], settings) for a, b in zip(at, at[1:])], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "value"])

    return map_batches(doc_columns(docs), run, "doc_id bigint, value bigint")


# --- the trie join of one task ----------------------------------------------------------------


class Trie:
    """Sorted fingerprints of many units that all begin at ``depth``; finds a forest of links."""

    def __init__(self, values: np.ndarray, settings: Settings):
        self.values, self.settings = values, settings
        self.root = np.arange(len(values))
        self.links: list[tuple[np.ndarray, np.ndarray]] = []
        self._see()

    def _see(self) -> None:
        """How often components change along the sorted fingerprints: equal counts, one component."""
        self.changes = np.concatenate([[0], np.cumsum(self.root[1:] != self.root[:-1])])

    def _union(self, a: np.ndarray, b: np.ndarray) -> None:
        """Connects a[i] with b[i]; only links that join components are kept."""
        changed = False
        while True:
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                break
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            low, high = np.minimum(x, y), np.maximum(x, y)
            # Each component is hooked to one smaller one at a time, so no ring can come up.
            hooked, first = np.unique(high, return_index=True)
            self.links.append((a[first], b[first]))
            parent = np.arange(len(self.root))
            parent[hooked] = low[first]
            while True:
                further = parent[parent]
                if (further == parent).all():
                    break
                parent = further
            self.root = parent[self.root]
            changed = True
        if changed:
            self._see()

    def _open(self, nodes: np.ndarray) -> np.ndarray:
        """Pairs that may still join components."""
        one = (self.changes[nodes[:, 1] - 1] == self.changes[nodes[:, 0]]) & (self.changes[nodes[:, 3] - 1] == self.changes[nodes[:, 2]])
        return nodes[~(one & (self.root[nodes[:, 0]] == self.root[nodes[:, 2]]))]

    def _compare(self, nodes: np.ndarray) -> None:
        """All fingerprints of one node with all of the other."""
        for start in range(0, len(nodes), self.settings.pairs_at_once // self.settings.few + 1):
            part = nodes[start : start + self.settings.pairs_at_once // self.settings.few + 1]
            wide = part[:, 3] - part[:, 2]
            size = (part[:, 1] - part[:, 0]) * wide
            own = np.repeat(np.arange(len(part)), size)
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            a, b = part[own, 0] + step // wide[own], part[own, 2] + step % wide[own]
            near = (a != b) & (np.bitwise_count(self.values[a] ^ self.values[b]) <= self.settings.errors)
            self._union(a[near], b[near])

    def _whole(self, nodes: np.ndarray) -> None:
        """Pairs in which everything is linked with everything."""
        for lo, hi in ((0, 1), (2, 3)):
            size = nodes[:, hi] - nodes[:, lo]
            all_ = np.repeat(nodes[:, lo] - np.cumsum(size) + size, size) + np.arange(size.sum())
            self._union(np.repeat(nodes[:, 0 if lo else 2], size), all_)

    def _down(self, nodes: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """Children of pairs of nodes at ``depth``: those with others, those with themselves."""
        bit = np.uint64(1) << np.uint64(BITS - 1 - depth)
        ones = np.concatenate([[0], np.cumsum((self.values & bit) != 0)])

        def split(lo, hi):
            return hi - (ones[hi] - ones[lo])

        a, b, c, d, errors = nodes.T
        ab, cd = split(a, b), split(c, d)
        same = a == c
        both = np.concatenate([np.stack([a, ab, c, cd, errors], 1), np.stack([ab, b, cd, d, errors], 1)])
        across = np.concatenate([np.stack([a, ab, cd, d, errors + 1], 1), np.stack([ab, b, c, cd, errors + 1], 1)[~same]])
        full = lambda n: n[(n[:, 0] < n[:, 1]) & (n[:, 2] < n[:, 3])]
        return full(across[across[:, 4] <= self.settings.errors]), full(both)

    def join(self, nodes: np.ndarray, depth: int) -> None:
        """``nodes``: rows of (begin, end) of one node, (begin, end) of another, errors."""
        limit = self.settings.pairs_at_once
        waiting = [(nodes, depth)]
        while waiting:
            nodes, depth = waiting.pop()
            if len(nodes) > limit:
                waiting += [(nodes[i : i + limit], depth) for i in range(0, len(nodes), limit)]
                continue
            nodes = self._open(nodes[(nodes[:, 0] != nodes[:, 2]) | (nodes[:, 1] - nodes[:, 0] > 1)])
            all_linked = nodes[:, 4] + (BITS - depth) <= self.settings.errors
            self._whole(nodes[all_linked])
            nodes = nodes[~all_linked]
            few = (nodes[:, 1] - nodes[:, 0]) * (nodes[:, 3] - nodes[:, 2]) <= self.settings.few
            self._compare(nodes[few])
            nodes = nodes[~few]
            if len(nodes):
                across, both = self._down(nodes, depth)
                # Nodes with themselves come first: what they join need not be compared across.
                waiting += [(n, depth + 1) for n in (across, both) if len(n)]


# --- units ------------------------------------------------------------------------------------


def _turned(settings: Settings) -> Column:
    """A fingerprint once for each block of bits, turned so that the block is on top."""
    value = F.col("value")
    return F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(i).alias("turn"),
                    (F.shiftleft(value, n).bitwiseOR(F.shiftrightunsigned(value, BITS - n)) if n else value).alias("turned"),
                )
                for i, n in enumerate(settings.turns())
            )
        )
    )


_UNIT = ["turn", "one", "other"]


def _units(values: DataFrame, settings: Settings) -> Iterator[tuple[DataFrame, int]]:
    """Units (turn, one, other: the beginnings of two nodes) with their fingerprints (turned),
    small enough for a task, and the depth of their nodes."""
    depth = settings.top
    rows = values.select(_turned(settings).alias("t")).select("t.turn", F.shiftrightunsigned("t.turned", BITS - depth).alias("one"), "t.turned")
    rows = rows.select("turn", "one", F.col("one").alias("other"), "turned")
    while True:
        rows = durable(rows)
        mine = F.shiftrightunsigned("turned", BITS - depth) == F.col("one")
        sizes = durable(rows.groupBy(*_UNIT).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(mine, 1)).alias("n_one")))
        # A pair of nodes needs both, a node with itself two fingerprints.
        alive = sizes.where(F.when(F.col("one") == F.col("other"), F.col("n") > 1).otherwise((F.col("n_one") > 0) & (F.col("n_one") < F.col("n"))))
        large = durable(alive.where(F.col("n") > settings.unit_rows).select(*_UNIT))
        small = alive.where(F.col("n") <= settings.unit_rows).select(*_UNIT)
        if large.isEmpty():
            yield rows, depth
            return
        yield rows.join(sent(durable(small)), _UNIT, "left_semi"), depth
        step = min(4, BITS - depth)
        inside = rows.join(sent(large), _UNIT)
        child = F.shiftrightunsigned("turned", BITS - depth - step).bitwiseAND(F.lit((1 << step) - 1))
        first = F.shiftrightunsigned("turned", BITS - depth) == F.col("one")
        near = inside.withColumns({"child": child, "first": first, "with": F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit((1 << step) - 1).cast("bigint")))})
        errors = F.bit_count(F.col("one").bitwiseXOR(F.col("other"))) + F.bit_count(F.col("child").bitwiseXOR(F.col("with")))
        near = near.where(errors <= settings.errors)
        alone = F.col("one") == F.col("other")
        below = lambda node, c: F.shiftleft(node, step).bitwiseOR(c)
        ends = F.when(alone, F.least("child", "with")).when(F.col("first"), F.col("child")).otherwise(F.col("with"))
        others = F.when(alone, F.greatest("child", "with")).when(F.col("first"), F.col("with")).otherwise(F.col("child"))
        rows = near.select("turn", below(F.col("one"), ends).alias("one"), below(F.col("other"), others).alias("other"), "turned")
        depth += step


def _links(units: DataFrame, depth: int, settings: Settings) -> DataFrame:
    """(a, b): a forest of links within the units; ends are named by a mix of their bits."""
    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turns = np.array(settings.turns(), np.uint64)

    def run(batches):
        def joined(held: pa.Table):
            turn, one, other = (held.column(c).to_numpy() for c in _UNIT)
            turned = held.column("turned").to_numpy().view(np.uint64)
            order = np.lexsort((turned, other.view(np.uint64), one.view(np.uint64), turn))
            turn, one, other, turned = turn[order], one[order], other[order], turned[order]
            begins = np.flatnonzero(np.concatenate([[True], (turn[1:] != turn[:-1]) | (one[1:] != one[:-1]) | (other[1:] != other[:-1])]))
            ends = np.append(begins[1:], len(turned))
            mine = np.concatenate([[0], np.cumsum((turned >> np.uint64(BITS - depth)).view(np.int64) == one)])
            parted = begins + mine[ends] - mine[begins]
            alone = one[begins] == other[begins]
            errors = np.bitwise_count((one ^ other)[begins].view(np.uint64)).astype(np.int64)
            nodes = np.stack([begins, np.where(alone, ends, parted), np.where(alone, begins, parted), ends, errors], 1)
            trie = Trie(turned, settings)
            trie.join(nodes[(nodes[:, 0] < nodes[:, 1]) & (nodes[:, 2] < nodes[:, 3])], depth)
            back = turns[turn]
            own = mix(np.where(back == 0, turned, (turned >> back) | (turned << (np.uint64(BITS) - back)))).view(np.int64)
            for a, b in trie.links:
                yield pa.RecordBatch.from_arrays([pa.array(own[a]), pa.array(own[b])], names=["a", "b"])

        for held in _filled(batches, settings.held_rows):
            yield from joined(held)

    return map_batches(units.repartition(parts, *_UNIT).sortWithinPartitions(*_UNIT), run, "a bigint, b bigint")


def _filled(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Whole units together, about ``rows`` rows at once, from batches sorted by unit."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in _UNIT], 1)
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(1))
        if not len(cuts):
            continue  # one unit goes on; its size is bounded
        cut = int(cuts[-1]) + 1
        yield pa.Table.from_batches([*held[:-1], batch.slice(0, cut)])
        held, size = [batch.slice(cut)], batch.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


# --- results ----------------------------------------------------------------------------------


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row: doc_id, value (its fingerprint), component_id (the smallest doc_id reachable)."""
    rows = durable(fingerprints(docs, settings))
    groups = durable(rows.groupBy("value").agg(F.min("doc_id").alias("smallest"), F.count(F.lit(1)).alias("n")))
    links = None
    for units, depth in _units(groups.select("value"), settings):
        found = durable(_links(units, depth, settings))
        links = found if links is None else links.unionByName(found)
    roots = components(links)
    # The name of a fingerprint, as the links have it.
    names = map_batches(groups, _named, "value bigint, smallest bigint, n bigint, name bigint")
    linked = durable(names.join(roots.withColumnRenamed("node", "name"), "name"))
    least = linked.groupBy("root").agg(F.min("smallest").alias("component_id"))
    # Only fingerprints with another row or another fingerprint beside them need to be told.
    told = linked.join(least, "root").select("value", "component_id")
    several = groups.where("n > 1").join(told.select("value"), "value", "left_anti").select("value", F.col("smallest").alias("component_id"))
    found = durable(told.unionByName(several))
    return rows.join(sent(found), "value", "left").select("doc_id", "value", F.coalesce("component_id", "doc_id").alias("component_id"))


def _named(batches):
    for batch in batches:
        name = mix(batch.column("value").to_numpy().view(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(name)], names=[*batch.schema.names, "name"])


def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("value"), 16, "0")).alias("fingerprint"), "component_id")
