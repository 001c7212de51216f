"""N-gram Jaccard join: all texts with similar shingle sets, by a blocked sparse product.

The incidence matrix of documents by shingles is never multiplied as a whole.

1. Texts with the same set are one class, known by the hash of the set; only classes go on.
2. Shingles are put in an order, rarest first: by how often they stand, where that is much,
   and by how often their words do. Two sets with a similarity of ``threshold`` or
   more share a shingle among the first ``size - ceil(threshold * size) + 1`` of each, so
   only these columns are laid out, in blocks of columns. Within a column, classes whose sizes
   are too far apart to be linked, with nothing in between, part ways.
3. The classes of a column meet at one of them, the pivot, the one whose shingles are the most
   common; a large family of near copies so meets around its original, in most columns. For
   classes that only ever meet alone, the columns they share are counted; what two sets share
   beyond them is bounded by what is left of the set whose laid-out part ends first, and pairs
   below the bound from their sizes are discarded. The classes of a pivot then show their
   sketches: about a bit per shingle, each the parity of the shingles that fall on it. Two
   sketches differ in no more bits than their sets in shingles, so pairs that differ in too
   many are discarded, and no other. What remains connects classes to families.
4. The whole sets of a family are multiplied, which accumulates the overlaps of all pairs, and
   those below the bound from their sizes are discarded.

Products go block by block of classes and return a spanning forest, never a list of pairs. A
pivot or family with more classes than a block holds is multiplied block against block, but
only for classes that are not yet connected with its first block's, against all others.

Every link between different sets is found: its two ends share a column, hence a pivot, pass
the bound, and so are of one family, where they are compared unless they are known to be
connected already. The order of shingles decides on speed alone: it keeps unrelated texts
from sharing a column by chance. It comes from counts that leave out what is rare within each
task; tables of common shingles and words have at most ``common_kept`` rows.

Defined results: null, empty and blank texts have an empty set and are linked with nothing;
repeated rows are linked with each other; null ids take part and come back as null, and come
after all others where one row of a group is to stay; an empty table gives no rows; columns
other than ``doc_id`` and ``text`` are ignored. Sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import BROADCAST_ROWS, doc_columns, flat, free_name, map_batches, sent, slices, table, without
from tidewire.llm.components import components
from tidewire.llm.shingles import mix, shingle_sets, signatures, weighed_sets, word_hashes
from tidewire.plans.durable import durable


@dataclass(frozen=True)
class Settings:
    """Similarity as a fraction of whole numbers; the sizes bound what one task holds."""

    numerator: int = 75
    denominator: int = 100
    # Common shingles are counted in chunks; what stands less often in a chunk does not count.
    chunk_shingles: int = 2_000_000
    common_in_chunk: int = 4
    common_kept: int = 200_000
    block_postings: int = 1_500_000
    block_classes: int = 512
    block_shingles: int = 2_000_000
    columns_at_once: int = 4_096
    broadcast_rows: int = BROADCAST_ROWS

    def first(self, size: np.ndarray) -> np.ndarray:
        """How many of a set's first shingles must be laid out."""
        return size + (-size * self.numerator // self.denominator) + 1

    def linked(self, overlap, one, other):
        return self.denominator * overlap >= self.numerator * (one + other - overlap)


# --- classes and their rarest shingles ------------------------------------------------------


@dataclass(frozen=True)
class Frequencies:
    """How often common shingles and common words stand, by ascending hash."""

    shingles: np.ndarray
    shingle_counts: np.ndarray
    words: np.ndarray
    word_weights: np.ndarray

    @staticmethod
    def _found(known: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        if not len(known):
            return np.zeros(len(wanted), np.int64)
        place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        return np.where(known[place] == wanted, values[place], 0)

    def of_shingles(self, shingles: np.ndarray) -> np.ndarray:
        return self._found(self.shingles, self.shingle_counts, shingles)

    def of_words(self, words: np.ndarray) -> np.ndarray:
        return self._found(self.words, self.word_weights, words)


def _frequencies(docs: DataFrame, settings: Settings) -> Frequencies:
    """The ``common_kept`` most common shingles and words, about as often as they are.

    What stands less than ``common_in_chunk`` times in a chunk of a task does not count.
    """

    def run(batches):
        held: tuple[list, list] = ([], [])

        def counted():
            for kind in (0, 1):
                values, times = np.unique(np.concatenate(held[kind]), return_counts=True)
                often = times >= settings.common_in_chunk
                values, times = values[often].view(np.int64), times[often]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), kind, np.int32)), pa.array(values), pa.array(times)], names=["kind", "hash", "n"])
                held[kind].clear()

        size = 0
        for batch in batches:
            for part in slices(batch):
                raw, offsets = flat(part.column("text"))
                sets, _ = shingle_sets(raw, offsets)
                held[0].append(sets)
                held[1].append(word_hashes(raw, offsets)[0])
                size += len(sets)
                if size >= settings.chunk_shingles:
                    yield from counted()
                    size = 0
        if held[0]:
            yield from counted()

    often = map_batches(docs.select("text"), run, "kind int, hash bigint, n bigint").groupBy("kind", "hash").agg(F.sum("n").alias("n"))
    often = durable(often)

    def most(kind: int) -> tuple[np.ndarray, np.ndarray]:
        rows = often.where(F.col("kind") == kind).orderBy(F.desc("n"), "hash").limit(settings.common_kept).toPandas()
        values, counts = rows["hash"].to_numpy(np.int64).view(np.uint64), rows["n"].to_numpy(np.int64)
        order = np.argsort(values, kind="stable")
        return values[order], counts[order]

    words, counts = most(1)
    # Logarithms, so that their sum tells how often words like these meet by chance.
    return Frequencies(*most(0), words, np.round(np.log2(np.maximum(counts, 1)) * 16).astype(np.int64))


def sketches(sets: np.ndarray, size: np.ndarray) -> list[bytes]:
    """For every set the parities of its shingles over a power of two of bits, as many as it
    has shingles or up to twice as many. Half as many bits are the two halves' difference."""
    bits = np.int64(1) << np.ceil(np.log2(np.maximum(size, 64))).astype(np.int64)
    begins = np.cumsum(bits) - bits
    text = np.repeat(np.arange(len(size)), size)
    place = begins[text] + (sets & (bits[text] - 1).astype(np.uint64)).astype(np.int64)
    parity = (np.bincount(place, minlength=int(bits.sum())) & 1).astype(np.uint8)
    packed = np.packbits(parity, bitorder="little").tobytes()
    return [packed[b // 8 : (b + n) // 8] for b, n in zip(begins.tolist(), bits.tolist())]


def _classes(docs: DataFrame, settings: Settings) -> DataFrame:
    """Per row: doc_id, mark, n_shingles, class (null for an empty set), and, once per task and
    class, how common its shingles are, the ``first`` ones, and the sketch."""
    shared = docs.sparkSession.sparkContext.broadcast(_frequencies(docs, settings))

    def run(batches):
        known_counts = shared.value
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch):
                sets, size, weight = weighed_sets(*flat(part.column("text")), known_counts.of_words)
                names = signatures(sets, size).view(np.int64)
                text = np.repeat(np.arange(len(size)), size)
                times = known_counts.of_shingles(sets)
                order = np.lexsort((sets, weight, times, text))
                ends = np.cumsum(size)
                known = np.bincount(text, np.log1p(times), minlength=len(size)) / np.maximum(size, 1)
                ranked, begins = sets[order], ends - size
                take = settings.first(size)
                drawn = sketches(sets, size)
                blobs: list[bytes | None] = []
                for i, name in enumerate(names.tolist()):
                    if size[i] and name not in seen:
                        seen.add(name)
                        blobs.append(ranked[begins[i] : begins[i] + take[i]].tobytes())
                    else:
                        blobs.append(None)
                        drawn[i] = None
                columns = [pa.array(size), pa.array(names, mask=size == 0), pa.array(known.astype(np.float32)), pa.array(blobs, pa.binary()), pa.array(drawn, pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("mark"), *columns], names=_CLASS_COLUMNS)

    return map_batches(docs, run, "doc_id bigint, mark bigint, n_shingles bigint, class bigint, common float, first binary, sketch binary")


_CLASS_COLUMNS = ["doc_id", "mark", "n_shingles", "class", "common", "first", "sketch"]


# --- columns --------------------------------------------------------------------------------


def _meetings(classes: DataFrame, settings: Settings) -> DataFrame:
    """(pivot, class): classes that share a laid-out column, by the pivot they meet at.

    Two classes that only ever meet alone have all their overlap counted across blocks, and
    are discarded if it is below their bound. If they share another column with more classes
    as well, they meet at its pivot too.
    """
    laid = classes.where(F.col("first").isNotNull()).select("class", "n_shingles", "common", "first")
    postings = (laid.agg(F.sum(F.length("first"))).first()[0] or 0) // 8
    # Classes that share many columns meet once in every block: no more blocks than needed.
    blocks = postings // settings.block_postings + 1

    def lay_out(batches):
        for batch in (b.slice(i, 1 << 15) for b in batches for i in range(0, b.num_rows, 1 << 15)):
            raw, offsets = flat(batch.column("first"))
            shingle = raw.view(np.uint64) if len(raw) else np.zeros(0, np.uint64)
            row = np.repeat(np.arange(batch.num_rows), np.diff(offsets) // 8)
            block = (shingle % np.uint64(blocks)).astype(np.int64)
            # Half of a hash will do within a block: if two columns are taken for one, some
            # classes meet that need not.
            short = mix(shingle).astype("<u4")
            order = np.argsort(block, kind="stable")
            block, short, row = block[order], short[order], row[order]
            cuts = np.flatnonzero(np.diff(block, prepend=-1))
            name = np.asarray(batch.column("class"))
            size = np.asarray(batch.column("n_shingles")).astype("<u4")
            common = np.asarray(batch.column("common")).astype("<f4")
            columns: list[list] = [[], [], [], [], [], []]
            for a, b in zip(cuts, np.append(cuts[1:], len(block))):
                own, local = np.unique(row[a:b], return_inverse=True)
                blobs = (short[a:b], local.astype("<u2"), name[own], size[own], common[own])
                for column, value in zip(columns, (int(block[a]), *(x.tobytes() for x in blobs))):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), *(pa.array(c, pa.binary()) for c in columns[1:])], names=["block", "column", "local", "name", "size", "common"]
            )

    def meet(part: pa.Table) -> pa.Table:
        columns = {c: part.column(c).to_pylist() for c in part.column_names[1:]}
        shingle = np.concatenate([np.frombuffer(x, "<u4") for x in columns["column"]])
        owners = [(np.frombuffer(n, "<i8"), np.frombuffer(s, "<u4"), np.frombuffer(c, "<f4")) for n, s, c in zip(columns["name"], columns["size"], columns["common"])]
        local = [np.frombuffer(x, "<u2") for x in columns["local"]]
        name, size, common = (np.concatenate([o[k][i] for o, i in zip(owners, local)]) for k in range(3))
        size = size.astype(np.int64)
        order = np.lexsort((name, size, shingle))
        shingle, name, size, common = shingle[order], name[order], size[order], common[order]
        once = np.ones(len(name), bool)  # the same class, come from several tasks
        once[1:] = (shingle[1:] != shingle[:-1]) | (name[1:] != name[:-1])
        shingle, name, size, common = shingle[once], name[once], size[once], common[once]
        # A column parts where the next larger size is out of reach of the one before.
        fresh = np.ones(len(name), bool)
        fresh[1:] = (shingle[1:] != shingle[:-1]) | (settings.numerator * size[1:] > settings.denominator * size[:-1])
        column = np.cumsum(fresh) - 1
        several = np.bincount(column, minlength=1)[column] > 1 if len(column) else np.zeros(0, bool)
        column, name, common, size = column[several], name[several], common[several], size[several]
        order = np.lexsort((name, -common, column))
        column, name, size = column[order], name[order], size[order]
        heads = np.flatnonzero(np.diff(column, prepend=-1))
        members = np.diff(heads, append=len(column))
        head = np.repeat(heads, members)
        # Two classes alone in a column: how many such columns they have is their overlap here.
        alone = np.repeat(members, members) == 2
        met = np.stack([name[head], name, size[head], size], 1)
        pairs, times = np.unique(met[alone & (head != np.arange(len(name)))], axis=0, return_counts=True)
        others = np.unique(met[~alone], axis=0)
        rows = np.concatenate([pairs, others])
        overlap = np.concatenate([times, np.full(len(others), -1, np.int64)])
        return pa.table(dict(zip(("pivot", "class", "pivot_n", "n", "overlap"), (*rows.T, overlap))))

    blocked = map_batches(laid, lay_out, "block bigint, column binary, local binary, name binary, size binary, common binary")
    met = blocked.groupBy("block").applyInArrow(meet, "pivot bigint, class bigint, pivot_n bigint, n bigint, overlap bigint")
    met = met.groupBy("pivot", "class", "pivot_n", "n").agg(F.sum("overlap").alias("overlap"), (F.min("overlap") < 0).alias("more"))
    # The rest of the set whose laid-out part ends first bounds what two sets share beyond it.
    rest = F.ceil(F.greatest("pivot_n", "n") * settings.numerator / settings.denominator) - 1
    most = F.least(F.col("overlap") + rest, "pivot_n", "n")
    return met.where(F.col("more") | settings.linked(most, F.col("pivot_n"), F.col("n"))).select("pivot", "class", "more")


# --- products -------------------------------------------------------------------------------


def forest(names: np.ndarray, linked: np.ndarray, split: int | None = None) -> list[tuple[int, int]]:
    """A spanning forest over sets, from the matrix that tells which pairs are to be connected.

    With ``split``, only pairs of one of the first ``split`` sets and one of the others count.
    """
    count = len(names)
    if split is not None:
        linked[:split, :split] = False
        linked[split:, split:] = False
    found, left = [], np.ones(count, bool)
    for start in range(count):
        if not left[start]:
            continue
        left[start] = False
        open_rows = [start]
        while open_rows:
            near = np.flatnonzero(linked[open_rows.pop()] & left)
            left[near] = False
            found += [(int(names[start]), int(names[n])) for n in near]
            open_rows += near.tolist()
    return found


def linked_sets(rows: list[bytes], size: np.ndarray, settings: Settings) -> np.ndarray:
    """Which pairs of whole sets are linked: their product, over blocks of columns."""
    sets = [np.frombuffer(x, "<u8") for x in rows]
    count = len(sets)
    owner = np.repeat(np.arange(count), np.fromiter(map(len, sets), np.int64, count))
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], (np.cumsum(times > 1) - 1)[column[shared]]
    overlap = np.zeros((count, count), np.float32)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    wide = settings.columns_at_once
    cuts = np.searchsorted(column, np.arange(0, int(column[-1]) + 1 + wide, wide)) if len(column) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        part = np.zeros((count, int(column[b - 1] - column[a]) + 1), np.float32)
        part[owner[a:b], column[a:b] - column[a]] = 1
        overlap += part @ part.T
    return settings.linked(overlap.astype(np.int64), size[:, None], size[None, :])


def possibly_linked(rows: list[bytes], size: np.ndarray, settings: Settings) -> np.ndarray:
    """False only for pairs that cannot be linked: their sketches differ in too many bits."""
    words = np.fromiter((len(x) // 8 for x in rows), np.int64, len(rows))
    linked = np.zeros((len(rows), len(rows)), bool)
    for wide in np.unique(words):
        # Sizes that may be linked are at most a doubling of bits apart.
        own, other = np.flatnonzero(words == wide), np.flatnonzero((words == wide) | (words == 2 * wide))
        one = np.stack([np.frombuffer(rows[i], "<u8") for i in own])
        two = np.stack([_halved(np.frombuffer(rows[i], "<u8"), int(wide)) for i in other])
        for a in range(0, len(own), step := max(1, (1 << 22) // (len(other) * int(wide)))):
            differ = np.bitwise_count(one[a : a + step, None, :] ^ two[None, :, :]).sum(2, dtype=np.int64)
            n, m = size[own[a : a + step], None], size[None, other]
            most = np.minimum((n + m - differ) // 2, np.minimum(n, m))
            near = settings.linked(most, n, m)
            linked[np.ix_(own[a : a + step], other)] = near
            linked[np.ix_(other, own[a : a + step])] |= near.T
    return linked


def _halved(sketch: np.ndarray, words: int) -> np.ndarray:
    return sketch if len(sketch) == words else sketch[:words] ^ sketch[words:]


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows with the same keys together, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [np.asarray(batch.column(k)) for k in keys]
        fresh = np.zeros(batch.num_rows, bool)
        for c in columns:
            fresh[1:] |= c[1:] != c[:-1]
        fresh[0] = tuple(c[0] for c in columns) != last
        cuts = np.flatnonzero(fresh)
        last = tuple(c[-1] for c in columns)
        begin = 0
        for cut in cuts:
            if cut:
                held.append(batch.slice(begin, cut - begin))
            if held:
                yield pa.Table.from_batches(held)
            held, begin = [], cut
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def _multiply(units: DataFrame, judge, settings: Settings) -> DataFrame:
    """Links within each unit of (unit, side, class, n, row); with two sides, only across."""

    def run(batches):
        for part in _runs(batches, ["unit"]):
            side, names, size = (np.asarray(part.column(c).to_pylist(), np.int64) for c in ("side", "class", "n"))
            _, once = np.unique(np.stack([side, names], 1), axis=0, return_index=True)
            if len(once) < 2:
                continue
            rows = part.column("row").take(pa.array(once)).to_pylist()
            split = int((side[once] == 0).sum())
            found = forest(names[once], judge(rows, size[once], settings), split if split < len(once) else None)
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    parts = int(units.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_batches(units.repartition(parts, "unit").sortWithinPartitions("unit"), run, "a bigint, b bigint")


_UNIT_COLUMNS = ["unit", "side", "class", "n", "row"]
_UNIT_SCHEMA = "unit bigint, side int, class bigint, n bigint, row binary"


def _connect(members: DataFrame, fetch, judge, shingles_per_block: int, settings: Settings) -> DataFrame:
    """Links that connect, within every group, whatever ``judge`` connects.

    ``members``: group, class, doc_id (of one of its texts), n. ``fetch`` adds to rows with
    these the ``row`` of the class.
    """
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / settings.block_classes, F.sum("n") / shingles_per_block)).cast("int")
    groups = durable(members.groupBy("group").agg(blocks.alias("blocks")))
    part = F.pmod(F.xxhash64("class"), F.col("blocks").cast("long")).cast("int")
    held = durable(members.join(groups, "group").withColumn("block", part))
    columns = ["unit", "side", "class", "doc_id", "n"]

    def product(units: DataFrame) -> DataFrame:
        return durable(_multiply(fetch(sent(durable(units.select(*columns)), settings.broadcast_rows)), judge, settings))

    inside = held.withColumns({"unit": F.xxhash64("group", "block"), "side": F.lit(0)})
    links = product(inside)
    large = held.where("blocks > 1")
    if large.isEmpty():
        return links
    roots = durable(components(links)).select(F.col("node").alias("class"), "root")
    rooted = durable(large.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class")))
    # The component that holds most of the group's classes; it need not be compared with itself.
    sizes = rooted.groupBy("group", "root").agg(F.count(F.lit(1)).alias("held"))
    centre = durable(sizes.groupBy("group").agg(F.max_by("root", F.struct("held", "root")).alias("centre")))
    apart = durable(rooted.join(centre, "group").where("root <> centre"))
    rests = durable(apart.groupBy("group").agg(F.ceil(F.count(F.lit(1)) / settings.block_classes).cast("int").alias("rests")))
    # Every block of those apart against every block of all.
    left = apart.join(rests, "group").withColumns(
        {"i": F.pmod(F.xxhash64("class"), F.col("rests").cast("long")).cast("int"), "j": F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)), "side": F.lit(0)}
    )
    right = rooted.join(rests, "group").withColumns({"i": F.explode(F.sequence(F.lit(0), F.col("rests") - 1)), "j": F.col("block"), "side": F.lit(1)})
    keys = ["group", "i", "j", "side", "class", "doc_id", "n"]
    units = left.select(*keys).unionByName(right.select(*keys)).withColumn("unit", F.xxhash64("group", "i", "j"))
    return links.unionByName(product(units))


def _links(docs: DataFrame, classes: DataFrame, settings: Settings) -> DataFrame:
    """Enough links between classes to connect whatever links connect."""
    laid = classes.where(F.col("first").isNotNull())
    known = durable(laid.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("sketch").alias("row")))
    met = durable(_meetings(classes, settings))
    # A pivot is a member of its own group.
    met = met.select("pivot", "class").unionByName(met.select("pivot", F.col("pivot").alias("class"))).distinct()
    meetings = durable(met.withColumnRenamed("pivot", "group").join(known.drop("row"), "class"))

    def sketched(units: DataFrame) -> DataFrame:
        return known.select("class", "row").join(units, "class").select(*_UNIT_COLUMNS)

    def whole(units: DataFrame) -> DataFrame:
        def run(batches):
            for batch in batches:
                for part in slices(batch):
                    sets, size = shingle_sets(*flat(part.column("text")))
                    ends = np.cumsum(size)
                    own = signatures(sets, size).view(np.int64) == np.asarray(part.column("class"))
                    blobs = [sets[e - n : e].tobytes() for e, n in zip(ends, size)]
                    out = pa.RecordBatch.from_arrays([*(part.column(c) for c in _UNIT_COLUMNS[:4]), pa.array(blobs, pa.binary())], names=_UNIT_COLUMNS)
                    yield out.filter(pa.array(own))

        texts = docs.select(F.col("doc_id").alias("d"), "text").join(units, F.col("d").eqNullSafe(F.col("doc_id")))
        return map_batches(texts.select("unit", "side", "class", "n", "text"), run, _UNIT_SCHEMA)

    may = _connect(meetings, sketched, possibly_linked, settings.block_shingles * 32, settings)
    families = durable(components(may)).select(F.col("node").alias("class"), F.col("root").alias("group"))
    return _connect(families.join(known.drop("row"), "class"), whole, linked_sets, settings.block_shingles, settings)


def _grouped(docs: DataFrame, settings: Settings) -> DataFrame:
    """Per row: doc_id, mark (a hash of its text), n_shingles, class, and its component by a
    class (root) and by its smallest doc_id; those of an empty set are null."""
    texts = doc_columns(docs).withColumn("mark", F.xxhash64("text"))
    classes = durable(_classes(texts, settings))
    roots = components(_links(texts, classes, settings))
    smallest = classes.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("smallest"))
    rooted = durable(
        smallest.join(roots.select(F.col("node").alias("class"), "root"), "class", "left").select("class", "smallest", F.coalesce("root", "class").alias("root"))
    )
    least = durable(rooted.groupBy("root").agg(F.min("smallest").alias("component_id")))
    found = durable(rooted.join(least, "root").select("class", "root", "component_id"))
    return classes.select("doc_id", "mark", "n_shingles", "class").join(found, "class", "left")


def similar_groups(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (the smallest doc_id reachable by links)."""
    component = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return _grouped(docs, settings).select("doc_id", "n_shingles", component.alias("component_id"))


def one_of_each_group(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row of ``docs`` for each group, that with the smallest id (of texts with the same
    id, one), and all rows without words."""
    grouped = durable(_grouped(docs, settings).where("root is not null").select("doc_id", "mark", "root"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "mark")).alias("first")
    groups = durable(grouped.groupBy("root").agg(first, F.count(F.lit(1)).alias("rows")).where("rows > 1"))
    members = grouped.join(sent(groups.select("root", F.col("first.doc_id").alias("first_id"), F.col("first.mark").alias("first_mark")), settings.broadcast_rows), "root")
    stays = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("mark") == F.col("first_mark"))
    gone = durable(members.where(~stays).select("doc_id", "mark").distinct())
    # The row that stays may stand several times.
    often = durable(members.where(stays).groupBy("doc_id", "mark").count().where("count > 1").select("doc_id", "mark"))
    mark = free_name(docs, "mark")
    marked = docs.withColumn(mark, F.xxhash64(F.col("text").cast("string")))
    keys = ["doc_id", mark]
    gone, often = (x.withColumnRenamed("mark", mark) for x in (gone, often))
    left = without(marked, gone, *keys)
    once = without(left, often, *keys)
    again = left.join(sent(often), left["doc_id"].eqNullSafe(often["doc_id"]) & (left[mark] == often[mark]), "left_semi").dropDuplicates(keys)
    return once.select(*docs.columns).unionByName(again.select(*docs.columns))


def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar_groups(table(spark, folder, "documents"))
