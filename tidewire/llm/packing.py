"""Packing documents into training sequences by non-negative least squares.

Documents become ids of a public tokenizer and an end id; what is longer than a window is cut
into whole windows and a rest. The lengths of the pieces make a histogram of a few hundred
bins, whatever the corpus. Shallow combinations of bins that fill a window are enumerated,
their repeat counts are solved against the histogram by non-negative least squares and
rounded down, and what is left is packed greedily, largest first, again as combinations with
repeat counts. The recipe is therefore small; it tells for the n-th piece of a bin which
sequence it goes to, and Spark numbers the pieces of a bin in salted parts.

Bins are exact up to ``exact_up_to`` ids and ``bin_width`` wide above, rounded up, so a
sequence never overflows and a filled one lacks less than a bin per long piece.

Defined results: a null or empty text is one piece with the end id alone; a row that stands
twice is packed twice; null ids stay null; an empty table gives no pieces.
"""

from __future__ import annotations

import bisect
import itertools
import os
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm.common import appended, doc_columns, flat, map_batches, slices, table
from tidewire.plans.durable import durable


@dataclass(frozen=True)
class Settings:
    window: int = 4096
    end_id: int = 2
    tokenizer: str = "word_bpe_49k.json"
    exact_up_to: int = 256
    bin_width: int = 16
    cached_words: int = 600_000


# --- ids ------------------------------------------------------------------------------------


# Letters of ASCII and Latin-1, which make one word to this tokenizer.
_LETTERS = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
# Signs behind a letter up to white space are a word of their own to this tokenizer. An
# apostrophe may be part of a short form, a bracket of a special token.
_SPACE, _SMALL, _SIGN = 1, 2, 3
_FORMS = {_SPACE: rb"[ \t-\r]", _SMALL: rb"[a-z]", _SIGN: rb"[!-&(-/:;=?@\[-`{-~]"}
_KINDS = bytes(next((k for k, form in _FORMS.items() if re.match(form, bytes([b]))), 0) for b in range(256))


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, one behind the other, and how many each text has."""
    # Case does not matter to the ids, except in the names of special tokens.
    named = np.array([b"<|" in t for t in texts], bool)
    data = b"".join([t if n else t.lower() for t, n in zip(texts, named)]) + b" "
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    kind = np.frombuffer(data.translate(_KINDS), np.uint8)
    edge = np.zeros(len(data), bool)
    edge[at] = True

    def goes_on(mask: np.ndarray) -> np.ndarray:
        return mask[1:] & mask[:-1] & ~edge[1:]

    inside, sign = kind != _SPACE, kind == _SIGN
    opens = inside.copy()
    opens[1:] &= ~goes_on(inside)
    begin, last = sign.copy(), sign.copy()
    begin[1:] &= ~goes_on(sign)
    last[:-1] &= ~goes_on(sign)
    begin, end = np.flatnonzero(begin), np.flatnonzero(last) + 1
    tail = ~edge[begin] & (kind[begin - 1] == _SMALL) & (edge[end] | (kind[end] == _SPACE))
    if named.any():
        tail &= ~named[np.searchsorted(at, begin, side="right") - 1]
    opens[begin[tail]] = True
    letters = np.frombuffer(data, np.uint8)[inside]
    offsets = np.append(np.flatnonzero(opens[inside]), len(letters))
    words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return words, np.diff(np.searchsorted(np.flatnonzero(opens), at))


class Encoder:
    """Ids of texts, word by word: this tokenizer never joins what white space parts.

    Ids of words seen are kept, as ranges of one pool, and forgotten all at once when more than
    ``cached_words`` would be known. The words of one call are then learned together, so they
    are all known at its end, however many they are.
    """

    def __init__(self, settings: Settings):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        name = settings.tokenizer
        self.tokenizer = Tokenizer.from_file(name if os.path.isabs(name) else public_tokenizers.path(name))
        self.is_last = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.is_last[number] = token.endswith("</w>")
        self.limit = settings.cached_words
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.pool = np.zeros(1 << 16, np.uint32)
        self.begins = np.zeros(1 << 14, np.int64)
        self.used = 0

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> None:
        simple, others = [], []
        for word in words:
            (simple if word.isalpha() or _LETTERS.fullmatch(word) else others).append(word)
        words = simple + others
        # Words of letters are encoded as texts of many; the last id of a word is marked as such.
        texts = [b" ".join(simple[i : i + 200]).decode() for i in range(0, len(simple), 200)]
        ids = np.fromiter(itertools.chain.from_iterable(self._ids(texts)), np.uint32)
        ends = np.flatnonzero(self.is_last[ids]) + 1 if len(ids) else np.zeros(0, np.int64)
        found = self._ids([w.decode() for w in others])
        lengths = np.concatenate([np.diff(ends, prepend=0), np.fromiter(map(len, found), np.int64, len(found))])
        ids = np.concatenate([ids, np.fromiter(itertools.chain.from_iterable(found), np.uint32)])
        first, stop = len(self.number), self.used + len(ids)
        while len(self.pool) < stop:
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while len(self.begins) < first + len(words) + 1:
            self.begins = np.concatenate([self.begins, np.zeros_like(self.begins)])
        self.pool[self.used : stop] = ids
        self.begins[first : first + len(words) + 1] = self.used + np.concatenate([[0], np.cumsum(lengths)])
        self.used = stop
        self.number.update(zip(words, range(first, first + len(words))))

    def _look_up(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.number.get, words, itertools.repeat(-1)), np.int64, len(words))

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids with an end id behind every text, and the number of ids per text."""
        words, counts = words_of(texts)
        coded = words.dictionary_encode()
        raw, at = flat(coded.dictionary)
        data, at = raw.tobytes(), at.tolist()
        different = [data[a:b] for a, b in zip(at, at[1:])]
        which = self._look_up(different)
        if (new := np.flatnonzero(which < 0)).size:
            if len(self.number) + len(new) > self.limit:
                self._forget()
                new = np.arange(len(different))
            unknown = [different[i] for i in new]
            self._learn(unknown)
            which[new] = self._look_up(unknown)
        assert (which >= 0).all(), "a word has no ids"
        which = which[coded.indices.to_numpy()]
        begins = self.begins[which]
        lengths = self.begins[which + 1] - begins
        ends = np.concatenate([[0], np.cumsum(lengths)])
        ids = self.pool[np.arange(ends[-1]) + np.repeat(begins - ends[:-1], lengths)]
        stops = ends[np.concatenate([[0], np.cumsum(counts)])]
        return np.insert(ids, stops[1:], end_id).astype("<u4"), np.diff(stops) + 1


_encoders: dict[Settings, Encoder] = {}


def cut(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Pieces of at most a window: doc_id, start, length, doc_tokens, ids (32-bit little-endian)."""
    window = settings.window

    def run(batches):
        if settings not in _encoders:
            _encoders[settings] = Encoder(settings)
        encoder = _encoders[settings]
        for batch in batches:
            for part in slices(batch):
                raw, at = flat(part.column("text"))
                data = raw.tobytes()
                ids, tokens = encoder.encode([data[a:b] for a, b in zip(at[:-1], at[1:])], settings.end_id)
                count = -(-tokens // window)
                row = np.repeat(np.arange(len(tokens)), count)
                first = np.cumsum(count) - count
                start = (np.arange(len(row)) - first[row]) * window
                length = np.minimum(window, tokens[row] - start)
                offsets = np.concatenate([[0], np.cumsum(length) * 4]).astype(np.int32)
                blobs = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)), pa.array(start), pa.array(length), pa.array(tokens[row]), blobs],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    return map_batches(doc_columns(docs), run, "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary")


# --- the recipe -----------------------------------------------------------------------------


def bin_of(length, settings: Settings):
    """The bin of a length, as the longest length in it; for columns and for integers."""
    return -(-length // settings.bin_width) * settings.bin_width if length > settings.exact_up_to else length


def combinations(bins: list[int], settings: Settings) -> list[tuple[int, ...]]:
    """One to three bins that fill a window to less than a bin's width."""
    window, least = settings.window, settings.window - settings.bin_width + 1
    large = [b for b in bins if b > settings.exact_up_to]
    known = set(large)
    out = [(b,) for b in large if b >= least]
    step = settings.bin_width
    for i, a in enumerate(large):
        for b in large[i:]:
            if a + b > window:
                break
            if a + b >= least:
                out.append((a, b))
            third = (window - a - b) // step * step
            if third >= b and third in known:
                out.append((a, b, third))
    return out


def nnls(matrix: np.ndarray, target: np.ndarray, rounds: int = 300) -> np.ndarray:
    """x >= 0 with the least ||matrix x - target||, by the active-set method."""
    x = np.zeros(matrix.shape[1])
    active = np.zeros(len(x), bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(matrix.T @ target).max(initial=0)))
    for _ in range(rounds if len(x) else 0):
        gradient = np.where(active, -np.inf, matrix.T @ (target - matrix[:, active] @ x[active]))
        best = int(np.argmax(gradient))
        if gradient[best] <= tolerance:
            break
        active[best] = True
        while active.any():
            own = np.flatnonzero(active)
            part = matrix[:, own]
            # The little ridge keeps columns that say the same from being singular.
            step = np.linalg.solve(part.T @ part + 1e-10 * np.eye(len(own)), part.T @ target)
            low = step <= 0
            if not low.any():
                x[:] = 0
                x[own] = step
                break
            share = np.min(x[own][low] / np.maximum(x[own][low] - step[low], 1e-300))
            x[own] += share * (step - x[own])
            gone = own[low & (x[own] <= 1e-9)]
            if not len(gone):
                gone = own[low][:1]
            active[gone], x[gone] = False, 0
    return x


def recipe(histogram: dict[int, int], settings: Settings) -> list[tuple[list[tuple[int, int]], int]]:
    """Combinations with repeat counts that use up the histogram: ([(bin, times)], repeats)."""
    left = {b: n for b, n in sorted(histogram.items()) if n > 0}
    out: list[tuple[list[tuple[int, int]], int]] = []

    def use(counts: list[tuple[int, int]], repeats: int) -> None:
        out.append((counts, repeats))
        for b, times in counts:
            left[b] -= times * repeats
            if not left[b]:
                del left[b]

    bins = list(left)
    ways = combinations(bins, settings)
    if ways:
        place = {b: i for i, b in enumerate(bins)}
        matrix = np.zeros((len(bins), len(ways)))
        for column, way in enumerate(ways):
            for b in way:
                matrix[place[b], column] += 1
        weight = np.array(bins)[:, None] / settings.window  # an id left over counts the same in any bin
        solved = nnls(matrix * weight, np.array([left[b] for b in bins]) * weight[:, 0])
        for column in np.argsort(-solved, kind="stable"):
            counts = [(b, ways[column].count(b)) for b in sorted(set(ways[column]), reverse=True)]
            repeats = min(int(solved[column] + 1e-6), *(left.get(b, 0) // n for b, n in counts))
            if repeats > 0:
                use(counts, repeats)
    order = sorted(left)
    while left:
        gap, counts = settings.window, []
        upto = len(order)
        while gap and upto:
            upto = bisect.bisect_right(order, gap, 0, upto)
            if not upto:
                break
            b = order[upto - 1]
            times = min(gap // b, left[b])
            counts.append((b, times))
            gap -= b * times
            upto -= 1
        use(counts, min(left[b] // times for b, times in counts))
        order = [b for b in order if b in left]
    return out


@dataclass(frozen=True)
class Slots:
    """The recipe by bin and number: from ``key`` on, ``times`` pieces per sequence go to the
    sequences from ``sequence`` on, at places from ``place`` on."""

    key: np.ndarray
    sequence: np.ndarray
    times: np.ndarray
    place: np.ndarray


_KEY_SHIFT = 46


def slots(plan: list[tuple[list[tuple[int, int]], int]]) -> Slots:
    rows, taken, sequence = [], {}, 0
    for counts, repeats in plan:
        place = 0
        for b, times in counts:
            rows.append(((b << _KEY_SHIFT) + taken.get(b, 0), sequence, times, place))
            taken[b] = taken.get(b, 0) + times * repeats
            place += times
        sequence += repeats
    columns = np.array(sorted(rows), np.int64).reshape(-1, 4).T
    return Slots(*columns)


# --- placing --------------------------------------------------------------------------------


def place(pieces: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``pieces`` (with ``doc_id``, ``start`` and ``length``) with sequence_id and offset.

    ``pieces`` should be cheap to read again and carry no ids: it is counted, numbered and
    sorted. Pieces of one bin are numbered in as many parts as a shuffle has partitions, so
    no bin is one task's work.
    """
    spark = pieces.sparkSession
    names = pieces.columns
    width, exact = settings.bin_width, settings.exact_up_to
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    binned = pieces.withColumns(
        {
            "_bin": F.when(F.col("length") > exact, F.ceil(F.col("length") / width) * width).otherwise(F.col("length")),
            "_salt": F.pmod(F.xxhash64("doc_id", "start"), F.lit(parts)),
        }
    )
    counted = durable(binned.groupBy("_bin", "_salt").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r["_bin"]: r["n"] for r in counted.groupBy("_bin").agg(F.sum("n").alias("n")).collect()}
    shared = spark.sparkContext.broadcast(slots(recipe(histogram, settings)))
    before = Window.partitionBy("_bin").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counted.select("_bin", "_salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    # Pieces of repeated ids come in one order, too, so that a retry numbers them alike.
    order = [c for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens") if c in names]
    inside = Window.partitionBy("_bin", "_salt").orderBy(*order)
    numbered = (
        binned.withColumn("_number", F.row_number().over(inside) - 1)
        .join(bases, ["_bin", "_salt"])
        .select(*names, "_bin", (F.col("_base") + F.col("_number")).alias("_number"))
    )

    def run(batches):
        own = shared.value
        for batch in batches:
            key = (np.asarray(batch.column("_bin")).astype(np.int64) << _KEY_SHIFT) + np.asarray(batch.column("_number"))
            row = np.searchsorted(own.key, key, side="right") - 1
            nth = key - own.key[row]
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(own.sequence[row] + nth // own.times[row]), pa.array(own.place[row] + nth % own.times[row])],
                names=[*names, "sequence_id", "_place"],
            )

    placed = map_batches(numbered, run, appended(pieces.schema, "sequence_id bigint, _place bigint"))
    earlier = Window.partitionBy("sequence_id").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(*names, "sequence_id", F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("offset"))


def pack(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Pieces with their ids and where they go; ``doc_id`` must be unique here, since the ids
    are joined to the placed pieces by (doc_id, start)."""
    pieces = durable(cut(docs, settings))
    where = place(pieces.select("doc_id", "start", "length"), settings).drop("length")
    same = F.col("p.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("p.start") == F.col("w.start"))
    return pieces.alias("p").join(where.alias("w"), same).select("p.*", "sequence_id", "offset")


def placed_pieces(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per piece with the checksum of its ids instead of the ids."""
    pieces = cut(docs, settings)
    return place(durable(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")), settings)


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return placed_pieces(table(spark, folder, "documents"))
