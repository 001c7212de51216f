"""Toxicity by logistic regression, trained with FTRL-proximal.

Words, pairs of neighbouring words, pairs with one word between them and beginnings of words
are hashed into 2^``bits`` coordinates. Words and pairs count as present or not; beginnings,
which stand for the inflected and compound forms of a word, count by how often they come, in
proportion to the words of the text. FTRL-proximal gives every coordinate a rate of its own
and, by its L1 term, leaves most weights at exactly zero. What is left is a short list of
coordinates and weights, small enough to broadcast at any corpus size.

Training goes over a bounded sample in shards, each one task that streams its rows through
the optimiser; a coordinate takes part once ``least_rows`` rows of a shard hold it. The
shards' weights are averaged.

Defined results: texts without words, null and empty ones among them, score by the bias
alone; without labels of both classes every score is 0.5.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import appended, crc_of_id, doc_columns, map_batches, slices, strings, table
from tidewire.llm.sampling import labelled_sample

_WORD = re.compile(r"[^\W\d_]+")
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))


@dataclass(frozen=True)
class Settings:
    """``rows_per_class`` bounds the sample; a shard takes about ``rows_per_shard`` of it."""

    bits: int = 20
    rows_per_class: int = 8_000
    rows_per_shard: int = 2_500
    epochs: int = 6
    least_rows: int = 5
    share_scale: float = 60.0
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 12.0
    l2: float = 1.0
    threshold: float = 0.7
    cached_words: int = 500_000


# Lengths of the beginnings of words that are coordinates too.
_BEGINNINGS = (5, 6, 7)


class Hasher:
    """Coordinates of texts; hashes of words seen are kept, up to a limit."""

    def __init__(self, settings: Settings):
        self.settings = settings
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.hashes = np.zeros((1 << 14, 1 + len(_BEGINNINGS)), np.uint64)

    def _rows(self, words: list[str]) -> np.ndarray:
        """For every word its hash and those of its beginnings, 0 where it is too short."""
        missing = sorted(set(words).difference(self.known))
        if len(self.known) + len(missing) > self.settings.cached_words:
            self._forget()
            missing = sorted(set(words))
        first = len(self.known)
        while len(self.hashes) < first + len(missing):
            self.hashes = np.concatenate([self.hashes, np.zeros_like(self.hashes)])
        found = [[_hash(w), *(_hash(w[:n]) if len(w) >= n else 0 for n in _BEGINNINGS)] for w in missing]
        self.hashes[first : first + len(missing)] = np.array(found, np.uint64).reshape(-1, self.hashes.shape[1])
        self.known.update(zip(missing, range(first, first + len(missing))))
        return self.hashes[np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))]

    def sets(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Coordinates, those of a text together and each once; their values; how many per text."""
        split = [_WORD.findall(t.lower()) for t in texts]
        count = np.fromiter(map(len, split), np.int64, len(split))
        hashed = self._rows([w for s in split for w in s])
        words = hashed[:, 0]
        row = np.repeat(np.arange(len(texts)), count)
        parts = [(row, words * _MIX[0], 0)]
        for gap, mix in ((1, _MIX[1]), (2, _MIX[2])):
            if len(words) > gap:
                same = row[:-gap] == row[gap:]
                pair = words[:-gap] * mix + words[gap:] * _MIX[3] + np.uint64(gap)
                parts.append((row[:-gap][same], (pair ^ pair >> np.uint64(29))[same] * _MIX[0], 0))
        for n in range(len(_BEGINNINGS)):
            begin = hashed[:, 1 + n]
            parts.append((row[begin > 0], begin[begin > 0] * _MIX[1 + n % 3], 1))
        # The lowest bit of a coordinate tells what kind of value it takes.
        bits = self.settings.bits
        shift = np.uint64(65 - bits)
        keys = np.concatenate([(r << bits) | ((h >> shift).astype(np.int64) << 1) | kind for r, h, kind in parts])
        keys, times = np.unique(keys, return_counts=True)
        row, at = keys >> bits, keys & ((1 << bits) - 1)
        share = np.minimum(1.0, self.settings.share_scale * times / np.maximum(count[row], 1))
        return at, np.where(at & 1, share, 1.0).astype(np.float32), np.bincount(row, minlength=len(texts))


def _hash(word: str) -> int:
    raw = word.encode("utf-8", "replace")
    return zlib.crc32(raw) | zlib.crc32(raw, 0x5BD1E995) << 32


class Ftrl:
    """Per-coordinate FTRL-proximal; the last coordinate is the bias."""

    def __init__(self, settings: Settings):
        self.settings = settings
        size = (1 << settings.bits) + 1
        self.z, self.n = np.zeros(size), np.zeros(size)

    def weights(self, at: np.ndarray) -> np.ndarray:
        s = self.settings
        z = self.z[at]
        shrunk = np.sign(z) * s.l1 - z
        out = shrunk / ((s.beta + np.sqrt(self.n[at])) / s.alpha + s.l2)
        out[np.abs(z) <= s.l1] = 0
        return out

    def learn(self, at: np.ndarray, values: np.ndarray, label: int, importance: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ values, -30, 30)))
        g = (p - label) * importance * values
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.settings.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


@dataclass
class Model:
    """Sorted coordinates with weights; everything else weighs nothing."""

    at: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    settings: Settings = field(default_factory=Settings)

    def score(self, hasher: Hasher, texts: list[str]) -> np.ndarray:
        keys, values, count = hasher.sets(texts)
        total = np.full(len(texts), self.bias)
        if len(self.at):
            place = np.minimum(np.searchsorted(self.at, keys), len(self.at) - 1)
            hit = self.at[place] == keys
            row = np.repeat(np.arange(len(texts)), count)
            total += np.bincount(row[hit], self.weights[place[hit]] * values[hit], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def train_shard(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, settings: Settings) -> Ftrl:
    """FTRL over (coordinates, values) in a fixed shuffled order; the rarer class weighs more."""
    own = Ftrl(settings)
    seen = np.zeros(len(own.z), np.int64)
    for at, _ in rows:
        seen[at] += 1
    bias = len(own.z) - 1
    kept = [(np.append(at[seen[at] >= settings.least_rows], bias), np.append(v[seen[at] >= settings.least_rows], 1.0)) for at, v in rows]
    positive = max(int(labels.sum()), 1)
    rarer = min(max((len(labels) - positive) / positive, 1.0), 50.0) ** 0.5
    random = np.random.default_rng(7)
    for _ in range(settings.epochs):
        for i in random.permutation(len(kept)):
            own.learn(*kept[i], int(labels[i]), rarer if labels[i] else 1.0)
    return own


def average(shards: list[tuple[np.ndarray, np.ndarray]], settings: Settings) -> Model:
    """The mean of the shards' weights; a coordinate a shard does not hold counts as zero."""
    if not shards:
        return Model(settings=settings)
    at = np.concatenate([a for a, _ in shards])
    weights = np.concatenate([w for _, w in shards]) / len(shards)
    own, place = np.unique(at, return_inverse=True)
    total = np.bincount(place, weights, minlength=len(own))
    bias = own == 1 << settings.bits
    return Model(own[~bias], total[~bias], float(total[bias].sum()), settings)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """From rows of ``docs`` whose ids may be learnt from; only sparse weights are collected."""
    sample, counts = labelled_sample(doc_columns(docs), labels, "toxic", F.coalesce(crc_of_id(3) != 1, F.lit(False)), settings.rows_per_class)
    if len(counts) < 2:
        return Model(settings=settings)
    rows = sum(min(n, settings.rows_per_class) for n in counts.values())
    shards = max(1, rows // settings.rows_per_shard)

    def hash_texts(batches):
        hasher = Hasher(settings)
        for batch in batches:
            for part in slices(batch):
                keys, values, count = hasher.sets(strings(part.column("text")))
                ends = np.cumsum(count)
                found = [[x[e - c : e].astype(kind).tobytes() for e, c in zip(ends, count)] for x, kind in ((keys, "<u4"), (values, "<f4"))]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), *(pa.array(f, pa.binary()) for f in found)], names=["doc_id", "label", "keys", "values"]
                )

    def learn(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by("doc_id")
        columns = zip(batch.column("keys").to_pylist(), batch.column("values").to_pylist())
        rows = [(np.frombuffer(k, "<u4").astype(np.int64), np.frombuffer(v, "<f4").astype(float)) for k, v in columns]
        own = train_shard(rows, np.array(batch.column("label").to_pylist()), settings)
        at = np.flatnonzero(np.abs(own.z) > settings.l1)
        at = np.union1d(at, [len(own.z) - 1])
        return pa.table({"at": [at.astype("<i8").tobytes()], "weights": [own.weights(at).astype("<f8").tobytes()]})

    hashed = map_batches(sample, hash_texts, "doc_id bigint, label int, keys binary, values binary")
    shard = F.pmod(F.xxhash64("doc_id", F.lit("shard")), F.lit(shards))
    learnt = hashed.withColumn("shard", shard).groupBy("shard").applyInArrow(learn, "at binary, weights binary").collect()
    found = [(np.frombuffer(r["at"], "<i8"), np.frombuffer(r["weights"], "<f8")) for r in learnt]
    return average(sorted(found, key=lambda f: (len(f[0]), f[1].sum())), settings)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``toxicity``, in place of any of that name."""
    docs = docs.drop("toxicity")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        hasher = Hasher(own.settings)
        for batch in batches:
            for part in slices(batch):
                score = own.score(hasher, strings(part.column("text")))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(score)], names=[*part.schema.names, "toxicity"])

    return map_batches(docs, run, appended(docs.schema, "toxicity double"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    settings = Settings()
    model = train(documents, table(spark, folder, "labels"), settings)
    return scored(doc_columns(documents), model).select(
        "doc_id",
        F.coalesce(crc_of_id(3) == 1, F.lit(False)).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= settings.threshold).cast("int").alias("predicted"),
    )
