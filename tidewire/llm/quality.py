"""Document quality by Bradley-Terry ranking.

Every document has a score linear in features of how it is written. Labels are read as
preferences: a document marked good is preferred to one marked bad, with a probability that is
the logistic function of their difference in score. The weights minimise the logistic loss on
the differences of features over such pairs, made of a bounded sample. The cut between good and
bad is a quantile of the scores of all documents whose labels may be learnt from: the share of
them that the labels call bad.

Scores are reported as probabilities, moved so that the cut is at ``threshold``.

Defined results: null and empty texts have the features of a text without words; without
labels of both classes every score is ``threshold``; ties stay ties.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import appended, crc_of_id, doc_columns, map_batches, slices, strings, table
from tidewire.llm.sampling import labelled_sample, usable_labels
from tidewire.plans.durable import durable

_SIGNS = re.compile(r"[#$%&*!|~^<>=+\\{}\[\]@_`]")
FEATURES = (
    "log_words",
    "letters",
    "upper",
    "digits",
    "signs",
    "blanks",
    "word_length",
    "long_words",
    "sign_ends",
    "stops",
    "commas",
    "distinct",
    "top_word",
    "top_three",
    "same_as_before",
    "distinct_threes",
    "distinct_lines",
    "line_words",
    "one_word_sentences",
)


@dataclass(frozen=True)
class Settings:
    """``rows_per_class`` bounds the sample, ``pairs_per_row`` the preferences made of it."""

    rows_per_class: int = 8_000
    pairs_per_row: int = 8
    penalty: float = 1e-3
    threshold: float = 0.3


def features(text: str) -> list[float]:
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(FEATURES)
    letters = sum(map(len, re.findall(r"[^\W\d_]+", text)))
    upper = sum(map(len, re.findall(r"[A-ZÀ-ÖØ-Þ]+", text)))
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    top = [c for _, c in counts.most_common(3)]
    threes = n - 2
    ends = [w[-1] for w in words]
    stops = sum(e in ".?!" for e in ends)
    return [
        math.log1p(n),
        letters / chars,
        upper / max(letters, 1),
        sum(map(len, re.findall(r"[0-9]+", text))) / chars,
        len(_SIGNS.findall(text)) / chars,
        (chars - sum(map(len, words))) / chars,
        sum(map(len, words)) / n / 10,
        sum(len(w) > 12 for w in words) / n,
        sum(bool(_SIGNS.match(e)) for e in ends) / n,
        stops / n,
        ends.count(",") / n,
        math.log1p(len(counts)) / math.log1p(n),
        top[0] / n,
        sum(top) / n,
        sum(a == b for a, b in zip(words, words[1:])) / n,
        len(set(zip(words, words[1:], words[2:]))) / threes if threes > 0 else 1.0,
        len(set(lines)) / len(lines),
        min(n / len(lines), 200) / 100,
        sum(w[0].isupper() and e in ".?!" for w, e in zip(words, ends)) / n,
    ]


@dataclass
class Model:
    mean: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    scale: np.ndarray = field(default_factory=lambda: np.ones(len(FEATURES)))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    cut: float = 0.0
    slope: float = 1.0
    threshold: float = 0.3

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return ((rows - self.mean) / self.scale) @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of a good text; ``threshold`` at the cut."""
        move = math.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.raw(rows) - self.cut) + move, -30, 30)))


def bradley_terry(good: np.ndarray, bad: np.ndarray, settings: Settings) -> np.ndarray:
    """Weights with the least logistic loss on differences of good and bad rows, by Newton."""
    longer = max(len(good), len(bad))
    turns = np.arange(longer * settings.pairs_per_row)
    # Every row of the larger class meets several of the other, each time another one.
    pairs = good[turns % len(good)] - bad[(turns + turns // longer * 7919) % len(bad)]
    weights = np.zeros(pairs.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(pairs @ weights, -30, 30)))  # how wrong each preference is
        gradient = settings.penalty * weights - pairs.T @ p / len(pairs)
        hessian = (pairs * (p * (1 - p))[:, None]).T @ pairs / len(pairs) + settings.penalty * np.eye(len(weights))
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-7:
            break
    return weights


def fit(rows: np.ndarray, labels: np.ndarray, bad_share: float, settings: Settings = Settings()) -> Model:
    """``bad_share``: how many of all labels say bad; the sample may hold more of them."""
    if not len(rows) or labels.min() == labels.max():
        return Model(threshold=settings.threshold, cut=0.0)
    model = Model(rows.mean(0), np.maximum(rows.std(0), 1e-6), np.zeros(rows.shape[1]), threshold=settings.threshold)
    scaled = (rows - model.mean) / model.scale
    model.weights = bradley_terry(scaled[labels == 1], scaled[labels == 0], settings)
    raw = scaled @ model.weights
    # The quantile of the scores as all labels would give it: classes weigh what they are.
    weight = np.where(labels == 0, bad_share / (labels == 0).sum(), (1 - bad_share) / (labels == 1).sum())
    order = np.argsort(raw, kind="stable")
    reached = np.cumsum(weight[order])
    at = min(int(np.searchsorted(reached, bad_share - 1e-9)), len(order) - 2)
    model.cut = float(raw[order[at]] + raw[order[at + 1]]) / 2
    model.slope = 1.0
    return model


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """From rows of ``docs`` whose ids may be learnt from; the sample's features are collected."""
    sample, counts = labelled_sample(doc_columns(docs), labels, "quality", crc_of_id(5) != 0, settings.rows_per_class)
    rows = with_features(sample).select("label", "features").collect()
    known = sum(counts.values())
    return fit(
        np.array([r["features"] for r in rows], float).reshape(-1, len(FEATURES)),
        np.array([r["label"] for r in rows], int),
        counts.get(0, 0) / known if known else 0.0,
        settings,
    )


def raw_scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, raw): what the weights give, before the cut is known."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                rows = np.array([features(t) for t in strings(part.column("text"))], float).reshape(-1, len(FEATURES))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(shared.value.raw(rows))], names=["doc_id", "raw"])

    return map_batches(doc_columns(docs), run, "doc_id bigint, raw double")


def quantile(scores: DataFrame, share: float, bins: int = 4096) -> float:
    """Between the last of the least ``share`` of the rows of ``raw`` and the first of the rest.

    Exact: rows are counted in ``bins`` stretches, and then in those of the stretch that holds
    the place, until a stretch holds one value; what comes to the driver are counts.
    """
    low, high, rows = scores.agg(F.min("raw"), F.max("raw"), F.count("raw")).first()
    if not rows:
        return 0.0
    place = min(max(math.ceil(share * rows - 1e-9), 1), max(rows - 1, 1))
    below = 0  # rows under ``low``
    while low < high:
        step = (high - low) / bins
        if not step:
            break
        inside = scores.where(F.col("raw").between(low, high))
        at = F.least(F.floor((F.col("raw") - low) / step), F.lit(bins - 1))
        counts = inside.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n"), F.min("raw").alias("low"), F.max("raw").alias("high"))
        for row in sorted(counts.collect(), key=lambda r: r["at"]):
            if below + row["n"] >= place:
                low, high = row["low"], row["high"]
                break
            below += row["n"]
    above = scores.where(F.col("raw") > low).agg(F.min("raw")).first()[0]
    return low if above is None else (low + above) / 2


def cut_by_labels(model: Model, scores: DataFrame, labels: DataFrame) -> Model:
    """``model`` with its cut at the quantile of all of ``scores`` (a stored table) that have a
    label to learn from; the share below it is that of the labels that say bad."""
    own = usable_labels(labels, "quality", crc_of_id(5) != 0)
    known = durable(scores.where("raw is not null").join(own, "doc_id").select("raw", "label"))
    rows, bad = known.agg(F.count(F.lit(1)), F.count_if(F.col("label") == 0)).first()
    return replace(model, cut=quantile(known, bad / rows)) if rows and 0 < bad < rows else model


def with_features(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``features``; its ``text`` is given up."""
    rest = [c for c in docs.columns if c != "text"]

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                found = pa.array([features(t) for t in strings(part.column("text"))], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), found], names=[*rest, "features"])

    return map_batches(docs, run, appended(docs.drop("text").schema, "features array<double>"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a column ``quality_score``, in place of any of that name."""
    docs = docs.drop("quality_score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                rows = np.array([features(t) for t in strings(part.column("text"))], float).reshape(-1, len(FEATURES))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(shared.value.score(rows))], names=[*part.schema.names, "quality_score"])

    return map_batches(docs, run, appended(docs.schema, "quality_score double"))


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    settings = Settings()
    model = train(documents, labels, settings)
    scores = durable(raw_scores(documents, model))
    model = cut_by_labels(model, scores, labels)
    moved = model.slope * (F.col("raw") - model.cut) + math.log(model.threshold / (1 - model.threshold))
    score = 1 / (1 + F.exp(-F.greatest(F.least(moved, F.lit(30.0)), F.lit(-30.0))))
    return scores.select("doc_id", F.coalesce(crc_of_id(5) == 0, F.lit(False)).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= settings.threshold).cast("int")
    )
