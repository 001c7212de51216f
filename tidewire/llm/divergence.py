"""How the sources of a language differ in their use of terms, by a tree of term rows.

Terms are runs of letters of A to Z (in lower case) and of characters outside ASCII. A language
keeps the terms that stand in at least ``min_documents`` of its documents. A source with
``N`` places of its ``V`` kept terms gives a term with ``c`` places there the share
``p = 1 + floor(scale * (c + smoothing) / (N + smoothing * V))``, and so does the language
as a whole. Two sources are ``sum(|p - q|)`` over the kept terms apart.

Most terms stand in few sources, so that sum is not taken term by term. With ``o`` for the share
of a term that does not stand in a source,

    |p - q| = |o_p - o_q|                                              a constant of the pair
            + (|p - o_q| - |o_p - o_q|) + (|o_p - q| - |o_p - o_q|)    one source each
            + (|p - q| - |p - o_q| - |o_p - q| + |o_p - o_q|)          only if it stands in both

The second line comes from running sums over the shares of one source. The third line is the
correction of a pair, and comes from a frequent-pattern tree: a term's row holds its sources
in one order (those with most kept terms first) with their shares; equal rows are one with a
multiplicity; rows are inserted in ascending order, so rows with a common beginning share its
nodes, a branch is finished as soon as a row leaves it, and a task holds one open path. A
finished node gives every ancestor its correction once, times the rows that went through it.
Slices of the sorted rows are trees of their own, whose corrections add up, so a language that
holds all rows is spread over all tasks.

Sums are 64-bit, shares are divided in 38-digit decimals: all is exact up to 9e9 kept terms.

Defined results: null text, language and source are the empty string; repeated ids are
documents of their own; a group without terms has ``N = 0`` and takes part; with ``V = 0`` all
pairs are 0 apart; a source alone in its language has no pairs; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewire.llm.common import flat, map_batches, sent, slices, table
from tidewire.plans.durable import durable


@dataclass(frozen=True)
class Settings:
    min_documents: int = 30
    smoothing: int = 5
    scale: int = 1_000_000_000
    top_terms: int = 50
    # What a task holds before it hands on its sums.
    terms_held: int = 200_000
    pairs_held: int = 4_000_000
    text_bytes: int = 1 << 20


# --- counting -------------------------------------------------------------------------------

# Letters stay, A to Z become small, all else of ASCII becomes a blank.
_LETTERS = bytes(b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256))


def terms(raw: bytes, limit: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of about ``limit`` bytes."""
    letters = raw.translate(_LETTERS)
    start = 0
    while start < len(letters):
        stop = letters.find(b" ", start + limit)
        stop = len(letters) if stop < 0 else stop
        yield letters[start:stop].split()
        start = stop


def term_counts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, source, term, n, docs): places of a term and documents with it; every group has a
    row with the empty term. Counts are added up within a task before they move."""

    def run(batches):
        n: dict[tuple, Counter] = {}
        within: dict[tuple, Counter] = {}

        def counted():
            rows = [(*group, term.decode(), count, within[group][term]) for group, terms_ in n.items() for term, count in terms_.items()]
            rows += [(*group, "", 0, 0) for group in n]
            n.clear()
            within.clear()
            columns = zip(*rows)
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for part in slices(batch):
                raw, offsets = flat(part.column("text"))
                data = raw.tobytes()
                groups = zip(part.column("lang").to_pylist(), part.column("source").to_pylist())
                for group, a, b in zip(groups, offsets[:-1].tolist(), offsets[1:].tolist()):
                    places, documents = n.setdefault(group, Counter()), within.setdefault(group, Counter())
                    own: set[bytes] = set()
                    for words in terms(data[a:b], settings.text_bytes):
                        places.update(words)
                        own.update(words)
                    documents.update(own)
                if sum(map(len, n.values())) > settings.terms_held:
                    yield counted()
        if n:
            yield counted()

    filled = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    found = map_batches(filled, run, "lang string, source string, term string, n bigint, docs bigint")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return found.repartition(parts, "lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# --- shares ---------------------------------------------------------------------------------


def _share(count: Column, total: Column, kept: Column, settings: Settings) -> Column:
    """``p``; 1 when nothing is kept."""
    below = total + settings.smoothing * kept
    above = F.lit(settings.scale).cast("decimal(12,0)") * (count + settings.smoothing).cast("decimal(20,0)")
    return F.when(below == 0, F.lit(1)).otherwise(F.lit(1) + F.call_function("div", above, below.cast("decimal(20,0)"))).cast("bigint")


def shares(counts: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """From a stored table of ``term_counts``, two stored tables.

    Groups: lang, source, ``place`` of the source in its language, ``terms`` of the language
    that are kept, ``zero`` (share of a term that does not stand here), ``own`` (kept terms
    that do), ``total`` (sum of their shares). Kept terms: lang, source, term, place, zero, p,
    q (the language's share).
    """
    term = Window.partitionBy("lang", "term")
    known = counts.where("term <> ''").withColumns({"lang_docs": F.sum("docs").over(term), "lang_count": F.sum("n").over(term)})
    kept = durable(known.where(F.col("lang_docs") >= settings.min_documents).select("lang", "source", "term", "n", "lang_count"))
    size = kept.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("own"))
    langs = (
        kept.groupBy("lang", "term").agg(F.sum("n").alias("n")).groupBy("lang").agg(F.sum("n").alias("lang_n"), F.count(F.lit(1)).alias("terms"))
    )
    groups = counts.where("term = ''").select("lang", "source").join(size, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("own"), "source"))
    groups = durable(groups.withColumns({"place": place, "zero": _share(F.lit(0).cast("bigint"), F.col("n"), F.col("terms"), settings)}))
    sized = kept.join(sent(groups.withColumnRenamed("n", "size")), ["lang", "source"]).withColumns(
        {
            "p": _share(F.col("n"), F.col("size"), F.col("terms"), settings),
            "q": _share(F.col("lang_count"), F.col("lang_n"), F.col("terms"), settings),
        }
    )
    sized = durable(sized.select("lang", "source", "term", "place", "zero", "p", "q"))
    total = sized.groupBy("lang", "source").agg(F.sum("p").alias("total"))
    groups = groups.join(total, ["lang", "source"], "left").fillna(0)
    return durable(groups.select("lang", "source", "place", "terms", "zero", "own", "total")), sized


# --- pairs of sources -----------------------------------------------------------------------


def _corrections(kept: DataFrame, settings: Settings) -> DataFrame:
    """(lang, a, b, value): what pairs of places owe to terms that stand in both; a < b."""
    path = F.array_sort(F.collect_list(F.struct("place", "p", "zero"))).alias("path")
    rows = kept.groupBy("lang", "term").agg(path).where(F.size("path") > 1)
    rows = durable(rows.groupBy("lang", "path").agg(F.count(F.lit(1)).alias("terms")))
    parts = int(kept.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "lang", "path").sortWithinPartitions("lang", "path")

    def run(batches):
        tree = PatternTree()
        lang = None
        for batch in batches:
            paths = batch.column("path")
            begins = paths.offsets.to_numpy()
            items = paths.values
            place, p, zero = (items.field(k).to_numpy(zero_copy_only=False) for k in ("place", "p", "zero"))
            names, times = batch.column("lang").to_pylist(), batch.column("terms").to_pylist()
            for i, (name, often) in enumerate(zip(names, times)):
                if lang is not None and (name != lang or tree.pairs > settings.pairs_held):
                    yield tree.corrections(lang)
                lang = name
                a, b = begins[i], begins[i + 1]
                tree.insert(place[a:b], p[a:b], zero[a:b], often)
        if lang is not None:
            yield tree.corrections(lang)

    found = map_batches(ordered, run, "lang string, a bigint, b bigint, value bigint")
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


class PatternTree:
    """The open path of a frequent-pattern tree whose rows come in ascending order."""

    def __init__(self):
        self.place, self.p, self.zero = (np.zeros(0, np.int64) for _ in range(3))
        self.times: list[int] = []
        self.sums: dict[int, np.ndarray] = {}
        self.pairs = 0

    def insert(self, place: np.ndarray, p: np.ndarray, zero: np.ndarray, times: int) -> None:
        """A row with its multiplicity; nodes of the last row that it does not share are finished."""
        both = min(len(place), len(self.place))
        differs = np.flatnonzero((place[:both] != self.place[:both]) | (p[:both] != self.p[:both]))
        self._finish(int(differs[0]) if len(differs) else both)
        self.place, self.p, self.zero = place, p, zero
        self.times += [0] * (len(place) - len(self.times))
        self.times[-1] += times

    def _finish(self, depth: int) -> None:
        for node in range(len(self.times) - 1, depth - 1, -1):
            times = self.times.pop()
            if not node:
                continue
            self.times[-1] += times
            above, own = self.p[:node], self.p[node]
            o_above, o_own = self.zero[:node], self.zero[node]
            value = np.abs(above - own) - np.abs(above - o_own) - np.abs(o_above - own) + np.abs(o_above - o_own)
            place = int(self.place[node])
            sums = self.sums.get(place)
            if sums is None:  # ancestors stand before the node in the order of sources
                sums = self.sums[place] = np.zeros(place, np.int64)
                self.pairs += place
            sums[self.place[:node]] += times * value

    def corrections(self, lang: str) -> pa.RecordBatch:
        """The sums of all pairs since the last call; the tree is empty after it."""
        self._finish(0)
        self.place = self.place[:0]
        own = [np.flatnonzero(s) for s in self.sums.values()]
        a = np.concatenate([*own, np.zeros(0, np.int64)])
        b = np.repeat(np.fromiter(self.sums, np.int64, len(self.sums)), [len(x) for x in own])
        value = np.concatenate([*(s[x] for s, x in zip(self.sums.values(), own)), np.zeros(0, np.int64)])
        self.sums, self.pairs = {}, 0
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array(a), pa.array(b), pa.array(value)], names=["lang", "a", "b", "value"])


def source_pairs(groups: DataFrame, kept: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, source, item, value): the distance of every source to every other of its language."""
    one = groups.select("lang", F.col("place").alias("s"), F.col("zero").alias("zero_s"), "terms", "own", "total")
    other = groups.select("lang", F.col("place").alias("t"), F.col("zero").alias("zero_t"))
    pairs = one.join(other, "lang").where("s <> t")
    # Sums over the shares of s below what t gives a term that it does not have.
    steps = kept.groupBy("lang", "place", "p").agg(F.count(F.lit(1)).alias("n"))
    steps = steps.select("lang", F.col("place").alias("s"), F.col("p").alias("at"), F.lit(1).alias("kind"), "n", (F.col("n") * F.col("p")).alias("np"))
    asked = pairs.withColumns({"at": F.col("zero_t"), "kind": F.lit(0), "n": F.lit(0).cast("bigint"), "np": F.lit(0).cast("bigint")})
    running = Window.partitionBy("lang", "s").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    summed = asked.unionByName(steps, allowMissingColumns=True).withColumns({"below": F.sum("n").over(running), "below_p": F.sum("np").over(running)})
    apart = F.abs(F.col("zero_s") - F.col("zero_t"))
    alone = F.col("total") - F.col("own") * F.col("zero_t") + 2 * (F.col("zero_t") * F.col("below") - F.col("below_p")) - F.col("own") * apart
    # The constant of a pair is counted from its first source only.
    constant = F.when(F.col("s") < F.col("t"), F.col("terms") * apart).otherwise(0)
    ends = (F.least("s", "t").alias("a"), F.greatest("s", "t").alias("b"))
    parts = summed.where("kind = 0").select("lang", *ends, (alone + constant).alias("value"))
    whole = durable(parts.unionByName(_corrections(kept, settings)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = whole.unionByName(whole.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    names = groups.select("lang", F.col("place").alias("a"), "source")
    items = groups.select("lang", F.col("place").alias("b"), F.col("source").alias("item"))
    return both.join(sent(names), ["lang", "a"]).join(sent(items), ["lang", "b"]).select("lang", "source", "item", "value")


def source_terms(kept: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, source, item, value, rank): the terms that a source uses most above its language."""
    more = kept.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(more).where(F.col("rank") <= settings.top_terms)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def divergence(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(lang, source, part, item, value, rank): pairs of sources, and the terms that stand out."""
    counts = durable(term_counts(docs, settings))
    groups, kept = shares(counts, settings)
    pairs = _ranked(source_pairs(groups, kept, settings)).withColumn("part", F.lit("pair"))
    single = source_terms(kept, settings).withColumn("part", F.lit("term"))
    return pairs.unionByName(single).select("lang", "source", "part", "item", "value", "rank")


def op12_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence(table(spark, folder, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 30
), n AS (
  SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL
), groups AS (
  SELECT DISTINCT lang, source FROM d
), v AS (
  SELECT lang, count(*) AS v FROM kept GROUP BY lang
), size AS (
  SELECT g.lang, g.source, coalesce(sum(n.n), 0)::HUGEINT AS size FROM groups g LEFT JOIN n USING (lang, source) GROUP BY ALL
), grid AS (
  SELECT s.lang, s.source, k.term, coalesce(n.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n.n, 0) + 5)) // (s.size + 5 * v.v) AS p
  FROM size s JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN n ON n.lang = s.lang AND n.source = s.source AND n.term = k.term
), whole AS (
  SELECT lang, term, sum(n) AS n FROM n GROUP BY ALL
), langs AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q FROM whole
), apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM grid a JOIN grid b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), single AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM grid JOIN langs USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM single)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
