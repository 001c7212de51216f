"""Benchmark decontamination by pigeonhole edit matching.

A document leaks a benchmark item when some stretch of it is within the item's error budget,
a share of the item's length, in edit distance. Cut into one piece more than the budget, an
item within budget leaves at least one piece untouched; an Aho-Corasick automaton over all
pieces finds those in one pass, and Myers' bit-parallel search verifies the stretch around
each hit. Texts are compared as lower-cased words with single blanks between them.

Items travel to the tasks in parts of at most ``part_chars`` code points, one pass in the
same stage per part, so a task never holds more than one part's automaton at a time it builds.

Defined results: null and empty texts leak nothing; items without any word are never leaked;
an item that stands twice counts under both ids; equal ids of different items are reported
once; without items nothing leaks; rows keep their place and other columns their values.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import appended, doc_columns, free_name, map_batches, slices, strings, table

_WORDS = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Settings:
    error_share: float = 0.08
    part_chars: int = 8_000_000


def plain(text: str) -> str:
    return " ".join(_WORDS.findall(text.lower()))


def budget(length: int, share: float) -> int:
    return int(length * share)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """The item cut into ``errors`` + 1 pieces of nearly equal length, with their places."""
    count = errors + 1
    cuts = [len(item) * i // count for i in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Myers:
    """Approximate search of one pattern, a column of the distance matrix per integer."""

    def __init__(self, pattern: str):
        self.length = len(pattern)
        self.full = (1 << self.length) - 1
        self.high = 1 << (self.length - 1)
        self.masks: dict[str, int] = {}
        for place, char in enumerate(pattern):
            self.masks[char] = self.masks.get(char, 0) | 1 << place

    def best(self, text: str) -> int:
        """Smallest edit distance of the pattern to any substring of ``text``."""
        up, down, score = self.full, 0, self.length
        least, full, high, masks = score, self.full, self.high, self.masks
        for char in text:
            match = masks.get(char, 0)
            diagonal = (((match & up) + up) ^ up) | match | down
            plus = down | ~(diagonal | up) & full
            minus = up & diagonal
            if plus & high:
                score += 1
            elif minus & high:
                score -= 1
                if score < least:
                    least = score
            plus = plus << 1 & full
            minus = minus << 1 & full
            up = minus | ~(diagonal | match | down | plus) & full
            down = plus & (diagonal | match | down)
        return least


class Matcher:
    """The automaton over all pieces of some items, and their verification."""

    def __init__(self, items: list[tuple[int, str]], share: float):
        self.items = [(i, p, budget(len(p), share)) for i, t in items if (p := plain(t or ""))]
        self._automaton = None
        self._myers: dict[int, Myers] = {}

    def __getstate__(self):
        return {"items": self.items, "_automaton": None, "_myers": {}}

    def _pieces(self) -> ahocorasick.Automaton:
        if self._automaton is None:
            places: dict[str, list[tuple[int, int]]] = {}
            for number, (_, item, errors) in enumerate(self.items):
                for at, piece in pieces(item, errors):
                    places.setdefault(piece, []).append((number, at))
            own = ahocorasick.Automaton()
            for piece, where in places.items():
                own.add_word(piece, (len(piece), tuple(where)))
            own.make_automaton()
            self._automaton = own
        return self._automaton

    def leaks(self, text: str) -> list[tuple[int, int]]:
        """(item id, distance) of every item that a stretch of the text is close to."""
        low = plain(text)
        if not low or not self.items:
            return []
        stretches: dict[int, list[tuple[int, int]]] = {}
        for last, (length, where) in self._pieces().iter(low):
            for number, at in where:
                _, item, errors = self.items[number]
                begin = last - length + 1 - at - errors
                end = begin + len(item) + 2 * errors
                own = stretches.setdefault(number, [])
                # Hits come in order, so a stretch can only run into the one before it.
                if own and begin <= own[-1][1]:
                    own[-1] = (min(begin, own[-1][0]), max(end, own[-1][1]))
                else:
                    own.append((begin, end))
        found: dict[int, int] = {}
        for number, own in stretches.items():
            identity, item, errors = self.items[number]
            for begin, end in own:
                window = low[max(begin, 0) : end]
                if len(window) < len(item) - errors:
                    continue
                if item in window:
                    distance = 0
                else:
                    if number not in self._myers:
                        self._myers[number] = Myers(item)
                    distance = self._myers[number].best(window)
                if distance <= errors and distance < found.get(identity, errors + 1):
                    found[identity] = distance
                if found.get(identity) == 0:
                    break
        return sorted(found.items())


def _parts(items: DataFrame, settings: Settings) -> list[list[tuple[int, str]]]:
    """The items in bounded parts, each fetched by itself."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where(
        F.col("item_id").isNotNull() & F.col("text").isNotNull()
    )
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    count = int(total // settings.part_chars) + 1
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return [[tuple(r) for r in rows.where(part == i).orderBy("item_id", "text").collect()] for i in range(count)]


def find_leaks(docs: DataFrame, items: DataFrame, settings: Settings = Settings(), column: str = "leaks") -> DataFrame:
    """``docs`` with an array of (item_id, distance) by item, which replaces any column of
    that name."""
    docs = docs.drop(column)
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int64())]))
    out, found = docs, []
    for part in _parts(items, settings):
        shared = docs.sparkSession.sparkContext.broadcast(Matcher(part, settings.error_share))
        name = free_name(out, "leaks_of_part")
        found.append(name)

        def run(batches, shared=shared, name=name):
            matcher = shared.value
            for batch in batches:
                for rows in slices(batch):
                    leaks = [[dict(zip(("item_id", "distance"), x)) for x in matcher.leaks(t)] for t in strings(rows.column("text"))]
                    yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(leaks, kind)], names=[*rows.schema.names, name])

        out = map_batches(out, run, appended(out.schema, f"{name} array<struct<item_id:bigint,distance:bigint>>"))
    return out.select(*docs.columns, F.array_sort(F.concat(*found)).alias(column))


def clean_documents(docs: DataFrame, items: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rows that leak no item."""
    column = free_name(docs, "leaks")
    return find_leaks(docs, items, settings, column).where(F.size(column) == 0).select(*docs.columns)


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    found = find_leaks(doc_columns(table(spark, folder, "documents")), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id",
        (F.size("leaks") > 0).alias("contaminated"),
        F.size("leaks").cast("long").alias("n_items"),
        F.array_join(F.transform("leaks", lambda x: x["item_id"].cast("string")), ",").alias("item_ids"),
        F.array_min("leaks.distance").alias("min_distance"),
    )
