r"""Repair of conversations whose turns are blank, repeated, cut short or out of order.

A conversation is sound when the initials of its roles read ``(s?(ua)+)?``: an optional system
row, then user and assistant in turns. Edits: Keep costs 0, Rerole to user or assistant 1,
Delete 2 (blank and repeated rows must go), Insert of an empty user or assistant row 5; a row
cut short that stays adds 5. Of the cheapest edits those whose initials are ASCII-least count.

What stands before a row matters only by one of four states (nothing yet, or the last role),
so edits are found as in Hirschberg's method for alignments: a cost vector over the states
runs forward over the first half, one runs backward over the second, the crossing with the
least sum is taken, and both halves are solved alike. Nothing but two vectors of four is held.
Beside its cost, every state has the rank of its cheapest edits among those of the other
states, in ASCII order: edits that have used the same rows are equal or differ before either
ends (each row takes one letter other than I), so ranks can be carried on without the letters,
and the crossing that is ASCII-least among the cheapest is known at once. A state that costs
over ``FAR`` more than another cannot be on a cheapest way, and is left out.

On Spark, rows are sorted over all conversations by range, so a long conversation is cut into
pieces like everything else. A piece of a conversation that reaches beyond its task is first
reduced to what it costs to get from each state to each other one (with ranks); the method runs
over these tables, which gives the states at the ends of every piece, and then inside pieces.
Only marks of rows move: turn, role, a digest of role and text, and how often the row stands;
texts are fetched for rows that stay. The hash of a conversation is that of one long text: its
rows are streamed through one task, in order, with nothing held.

Defined results: rows of one turn come in the order of their roles, then digests; null turns
come first, null roles and texts are one space, rows with a null id are one conversation; a
role other than those that begin with s, u or a, or an empty one, cannot be kept; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import flat, map_batches, sent, slices, table
from tidewire.plans.durable import durable

BLANKS = " \t\n\x0b\x0c\r"

# --- edits ----------------------------------------------------------------------------------

INSERT, DELETE, REROLE, CUT = 5, 2, 1, 5
# States: nothing yet, after a system, user, assistant row. The role that may follow each.
NEXT = (2, 2, 3, 2)
ROLES = ("", "system", "user", "assistant")
MAY_FOLLOW = {1: (0,), 2: (0, 1, 3), 3: (2,)}
# From every state it takes so many inserted rows to end soundly, and two at most.
TAIL = ("", "II", "I", "")
FAR = 2 * INSERT
NEVER = 1 << 60


class Step:
    """What it costs to get from state to state over a row or a piece, and in which ASCII rank."""

    def __init__(self, cost: list[list[int]], rank: list[list[int]], letters: list[list[str]] | None = None):
        self.cost, self.rank, self.letters = cost, rank, letters


def _row_step(initial: int, cut: int, must_go: bool) -> Step:
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for state in range(4):
        here = state
        for inserted in range(3):
            ways = [(here, 0 if must_go else DELETE, "D")]
            if not must_go:
                ways.append((NEXT[here], REROLE + CUT * cut, "R"))
                if here in MAY_FOLLOW.get(initial, ()):
                    ways.append((initial, CUT * cut, "K"))
            for end, cost, letter in ways:
                way = (INSERT * inserted + cost, "I" * inserted + letter)
                best[state, end] = min(best.get((state, end), way), way)
            here = NEXT[here]
    order = sorted({w[1] for w in best.values()})
    none = (NEVER, "")
    grid = [[best.get((p, q), none) for q in range(4)] for p in range(4)]
    return Step(
        [[w[0] for w in row] for row in grid],
        [[order.index(w[1]) if w[1] else 0 for w in row] for row in grid],
        [[w[1] for w in row] for row in grid],
    )


# Kinds of rows: twice the initial's state (0: none of them), plus one if cut short; MUST_GO.
MUST_GO = 8
ROW_STEPS = [_row_step(kind >> 1, kind & 1, False) for kind in range(8)] + [_row_step(0, 0, True)]


def _dense(ranks: dict) -> dict:
    places = {r: i for i, r in enumerate(sorted(set(ranks.values())))}
    return {k: places[r] for k, r in ranks.items()}


@lru_cache(maxsize=1 << 16)
def forward(vector: tuple, step: Step) -> tuple[tuple, tuple]:
    """The vector behind a step, and what was taken off the costs of each of its groups.

    A vector has costs and then ranks, four of each for every group of ways with a common
    beginning. Costs count from the least of a group; ranks go over all groups.
    """
    size = len(vector) // 2
    costs, ranks, off = {}, {}, []
    for group in range(0, size, 4):
        for end in range(4):
            ways = [
                (vector[group + p] + step.cost[p][end], vector[size + group + p], step.rank[p][end])
                for p in range(4)
                if vector[group + p] < NEVER and step.cost[p][end] < NEVER
            ]
            if ways:
                costs[group + end], *ranks[group + end] = min(ways)
        own = [costs[i] for i in range(group, group + 4) if i in costs]
        off.append(min(own, default=0))
        for i in range(group, group + 4):
            if i in costs:
                costs[i] -= off[-1]
                if costs[i] > FAR:
                    del costs[i], ranks[i]
    ranks = _dense({i: tuple(r) for i, r in ranks.items()})
    return tuple(costs.get(i, NEVER) for i in range(size)) + tuple(ranks.get(i, 0) for i in range(size)), tuple(off)


@lru_cache(maxsize=1 << 16)
def backward(vector: tuple, step: Step) -> tuple:
    """The vector before a step: costs and ranks of the ways from there to the end."""
    costs, ranks = {}, {}
    for state in range(4):
        ways = [
            (vector[q] + step.cost[state][q], step.rank[state][q], vector[4 + q])
            for q in range(4)
            if vector[q] < NEVER and step.cost[state][q] < NEVER
        ]
        if ways:
            costs[state], *ranks[state] = min(ways)
    least = min(costs.values())
    ranks = _dense({i: tuple(r) for i, r in ranks.items()})
    return tuple(costs[i] - least if i in costs else NEVER for i in range(4)) + tuple(ranks.get(i, 0) for i in range(4))


def at(state: int) -> tuple:
    """The vector of ways that are in ``state``."""
    return tuple(0 if i == state else NEVER for i in range(4)) + (0,) * 4


SOUND_END = tuple(INSERT * len(t) for t in TAIL) + tuple(sorted(set(TAIL)).index(t) for t in TAIL)


def states(steps: list[Step], entry: int, end: tuple) -> list[int]:
    """The states of the least way, before the first step and behind every one.

    ``end`` is the vector of what follows: ``SOUND_END``, or a state that is to be reached.
    """
    found = [entry]
    open_parts = [(0, len(steps), end)]
    while open_parts:
        start, stop, end = open_parts.pop()
        if start == stop:
            continue
        middle = (start + stop) // 2 if stop - start > 1 else stop
        ahead, behind = at(found[-1]), end
        for step in steps[start:middle]:
            ahead, _ = forward(ahead, step)
        for step in reversed(steps[middle:stop]):
            behind = backward(behind, step)
        _, _, _, crossing = min((ahead[q] + behind[q], ahead[4 + q], behind[4 + q], q) for q in range(4))
        if middle == stop:
            found.append(crossing)
        else:
            open_parts += [(middle, stop, end), (start, middle, at(crossing))]
    return found


def piece_step(kinds: bytes) -> Step:
    """A piece as one step from each state to each other; rows that must go count nothing."""
    vector = tuple(0 if g == s else NEVER for g in range(4) for s in range(4)) + (0,) * 16
    total = [0] * 4
    for kind in kinds:
        vector, off = forward(vector, ROW_STEPS[kind])
        total = [t + o for t, o in zip(total, off)]
    cost = [[vector[4 * g + q] + total[g] if vector[4 * g + q] < NEVER else NEVER for q in range(4)] for g in range(4)]
    return Step(cost, [list(vector[16 + 4 * g : 20 + 4 * g]) for g in range(4)])


def edits(kinds: bytes, entry: int = 0, end: tuple = SOUND_END) -> list[tuple[str, int, int]]:
    """(letters, state before, state behind) of every row; the last row's letters come without
    what has to be inserted behind it."""
    way = states([ROW_STEPS[k] for k in kinds], entry, end)
    return [(ROW_STEPS[k].letters[p][q], p, q) for k, p, q in zip(kinds, way, way[1:])]


# --- marks of rows --------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after damage drawn by a checksum of conversation and turn, with how often each
    stands (``copies``); a row that was dropped stands 0 times."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    place = F.concat_ws(":", text("conv_id"), text("turn"))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        text("role").alias("role"),
        text("text").alias("text"),
        (F.crc32(place.cast("binary")) % 20).alias("damage"),
    )
    kind = F.col("damage")
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """Nulls filled, conversations named by strings, rows by digests; without rows that do not
    stand, but for one of each conversation."""
    gone = F.col("copies") == 0
    filled = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(gone, "").otherwise(F.coalesce("text", F.lit(" "))).alias("text"),
        "copies",
    )
    told_apart = F.concat(F.length("role"), F.lit(":"), "role", "text")
    return filled.withColumn("key", F.when(F.col("copies") == 0, F.lit(b"")).otherwise(F.unhex(F.sha2(told_apart, 256))))


def _marks(keyed: DataFrame) -> DataFrame:
    """One row per conversation, turn and text, and one that goes before each text's first."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 2).when(initial == "u", 4).when(initial == "a", 6).otherwise(0)
    cut = F.when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    rows = keyed.select("conv", "turn", "role", "key", "copies", (kind + cut).cast("int").alias("kind"), (trimmed == "").alias("blank"))
    rows = durable(rows.groupBy("conv", "turn", "role", "key").agg(F.sum("copies").alias("copies"), F.first("kind").alias("kind"), F.first("blank").alias("blank")))
    turn = F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn"))["turn"].alias("turn")
    first = rows.where("copies > 0 and not blank").groupBy("conv", "role", "key").agg(turn)
    first = first.select("conv", "turn", "role", "key", F.lit(0).cast("bigint").alias("copies"), F.lit(-1).alias("kind"), F.lit(False).alias("blank"))
    return rows.unionByName(first)


# --- pieces ---------------------------------------------------------------------------------

_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_PIECE = (
    "conv string, part int, seq int, open boolean, kinds binary, times binary, keys binary, "
    + ", ".join(f"{c} bigint" for c in _COUNTS)
    + ", low bigint, high bigint, first_turn bigint, last_turn bigint, first_initial int, last_initial int, cost binary, rank binary"
)
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[1, 2] = _LEGAL[2, 3] = _LEGAL[3, 2] = True


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held = []
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _pieces(marks: DataFrame, rows_held: int) -> DataFrame:
    """Conversations, or parts of them, in order: kinds of rows, digests of those that may
    stay, counts, and what the ends must know of each other."""
    parts = int(marks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = ["conv", "turn", "role", "key"]
    ordered = marks.repartitionByRange(parts, *place).sortWithinPartitions(*place, "kind").withColumn("part", F.spark_partition_id())

    def run(batches):
        after_first = False
        for seq, held in enumerate(_gathered((b for b in batches if b.num_rows), rows_held)):
            conv = held.column("conv").combine_chunks()
            conv = conv.chunk(0) if isinstance(conv, pa.ChunkedArray) else conv
            codes = conv.dictionary_encode()
            name = np.asarray(codes.indices)
            kind, copies = np.asarray(held.column("kind")), np.asarray(held.column("copies"))
            blank = np.asarray(held.column("blank"))
            turn = held.column("turn")
            known = np.asarray(turn.is_valid())
            turn = np.asarray(turn.fill_null(0))
            first = np.concatenate([[after_first], kind[:-1] < 0])
            after_first = bool(kind[-1] < 0)
            stands = copies > 0
            stays = stands & first & ~blank
            # Each row once as what it is, if it may stay, and as often as it must go.
            kinds = np.stack([np.where(stays, kind, MUST_GO), np.full(len(kind), MUST_GO)], 1).astype(np.uint8)
            times = np.stack([stays, copies - stays], 1).astype(np.int64)
            keys = b"".join(held.column("key").filter(pa.array(stays)).to_pylist())
            key_at = np.concatenate([[0], np.cumsum(stays)])
            cuts = np.flatnonzero(np.diff(name, prepend=-1))
            ends = np.append(cuts[1:], len(name))
            rows: list[tuple] = []
            for number, (a, b) in enumerate(zip(cuts.tolist(), ends.tolist())):
                is_open = number == 0 or number == len(cuts) - 1
                there = times[a:b].ravel() > 0
                own_kinds, own_times = _merged(kinds[a:b].ravel()[there], times[a:b].ravel()[there])
                here = np.flatnonzero(stands[a:b]) + a
                initial = kind[here] >> 1
                illegal = int(copies[here].sum()) - len(here) + int((~_LEGAL[initial[:-1], initial[1:]]).sum())
                turns = turn[here][known[here]]
                counts = (
                    int(copies[a:b][blank[a:b]].sum()),
                    int((copies - stays)[a:b][~blank[a:b]].sum()),
                    int((stays[a:b] & (kind[a:b] & 1 == 1)).sum()),
                    illegal,
                    int((np.diff(turns) != 0).sum()) + (len(turns) > 0),
                )
                ranges = (int(turns.min()), int(turns.max())) if len(turns) else (None, None)
                around = (None, None, -1, -1)
                if len(here):
                    x, y = here[0], here[-1]
                    around = (int(turn[x]) if known[x] else None, int(turn[y]) if known[y] else None, int(initial[0]), int(initial[-1]))
                cost = rank = None
                if is_open:
                    step = piece_step(own_kinds.tobytes())
                    cost, rank = np.array(step.cost, "<i8").tobytes(), np.array(step.rank, "<i8").tobytes()
                blobs = (own_kinds.tobytes(), own_times.tobytes(), keys[32 * key_at[a] : 32 * key_at[b]])
                rows.append((codes.dictionary[name[a]].as_py(), seq, is_open, *blobs, *counts, *ranges, *around, cost, rank))
            part = held.column("part")[0].as_py()
            yield _batch(_PIECE, [(c, part, *rest) for c, *rest in rows])

    return map_batches(ordered, run, _PIECE)


def _merged(kinds: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that must go and follow each other as one."""
    if not len(kinds):
        return kinds, times
    fresh = np.ones(len(kinds), bool)
    fresh[1:] = (kinds[1:] != MUST_GO) | (kinds[:-1] != MUST_GO)
    return kinds[fresh], np.add.reduceat(times, np.flatnonzero(fresh))


_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(list(c), _TYPES[t]) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])


_PLAN = "conv string, part int, seq int, entry int, exit int, tail string, more_illegal bigint, same_turn bigint"


def _plan(part: pa.Table) -> pa.Table:
    """States at both ends of every piece of one conversation, and what counts across ends."""
    pieces = sorted(part.to_pylist(), key=lambda r: (r["part"], r["seq"]))
    grid = lambda blob: np.frombuffer(blob, "<i8").reshape(4, 4).tolist()
    way = states([Step(grid(p["cost"]), grid(p["rank"])) for p in pieces], 0, SOUND_END)
    rows, last_initial, last_turn = [], -1, None
    for number, (piece, entry, leave) in enumerate(zip(pieces, way, way[1:])):
        illegal = same = 0
        if piece["first_initial"] >= 0:
            illegal = int(last_initial >= 0 and not _LEGAL[last_initial, piece["first_initial"]])
            same = int(last_turn is not None and last_turn == piece["first_turn"])
            last_initial, last_turn = piece["last_initial"], piece["last_turn"]
        tail = TAIL[leave] if number == len(pieces) - 1 else ""
        rows.append((piece["conv"], piece["part"], piece["seq"], entry, leave, tail, illegal, same))
    return pa.Table.from_batches([_batch(_PLAN, rows)])


_SOLVED = (
    "conv string, part int, seq int, audit string, cost bigint, "
    + ", ".join(f"{c} bigint" for c in _COUNTS)
    + ", low bigint, high bigint"
)


def _solved(pieces: DataFrame) -> DataFrame:
    """Per piece its letters, cost and counts, and its rows as they will be: ``keys`` (null
    where inserted) and ``roles`` (null where kept)."""
    opened = pieces.where("open").select("conv", "part", "seq", "cost", "rank", "first_turn", "last_turn", "first_initial", "last_initial")
    plan = durable(opened.groupBy("conv").applyInArrow(_plan, _PLAN))
    joined = pieces.drop("cost", "rank", "open", "first_turn", "last_turn", "first_initial", "last_initial").join(sent(plan), ["conv", "part", "seq"], "left")

    def run(batches):
        for batch in batches:
            done, keys, roles = [], [], []
            for p in batch.to_pylist():
                whole = p["entry"] is None
                kinds, times, own = p["kinds"], np.frombuffer(p["times"], np.int64).tolist(), p["keys"]
                found = edits(kinds, *((0, SOUND_END) if whole else (p["entry"], at(p["exit"]))))
                letters, cost, taken = [], 0, 0
                row_keys, row_roles = [], []
                for kind, often, (edit, before, behind) in zip(kinds, times, found):
                    cost += ROW_STEPS[kind].cost[before][behind]
                    for _ in edit[:-1]:
                        before = NEXT[before]
                        row_keys.append(None)
                        row_roles.append(ROLES[before])
                    if kind == MUST_GO:
                        cost += DELETE * often
                        letters += (edit[:-1], "D" * often)
                        continue
                    letters.append(edit)
                    if edit[-1] != "D":
                        row_keys.append(own[32 * taken : 32 * taken + 32])
                        row_roles.append(None if edit[-1] == "K" else ROLES[behind])
                    taken += 1
                state = found[-1][2] if found else (0 if whole else p["entry"])
                for letter in TAIL[state] if whole else p["tail"]:
                    state = NEXT[state]
                    cost += INSERT
                    letters.append(letter)
                    row_keys.append(None)
                    row_roles.append(ROLES[state])
                counts = [p[c] for c in _COUNTS]
                if not whole:
                    counts[3] += p["more_illegal"]
                    counts[4] -= p["same_turn"]
                done.append((p["conv"], p["part"], p["seq"], "".join(letters), cost, *counts, p["low"], p["high"]))
                keys.append(row_keys)
                roles.append(row_roles)
            rows = _batch(_SOLVED, done)
            lists = [pa.array(keys, pa.list_(pa.binary())), pa.array(roles, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*rows.columns, *lists], names=[*rows.schema.names, "keys", "roles"])

    return map_batches(joined, run, f"{_SOLVED}, keys array<binary>, roles array<string>")


# --- results --------------------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    # Rows of a task that are worked on, and of a piece of a long conversation.
    rows_held: int = 1 << 18


@dataclass(frozen=True)
class Repair:
    """Stored tables: one row per piece of a conversation, and texts by their digests."""

    pieces: DataFrame
    keyed: DataFrame

    def report(self) -> DataFrame:
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
        whole = self.pieces.groupBy("conv").agg(
            *(F.sum(c).alias(c) for c in (*_COUNTS, "cost")),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
            F.array_sort(F.collect_list(F.struct("part", "seq", "audit"))).alias("parts"),
        )
        gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("bigint"))
        counts = ("blank", "duplicate", "truncated", "illegal", "cost")
        return whole.select("conv", _conv_id(), gaps.alias("gaps"), *counts, F.concat_ws("", "parts.audit").alias("audit"))

    def rows(self) -> DataFrame:
        """The repaired rows: conv, conv_id, role, text, in the order of part, seq, row."""
        kept = self.pieces.select("conv", "part", "seq", F.posexplode(F.arrays_zip("keys", "roles")).alias("row", "now"))
        kept = kept.select("conv", "part", "seq", "row", F.col("now.keys").alias("key"), F.col("now.roles").alias("new_role"))
        # One text for each digest; repeated rows meet before they move.
        texts = self.keyed.where("copies > 0").groupBy("conv", "key").agg(F.first("role").alias("old_role"), F.first("text").alias("text"))
        held = kept.where("key is not null").join(texts, ["conv", "key"])
        new = kept.where("key is null").withColumns({"old_role": F.lit(None).cast("string"), "text": F.lit("")})
        role = F.coalesce("new_role", "old_role").alias("role")
        return held.unionByName(new).select("conv", _conv_id(), "part", "seq", "row", role, "text")

    def hashes(self) -> DataFrame:
        """(conv, hash) of all conversations that have rows: SHA-256 of ``role:text`` lines."""
        parts = int(self.keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        lines = self.rows().select("conv", "part", "seq", "row", F.concat_ws(":", "role", "text").alias("line"))
        ordered = lines.repartition(parts, "conv").sortWithinPartitions("conv", "part", "seq", "row").select("conv", "line")

        def run(batches):
            conv, held = None, None
            for batch in (s for b in batches for s in slices(b, "line")):
                done = []
                raw, offsets = flat(batch.column("line"))
                data = memoryview(raw.tobytes())
                for name, a, b in zip(batch.column("conv").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                    if name != conv:
                        if held is not None:
                            done.append((conv, held.hexdigest()))
                        conv, held = name, hashlib.sha256()
                    else:
                        held.update(b"\n")
                    held.update(data[a:b])
                if done:
                    yield _batch("conv string, hash string", done)
            if held is not None:
                yield _batch("conv string, hash string", [(conv, held.hexdigest())])

        return map_batches(ordered, run, "conv string, hash string")


def _conv_id() -> Column:
    return F.nullif("conv", F.lit("")).cast("long").alias("conv_id")


def repair(rows: DataFrame, settings: Settings = Settings()) -> Repair:
    """Conversations given as conv_id, turn, role, text and how often a row stands (copies)."""
    keyed = _keyed(rows)
    pieces = durable(_pieces(_marks(keyed), settings.rows_held))
    return Repair(durable(_solved(pieces)), keyed)


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    repaired = repair(damaged(table(spark, folder, "conversations")))
    report = repaired.report().join(repaired.hashes(), "conv", "left")
    empty = F.lit(hashlib.sha256().hexdigest())
    return report.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.coalesce("hash", empty).alias("repaired_sha256")
    )


OP11_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i::UBIGINT AS i, i::UBIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8
), source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place
  FROM conversations
), hashed AS (
  SELECT s.*, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(place, ''), lambda x: ascii(x)::UBIGINT)),
         lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::INTEGER])), 4294967295::UBIGINT) % 20 AS kind
  FROM source s, crc
), damaged AS (
  SELECT coalesce(conv_id::VARCHAR, '') AS conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 0 THEN 0 WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hashed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(length(role)::VARCHAR || ':' || role || text), copy) AS i
  FROM damaged
), judged AS (
  SELECT *, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last,
         row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again,
         lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) || left(role, 1) AS pair
  FROM placed
), r AS (
  SELECT *, CASE WHEN last = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault
  FROM judged
), counted AS (
  SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv
), convs AS (
  SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, '') AS conv FROM conversations
), inserted(state, here, letters, lines) AS (
  -- nothing yet (n), or the last role's initial, before and after some inserted rows
  VALUES ('n', 'n', '', []::VARCHAR[]), ('n', 'u', 'I', ['user:']), ('n', 'a', 'II', ['user:', 'assistant:']),
         ('s', 's', '', []), ('s', 'u', 'I', ['user:']), ('s', 'a', 'II', ['user:', 'assistant:']),
         ('u', 'u', '', []), ('u', 'a', 'I', ['assistant:']), ('u', 'u', 'II', ['assistant:', 'user:']),
         ('a', 'a', '', []), ('a', 'u', 'I', ['user:']), ('a', 'a', 'II', ['user:', 'assistant:'])
), ways AS (
  SELECT conv, 0::BIGINT AS i, 'n' AS state, '0000000000' AS best, []::VARCHAR[] AS lines FROM convs
  UNION ALL
  SELECT conv, i, state, min(best), arg_min(lines, best)
  FROM (
    SELECT w.conv, r.i, CASE e.edit WHEN 'D' THEN s.here WHEN 'K' THEN left(r.role, 1) WHEN 'R' THEN CASE s.here WHEN 'u' THEN 'a' ELSE 'u' END END AS state,
           lpad((left(w.best, 10)::BIGINT + 5 * length(s.letters) + e.cost + CASE WHEN e.edit <> 'D' AND r.fault = 'truncated' THEN 5 ELSE 0 END)::VARCHAR, 10, '0')
             || substr(w.best, 11) || s.letters || e.edit AS best,
           w.lines || s.lines || CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [r.role || ':' || r.text]
             WHEN 'R' THEN [CASE s.here WHEN 'u' THEN 'assistant' ELSE 'user' END || ':' || r.text] END AS lines
    FROM ways w JOIN r ON r.conv = w.conv AND r.i = w.i + 1 JOIN inserted s ON s.state = w.state
    JOIN (VALUES ('D', 2), ('K', 0), ('R', 1)) e(edit, cost)
      ON e.edit = 'D' OR (r.fault IN ('sound', 'truncated') AND (e.edit = 'R'
         OR s.here || left(r.role, 1) IN ('ns', 'nu', 'su', 'au', 'ua')))
  )
  GROUP BY conv, i, state
), ended AS (
  SELECT w.conv, lpad((left(w.best, 10)::BIGINT + 5 * length(s.letters))::VARCHAR, 10, '0') || substr(w.best, 11) || s.letters AS best,
         w.lines || s.lines AS lines
  FROM ways w LEFT JOIN counted c ON c.conv = w.conv JOIN inserted s ON s.state = w.state
  WHERE w.i = coalesce(c.n, 0) AND s.here IN ('n', 'a')
), least AS (
  SELECT conv, min(best) AS best, arg_min(lines, best) AS lines FROM ended GROUP BY conv
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, left(best, 10)::BIGINT AS cost,
       substr(best, 11) AS audit, sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM convs JOIN least USING (conv) LEFT JOIN counted USING (conv)
"""
