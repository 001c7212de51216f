"""Conversation repair against a plain search of all edits, and against SQL."""

from __future__ import annotations

import random

import plain
import pytest

from tidewire.llm import conversations
from tidewire.llm.queries import ORACLES, QUERIES

ROLES = ["user", "assistant", "system", "tool", "assistant", "user", "", "User"]


def kinds_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        solid = plain.SPACES.sub("", text)
        gone = not solid or (role, text) in seen
        out.append(8 if gone else {"s": 2, "u": 4, "a": 6}.get(role[:1], 0) + (solid[-1] not in ".!?"))
        seen.add((role, text))
    return bytes(out)


def random_rows(pick, most):
    texts = ["", "a.", "b", "c!", " \t"]
    return [(i, pick.choice(ROLES), pick.choice([*texts, f"d{i}.", f"e{i}?"])) for i in range(pick.randrange(most))]


def audit_of(kinds):
    found = conversations.edits(kinds)
    return "".join(e[0] for e in found) + conversations.TAIL[found[-1][2] if found else 0]


def test_edits_are_the_least_ones():
    pick = random.Random(1)
    for _ in range(1500):
        rows = random_rows(pick, 14)
        assert audit_of(kinds_of(rows)) == plain.repaired(rows)[6], rows


def test_pieces_give_the_edits_of_the_whole():
    pick = random.Random(2)
    for _ in range(600):
        kinds = bytes(pick.choice([8, 0, 1, 2, 3, 4, 5, 6, 7, 4, 6]) for _ in range(pick.randrange(40)))
        cuts = sorted(pick.randrange(len(kinds) + 1) for _ in range(3))
        pieces = [kinds[a:b] for a, b in zip([0, *cuts], [*cuts, len(kinds)])]
        way = conversations.states([conversations.piece_step(p) for p in pieces], 0, conversations.SOUND_END)
        parts = [conversations.edits(p, a, conversations.at(b)) for p, a, b in zip(pieces, way, way[1:])]
        assert "".join(e[0] for p in parts for e in p) + conversations.TAIL[way[-1]] == audit_of(kinds)


def test_a_long_conversation_takes_little():
    """Vectors repeat, so a quarter of a million rows are done in seconds."""
    kinds = bytes(random.Random(3).choice([8, 3, 4, 5, 6, 7, 4, 6]) for _ in range(250_000))
    assert len(audit_of(kinds)) >= len(kinds)


def test_repair_of_documents_and_sql(spark, larger):
    oracle_check = pytest.importorskip("oracle_check")
    frame = QUERIES["op11_conversation_repair"](spark, larger)
    got = {r[0]: tuple(r[1:]) for r in frame.collect()}
    source = spark.read.parquet(f"{larger}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert got == {c: plain.repaired(rows) for c, rows in plain.damage(map(tuple, source.collect())).items()}
    assert oracle_check.difference(oracle_check.spark_rows(frame), oracle_check.duck_rows(oracle_check.duck(larger), ORACLES["op11_conversation_repair"])) is None


def test_repair_of_odd_rows(spark):
    """Nulls everywhere, ties, repeats, a conversation over many pieces, clashing names."""
    pick = random.Random(5)
    rows = [(1, None, None, None), (1, 2, "user", "x."), (1, 2, "assistant", "y."), (1, 2, "user", "x."), (None, 1, "user", "q?"), (None, None, None, "z")]
    rows += [(7, t, r, x) for t, r, x in random_rows(pick, 30)] + [(8, i // 3, pick.choice(ROLES), pick.choice(["a.", "b", f"{i}.", ""])) for i in range(400)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as conv", "2 as part", "3 as seq", "4L as copies")
    want = {c: plain.repaired(r) for c, r in plain.damage(rows).items()}
    for held in (1 << 18, 7):
        done = conversations.repair(conversations.damaged(frame.repartition(5)), conversations.Settings(rows_held=held))
        hashes = {r["conv"]: r["hash"] for r in done.hashes().collect()}
        empty = plain.hashlib.sha256().hexdigest()
        got = {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], hashes.get(r["conv"], empty)) for r in done.report().collect()}
        assert got == want
    assert conversations.repair(conversations.damaged(frame.limit(0))).report().count() == 0
