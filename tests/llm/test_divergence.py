"""Divergence of sources against sums over all terms."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from tidewire.llm import divergence
from tidewire.llm.queries import ORACLES, QUERIES

import plain


def diverged(rows, least):
    """Rows of the result from (lang, source, text), term by term and pair by pair."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", plain.lower(text))
        counts[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: c for (at, s), c in counts.items() if at == lang}
        whole = sum(own.values(), Counter())

        def share(c, kept=kept):
            total = sum(c[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // total for t in kept}

        q, p = share(whole), {s: share(c) for s, c in own.items()}
        for s in own:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if own[s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, 50)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(found[:most], 1)]
    return sorted(out)


def test_divergence_of_documents_and_sql(spark, larger):
    oracle_check = pytest.importorskip("oracle_check")
    got = oracle_check.spark_rows(QUERIES["op12_divergence"](spark, larger))
    assert oracle_check.difference(got, oracle_check.duck_rows(oracle_check.duck(larger), ORACLES["op12_divergence"])) is None
    rows = spark.read.parquet(f"{larger}/documents.parquet").select("lang", "source", "text").collect()
    order = [got[0].index(c) for c in ("lang", "source", "part", "item", "value", "rank")]
    assert sorted(tuple(r[i] for i in order) for r in got[1]) == diverged(map(tuple, rows), 30)


def test_divergence_of_odd_rows(spark, odd):
    """Nulls, groups without terms, languages without kept terms, small holdings of a task."""
    pick = np.random.default_rng(1)
    rows = [(None, None, None), ("en", "a", ""), ("en", None, "1 2 3"), ("xx", "a", "rare words"), ("xx", "b", None), ("yy", "only", "Ä ä Ärger ärger")]
    words = ["Alpha", "beta", "gamma", "Été", "ete", "x", "中文"]
    rows += [("en", str(s), " ".join(pick.choice(words, pick.integers(1, 9)))) for s in pick.integers(0, 9, 300)]
    frame = spark.createDataFrame(rows * 2, "lang string, source string, text string").selectExpr("*", "1 as place", "2 as term", "3 as p", "4 as n")
    for settings in (divergence.Settings(), divergence.Settings(terms_held=3, pairs_held=2, text_bytes=4)):
        assert sorted(map(tuple, divergence.divergence(frame, settings).collect())) == diverged(rows * 2, 30)
    assert divergence.divergence(frame.limit(0)).count() == 0
    one = spark.createDataFrame([("en", "a", "t"), ("en", "a", "t")], "lang string, source string, text string")
    assert divergence.divergence(one, divergence.Settings(min_documents=1)).count() == 0


def test_tree_adds_up_all_pairs():
    pick = np.random.default_rng(2)
    zero = pick.integers(1, 50, 6)
    rows = sorted([(i, int(zero[i] + pick.integers(1, 4))) for i in range(6) if pick.random() < 0.6] for _ in range(200))
    tree, want = divergence.PatternTree(), defaultdict(int)
    for row in filter(None, rows):
        place, p = (np.array(x, np.int64) for x in zip(*row))
        tree.insert(place, p, zero[place], 3)
        for j, (b, v) in enumerate(row):
            for a, u in row[:j]:
                want[a, b] += 3 * (abs(u - v) - abs(u - zero[b]) - abs(zero[a] - v) + abs(zero[a] - zero[b]))
    got = tree.corrections("en").to_pydict()
    assert {(a, b): v for a, b, v in zip(got["a"], got["b"], got["value"])} == {k: v for k, v in want.items() if v}
