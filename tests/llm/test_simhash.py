"""SimHash near duplicates against comparison of all fingerprints."""

from __future__ import annotations

import numpy as np
import plain
import xxhash

from tidewire.llm import simhash
from tidewire.llm.queries import QUERIES


def fingerprint(text):
    words = [w for w in plain.SPACES.split(plain.lower(text)) if w]
    rows = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in rows]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def groups(values, errors=4):
    """The smallest index of each one's component."""
    parent = list(range(len(values)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= errors):
            x, y = sorted((find(i), find(i + 1 + int(j))))
            parent[y] = x
    return [find(i) for i in range(len(values))]


def result(frame):
    return {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in frame.collect()}


def test_documents(spark, larger):
    rows = {r["doc_id"]: fingerprint(r["text"]) for r in spark.read.parquet(f"{larger}/documents.parquet").collect()}
    ids = sorted(rows)
    names = groups(np.array([rows[i] for i in ids], np.uint64))
    got = result(QUERIES["op13_simhash"](spark, larger))
    assert got == {i: (f"{rows[i]:016x}", ids[c]) for i, c in zip(ids, names)}


def crowd(pick):
    """Clusters of fingerprints a few bits apart, and strangers."""
    values = list(pick.integers(0, 1 << 63, 150))
    for base in pick.integers(0, 1 << 63, 6):
        for _ in range(60):
            values.append(base ^ sum({1 << int(k) for k in pick.integers(0, 63, pick.integers(0, 6))}))
    return np.unique(np.array(values).astype(np.uint64))


def test_trie_finds_all_components():
    pick = np.random.default_rng(0)
    for settings in (simhash.Settings(few=1, pairs_at_once=16), simhash.Settings(few=4, pairs_at_once=64), simhash.Settings()):
        for _ in range(6):
            values = crowd(pick)
            trie = simhash.Trie(values, settings)
            trie.join(np.array([[0, len(values), 0, len(values), 0]]), 0)
            want = groups(values)
            names = dict(zip(trie.root.tolist(), want))
            assert [names[r] for r in trie.root.tolist()] == want and len(names) == len(set(want))
            assert sum(len(a) for a, _ in trie.links) == len(values) - len(set(want))


def test_a_dense_crowd_is_no_list_of_pairs():
    """All 65 536 fingerprints of sixteen free bits: a tree of links, in little time."""
    values = np.arange(1 << 16, dtype=np.uint64) << np.uint64(20)
    trie = simhash.Trie(values, simhash.Settings())
    trie.join(np.array([[0, len(values), 0, len(values), 0]]), 0)
    assert len(set(trie.root.tolist())) == 1 and sum(len(a) for a, _ in trie.links) == len(values) - 1


def test_units_are_taken_down_until_they_are_small(spark):
    values = crowd(np.random.default_rng(3))
    frame = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "value long")
    settings = simhash.Settings(unit_rows=8, held_rows=40, top=2)
    found = []
    for units, depth in simhash._units(frame, settings):
        found += [(r["a"], r["b"]) for r in simhash._links(units, depth, settings).collect()]
    names = {int(n): i for i, n in enumerate(simhash.mix(values).view(np.int64))}
    parent = list(range(len(values)))

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in found:
        x, y = sorted((root(names[a]), root(names[b])))
        parent[y] = x
    assert [root(i) for i in range(len(values))] == groups(values)


def test_odd_rows(spark, odd, nothing):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    found = {r["doc_id"]: (r["value"], r["component_id"]) for r in rows}
    # No words: fingerprint zero, linked like any other.
    assert found[1] == found[2] == found[3] == (0, 1)
    assert found[4] == found[5] == found[7] and found[4][1] == 4
    assert found[11] == found[12] and found[11][1] == 11 and found[None][1] is None
    for r in odd.collect():
        assert found[r["doc_id"]][0] % 2**64 == fingerprint(r["text"])
    assert simhash.near_duplicates(nothing).count() == 0
