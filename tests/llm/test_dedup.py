"""Exact dedup and the n-gram join against comparison of all rows."""

from __future__ import annotations

import random

import numpy as np
import plain
import pytest

from tidewire.llm import exact_dedup, ngram_join
from tidewire.llm.components import components
from tidewire.llm.queries import ORACLES, QUERIES
from tidewire.llm.shingles import shingle_sets
from tidewire.plans.durable import scratch_folder


def pairs(frame):
    return [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]


def test_exact_dedup_of_documents(spark, larger):
    want = plain.same(pairs(spark.read.parquet(f"{larger}/documents.parquet")))
    rows = QUERIES["op4_exact_dedup"](spark, larger).collect()
    assert len(rows) == len(want)
    for r in rows:
        assert want[r["doc_id"]] == (r["keep_id"], r["group_size"], r["text_sha256"])
        assert r["kept"] == (r["doc_id"] == r["keep_id"])


def test_exact_dedup_sql(spark, folder):
    oracle_check = pytest.importorskip("oracle_check")
    got = oracle_check.spark_rows(QUERIES["op4_exact_dedup"](spark, folder))
    assert oracle_check.difference(got, oracle_check.duck_rows(oracle_check.duck(folder), ORACLES["op4_exact_dedup"])) is None


def test_exact_dedup_of_odd_rows(spark, odd, nothing):
    index = exact_dedup.fresh_index(spark)
    rows = [r.asDict() for r in index.add(odd).collect()]
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    # Equal without white space: 4, 6 and twice 7; the longest original with the least id stays.
    assert {by_id[i]["keep_id"] for i in (4, 6, 7)} == {4} and by_id[4]["group_size"] == 4
    assert by_id[5]["keep_id"] == 5
    assert {by_id[i]["keep_id"] for i in (1, 2, 3)} == {3}
    assert by_id[None]["kept"]
    assert index.add(nothing).count() == 0


def test_index_remembers(spark):
    where = scratch_folder(spark, "test-index")
    first = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    second = spark.createDataFrame([(3, "ab"), (4, "d"), (5, "d ")], "doc_id long, text string")
    exact_dedup.DigestIndex(spark, where, 4).add(first).count()
    again = exact_dedup.DigestIndex(spark, where, 4)
    found = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in again.add(second).collect()}
    assert found == {3: (1, False), 4: (5, False), 5: (5, True)}
    assert again.rows().count() == 3


def test_a_batch_added_again_keeps_its_rows(spark):
    """As after a job that ended between the append and its answer."""
    index = exact_dedup.DigestIndex(spark, scratch_folder(spark, "test-index"), 4)
    rows = spark.createDataFrame([(1, "a b"), (2, "ab"), (3, "c")], "doc_id long, text string")
    first = sorted(map(tuple, index.add(rows).collect()))
    assert sorted(map(tuple, index.add(rows.repartition(3)).collect())) == first and index.rows().count() == 2
    assert [r["kept"] for r in index.add(rows, "another").collect()] == [False] * 3
    assert {r["kept"] for r in index.add(rows.where("doc_id = 3"), "third").collect()} == {False}


def test_kept_documents(spark, odd):
    kept = exact_dedup.kept_documents(odd, exact_dedup.fresh_index(spark))
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=lambda i: (i is None, i))
    # "a b" and "A B" differ in their letters.
    assert ids == [3, 4, 5, 8, 9, 10, 11, 12, None]
    assert kept.count() == len(ids)


def test_a_row_that_stays_is_kept_once(spark):
    rows = spark.createDataFrame([(1, "x y"), (1, "x y"), (2, "xy")], "doc_id long, text string")
    assert exact_dedup.kept_documents(rows, exact_dedup.fresh_index(spark)).collect() == [(1, "x y")]


SMALL_BLOCKS = ngram_join.Settings(block_classes=8, block_shingles=3_000, columns_at_once=64, broadcast_rows=0, common_kept=20, chunk_shingles=500, common_in_chunk=2)


@pytest.mark.parametrize("settings", [ngram_join.Settings(), SMALL_BLOCKS], ids=["whole", "blocks"])
def test_join_of_documents(spark, folder, settings):
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    want = plain.similar(pairs(documents))
    rows = ngram_join.similar_groups(documents, settings).collect()
    assert len(rows) == len(want)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == want


@pytest.mark.parametrize("settings", [ngram_join.Settings(), SMALL_BLOCKS], ids=["whole", "blocks"])
def test_join_of_a_family(spark, settings):
    """Near copies around the threshold: many links hang on pairs away from the original."""
    pick = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(pick.randrange(4)):
            words[pick.randrange(len(words))] = f"v{pick.randrange(40)}"
        rows.append((i, " ".join(words)))
    rows += [(200 + i, " ".join(pick.choices("abcdefg", k=9))) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_groups(frame, settings).collect()}
    assert got == plain.similar(rows)


def test_join_of_odd_rows(spark, odd, nothing):
    rows = ngram_join.similar_groups(odd).collect()
    assert len(rows) == odd.count()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert found[1] == (0, 1) and found[2] == (0, 2) and found[3] == (0, 3)
    assert found[4] == found[5] == found[7] == (2, 4)
    assert found[11] == found[12] == (1, 11)
    assert found[None][1] is None
    assert ngram_join.similar_groups(nothing).count() == 0
    left = ngram_join.one_of_each_group(odd)
    assert left.columns == odd.columns
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"]) == [1, 2, 3, 4, 6, 8, 9, 10, 11]


@pytest.mark.parametrize("words", [1, 2, 3, 4])
def test_shingles_of_a_slice_of_few_words(words):
    """A slice with fewer words than a shingle gives what its text gives beside others."""
    short, long = b" ".join([b"Hello", b"big", b"wide", b"world"][:words]), b"one two three four five six"
    alone, count = shingle_sets(np.frombuffer(short, np.uint8), np.array([0, len(short)]))
    both, counts = shingle_sets(np.frombuffer(short + long, np.uint8), np.array([0, len(short), len(short + long)]))
    assert count.tolist() == [1] and counts.tolist() == [1, 2]
    assert alone.tolist() == both[:1].tolist()


@pytest.mark.parametrize("words", [1, 2, 3, 4])
def test_join_of_a_single_short_row(spark, words):
    frame = spark.createDataFrame([(1, " ".join("abcd"[:words]))], "doc_id long, text string")
    assert [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.similar_groups(frame).collect()] == [(1, 1, 1)]
    assert ngram_join.one_of_each_group(frame).count() == 1


def test_join_of_short_rows_behind_a_long_one(spark):
    long = " ".join(f"word{i}" for i in range(120_000))
    rows = [(1, long), (2, "Hello world"), (3, long), (4, "hello wide world"), (5, long), (6, "Hello  WORLD")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.similar_groups(frame).collect()}
    assert len(long) > 1 << 20
    assert got == {i: (119_996, 1) for i in (1, 3, 5)} | {2: (1, 2), 4: (1, 4), 6: (1, 2)}


def test_product_counts_every_pair():
    pick = np.random.default_rng(1)
    sets = [np.unique(pick.integers(0, 60, 25)).astype(np.uint64) for _ in range(30)]
    settings, size = ngram_join.Settings(), np.array([len(s) for s in sets])
    linked = {(a, b) for a in range(30) for b in range(a) if settings.linked(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))}
    narrow = ngram_join.Settings(columns_at_once=7)
    found = ngram_join.forest(np.arange(30), ngram_join.linked_sets([x.tobytes() for x in sets], size, narrow))
    groups = [{i} for i in range(30)]
    for a, b in linked:
        one, two = next(g for g in groups if a in g), next(g for g in groups if b in g)
        if one is not two:
            groups.remove(two)
            one |= two
    assert len(found) == 30 - len(groups)
    assert all(any(a in g and b in g for g in groups) for a, b in found)


def test_components(spark):
    pick = random.Random(2)
    names = pick.sample(range(10**6), 60)
    edges = [(names[i], names[i + 1]) for i in range(29)] + [(names[30], n) for n in names[31:]]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(names[:30], min(names[:30])), **dict.fromkeys(names[30:], min(names[30:]))}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketches_discard_no_link():
    """What sketches discard is never linked, also where they have other numbers of bits."""
    pick = np.random.default_rng(4)
    settings, discarded = ngram_join.Settings(), 0
    for _ in range(60):
        base = pick.integers(0, 1 << 62, pick.integers(5, 200)).astype(np.uint64)
        sets = []
        for _ in range(8):
            own = base[pick.random(len(base)) < pick.choice([0.5, 0.9, 1.0])]
            sets.append(np.unique(np.concatenate([own, pick.integers(0, 1 << 62, pick.integers(0, 40)).astype(np.uint64)])))
        sets = [x for x in sets if len(x)]
        size = np.array([len(x) for x in sets])
        whole = ngram_join.linked_sets([x.tobytes() for x in sets], size, settings)
        may = ngram_join.possibly_linked(ngram_join.sketches(np.concatenate(sets), size), size, settings)
        assert (may == may.T).all() and not (whole & ~may).any()
        discarded += int((~may & ~whole).sum())
    assert discarded


def test_unrelated_rows_without_an_id_stay(spark):
    """Rows with no id, or with the same, are told apart by their texts."""
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [(None, a), (1, a), (None, b), (2, b + " x"), (2, a + " y z q"), (3, ""), (3, ""), (None, None)]
    left = ngram_join.one_of_each_group(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, left.collect()), key=str) == sorted([(1, a), (None, b), (2, b + " x"), (2, a + " y z q"), (3, ""), (3, ""), (None, None)], key=str)
    same = [(None, a), (None, a), (5, a + " end"), (5, a + " end"), (None, b)]
    left = ngram_join.one_of_each_group(spark.createDataFrame(same, "doc_id long, text string"))
    assert sorted(map(tuple, left.collect()), key=str) == sorted([(5, a + " end"), (None, b)], key=str)
