"""Decontamination, and the pipeline's stages against plain versions of them."""

from __future__ import annotations

import random
import zlib

import corpus_pipeline
import plain
import pytest
import test_packing

from tidewire.llm import decontaminate, language_id
from tidewire.plans.durable import durable


def test_distance_search():
    pick = random.Random(1)
    for _ in range(150):
        pattern = "".join(pick.choices("abc ", k=pick.randrange(1, 70)))
        text = "".join(pick.choices("abc ", k=pick.randrange(90)))
        assert decontaminate.Myers(pattern).best(text) == plain.distance(pattern, text)


def test_no_leak_is_missed():
    """Items of few letters, cut and changed at random, against a search of all places."""
    pick = random.Random(2)
    items = [(i, "".join(pick.choices("abcde ", k=pick.randrange(20, 60)))) for i in range(12)]
    matcher = decontaminate.Matcher(items, 0.1)
    for _ in range(150):
        text = list(pick.choice(items)[1])
        for _ in range(pick.randrange(6)):
            place = pick.randrange(len(text))
            text[place : place + pick.randrange(2)] = pick.choices("abcde", k=pick.randrange(2))
        whole = "".join(pick.choices("abcde ", k=20)) + "".join(text) + "".join(pick.choices("abcde ", k=20))
        low = decontaminate.plain(whole)
        want = [(i, d) for i, t in items if (p := decontaminate.plain(t)) and (d := plain.distance(p, low)) <= decontaminate.budget(len(p), 0.1)]
        assert matcher.leaks(whole) == want


def test_leaks_of_odd_rows(spark, odd, nothing):
    items = spark.createDataFrame([(1, "one two three four five six"), (2, "one two three four five six"), (3, None), (None, "x"), (4, " ")], "item_id long, text string")
    for settings in (decontaminate.Settings(), decontaminate.Settings(part_chars=10)):
        out = decontaminate.find_leaks(odd, items, settings)
        assert out.count() == odd.count() and out.columns.count("leaks") == 1
        found = {r["doc_id"]: [tuple(x) for x in r["leaks"]] for r in out.collect()}
        assert found[4] == found[5] == found[7] == [(1, 0), (2, 0)]
        assert not any(found[i] for i in (1, 2, 3, 6, 8, 9, 10, 11))
        assert decontaminate.find_leaks(nothing, items, settings).count() == 0
    assert decontaminate.find_leaks(odd, items.limit(0)).where("size(leaks) > 0").count() == 0
    clean = decontaminate.clean_documents(odd, items)
    assert clean.columns == odd.columns
    assert not {4, 5, 7} & {r["doc_id"] for r in clean.collect()}


@pytest.fixture(scope="module")
def stages(spark, folder):
    """Every stage's input and output on the smallest tables."""
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    found = [documents]
    for _, stage in corpus_pipeline.STAGES:
        found.append(durable(stage(spark, found[-1], folder)))
    return found


def rows_of(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_stages_keep_the_columns(stages):
    for frame in stages[:-1]:
        assert frame.schema.simpleString() == stages[0].schema.simpleString()


def test_language_stage(stages):
    before, after = rows_of(stages[0]), rows_of(stages[1])
    training = stages[0].collect()
    model = language_id.train(stages[0].where(f"doc_id in ({','.join(str(r['doc_id']) for r in training if zlib.crc32(str(r['doc_id']).encode()) % 4 != 2)})"))
    assert set(after) == {i for i, t in before.items() if not model.classify(t or "")[2]}
    assert len(after) > 0.95 * len(before)


def test_exact_stage(stages):
    want = plain.same(list(rows_of(stages[1]).items()))
    assert set(rows_of(stages[2])) == {keep for keep, _, _ in want.values()}


def test_join_stage(stages):
    want = plain.similar(list(rows_of(stages[2]).items()))
    assert set(rows_of(stages[3])) == {component for _, component in want.values()}


def test_decontamination_stage(spark, folder, stages):
    items = [decontaminate.plain(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    before, after = rows_of(stages[3]), rows_of(stages[4])
    for i, text in before.items():
        if any(item in decontaminate.plain(text) for item in items):
            assert i not in after
    assert len(after) > 0.8 * len(before)


def test_packing_stage(stages):
    rows = stages[5].collect()
    assert {r["doc_id"] for r in rows} == set(rows_of(stages[4]))
    test_packing.check_sequences(rows)


def test_run_is_all_stages(spark, folder, stages):
    got = corpus_pipeline.run(spark, folder).select("doc_id", "start", "ids_crc32").collect()
    assert sorted(got) == sorted(stages[5].select("doc_id", "start", "ids_crc32").collect())


def test_stages_take_odd_rows(spark, folder, odd, nothing):
    for frame in (odd, nothing.selectExpr("*", "'s' as source", "1L as n_chars")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, folder)
            if name != "packing":
                assert out.columns == frame.columns, name
            assert out.count() >= 0
