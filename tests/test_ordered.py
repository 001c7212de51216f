from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewire.plans.ordered import (
    by_group_size,
    following,
    heavy_groups,
    latest,
    lay_out,
    previous,
    ranked,
    running_sum,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds more than a third of the rows, one key is null."""
    rng = random.Random(3)
    rows = [(0 if n % 3 == 0 else rng.choice([1, 2, 3, None]), n * 7 % 601, n % 5) for n in range(601)]
    return spark.createDataFrame(rows, "k int, at int, v int")


def test_heavy_groups_of_a_large_table(spark):
    """Above a thousand rows the limit is checked on a sample."""
    rows = spark.range(300_000).selectExpr("if(id % 3 = 0, 0, id) as k")
    assert [r["k"] for r in heavy_groups(rows, ["k"], 50_000).collect()] == [0]
    assert heavy_groups(rows, ["k"], 500_000) is None


def test_heavy_groups(skewed):
    assert heavy_groups(skewed, ["k"], 10_000) is None
    assert [r["k"] for r in heavy_groups(skewed, ["k"], 150).collect()] == [0]


@pytest.mark.parametrize("limit", [5, 150, 10_000])
def test_scans_equal_plain_windows(skewed, limit):
    keys, order = ["k"], ["at"]
    some = F.when(F.col("v") > 2, F.col("v"))

    def build(rows, sliced):
        laid = lay_out(rows, keys, order, sliced)
        laid = running_sum(laid, keys, order, {"total": F.col("v")}, sliced)
        laid = previous(laid, keys, order, "before", F.col("v"), sliced)
        laid = latest(laid, keys, order, "kept", some, sliced)
        laid = following(laid, keys, order, "ahead", some, sliced)
        return laid.select("k", "at", "total", "before", "kept", "ahead")

    got = by_group_size(skewed, keys, limit, build)
    plain = Window.partitionBy("k").orderBy("at")
    upto = plain.rowsBetween(Window.unboundedPreceding, 0)
    after = plain.rowsBetween(1, Window.unboundedFollowing)
    want = skewed.select(
        "k",
        "at",
        F.sum("v").over(upto).alias("total"),
        F.lag("v").over(plain).alias("before"),
        F.last(some, ignorenulls=True).over(upto).alias("kept"),
        F.first(some, ignorenulls=True).over(after).alias("ahead"),
    )
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


@pytest.mark.parametrize("limit", [5, 10_000])
def test_rank_without_keys(skewed, limit):
    got = {r["at"]: r["n"] for r in ranked(skewed, [], ["at"], "n", limit).collect()}
    assert got == {at: at + 1 for at in range(601)}
