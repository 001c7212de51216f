"""Ordered work (running sums, previous/next rows, ranks) over groups of any size.

A plain window puts one group into one task. That is the best plan for groups up
to a known size, and a dead end for a group that holds a third of the table. So:

* :func:`by_group_size` finds the groups above a limit and sends them down a second
  branch;
* in that branch :func:`lay_out` range-partitions on (group, order), which cuts one
  group into many slices of equal size, and stores the result so that slice numbers
  can never change under a retry;
* :func:`running_sum`, :func:`previous`, :func:`latest` and :func:`following` then work per slice and
  add what crosses slice borders. At most one group crosses each border, so the
  table of carried values has at most two rows per slice and is broadcast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.plans.durable import durable

SLICE = "_slice"
_SAMPLED_PER_HEAVY_GROUP = 1000
_SEED = 17
_MAX_LISTED_KEYS = 10_000
_MAX_BROADCAST_KEYS = 1_000_000


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys], F.lit(True)
    )


def heavy_groups(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame | None:
    """Keys of groups with about ``limit`` rows or more, or None when there are none.

    Counting every group exactly would shuffle nearly as much as the work itself when
    groups are many and small. So a thin sample is counted, large enough that a group of
    ``limit`` rows shows up about a thousand times; half of that already counts as heavy,
    which makes a miss practically impossible. The sample only picks the branch: both
    branches are exact and keep every row. There are at most 2 x rows/limit such keys.
    A short list comes back to the driver and becomes part of the plan, a longer one is
    stored.
    """
    fraction = min(1.0, _SAMPLED_PER_HEAVY_GROUP / limit)
    rows = df.select(*keys)
    threshold = limit
    if fraction < 1.0:
        rows = rows.sample(fraction, seed=_SEED)
        threshold = _SAMPLED_PER_HEAVY_GROUP / 2
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    heavy = counts.where(F.col("_n") > threshold).select(*(keys or ["_n"]))
    listed = heavy.limit(_MAX_LISTED_KEYS + 1).collect()
    if not listed:
        return None
    if len(listed) <= _MAX_LISTED_KEYS:
        return df.sparkSession.createDataFrame(listed, heavy.schema)
    return durable(heavy)


def by_group_size(
    df: DataFrame,
    keys: Sequence[str],
    limit: int,
    build: Callable[[DataFrame, bool], DataFrame],
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Run ``build(rows, sliced)`` once for ordinary groups and, if any, once for heavy ones.

    ``sizes`` may name a cheaper table to count: one with at least as many rows per
    group, such as the packets behind a flow table.
    """
    heavy = heavy_groups(df if sizes is None else sizes, keys, limit)
    if heavy is None:
        return build(df, False)
    if not keys:
        return build(df, True)
    # The bound above is checked, too: a longer list is joined without a broadcast.
    listed = F.broadcast(heavy) if heavy.count() <= _MAX_BROADCAST_KEYS else heavy
    ordinary = df.join(listed, null_safe(df, heavy, keys), "left_anti")
    sliced = df.join(listed, null_safe(df, heavy, keys), "left_semi")
    return build(ordinary, False).unionByName(build(sliced, True))


def lay_out(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], sliced: bool
) -> DataFrame:
    """Add the slice number. Unsliced rows stay where they are, in slice 0."""
    if not sliced:
        return df.withColumn(SLICE, F.lit(0))
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(slices, *keys, *order)
    return durable(ranged.withColumn(SLICE, F.spark_partition_id()))


def _group(keys: Sequence[str], sliced: bool) -> list[str]:
    return [*keys, SLICE] if sliced else list(keys)


def _carry_in(
    df: DataFrame, carry: DataFrame, keys: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """Left-join the border table (at most two rows per slice) and drop its keys."""
    on = [*keys, SLICE]
    renamed = carry.select(
        *[F.col(k).alias(f"_carry_{k}") for k in on],
        *[F.col(n).alias(f"_carry_{n}") for n in names],
    )
    match = reduce(
        lambda a, b: a & b, [df[k].eqNullSafe(renamed[f"_carry_{k}"]) for k in on]
    )
    joined = df.join(F.broadcast(renamed), match, "left")
    return joined.drop(*[f"_carry_{k}" for k in on])


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, Column],
    sliced: bool,
) -> DataFrame:
    """Inclusive running sums; ``order`` must be unique within a group."""
    group = _group(keys, sliced)
    window = (
        Window.partitionBy(*group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = df.select("*", *[F.sum(c).over(window).alias(n) for n, c in sums.items()])
    if not sliced:
        return local
    earlier = (
        Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    )
    totals = df.groupBy(*group).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    carry = totals.select(
        *group,
        *[F.sum(n).over(earlier).alias(n) for n in sums],
        F.count(F.lit(1)).over(earlier).alias("_before"),
    ).where("_before > 0")
    out = _carry_in(local, carry, keys, list(sums))
    for name in sums:
        out = out.withColumn(name, F.col(name) + F.coalesce(F.col(f"_carry_{name}"), F.lit(0)))
    return out.drop(*[f"_carry_{n}" for n in sums])


def previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    value: Column,
    sliced: bool,
) -> DataFrame:
    """``value`` of the row before, null on the first row of the group."""
    group = _group(keys, sliced)
    window = Window.partitionBy(*group).orderBy(*order)
    local = df.withColumn(name, F.lag(F.struct(value.alias("v"))).over(window))
    if sliced:
        ends = df.groupBy(*group).agg(
            F.max_by(F.struct(value.alias("v")), F.struct(*order)).alias(name)
        )
        across = Window.partitionBy(*keys).orderBy(SLICE)
        carry = ends.withColumn(name, F.lag(name).over(across)).where(F.col(name).isNotNull())
        local = _carry_in(local, carry, keys, [name])
        local = local.withColumn(name, F.coalesce(name, f"_carry_{name}")).drop(f"_carry_{name}")
    return local.withColumn(name, F.col(name)["v"])


def latest(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    value: Column,
    sliced: bool,
) -> DataFrame:
    """Last non-null ``value`` at or before the row, null when there is none."""
    group = _group(keys, sliced)
    window = (
        Window.partitionBy(*group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = df.withColumn(name, F.last(value, ignorenulls=True).over(window))
    if sliced:
        earlier = (
            Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
        )
        ends = df.groupBy(*group).agg(
            F.max_by(value, F.when(value.isNotNull(), F.struct(*order))).alias(name)
        )
        carry = ends.withColumn(name, F.last(name, ignorenulls=True).over(earlier)).where(
            F.col(name).isNotNull()
        )
        local = _carry_in(local, carry, keys, [name])
        local = local.withColumn(name, F.coalesce(name, f"_carry_{name}")).drop(f"_carry_{name}")
    return local


def following(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    value: Column,
    sliced: bool,
) -> DataFrame:
    """First non-null ``value`` strictly after the row, null when there is none.

    The window runs in descending order: a frame that starts at the far end grows by
    one row per step, while one that ends there is recomputed for every row.
    """
    group = _group(keys, sliced)
    backwards = [F.col(c).desc() for c in order]
    window = (
        Window.partitionBy(*group)
        .orderBy(*backwards)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = df.withColumn(name, F.last(value, ignorenulls=True).over(window))
    if sliced:
        later = (
            Window.partitionBy(*keys)
            .orderBy(F.col(SLICE).desc())
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        starts = df.groupBy(*group).agg(
            F.min_by(value, F.when(value.isNotNull(), F.struct(*order))).alias(name)
        )
        carry = starts.withColumn(name, F.last(name, ignorenulls=True).over(later)).where(
            F.col(name).isNotNull()
        )
        local = _carry_in(local, carry, keys, [name])
        local = local.withColumn(name, F.coalesce(name, f"_carry_{name}")).drop(f"_carry_{name}")
    return local


def ranked(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    limit: int,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Row number from 1 by ``order`` (unique within a group), for groups of any size."""

    def build(rows: DataFrame, sliced: bool) -> DataFrame:
        laid = lay_out(rows, keys, order, sliced)
        return running_sum(laid, keys, order, {name: F.lit(1)}, sliced).drop(SLICE)

    return by_group_size(df, keys, limit, build, sizes)
