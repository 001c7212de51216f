"""Deterministic training-set reduction: per-capture caps and label balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewire.plans.durable import durable

FLOW_ORDER = ["start_us", "end_us", "flow_id"]


def cap_of(scenario: Column, caps: dict[str, int]) -> Column:
    """The cap of a scenario, null when it has none."""
    if not caps:
        return F.lit(None).cast("int")
    table = F.create_map(*[F.lit(v) for pair in caps.items() for v in pair])
    return F.try_element_at(table, scenario)


def cap_captures(flows: DataFrame, caps: dict[str, int]) -> DataFrame:
    """Keep the first flows of each capture, as many as its scenario's cap allows.

    Uncapped scenarios pass without a shuffle. For the others the largest cap bounds
    the rank, so each task drops what cannot be kept before anything is shuffled.
    """
    if not caps:
        return flows
    capped = flows.withColumn("_cap", cap_of(F.col("scenario_id"), caps))
    order = Window.partitionBy("capture_id").orderBy(*FLOW_ORDER)
    first = (
        capped.where(F.col("_cap").isNotNull())
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= max(caps.values()))
        .where(F.col("_rank") <= F.col("_cap"))
    )
    free = capped.where(F.col("_cap").isNull())
    return first.select(*flows.columns).unionByName(free.select(*flows.columns))


def cap_audit(flows: DataFrame, caps: dict[str, int]) -> DataFrame:
    """Flow counts per capture before and after the cap; counts only, no ranking."""
    counts = flows.groupBy("capture_id").agg(
        F.min("scenario_id").alias("scenario_id"),
        F.min("scenario_family").alias("scenario_family"),
        F.min("label_binary").alias("label_binary"),
        F.count(F.lit(1)).alias("original_flow_count"),
    )
    cap = cap_of(F.col("scenario_id"), caps)
    kept = F.least(F.col("original_flow_count"), cap.cast("long"))
    return counts.select(
        "*", kept.alias("capped_flow_count"), cap.alias("cap_applied")
    )


def balance_labels(flows: DataFrame, digits: int = 5) -> DataFrame:
    """Cut every label down to the smallest one, keeping the smallest ``md5(flow_id)``.

    There are two or three labels, so ranking inside a label would put half the table
    into one task. Instead flows are counted per leading hash digits; the counts tell in
    which cell each label's quota ends. Only the flows of that one cell, one in
    16**digits, are ranked, and their cut-off is then a filter on the whole table.
    """
    hashed = flows.where(F.col("label_binary").isNotNull()).withColumn(
        "_hash", F.md5(F.col("flow_id"))
    )
    hashed = hashed.withColumn("_cell", F.substring("_hash", 1, digits))
    # At most labels x 16**digits rows, stored because three steps below read them.
    cells = durable(hashed.groupBy("label_binary", "_cell").agg(F.count(F.lit(1)).alias("_n")))
    totals = cells.groupBy("label_binary").agg(F.sum("_n").alias("_total"))
    # One row per label: small enough for a window without partitions.
    smallest = F.min("_total").over(Window.partitionBy())
    quota = totals.select("label_binary", smallest.alias("_quota"))
    upto = (
        Window.partitionBy("label_binary")
        .orderBy("_cell")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    before = F.col("_upto") - F.col("_n")
    edge = (
        cells.withColumn("_upto", F.sum("_n").over(upto))
        .join(quota, "label_binary")
        .where((F.col("_upto") >= F.col("_quota")) & (before < F.col("_quota")))
        .select("label_binary", "_cell", (F.col("_quota") - before).alias("_left"))
    )
    # One row per label on the broadcast side, here and below.
    order = Window.partitionBy("label_binary").orderBy("_hash", "flow_id")
    cutoff = (
        hashed.select("label_binary", "_cell", "_hash", "flow_id")
        .join(F.broadcast(edge), ["label_binary", "_cell"])
        .withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") == F.col("_left"))
        .select("label_binary", F.struct("_hash", "flow_id").alias("_cutoff"))
    )
    return (
        hashed.join(F.broadcast(cutoff), "label_binary")
        .where(F.struct("_hash", "flow_id") <= F.col("_cutoff"))
        .select(*flows.columns)
    )


def training_view(flows: DataFrame, caps: dict[str, int]) -> DataFrame:
    """Cap, store the capped flows, then balance."""
    return balance_labels(durable(cap_captures(flows, caps)))
