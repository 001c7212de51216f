"""Capture-level train/validation/test plans and the flows they select."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.plans.ordered import ranked
from tidewire.schemas import SPLITS
from tidewire.settings import Settings

# Order in which captures of a group are dealt out.
BY_LABEL = ("label_binary", ["campaign_id", "scenario_id", "capture_id"])
BY_SCENARIO = ("scenario_id", ["campaign_id", "capture_id"])


def split_name(rank: Column, total: Column) -> Column:
    """70/15/15 by rank, each part at least one when there are three or more."""
    validation = F.greatest(F.lit(1), F.bround(total * 0.15).cast("long"))
    test = F.greatest(F.lit(1), total - F.bround(total * 0.7).cast("long") - validation)
    train = total - validation - test
    large = (
        F.when(rank <= train, "train").when(rank <= train + validation, "validation")
    ).otherwise("test")
    return F.when(total >= 3, large).when(rank == 1, "train").otherwise("test")


def assign_splits(
    captures: DataFrame, plan: tuple[str, list[str]], settings: Settings
) -> DataFrame:
    """Add ``split``: captures are dealt out in order within each label or scenario."""
    group, order = plan
    present = captures.where(F.col(group).isNotNull())
    totals = present.groupBy(group).agg(F.count(F.lit(1)).alias("_total"))
    placed = ranked(present, [group], order, "_rank", settings.max_group_rows)
    return placed.join(totals, group).select(
        *captures.columns, split_name(F.col("_rank"), F.col("_total")).alias("split")
    )


def flows_with_split(flows: DataFrame, plan: DataFrame) -> DataFrame:
    """Flows of planned captures with their split."""
    return flows.join(plan.select("capture_id", "split"), "capture_id")


def flows_of_split(flows: DataFrame, plan: DataFrame, split: str) -> DataFrame:
    """Flows whose capture the plan puts into ``split``."""
    if split not in SPLITS:
        raise KeyError(f"unknown split: {split}")
    chosen = plan.where(F.col("split") == split).select("capture_id")
    return flows.join(chosen, "capture_id", "left_semi")


def split_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy("split", "label_binary").agg(F.count(F.lit(1)).alias("capture_count"))


def split_family_presence(plan: DataFrame) -> DataFrame:
    return plan.groupBy("split", "scenario_family").agg(
        F.count(F.lit(1)).alias("capture_count")
    )


def split_flow_distribution(flows: DataFrame, plan: DataFrame, *by: str) -> DataFrame:
    """Flows per split and the given flow columns."""
    return flows_with_split(flows, plan).groupBy("split", *by).agg(
        F.count(F.lit(1)).alias("flow_count")
    )
