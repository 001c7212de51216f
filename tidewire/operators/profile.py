"""Distributions, profiles and schema comparisons."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.numbers import rounded_ratio



def _share(part: Column, whole: Column) -> Column:
    return rounded_ratio(part * 100, whole, 2)


def label_distribution(flows: DataFrame, *by: str) -> DataFrame:
    """Flows per label and the given columns, with the share inside the label."""
    counts = flows.groupBy("label_binary", *by).agg(F.count(F.lit(1)).alias("flow_count"))
    within = F.sum("flow_count").over(Window.partitionBy("label_binary"))
    return counts.withColumn("pct_within_label", _share(F.col("flow_count"), within))


def flow_distribution(flows: DataFrame, *by: str) -> DataFrame:
    """As :func:`label_distribution`, with the share of all flows as well."""
    counts = flows.groupBy("label_binary", *by).agg(F.count(F.lit(1)).alias("flow_count"))
    # A window over the distribution rows (labels x scenarios), not over flows.
    total = F.sum("flow_count").over(Window.partitionBy())
    within = F.sum("flow_count").over(Window.partitionBy("label_binary"))
    return counts.select(
        "*",
        _share(F.col("flow_count"), total).alias("pct_total"),
        _share(F.col("flow_count"), within).alias("pct_within_label"),
    )


def top_share(flows: DataFrame, by: str, top: int = 3) -> DataFrame:
    """Share of each label's flows held by its ``top`` largest groups."""
    counts = flows.groupBy("label_binary", by).agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy("label_binary").orderBy(F.desc("_n"), by)
    placed = counts.withColumn("_rank", F.row_number().over(order))
    name = f"top{top}_share_pct"
    largest = F.sum(F.when(F.col("_rank") <= top, F.col("_n")).otherwise(0))
    return placed.groupBy("label_binary").agg(_share(largest, F.sum("_n")).alias(name))


def capture_distribution(captures: DataFrame, *by: str) -> DataFrame:
    """Captures, flows, packets and mean flows per capture, with the label's share."""
    rows = captures.groupBy("label_binary", *by).agg(
        F.count(F.lit(1)).alias("capture_count"),
        F.sum("flow_count").alias("flow_count"),
        F.sum("packet_count").alias("packet_count"),
    )
    within = F.sum("capture_count").over(Window.partitionBy("label_binary"))
    return rows.select(
        "*",
        rounded_ratio(F.col("flow_count"), F.col("capture_count"), 2).alias(
            "avg_flows_per_capture"
        ),
        _share(F.col("capture_count"), within).alias("pct_captures_within_label"),
    )


def stage_summary(stages: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, captures, campaigns and label counts of each stage of a view."""
    parts = [
        frame.select(F.lit(name).alias("stage"), "campaign_id", "capture_id", "label_binary")
        for name, frame in stages.items()
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    # Flows collapse to captures first, so the distinct counts see few rows.
    per_capture = every.groupBy("stage", "campaign_id", "capture_id", "label_binary").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    return per_capture.groupBy("stage").agg(
        F.sum("_rows").alias("row_count"),
        F.countDistinct("capture_id").alias("capture_count"),
        F.countDistinct("campaign_id").alias("campaign_count"),
        F.sum(F.when(F.col("label_binary") == "normal", F.col("_rows")).otherwise(0)).alias(
            "normal_count"
        ),
        F.sum(F.when(F.col("label_binary") == "suspect", F.col("_rows")).otherwise(0)).alias(
            "suspect_count"
        ),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts per value; nulls count under ``nan``."""
    value = F.coalesce(F.col(column).cast("string"), F.lit("nan")).alias(column)
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("row_count"))


def top_values(df: DataFrame, column: str, top: int) -> DataFrame:
    """The most frequent values, ties by value."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("row_count"))
    return counts.orderBy(F.desc("row_count"), column).limit(top)


def split_profile(df: DataFrame, split: str) -> DataFrame:
    """One row per column: type, nulls and the split's size. One pass over the data."""
    names = df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.array(
            *[
                F.struct(
                    F.lit(field.name).alias("column_name"),
                    F.lit(field.dataType.simpleString()).alias("dtype"),
                    F.count_if(F.col(field.name).isNull()).alias("null_count"),
                )
                for field in df.schema
            ]
        ).alias("_columns"),
    )
    return wide.select(
        F.lit(split).alias("split"),
        F.col("_rows").alias("row_count"),
        F.lit(len(names)).alias("column_count"),
        F.inline("_columns"),
    )


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Null counts, range, mean and population deviation per column, in one pass."""

    def stats(name: str) -> Column:
        number = F.col(name).try_cast("double")
        return F.struct(
            F.lit(name).alias("feature_name"),
            F.count(number).alias("non_null_count"),
            F.count_if(number.isNull()).alias("null_count"),
            F.round(F.count_if(number.isNull()) / F.count(F.lit(1)), 6).alias("null_rate"),
            F.round(F.min(number), 6).alias("min"),
            F.round(F.max(number), 6).alias("max"),
            F.round(F.avg(number), 6).alias("mean"),
            F.round(F.stddev_pop(number), 6).alias("std"),
        )

    return df.agg(F.array(*[stats(c) for c in columns]).alias("_stats")).select(F.inline("_stats"))


def categorical_profile(df: DataFrame, columns: list[str], top: int = 5) -> DataFrame:
    """Null counts per column and its most frequent values as a JSON object."""
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("feature_name"),
                        F.coalesce(F.col(c).cast("string"), F.lit("None")).alias("value"),
                        F.col(c).isNull().cast("long").alias("null"),
                    )
                    for c in columns
                ]
            )
        )
    )
    # Nulls are shown as ``None`` and count together with that text.
    counts = pairs.groupBy("feature_name", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum("null").alias("nulls")
    )
    totals = counts.groupBy("feature_name").agg(
        F.sum(F.col("n") - F.col("nulls")).alias("non_null_count"),
        F.sum("nulls").alias("null_count"),
    )
    order = Window.partitionBy("feature_name").orderBy(F.desc("n"), "value")
    best = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    entries = F.array_sort(F.collect_list(F.struct("rank", "value", "n")))
    listed = best.groupBy("feature_name").agg(
        F.to_json(
            F.map_from_entries(
                F.transform(entries, lambda e: F.struct(e["value"], e["n"]))
            )
        ).alias("top_values")
    )
    rate = F.col("null_count") / (F.col("non_null_count") + F.col("null_count"))
    return totals.join(listed, "feature_name").select(
        "feature_name",
        "non_null_count",
        "null_count",
        F.round(rate, 6).alias("null_rate"),
        "top_values",
    )


_DRIFT = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("position", T.IntegerType()),
        T.StructField("dtype", T.StringType()),
    ]
)


def schema_drift(tables: Mapping[str, DataFrame], reference: str) -> DataFrame:
    """Where tables differ from the reference table: one row per differing column.

    ``finding`` is ``missing``, ``extra``, ``dtype`` or ``position``. Only schemas are
    compared; no table is read.
    """
    spark = tables[reference].sparkSession
    rows = [
        (name, field.name, place, field.dataType.simpleString())
        for name, frame in tables.items()
        for place, field in enumerate(frame.schema)
    ]
    fields = spark.createDataFrame(rows, _DRIFT)
    base = fields.where(F.col("table_name") == reference).select(
        "column_name", F.col("position").alias("want_position"), F.col("dtype").alias("want_dtype")
    )
    names = [name for name in tables if name != reference]
    expected = base.select("*", F.explode(F.array(*map(F.lit, names))).alias("table_name"))
    seen = fields.where(F.col("table_name") != reference)
    both = expected.join(seen, ["table_name", "column_name"], "full")
    finding = (
        F.when(F.col("dtype").isNull(), "missing")
        .when(F.col("want_dtype").isNull(), "extra")
        .when(F.col("dtype") != F.col("want_dtype"), "dtype")
        .when(F.col("position") != F.col("want_position"), "position")
    )
    return both.withColumn("finding", finding).where(F.col("finding").isNotNull())


def table_signature(df: DataFrame) -> DataFrame:
    """Row count and an order-free hash: equal tables give equal signatures.

    A row is its cells as text, nulls marked, in column order; the hash is the sum of
    the first fifteen hexadecimal digits of the rows' MD5.
    """
    cells = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in df.columns]
    digits = F.substring(F.md5(F.concat_ws("|", *cells)), 1, 15)
    number = F.conv(digits, 16, 10).cast("decimal(38,0)")
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(number), F.lit(0)).cast("string").alias("content_sum"),
    )


def type_misfits(df: DataFrame, group: str, types: Mapping[str, str]) -> DataFrame:
    """Per group and column: rows, nulls, and texts that are not of the wanted type.

    Finds the campaign whose table drifted, by its values. One pass and one shuffle of a
    row per group and task.
    """

    def cell(name: str, kind: str) -> Column:
        held = F.col(name).isNotNull()
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("expected_type"),
            F.count_if(~held).alias("null_count"),
            F.count_if(held & F.col(name).try_cast(kind).isNull()).alias("misfit_count"),
        )

    counts = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("row_count"), F.array(*[cell(n, k) for n, k in types.items()]).alias("_cells")
    )
    return counts.select(group, "row_count", F.inline("_cells"))
