"""Model quality from (truth, prediction, score) rows.

Input columns: ``y_true`` and ``y_pred`` (labels) and ``score`` (probability of the
positive label). ``by`` columns, such as model and split, give one result per group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.plans.ordered import by_group_size, lay_out, running_sum
from tidewire.schemas import POSITIVE_LABEL
from tidewire.settings import Settings



def confusion_counts(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by, "y_true", "y_pred").agg(F.count(F.lit(1)).alias("row_count"))


def confusion_matrix(rows: DataFrame, *by: str) -> DataFrame:
    """Dense grid over all labels seen as truth or prediction.

    The grid is built from the labels of the counted pairs, never from rows.
    """
    counts = confusion_counts(rows, *by)
    labels = F.array_sort(F.collect_set("label"))
    seen = counts.select(*by, F.explode(F.array("y_true", "y_pred")).alias("label"))
    seen = seen.groupBy(*by).agg(labels.alias("_labels"))
    grid = seen.select(*by, F.explode("_labels").alias("y_true"), "_labels").select(
        *by, "y_true", F.explode("_labels").alias("y_pred")
    )
    joined = grid.join(counts, [*by, "y_true", "y_pred"], "left")
    return joined.select(
        *by, "y_true", "y_pred", F.coalesce("row_count", F.lit(0)).alias("row_count")
    )


def _ratio(part: Column, whole: Column) -> Column:
    """Zero when there is nothing to divide by."""
    return F.when(whole > 0, part / whole).otherwise(0.0)


def classification_metrics(rows: DataFrame, *by: str) -> DataFrame:
    """Accuracy, balanced accuracy, precision, recall, F1, FPR and mean score."""
    truth = F.col("y_true") == POSITIVE_LABEL
    guess = F.col("y_pred") == POSITIVE_LABEL
    counts = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("y_true") == F.col("y_pred")).alias("_right"),
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"),
        F.count_if(~truth & ~guess).alias("tn"),
        F.round(F.avg("score"), 6).alias("mean_probability_suspect"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    specificity = _ratio(tn, tn + fp)
    balanced = (
        F.when(tp + fn == 0, specificity)
        .when(tn + fp == 0, recall)
        .otherwise((recall + specificity) / 2)
    )
    return counts.select(
        *by,
        "rows",
        F.round(F.col("_right") / F.col("rows"), 6).alias("accuracy"),
        F.round(balanced, 6).alias("balanced_accuracy"),
        F.round(precision, 6).alias("precision_suspect"),
        F.round(recall, 6).alias("recall_suspect"),
        F.round(_ratio(2 * tp, 2 * tp + fp + fn), 6).alias("f1_suspect"),
        F.round(_ratio(fp, fp + tn), 6).alias("false_positive_rate"),
        "tn",
        "fp",
        "fn",
        "tp",
        "mean_probability_suspect",
    )


def classification_report(rows: DataFrame, *by: str) -> DataFrame:
    """Precision, recall, F1 and support per class, plus macro and weighted averages."""
    pairs = confusion_counts(rows, *by)
    sides = pairs.select(
        *by,
        F.inline(
            F.array(
                F.struct(
                    F.col("y_true").alias("label"),
                    F.col("row_count").alias("_support"),
                    F.lit(0).cast("long").alias("_predicted"),
                    F.when(F.col("y_true") == F.col("y_pred"), F.col("row_count"))
                    .otherwise(0)
                    .alias("_hit"),
                ),
                F.struct(
                    F.col("y_pred").alias("label"),
                    F.lit(0).cast("long").alias("_support"),
                    F.col("row_count").alias("_predicted"),
                    F.lit(0).cast("long").alias("_hit"),
                ),
            )
        ),
    )
    sums = sides.groupBy(*by, "label").agg(
        F.sum("_support").alias("support"),
        F.sum("_predicted").alias("_predicted"),
        F.sum("_hit").alias("_hit"),
    )
    hit, support, predicted = F.col("_hit"), F.col("support"), F.col("_predicted")
    per_class = sums.select(
        *by,
        "label",
        _ratio(hit, predicted).alias("precision"),
        _ratio(hit, support).alias("recall"),
        _ratio(2 * hit, support + predicted).alias("f1_score"),
        "support",
    )
    measures = ["precision", "recall", "f1_score"]
    total = F.sum("support")
    macro = per_class.groupBy(*by).agg(
        F.lit("macro avg").alias("label"),
        *[F.avg(m).alias(m) for m in measures],
        total.alias("support"),
    )
    weighted = per_class.groupBy(*by).agg(
        F.lit("weighted avg").alias("label"),
        *[(F.sum(F.col(m) * F.col("support")) / total).alias(m) for m in measures],
        total.alias("support"),
    )
    every = per_class.unionByName(macro).unionByName(weighted)
    return every.select(
        *by, "label", *[F.round(m, 6).alias(m) for m in measures], "support"
    )


def roc_auc(rows: DataFrame, settings: Settings, *by: str) -> DataFrame:
    """Exact area under the ROC curve; ties count half, null with one class only.

    Rows collapse to one per distinct score before anything is ordered, and the
    running sum over scores is sliced when even those are too many for one task.
    """
    positive = F.col("y_true") == POSITIVE_LABEL
    scores = rows.groupBy(*by, "score").agg(
        F.count_if(positive).alias("_pos"), F.count_if(~positive).alias("_neg")
    )
    keys = list(by)

    def build(part: DataFrame, sliced: bool) -> DataFrame:
        laid = lay_out(part, keys, ["score"], sliced)
        return running_sum(laid, keys, ["score"], {"_below": F.col("_neg")}, sliced)

    summed = by_group_size(scores, keys, settings.max_group_rows, build)
    # Twice the rank sum, in whole numbers: negatives below plus half of those tied.
    doubled = F.col("_pos").cast("decimal(38,0)") * (2 * F.col("_below") - F.col("_neg"))
    totals = summed.groupBy(*by).agg(
        F.sum(doubled).alias("_doubled"),
        F.sum("_pos").alias("_pos"),
        F.sum("_neg").alias("_neg"),
    )
    both = (F.col("_pos") > 0) & (F.col("_neg") > 0)
    area = (
        F.col("_doubled").cast("double")
        / F.lit(2.0)
        / F.col("_pos").cast("double")
        / F.col("_neg").cast("double")
    )
    return totals.select(*by, F.when(both, F.round(area, 6)).alias("roc_auc_suspect"))


def scenario_breakdown(rows: DataFrame) -> DataFrame:
    """Size, accuracy, predicted and true suspect rate per scenario, largest first."""
    breakdown = rows.groupBy("scenario_id", "scenario_family").agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count_if(F.col("y_true") == F.col("y_pred")) / F.count(F.lit(1))).alias("accuracy"),
        (F.count_if(F.col("y_pred") == POSITIVE_LABEL) / F.count(F.lit(1))).alias(
            "predicted_suspect_rate"
        ),
        (F.count_if(F.col("y_true") == POSITIVE_LABEL) / F.count(F.lit(1))).alias(
            "true_suspect_rate"
        ),
    )
    return breakdown.orderBy(F.desc("rows"), "scenario_id")


def model_comparison(rows: DataFrame, settings: Settings) -> DataFrame:
    """Metric rows per model and split, with ROC-AUC."""
    by = ("model", "split")
    metrics = classification_metrics(rows, *by).drop("tn", "fp", "fn", "tp")
    return metrics.drop("mean_probability_suspect").join(
        roc_auc(rows, settings, *by), list(by), "left"
    )
