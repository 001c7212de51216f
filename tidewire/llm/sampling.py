"""The bounded, labelled training sample of the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_PARTS = 1_000_000


def usable_labels(labels: DataFrame, label: str, usable: Column) -> DataFrame:
    """(doc_id, label): labels of 0 or 1 that may be learnt from; of repeated ones the larger."""
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(usable)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows_per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """About ``rows_per_class`` labelled documents of each class, and all labels counted.

    ``usable`` tells by ``doc_id`` which labels may be learnt from. Of repeated labels of one
    document the larger counts; labels other than 0 and 1 do not. The sample is picked by a
    hash of the id, so it is the same in every run; it is bounded, and so is its broadcast.
    Of rows with the same id one counts, that whose text has the smallest hash. Null ids are
    never in the sample; an empty table gives an empty one. Returns doc_id, text, label (int).
    """
    own = usable_labels(labels, label, usable)
    counts = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col("label") == value, F.lit(min(_PARTS, _PARTS * rows_per_class // max(n, 1)))).otherwise(share)
    picked = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(_PARTS)) < share)
    found = docs.join(F.broadcast(picked), "doc_id").select("doc_id", "text", "label")
    order = F.struct(F.xxhash64("text"), "text")
    return found.groupBy("doc_id", "label").agg(F.min(order)["text"].alias("text")).select("doc_id", "text", "label"), counts
