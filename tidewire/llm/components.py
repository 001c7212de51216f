"""Connected components of a graph given as links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewire.plans.durable import durable


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a and b, long), one root per component.

    In a round every node points to the smallest of itself and its neighbours, and links are
    redrawn between what their ends point to. A star, however large, is gone after one round,
    and each round costs two joins of the links that are left. Names should not follow the
    graph's shape (hashes do not), or a long path takes a round per few nodes. Every round is
    a table in the shared folder, so a lost executor costs a re-read.
    """
    steps = []
    left = durable(links.select("a", "b").where("a <> b").distinct())
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = durable(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("to")))
        steps.append(step)
        left = durable(
            left.join(step.select(F.col("node").alias("a"), F.col("to").alias("ta")), "a")
            .join(step.select(F.col("node").alias("b"), F.col("to").alias("tb")), "b")
            .where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .distinct()
        )
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    # What a node of the first round points to may point on in the next.
    found = steps[0].select("node", F.col("to").alias("root"))
    for step in steps[1:]:
        on = step.select(F.col("node").alias("root"), "to")
        found = durable(found.join(on, "root", "left").select("node", F.coalesce("to", "root").alias("root")))
    return found
