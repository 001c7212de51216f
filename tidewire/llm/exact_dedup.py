"""Exact deduplication against a persistent digest index.

The index is a Parquet table of one row per distinct text, bucketed and sorted by the
text's SHA-256. A new batch is reduced to one row per digest before anything but ids and
digests moves, is held against the index by a sort-merge anti-join that needs no shuffle
of the index, and what is new is appended to the same buckets.

Defined results: a null text is the empty one; a null id sorts after all others; repeated
rows are rows of the same group; an empty batch adds nothing; columns other than ``doc_id``
and ``text`` are ignored by ``add`` and kept as they are by ``kept_documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm.common import doc_columns, free_name, sent, table, without
from tidewire.plans.durable import durable, scratch_folder

# A digest with more than one in so many rows of a batch is joined by broadcast; there can
# be no more than this many such digests, whatever the batch holds.
HOT_SHARE = 1000

_COLUMNS = "digest BINARY, keep_id BIGINT, keep_chars INT, size BIGINT, batch STRING"


def digest(text: Column) -> Column:
    """SHA-256 of the text without blanks and line ends."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]", ""), 256))


def chars(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def _rank() -> Column:
    """Orders rows of equal text: longest original first, then the smallest id."""
    return F.struct(-F.col("chars"), F.col("doc_id").isNull(), F.col("doc_id"))


class DigestIndex:
    """One index in ``folder``; opening the same folder again continues it.

    ``buckets`` must be the number the index was made with.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int):
        self.spark = spark
        self.name = f"digest_index_{uuid.uuid5(uuid.NAMESPACE_URL, folder).hex}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({_COLUMNS}) USING parquet CLUSTERED BY (digest)"
            f" SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{folder}'"
        )

    def rows(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def add(self, docs: DataFrame, batch: str | None = None) -> DataFrame:
        """Append the batch's new texts; a decision for every row of the batch.

        ``batch`` names the batch; by default a hash of its rows does. Texts that the index
        holds under the same name count as the batch's own, and are not appended again, so a
        job that ended after the append may simply add the batch once more. Returns doc_id, digest, chars, keep_id, group_size, kept. ``keep_id`` is the row that
        stays, of this batch or of an earlier one; rows of a text that an earlier batch
        brought are all dropped, and ``group_size`` is then its size in that batch. A row that
        stands several times with the same id is ``kept`` each time.
        """
        rows = durable(doc_columns(docs).select("doc_id", digest(F.col("text")).alias("digest"), chars(F.col("text")).alias("chars")))
        groups = durable(rows.groupBy("digest").agg(F.min(_rank()).alias("first"), F.count(F.lit(1)).alias("size")))
        if batch is None:
            # Whatever the order of rows: sums of their hashes, and how many there are.
            sums = [F.sum(F.xxhash64(F.lit(seed), "doc_id", "digest", "chars").cast("decimal(20,0)")) for seed in (1, 2)]
            batch = uuid.uuid5(uuid.NAMESPACE_OID, "|".join(map(str, rows.agg(F.count(F.lit(1)), *sums).first()))).hex
        fresh = groups.join(self.rows().select("digest").hint("merge"), "digest", "left_anti")
        fresh.select(
            "digest",
            F.col("first.doc_id").alias("keep_id"),
            (-F.col("first.col1")).cast("int").alias("keep_chars"),
            "size",
            F.lit(batch).alias("batch"),
        ).write.insertInto(self.name)
        known = self.rows()
        # A huge group would be one task of the join; such groups are few and go by broadcast.
        limit = max(2, rows.count() // HOT_SHARE)
        hot = groups.where(F.col("size") > limit).select("digest")
        known_hot = known.join(F.broadcast(hot), "digest", "left_semi")
        joined = rows.join(F.broadcast(known_hot), "digest").unionByName(
            rows.join(F.broadcast(hot), "digest", "left_anti").join(known.hint("merge"), "digest")
        )
        mine = F.col("batch") == batch
        return joined.select(
            "doc_id",
            "digest",
            "chars",
            "keep_id",
            F.col("size").alias("group_size"),
            (mine & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))).alias("kept"),
        )


def drop_index(index: DigestIndex) -> None:
    """Forget the index's table; its files stay where they are."""
    index.spark.sql(f"DROP TABLE IF EXISTS {index.name}")


def fresh_index(spark: SparkSession) -> DigestIndex:
    """An empty index in a new folder, with as many buckets as a shuffle has partitions."""
    return DigestIndex(spark, scratch_folder(spark, "digest-index"), int(spark.conf.get("spark.sql.shuffle.partitions")))


def kept_documents(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """Rows of ``docs`` that the index does not hold yet, one of each text."""
    decided = durable(index.add(docs))
    marks = {"digest": free_name(docs, "digest"), "chars": free_name(docs, "chars")}
    marked = docs.withColumns({marks["digest"]: digest(F.col("text")), marks["chars"]: chars(F.col("text"))})
    keys = ["doc_id", *marks.values()]
    decided = decided.select("doc_id", "kept", *(F.col(k).alias(v) for k, v in marks.items()))
    gone = durable(decided.where("not kept").select(*keys).distinct())
    # The row that stays may stand several times; such ids are few or the input is odd.
    often = durable(decided.where("kept").groupBy(*keys).count().where("count > 1").select(*keys))
    left = without(marked, gone, *keys)
    once = without(left, often, *keys)
    again = left.join(sent(often), keys, "left_semi").dropDuplicates(keys)
    return once.select(*docs.columns).unionByName(again.select(*docs.columns))


def op4_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    index = fresh_index(spark)
    decided = durable(index.add(table(spark, folder, "documents")))
    drop_index(index)
    return decided.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h
  FROM documents
), w AS (
  SELECT doc_id, h, first_value(doc_id) OVER (PARTITION BY h ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY h) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM w
"""
