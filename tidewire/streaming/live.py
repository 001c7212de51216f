"""From a packet stream to events, alerts, blocks and logs, one micro-batch at a time.

One streaming query cuts flows, keeps late packets, and adds window features, in two stateful
operators, one behind the other. Every micro-batch writes its own folder ``batch_id=N`` of each
table and replaces it when the batch is run again, so a restart neither loses nor repeats
records. ``compact`` joins the folders of finished micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidewire.functions.network import failed_connection_ratio
from tidewire.operators import detect, views
from tidewire.settings import Settings
from tidewire.streaming.flows import cut_stream, finished_flows, late_packets, with_heartbeat
from tidewire.streaming.windows import FEATURES, with_stream_windows

TABLES = ("flows", "events", "alerts", "blocks", "logs", "late")

Scorer = Callable[[DataFrame], DataFrame]


def observed_lines(parsed: DataFrame) -> DataFrame:
    """Parsed lines with counters in every progress report of the query."""
    return parsed.observe(
        "packet_lines",
        F.count(F.lit(1)).alias("lines"),
        F.count_if(F.col("reject_reason").isNotNull()).alias("packet_parse_errors"),
    )


def write_rejects(parsed: DataFrame, path: str, checkpoint: str, once: bool) -> StreamingQuery:
    """Rejected lines as a table of their own."""
    rejects = parsed.where(F.col("reject_reason").isNotNull())
    writer = rejects.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if once:
        writer = writer.trigger(availableNow=True)
    return writer.start(path)


def _folder(path: str, table: str, batch_id: int) -> str:
    return f"{path}/{table}/batch_id={batch_id}"


def _listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(place)] if system.exists(place) else []


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return place.getFileSystem(conf).exists(place)


def described_flows(cut: DataFrame) -> DataFrame:
    """All 31 features of the finished flows among the rows of one micro-batch."""
    ratio = failed_connection_ratio(F.col("protocol"), F.col("syn_count"), F.col("ack_count"), F.col("rst_count"))
    return finished_flows(cut, *FEATURES).withColumn("failed_connection_ratio", ratio)


def process_batch(
    cut: DataFrame, batch_id: int, path: str, scorer: Scorer, settings: Settings
) -> None:
    """Features, scores, decisions and records of one micro-batch of finished flows."""
    spark = cut.sparkSession
    for name in TABLES:
        compact(spark, path, name, batch_id)
    # Written once and read back: the stateful stages must not run again per table.
    cut.write.mode("overwrite").parquet(_folder(path, "finished", batch_id))
    new = spark.read.schema(cut.schema).parquet(_folder(path, "finished", batch_id))
    late_packets(new).write.mode("overwrite").parquet(_folder(path, "late", batch_id))
    described_flows(new).write.mode("overwrite").parquet(_folder(path, "flows", batch_id))
    detected = detect.detect(
        scorer(spark.read.parquet(_folder(path, "flows", batch_id))),
        alert_threshold=settings.alert_confidence_threshold,
        block_threshold=settings.block_confidence_threshold,
        mode=settings.blocking_mode,
        threshold_source="live_runtime",
    )
    events = detect.event_records(detected)
    events.write.mode("overwrite").parquet(_folder(path, "events", batch_id))
    # Alerts come from the stored events, so that both carry the same decision time.
    stored = spark.read.parquet(_folder(path, "events", batch_id))
    tables = {
        "alerts": detect.alert_records(stored),
        "blocks": detect.blocking_records(detected),
        "logs": detect.log_records(detected, stored),
    }
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(_folder(path, name, batch_id))
    _add_to_totals(stored, new.where("is_late"), batch_id, path)
    # The micro-batch before this one is finished for good, and will not be run again.
    _forget(spark, path, "finished", batch_id - 1)
    _forget(spark, path, "totals", batch_id - 2)


COUNTERS = ("finalized_flows", "predictions", "alerts", "block_decisions", "late_packets")


def _add_to_totals(events: DataFrame, late: DataFrame, batch_id: int, path: str) -> None:
    """Counters of the run up to this micro-batch: those of the one before, and its own.

    Every micro-batch writes one, also without a flow; a repeated one finds the one before it
    in its place and writes the same again.
    """
    spark = events.sparkSession
    counted = events.agg(
        F.count(F.lit(1)).alias("finalized_flows"),
        F.count(F.lit(1)).alias("predictions"),
        F.count_if("alert_triggered").alias("alerts"),
        F.count_if("blocked").alias("block_decisions"),
    ).crossJoin(late.agg(F.count(F.lit(1)).alias("late_packets")))
    before = _folder(path, "totals", batch_id - 1)
    if _exists(spark, before):
        counted = counted.unionByName(spark.read.parquet(before)).agg(*[F.sum(c).alias(c) for c in COUNTERS])
    counted.write.mode("overwrite").parquet(_folder(path, "totals", batch_id))


def totals(spark: SparkSession, path: str) -> DataFrame:
    """Flows, predictions, alerts, block decisions and late packets of the run so far: one row,
    of zeros when there is none yet. Only the newest micro-batch is read."""
    numbers = [int(name.rsplit("=", 1)[1]) for name in _listed(spark, f"{path}/totals") if "=" in name]
    if not numbers:
        return spark.range(1).select(*[F.lit(0).cast("bigint").alias(c) for c in COUNTERS])
    return spark.read.parquet(_folder(path, "totals", max(numbers)))


def run_live(
    packets: DataFrame,
    path: str,
    checkpoint: str,
    scorer: Scorer,
    settings: Settings,
    once: bool = False,
    wall_clock: bool = True,
) -> StreamingQuery:
    """Start detection on a packet stream; ``once`` stops after what is available.

    Without ``once`` the wall clock is joined in, so that flows of a line that has fallen quiet
    are closed. Packets of a recording, whose clock is not the wall's, bring control rows of
    their own (``flows.with_heartbeat``) or none: give ``wall_clock=False``.
    """
    if wall_clock and not once:
        rate = packets.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
        packets = with_heartbeat(packets, rate)

    def handle(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, path, scorer, settings)

    writer = (
        with_stream_windows(cut_stream(packets, settings), settings)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
    )
    if once:
        writer = writer.trigger(availableNow=True)
    else:
        interval = f"{round(settings.flush_interval_seconds * 1000)} milliseconds"
        writer = writer.trigger(processingTime=interval)
    return writer.start()


FAN_OUT = 16


def _folders(spark: SparkSession, path: str, table: str) -> list[tuple[int, int, str]]:
    """(first, last micro-batch, name) of a table's folders, without those that another holds."""
    found = []
    for name in _listed(spark, f"{path}/{table}"):
        kind, _, numbers = name.partition("=")
        if kind in ("batch_id", "batches"):
            first, _, last = numbers.partition("-")
            found.append((int(first), int(last or first), name))
    kept: list[tuple[int, int, str]] = []
    for first, last, name in sorted(found, key=lambda f: (f[0], -f[1])):
        if not kept or first > kept[-1][1]:
            kept.append((first, last, name))
    return kept


def compact(spark: SparkSession, path: str, table: str, batch_id: int) -> None:
    """Join the folders of the micro-batches before ``batch_id``, sixteen at a time.

    Sixteen micro-batches become one folder, sixteen of these one of the next size, so a
    record is rewritten a logarithmic number of times and there are never more than sixteen
    folders of a size. A joined folder appears by one renaming; readers then pass over what
    it was made of, which is removed after that.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = lambda name: jvm.org.apache.hadoop.fs.Path(f"{path}/{table}/{name}")
    system = place("").getFileSystem(conf)
    width = FAN_OUT
    while batch_id and batch_id % width == 0:
        first, last = batch_id - width, batch_id - 1
        parts = [f for f in _folders(spark, path, table) if first <= f[0] and f[1] <= last]
        if len(parts) > 1:
            whole = spark.read.parquet(*[f"{path}/{table}/{name}" for _, _, name in parts])
            whole.coalesce(1 + len(parts) // FAN_OUT).write.mode("overwrite").parquet(f"{path}/{table}/_joined")
            system.rename(place("_joined"), place(f"batches={first}-{last}"))
        width *= FAN_OUT
    held = {name for _, _, name in _folders(spark, path, table)}
    for name in _listed(spark, f"{path}/{table}"):
        if name.startswith(("batch_id=", "batches=")) and name not in held:
            system.delete(place(name), True)


def _forget(spark: SparkSession, path: str, table: str, batch_id: int) -> None:
    """Remove what a finished micro-batch needed for itself only."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folder(path, table, batch_id))
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def read_history(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One of the record tables, over all micro-batches."""
    return _read_folders(spark, path, table, _folders(spark, path, table))


def _read_folders(spark: SparkSession, path: str, table: str, folders: list[tuple[int, int, str]]) -> DataFrame:
    if not folders:
        raise FileNotFoundError(f"no micro-batch has written {table} yet")
    return spark.read.parquet(*[f"{path}/{table}/{name}" for _, _, name in folders])


def recent(spark: SparkSession, path: str, table: str, n: int) -> DataFrame:
    """Newest records of a table, with the number of all of them.

    Micro-batches are in the order of their decisions: folders are read from the newest on
    until they hold enough. What all hold is told by the files' footers.
    """
    ties = {"events": "event_id", "alerts": "alert_id", "blocks": "block_id", "logs": "message"}
    folders, rows, at = _folders(spark, path, table), 0, 0
    while at < len(folders) and rows < n:
        at += 1
        rows += _read_folders(spark, path, table, folders[-at : len(folders) - at + 1]).count()
    total = rows + (_read_folders(spark, path, table, folders[:-at]).count() if at < len(folders) else 0)
    newest = views.latest_with_total(_read_folders(spark, path, table, folders[-at:] if at else []), n, ties[table])
    return newest.withColumn("total_available", F.lit(total).cast(newest.schema["total_available"].dataType))


def replay_stream(
    spark: SparkSession,
    split_path: str,
    path: str,
    checkpoint: str,
    scorer: Scorer,
    files_per_batch: int = 1,
) -> StreamingQuery:
    """Replay a stored split through the model, file by file, without thresholds."""
    schema = spark.read.parquet(split_path).schema
    source = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(split_path)
    )
    decided = detect.event_records(detect.detect(scorer(source)))
    return (
        decided.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
