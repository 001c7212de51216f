"""Manifests, campaign tables, splits, and what is written back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.operators.labeling import last_per_key
from tidewire.plans.ordered import SLICE, latest, running_sum
from tidewire.schemas import CAPTURE_SUMMARY_COLUMNS, MANIFEST_COLUMNS, SPLITS

_SUMMARY_COUNTS = ["packet_count", "flow_count"]


# Stands for a comma between cells; no text file holds this character.
_CELL_END = "\0"


def csv_cells(record: Column) -> Column:
    """Cells of one CSV record, however many; quotes are taken off, empty cells are null.

    Cut at its quotes, every other part of a record is outside of them (a doubled quote
    leaves an empty part), so the work grows with the record's length only.
    """
    parts = F.transform(
        F.split(record, '"', -1),
        lambda part, i: F.when(i % 2 == 0, F.replace(part, F.lit(","), F.lit(_CELL_END))).otherwise(part),
    )
    cells = F.split(F.array_join(parts, '"'), _CELL_END, -1)

    def cell(raw: Column) -> Column:
        quoted = (F.length(raw) >= 2) & raw.startswith('"') & raw.endswith('"')
        inner = F.replace(F.substring(raw, F.lit(2), F.length(raw) - 2), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(quoted, inner).otherwise(raw), F.lit(""))

    return F.transform(cells, cell)


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(path, position, record): the records of CSV files; blank ones are left out.

    A line continues the record before it while the quotes up to there are odd in number.
    Quotes are summed within the blocks in which files are read and then over blocks, and
    so is the beginning of the record, so one file may be many tasks. ``position`` grows
    along a file. A line break within quotes comes back as a line feed.
    """
    place = F.col("_metadata.file_block_start")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        place.alias(SLICE),
        # A line is at least one byte long, so rows of a block never reach the next offset.
        (place * 2 + row).alias("position"),
    )
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    counted = running_sum(lines, ["path"], ["position"], {"_quotes": quotes}, True)
    begins = F.when((F.col("_quotes") - quotes) % 2 == 0, F.col("position"))
    marked = latest(counted, ["path"], ["position"], "_begin", begins, True)
    parts = F.array_sort(F.collect_list(F.struct("position", "value")))
    records = marked.groupBy("path", "_begin").agg(F.array_join(parts["value"], "\n").alias("record"))
    return records.where(F.length(F.trim("record")) > 0).select("path", F.col("_begin").alias("position"), "record")


def read_csv_by_header(spark: SparkSession, path: str, wanted: Sequence[str]) -> DataFrame:
    """CSV files whose headers differ, as one scan: columns by name, absent ones null.

    ``path`` may be a glob over any number of files. The header of each file is its first
    record; headers, one row per file, are joined back to the records. ``_position``
    orders the records of a file, and files by path.
    """
    records = csv_records(spark, path).select(
        "path", F.struct("path", "position").alias("_position"), csv_cells(F.col("record")).alias("cells")
    )
    headers = records.groupBy("path").agg(
        F.min_by("cells", "_position").alias("names"), F.min("_position").alias("_first")
    )
    body = records.join(headers, "path").where(F.col("_position") > F.col("_first"))

    def cell(name: str) -> Column:
        place = F.array_position("names", F.lit(name)).cast("int")
        return F.when(place > 0, F.get("cells", place - 1)).alias(name)

    return body.select(*[cell(c) for c in wanted], "_position")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows by capture file; a repeated file name keeps its last row.

    Manifests of different age have different columns.
    """
    rows = read_csv_by_header(spark, path, [*MANIFEST_COLUMNS, "severity"]).withColumn(
        "capture_id", F.regexp_replace("pcap_name", r"\.[^.]*$", "")
    )
    kept = last_per_key(rows, "pcap_name", ["_position"]).drop("_position")
    return kept.withColumns(
        {c: F.col(c).try_cast("long") for c in ("run_index", "packet_count")}
    )


def read_capture_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Capture summaries of several campaigns, columns aligned by name."""
    rows = read_csv_by_header(spark, path, CAPTURE_SUMMARY_COLUMNS).drop("_position")
    return rows.withColumns({c: F.col(c).try_cast("long") for c in _SUMMARY_COUNTS})


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of tables that may lack some of each other's columns."""
    if not frames:
        raise FileNotFoundError("no campaign tables were found")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


_WIDENING = ("tinyint", "smallint", "int", "bigint", "float", "double")


def common_type(one: str, other: str) -> str:
    """The narrower of the types that hold both: by width for numbers, else a string."""
    if one == other or other == "void":
        return one
    if one == "void":
        return other
    if one in _WIDENING and other in _WIDENING:
        wider = max(one, other, key=_WIDENING.index)
        # A float does not hold all whole numbers of 32 bits or more.
        return "double" if wider == "float" and {one, other} & {"int", "bigint"} else wider
    return "string"


def align(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of tables that lack some of each other's columns or give them other types."""
    types: dict[str, str] = {}
    for frame in frames:
        for name, kind in frame.dtypes:
            types[name] = common_type(types.get(name, kind), kind)
    return union_by_name([f.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in f.columns]) for f in frames])


def matching_paths(spark: SparkSession, path: str) -> list[str]:
    """What a glob stands for; Spark's own file systems are asked, so any storage will do."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return sorted(f.getPath().toString() for f in found or [])


def read_flows(spark: SparkSession, path: str) -> DataFrame:
    """Flow tables of all campaigns under a glob, aligned by name.

    A column may be missing in some campaigns, or whole numbers in one and fractions in
    another (which is what a missing value makes of them in many writers). Campaigns of
    the same schema are one scan; only schemas, not rows, are looked at beforehand.
    """
    by_schema: dict[str, list[str]] = {}
    schemas = {}
    for table in matching_paths(spark, path):
        schema = spark.read.option("mergeSchema", "true").parquet(table).schema
        schemas[schema.json()] = schema
        by_schema.setdefault(schema.json(), []).append(table)
    return align([spark.read.schema(schemas[key]).parquet(*group) for key, group in by_schema.items()] if by_schema else [])


def write_splits(flows: DataFrame, path: str) -> None:
    """Flows with a ``split`` column, one folder per split, sorted for later readers."""
    ordered = flows.sortWithinPartitions("split", "start_us", "end_us", "flow_id")
    ordered.write.mode("overwrite").partitionBy("split").parquet(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split; only its folder is listed and read."""
    if split not in SPLITS:
        raise KeyError(f"unknown split: {split}")
    return spark.read.parquet(path).where(F.col("split") == split).drop("split")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_json_summary(summary: Mapping[str, DataFrame], path: str) -> None:
    """Each named table as a JSON dataset of its own under ``path``."""
    for name, frame in summary.items():
        frame.write.mode("overwrite").json(f"{path}/{name}")


def append_history(df: DataFrame, path: str) -> None:
    """Append records; how many of them count as history is decided when reading."""
    df.write.mode("append").parquet(path)
