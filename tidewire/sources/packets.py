"""Dissected packet lines: fifteen comma-separated fields, usually quoted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.network import flag_value, lenient_double, lenient_int, protocol_name
from tidewire.schemas import PACKET_FLAGS, PACKET_LINE_FIELDS

_CSV_SCHEMA = ", ".join(f"{name} string" for name in [*PACKET_LINE_FIELDS, "_malformed"])
_FLAG_FIELDS = dict(
    zip(
        PACKET_FLAGS,
        ["tcp_flags_syn", "tcp_flags_ack", "tcp_flags_reset", "tcp_flags_fin", "tcp_flags_push"],
    )
)


def parse_packet_lines(
    lines: DataFrame, column: str = "value", strict_numeric_flags: bool = False
) -> DataFrame:
    """Parse one packet per line; ``reject_reason`` is null for usable packets.

    A line is rejected when it has fewer fields than expected (an empty one has none), no
    usable time, or a blank address. Everything else is read leniently, with defaults.
    """
    rest = [c for c in lines.columns if c != column]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_malformed"}
    fields = F.from_csv(F.col(column), F.lit(_CSV_SCHEMA), options)
    # A generator, because the optimizer would copy a plain parse into every use of it.
    # It gives nothing at all for a line without a field.
    blank = F.trim(F.coalesce(F.col(column), F.lit(""))) == ""
    row = lines.select(*rest, blank.alias("_blank"), F.inline(F.array(fields)))
    field = F.col
    # The parser gives null for a blank field and for an absent one, but hands back lines of
    # another number of fields; only in those are commas counted.
    outside_quotes = F.regexp_replace(field("_malformed"), '"[^"]*"', "")
    commas = F.length(outside_quotes) - F.length(F.replace(outside_quotes, F.lit(","), F.lit("")))
    short = F.col("_blank") | F.coalesce(commas < len(PACKET_LINE_FIELDS) - 1, F.lit(False))

    ports = {
        f"_{n}": lenient_int(field(n), 0)
        for n in ("tcp_srcport", "udp_srcport", "tcp_dstport", "udp_dstport")
    }
    read = row.select(
        *rest,
        lenient_double(field("frame_time_epoch"), -1.0).alias("_seconds"),
        F.coalesce(F.trim(field("ip_src")), F.lit("")).alias("src_ip"),
        F.coalesce(F.trim(field("ip_dst")), F.lit("")).alias("dst_ip"),
        *[c.alias(n) for n, c in ports.items()],
        protocol_name(lenient_int(field("ip_proto"), -1)).alias("protocol"),
        lenient_int(field("frame_len"), 0).alias("packet_length"),
        *[
            flag_value(field(source), strict_numeric_flags).alias(flag)
            for flag, source in _FLAG_FIELDS.items()
        ],
        lenient_int(field("icmp_type"), -1).alias("icmp_type"),
        short.alias("_short"),
    ).withColumn(
        # No time at all, or none that fits, for "nan", "Infinity" and "1e300".
        "_micros", F.round(F.col("_seconds") * 1_000_000).try_cast("long")
    )

    def port(side: str) -> Column:
        return (
            F.when(F.col("protocol") == "TCP", F.col(f"_tcp_{side}port"))
            .when(F.col("protocol") == "UDP", F.col(f"_udp_{side}port"))
            .otherwise(0)
        )

    reason = (
        F.when(F.col("_short"), "short_line")
        .when((F.col("_seconds") < 0) | F.col("_micros").isNull(), "bad_time")
        .when((F.col("src_ip") == "") | (F.col("dst_ip") == ""), "blank_address")
    )
    return read.select(
        *rest,
        F.col("_micros").alias("ts_us"),
        "src_ip",
        "dst_ip",
        port("src").alias("src_port"),
        port("dst").alias("dst_port"),
        "protocol",
        "packet_length",
        *PACKET_FLAGS,
        "icmp_type",
        reason.alias("reject_reason"),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull())


def read_packet_lines(spark: SparkSession, path: str, session_id: str) -> DataFrame:
    """Lines of all capture files under ``path``, with capture and arrival order.

    The capture is the file name without extension. ``seq`` grows with the position in
    the file: byte offset of the split first, row within the split second, both taken
    from the file itself so that a re-read numbers lines the same way.
    """
    lines = spark.read.text(path)
    file_name = F.col("_metadata.file_name")
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return lines.select(
        "value",
        F.lit(session_id).alias("session_id"),
        F.regexp_replace(file_name, r"\.[^.]*$", "").alias("capture_id"),
        F.col("_metadata.file_block_start").alias("_offset"),
        row.alias("_row"),
    ).select(
        "value",
        "session_id",
        "capture_id",
        # A line is at least one byte long, so rows of a split never reach the next offset.
        (F.col("_offset") * 2 + F.col("_row")).alias("seq"),
    )


def packet_line_stream(
    spark: SparkSession, path: str, session_id: str, files: int = 1
) -> DataFrame:
    """The same lines as a stream of new files, ``files`` per micro-batch.

    A stream has no position in the file. ``seq`` is a hash of the line instead: it
    orders packets of the same microsecond, the same way on every attempt.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files).text(path)
    return lines.select(
        "value",
        F.lit(session_id).alias("session_id"),
        F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("capture_id"),
        F.xxhash64("value").alias("seq"),
    )
