"""Flow-shaped views over the driver tables, for queries, tests and benchmarks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def micros(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def packets(spark: SparkSession, folder: str, captures: int = 1) -> DataFrame:
    """One packet per event; ``captures`` > 1 spreads users over that many captures."""
    events = table(spark, folder, "events")
    port = "element_at(array(22, 53, 80, 443), cast(k % 4 as int) + 1)"
    base = events.select(
        F.col("event_id").alias("seq"),
        F.expr("(unix_micros(cast(ts as timestamp)) - 1704067200000000) div 4000").alias("ts_us"),
        F.expr(
            "case event_type when 'signup' then 'UDP' when 'error' then 'ICMP' else 'TCP' end"
        ).alias("protocol"),
        F.col("user_id").alias("u"),
        F.expr("cast(get_json_object(props, '$.k') as bigint)").alias("k"),
        "value",
    ).selectExpr(
        "*",
        "seq % 3 = 0 as rev",
        "concat('10.0.0.', cast(u % 6 as string)) as client",
        "concat('10.0.1.', cast(k % 3 as string)) as server",
        "if(protocol = 'ICMP', 0, cast(40000 + u % 2 as int)) as cport",
        f"if(protocol = 'ICMP', 0, {port}) as sport",
    )
    capture = "'CAP-EVT'" if captures == 1 else f"concat('CAP-', cast(u % {captures} as string))"
    return base.selectExpr(
        "'EVT' as session_id",
        f"{capture} as capture_id",
        "seq",
        "ts_us",
        "if(rev, server, client) as src_ip",
        "if(rev, client, server) as dst_ip",
        "if(rev, sport, cport) as src_port",
        "if(rev, cport, sport) as dst_port",
        "protocol",
        "cast(least(1500, 40 + floor(value * 4)) as int) as packet_length",
        "if(protocol = 'TCP' and seq % 7 = 0, 1, 0) as syn",
        "if(protocol = 'TCP' and seq % 3 <> 1, 1, 0) as ack",
        "if(protocol = 'TCP' and seq % 29 = 0, 1, 0) as rst",
        "if(protocol = 'TCP' and seq % 23 = 0, 1, 0) as fin",
        "if(protocol = 'TCP' and seq % 5 = 0, 1, 0) as psh",
        "case when protocol <> 'ICMP' then -1 when rev then 0 else 8 end as icmp_type",
    )


def captures(spark: SparkSession, folder: str) -> DataFrame:
    """One capture per customer, with manifest fields."""
    return table(spark, folder, "customer").selectExpr(
        "c_custkey",
        "concat('cap_', lpad(cast(c_custkey as string), 7, '0')) as capture_id",
        "concat(if(c_custkey % 50 = 0, 'smoke_', 'camp_'), cast(c_nationkey % 5 as string))"
        " as campaign_id",
        "concat(if(c_custkey % 29 < 16, 'N', 'S'), lpad(cast(c_custkey % 29 as string), 2, '0'))"
        " as scenario_id",
        "if(c_custkey % 29 < 16, 'normal', 'suspect') as label_binary",
        "concat('fam_', cast((c_custkey % 29) % 11 as string)) as scenario_family",
        "if(c_acctbal < -900, 'scenario_error', 'ok') as status",
    )


def capture_flows(spark: SparkSession, folder: str) -> DataFrame:
    """One unlabelled flow per order, in the capture of its customer."""
    return table(spark, folder, "orders").selectExpr(
        "concat('cap_', lpad(cast(o_custkey as string), 7, '0')) as capture_id",
        "concat('cap_', lpad(cast(o_custkey as string), 7, '0'), '__',"
        " lpad(cast(o_orderkey as string), 8, '0')) as flow_id",
        "unix_micros(cast(o_orderdate as timestamp)) as start_us",
        "unix_micros(cast(o_orderdate as timestamp)) + (o_orderkey % 97) * 1000 as end_us",
        "cast(round(o_totalprice * 100) as bigint) % 1001 as p_milli",
        "case o_orderstatus when 'F' then 'TCP' when 'O' then 'UDP' else 'ICMP' end as protocol",
        "o_orderkey",
        "o_custkey",
    )


def labeled_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders joined to their capture: flows with label, scenario and campaign."""
    flows = capture_flows(spark, folder)
    return flows.join(captures(spark, folder), "capture_id")


def packet_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Dissected packet lines spelled from events, with the usual defects mixed in."""
    events = packets(spark, folder)
    time = "concat(cast(ts_us div 1000000 as string), '.', lpad(cast(ts_us % 1000000 as string), 6, '0'))"
    number = "case protocol when 'ICMP' then '1' when 'TCP' then '6' else '17' end"

    def only(protocol: str, column: str) -> str:
        return f"if(protocol = '{protocol}', cast({column} as string), '')"

    fields = [
        "case when seq % 83 = 0 then '-1.5' when seq % 79 = 0 then 'n/a'"
        " when seq % 101 = 0 then 'nan' when seq % 103 = 0 then 'Infinity'"
        f" when seq % 107 = 0 then '1e300' else {time} end",
        "if(seq % 89 = 0, ' ', src_ip)",
        "dst_ip",
        only("TCP", "src_port"),
        only("UDP", "src_port"),
        only("TCP", "dst_port"),
        only("UDP", "dst_port"),
        f"if(seq % 71 = 0, '47', {number})",
        "if(seq % 61 = 0, '60.9', cast(packet_length as string))",
        "if(seq % 2 = 0, if(syn = 1, 'True', 'False'), cast(syn as string))",
        "cast(ack as string)",
        "cast(rst as string)",
        "if(seq % 59 = 0, 'x', cast(fin as string))",
        "cast(psh as string)",
        "if(icmp_type < 0, '', cast(icmp_type as string))",
    ]
    quoted = ", ".join(f"concat('\"', {field}, '\"')" for field in fields)
    return events.selectExpr(
        "seq",
        f"case when seq % 97 = 0 then '\"1.0\",\"10.0.0.1\"' when seq % 73 = 0 then ''"
        f" when seq % 67 = 0 then '   ' else concat_ws(',', {quoted}) end as value",
    )


def manifest_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest lines in file order; every capture name occurs up to three times."""
    return captures(spark, folder).selectExpr(
        "c_custkey as position",
        "concat('run_', lpad(cast(c_custkey - c_custkey % 3 as string), 7, '0'), '.pcap')"
        " as pcap_name",
        "campaign_id",
        "scenario_id",
        "label_binary",
        "concat('172.30.1.', cast(20 + c_custkey % 4 as string)) as source_host",
        "status",
    )


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One manifest row per capture; one capture in seventeen has none, some lack a family."""
    return captures(spark, folder).where("c_custkey % 17 <> 0").selectExpr(
        "capture_id",
        "campaign_id",
        "scenario_id",
        "label_binary",
        "if(c_custkey % 4 = 0, '', scenario_family) as scenario_family",
        "if(c_custkey % 9 = 0, 'low', '') as severity",
        "concat('172.30.1.', cast(20 + c_custkey % 4 as string)) as source_host",
        "status",
    )


def packets_of_captures(spark: SparkSession, folder: str) -> DataFrame:
    """Packets spread over the manifest's captures, some of them controller SSH traffic."""
    customers = "pmod(u, 1000)"
    return packets(spark, folder).join(
        table(spark, folder, "events").selectExpr("event_id as seq", "user_id as u"), "seq"
    ).selectExpr(
        "seq",
        "ts_us",
        f"concat('cap_', lpad(cast({customers} as string), 7, '0')) as capture_id",
        f"if(seq % 5 = 0, concat('172.30.1.', cast(20 + {customers} % 4 as string)), src_ip)"
        " as src_ip",
        "if(seq % 5 < 2, '172.30.1.20', dst_ip) as dst_ip",
        "src_port",
        "dst_port",
        "protocol",
    )


def capture_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Captures with flow and packet counts taken from the orders behind them."""
    counts = capture_flows(spark, folder).selectExpr(
        "capture_id", "o_orderkey % 9 + 1 as packets"
    )
    per_capture = counts.groupBy("capture_id").agg(
        F.count(F.lit(1)).alias("flow_count"), F.sum("packets").alias("packet_count")
    )
    joined = captures(spark, folder).join(per_capture, "capture_id", "left")
    return joined.na.fill(0, ["flow_count", "packet_count"])


# Stand-in caps that bind on about ten flows per capture.
CAPS = {"N01": 3, "N02": 5, "N07": 2, "N11": 4, "S16": 6, "S20": 3, "S23": 1, "S27": 8}


def scored_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled flows with a model's answer and the columns the records need."""
    return labeled_flows(spark, folder).selectExpr(
        "flow_id",
        "capture_id",
        "campaign_id",
        "scenario_id",
        "label_binary",
        "if(o_orderkey % 6 = 0, scenario_family, cast(null as string)) as scenario_family",
        "if(o_orderkey % 10 = 3, 'lf_known', '') as label_family",
        "if(o_orderkey % 17 = 0, 'medium', cast(null as string)) as severity",
        "p_milli",
        "if(p_milli >= 500, 'suspect', 'normal') as raw_label",
        "map('normal', 1D - p_milli / 1000D, 'suspect', p_milli / 1000D) as probability",
        "if(o_orderkey % 13 = 0, cast(null as string), concat('10.1.', cast(o_custkey % 7 as string),"
        " '.', cast(o_orderkey % 11 as string))) as src_ip",
        "if(o_orderkey % 39 = 0, cast(null as string),"
        " concat('10.2.0.', cast(o_orderkey % 5 as string))) as dst_ip",
        "40000 + o_orderkey % 100 as src_port",
        "cast(element_at(array(22, 53, 80, 443), cast(o_custkey % 4 as int) + 1) as bigint)"
        " as dst_port",
        "protocol",
        "1 + o_orderkey % 9 as packet_count_total",
        "60 * (1 + o_orderkey % 9) + o_custkey % 50 as byte_count_total",
        "(end_us - start_us) / 1000D as duration_ms",
        "if(protocol = 'TCP', o_orderkey % 2, 0) as syn_count",
        "if(protocol = 'TCP', o_orderkey % 3, 0) as ack_count",
        "if(protocol = 'TCP', (o_orderkey div 7) % 2, 0) as rst_count",
        "if(protocol = 'TCP' and o_orderkey % 5 = 0, 1, 0) as fin_count",
        "if(protocol = 'TCP' and o_orderkey % 4 = 0, 1, 0) as psh_count",
        "start_us",
        "end_us",
        "if(o_orderkey % 19 = 0, cast(null as bigint), end_us + 500000) as finalized_us",
    )


def evaluated_flows(spark: SparkSession, folder: str) -> DataFrame:
    """Truth, prediction and score per flow, for the quality measures."""
    return labeled_flows(spark, folder).selectExpr(
        "flow_id",
        "capture_id",
        "scenario_id",
        "scenario_family",
        "label_binary as y_true",
        "if(p_milli >= 500, 'suspect', 'normal') as y_pred",
        "p_milli / 1000D as score",
        "p_milli",
    )


def raw_feature_rows(spark: SparkSession, folder: str, *more: str) -> DataFrame:
    """Contract inputs as text, with nulls, garbage, one absent and one extra column."""
    return table(spark, folder, "lineitem").selectExpr(
        "if(l_linenumber = 7, null, if(l_returnflag = 'A', 'TCP', 'UDP')) as protocol",
        "cast(40000 + l_partkey % 100 as string) as src_port",
        "if(l_partkey % 31 = 0, 'https', cast(l_suppkey % 500 as string)) as dst_port",
        "if(l_orderkey % 41 = 0, 'n/a', cast(l_discount as string)) as duration_ms",
        "if(l_orderkey % 43 = 0, null, cast(l_linenumber as string)) as packet_count_total",
        "cast(l_quantity as string) as pkt_len_mean",
        "l_returnflag as unrelated",
        *more,
    )
