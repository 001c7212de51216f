from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidewire.operators import profile
from tidewire.operators.labeling import label_flows
from tidewire.schemas import FEATURES
from tidewire.sources import contract, packets, tables

GOOD = '"1.5","10.0.0.1","10.0.0.2","1234","","443","","6","60","1","True","0","0","0",""'


def parse(spark, *lines, **options):
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    return packets.parse_packet_lines(frame, **options).collect()


def test_packet_line(spark):
    (row,) = parse(spark, GOOD)
    assert row["reject_reason"] is None
    assert (row["ts_us"], row["src_port"], row["dst_port"]) == (1_500_000, 1234, 443)
    assert (row["protocol"], row["packet_length"], row["icmp_type"]) == ("TCP", 60, -1)
    assert (row["syn"], row["ack"]) == (1, 1)


def test_strict_flags_read_words_as_zero(spark):
    (row,) = parse(spark, GOOD, strict_numeric_flags=True)
    assert (row["syn"], row["ack"]) == (1, 0)


def test_unquoted_and_lenient_fields(spark):
    line = "2,10.0.0.1,10.0.0.2,,53,,5353,17,60.9,x,,,,,8"
    (row,) = parse(spark, line)
    assert row["reject_reason"] is None
    assert (row["src_port"], row["dst_port"], row["packet_length"]) == (53, 5353, 60)
    assert (row["syn"], row["icmp_type"]) == (0, 8)


def test_rejects(spark):
    lines = ['"1.0","10.0.0.1"', GOOD.replace("1.5", "-2"), GOOD.replace("10.0.0.1", " "), ""]
    reasons = [r["reject_reason"] for r in parse(spark, *lines)]
    assert reasons == ["short_line", "bad_time", "blank_address", "short_line"]


def test_packet_files(spark, tmp_path):
    for name in ("cap_a", "cap_b"):
        lines = [GOOD.replace("1234", str(n)) for n in range(50)]
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    read = packets.read_packet_lines(spark, str(tmp_path), "S")
    rows = packets.accepted(packets.parse_packet_lines(read)).collect()
    assert {r["capture_id"] for r in rows} == {"cap_a", "cap_b"}
    for name in ("cap_a", "cap_b"):
        mine = sorted((r for r in rows if r["capture_id"] == name), key=lambda r: r["seq"])
        assert [r["src_port"] for r in mine] == list(range(50))


def test_manifests_of_different_age(spark, tmp_path):
    old, new = tmp_path / "old.csv", tmp_path / "new.csv"
    old.write_text(
        "campaign_id,scenario_id,label_binary,pcap_name,status\n"
        "c1,N20,normal,a.pcap,ok\nc1,S01,suspect,b.pcap,ok\nc1,N21,normal,a.pcap,retried\n"
    )
    new.write_text(
        "campaign_id,run_index,scenario_id,scenario_family,label_binary,pcap_name\n"
        "c2,3,S05,my_family,suspect,c.pcap\n"
    )
    rows = tables.read_manifest(spark, str(tmp_path / "*.csv"))
    got = {r["capture_id"]: r for r in rows.collect()}
    assert got["a"]["status"] == "retried" and got["a"]["scenario_id"] == "N21"
    assert got["c"]["run_index"] == 3 and got["b"]["scenario_family"] is None
    flows = spark.createDataFrame([(c,) for c in "abcx"], "capture_id string")
    labels = {r["capture_id"]: r for r in label_flows(flows, rows).collect()}
    assert labels["a"]["scenario_family"] == "normal_http_short"
    assert (labels["b"]["scenario_family"], labels["b"]["severity"]) == ("scan_syn", "medium")
    assert (labels["c"]["scenario_family"], labels["c"]["severity"]) == ("my_family", "high")
    assert (labels["x"]["label_binary"], labels["x"]["scenario_family"]) == ("unknown", "unknown")


def test_split_round_trip(spark, tmp_path):
    flows = spark.createDataFrame(
        [(n, n + 1, f"f{n}", ["train", "validation", "test"][n % 3]) for n in range(30)],
        "start_us long, end_us long, flow_id string, split string",
    )
    path = str(tmp_path / "splits")
    tables.write_splits(flows, path)
    test = tables.read_split(spark, path, "test")
    assert test.count() == 10
    plan = test._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    with pytest.raises(KeyError):
        tables.read_split(spark, path, "holdout")


def test_writers(spark, tmp_path):
    frame = spark.createDataFrame([("a", 1)], "name string, n long")
    tables.write_csv(frame, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).first()["n"] == "1"
    tables.write_json_summary({"part": frame}, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json" / "part")).first()["n"] == 1
    tables.append_history(frame, str(tmp_path / "history"))
    tables.append_history(frame, str(tmp_path / "history"))
    assert tables.read_flows(spark, str(tmp_path / "history")).count() == 2
    with pytest.raises(FileNotFoundError):
        tables.union_by_name([])


def contract_with(**changes):
    raw = json.loads(contract.contract_json(contract.DEFAULT_CONTRACT))
    return json.dumps({**raw, **changes})


def test_contract_round_trip():
    read = contract.parse_contract(contract_with())
    assert read == contract.DEFAULT_CONTRACT
    assert len(read.inputs) == 31 and read.categorical == ["protocol"]


@pytest.mark.parametrize(
    "changes",
    [
        {"input_columns_before_encoding": ["src_port", "src_port"]},
        {"input_columns_before_encoding": ["flow_id"]},
        {"input_columns_before_encoding": ["label_binary"]},
        {"runtime_feature_dtypes": {"src_port": "int64"}},
        {"runtime_feature_dtypes": []},
        {"runtime_feature_dtypes": {**FEATURES, "src_port": "object"}},
    ],
)
def test_broken_contracts(changes):
    with pytest.raises(contract.ContractError):
        contract.parse_contract(contract_with(**changes))


def test_missing_key_and_missing_types():
    raw = json.loads(contract_with())
    without = {k: v for k, v in raw.items() if k != "model_type"}
    with pytest.raises(contract.ContractError, match="model_type"):
        contract.parse_contract(json.dumps(without))
    untyped = {k: v for k, v in raw.items() if k != "runtime_feature_dtypes"}
    features = contract.parse_contract(json.dumps(untyped)).features
    assert features["src_port"] == "float64" and features["protocol"] == "string"


def test_projection_checks_columns(spark):
    row = {name: "1" for name in FEATURES} | {"extra": "x", "protocol": "TCP"}
    frame = spark.createDataFrame([tuple(row.values())], [*row])
    projected = contract.project_features(frame)
    assert projected.columns == list(FEATURES)
    assert contract.extra_columns(frame.columns, contract.DEFAULT_CONTRACT) == ["extra"]
    with pytest.raises(contract.ContractError, match="src_port"):
        contract.project_features(frame.drop("src_port"))
    bad = frame.withColumn("src_port", F.lit("http"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        contract.project_features(bad).collect()


def test_misfits_go_to_a_side_table(spark):
    row = {name: "1" for name in FEATURES} | {"protocol": "TCP", "flow_id": "a"}
    rows = [tuple(row.values()), tuple({**row, "src_port": "http", "flow_id": "b"}.values())]
    rows.append(tuple({**row, "dst_port": None, "flow_id": "c"}.values()))
    good, bad = contract.split_misfits(spark.createDataFrame(rows, [*row]))
    assert {r["flow_id"] for r in good.collect()} == {"a", "c"}
    assert dict(good.dtypes)["src_port"] == "bigint"
    assert [r["src_port"] for r in bad.collect()] == ["http"]


def test_drift_and_signature(spark):
    base = spark.createDataFrame([(1, "a")], "x int, y string")
    other = spark.createDataFrame([("a", 1, 2)], "y string, x long, z int")
    found = {
        (r["column_name"], r["finding"]) for r in profile.schema_drift({"b": base, "o": other}, "b").collect()
    }
    assert found == {("x", "dtype"), ("y", "position"), ("z", "extra")}
    two = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    turned = spark.createDataFrame([(2, "b"), (1, "a")], "x int, y string")
    changed = spark.createDataFrame([(2, "b"), (1, "c")], "x int, y string")
    sign = lambda df: profile.table_signature(df).first()
    assert sign(two) == sign(turned) != sign(changed)


def test_csv_of_any_width_and_order(spark, tmp_path):
    wide = [f"c{n}" for n in range(40)]
    (tmp_path / "a.csv").write_text(",".join([*wide, "name", "note"]) + "\n" + ",".join(["x"] * 40) + ',first,"a, ""b"""\n')
    (tmp_path / "b.csv").write_text("note,name\n,second\n\n\"\",third\n")
    rows = tables.read_csv_by_header(spark, f"{tmp_path}/*.csv", ["name", "note", "c39", "absent"])
    got = {r["name"]: (r["note"], r["c39"], r["absent"]) for r in rows.collect()}
    assert got == {"first": ('a, "b"', "x", None), "second": (None, None, None), "third": (None, None, None)}


def test_times_that_are_none_are_rejected(spark):
    rest = ",".join('"1"' for _ in range(14))
    lines = [f'"{t}",{rest}' for t in ("1.5", "nan", "Infinity", "-Infinity", "1e300", "", "x")]
    lines += ['"1.5","1"', f'"1.5",{rest},"one more"']
    parsed = packets.parse_packet_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = [(r["ts_us"], r["reject_reason"]) for r in parsed.collect()]
    assert got[0] == (1_500_000, None) and got[8] == (1_500_000, None)
    assert [reason for _, reason in got[1:7]] == ["bad_time"] * 6
    assert got[7][1] == "short_line"


def test_nulls_count_with_their_text(spark):
    rows = spark.createDataFrame([(None,), ("None",), ("a",), (None,)], "c string")
    got = profile.categorical_profile(rows, ["c"]).first()
    assert (got["non_null_count"], got["null_count"], got["top_values"]) == (2, 2, '{"None":3,"a":1}')


def test_misfits_by_campaign(spark):
    rows = spark.createDataFrame([("x", "1"), ("x", "b"), ("y", None)], "campaign string, port string")
    got = {(r["campaign"], r["row_count"], r["null_count"], r["misfit_count"]) for r in profile.type_misfits(rows, "campaign", {"port": "bigint"}).collect()}
    assert got == {("x", 2, 0, 1), ("y", 1, 1, 0)}


def test_records_of_many_lines_and_cells(spark, tmp_path):
    """Quoted line breaks, doubled quotes, blank lines, and 20 000 quoted cells in a record."""
    many = ",".join(f'"{n}, ""{n}"""' for n in range(20_000))
    names = ",".join(f"c{n}" for n in range(20_000))
    (tmp_path / "a.csv").write_text(f'name,note,{names}\n\n"x ""y""","one\n\ntwo, three\n",{many}\nplain,,{many}\n   \n')
    (tmp_path / "b.csv").write_text('note,name\n"a\n""b""",z\n')
    got = tables.read_csv_by_header(spark, f"{tmp_path}/*.csv", ["name", "note", "c19999"]).orderBy("_position").drop("_position").collect()
    last = '19999, "19999"'
    assert [tuple(r) for r in got] == [('x "y"', "one\n\ntwo, three\n", last), ("plain", None, last), ("z", 'a\n"b"', None)]


def test_records_across_blocks(spark, tmp_path):
    """One file read in many blocks; its records are longer than a block."""
    note = "\n".join(f"line {n}, of a note" for n in range(60))
    (tmp_path / "a.csv").write_text("name,note\n" + "".join(f'{n},"{note}"\n' for n in range(50)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        rows = tables.read_csv_by_header(spark, f"{tmp_path}/a.csv", ["name", "note"]).orderBy("_position").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(r["name"], r["note"]) for r in rows] == [(str(n), note) for n in range(50)]


def test_campaigns_of_other_types(spark, tmp_path):
    spark.createDataFrame([(1, 5, "a")], "id long, n long, only string").write.parquet(f"{tmp_path}/one/flows.parquet")
    spark.createDataFrame([(2, 1.5)], "id int, n double").write.parquet(f"{tmp_path}/two/flows.parquet")
    spark.createDataFrame([(3, "x")], "id long, n string").write.parquet(f"{tmp_path}/three/flows.parquet")
    assert tables.common_type("bigint", "double") == "double" and tables.common_type("bigint", "float") == "double"
    two = tables.read_flows(spark, f"{tmp_path}/t[w]*/flows.parquet")
    assert two.schema["n"].dataType.simpleString() == "double"
    rows = tables.read_flows(spark, f"{tmp_path}/*/flows.parquet").orderBy("id").collect()
    assert [(r["id"], r["n"], r["only"]) for r in rows] == [(1, "5", "a"), (2, "1.5", None), (3, "x", None)]
    with pytest.raises(FileNotFoundError):
        tables.read_flows(spark, f"{tmp_path}/none/*.parquet")


def test_blank_lines_are_short(spark):
    lines = ["", "   ", ",".join([""] * 15), ",".join([""] * 14)]
    assert [r["reject_reason"] for r in parse(spark, *lines)] == ["short_line", "short_line", "bad_time", "short_line"]
