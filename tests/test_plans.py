"""What the plans must and must not contain."""

from __future__ import annotations

import pytest

from tidewire import Settings
from tidewire import fixtures as fx
from tidewire.operators import flows, sampling
from tidewire.queries import QUERIES


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


_CHEAP = [
    "flow_table",
    "flow_features",
    "label_flows",
    "split_flows",
    "balance_labels",
    "block_decision",
    "event_records",
    "journal",
    "classification_report",
    "categorical_top5",
    "runtime_status",
    "view_summary",
]


@pytest.mark.parametrize("name", _CHEAP)
def test_no_python_and_no_cross_join(spark, folder, name):
    plan = plan_of(QUERIES[name](spark, folder))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "Cartesian", "NestedLoop"):
        assert bad not in plan


def test_cap_drops_rows_before_the_shuffle(spark, folder):
    plan = plan_of(sampling.cap_captures(fx.labeled_flows(spark, folder), fx.CAPS))
    assert "WindowGroupLimit" in plan


def test_flow_table_shuffles_packets_once(spark, folder):
    table = flows.flow_table(fx.packets(spark, folder), Settings())
    table.collect()
    final = plan_of(table).split("== Initial Plan ==")[0]
    # Folded and plain segments read one exchange, and the aggregation needs no other.
    assert final.count("ShuffleQueryStage") - final.count("ReusedExchange") == 1


def test_scan_reads_only_needed_columns(spark, folder):
    plan = plan_of(QUERIES["protocol_name"](spark, folder))
    assert "ReadSchema: struct<l_quantity:double>" in plan
