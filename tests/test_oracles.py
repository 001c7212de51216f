"""Every query with an SQL counterpart, on the smallest tables."""

from __future__ import annotations

import pytest
from oracle_check import difference, duck, duck_rows, spark_rows

from tidewire.oracles import ORACLES
from tidewire.queries import QUERIES

# Streams and models have tests of their own; at full length they only cost time here.
_SLOW = {"stream_detection", "stream_flows", "stream_packets", "stream_replay"}


@pytest.fixture(scope="module")
def connection(folder):
    return duck(folder)


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
    assert set(QUERIES) - set(ORACLES) == {
        "train_rf",
        "score_flows",
        "model_eval",
    }


@pytest.mark.parametrize("name", sorted(set(ORACLES) - _SLOW))
def test_query_matches_sql(spark, folder, connection, name):
    got = spark_rows(QUERIES[name](spark, folder))
    assert difference(got, duck_rows(connection, ORACLES[name])) is None
