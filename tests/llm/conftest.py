from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def larger():
    return "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows, and
    columns named like those that operators add."""
    rows = [
        (1, None, "en", None),
        (2, "", None, 1),
        (3, " \t\n ", "en", 1),
        (4, "one two three four five six", "en", 2),
        (5, "One  two three four five six\n", "en", 2),
        (6, "onetwo threefourfive six", "en", 3),
        (7, "one two three four five six", "en", 2),
        (7, "one two three four five six", "en", 2),
        (None, "the text without an id", None, None),
        (8, "12 !! ?? 34", "de", 4),
        (9, "ein Wort und noch ein Wort und so weiter " * 3000, "de", 5),
        (10, "x" * 50_000, None, 6),
        (11, "a b", "fr", 7),
        (12, "A B", "fr", 7),
    ]
    schema = "doc_id long, text string, lang string, n long"
    frame = spark.createDataFrame(rows, schema)
    return frame.selectExpr(
        "*",
        "'s' as source",
        "'old' as language_id",
        "1 as leaks",
        "2 as secrets",
        "3 as personal_data",
        "4 as licenses",
        "5 as digest",
        "6 as chars",
        "7 as quality_score",
        "8 as toxicity",
        "9 as gone_0",
    )


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")
