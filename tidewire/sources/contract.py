"""The feature contract: which columns a model reads, in which order and type."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.schemas import EXCLUDED_COLUMNS, FEATURES, POSITIVE_LABEL, TARGET

_REQUIRED = [
    "model_type",
    "target_column",
    "positive_label",
    "selected_candidate",
    "excluded_columns",
    "input_columns_before_encoding",
]
_SPARK_TYPES = {"int64": T.LongType(), "float64": T.DoubleType(), "string": T.StringType()}


class ContractError(ValueError):
    """A contract or a table that does not fit it."""


@dataclass(frozen=True)
class FeatureContract:
    features: dict[str, str]
    target: str = TARGET
    positive_label: str = POSITIVE_LABEL
    excluded: tuple[str, ...] = ()
    model_type: str = "RandomForestClassifier"
    # Hyper-parameters of the selected model.
    parameters: dict = field(
        default_factory=lambda: {
            "n_estimators": 300,
            "max_depth": 20,
            "min_samples_leaf": 1,
            "max_features": "sqrt",
        }
    )

    @property
    def inputs(self) -> list[str]:
        return list(self.features)

    @property
    def categorical(self) -> list[str]:
        return [c for c, t in self.features.items() if t == "string"]

    @property
    def numeric(self) -> list[str]:
        return [c for c, t in self.features.items() if t != "string"]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c, _SPARK_TYPES[t]) for c, t in self.features.items()])


DEFAULT_CONTRACT = FeatureContract(dict(FEATURES), excluded=tuple(EXCLUDED_COLUMNS))


def _feature_type(name: str, declared: str | None) -> str:
    if name == "protocol":
        return "string"
    text = (declared or "float64").strip().lower()
    if text.startswith("int"):
        return "int64"
    if text in ("str", "string", "object"):
        raise ContractError(f"numeric feature {name} is declared as {declared}")
    return "float64"


def parse_contract(text: str) -> FeatureContract:
    """Read a contract from JSON and check that it is consistent."""
    raw = json.loads(text)
    absent = sorted(key for key in _REQUIRED if key not in raw)
    if absent:
        raise ContractError("missing keys: " + ", ".join(absent))
    inputs = list(raw["input_columns_before_encoding"])
    if len(inputs) != len(set(inputs)):
        raise ContractError("duplicate input columns")
    excluded = tuple(raw["excluded_columns"])
    shared = sorted(set(inputs) & set(excluded))
    if shared:
        raise ContractError("inputs are excluded columns: " + ", ".join(shared))
    if raw["target_column"] in inputs:
        raise ContractError("the target is an input")
    declared = raw.get("runtime_feature_dtypes")
    if declared is not None:
        if not isinstance(declared, dict):
            raise ContractError("runtime_feature_dtypes must be an object")
        wrong = sorted(set(inputs) ^ set(declared))
        if wrong:
            raise ContractError("types do not cover the inputs: " + ", ".join(wrong))
    features = {c: _feature_type(c, declared[c] if declared else None) for c in inputs}
    return FeatureContract(
        features,
        target=str(raw["target_column"]),
        positive_label=str(raw["positive_label"]),
        excluded=excluded,
        model_type=str(raw["model_type"]),
        parameters=dict(raw["selected_candidate"]),
    )


def contract_json(contract: FeatureContract) -> str:
    return json.dumps(
        {
            "model_type": contract.model_type,
            "target_column": contract.target,
            "positive_label": contract.positive_label,
            "selected_candidate": contract.parameters,
            "excluded_columns": list(contract.excluded),
            "input_columns_before_encoding": contract.inputs,
            "runtime_feature_dtypes": dict(contract.features),
        },
        indent=2,
    )


def extra_columns(columns: Iterable[str], contract: FeatureContract) -> list[str]:
    return sorted(set(columns) - set(contract.inputs))


def _check_present(df: DataFrame, wanted: list[str]) -> None:
    absent = [c for c in wanted if c not in df.columns]
    if absent:
        raise ContractError("Missing required features: " + ", ".join(absent))


def _coerced(df: DataFrame, contract: FeatureContract) -> list[Column]:
    """Contract types; nulls stay null and a value that does not fit fails the job."""
    return [F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.struct()]


def project_features(
    df: DataFrame, contract: FeatureContract = DEFAULT_CONTRACT, keep: Iterable[str] = ()
) -> DataFrame:
    """The contract's inputs in order, after the ``keep`` columns."""
    _check_present(df, contract.inputs)
    return df.select(*keep, *_coerced(df, contract))


def split_misfits(
    df: DataFrame, contract: FeatureContract = DEFAULT_CONTRACT
) -> tuple[DataFrame, DataFrame]:
    """Rows with the contract's types, and the rows with a value that does not fit.

    For streams, where one bad value must not stop the query: both parts keep all
    columns, and the second goes to a table of rejects.
    """
    _check_present(df, contract.inputs)
    typed = {f.name: F.col(f.name).try_cast(f.dataType) for f in contract.struct()}
    misfits = [F.col(name).isNotNull() & value.isNull() for name, value in typed.items()]
    bad = reduce(lambda a, b: a | b, misfits)
    return df.where(~bad).withColumns(typed), df.where(bad)


def training_frame(df: DataFrame, contract: FeatureContract = DEFAULT_CONTRACT) -> DataFrame:
    """Inputs, target and whatever capture context the table has."""
    _check_present(df, [*contract.inputs, contract.target])
    context = [c for c in ("capture_id", "scenario_id", "scenario_family") if c in df.columns]
    return df.select(
        *_coerced(df, contract), F.col(contract.target).cast("string"), *context
    )


def contract_violations(
    df: DataFrame, contract: FeatureContract = DEFAULT_CONTRACT
) -> DataFrame:
    """Per contract column: is it there, how many nulls, how many values that do not fit.

    One pass over the table, whatever the number of columns.
    """

    def check(name: str, dtype: T.DataType) -> Column:
        if name not in df.columns:
            present, nulls, misfits = F.lit(False), F.lit(0), F.lit(0)
        else:
            value = F.col(name)
            present = F.lit(True)
            nulls = F.count_if(value.isNull())
            misfits = F.count_if(value.isNotNull() & value.try_cast(dtype).isNull())
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(contract.features[name]).alias("expected_type"),
            present.alias("present"),
            nulls.cast("long").alias("null_count"),
            misfits.cast("long").alias("misfit_count"),
        )

    checks = [check(f.name, f.dataType) for f in contract.struct()]
    # The count keeps this an aggregation even when every column is absent.
    one = df.agg(F.count(F.lit(1)).alias("_rows"), F.array(*checks).alias("_checks"))
    return one.select(F.inline("_checks"))
