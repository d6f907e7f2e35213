"""Declared output schemas: derived from the feature declarations, checked before a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from moontally.operators.rows import quoted
from moontally.plans.spec import FeatureGroup, FeatureJob

TYPES = {"double": T.DoubleType(), "bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType()}


class ContractError(ValueError):
    """A frame does not have exactly the declared columns."""


def group_contract(group: FeatureGroup, job: FeatureJob) -> T.StructType:
    """Key first, then the features in declared order with their declared types."""
    fields = [T.StructField(group.key, T.StringType())]
    fields += [T.StructField(name, TYPES[kind]) for name, kind in group.extra_columns]
    fields += [T.StructField(name, TYPES[feature.type]) for _, feature, name in group.columns(job)]
    return T.StructType(fields)


def missing_and_extra(df: DataFrame, contract: T.StructType, optional: set[str] = frozenset()) -> tuple[list, list]:
    declared, present = set(contract.names), set(df.columns)
    return sorted(declared - present - set(optional)), sorted(present - declared)


def conform(df: DataFrame, contract: T.StructType, fill_missing: bool = True) -> DataFrame:
    """Columns in declared order and type; unknown columns are an error.

    A declared column nothing produces becomes NULL if ``fill_missing``, else an error.
    """
    missing, extra = missing_and_extra(df, contract)
    if extra or (missing and not fill_missing):
        raise ContractError(f"missing columns {missing}, undeclared columns {extra}")
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = []
    for f in contract.fields:
        value = "NULL" if f.name in missing else quoted(f.name)
        if types.get(f.name) != f.dataType:
            value = f"CAST({value} AS {f.dataType.simpleString()})"
        columns.append(f"{value} AS {quoted(f.name)}")
    return df.selectExpr(*columns)
