"""Column naming: ``<feature>_<range>`` and ``<index>_<name>``."""

from __future__ import annotations

from pyspark.sql import DataFrame


def range_name(feature: str, months: int) -> str:
    return f"{feature}_{months}"


def split_range_name(column: str) -> tuple[str, int]:
    feature, _, months = column.rpartition("_")
    return feature, int(months)


def index_name(index: int, name: str) -> str:
    return f"{index}_{name}"


def split_index_name(column: str) -> tuple[int, str] | None:
    head, sep, name = column.partition("_")
    return (int(head), name) if sep and head.isdigit() else None


def strip_index(df: DataFrame) -> DataFrame:
    """Drop the index prefix a pivot leaves; only unambiguous with a single target."""
    parts = {c: split_index_name(c) for c in df.columns}
    return df.withColumnsRenamed({c: part[1] for c, part in parts.items() if part})
