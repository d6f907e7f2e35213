"""Row operators: projection, filters, de-duplication, casts and fills."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_cols(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(quoted(name)) for name in names])


def notnull_key_filter(df: DataFrame, *keys: str) -> DataFrame:
    """Rows that have all keys; written as IS NOT NULL, which the parquet scan takes over."""
    return value_filters(df, *[F.col(quoted(key)).isNotNull() for key in keys])


def value_filters(df: DataFrame, *conditions: Column) -> DataFrame:
    for condition in conditions:
        df = df.where(condition)
    return df


def distinct_rows(df: DataFrame) -> DataFrame:
    """Equal rows become one.  Copies collapse map-side; the shuffle is by whole row."""
    return df.distinct()


def distinct_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def cast_cols(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Casts where an unreadable value becomes NULL."""
    return df.withColumns({name: F.col(quoted(name)).try_cast(to) for name, to in types.items()})


def na_fill(df: DataFrame, value: float = 0, subset: Sequence[str] | None = None) -> DataFrame:
    """Numeric NULLs to one value, all numeric columns or a subset."""
    return df.na.fill(value, subset=list(subset) if subset else None)


def const_overwrite(df: DataFrame, column: str, source: DataFrame | None = None) -> DataFrame:
    """Replace a column by its global maximum: a scalar subquery, no collect, no join."""
    top = (df if source is None else source).agg(F.max(column))
    return df.withColumn(column, top.scalar())


def fill_const(df: DataFrame, defaults: Mapping[str, float]) -> DataFrame:
    """Constant defaults for the columns that are present, in their own type."""
    present = set(df.columns)
    known = {name: value for name, value in defaults.items() if name in present}
    return df.na.fill(known) if known else df


def fill_when_null(df: DataFrame, defaults: Mapping[str, float]) -> DataFrame:
    """As :func:`fill_const`, but a default may widen the column's type."""
    return df.withColumns({
        name: F.when(F.col(quoted(name)).isNull(), F.lit(value)).otherwise(F.col(quoted(name)))
        for name, value in defaults.items()
        if name in df.columns
    })


def fill_query(df: DataFrame, defaults: Mapping[str, Column], source: DataFrame | None = None) -> DataFrame:
    """Defaults that are aggregates of a whole frame, as scalar subqueries."""
    source = df if source is None else source
    types = dict(df.dtypes)
    return df.withColumns({
        name: F.coalesce(F.col(quoted(name)), source.agg(aggregate).scalar().cast(types[name]))
        for name, aggregate in defaults.items()
        if name in types
    })


def quoted(name: str) -> str:
    """Column names with blanks, brackets or dots, safe for ``F.col``."""
    return f"`{name}`"
