"""Reading monthly snapshots.

A snapshot source lays out ``<base>/<month_index>/<table>``; opening only the months a
job needs is its partition pruning.  Rows carry their own ``date_key``, from which the
month is derived again: a text range on ``date_key`` goes down to the parquet scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moontally.functions.calendar import month_index, month_span, month_start, parse_date_key
from moontally.operators.rows import distinct_keys, notnull_key_filter, project_cols, quoted
from moontally.operators.windows import MONTH
from moontally.sources.catalog import SOURCE_COLUMNS, key_column, source_schema


class SnapshotSource:
    """Parquet snapshots below one base path; ``paths`` maps table to relative path."""

    def __init__(self, spark: SparkSession, base: str, paths: Mapping[str, str] | None = None):
        self.spark, self.base, self.paths = spark, base.rstrip("/"), dict(paths or {})

    def path(self, table: str, month: int) -> str:
        return f"{self.base}/{month}/{self.paths.get(table, table)}"

    def scan_months(self, table: str, first: int, last: int) -> DataFrame:
        """The snapshots of months first..last of one table as one frame, at the table's declared schema.

        Every month is read with its own schema, so months written before a column was added or widened
        stand next to later ones.  Undeclared columns come through where all months have them alike.
        """
        months = [self.scan_month(table, m) for m in range(first, last + 1)]
        alike = reduce(lambda kept, df: [c for c in kept if c in df.dtypes], months[1:], months[0].dtypes)
        columns = [F.col(quoted(name)) for name, _ in alike]
        return reduce(lambda a, b: a.unionByName(b), [df.select(*columns) for df in months])

    def scan_month(self, table: str, month: int) -> DataFrame:
        path = self.path(table, month)
        return at_source_schema(self.spark.read.parquet(path), table, path)

    def scan_all(self, table: str) -> DataFrame:
        """All snapshots of one table as one frame."""
        path = f"{self.base}/*/{self.paths.get(table, table)}"
        return at_source_schema(self.spark.read.parquet(path), table, path)


class SchemaDriftError(ValueError):
    """A snapshot does not fit the declared schema of its table."""


# Changes of type that lose nothing.
_WIDER = {
    T.LongType: (T.ByteType, T.ShortType, T.IntegerType),
    T.IntegerType: (T.ByteType, T.ShortType),
    T.DoubleType: (T.FloatType, T.ByteType, T.ShortType, T.IntegerType),
    T.StringType: (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
}


def at_source_schema(df: DataFrame, table: str, where: str) -> DataFrame:
    """Declared columns brought to their declared types, others as they are.

    A missing column is NULL, unless it is the key or the date: without these no row has a meaning.
    A type that does not widen to the declared one is an error that names the snapshot; so are two
    columns that differ in case only.  Tables the catalog does not know come as they are.
    """
    if table not in SOURCE_COLUMNS:
        return df
    present = {f.name: f.dataType for f in df.schema.fields}
    if len({name.lower() for name in present}) < len(df.columns):
        raise SchemaDriftError(f"{where}: ambiguous columns {df.columns}")
    found = {name.lower(): name for name in present}
    columns, problems = [], []
    for field in source_schema(table).fields:
        name = found.pop(field.name.lower(), None)
        kind = present.get(name)
        if name is None and field.name in (key_column(table), "date_key"):
            problems.append(f"{field.name} is missing")
        elif name is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif kind == field.dataType:
            columns.append(F.col(quoted(name)).alias(field.name))
        elif isinstance(kind, _WIDER.get(type(field.dataType), ())):
            columns.append(F.col(quoted(name)).cast(field.dataType).alias(field.name))
        else:
            problems.append(f"{field.name} is {kind.simpleString()}, declared {field.dataType.simpleString()}")
    if problems:
        raise SchemaDriftError(f"{where}: {', '.join(problems)}")
    return df.select(*columns, *[F.col(quoted(name)) for name in found.values()])


def with_month(df: DataFrame, first: int, last: int, date_key: str = "date_key") -> DataFrame:
    """Adds ``date`` and ``month_index`` to rows whose date text is in months first..last."""
    df = df.withColumn("date", parse_date_key(F.col(date_key)))
    starts = [f"{month_start(m):%Y%m%d}" for m in range(first + 1, last + 1)]
    later = [F.when(F.col(date_key) >= start, 1).otherwise(0) for start in starts]
    return df.withColumn(MONTH, reduce(add, later, F.lit(first)))


def within_months(df: DataFrame, first: int, last: int, date_key: str = "date_key") -> DataFrame:
    """Rows dated in months first..last, as a text range the parquet reader can skip by."""
    start, end = month_span(first, last)
    return df.where((F.col(date_key) >= f"{start:%Y%m%d}") & (F.col(date_key) < f"{end:%Y%m%d}"))


def read_table(source, table: str, first: int, last: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Common reader: the months and columns asked for; rows with a key and a readable date."""
    wanted = list(columns or SOURCE_COLUMNS[table])
    df = within_months(project_cols(source.scan_months(table, first, last), wanted), first, last)
    dated = with_month(notnull_key_filter(df, key_column(table)), first, last)
    return dated.where(F.col("date").isNotNull())


def read_all(source, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The same over every snapshot there is."""
    keyed = notnull_key_filter(project_cols(source.scan_all(table), list(columns or SOURCE_COLUMNS[table])), key_column(table))
    dated = keyed.withColumn("date", parse_date_key(F.col("date_key")))
    return dated.withColumn(MONTH, month_index(F.col("date"))).where(F.col("date").isNotNull())


def read_undated(source, table: str, first: int, last: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows with a key of the snapshots first..last, whatever their own date."""
    df = project_cols(source.scan_months(table, first, last), list(columns or SOURCE_COLUMNS[table]))
    return notnull_key_filter(df, key_column(table))


def scan_droplist(spark: SparkSession, path: str) -> DataFrame:
    """Keys of a written drop list, once each."""
    return drop_keys(spark.read.parquet(path))


def drop_keys(drop_list: DataFrame) -> DataFrame:
    return distinct_keys(drop_list, "key")
