"""Writers: feature tables as parquet (or any other batch format), with a schema contract."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moontally.operators.windows import MONTH
from moontally.plans.contracts import conform


#: Formats that are written as folders of files, by month.
FILE_FORMATS = ("parquet", "orc", "json", "csv", "avro")


def sink_writer_cap(df: DataFrame, cap: int) -> DataFrame:
    """At most ``cap`` concurrent writers; 0 leaves the frame alone.

    A rebalancing shuffle stands before the write, so the stage that makes the rows stays
    wide and its output is dealt by size; ``coalesce`` then only ever lowers the number.
    """
    return df.hint("rebalance").coalesce(cap) if cap > 0 else df


def sink_parquet_features(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def sink_table_append(
    df: DataFrame,
    path: str | None,
    contract: T.StructType,
    month: int,
    mode: str = "append",
    cap: int = 0,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> None:
    """Append one month of a feature table, in its declared schema.

    Tables of file formats are partitioned by month.  ``mode='overwrite'`` replaces that
    month only, which makes a re-run idempotent.  Other formats (``fmt='jdbc'`` with its
    options) take the rows as they are.
    """
    out = sink_writer_cap(conform(df, contract, fill_missing=False), cap)
    if fmt not in FILE_FORMATS:
        out.write.format(fmt).options(**dict(options or {})).mode(mode).save()
        return
    writer = out.withColumn(MONTH, F.lit(month)).write.mode(mode).partitionBy(MONTH)
    writer.options(**dict(options or {}), partitionOverwriteMode="dynamic").format(fmt).save(path)


def read_feature_table(
    spark: SparkSession,
    path: str,
    contract: T.StructType,
    month: int,
    fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One month of a feature table; the month filter prunes partitions of files."""
    reader = spark.read.format(fmt).options(**dict(options or {}))
    if fmt not in FILE_FORMATS:
        return reader.load()
    schema = T.StructType([*contract.fields, T.StructField(MONTH, T.IntegerType())])
    return reader.schema(schema).load(path).where(F.col(MONTH) == month).drop(MONTH)


def fresh_folder(base: str | None) -> str:
    """A new folder below ``base``, which all executors share."""
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{base.rstrip('/')}/moontally-{uuid.uuid4().hex}"
