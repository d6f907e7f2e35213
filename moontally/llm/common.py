"""Helpers shared by the operators: input tables, the shared folder, sizes, distributed ranks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes up to which a measured side of a join is broadcast.
BROADCAST_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a local master without one gets a temporary one."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="moontally-"))
        folder = context.getCheckpointDir()
    return folder


def small_batches(spark: SparkSession, most: str = "8m") -> None:
    """Texts go to Python in batches of about ``most``, unless the session has a size of its own.

    A session setting: batches of 64 MB, the default, fill a small executor's memory several times over.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":  # the default
        spark.conf.set(name, most)


def stash(frame: DataFrame) -> DataFrame:
    """The rows as a table written to the shared folder: lineage ends here and is not run again."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def broadcast_if_small(frame: DataFrame, row_bytes: int, most: int = BROADCAST_BYTES) -> DataFrame:
    """A stashed frame with a broadcast hint if its counted rows fit ``most`` bytes, else as it is."""
    return F.broadcast(frame) if frame.count() * row_bytes <= most else frame


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of the md5 of the parts; SQL engines agree on it."""
    text = F.concat_ws(":", *(F.coalesce(p.cast("string"), F.lit("null")) for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(2**52))


def running(
    frame: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[Column], name: str, weight: Column | None = None
) -> DataFrame:
    """Adds ``name``: the sum of ``weight`` (default: the number) of the rows before a row within ``keys``.

    Rows are ordered by ``bucket`` (a long that splits every key into parts that fit a task), then by
    ``order``. Only sums per (keys, bucket) are brought together, so no task needs the rows of a key.
    ``frame`` is read twice and must give the same rows each time.
    """
    weight = F.lit(1).cast("long") if weight is None else weight
    parts = frame.groupBy(*keys, bucket).agg(F.sum(weight).alias("_in"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*keys, bucket, F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = frame.withColumn("_own", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    joined = ranked.join(parts, [*keys, bucket])
    return joined.withColumn(name, F.col("_base") + F.col("_own")).drop("_base", "_own")
