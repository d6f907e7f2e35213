"""Handsets used and for how long."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moontally.functions.scalars import HANDSET_BRANDS, ratio
from moontally.operators.grain import value_months
from moontally.operators.rows import distinct_rows, notnull_key_filter
from moontally.operators.windows import MONTH
from moontally.plans.spec import Feature, FeatureGroup, FeatureJob
from moontally.sources.snapshots import read_table

KEY = "fake_msisdn"
MONTH_DAYS = {1: 31, 2: 62}


def rows(source, job: FeatureJob, max_range: int) -> DataFrame:
    handsets = read_table(source, "handset_price", *job.months(max_range)).drop("date_key")
    return distinct_rows(notnull_key_filter(handsets, "handset_brand", "cnt_of_days"))


def grain(handsets: DataFrame, job: FeatureJob, max_range: int) -> DataFrame:
    """Rows per key, month and model, with ``model_days``, and rows per key, month and brand, with ``days``.

    No feature needs a model together with its brand. So a value of a key has one row a month, and neither a key with
    many models nor a brand with many models meets in one task.
    """
    n, days, months = F.lit(1), F.col("cnt_of_days"), job.months(max_range)
    models = value_months(handsets, KEY, "handset_model", months, {"n": n, "model_days": days})
    brands = value_months(handsets, KEY, "handset_brand", months, {"n": n, "days": days})
    return models.unionByName(brands, allowMissingColumns=True)


def _brand_rows(position: int) -> Feature:
    brand = HANDSET_BRANDS[position]
    return Feature(
        f"handset_v[{position}]",
        "bigint",
        lambda w: F.coalesce(w.sum("n", F.col("handset_brand") == brand), F.lit(0)),
    )


def _brand_days(brand: str) -> Feature:
    """Named a ratio, but a sum of days."""
    return Feature(
        f"{brand.lower()}_usage_ratio", "bigint", lambda w: w.sum("days", F.col("handset_brand") == brand)
    )


def stability(w):
    return ratio(w.max("model_days"), w.sum(F.col("n").cast("double") * F.col("model_days")))


GROUP = FeatureGroup(
    name="HandsetPrice",
    table="handset_price",
    key=KEY,
    rows=rows,
    grain=grain,
    features=(
        _brand_days("XIAOMI"),
        _brand_rows(4),
        Feature("max_days_single_handset", "bigint", lambda w: w.max("model_days"), default=MONTH_DAYS),
        Feature("handset_stability", "double", stability, default=1),
        _brand_rows(0),
        _brand_rows(1),
        _brand_rows(2),
        Feature(
            "avg_days_per_handset",
            "double",
            lambda w: ratio(w.sum("days"), w.distinct_seen("handset_model")),
            default=MONTH_DAYS,
        ),
        _brand_days("APPLE"),
        Feature("total_unique_handsets", "int", lambda w: w.distinct_seen("handset_model"), default=1),
        _brand_days("SAMSUNG"),
        Feature("total_unique_brands", "int", lambda w: w.distinct_seen("handset_brand"), default=1),
        _brand_rows(3),
        Feature("total_usage_days", "bigint", lambda w: w.sum("days"), default=MONTH_DAYS),
        Feature(
            "brand_diversity_ratio",
            "double",
            lambda w: ratio(w.distinct_seen("handset_model"), w.distinct_seen("handset_brand")),
            default=1,
        ),
        _brand_days("HUAWEI"),
    ),
)
