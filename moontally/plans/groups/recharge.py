"""Recharges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moontally.functions.calendar import parse_ts
from moontally.functions.scalars import is_afternoon, is_weekend, ratio
from moontally.operators.rows import distinct_rows
from moontally.plans.spec import Feature, FeatureGroup, FeatureJob
from moontally.sources.snapshots import read_table

KEY = "bib_id"
AMOUNT = "recharge_value_amt"


def rows(source, job: FeatureJob, max_range: int) -> DataFrame:
    recharges = read_table(source, "recharge", *job.months(max_range)).drop("date_key")
    recharges = distinct_rows(recharges.withColumn("recharge_dt", parse_ts(F.col("recharge_dt"))))
    return recharges.withColumns({
        "afternoon": is_afternoon(F.col("recharge_dt"), F.col(AMOUNT)),
        "weekend": is_weekend(F.col("date")),
    })


def weekend_share(w):
    spent = F.coalesce(w.sum(AMOUNT, F.col("weekend")), F.lit(0.0))
    return ratio(spent, w.sum(AMOUNT))


GROUP = FeatureGroup(
    name="Recharge",
    table="recharge",
    key=KEY,
    rows=rows,
    features=(
        Feature("count_recharge", "bigint", lambda w: w.rows()),
        Feature("ratio_afternoon_recharge", "double", lambda w: ratio(w.rows(F.col("afternoon")), w.rows())),
        Feature("max_recharge", "double", lambda w: w.max(AMOUNT)),
        Feature("min_recharge", "double", lambda w: w.min(AMOUNT)),
        Feature("mean_recharge", "double", lambda w: w.mean(AMOUNT)),
        Feature("sum_recharge", "double", lambda w: w.sum(AMOUNT)),
        Feature("balance_max", "double", lambda w: w.max("account_balance_after_amt")),
        Feature("mean_balance_before_recharge", "double", lambda w: w.mean("account_balance_before_amt")),
        Feature("ratio_weekend_recharge", "double", weekend_share),
    ),
)
