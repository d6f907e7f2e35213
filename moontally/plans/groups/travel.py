"""Domestic travel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moontally.functions.scalars import flag, travel_bucket
from moontally.operators.rows import distinct_rows
from moontally.plans.spec import Feature, FeatureGroup, FeatureJob
from moontally.sources.snapshots import read_table

KEY = "fake_msisdn"


def rows(source, job: FeatureJob, max_range: int) -> DataFrame:
    return distinct_rows(read_table(source, "domestic_travel", *job.months(max_range)).drop("date_key"))


def in_bucket(bucket: str):
    """The bucket comes from the total over all months read, for every range."""
    return lambda w: flag(travel_bucket(F.sum("sum_travel")) == bucket)


GROUP = FeatureGroup(
    name="DomesticTravel",
    table="domestic_travel",
    key=KEY,
    rows=rows,
    per_target=True,
    sees_all=True,
    features=(
        Feature("avg_daily_travel", "double", lambda w: w.mean("sum_travel")),
        Feature("unique_travel_days", "bigint", lambda w: w.distinct_days("date")),
        Feature("travel_1_5", "int", in_bucket("1-5")),
        Feature("max_travel_in_day", "bigint", lambda w: w.max("sum_travel")),
        Feature("travel_11_plus", "int", in_bucket("11+")),
        Feature("travel_6_10", "int", in_bucket("6-10")),
        Feature("total_travel", "bigint", lambda w: w.sum("sum_travel")),
    ),
)
