"""Package activations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moontally.functions.calendar import epoch_seconds, parse_ts
from moontally.functions.scalars import data_mb, ratio, strip_spaces
from moontally.operators.grain import value_months
from moontally.operators.rows import distinct_rows
from moontally.operators.windows import MONTH
from moontally.plans.spec import Feature, FeatureGroup, FeatureJob
from moontally.sources.snapshots import read_table

KEY = "bib_id"


def rows(source, job: FeatureJob, max_range: int) -> DataFrame:
    return distinct_rows(read_table(source, "package", *job.months(max_range)))


def parsed(packages: DataFrame) -> DataFrame:
    """Normalised names, data volume and period in seconds."""
    period = epoch_seconds(parse_ts(F.col("deactivation_date"))) - epoch_seconds(parse_ts(F.col("activation_date")))
    return packages.withColumns({
        "code": strip_spaces(F.col("offering_code")),
        "name": strip_spaces(F.col("offering_name")),
        "data_usage": data_mb(F.col("offering_name")),
        "period": period,
    })


def grain(packages: DataFrame, job: FeatureJob, max_range: int) -> DataFrame:
    """Rows per key and month with the measures, and per key, month and code or name for the distinct counts."""
    offers, months = parsed(packages), job.months(max_range)
    measures = offers.groupBy(KEY, MONTH).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("offer_amount") == 0, 1)).alias("n_free"),
        F.sum("data_usage").alias("data_usage"),
        F.sum("offer_amount").alias("offer_amount"),
        F.count("period").alias("n_period"),
        F.sum("period").alias("period_sum"),
        F.min("period").alias("period_min"),
        F.max("period").alias("period_max"),
    )
    counted = [value_months(offers, KEY, column, months, {}) for column in ("code", "name")]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counted, measures)


GROUP = FeatureGroup(
    name="Package",
    table="package",
    key=KEY,
    rows=rows,
    grain=grain,
    features=(
        Feature("mean_package_period", "double", lambda w: ratio(w.sum("period_sum"), w.sum("n_period")), default=-1),
        Feature("ratio_offeramount_zero", "double", lambda w: ratio(w.sum("n_free"), w.sum("n"))),
        Feature("max_package_period", "bigint", lambda w: w.max("period_max"), default=-1),
        Feature("sum_offer_amount", "double", lambda w: w.sum("offer_amount")),
        Feature("count_packages", "bigint", lambda w: w.sum("n")),
        Feature("min_package_period", "bigint", lambda w: w.min("period_min"), default=-1),
        Feature("sum_data_MB", "double", lambda w: w.sum("data_usage")),
        Feature("count_distinct_offername", "bigint", lambda w: w.distinct_seen("name")),
        Feature("count_distinct_offercode", "bigint", lambda w: w.distinct_seen("code")),
    ),
)
