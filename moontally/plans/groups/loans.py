"""Airtime loans: assignments and how fast they are repaid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moontally.functions.calendar import epoch_seconds, parse_ts
from moontally.functions.scalars import ratio
from moontally.operators.grain import DAY_SECONDS, agg_recovery_rollup, interval_grain
from moontally.operators.joins import right_join_recovery
from moontally.operators.rows import cast_cols, distinct_rows
from moontally.operators.windows import MONTH, MonthWindow, with_window_flags
from moontally.plans.pipeline import present_name
from moontally.plans.spec import Feature, FeatureGroup, FeatureJob
from moontally.sources.snapshots import read_table, read_undated

KEY = "bib_id"
LOAN_TYPES = {"loan_id": "bigint", "loan_amount": "int"}
NO_INTERVAL = {1: 2592000, 2: 5184000}
UNPAID_DAYS = 30


def typed(loans: DataFrame, moment: str) -> DataFrame:
    return cast_cols(loans.withColumn(moment, parse_ts(F.col("date_timestamp"))), LOAN_TYPES)


def rows(source, job: FeatureJob, max_range: int) -> DataFrame:
    loans = read_table(source, "loan_assign", *job.months(max_range)).drop("date_key")
    return distinct_rows(typed(loans, "dt_sec"))


def keyed(loans: DataFrame, windows: list[MonthWindow], span: tuple[int, int]) -> DataFrame:
    """Amounts and intervals come from two groupings of the same rows, joined on the key
    both are already partitioned by.  Loans are counted by grouping on them first."""
    lent, flagged = with_window_flags(loans, windows, span)
    days, _ = with_window_flags(interval_grain(loans, KEY, "dt_sec"), windows, span)
    per_loan, amounts, intervals = [], [], []
    for window in windows:
        w, tag = flagged[window], _tag(window)
        per_loan += [
            w.rows().alias(f"rows{tag}"),
            w.sum("loan_amount").alias(f"sum{tag}"),
            w.max("loan_amount").alias(f"max{tag}"),
            w.min("loan_amount").alias(f"min{tag}"),
        ]
        seen = F.col(f"rows{tag}") > 0
        amounts += [
            F.max(seen).alias(present_name(w)),
            F.count(F.when(seen, F.col("loan_id"))).alias(f"loans{tag}"),
            F.sum(f"sum{tag}").alias(f"sum{tag}"),
            F.max(f"max{tag}").alias(f"max{tag}"),
            F.min(f"min{tag}").alias(f"min{tag}"),
        ]
        intervals += [
            ratio(w.sum("gap_sum"), w.sum("n") - w.sum("starts")).alias(f"gap_mean{tag}"),
            w.min("gap_min").alias(f"gap_min{tag}"),
            w.max("gap_max").alias(f"gap_max{tag}"),
        ]
    by_amount = lent.groupBy(KEY, "loan_id").agg(*per_loan).groupBy(KEY).agg(*amounts)
    return by_amount.join(days.groupBy(KEY).agg(*intervals), KEY, "left")


def _tag(w) -> str:
    return f"_{w.target}_{w.months}"


def _column(prefix: str):
    return lambda w: F.col(f"{prefix}{_tag(w)}")


GROUP = FeatureGroup(
    name="LoanAssign",
    table="loan_assign",
    key=KEY,
    rows=rows,
    keyed=keyed,
    per_target=True,
    features=(
        Feature("loan_amount_max", "int", _column("max")),
        Feature("count_loans", "bigint", _column("loans")),
        Feature("loan_amount_min", "int", _column("min")),
        Feature("max_time_interval_loan", "bigint", _column("gap_max"), default=NO_INTERVAL),
        Feature("loan_amount_sum", "bigint", _column("sum")),
        Feature("min_time_interval_loan", "bigint", _column("gap_min"), default=NO_INTERVAL),
        Feature("mean_time_interval_loan", "double", _column("gap_mean"), default=NO_INTERVAL),
    ),
)


def recoveries(source, job: FeatureJob, max_range: int) -> DataFrame:
    """Per loan and target: all recoveries of the snapshots that the target's window reads, also those dated outside
    its months: only loans are cut by date."""
    each = [
        typed(read_undated(source, "loan_recovery", target - max_range + 1, target), "dt_sec_l").withColumn("target", F.lit(target))
        for target in job.targets
    ]
    recovered = reduce(lambda a, b: a.unionByName(b), each)
    return agg_recovery_rollup(recovered.where(F.col("loan_id").isNotNull()), "target")


def loans_of_previous_month(source, job: FeatureJob, max_range: int) -> DataFrame:
    """Loans of the month before a target, with that target."""
    loans = read_table(source, "loan_assign", *job.months(max_range)).withColumn("target", F.col(MONTH) + 1)
    return distinct_rows(typed(loans.where(F.col("target").isin(*job.targets)), "dt_sec_r").drop("date_key"))


def repaid_rows(source, job: FeatureJob, max_range: int) -> DataFrame:
    """Loans of the month before the target with their days to repay."""
    loans = right_join_recovery(
        loans_of_previous_month(source, job, max_range), recoveries(source, job, max_range), "target"
    )
    seconds = epoch_seconds(F.col("recovered_time")) - epoch_seconds(F.col("dt_sec_r"))
    fully = F.col("recovered_amt") == F.col("loan_amount")
    days = F.when(fully, seconds / DAY_SECONDS).otherwise(F.lit(float(UNPAID_DAYS)))
    return loans.withColumn("time_to_repay", days)


def mean_of_previous_month(w: MonthWindow) -> Column:
    return w.mean("time_to_repay", F.col("target") == w.target)


RECOVERY = FeatureGroup(
    name="LoanRec",
    table="loan_recovery",
    key=KEY,
    rows=repaid_rows,
    features=(
        Feature("mean_time_to_repay", "double", mean_of_previous_month, ranges=(2,), default=-1, lengths=(2,)),
    ),
    extra_columns=(("mean_time_to_repay_1", "double"),),
)
