"""Postpaid accounts: the first snapshot of the month, and the change between the first two."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moontally.functions.scalars import flag, ratio
from moontally.operators.grain import leading_rows
from moontally.plans.spec import Feature, FeatureGroup, FeatureJob
from moontally.sources.snapshots import read_table

KEY = "fake_msisdn"
COLUMNS = (
    "fake_msisdn", "credit_limit", "deposit_amt_n", "outstanding_balance", "unbilled_amount",
    "last_status", "last_payment_date", "suspension_flag", "date_key",
)
# Rows of one month are taken by date; the other columns only settle equal dates.
ORDER = ("date", *COLUMNS[1:-1])
BARRED = ("Hard", "Soft")
SILENT_DAYS = 90


def rows(source, job: FeatureJob, max_range: int) -> DataFrame:
    """The rows are numbered before repeated ones could go, so none are removed."""
    return read_table(source, "post_paid", *job.months(max_range), columns=COLUMNS)


def grain(accounts: DataFrame, job: FeatureJob, max_range: int) -> DataFrame:
    """The two leading rows of each month with the row-level flags and ratios; rows are numbered over all months of a key."""
    limit, deposit = F.col("credit_limit"), F.col("deposit_amt_n")
    balance, unbilled = F.col("outstanding_balance"), F.col("unbilled_amount")
    zero = F.lit(0.0)
    quiet = F.datediff("date", "last_payment_date")
    credit = F.coalesce(limit, zero) + F.coalesce(deposit, zero)
    bill = F.coalesce(balance, zero) + F.coalesce(unbilled, zero)
    return leading_rows(accounts, KEY, ORDER).withColumns({
        "is_creditor": flag(balance < 0),
        "unbilled_ratio": ratio(unbilled, limit + deposit),
        "account_status_active": F.when(F.col("last_status").isin(*BARRED), 0).otherwise(1),
        "has_payment": F.when(F.col("last_payment_date").isNull(), 0).otherwise(1),
        "credit_ratio": ratio(balance, limit + deposit),
        "is_suspended": F.when(F.col("suspension_flag").isNull(), 0).otherwise(1),
        "over_limit_flag": flag(balance + unbilled > limit + deposit),
        "deposit_to_credit_ratio": ratio(deposit, limit),
        "churn": flag((quiet > SILENT_DAYS) & (unbilled == 0)),
        "days_since_last_payment": quiet,
        "credit": credit,
        "bill": bill,
        "free": credit - bill,
    })


def first_of_window(name: str):
    return lambda w: F.min_by(w.only(name), w.only("row_number"))


def _at(row: int, name: str) -> Column:
    return F.max(F.when(F.col("row_number") == row, F.col(name)))


def growth(name: str) -> Column:
    """(first - second) / second snapshot."""
    return ratio(_at(1, name) - _at(2, name), _at(2, name))


def grown(name: str):
    """Growth, with declines and missing second snapshots as 0."""
    return lambda w: F.greatest(growth(name), F.lit(0.0))


def utilization_growth(w) -> Column:
    return ratio(ratio(_at(2, "bill"), _at(2, "credit")), ratio(_at(1, "bill"), _at(1, "credit"))) - 1.0


def _snapshot(name: str, type_: str, default=0) -> Feature:
    return Feature(name, type_, first_of_window(name), ranges=(1,), default=default, lengths=(1,))


GROUP = FeatureGroup(
    name="PostPaid",
    table="post_paid",
    key=KEY,
    rows=rows,
    grain=grain,
    per_target=True,
    features=(
        _snapshot("is_creditor", "int"),
        _snapshot("unbilled_ratio", "double"),
        _snapshot("account_status_active", "int", default=1),
        _snapshot("has_payment", "int"),
        _snapshot("credit_ratio", "double"),
        _snapshot("is_suspended", "int"),
        _snapshot("over_limit_flag", "int"),
        _snapshot("deposit_to_credit_ratio", "double"),
        _snapshot("churn", "int"),
        _snapshot("days_since_last_payment", "int", default=F.max),
        Feature("avl_credit_limit_growth", "double", grown("free"), ranges=(2,), lengths=(2,)),
        Feature("deposit_change", "double", grown("deposit_amt_n"), ranges=(2,), lengths=(2,)),
        Feature("total_credit_utilization_growth", "double", utilization_growth, ranges=(2,), lengths=(2,)),
        Feature("credit_limit_change", "double", grown("credit_limit"), ranges=(2,), lengths=(2,)),
        Feature("credit_limit_growth_rate", "double", grown("credit_limit"), ranges=(2,), lengths=(2,)),
    ),
)
