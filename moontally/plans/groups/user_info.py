"""Subscriber master data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moontally.functions.calendar import parse_date_key
from moontally.functions.scalars import flag
from moontally.plans.spec import Feature, FeatureGroup, FeatureJob
from moontally.sources.snapshots import read_table

KEY = "bib_id"
# The ability statuses reported as flags.
STATUSES = ("HARD", "ERASED", "OTHER", "READY TO ACTIVATE SOFT", "SOFT", "ACTIVE", "READY TO ACTIVE")
COLUMNS = ("bib_id", "contract_type_v", "registration_date_d", "ability_status", "account_balance", "date_key")


def rows(source, job: FeatureJob, max_range: int) -> DataFrame:
    """Every feature is a maximum, so repeated rows need no removal, and no shuffle for it."""
    if job.as_of is None:
        raise ValueError("bib_age needs the job's as_of date")
    users = read_table(source, "user_info", *job.months(max_range), columns=COLUMNS)
    age = F.lit(job.as_of.year) - F.year(parse_date_key(F.col("registration_date_d")))
    balance = F.when(F.col("account_balance").isNull(), 0.0).otherwise(F.col("account_balance").try_cast("double"))
    return users.withColumns({"age": age, "balance": balance})


def status_flag(status: str):
    def formula(w) -> Column:
        return w.max(flag(F.col("ability_status") == status))

    return Feature(f"abstat_{status}", "int", formula, ranges=(1,))


_by_status = {status: status_flag(status) for status in STATUSES}

GROUP = FeatureGroup(
    name="UserInfo",
    table="user_info",
    key=KEY,
    rows=rows,
    per_target=True,
    features=(
        _by_status["HARD"],
        _by_status["ERASED"],
        _by_status["OTHER"],
        _by_status["READY TO ACTIVATE SOFT"],
        Feature("postpaid", "int", lambda w: w.max(flag(F.col("contract_type_v") == "N")), ranges=(1,), default=-1),
        Feature("max_account_balance", "double", lambda w: w.max("balance"), ranges=(1,)),
        _by_status["SOFT"],
        Feature("bib_age", "int", lambda w: w.max("age"), ranges=(1,)),
        _by_status["ACTIVE"],
        _by_status["READY TO ACTIVE"],
    ),
)
