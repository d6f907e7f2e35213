"""Instalment credit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moontally.functions.scalars import days_after_due, days_delay, debt_status, terrible_debt_status
from moontally.operators.grain import agg_installment_rollup
from moontally.operators.rows import const_overwrite
from moontally.operators.windows import MONTH
from moontally.plans.spec import Feature, FeatureGroup, FeatureJob
from moontally.sources.snapshots import read_table

KEY = "fake_msisdn"
CANCELLED = 3
COLUMNS = (
    "fake_msisdn", "credit_assigned_date", "loan_status", "installment_id",
    "installment_duedate", "days_delayed", "date_key",
)
# Debt class -> feature suffix.
CLASSES = {4: "delayed", 3: "ontime", 2: "overdue", 1: "notdue"}


def scored_lines(source, job: FeatureJob, max_range: int) -> DataFrame:
    lines = read_table(source, "credit_management", *job.months(max_range), columns=COLUMNS)
    return lines.where(F.col("credit_assigned_date") > F.lit(job.credit_assigned_after))


def rows(source, job: FeatureJob, max_range: int) -> DataFrame:
    """Every instalment counts in every window: its month becomes the latest one, of several targets that of the target."""
    lines = scored_lines(source, job, max_range)
    return const_overwrite(lines, MONTH) if len(set(job.targets)) == 1 else lines


def instalments(lines: DataFrame) -> DataFrame:
    """One row per instalment with its worst delays."""
    day, due, delayed = F.col("date"), F.col("installment_duedate"), F.col("days_delayed")
    live = lines.where(F.col("loan_status") != CANCELLED).withColumns({
        "days_delay_new": days_delay(day, due, delayed),
        "days_after_duedate": days_after_due(day, due),
    })
    return agg_installment_rollup(live, KEY)


def classified(rolled: DataFrame) -> DataFrame:
    after, delay, delayed = F.col("days_after_duedate"), F.col("days_delay_new"), F.col("days_delayed")
    return rolled.withColumns({
        "debt_status_1": debt_status(after, delay, delayed, 31),
        "debt_status_2": debt_status(after, delay, delayed, 62),
        "terrible_debt_status": terrible_debt_status(after, delayed),
    })


def grain(lines: DataFrame, job: FeatureJob, max_range: int) -> DataFrame:
    if len(set(job.targets)) > 1:
        target = F.col(f"{KEY}.target")
        latest = lines.groupBy(target.alias("_target")).agg(F.max(MONTH).alias("_latest"))
        lines = lines.join(latest, target == F.col("_target")).withColumn(MONTH, F.col("_latest")).drop("_target", "_latest")
    return classified(instalments(lines))


def _count(name: str, months: int, status: str, value: int) -> Feature:
    return Feature(
        name, "bigint", lambda w: w.count("installment_id", F.col(status) == value), ranges=(months,), lengths=(months,)
    )


def _class_count(value: int, months: int) -> Feature:
    suffix = "" if months == 1 else "_2"
    return _count(f"cnt_{CLASSES[value]}{suffix}", months, f"debt_status_{months}", value)


def _class_days(value: int, months: int, default: int) -> Feature:
    suffix = "" if months == 1 else "_2"
    status = f"debt_status_{months}"
    return Feature(
        f"avg_days_{CLASSES[value]}{suffix}",
        "double",
        lambda w: F.coalesce(w.mean("days_delayed", F.col(status) == value), F.lit(float(default))),
        ranges=(months,),
        default=default,
        lengths=(months,),
    )


GROUP = FeatureGroup(
    name="CreditManagement",
    table="credit_management",
    key=KEY,
    rows=rows,
    per_target=True,
    grain=grain,
    features=(
        _class_days(3, 1, default=1),
        _class_days(4, 1, default=-1),
        _class_count(4, 1),
        _class_count(1, 1),
        _class_count(3, 1),
        _class_count(2, 1),
        _count("cnt_much_delayed_notpaid", 2, "terrible_debt_status", 1),
        _class_count(3, 2),
        _count("cnt_much_delayed_paid", 2, "terrible_debt_status", 2),
        _class_days(3, 2, default=1),
        _class_count(1, 2),
        _class_days(4, 2, default=-1),
        _class_count(4, 2),
        _class_count(2, 2),
    ),
)
