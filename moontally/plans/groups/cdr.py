"""Usage: messages, calls and data per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moontally.functions.calendar import month_start
from moontally.functions.scalars import is_weekend, ratio
from moontally.operators.grain import DAY_SECONDS, previous_active_day
from moontally.operators.rows import distinct_rows
from moontally.operators.windows import MONTH, MonthWindow
from moontally.plans.spec import Feature, FeatureGroup, FeatureJob
from moontally.sources.snapshots import read_table

KEY = "bib_id"
# Usage kind -> source column whose positive value makes a day active.
ACTIVITY = {"sms": "sms_count", "voice": "voice_count", "gprs": "gprs_usage"}
MEASURES = ("sms_count", "voice_count", "call_duration", "gprs_usage")
NO_INTERVAL = {1: 2592000, 2: 5184000}


def rows(source, job: FeatureJob, max_range: int) -> DataFrame:
    return distinct_rows(read_table(source, "cdr", *job.months(max_range)).drop("date_key"))


def day_grain(usage: DataFrame) -> DataFrame:
    """One row per key and day: usage, and for each kind the number of active rows."""
    return usage.groupBy(KEY, MONTH, "date").agg(
        *[F.sum(m).alias(m) for m in MEASURES],
        *[F.count(F.when(F.col(m) > 0, 1)).alias(f"{kind}_rows") for kind, m in ACTIVITY.items()],
    )


def with_previous_days(days: DataFrame) -> DataFrame:
    return previous_active_day(days, [KEY], {f"{kind}_previous": F.col(f"{kind}_rows") > 0 for kind in ACTIVITY})


def grain(usage: DataFrame, job: FeatureJob, max_range: int) -> DataFrame:
    days = with_previous_days(day_grain(usage))
    gaps = {f"{kind}_gap": F.datediff("date", f"{kind}_previous") * DAY_SECONDS for kind in ACTIVITY}
    return days.withColumns({**gaps, "weekend": is_weekend(F.col("date"))})


def _inside(window: MonthWindow, kind: str) -> Column:
    """The previous active day is in the window too."""
    start: dt.date = month_start(window.first)
    return F.col(f"{kind}_previous") >= F.lit(start)


def mean_interval(kind: str):
    """Active rows of one day are 0 apart, so n rows make n - 1 intervals."""

    def formula(w: MonthWindow) -> Column:
        intervals = w.sum(f"{kind}_rows") - 1
        total = F.coalesce(w.sum(f"{kind}_gap", _inside(w, kind)), F.lit(0))
        return F.when(intervals > 0, ratio(total, intervals))

    return formula


def max_interval(kind: str):
    def formula(w: MonthWindow) -> Column:
        longest = F.coalesce(w.max(f"{kind}_gap", _inside(w, kind)), F.lit(0))
        return F.when(w.sum(f"{kind}_rows") > 1, longest)

    return formula


def min_interval(kind: str):
    return lambda w: w.min(f"{kind}_gap", _inside(w, kind))


def total(measure: str):
    return lambda w: F.coalesce(w.sum(measure), F.lit(0))


def active_days(kind: str):
    return lambda w: w.rows(F.col(f"{kind}_rows") > 0)


def weekend_sum(measure: str):
    return lambda w: w.sum(measure, F.col("weekend"))


def weekend_ratio(measure: str):
    return lambda w: ratio(w.sum(measure, F.col("weekend")), w.sum(measure))


def _interval(which: str, kind: str) -> Feature:
    formula, type_ = {
        "mean": (mean_interval, "double"),
        "min": (min_interval, "bigint"),
        "max": (max_interval, "bigint"),
    }[which]
    return Feature(f"{which}_time_interval_{kind}", type_, formula(kind), default=NO_INTERVAL)


GROUP = FeatureGroup(
    name="CDR",
    table="cdr",
    key=KEY,
    rows=rows,
    grain=grain,
    features=(
        Feature("gprs_usage_sum", "double", total("gprs_usage")),
        Feature("sms_count", "bigint", total("sms_count")),
        Feature("ratio_weekend_gprs_usage", "double", weekend_ratio("gprs_usage")),
        _interval("max", "sms"),
        _interval("mean", "voice"),
        _interval("mean", "sms"),
        _interval("min", "gprs"),
        _interval("mean", "gprs"),
        Feature("ratio_weekend_call_duration_sum", "double", weekend_ratio("call_duration")),
        Feature("gprs_usage_activedays", "bigint", active_days("gprs")),
        _interval("min", "voice"),
        Feature("call_duration_sum", "double", total("call_duration")),
        Feature("voice_count", "bigint", total("voice_count")),
        _interval("max", "voice"),
        _interval("max", "gprs"),
        Feature("sms_activedays", "bigint", active_days("sms")),
        _interval("min", "sms"),
        Feature("ratio_weekend_sms_count", "double", weekend_ratio("sms_count")),
        Feature("voice_activedays", "bigint", active_days("voice")),
        Feature("ratio_weekend_voice_count", "double", weekend_ratio("voice_count")),
    ),
    optional=(
        Feature("sms_sum_weekend", "bigint", weekend_sum("sms_count")),
        Feature("voice_sum_weekend", "bigint", weekend_sum("voice_count")),
        Feature("call_duration_sum_weekend", "double", weekend_sum("call_duration")),
        Feature("gprs_usag_sum_weekend", "double", weekend_sum("gprs_usage")),
    ),
)
