"""Messages from banks."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moontally.functions.calendar import month_start
from moontally.functions.scalars import clean_name, has_vocab, ratio, vocab_position
from moontally.operators.rows import distinct_rows
from moontally.operators.windows import MONTH, MonthWindow
from moontally.plans.pipeline import present_name
from moontally.plans.spec import Feature, FeatureGroup, FeatureJob
from moontally.sources.snapshots import read_table

KEY = "fake_msisdn"
# Gregorian days of the month that count as month end.
MONTH_END_DAYS = (18, 19, 20, 21, 22)


def rows(source, job: FeatureJob, max_range: int) -> DataFrame:
    """Rows whose sender name holds a bank."""
    messages = read_table(source, "customer_person_type_bank_info", *job.months(max_range)).drop("date_key")
    return distinct_rows(messages.where(has_vocab(F.col("bank_name"))))


def with_bank(senders: DataFrame) -> DataFrame:
    """Adds ``bank``, the vocabulary position of the first bank in a sender name."""
    cleaned = senders.withColumn("cleaned", clean_name(F.col("bank_name")))
    return cleaned.withColumn("bank", vocab_position(F.col("cleaned"))).drop("cleaned")


def sender_grain(messages: DataFrame, first: int, last: int) -> DataFrame:
    """Per key and sender, for every month: rows, messages, month-end messages, day map."""
    month = F.col(MONTH)
    month_end = F.dayofmonth("date").isin(*MONTH_END_DAYS)
    aggregates = []
    for m in range(first, last + 1):
        here = month == m
        slot = F.datediff("date", F.lit(month_start(m)))
        aggregates += [
            F.count(F.when(here, 1)).alias(f"rows_{m}"),
            F.sum(F.when(here, F.col("sms_cnt"))).alias(f"sms_{m}"),
            F.sum(F.when(here & month_end, F.col("sms_cnt"))).alias(f"end_{m}"),
            F.bit_or(F.when(here, F.call_function("shiftleft", F.lit(1), slot))).alias(f"days_{m}"),
        ]
    return with_bank(messages.groupBy(KEY, "bank_name").agg(*aggregates))


def _over_months(w: MonthWindow, name: str) -> Column:
    """Sum over the months of a window; a month without a value adds 0."""
    columns = [F.coalesce(F.col(f"{name}_{m}"), F.lit(0)) for m in range(w.first, w.target + 1)]
    return reduce(add, columns)


def keyed(messages: DataFrame, windows: list[MonthWindow], span: tuple[int, int]) -> DataFrame:
    """One row per key in three mergeable groupings, no window over the senders of a key.

    1. per sender: month totals; the sender's score is rows x total, summed over months.
    2. per equal total of the target month: how many senders share it.
    3. per key: the largest total times its senders, and the sums.
    """
    first, last = span
    months, targets = range(first, last + 1), sorted({w.target for w in windows})
    senders = sender_grain(messages, first, last)
    # Rows x messages of a hot key outgrow a long.
    wide = "decimal(19,0)"
    score = reduce(
        add,
        [F.col(f"rows_{m}").cast(wide) * F.coalesce(F.col(f"sms_{m}"), F.lit(0)).cast(wide) for m in months],
    )
    senders = senders.withColumn("score", score)

    per_month = [F.sum(f"{name}_{m}").alias(f"{name}_{m}") for name in ("rows", "sms", "end") for m in months]
    per_month += [F.bit_or(f"days_{m}").alias(f"days_{m}") for m in months]
    best = {_best(w): F.struct("score", _over_months(w, "sms").alias("messages")) for w in windows}
    banks = {
        _banks(w): F.when(_over_months(w, "rows") > 0, F.call_function("shiftleft", F.lit(1), F.col("bank")))
        for w in windows
    }
    totals = [f"total_{t}" for t in targets]
    # The best score with its messages: a maximum of both that tasks merge, whatever their size or sign.
    carried = [
        *[F.max(name).alias(name) for name in best],
        *[F.bit_or(name).alias(name) for name in banks],
    ]
    equal_totals = (
        senders.withColumns({**best, **banks, **{f"total_{t}": F.col(f"sms_{t}") for t in targets}})
        .groupBy(KEY, *totals)
        .agg(*per_month, *carried, F.count(F.lit(1)).alias("senders"))
    )
    if len(targets) > 1:  # a total of one target is spread over the totals of the others
        most = equal_totals.groupBy(KEY).agg(*[F.max(f"total_{t}").alias(f"most_{t}") for t in targets])
        equal_totals = equal_totals.join(most, KEY)
        carried += [F.max(f"most_{t}").alias(f"most_{t}") for t in targets]
        sharing = [F.sum(F.when(F.col(f"total_{t}") == F.col(f"most_{t}"), F.col("senders"))) * F.max(f"most_{t}") for t in targets]
    else:
        sharing = [F.max_by(F.col("senders") * F.col(f"total_{t}"), F.col(f"total_{t}")) for t in targets]
    tops = [column.alias(f"top_{t}") for column, t in zip(sharing, targets)]
    one_row = equal_totals.groupBy(KEY).agg(*per_month, *carried, *tops)
    return one_row.withColumns({present_name(w): _over_months(w, "rows") > 0 for w in windows})


def _best(w: MonthWindow) -> str:
    return f"best_{w.target}_{w.months}"


def _banks(w: MonthWindow) -> str:
    return f"banks_{w.target}_{w.months}"


def active_days(w: MonthWindow) -> Column:
    counts = [F.coalesce(F.bit_count(f"days_{m}"), F.lit(0)) for m in range(w.first, w.target + 1)]
    return reduce(add, counts)


def loyalty_one_month(w: MonthWindow) -> Column:
    """Messages of the top bank(s) of the target month over all."""
    return ratio(F.col(f"top_{w.target}"), _over_months(w, "sms"))


def loyalty_all_months(w: MonthWindow) -> Column:
    """Messages of the bank with the best score over all; a tie takes the larger sender."""
    return ratio(F.col(f"{_best(w)}.messages"), _over_months(w, "sms"))


def per_day(days: int):
    return lambda w: ratio(_over_months(w, "sms"), F.lit(days))


GROUP = FeatureGroup(
    name="BankInfo",
    table="customer_person_type_bank_info",
    key=KEY,
    rows=rows,
    per_target=True,
    keyed=keyed,
    features=(
        Feature("bank_active_days_count", "bigint", active_days),
        Feature("bank_loyalty_ratio_first", "double", loyalty_one_month, ranges=(1,), lengths=(1,)),
        Feature("total_bank_count", "bigint", lambda w: F.bit_count(_banks(w))),
        Feature("bank_loyalty_ratio_both", "double", loyalty_all_months, ranges=(2,), lengths=(2,)),
        Feature("month_end_sms_ratio", "double", lambda w: ratio(_over_months(w, "end"), _over_months(w, "sms"))),
        Feature("avg_daily_bank_sms_first", "double", per_day(30), ranges=(1,), lengths=(1,)),
        Feature("avg_daily_bank_sms_both", "double", per_day(60), ranges=(2,), lengths=(2,)),
    ),
)
