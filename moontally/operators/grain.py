"""Rollups and window functions at a bounded grain.

A window function over raw rows of a key puts all of the key's rows into one task.
Every operator here first collapses rows, map-side, to a grain whose size per key does
not grow with the data (calendar days, seconds of a day, billing months), or to distinct
values, and runs its window over that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from moontally.operators.windows import MONTH

DAY_SECONDS = 24 * 3600
# Names that one task puts in order, about; larger ties are cut.
TIE_SEGMENT = 1 << 18


def regroup_by_prefix(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Second level of a two-level grouping; the function follows from the column name.

    ``min_``, ``max_`` and ``sum_`` repeat theirs, ``avg_`` adds up, anything else keeps
    one value (the least, so that it is reproducible).
    """
    rules = {"min_": F.min, "max_": F.max, "sum_": F.sum, "avg_": F.sum}
    return df.groupBy(key).agg(*[rules.get(name[:4], F.min)(F.col(f"`{name}`")).alias(name) for name in columns])


def agg_recovery_rollup(recoveries: DataFrame, *by: str) -> DataFrame:
    """Per loan (and the columns ``by``): recovered sum and last recovery time."""
    return recoveries.groupBy("loan_id", *by).agg(
        F.sum("hsdp_recovery").alias("recovered_amt"), F.max("dt_sec_l").alias("recovered_time")
    )


def agg_installment_rollup(rows: DataFrame, key: str) -> DataFrame:
    """Per (key, instalment): the worst of its delay measures over the snapshots."""
    measures = ("days_delay_new", "days_delayed", "days_after_duedate", MONTH)
    return rows.groupBy(key, "installment_id").agg(*[F.max(m).alias(m) for m in measures])


def previous_active_day(days: DataFrame, key: Sequence[str], active: Mapping[str, Column]) -> DataFrame:
    """Per day row: the latest earlier day that was active, NULL on inactive days.

    ``days`` has one row per key and ``date``; ``active`` maps an output column to the
    condition that makes a day active.
    """
    earlier = Window.partitionBy(*key).orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    return days.withColumns({
        name: F.when(condition, F.max(F.when(condition, F.col("date"))).over(earlier))
        for name, condition in active.items()
    })


def value_months(rows: DataFrame, key: str, value: str, months: tuple[int, int], sums: Mapping[str, Column]) -> DataFrame:
    """One row per (key, value, month) with the ``sums`` of its rows, and ``<value>_seen``: the month before that held the value.

    A value is new to a window where it was not seen since the window's start, so counting those rows counts
    distinct values of every window in one grouping. Months are few, so each has its columns in one mergeable
    hash aggregation per value, and no window function sorts the values of a key.
    """
    span = range(months[0], months[1] + 1)
    held = [F.col(MONTH) == month for month in span]
    per_value = rows.groupBy(key, value).agg(
        *[F.count(F.when(at, 1)).alias(f"_rows_{m}") for m, at in zip(span, held)],
        *[F.sum(F.when(at, column)).alias(f"_{name}_{m}") for m, at in zip(span, held) for name, column in sums.items()],
    )

    def entry(month: int) -> Column:
        earlier = [F.when(F.col(f"_rows_{m}") > 0, F.lit(m)) for m in range(month - 1, span[0] - 1, -1)]
        return F.struct(
            F.lit(month).alias(MONTH), F.col(f"_rows_{month}").alias("_rows"), *[F.col(f"_{name}_{month}").alias(name) for name in sums],
            F.coalesce(F.lit(None).cast("int"), *earlier).alias(f"{value}_seen"),
        )

    entries = F.filter(F.array(*[entry(month) for month in span]), lambda x: x["_rows"] > 0)
    return per_value.select(key, value, F.inline(entries)).drop("_rows")


def event_moments(rows: DataFrame, key: str, moment: str) -> DataFrame:
    """Distinct (key, month, moment) with the number of rows they stand for, and their day.

    An unknown moment stands for no rows and takes part in no interval.
    """
    moments = rows.groupBy(key, MONTH, moment).agg(F.count(moment).alias("n"))
    return moments.withColumn("day", F.unix_date(F.to_date(moment)))


def lag_within_day(moments: DataFrame, key: str, moment: str) -> DataFrame:
    """Adds the previous moment of the same key and day (NULL for the first of the day)."""
    in_day = Window.partitionBy(key, "day").orderBy(moment, MONTH)
    return moments.withColumn("previous", F.lag(moment).over(in_day))


def lag_over_days(daily: DataFrame, key: str) -> DataFrame:
    """Adds ``last_before``: the latest moment on any earlier day of the key."""
    day_number = F.coalesce("day", F.lit(-(2**31) + 2))
    earlier_days = Window.partitionBy(key).orderBy(day_number).rangeBetween(Window.unboundedPreceding, -1)
    return daily.withColumn("last_before", F.max("last_of_day").over(earlier_days))


def lagged_moments(rows: DataFrame, key: str, moment: str) -> DataFrame:
    """Every distinct moment of a key with the one before it.

    Two bounded windows replace one unbounded one: moments of a day, then days of a key.
    """
    moments = lag_within_day(event_moments(rows, key, moment).where(F.col("n") > 0), key, moment)
    daily = moments.groupBy(key, "day").agg(F.max(moment).alias("last_of_day"))
    before = lag_over_days(daily, key).select(key, "day", "last_before")
    return (
        moments.join(before, [key, "day"])
        .withColumn("previous", F.coalesce("previous", "last_before"))
        .drop("day", "last_before")
    )


def interval_grain(rows: DataFrame, key: str, moment: str) -> DataFrame:
    """Per (key, day, month): what the intervals between consecutive rows add up to.

    Columns: ``n`` rows, ``starts`` (1 where the very first row of the key is), and the
    sum, least and greatest interval in seconds, rows at one moment being 0 apart.
    """
    moments = lag_within_day(event_moments(rows, key, moment), key, moment)
    second = F.unix_timestamp(moment)
    gap = second - F.unix_timestamp("previous")
    repeated = F.when(F.col("n") > 1, F.lit(0).cast("long"))
    daily = moments.groupBy(key, "day", MONTH).agg(
        F.sum("n").alias("n"),
        F.sum(gap).alias("gap_sum"),
        F.min(F.least(gap, repeated)).alias("gap_min"),
        F.max(F.greatest(gap, repeated)).alias("gap_max"),
        F.min(F.when(F.col("previous").isNull(), second)).alias("head"),
        F.max(second).alias("last_of_day"),
    )
    head_gap = F.when(F.col("head").isNotNull(), F.col("head") - F.col("last_before"))
    return (
        lag_over_days(daily, key)
        .withColumn("head_gap", head_gap)
        .withColumn("starts", F.when(F.col("head").isNotNull() & F.col("last_before").isNull(), 1).otherwise(0))
        .withColumn("gap_sum", F.coalesce("gap_sum", F.lit(0)) + F.coalesce("head_gap", F.lit(0)))
        .withColumn("gap_min", F.least("gap_min", "head_gap"))
        .withColumn("gap_max", F.greatest("gap_max", "head_gap"))
        .select(key, MONTH, "n", "starts", "gap_sum", "gap_min", "gap_max")
    )


def leading_rows(rows: DataFrame, key: str, order: Sequence[str], keep: int = 2) -> DataFrame:
    """The first ``keep`` rows of every (key, month), numbered over the key as ``row_number``.

    The limit is applied before the shuffle (window group limit), so a task never holds
    more than ``keep`` rows per key, month and upstream task.  Numbers up to ``keep`` are
    those of the whole key.
    """
    in_month = Window.partitionBy(key, MONTH).orderBy(*order)
    over_key = Window.partitionBy(key).orderBy(MONTH, "row_in_month")
    return (
        rows.withColumn("row_in_month", F.row_number().over(in_month))
        .where(F.col("row_in_month") <= keep)
        .withColumn("row_number", F.row_number().over(over_key))
    )


def bank_month_totals(rows: DataFrame, key: str) -> DataFrame:
    """Per (key, sender name, month): rows and messages."""
    return rows.groupBy(key, "bank_name", MONTH).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("sms_cnt").alias("total_sms_count")
    )


def total_ranks(totals: DataFrame, key: str) -> DataFrame:
    """Per key, month and total: ``rank`` among the totals of the month, most messages first.

    Sender names are free text, so a hot key may have any number of them.  Equal totals are
    counted first and ranked as one row each.
    """
    month = [key, MONTH]
    above = Window.partitionBy(*month).orderBy(F.desc("total")).rowsBetween(Window.unboundedPreceding, -1)
    equal = totals.groupBy(*month, F.col("total_sms_count").alias("total")).agg(F.count(F.lit(1)).alias("names"))
    return equal.select(*month, "total", (F.coalesce(F.sum("names").over(above), F.lit(0)) + 1).alias("rank"))


def _with_tie(totals: DataFrame, ties: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``totals`` with what ``ties`` holds for the row's ``columns`` and total (unknown totals are equal).

    An outer join even where every row has its match: then only ``ties`` can be broadcast, and rows stay dealt evenly.
    """
    renamed = ties.withColumnsRenamed({name: f"_{name}" for name in columns})
    same = [F.col(name) == F.col(f"_{name}") for name in columns]
    met = totals.join(renamed, reduce(and_, same, F.col("total_sms_count").eqNullSafe(F.col("total"))), "left")
    return met.drop("total", *[f"_{name}" for name in columns])


def month_rank(totals: DataFrame, key: str) -> DataFrame:
    """``rank`` of the senders of a month by messages, most first; names need no order."""
    met = _with_tie(totals, total_ranks(totals, key), [key, MONTH])
    return met.select(*totals.columns, F.col("rank").cast("int").alias("rank"))


def month_ranks(totals: DataFrame, key: str, names_a_segment: int = TIE_SEGMENT) -> DataFrame:
    """``rank_in_month`` and ``rank`` of the senders of a month by messages, most first, then by name.

    Names are put in order inside an equal total only, and a large tie not in one task: about
    one name in ``names_a_segment``, picked by hash, is a border; the borders cut the tie into
    segments, which are counted and ordered each in a task of its own.  The choice of borders
    moves work, never a rank.
    """
    month, total = [key, MONTH], F.col("total_sms_count").alias("total")
    border = F.col("bank_name").isNotNull() & (F.pmod(F.xxhash64("bank_name"), F.lit(names_a_segment)) == 0)
    borders = totals.where(border).groupBy(*month, total).agg(F.collect_set("bank_name").alias("borders"))
    met = _with_tie(totals, total_ranks(totals, key), month)
    cut = _with_tie(met, borders, month)
    reached = F.size(F.filter("borders", lambda name: name <= F.col("bank_name")))
    cut = cut.withColumn("segment", F.when(F.col("borders").isNotNull(), reached).otherwise(0)).drop("borders")
    in_tie = Window.partitionBy(*month, "total").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    sizes = cut.groupBy(*month, total, "segment").agg(F.count(F.lit(1)).alias("names"))
    before = sizes.select(*month, "total", "segment", F.sum("names").over(in_tie).alias("before")).where(F.col("before") > 0)
    placed = _with_tie(cut, before, [*month, "segment"])
    inside = Window.partitionBy(key, MONTH, "total_sms_count", "segment").orderBy("bank_name")
    rank_in_month = F.col("rank") + F.coalesce("before", F.lit(0)) + F.row_number().over(inside) - 1
    return placed.select(*totals.columns, rank_in_month.cast("int").alias("rank_in_month"), F.col("rank").cast("int").alias("rank"))


def running_totals(totals: DataFrame, key: str) -> DataFrame:
    """``total_sms_cnt_both``: running sum over the rows of a sender, larger months first.

    Every row of a month carries the month's total, so a month adds rows x total;
    equal totals are peers.
    """
    frame = Window.partitionBy(key, "bank_name").orderBy(F.desc("total_sms_count"))
    return totals.withColumn("total_sms_cnt_both", F.sum(F.col("row_count") * F.col("total_sms_count")).over(frame))


def distinct_total_sum(totals: DataFrame, key: str) -> DataFrame:
    """Per key: sum of its distinct month totals."""
    return totals.select(key, "total_sms_count").distinct().groupBy(key).agg(
        F.sum("total_sms_count").alias("distinct_sum")
    )


def month_position(months: DataFrame, key: str) -> DataFrame:
    """``dense_rank`` of a month among the months of its key, and how many there are."""
    over_key = Window.partitionBy(key)
    return months.withColumns({
        "dense_rank": F.dense_rank().over(over_key.orderBy(MONTH)),
        "count_dense_rank": F.count(F.lit(1)).over(over_key),
    })


def first_last(rows: DataFrame, key: str, order: str, columns: Mapping[str, str]) -> DataFrame:
    """Per key: the value of each column in the first and in the last row by ``order``.

    Rows of equal order go by the value itself, unknown values first, and rows without an order do not count, so how rows are dealt to tasks does not matter.
    ``columns`` maps a column to the suffix of its results: ``first_<suffix>``, ``last_<suffix>``.
    """
    ends = {
        suffix: F.when(F.col(order).isNotNull(), F.struct(order, F.col(name).alias("value"))) for name, suffix in columns.items()
    }
    return rows.groupBy(key).agg(
        *[F.min(end)["value"].alias(f"first_{suffix}") for suffix, end in ends.items()],
        *[F.max(end)["value"].alias(f"last_{suffix}") for suffix, end in ends.items()],
    )


def distinct_so_far(months: DataFrame, key: str, values: Sequence[str], column: str, name: str) -> DataFrame:
    """``name``: how many of the known ``values`` the array ``column`` held up to and including each month.

    A running maximum per known value; nothing is collected.
    """
    so_far = Window.partitionBy(key).orderBy(MONTH)
    seen = [F.max(F.array_contains(column, value).cast("int")).over(so_far) for value in values]
    return months.withColumn(name, reduce(add, [F.coalesce(x, F.lit(0)) for x in seen]))


def sums_where(months: DataFrame, key: str, sums: Mapping[str, Column]) -> DataFrame:
    """Adds sums over all rows of the key, next to every row; conditions are part of the summed columns."""
    over_key = Window.partitionBy(key)
    return months.withColumns({name: F.sum(value).over(over_key) for name, value in sums.items()})


def first_last_over(months: DataFrame, key: str, columns: Mapping[str, tuple[str, bool, bool]]) -> DataFrame:
    """Adds values of the key's first or last month next to every row.

    ``columns`` maps a result to (column, whether the last, whether unknown values are passed over).
    """
    whole = Window.partitionBy(key).orderBy(MONTH).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return months.withColumns({
        name: (F.last if last else F.first)(column, ignorenulls=known).over(whole)
        for name, (column, last, known) in columns.items()
    })
