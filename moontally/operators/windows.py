"""Trailing windows of billing months.

A window of ``months`` at ``target`` holds the rows with
``target - months < month_index <= target``.  Feature formulas ask a window for
conditional aggregates, so every (target, range) pair is computed in one pass over
one grouping; :func:`window_assign` and :func:`pivot_features` give the same result
row-wise, for callers that want the assigned rows themselves.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moontally.functions.calendar import month_span, month_start
from moontally.operators.naming import index_name, strip_index

MONTH = "month_index"


@dataclass(frozen=True)
class MonthWindow:
    """The ``months`` billing months that end with ``target``.

    Formulas meet the window as a condition on every aggregate.  ``flag`` names a boolean
    column that already holds it; ``everything`` says the frame has no other rows.
    """

    target: int
    months: int
    flag: str | None = None
    everything: bool = False

    @property
    def first(self) -> int:
        return self.target - self.months + 1

    @property
    def flag_name(self) -> str:
        return f"in_{self.target}_{self.months}"

    def holds(self) -> Column:
        month = F.col(MONTH)
        if self.months == 1:
            return month == self.target
        return (month >= self.first) & (month <= self.target)

    def only(self, value: Column | str, *conditions: Column) -> Column:
        """The value on rows of the window (and of the conditions), NULL elsewhere."""
        value = F.col(value) if isinstance(value, str) else value
        if not self.everything:
            conditions = (F.col(self.flag) if self.flag else self.holds(), *conditions)
        return F.when(reduce(and_, conditions), value) if conditions else value

    def rows(self, *conditions: Column) -> Column:
        return F.count(self.only(F.lit(1), *conditions))

    def sum(self, value: Column | str, *conditions: Column) -> Column:
        return F.sum(self.only(value, *conditions))

    def count(self, value: Column | str, *conditions: Column) -> Column:
        return F.count(self.only(value, *conditions))

    def mean(self, value: Column | str, *conditions: Column) -> Column:
        return F.avg(self.only(value, *conditions))

    def min(self, value: Column | str, *conditions: Column) -> Column:
        return F.min(self.only(value, *conditions))

    def max(self, value: Column | str, *conditions: Column) -> Column:
        return F.max(self.only(value, *conditions))

    def distinct(self, value: Column | str, *conditions: Column) -> Column:
        return F.count_distinct(self.only(value, *conditions))

    def distinct_seen(self, name: str) -> Column:
        """Distinct values of a column that has its ``_seen`` month beside it."""
        seen = F.col(f"{name}_seen")
        return self.rows(F.col(name).isNotNull() & (seen.isNull() | (seen < self.first)))

    def distinct_days(self, day: Column | str, *conditions: Column) -> Column:
        """Exact distinct count of dates: one 31-bit map per month, no distinct shuffle."""
        day = F.col(day) if isinstance(day, str) else day
        counts = [
            F.bit_count(F.bit_or(F.when(reduce(and_, conditions, F.col(MONTH) == m), _day_bit(day, m))))
            for m in range(self.first, self.target + 1)
        ]
        return reduce(add, [F.coalesce(c, F.lit(0)) for c in counts]).cast("long")


def _day_bit(day: Column, month: int) -> Column:
    start: dt.date = month_start(month)
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.datediff(day, F.lit(start)))


def time_range_filter(df: DataFrame, targets: Sequence[int], months: int) -> DataFrame:
    """Rows any of the targets can see through its largest window.

    Months are consecutive date ranges, so a frame that has the ``date`` is cut by date:
    a filter the optimizer can move towards the scan without the month arithmetic.
    """
    first, last = min(targets) - months + 1, max(targets)
    if "date" not in df.columns:
        return df.where(F.col(MONTH).between(first, last))
    start, end = month_span(first, last)
    return df.where((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(end)))


def window_assign(df: DataFrame, targets: Sequence[int], months: int) -> DataFrame:
    """Overwrite ``month_index`` by the target(s) whose window holds the row.

    One target is a filter; several targets repeat a row once per window it falls in
    (at most ``months`` times).
    """
    if len(targets) == 1:
        window = MonthWindow(targets[0], months)
        return df.where(window.holds()).withColumn(MONTH, F.lit(targets[0]))
    wanted = list(targets)
    later = F.sequence(F.col(MONTH), F.col(MONTH) + F.lit(months - 1))
    return df.withColumn(MONTH, F.explode(F.filter(later, lambda m: m.isin(wanted))))


def derived_phase_ab(
    df: DataFrame,
    before: Sequence[Mapping[str, Column]],
    after: Sequence[Mapping[str, Column]],
    targets: Sequence[int],
    months: int,
) -> DataFrame:
    """Ordered derived columns around the window assignment.

    ``before`` sees the real month of a row, ``after`` sees the target it was
    assigned to.  Each mapping is one projection; later ones may use earlier ones.
    """
    df = reduce(lambda d, columns: d.withColumns(dict(columns)), before, df)
    df = window_assign(df, targets, months)
    return reduce(lambda d, columns: d.withColumns(dict(columns)), after, df)


def pivot_features(df: DataFrame, key: str, targets: Sequence[int], features: Mapping[str, Column]) -> DataFrame:
    """One row per key from assigned rows; columns are prefixed when targets are several."""
    pivoted = df.groupBy(key).pivot(MONTH, list(targets))
    if len(features) == 1:  # Spark names the columns of a lone aggregate by target only
        (name, column), = features.items()
        wide = pivoted.agg(column.alias(name))
        wide = wide.withColumnsRenamed({str(t): index_name(t, name) for t in targets})
    else:
        wide = pivoted.agg(*[column.alias(name) for name, column in features.items()])
    return strip_index(wide) if len(targets) == 1 else wide


def outer_join_ranges(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full-outer join of per-range feature frames; a key absent from a range keeps NULLs."""
    return reduce(lambda left, right: left.join(right, key, "full_outer"), frames)


def any_window(windows: Sequence[MonthWindow]) -> Column:
    return reduce(or_, [window.holds() for window in windows])


def with_window_flags(
    df: DataFrame, windows: Sequence[MonthWindow], span: tuple[int, int], keep_all: bool = False
) -> tuple[DataFrame, dict[MonthWindow, MonthWindow]]:
    """Rows of any window, one flag column per window, and the windows that use them.

    The condition of a window is evaluated once per row instead of once per aggregate.
    ``span`` are the months the frame holds: a window over all of them needs no
    condition, and no rows are filtered when the windows leave none out.  ``keep_all``
    leaves the rows before the windows to formulas that look at them.
    """
    held = set(range(span[0], span[1] + 1))
    seen = {w: held & set(range(w.first, w.target + 1)) for w in windows}
    if not keep_all and set().union(*seen.values()) != held:
        df = df.where(any_window(windows))
        held = set().union(*seen.values())
    flagged = {
        w: replace(w, everything=True) if months == held else replace(w, flag=w.flag_name)
        for w, months in seen.items()
    }
    return df.withColumns({w.flag: w.holds() for w in flagged.values() if w.flag}), flagged
