"""What a feature group declares."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame

from moontally.operators.naming import index_name, range_name
from moontally.operators.windows import MonthWindow

Aggregate = Callable[[Column], Column]
Default = float | Mapping[int, float] | Aggregate | None


@dataclass(frozen=True)
class Feature:
    """One feature: its formula for a window, declared ranges, output type and default.

    The default is a number, a number per range, or an aggregate over the finished
    column (a scalar computed from the frame itself).
    """

    name: str
    type: str
    formula: Callable[[MonthWindow], Column]
    ranges: tuple[int, ...] = (1, 2)
    default: Default = 0
    # Window lengths the formula has a meaning for; None: any.
    lengths: tuple[int, ...] | None = None

    def default_for(self, months: int) -> float | Aggregate | None:
        return self.default.get(months) if isinstance(self.default, Mapping) else self.default


@dataclass(frozen=True)
class FeatureJob:
    """One run: target month(s) and the dates formulas may not take from the clock."""

    targets: tuple[int, ...]
    as_of: dt.date | None = None
    # Fixed value: credit lines assigned up to this day are not scored.
    credit_assigned_after: dt.date = dt.date(2024, 12, 16)

    @property
    def target(self) -> int:
        if len(self.targets) != 1:
            raise ValueError("the job has several target months")
        return self.targets[0]

    def windows(self, ranges: Sequence[int]) -> list[MonthWindow]:
        return [MonthWindow(target, months) for months in sorted(ranges) for target in self.targets]

    def months(self, max_range: int) -> tuple[int, int]:
        """First and last billing month any window sees."""
        return min(self.targets) - max_range + 1, max(self.targets)

    def column(self, window: MonthWindow, feature: str) -> str:
        name = range_name(feature, window.months)
        return name if len(self.targets) == 1 else index_name(window.target, name)


@dataclass(frozen=True)
class FeatureGroup:
    """A source table, the rows of it that count, and the features over them.

    ``rows`` reads and types the source; ``grain`` collapses it, if a formula needs
    more than one pass.  A group with ``keyed`` set aggregates by itself, to one row per
    key, from its rows, the windows wanted and the span of months read; its formulas are
    projections of that row, which holds ``present_<window>``.
    """

    name: str
    table: str
    key: str
    features: tuple[Feature, ...]
    rows: Callable[[object, FeatureJob, int], DataFrame]
    grain: Callable[[DataFrame, FeatureJob, int], DataFrame] | None = None
    keyed: Callable[[DataFrame, list[MonthWindow], tuple[int, int]], DataFrame] | None = None
    optional: tuple[Feature, ...] = field(default=())
    # Formulas look at all months read, also at those before their window.
    sees_all: bool = False
    # Numbers, lags or limits run over all months read: with several targets, each has its own copy of the rows.
    per_target: bool = False
    # Declared output columns no feature produces: (name, type).
    extra_columns: tuple[tuple[str, str], ...] = field(default=())

    @property
    def ranges(self) -> tuple[int, ...]:
        return tuple(sorted({months for f in self.features for months in f.ranges}))

    @property
    def max_range(self) -> int:
        return max(self.ranges)

    def declare(self, ranges: Mapping[str, Sequence[int]]) -> FeatureGroup:
        """The group with just these features, each over the window lengths given."""
        known = {f.name: f for f in self.features + self.optional}
        if unknown := sorted(set(ranges) - set(known)):
            raise ValueError(f"{self.name} has no features {unknown}")
        for name, lengths in ranges.items():
            allowed = known[name].lengths
            if not lengths or min(lengths) < 1 or (allowed and not set(lengths) <= set(allowed)):
                raise ValueError(f"{name} is not defined over {tuple(lengths)} months, only over {allowed or 'one or more'}")
        declared = tuple(replace(known[name], ranges=tuple(lengths)) for name, lengths in ranges.items())
        return replace(self, features=declared, optional=(), extra_columns=())

    def with_optional(self) -> FeatureGroup:
        return replace(self, features=self.features + self.optional)

    def in_ranges(self, *ranges: int) -> FeatureGroup:
        """The same group with only some of its ranges."""
        kept = [
            replace(f, ranges=tuple(r for r in f.ranges if r in ranges))
            for f in self.features
            if set(f.ranges) & set(ranges)
        ]
        return replace(self, features=tuple(kept), extra_columns=())

    def columns(self, job: FeatureJob) -> list[tuple[MonthWindow, Feature, str]]:
        """Output columns in declared order: range by range, features as declared."""
        return [
            (window, feature, job.column(window, feature.name))
            for window in job.windows(self.ranges)
            for feature in self.features
            if window.months in feature.ranges
        ]
