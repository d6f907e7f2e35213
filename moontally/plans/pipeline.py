"""From a feature group and a source to one filled, typed row per subscriber."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moontally.operators.joins import anti_join_droplist
from moontally.operators.rows import fill_const, fill_query, quoted
from moontally.operators.windows import MONTH, MonthWindow, outer_join_ranges, with_window_flags
from moontally.plans.contracts import conform, group_contract
from moontally.plans.spec import FeatureGroup, FeatureJob


def grain_rows(group: FeatureGroup, source, job: FeatureJob, max_range: int | None = None) -> DataFrame:
    """The rows the group's formulas aggregate."""
    max_range = max_range or group.max_range
    rows = group.rows(source, job, max_range)
    return group.grain(rows, job, max_range) if group.grain else rows


def raw_features(group: FeatureGroup, source, job: FeatureJob, max_range: int | None = None) -> DataFrame:
    """All windows of a group in one grouping, before drop list and defaults.

    A key with no row in a window has NULL there, not 0.  ``max_range`` widens the
    months read beyond the group's own ranges: what a formula sees before the window
    starts is part of its meaning.
    """
    max_range = max_range or group.max_range
    rows = group.rows(source, job, max_range)
    if group.per_target and len(set(job.targets)) > 1:
        return features_by_target(group, rows, job, max_range)
    one_row, present = one_row_per_key(group, rows, job, max_range)
    if group.keyed or (group.sees_all and all(present.values())):
        one_row = one_row.where(reduce(or_, [F.col(flag) for flag in present.values()]))

    def guarded(window: MonthWindow, name: str) -> str:
        if present[window] is None:
            return quoted(name)
        return f"CASE WHEN {present[window]} THEN {quoted(name)} END AS {quoted(name)}"

    return one_row.selectExpr(group.key, *[guarded(window, name) for window, _, name in group.columns(job)])


def one_row_per_key(
    group: FeatureGroup, rows: DataFrame, job: FeatureJob, max_range: int
) -> tuple[DataFrame, dict[MonthWindow, str | None]]:
    """Key, features, and per window the column that says whether the key has rows there; None: it always has."""
    columns, windows = group.columns(job), job.windows(group.ranges)
    if group.keyed:
        one_row = group.keyed(rows, windows, job.months(max_range))
        present = {w: present_name(w) for w in windows}
        return one_row.select(
            group.key, *present.values(), *[feature.formula(w).alias(name) for w, feature, name in columns]
        ), present
    rows = group.grain(rows, job, max_range) if group.grain else rows
    frame, flagged = with_window_flags(rows, windows, job.months(max_range), group.sees_all)
    present = {w: None if f.everything else present_name(w) for w, f in flagged.items()}
    return frame.groupBy(group.key).agg(
        *[(f.rows() > 0).alias(present[w]) for w, f in flagged.items() if present[w]],
        *[feature.formula(flagged[window]).alias(name) for window, feature, name in columns],
    ), present


def features_by_target(group: FeatureGroup, rows: DataFrame, job: FeatureJob, max_range: int) -> DataFrame:
    """Several targets of a group whose formulas see more than their window: each as if it were alone.

    A row is copied once for each target whose widest window holds it, and (key, target) takes the place of the
    key, so numbers, lags and limits are taken within what one target sees and limits still come before the shuffle.
    One source scan and one grouping serve all targets; their columns meet in a grouping of one row per key and target.
    """
    held = F.filter(F.array(*[F.lit(t) for t in job.targets]), lambda t: (t >= F.col(MONTH)) & (t < F.col(MONTH) + max_range))
    copies = rows.withColumn("_target", F.explode(held))
    pair = F.struct(F.col(group.key).alias("key"), F.col("_target").alias("target"))
    one_row, present = one_row_per_key(group, copies.withColumn(group.key, pair).drop("_target"), job, max_range)
    own = lambda w: (F.col(f"{group.key}.target") == w.target) & F.col(present[w])
    seen = one_row.where(reduce(or_, [own(w) for w in present]))
    return seen.groupBy(F.col(f"{group.key}.key").alias(group.key)).agg(
        *[F.max(F.when(own(w), F.col(quoted(name)))).alias(name) for w, _, name in group.columns(job)]
    )


def range_frames(group: FeatureGroup, source, job: FeatureJob) -> list[DataFrame]:
    """One frame per range; their outer join equals :func:`raw_features`."""
    return [raw_features(group.in_ranges(months), source, job, group.max_range) for months in group.ranges]


def raw_features_by_range(group: FeatureGroup, source, job: FeatureJob) -> DataFrame:
    return outer_join_ranges(range_frames(group, source, job), group.key)


def fill_features(group: FeatureGroup, frame: DataFrame, job: FeatureJob) -> DataFrame:
    """Declared defaults, constants first, then those computed from the frame."""
    constants, queries = {}, {}
    for window, feature, name in group.columns(job):
        default = feature.default_for(window.months)
        if callable(default):
            queries[name] = default(F.col(quoted(name)))
        elif default is not None:
            constants[name] = default
    return fill_query(fill_const(frame, constants), queries, frame)


def build_features(
    group: FeatureGroup,
    source,
    job: FeatureJob,
    drop_list: DataFrame | None = None,
    fill: bool = True,
) -> DataFrame:
    """The feature table of a group.

    The drop list removes whole keys, so it is applied to the one-row-per-key frame:
    the raw rows are never shuffled (nor a large list broadcast) for it.
    """
    frame = raw_features(group, source, job)
    if drop_list is not None:
        frame = anti_join_droplist(frame, drop_list, group.key)
    if fill:
        frame = fill_features(group, frame, job)
    return conform(frame, group_contract(group, job))


def present_name(window) -> str:
    return f"present_{window.target}_{window.months}"
