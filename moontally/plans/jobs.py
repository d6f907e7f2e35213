"""The three programs: drop list, feature tables, feature store."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from moontally.functions.calendar import month_index_of
from moontally.plans import droplist
from moontally.plans.contracts import group_contract
from moontally.plans.groups import GROUPS
from moontally.plans.pipeline import build_features
from moontally.plans.spec import FeatureGroup, FeatureJob
from moontally.plans.store import feature_store, store_contract
from moontally.sources.sinks import read_feature_table, sink_table_append, sink_writer_cap
from moontally.sources.snapshots import SnapshotSource, scan_droplist

# Feature table of each group.
TABLES = {
    "CDR": "CDR_features",
    "Recharge": "recharge_features",
    "CreditManagement": "credit_management_features",
    "UserInfo": "userinfo_features",
    "DomesticTravel": "domestic_travel_features",
    "LoanRec": "loanrec_features",
    "LoanAssign": "loanassign_features",
    "PackagePurchaseExtras": "package_purchase_extras_features",
    "PackagePurchase": "package_purchase_features",
    "PostPaid": "postpaid_features",
    "BankInfo": "bankinfo_features",
    "HandsetPrice": "handset_price_features",
    "Package": "package_features",
    "Arpu": "arpu_features",
}
STORE_TABLE = "feature_store"


@dataclass(frozen=True)
class Layout:
    """Where things are: snapshots, drop lists, results."""

    snapshots: str
    drop_lists: str
    output: str
    paths: Mapping[str, str] = field(default_factory=dict)
    #: Writers at most, of feature tables and of drop lists; 0: as many as there are partitions.
    writer_cap: int = 0
    drop_list_writers: int = 0
    #: Batch format of feature tables and its options; parquet tables are partitioned by month.
    fmt: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def drop_list(self, month: int) -> str:
        return f"{self.drop_lists}/drop_list_{month - 1}_{month}"

    def table(self, name: str) -> str:
        return f"{self.output}/{name}"


def run_drop_list(spark: SparkSession, layout: Layout, date: dt.date | str, table: str) -> str:
    """Write the drop list between the month before ``date``'s and its own."""
    month = month_index_of(date)
    source = SnapshotSource(spark, layout.snapshots, layout.paths)
    current, previous = (source.scan_months(table, m, m) for m in (month, month - 1))
    changed = droplist.drop_list(*droplist.ownership(current, previous))
    path = layout.drop_list(month)
    sink_writer_cap(changed, layout.drop_list_writers).write.mode("overwrite").parquet(path)
    return path


def run_features(
    spark: SparkSession, layout: Layout, date: dt.date | str, name: str | FeatureGroup, mode: str = "overwrite"
) -> DataFrame:
    """Write one group's feature table of the month and return it as read back.

    ``name`` is a group's name, or a group with window lengths of its own (``declare``).
    """
    month, group = month_index_of(date), GROUPS[name] if isinstance(name, str) else name
    as_of = dt.date.fromisoformat(date) if isinstance(date, str) else date
    job = FeatureJob(targets=(month,), as_of=as_of)
    source = SnapshotSource(spark, layout.snapshots, layout.paths)
    frame = build_features(group, source, job, scan_droplist(spark, layout.drop_list(month)))
    return _written(spark, layout, TABLES[group.name], frame, group_contract(group, job), month, mode)


def _written(spark: SparkSession, layout: Layout, table: str, frame: DataFrame, contract, month: int, mode: str) -> DataFrame:
    """The rows written in the layout's format, as read back."""
    path, how = layout.table(table), {"fmt": layout.fmt, "options": layout.options}
    sink_table_append(frame, path, contract, month, mode=mode, cap=layout.writer_cap, **how)
    return read_feature_table(spark, path, contract, month, **how)


def run_feature_store(
    spark: SparkSession, layout: Layout, month: int, names: Sequence[str] = tuple(GROUPS)
) -> DataFrame:
    """Write the wide table of a month from its feature tables; a re-run replaces the month."""
    job = FeatureJob(targets=(month,))
    tables = {
        name: read_feature_table(
            spark, layout.table(TABLES[name]), group_contract(GROUPS[name], job), month, layout.fmt, layout.options
        )
        for name in names
    }
    wide = feature_store(tables)
    contract = store_contract() if set(names) == set(GROUPS) else wide.schema
    return _written(spark, layout, STORE_TABLE, wide, contract, month, "overwrite")
