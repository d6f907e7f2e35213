"""Package purchases: by source system and service, and the two-level service statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moontally.functions.scalars import ratio
from moontally.operators.grain import regroup_by_prefix
from moontally.operators.rows import distinct_rows, value_filters
from moontally.operators.windows import MonthWindow, with_window_flags
from moontally.plans.pipeline import present_name
from moontally.plans.spec import Feature, FeatureGroup, FeatureJob
from moontally.sources.snapshots import read_table

KEY = "fake_msisdn"
# Feature suffix -> service name in the source.
SERVICES = {
    "Recharge_Money": "Recharge Money",
    "DATA_BOLTON": "DATA_BOLTON",
    "EREFILL": "EREFILL",
    "DATA_BUYABLE": "DATA_BUYABLE",
    "BillPayment": "BillPayment",
    "Pay_Bill": "Pay Bill",
    "TDD_BOLTON": "TDD_BOLTON",
}
OTHER = "OTHER"


def rows(source, job: FeatureJob, max_range: int) -> DataFrame:
    purchases = read_table(source, "package_purchase", *job.months(max_range)).drop("date_key")
    return distinct_rows(value_filters(purchases, F.col("amount") > 0, F.col("cnt") > 0))


def is_service(suffix: str) -> Column:
    """Rows of one service; OTHER is every named service outside the list."""
    service = F.col("service_type")
    if suffix == OTHER:
        return service.isNotNull() & ~service.isin(*SERVICES.values())
    return service == SERVICES[suffix]


def _largest_count(suffix: str) -> Feature:
    return Feature(
        f"service_v[{suffix}]",
        "bigint",
        lambda w: w.max(F.when(is_service(suffix), F.col("cnt")).otherwise(0)),
    )


def _from_system(kind: str) -> Feature:
    system = f"{kind}_PURCHASE"
    return Feature(f"CNT_{system}", "bigint", lambda w: w.rows(F.col("source_system_cd") == system))


EXTRAS = FeatureGroup(
    name="PackagePurchaseExtras",
    table="package_purchase",
    key=KEY,
    rows=rows,
    features=(
        _from_system("INDIRECT"),
        *[
            _largest_count(suffix)
            for suffix in (
                "BillPayment", "Pay_Bill", "EREFILL", OTHER, "DATA_BOLTON",
                "Recharge_Money", "TDD_BOLTON", "DATA_BUYABLE",
            )
        ],
        _from_system("BUNDLE"),
        _from_system("DIRECT"),
    ),
)


STATISTICS = ("min", "max", "sum")


def service_grain(purchases: DataFrame, windows, span: tuple[int, int]) -> DataFrame:
    """First level: per key and service, every window's statistics (``<name>@<window>``)."""
    purchases, flagged = with_window_flags(purchases, windows, span)
    aggregates = []
    for window in windows:
        w, tag = flagged[window], _tag(window)
        for name in STATISTICS:
            for column in ("cnt", "amount"):
                aggregates.append(getattr(w, name)(column).alias(f"{name}_service_{column}{tag}"))
        aggregates.append(w.mean(ratio(F.col("amount"), F.col("cnt"))).alias(f"mean_price{tag}"))
        aggregates.append((w.rows() > 0).alias(f"seen{tag}"))
    return purchases.groupBy(KEY, "service_type").agg(*aggregates)


def keyed(purchases: DataFrame, windows: list[MonthWindow], span: tuple[int, int]) -> DataFrame:
    """Second level: the same statistic over services; mean prices add up."""
    services = service_grain(purchases, windows, span)
    names = []
    for w in windows:
        tag = _tag(w)
        prices = {
            f"avg_{suffix}{tag}": F.when(
                F.col(f"seen{tag}"), F.when(is_service(suffix), F.col(f"mean_price{tag}")).otherwise(0.0)
            )
            for suffix in (*SERVICES, OTHER)
        }
        seen = F.col(f"seen{tag}").cast("int")
        services = services.withColumns({**prices, f"max_seen{tag}": seen})
        names += [*prices, f"max_seen{tag}"]
        names += [f"{name}_service_{column}{tag}" for name in STATISTICS for column in ("cnt", "amount")]
    one_row = regroup_by_prefix(services, KEY, names)
    return one_row.withColumns({present_name(w): F.col(f"max_seen{_tag(w)}") == 1 for w in windows})


def _tag(window) -> str:
    return f"@{window.target}@{window.months}"


def _column(name: str, type_: str) -> Feature:
    return Feature(name, type_, lambda w: F.col(f"{name}{_tag(w)}"))


PURCHASES = FeatureGroup(
    name="PackagePurchase",
    table="package_purchase",
    key=KEY,
    rows=rows,
    keyed=keyed,
    features=(
        _column("avg_DATA_BUYABLE", "double"),
        _column("sum_service_cnt", "bigint"),
        _column("avg_DATA_BOLTON", "double"),
        _column("avg_Pay_Bill", "double"),
        _column("avg_Recharge_Money", "double"),
        _column("min_service_cnt", "bigint"),
        _column("avg_TDD_BOLTON", "double"),
        _column("avg_EREFILL", "double"),
        _column("avg_BillPayment", "double"),
        _column("sum_service_amount", "double"),
        _column("max_service_cnt", "bigint"),
        _column("max_service_amount", "double"),
        _column("min_service_amount", "double"),
        _column("avg_OTHER", "double"),
    ),
)
