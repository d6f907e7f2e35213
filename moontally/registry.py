"""Named queries: every operator and feature group over the star-schema test tables.

Events hold exactly two billing months and feed the usage-side tables; orders span six
years and feed the credit-side tables, row-level queries over all of them, windowed ones
over the target month and the one before.  Doubles are rounded to six digits, so that
results can be compared by value.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from moontally.functions import scalars
from moontally.functions.calendar import epoch_seconds, month_index, parse_date_key, parse_ts
from moontally.operators import grain, joins, rows, windows
from moontally.operators.windows import MONTH
from moontally.plans import droplist, pipeline, store
from moontally.plans.contracts import conform, group_contract
from moontally.plans.groups import GROUPS, arpu, bank_info, cdr, credit, loans, package, postpaid
from moontally.plans.spec import FeatureGroup, FeatureJob
from moontally.sources import sinks, snapshots
from moontally.sources.catalog import SOURCE_COLUMNS
from moontally.sources.star import AS_OF, EVENTS_MONTH, ORDERS_MONTH, StarSource

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Contract types of the source.
CONTRACT_TYPES = ("N", "P")
EVENTS_SPAN = (EVENTS_MONTH - 1, EVENTS_MONTH)
EVENT_GROUPS = (
    "CDR", "Recharge", "DomesticTravel", "PackagePurchaseExtras", "PackagePurchase", "BankInfo",
    "HandsetPrice", "Arpu",
)
EVENT_TABLES = {GROUPS[name].table for name in EVENT_GROUPS}


def job_for(name: str) -> FeatureJob:
    return FeatureJob((EVENTS_MONTH if name in EVENT_GROUPS else ORDERS_MONTH,), as_of=AS_OF)


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, in double arithmetic: large values come through as they are.

    The small shift takes the last bit of a sum off decimal ties.
    """

    def digits(name: str, kind: str) -> str:
        column = rows.quoted(name)
        return f"rint({column} * 1000000D + 0.00001D) / 1000000D AS {column}" if kind == "double" else column

    return df.selectExpr(*[digits(name, kind) for name, kind in df.dtypes])


def query(build: Callable[[StarSource], DataFrame], name: str | None = None) -> Callable:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return rounded(build(StarSource(spark, folder)))

    REGISTRY[name or build.__name__] = run
    return build


# Drop lists of the test tables.


def part_months(source: StarSource) -> tuple[DataFrame, DataFrame]:
    return source.part_owners(ORDERS_MONTH), source.part_owners(ORDERS_MONTH - 1)


def dropped_users(source: StarSource) -> DataFrame:
    changed = droplist.drop_list(source.user_owners(EVENTS_MONTH), source.user_owners(EVENTS_MONTH - 1))
    return snapshots.drop_keys(changed)


def dropped_customers(source: StarSource) -> DataFrame:
    changed = droplist.drop_list(source.customer_owners(ORDERS_MONTH), source.customer_owners(ORDERS_MONTH - 1))
    return snapshots.drop_keys(changed)


# Shared inputs.


def usage_rows(source: StarSource) -> DataFrame:
    return snapshots.read_table(source, "cdr", *EVENTS_SPAN).drop("date_key")


def usage_days(source: StarSource) -> DataFrame:
    return cdr.day_grain(rows.distinct_rows(usage_rows(source)))


def purchase_rows(source: StarSource) -> DataFrame:
    return snapshots.read_all(source, "package_purchase").drop("date_key")


def bank_totals(source: StarSource) -> DataFrame:
    return grain.bank_month_totals(bank_info.rows(source, job_for("BankInfo"), 2), "fake_msisdn")


def arpu_months(source: StarSource) -> DataFrame:
    """Per key and month: revenues, contract types and the site types at both ends."""
    accounts = arpu.rows(source, job_for("Arpu"), 2)
    return accounts.groupBy("fake_msisdn", MONTH).agg(
        *[F.sum(r).alias(r) for r in ("voice_revenue", "gprs_revenue", "sms_revenue")],
        F.array_compact(
            F.array(*[F.max(F.when(F.col("contract_type") == t, t)) for t in CONTRACT_TYPES])
        ).alias("contract_types"),
        F.min_by("site_type", F.struct("date", "site_type")).alias("first_site"),
        F.max_by("site_type", F.struct("date", "site_type")).alias("last_site"),
        F.min_by("site_type", F.when(F.col("site_type").isNotNull(), F.struct("date", "site_type"))).alias(
            "first_known_site"
        ),
        F.max_by("site_type", F.when(F.col("site_type").isNotNull(), F.struct("date", "site_type"))).alias(
            "last_known_site"
        ),
    )


def all_orders(source: StarSource, table: str, columns=None) -> DataFrame:
    return snapshots.read_all(source, table, columns)


def only(group: FeatureGroup, *features: str) -> FeatureGroup:
    wide = group.with_optional()
    return replace(wide, features=tuple(f for f in wide.features if f.name in features))


def raw(source: StarSource, group: FeatureGroup) -> DataFrame:
    return pipeline.raw_features(group, source, job_for(group.name))


def typed(source: StarSource, group: FeatureGroup, frame: DataFrame) -> DataFrame:
    return conform(frame, group_contract(replace(group, extra_columns=()), job_for(group.name)))


def _raw_sides(source: StarSource) -> list[tuple[dict[str, DataFrame], DataFrame]]:
    """Raw features of the groups over users and over customers, each with its drop list.

    All groups read the same two months, which are written once.
    """
    source = source.prepared(written_folder(source), EVENTS_SPAN, (ORDERS_MONTH - 1, ORDERS_MONTH))
    users = {name: raw(source, group) for name, group in GROUPS.items() if name in EVENT_GROUPS}
    customers = {name: raw(source, group) for name, group in GROUPS.items() if name not in EVENT_GROUPS}
    return [(users, dropped_users(source)), (customers, dropped_customers(source))]


def features(source: StarSource, name: str) -> DataFrame:
    dropped = dropped_users(source) if name in EVENT_GROUPS else dropped_customers(source)
    return pipeline.build_features(GROUPS[name], source, job_for(name), dropped)


# Scans and sinks.


def written_folder(source: StarSource) -> str:
    """Where queries that write and read again do so: in the session's shared folder.

    Only a local session without one gets a temporary folder.
    """
    base = source.spark.conf.get("spark.checkpoint.dir", None)
    if not base and source.spark.sparkContext.master.startswith("local"):
        base = tempfile.mkdtemp(prefix="moontally-")
    return sinks.fresh_folder(base)


@query
def scan_months(source: StarSource) -> DataFrame:
    base = written_folder(source)
    written = snapshots.SnapshotSource(source.spark, base)
    for month in EVENTS_SPAN:
        source.scan_months("cdr", month, month).write.parquet(written.path("cdr", month))
    return snapshots.read_table(written, "cdr", *EVENTS_SPAN).drop("date_key")


@query
def scan_registry(source: StarSource) -> DataFrame:
    """Rows per table and month, through the reader of every table."""
    counts = []
    for table in SOURCE_COLUMNS:
        span = EVENTS_SPAN if table in EVENT_TABLES else (ORDERS_MONTH - 1, ORDERS_MONTH)
        read = snapshots.read_table(source, table, *span)
        counts.append(read.groupBy(MONTH).agg(F.count(F.lit(1)).alias("n")).select(F.lit(table).alias("source"), MONTH, "n"))
    return reduce(lambda a, b: a.unionByName(b), counts)


@query
def time_range_filter(source: StarSource) -> DataFrame:
    loan_rows = all_orders(source, "loan_assign").select("bib_id", "loan_id", "date", MONTH)
    return windows.time_range_filter(loan_rows, (ORDERS_MONTH, ORDERS_MONTH - 1), 2)


@query
def scan_droplist(source: StarSource) -> DataFrame:
    path = written_folder(source)
    droplist.drop_list(*part_months(source)).write.parquet(path)
    return snapshots.scan_droplist(source.spark, path)


@query
def distinct_keys(source: StarSource) -> DataFrame:
    return rows.distinct_keys(source.part_owners(None), "key", "owner")


@query
def distinct_rows(source: StarSource) -> DataFrame:
    return rows.distinct_rows(usage_rows(source))


def _written_recharge(source: StarSource, write: Callable[[DataFrame, str], None]) -> DataFrame:
    path = written_folder(source)
    frame = features(source, "Recharge")
    write(frame, path)
    return source.spark.read.schema(frame.schema).parquet(path)


@query
def sink_parquet_features(source: StarSource) -> DataFrame:
    return _written_recharge(source, sinks.sink_parquet_features)


@query
def sink_table_append(source: StarSource) -> DataFrame:
    group, job, path = GROUPS["Recharge"], job_for("Recharge"), written_folder(source)
    contract = group_contract(group, job)
    sinks.sink_table_append(features(source, "Recharge"), path, contract, EVENTS_MONTH)
    return sinks.read_feature_table(source.spark, path, contract, EVENTS_MONTH)


@query
def sink_writer_cap(source: StarSource) -> DataFrame:
    return _written_recharge(source, lambda df, path: sinks.sink_writer_cap(df, 3).write.parquet(path))


@query
def schema_contract(source: StarSource) -> DataFrame:
    group, job = GROUPS["Recharge"], job_for("Recharge")
    frame = pipeline.fill_features(group, raw(source, group), job)
    return conform(frame, group_contract(group, job), fill_missing=False)


# Rows.


@query
def project_cols(source: StarSource) -> DataFrame:
    return rows.project_cols(purchase_rows(source), ["fake_msisdn", "service_type", "cnt"])


@query
def notnull_key_filter(source: StarSource) -> DataFrame:
    handsets = snapshots.read_all(source, "handset_price")
    return rows.notnull_key_filter(
        handsets.select("fake_msisdn", "handset_brand", "handset_model", "cnt_of_days", "date"),
        "fake_msisdn",
        "handset_brand",
    )


@query
def value_filters(source: StarSource) -> DataFrame:
    return rows.value_filters(purchase_rows(source), F.col("amount") > 0, F.col("cnt") > 0)


@query
def na_fill(source: StarSource) -> DataFrame:
    accounts = snapshots.read_all(source, "arpu")
    return rows.na_fill(accounts.select("fake_msisdn", "date", "age", "res_com_score", "site_type"))


@query
def cast_cols(source: StarSource) -> DataFrame:
    return rows.cast_cols(all_orders(source, "loan_assign"), loans.LOAN_TYPES).select("bib_id", "loan_id", "loan_amount")


def _days(source: StarSource) -> DataFrame:
    """Distinct dates of three tables, as text."""
    columns = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    texts = [
        source.base(table).select(F.date_format(column, "yyyyMMdd").alias("date_key"))
        for table, column in columns.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), texts).distinct()


def _month_index(source: StarSource) -> DataFrame:
    days = _days(source).withColumn("date", parse_date_key(F.col("date_key")))
    return days.select("date", month_index(F.col("date")).alias(MONTH))


query(_month_index, "month_index")


def _parse_date_key(source: StarSource) -> DataFrame:
    """Every date text, and a spoiled copy of it that must give NULL."""
    texts = _days(source)
    spoiled = texts.select(F.concat(F.lit("x"), "date_key").alias("date_key"))
    return texts.unionByName(spoiled).select("date_key", parse_date_key(F.col("date_key")).alias("date"))


query(_parse_date_key, "parse_date_key")


def _parse_ts(source: StarSource) -> DataFrame:
    texts = source.base("events").select("event_id", F.date_format("ts", "yyyyMMdd HH:mm:ss").alias("text"))
    return texts.select("event_id", "text", epoch_seconds(parse_ts(F.col("text"))).alias("seconds"))


query(_parse_ts, "parse_ts")


@query
def derived_phase_ab(source: StarSource) -> DataFrame:
    """Weekend flag from the real month, gaps from the assigned one."""
    over_target = Window.partitionBy("bib_id", MONTH).orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    active = F.col("sms_rows") > 0
    before = [{"weekend": scalars.is_weekend(F.col("date")), "real_month": F.col(MONTH)}]
    after = [
        {"previous": F.when(active, F.max(F.when(active, F.col("date"))).over(over_target))},
        {"gap_sms": F.datediff("date", "previous") * grain.DAY_SECONDS},
    ]
    targets = (EVENTS_MONTH - 1, EVENTS_MONTH)
    derived = windows.derived_phase_ab(usage_days(source), before, after, targets, 2)
    return derived.select("bib_id", "date", MONTH, "real_month", "weekend", "sms_count", "gap_sms")


@query
def range_naming(source: StarSource) -> DataFrame:
    return typed(source, GROUPS["Recharge"], raw(source, GROUPS["Recharge"]))


@query
def index_naming(source: StarSource) -> DataFrame:
    group, job = GROUPS["Recharge"], FeatureJob((EVENTS_MONTH - 1, EVENTS_MONTH))
    return conform(pipeline.raw_features(group, source, job), group_contract(group, job))


@query
def const_overwrite(source: StarSource) -> DataFrame:
    lines = credit.rows(source, job_for("CreditManagement"), 2)
    return lines.select("fake_msisdn", "installment_id", "date", MONTH)


@query
def agg_global_max(source: StarSource) -> DataFrame:
    return credit.scored_lines(source, job_for("CreditManagement"), 2).agg(F.max(MONTH).alias(MONTH))


# Joins and sets.


@query
def anti_join_droplist(source: StarSource) -> DataFrame:
    return joins.anti_join_droplist(usage_rows(source), dropped_users(source), "bib_id")


@query
def outer_join_ranges(source: StarSource) -> DataFrame:
    group = GROUPS["LoanAssign"]
    return typed(source, group, pipeline.raw_features_by_range(group, source, job_for("LoanAssign")))


def _all_recoveries(source: StarSource) -> DataFrame:
    return grain.agg_recovery_rollup(loans.typed(all_orders(source, "loan_recovery"), "dt_sec_l"))


@query
def agg_recovery_rollup(source: StarSource) -> DataFrame:
    rolled = _all_recoveries(source)
    return rolled.withColumn("recovered_time", epoch_seconds(F.col("recovered_time")))


@query
def right_join_recovery(source: StarSource) -> DataFrame:
    lent = loans.typed(all_orders(source, "loan_assign"), "dt_sec_r").select("bib_id", "loan_id", "loan_amount")
    joined = joins.right_join_recovery(lent, _all_recoveries(source))
    return joined.withColumn("recovered_time", epoch_seconds(F.col("recovered_time")))


@query
def inner_join_multi_owner(source: StarSource) -> DataFrame:
    return joins.inner_join_multi_owner(source.part_owners(None))


@query
def broadcast_inner_owner(source: StarSource) -> DataFrame:
    return droplist.changed_now(*part_months(source))


@query
def broadcast_anti_owner(source: StarSource) -> DataFrame:
    return droplist.changed_before(*part_months(source))


@query
def union_distinct(source: StarSource) -> DataFrame:
    """All owners of parts and of customers."""
    return joins.union_distinct([source.part_owners(None), source.customer_owners(None)])


@query
def drop_list(source: StarSource) -> DataFrame:
    return droplist.drop_list(*part_months(source))


# Windows and groupings.


@query
def window_assign(source: StarSource) -> DataFrame:
    assigned = windows.window_assign(usage_rows(source), (EVENTS_MONTH - 1, EVENTS_MONTH), 2)
    return assigned.select("bib_id", "date", MONTH, "sms_count", "voice_count", "call_duration")


@query
def pivot_features(source: StarSource) -> DataFrame:
    targets = (EVENTS_MONTH - 1, EVENTS_MONTH)
    assigned = windows.window_assign(usage_rows(source), targets, 2)
    sums = {"sms_sum": F.sum("sms_count"), "voice_max": F.max("voice_count"), "record_count": F.count(F.lit(1))}
    return windows.pivot_features(assigned, "bib_id", targets, sums)


@query
def group_two_level(source: StarSource) -> DataFrame:
    return typed(source, GROUPS["PackagePurchase"], raw(source, GROUPS["PackagePurchase"]))


def _some(name: str, group: str, *names: str) -> None:
    """A grouping operator, shown by the features of a group that use it."""
    picked = only(GROUPS[group], *names)
    query(lambda source: typed(source, picked, raw(source, picked)), name)


_some("agg_sum_coalesce", "CDR", "sms_count", "voice_count", "call_duration_sum", "gprs_usage_sum")
_some("agg_count_distinct", "CDR", "sms_activedays", "voice_activedays", "gprs_usage_activedays")
_some(
    "agg_conditional", "CDR",
    "sms_sum_weekend", "voice_sum_weekend", "call_duration_sum_weekend", "gprs_usag_sum_weekend",
)
_some(
    "agg_basic", "Recharge", "count_recharge", "max_recharge", "min_recharge", "mean_recharge", "sum_recharge"
)
_some("agg_ratio", "Recharge", "ratio_afternoon_recharge", "ratio_weekend_recharge")
_some("agg_set_size", "HandsetPrice", "total_unique_handsets", "total_unique_brands", "brand_diversity_ratio")


@query
def agg_first_last(source: StarSource) -> DataFrame:
    accounts = all_orders(source, "post_paid", postpaid.COLUMNS)
    return grain.first_last(accounts, "fake_msisdn", "date", {"credit_limit": "limit", "last_status": "status"})


@query
def one_hot_vocab(source: StarSource) -> DataFrame:
    handsets = snapshots.read_all(source, "handset_price")
    hot = scalars.one_hot_vocab(F.col("handset_brand"))
    return handsets.select("fake_msisdn", "date", "handset_brand", *[c.alias(f"brand_{i}") for i, c in enumerate(hot)])


def _all_instalments(source: StarSource) -> DataFrame:
    return credit.instalments(all_orders(source, "credit_management", credit.COLUMNS))


@query
def agg_installment_rollup(source: StarSource) -> DataFrame:
    return _all_instalments(source)


@query
def debt_status(source: StarSource) -> DataFrame:
    return credit.classified(_all_instalments(source)).drop(MONTH)


@query
def win_prev_active_day(source: StarSource) -> DataFrame:
    days = cdr.with_previous_days(usage_days(source))
    return days.select("bib_id", "date", "sms_previous", "voice_previous", "gprs_previous")


@query
def weekend_flag(source: StarSource) -> DataFrame:
    usage = snapshots.read_all(source, "cdr")
    return usage.select("bib_id", "date", "sms_count", scalars.flag(scalars.is_weekend(F.col("date"))).alias("weekend"))


@query
def win_lag(source: StarSource) -> DataFrame:
    """Every distinct loan moment of a customer, over six years of orders."""
    lent = loans.typed(all_orders(source, "loan_assign"), "dt_sec")
    lagged = grain.lagged_moments(lent, "bib_id", "dt_sec")
    second, previous = epoch_seconds(F.col("dt_sec")), epoch_seconds(F.col("previous"))
    return lagged.select("bib_id", MONTH, second.alias("seconds"), "n", (second - previous).alias("interval"))


@query
def win_row_number(source: StarSource) -> DataFrame:
    ranked = grain.month_ranks(bank_totals(source), "fake_msisdn")
    return ranked.select("fake_msisdn", "bank_name", MONTH, "total_sms_count", "rank_in_month")


@query
def win_rank(source: StarSource) -> DataFrame:
    ranked = grain.month_rank(bank_totals(source), "fake_msisdn")
    return ranked.select("fake_msisdn", "bank_name", MONTH, "total_sms_count", "rank")


@query
def win_sum_running(source: StarSource) -> DataFrame:
    return grain.running_totals(bank_totals(source), "fake_msisdn")


@query
def win_collect_set_sum(source: StarSource) -> DataFrame:
    return grain.distinct_total_sum(bank_totals(source), "fake_msisdn")


@query
def win_dense_rank(source: StarSource) -> DataFrame:
    return grain.month_position(arpu_months(source), "fake_msisdn").select("fake_msisdn", MONTH, "dense_rank")


@query
def win_set_size(source: StarSource) -> DataFrame:
    return grain.month_position(arpu_months(source), "fake_msisdn").select("fake_msisdn", MONTH, "count_dense_rank")


@query
def win_distinct_list(source: StarSource) -> DataFrame:
    """Contract types seen up to and including each month."""
    counted = grain.distinct_so_far(
        arpu_months(source), "fake_msisdn", CONTRACT_TYPES, "contract_types", "contract_type_count"
    )
    return counted.select("fake_msisdn", MONTH, "contract_type_count")


@query
def win_sum_conditional(source: StarSource) -> DataFrame:
    """Revenue of the latest and of the previous month next to every month."""
    at, n, revenue = F.col("dense_rank"), F.col("count_dense_rank"), F.col("sms_revenue")
    sums = {
        "sms_latest": F.when(at == n, revenue),
        "sms_before": F.when((at == 1) & (n > 1), revenue).otherwise(0.0),
    }
    months = grain.month_position(arpu_months(source), "fake_msisdn")
    return grain.sums_where(months, "fake_msisdn", sums).select("fake_msisdn", MONTH, *sums)


@query
def win_first_last(source: StarSource) -> DataFrame:
    """First and last site type of a key, with and without unknown ones."""
    columns = {
        "first_site": ("first_site", False, False),
        "last_site": ("last_site", True, False),
        "first_known_site": ("first_known_site", False, True),
        "last_known_site": ("last_known_site", True, True),
    }
    return grain.first_last_over(arpu_months(source), "fake_msisdn", columns).select("fake_msisdn", MONTH, *columns)


def _travel_days(source: StarSource) -> DataFrame:
    """Per key and day: trips, and the key's total over both months."""
    trips = rows.distinct_rows(snapshots.read_table(source, "domestic_travel", *EVENTS_SPAN).drop("date_key"))
    days = trips.groupBy("fake_msisdn", "date").agg(F.sum("sum_travel").alias("sum_travel"))
    return grain.sums_where(days, "fake_msisdn", {"total_travel": F.col("sum_travel")})


@query
def win_sum_partition(source: StarSource) -> DataFrame:
    return _travel_days(source)


@query
def travel_bucket(source: StarSource) -> DataFrame:
    return _travel_days(source).withColumn("travel_bucket", scalars.travel_bucket(F.col("total_travel")))


# Scalar functions.


def _offers(source: StarSource) -> DataFrame:
    return all_orders(source, "package").select("bib_id", "offering_name", "offering_code")


@query
def norm_string(source: StarSource) -> DataFrame:
    offers = _offers(source)
    return offers.select(
        "bib_id",
        scalars.norm_string(F.col("offering_name")).alias("name"),
        scalars.norm_string(F.col("offering_code")).alias("code"),
    )


@query
def data_mb(source: StarSource) -> DataFrame:
    return _offers(source).select("bib_id", "offering_name", scalars.data_mb(F.col("offering_name")).alias("data_mb"))


@query
def vocab_match(source: StarSource) -> DataFrame:
    messages = snapshots.read_all(source, "customer_person_type_bank_info")
    matched = F.array_join(scalars.vocab_match(F.col("bank_name")), ",")
    return messages.select("fake_msisdn", "date", "bank_name", matched.alias("matched_banks"))


@query
def afternoon_flag(source: StarSource) -> DataFrame:
    paid = snapshots.read_all(source, "recharge")
    afternoon = scalars.is_afternoon(parse_ts(F.col("recharge_dt")), F.col("recharge_value_amt"))
    return paid.select("bib_id", "recharge_dt", "recharge_value_amt", scalars.flag(afternoon).alias("afternoon"))


@query
def ratio_null_safe(source: StarSource) -> DataFrame:
    accounts = all_orders(source, "post_paid", postpaid.COLUMNS)
    limit, deposit = F.col("credit_limit"), F.col("deposit_amt_n")
    return accounts.select(
        "fake_msisdn",
        "date",
        scalars.ratio(F.col("outstanding_balance"), limit + deposit).alias("credit_ratio"),
        scalars.ratio(deposit, limit).alias("deposit_to_credit_ratio"),
    )


# Fills.


@query
def fill_const(source: StarSource) -> DataFrame:
    group, job = GROUPS["LoanAssign"], job_for("LoanAssign")
    defaults = {name: f.default_for(w.months) for w, f, name in group.columns(job)}
    return typed(source, group, rows.fill_const(raw(source, group), defaults))


@query
def fill_query(source: StarSource) -> DataFrame:
    picked = only(GROUPS["PostPaid"], "days_since_last_payment", "has_payment", "credit_limit_change")
    frame = raw(source, picked)
    return typed(source, picked, rows.fill_query(frame, {"days_since_last_payment_1": F.max("days_since_last_payment_1")}))


@query
def fill_when_null(source: StarSource) -> DataFrame:
    group = GROUPS["LoanAssign"]
    defaults = {"mean_time_interval_loan_1": 2592000, "loan_amount_sum_1": 0, "loan_amount_sum_2": 0}
    return typed(source, group, rows.fill_when_null(raw(source, group), defaults))


# Feature groups and the store.

FEATURE_QUERIES = {
    "fg_cdr": "CDR",
    "fg_package": "Package",
    "fg_user_info": "UserInfo",
    "fg_package_purchase_extras": "PackagePurchaseExtras",
    "fg_package_purchase": "PackagePurchase",
    "fg_arpu": "Arpu",
    "fg_handset": "HandsetPrice",
    "fg_bank_info": "BankInfo",
    "fg_recharge": "Recharge",
    "fg_loan_assign": "LoanAssign",
    "fg_loan_rec": "LoanRec",
    "fg_domestic_travel": "DomesticTravel",
    "fg_postpaid": "PostPaid",
    "fg_credit_management": "CreditManagement",
}


def _feature_query(group: str) -> None:
    query(lambda source: features(source, group), next(k for k, v in FEATURE_QUERIES.items() if v == group))


for _group in FEATURE_QUERIES.values():
    _feature_query(_group)


def _written_sides(source: StarSource) -> list[store.Side]:
    """Store parts of all groups as bucketed tables, each group built once."""
    buckets = int(source.spark.conf.get("spark.sql.shuffle.partitions"))
    return store.written_sides(store.raw_sides(_raw_sides(source)), written_folder(source), buckets)


@query
def id_spine(source: StarSource) -> DataFrame:
    """Ids of all groups; each drop list is taken out of the ids of its side once."""
    spines = []
    for frames, dropped in _raw_sides(source):
        ids = joins.id_spine([(frame, GROUPS[name].key) for name, frame in frames.items()])
        spines.append(joins.anti_join_droplist(ids, dropped, store.ID))
    return joins.union_distinct(spines)


@query
def store_left_joins(source: StarSource) -> DataFrame:
    return store.wide_sides(_written_sides(source), store.joined, filled=True)


@query
def store_coalesce(source: StarSource) -> DataFrame:
    return store.store_of_sides(_written_sides(source), store.joined)


@query
def feature_store(source: StarSource) -> DataFrame:
    return store.store_of_sides(store.raw_sides(_raw_sides(source)))
