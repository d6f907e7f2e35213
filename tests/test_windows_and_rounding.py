"""What formulas may see outside their window, lengths that have a meaning, and values kept by rounding."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from check import database
from moontally.functions.calendar import month_start
from moontally.operators import grain
from moontally.plans import jobs
from moontally.plans.groups import GROUPS
from moontally.plans.pipeline import raw_features, raw_features_by_range
from moontally.plans.spec import FeatureJob
from moontally.registry import REGISTRY, rounded
from moontally.sources.star import EVENTS_MONTH, ORDERS_MONTH
from oracle.groups import rounded as rounded_sql

FOLDER = "/root/testdata/sf0.001"


class Tables:
    def __init__(self, spark, **tables):
        self.spark, self.tables = spark, tables

    def scan_months(self, table, first, last):
        return self.tables[table]


def day(month: int, after: int = 3) -> str:
    return f"{month_start(month) + dt.timedelta(days=after):%Y%m%d}"


@pytest.mark.parametrize("value", [1e13, 5e14, -1e13, 0.12345649951, -0.12345649951, 2.5e-7, 9007199254740993.0])
def test_rounding_keeps_large_values_and_agrees_with_sql(spark, value):
    ours = rounded(spark.createDataFrame([(value,)], "v double")).first().v
    theirs = database(FOLDER).execute(f"SELECT {rounded_sql('?')}", [value]).fetchone()[0]
    assert ours == theirs and ours == pytest.approx(value, abs=5.1e-7, rel=1e-15)
    if abs(value) > 1e12:
        assert ours == value


def travel(spark, *rows):
    frame = spark.createDataFrame([(k, day(m, d), n) for k, m, d, n in rows], "fake_msisdn string, date_key string, sum_travel long")
    return Tables(spark, domestic_travel=frame)


def test_travel_bucket_comes_from_all_months_in_both_plans(spark):
    month = EVENTS_MONTH
    source = travel(spark, ("a", month - 1, 3, 9), ("a", month, 3, 3), ("b", month - 1, 3, 4), ("b", month, 3, 3), ("c", month - 1, 3, 12), ("d", month, 3, 5))
    for plan in (raw_features, raw_features_by_range):
        rows = {r.fake_msisdn: r for r in plan(GROUPS["DomesticTravel"], source, FeatureJob((month,))).collect()}
        assert [rows["a"][f"travel_11_plus_{n}"] for n in (1, 2)] == [1, 1]
        assert [rows["b"][f"travel_6_10_{n}"] for n in (1, 2)] == [1, 1]
        assert [rows["c"][f"travel_11_plus_{n}"] for n in (1, 2)] == [None, 1]
        assert [rows["d"][f"travel_1_5_{n}"] for n in (1, 2)] == [1, 1]
    alone = raw_features(GROUPS["DomesticTravel"].in_ranges(1), source, FeatureJob((month,)), 2)
    assert sorted(r.fake_msisdn for r in alone.collect()) == ["a", "b", "d"]


def test_recoveries_count_whatever_their_date(spark):
    month = ORDERS_MONTH
    lent = spark.createDataFrame(
        [("k", "1", "100", day(month - 1), f"{day(month - 1)} 00:00:00")],
        "bib_id string, loan_id string, loan_amount string, date_key string, date_timestamp string",
    )
    paid = spark.createDataFrame(
        [("k", "1", "100", 100.0, day(month + 1), f"{day(month - 1, 7)} 00:00:00")],
        "bib_id string, loan_id string, loan_amount string, hsdp_recovery double, date_key string, date_timestamp string",
    )
    row = raw_features(GROUPS["LoanRec"], Tables(spark, loan_assign=lent, loan_recovery=paid), FeatureJob((month,))).first()
    assert row["mean_time_to_repay_2"] == 4.0


def test_numbered_groups_take_several_targets(spark):
    job = FeatureJob((ORDERS_MONTH - 1, ORDERS_MONTH))
    for name in ("PostPaid", "LoanRec"):
        made = raw_features(GROUPS[name], REGISTRY_SOURCE(spark), job).columns
        declared = {column for *_, column in GROUPS[name].columns(job)}
        assert declared and declared <= set(made)


def REGISTRY_SOURCE(spark):
    from moontally.sources.star import StarSource

    return StarSource(spark, FOLDER)


@pytest.mark.parametrize(
    ("group", "feature", "length"),
    [("BankInfo", "bank_loyalty_ratio_first", 2), ("Arpu", "sms_revenue_change", 3), ("BankInfo", "avg_daily_bank_sms_both", 1), ("PostPaid", "deposit_change", 1), ("CreditManagement", "cnt_delayed_2", 1), ("CDR", "sms_count", 0)],
)
def test_lengths_without_a_meaning_raise(group, feature, length):
    with pytest.raises(ValueError):
        GROUPS[group].declare({feature: (length,)})


@pytest.mark.parametrize("names_a_segment", [1, 3, 1 << 18])
def test_ranks_equal_a_window_over_all_names(spark, names_a_segment):
    rows = [("k", f"n{i}", 1, i % 4 if i % 5 else None) for i in range(40)] + [("j", "n", 1, 3), ("j", "m", 2, 3)]
    totals = spark.createDataFrame(rows, "key string, bank_name string, month_index int, total_sms_count long")
    got = {(r.key, r.bank_name): (r.rank_in_month, r["rank"]) for r in grain.month_ranks(totals, "key", names_a_segment).collect()}
    assert {(r.key, r.bank_name): r["rank"] for r in grain.month_rank(totals, "key").collect()} == {k: v[1] for k, v in got.items()}
    for key, month in (("k", 1), ("j", 1), ("j", 2)):
        own = sorted((x for x in rows if (x[0], x[2]) == (key, month)), key=lambda x: (-(x[3] if x[3] is not None else -1), x[1]))
        for i, x in enumerate(own):
            first = next(n for n, y in enumerate(own) if y[3] == x[3])
            assert got[key, x[1]] == (i + 1, first + 1)


def test_job_with_declared_lengths_and_another_format(spark, tmp_path):
    month = EVENTS_MONTH
    for m in range(month - 2, month + 1):
        travel(spark, ("a", m, 3, 2)).tables["domestic_travel"].write.parquet(f"{tmp_path}/in/{m}/domestic_travel")
    spark.createDataFrame([("z", "o")], "key string, owner string").write.parquet(f"{tmp_path}/drops/drop_list_{month - 1}_{month}")
    layout = jobs.Layout(f"{tmp_path}/in", f"{tmp_path}/drops", f"{tmp_path}/out", fmt="orc", options={"compression": "zlib"})
    group = GROUPS["DomesticTravel"].declare({"total_travel": (1, 3)})
    got = jobs.run_features(spark, layout, f"{month_start(month):%Y-%m-%d}", group)
    assert [tuple(r) for r in got.collect()] == [("a", 2, 6)]
    assert list((tmp_path / "out" / jobs.TABLES["DomesticTravel"] / f"month_index={month}").glob("*.orc"))


def test_bank_scores_use_hash_aggregation(spark):
    text = REGISTRY["fg_bank_info"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text


@pytest.mark.parametrize(("name", "exchanges"), [("HandsetPrice", 4), ("Package", 5)])
def test_distinct_values_need_no_window(spark, name, exchanges):
    """The de-duplication (read by each branch), one grouping per branch, the grouping by key."""
    from moontally.registry import raw

    plan = raw(REGISTRY_SOURCE(spark), GROUPS[name])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and "REPARTITION" not in text
    plan.write.format("noop").mode("overwrite").save()
    plan.collect()
    final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") - final.count("ReusedExchange") <= exchanges, final


def test_value_months_of_a_value_in_some_months(spark):
    rows = spark.createDataFrame(
        [("k", "a", 5, 1), ("k", "a", 7, 2), ("k", "a", 7, 3), ("k", "b", 6, None), ("k", None, 7, 4), (None, "a", 5, 5)],
        "key string, v string, month_index int, x int",
    )
    got = grain.value_months(rows, "key", "v", (5, 7), {"x": F.col("x")})
    assert got.columns == ["key", "v", "month_index", "x", "v_seen"]
    want = [("k", "a", 5, 1, None), ("k", "a", 7, 5, 5), ("k", "b", 6, None, None), ("k", None, 7, 4, None), (None, "a", 5, 5, None)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert grain.value_months(rows.limit(0), "key", "v", (5, 7), {}).collect() == []
