import pytest
from pyspark.sql import functions as F

from moontally.functions import scalars
from moontally.operators import grain, joins, naming, rows, windows
from moontally.operators.windows import MONTH, MonthWindow
from moontally.plans.contracts import ContractError, conform


def values(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_names():
    assert naming.range_name("cnt_x_2", 2) == "cnt_x_2_2"
    assert naming.split_range_name("cnt_x_2_2") == ("cnt_x_2", 2)
    assert naming.split_index_name("16842_sms_count_1") == (16842, "sms_count_1")
    assert naming.split_index_name("sms_count_1") is None


@pytest.fixture
def months(spark):
    return spark.createDataFrame([("a", m, m * 10) for m in range(1, 7)] + [("b", 3, 1)], f"key string, {MONTH} int, x int")


def test_single_target_is_the_many_target_assignment_restricted(months):
    for length in (1, 2, 3):
        many = windows.window_assign(months, [4, 5], length).where(F.col(MONTH) == 5)
        assert values(windows.window_assign(months, [5], length)) == values(many)


def test_time_range_keeps_what_any_target_sees(months):
    kept = windows.time_range_filter(months, [4, 5], 2)
    assert {r[MONTH] for r in kept.collect()} == {3, 4, 5}


def test_pivot_prefixes_only_several_targets(months):
    assigned = windows.window_assign(months, [4, 5], 2)
    wide = windows.pivot_features(assigned, "key", [4, 5], {"s": F.sum("x"), "n": F.count(F.lit(1))})
    assert values(wide) == [("a", 70, 2, 90, 2), ("b", 1, 1, None, None)]
    assert set(wide.columns) == {"key", "4_s", "4_n", "5_s", "5_n"}
    assert windows.pivot_features(assigned, "key", [4, 5], {"s": F.sum("x")}).columns == ["key", "4_s", "5_s"]
    lone = windows.window_assign(months, [5], 2)
    assert windows.pivot_features(lone, "key", [5], {"s": F.sum("x"), "m": F.max("x")}).columns == ["key", "s", "m"]
    assert windows.pivot_features(lone, "key", [5], {"s": F.sum("x")}).columns == ["key", "s"]


def test_distinct_days_counts_every_day_of_a_month_once(spark):
    import datetime as dt

    from moontally.functions.calendar import month_index_of, month_start

    index = 16835
    first = month_start(index - 1)
    days = [first + dt.timedelta(days=i) for i in range(62) if month_index_of(first + dt.timedelta(days=i)) <= index]
    frame = spark.createDataFrame([("a", d, month_index_of(d)) for d in days for _ in range(2)], f"key string, date date, {MONTH} int")
    w1, w2 = MonthWindow(index, 1), MonthWindow(index, 2)
    row = frame.groupBy("key").agg(w1.distinct_days("date").alias("one"), w2.distinct_days("date").alias("two")).first()
    assert (row.one, row.two) == (sum(month_index_of(d) == index for d in days), len(days))


def test_regroup_by_prefix(spark):
    frame = spark.createDataFrame([("k", 1, 5, 2, 0.5, "z"), ("k", 3, 7, 4, 1.5, "a")], "key string, min_x int, max_x int, sum_x int, avg_x double, other string")
    assert values(grain.regroup_by_prefix(frame, "key", frame.columns[1:])) == [("k", 1, 7, 6, 2.0, "a")]


def test_data_mb(spark):
    cases = {"5 GB": 5120.0, "500mb": 500.0, "1.5gb": 1536.0, "gb only": None, "none": 0.0, None: None}
    frame = spark.createDataFrame([(k,) for k in cases], "name string")
    got = {r.name: r.mb for r in frame.select("name", scalars.data_mb(F.col("name")).alias("mb")).collect()}
    cases[None] = 0.0  # a missing name holds no unit
    assert got == cases


def test_vocab_match(spark):
    cases = {
        "Iz-MELLAT & Melli": ["mellat", "melli", "iz"],
        " V.Mellat": [],
        "shop": [],
        None: [],
        "me.ll.at": ["mellat"],
    }
    frame = spark.createDataFrame([(k,) for k in cases], "name string")
    got = {r.name: r.m for r in frame.select("name", scalars.vocab_match(F.col("name")).alias("m")).collect()}
    assert got == cases


def test_debt_classes(spark):
    frame = spark.createDataFrame(
        [(31, 5, 5), (31, 5, None), (31, 0, 0), (31, -1, None), (32, 5, 5), (60, 60, None), (62, 40, 40), (63, 10, 10)],
        "after int, delay int, delayed int",
    )
    after, delay, delayed = F.col("after"), F.col("delay"), F.col("delayed")
    got = frame.select(
        scalars.debt_status(after, delay, delayed, 31),
        scalars.debt_status(after, delay, delayed, 62),
        scalars.terrible_debt_status(after, delayed),
    ).collect()
    assert [tuple(r) for r in got] == [
        (4, 4, -1), (2, 2, -1), (3, 3, -1), (1, 1, -1), (-1, 4, -1), (-1, 2, 1), (-1, 4, 2), (-1, -1, -1),
    ]


def test_travel_buckets_and_ratio(spark):
    frame = spark.createDataFrame([(5, 0.0), (6, 2.0), (10, None), (11, 1.0), (None, 1.0)], "t int, d double")
    got = frame.select(scalars.travel_bucket(F.col("t")), scalars.ratio(F.lit(1), F.col("d"))).collect()
    assert [tuple(r) for r in got] == [("1-5", None), ("6-10", 0.5), ("6-10", None), ("11+", 1.0), ("11+", 1.0)]


def test_fills(spark):
    frame = spark.createDataFrame([("a", None, 2.0), ("b", 4, None)], "key string, `x[0]_1` int, `a b_1` double")
    assert values(rows.fill_const(frame, {"x[0]_1": 7, "a b_1": 1, "absent": 3})) == [("a", 7, 2.0), ("b", 4, 1.0)]
    assert values(rows.fill_when_null(frame, {"x[0]_1": 7.5})) == [("a", 7.5, 2.0), ("b", 4.0, None)]
    assert values(rows.fill_query(frame, {"a b_1": F.max("a b_1")})) == [("a", None, 2.0), ("b", 4, 2.0)]


def test_const_overwrite(spark):
    frame = spark.createDataFrame([("a", 1), ("b", 5)], "key string, m int")
    assert values(rows.const_overwrite(frame, "m")) == [("a", 5), ("b", 5)]


def test_contract(spark):
    from pyspark.sql import types as T

    contract = T.StructType([T.StructField("k", T.StringType()), T.StructField("n", T.LongType())])
    frame = spark.createDataFrame([(1, "a")], "n int, k string")
    assert conform(frame, contract).dtypes == [("k", "string"), ("n", "bigint")]
    assert conform(frame.select("k"), contract).first() == ("a", None)
    with pytest.raises(ContractError):
        conform(frame.select("k"), contract, fill_missing=False)
    with pytest.raises(ContractError):
        conform(frame.withColumn("z", F.lit(1)), contract)


def test_right_join_recovery_keeps_loans(spark):
    loans = spark.createDataFrame([(1, "a"), (2, "b")], "loan_id bigint, bib_id string")
    paid = spark.createDataFrame([(1, 3.0), (1, 4.0), (9, 1.0)], "loan_id bigint, hsdp_recovery double")
    rolled = grain.agg_recovery_rollup(paid.withColumn("dt_sec_l", F.lit("2024-01-01").cast("timestamp")))
    got = joins.right_join_recovery(loans, rolled).select("loan_id", "recovered_amt")
    assert values(got) == [(1, 7.0), (2, 0.0)]


def test_lagged_moments_equal_one_window(spark):
    """Bounded two-level lag against the plain window it replaces, with a hot key."""
    from pyspark.sql import Window

    data = (
        spark.range(4000)
        .select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("key"),
            F.timestamp_seconds(1704067200 + (F.hash("id") % 3000000 + 3000000) % 3000000 * 2).alias("t"),
            F.lit(1).alias(MONTH),
        )
        .cache()
    )
    got = grain.lagged_moments(data, "key", "t").select("key", "t", "previous")
    plain = data.distinct().withColumn("previous", F.lag("t").over(Window.partitionBy("key").orderBy("t")))
    assert values(got) == values(plain.select("key", "t", "previous"))


def test_leading_rows_number_the_whole_key(spark):
    from pyspark.sql import Window

    data = spark.range(300).select(
        F.concat(F.lit("k"), F.col("id") % 7).alias("key"),
        (F.hash("id") % 2 + 10).alias(MONTH),
        F.col("id").alias("o"),
    )
    plain = data.withColumn("row_number", F.row_number().over(Window.partitionBy("key").orderBy(MONTH, "o")))
    got = grain.leading_rows(data, "key", ["o"]).where("row_number <= 2").select(*plain.columns)
    assert values(got) == values(plain.where("row_number <= 2"))


@pytest.mark.parametrize("parts", [1, 5])
def test_first_and_last_of_equal_dates_do_not_depend_on_partitions(spark, parts):
    rows = [("a", 1, 5), ("a", 1, 3), ("a", 1, None), ("a", 2, 7), ("a", 2, 9), ("b", 1, None), ("c", None, 4)]
    frame = spark.createDataFrame(rows, "key string, day int, v int").repartition(parts)
    got = {tuple(r) for r in grain.first_last(frame, "key", "day", {"v": "v"}).collect()}
    assert got == {("a", None, 9), ("b", None, None), ("c", None, None)}
