"""No task of a feature plan holds a hot key: a third of all rows belong to one."""

import pytest
from pyspark.sql import functions as F

from moontally.functions.calendar import month_span
from moontally.operators import grain
from moontally.plans.groups import GROUPS, bank_info
from moontally.plans.pipeline import raw_features
from moontally.registry import EVENT_GROUPS, job_for
from moontally.sources.star import EVENTS_MONTH, ORDERS_MONTH

ROWS = 60_000
PARTITIONS = 12
SETTINGS = {
    "spark.sql.shuffle.partitions": str(PARTITIONS),
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def number(below: int, seed: int):
    return F.pmod(F.xxhash64(F.col("id"), F.lit(seed)), F.lit(below))


def hot_table(spark, table: str, month: int):
    """Rows of one key in three; the other keys have about thirty each."""
    start, end = month_span(month - 1, month)
    key = F.when(number(3, 1) == 0, "hot").otherwise(F.concat(F.lit("k"), number(ROWS // 30, 2)))
    date = F.date_add(F.lit(start), number((end - start).days, 3).cast("int"))
    day = F.date_format(date, "yyyyMMdd")
    moment = F.concat(day, F.lit(" "), F.date_format(F.timestamp_seconds(number(86400, 4)), "HH:mm:ss"))
    money = lambda seed: (number(1000, seed) / 7).cast("double")
    columns = {
        "cdr": dict(bib_id=key, sms_count=number(3, 5), voice_count=number(3, 6), call_duration=money(7), gprs_usage=money(8), voice_session_cost=money(9)),
        "recharge": dict(bib_id=key, recharge_value_amt=money(5), recharge_dt=moment, origin_host_nm=F.lit("h"), account_balance_before_amt=money(6), account_balance_after_amt=money(7)),
        "package_purchase": dict(fake_msisdn=key, service_type=F.concat(F.lit("s"), number(9, 5)), cnt=1 + number(5, 6), amount=money(7) + 1, source_system_cd=F.lit("x")),
        "domestic_travel": dict(fake_msisdn=key, sum_travel=number(100000, 5)),
        "customer_person_type_bank_info": dict(fake_msisdn=key, bank_name=F.concat(F.lit("Bank Mellat "), number(500, 5)), sms_cnt=1 + number(1000, 6)),
        "handset_price": dict(fake_msisdn=key, handset_model=F.concat(F.lit("m"), number(2000, 5)), handset_brand=F.lit("SAMSUNG"), handset_type=F.lit("s"), cnt_of_days=number(31, 6), month_id=F.lit("1")),
        "loan_assign": dict(bib_id=key, loan_id=number(ROWS, 5).cast("string"), loan_amount=number(1000, 6).cast("string"), date_timestamp=moment),
        "package": dict(bib_id=key, offering_code=F.concat(F.lit("c"), number(300, 5)), offer_amount=money(6), offering_name=F.concat(number(900, 7), F.lit(" gb")), activation_date=moment, deactivation_date=moment),
        "post_paid": dict(fake_msisdn=key, credit_limit=money(5), deposit_amt_n=money(6), outstanding_balance=money(7), unbilled_amount=money(8), last_status=F.lit("Hard"), last_payment_date=date, avl_credit_limit=money(9), suspension_flag=F.lit("Y"), month_id=F.lit("1")),
        "credit_management": dict(fake_msisdn=key, credit_amount=money(5), credit_assigned_date=F.lit("2024-12-31").cast("date"), loan_id=number(99, 6), loan_amount=money(7), loan_status=F.lit(1), installment_id=number(ROWS, 8), installment_amount=money(9), installment_duedate=date, days_delayed=number(50, 10).cast("int")),
        "arpu": dict(fake_msisdn=key, contract_type=F.lit("N"), registration_date=F.lit("1"), gender=F.lit("F"), age=number(80, 5).cast("int"), modem_model=F.lit("m"), flag_sim_tier=F.lit("t"), site_type=F.lit("Port"), res_com_score=money(6), voice_revenue=money(7), gprs_revenue=money(8), sms_revenue=money(9), subscription_revenue=money(10)),
    }[table]
    return spark.range(0, ROWS, 1, 8).select(*[c.alias(n) for n, c in columns.items()], day.alias("date_key"))


class HotSource:
    def __init__(self, spark, folder: str):
        self.spark, self.folder = spark, folder

    def scan_months(self, table: str, first: int, last: int):
        return self.spark.read.parquet(f"{self.folder}/{table}")


def shuffle_reads(spark, run) -> list[list[int]]:
    """Records read per task, for every stage behind a shuffle that ``run`` executes."""
    tracker, store = spark.sparkContext.statusTracker(), spark._jsparkSession.sparkContext().statusStore()
    before = set(tracker.getJobIdsForGroup(None))
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()  # the status store follows the jobs
    stages = {s for job in set(tracker.getJobIdsForGroup(None)) - before for s in tracker.getJobInfo(job).stageIds}
    reads = []
    for stage in stages:
        data = store.lastStageAttempt(stage)
        if data.status().toString() == "COMPLETE" and data.shuffleReadRecords() > 0:
            tasks = store.taskList(stage, data.attemptId(), 1000)
            metrics = [tasks.apply(i).taskMetrics().get().shuffleReadMetrics() for i in range(tasks.size())]
            reads.append(sorted(m.recordsRead() for m in metrics))
    return reads


HOT_GROUPS = [n for n in GROUPS if n not in ("UserInfo", "LoanRec")]


@pytest.mark.parametrize("name", HOT_GROUPS)
def test_tasks_stay_even(spark, tmp_path, name):
    group = GROUPS[name]
    month = EVENTS_MONTH if name in EVENT_GROUPS else ORDERS_MONTH
    hot_table(spark, group.table, month).write.parquet(f"{tmp_path}/{group.table}")
    source = HotSource(spark, str(tmp_path))
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        frame = raw_features(group, source, job_for(name))
        reads = shuffle_reads(spark, lambda: frame.write.format("noop").mode("overwrite").save())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert reads
    fair = ROWS / PARTITIONS
    assert max(r[-1] for r in reads) < 2 * fair, [(r[len(r) // 2], r[-1]) for r in reads]


@pytest.mark.parametrize(("name", "table", "column"), [("HandsetPrice", "handset_price", "handset_model"), ("Package", "package", "offering_name")])
def test_distinct_values_of_a_hot_key_stay_even(spark, tmp_path, name, table, column):
    """A hot key with a value of its own in every row, all of one brand."""
    rows = hot_table(spark, table, EVENTS_MONTH if name in EVENT_GROUPS else ORDERS_MONTH)
    rows.withColumn(column, F.concat(F.lit("v"), F.monotonically_increasing_id())).write.parquet(f"{tmp_path}/{table}")
    source = HotSource(spark, str(tmp_path))
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        frame = raw_features(GROUPS[name], source, job_for(name))
        reads = shuffle_reads(spark, lambda: frame.write.format("noop").mode("overwrite").save())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert reads and max(r[-1] for r in reads) < 2 * ROWS / PARTITIONS, [(r[len(r) // 2], r[-1]) for r in reads]


@pytest.mark.parametrize("equal_totals", [False, True])
def test_ranks_of_free_text_names_stay_even(spark, tmp_path, equal_totals):
    """A hot key with about as many sender names as rows; all with one message each, or not."""
    names = hot_table(spark, "customer_person_type_bank_info", EVENTS_MONTH).withColumn(
        "bank_name", F.concat(F.lit("Bank Mellat "), F.monotonically_increasing_id())
    )
    if equal_totals:
        names = names.withColumn("sms_cnt", F.lit(1).cast("long"))
    names.write.parquet(f"{tmp_path}/customer_person_type_bank_info")
    source = HotSource(spark, str(tmp_path))
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    try:
        totals = grain.bank_month_totals(bank_info.rows(source, job_for("BankInfo"), 2), "fake_msisdn")
        ranked = grain.month_ranks(totals, "fake_msisdn", names_a_segment=50)
        reads = shuffle_reads(spark, lambda: ranked.write.format("noop").mode("overwrite").save())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    # one join reads names and totals together
    assert reads and max(r[-1] for r in reads) < 2.5 * ROWS / PARTITIONS, [(r[len(r) // 2], r[-1]) for r in reads]
