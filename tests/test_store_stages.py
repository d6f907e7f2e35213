"""The store query builds each group once: executed stages, counted from Spark's own records."""

import time

import pytest

from moontally.plans import store
from moontally.registry import EVENT_TABLES, EVENTS_SPAN, ORDERS_MONTH, REGISTRY, StarSource, _raw_sides
from moontally.sources.catalog import SOURCE_COLUMNS

FOLDER = "/root/testdata/sf0.001"


def executed(spark, run) -> list:
    """(reads files, tasks) of every stage that ``run`` executes."""
    tracker, store = spark.sparkContext.statusTracker(), spark._jsparkSession.sparkContext().statusStore()
    before = set(tracker.getJobIdsForGroup(None))
    run()
    stages = {s for job in set(tracker.getJobIdsForGroup(None)) - before for s in tracker.getJobInfo(job).stageIds}
    done = [store.lastStageAttempt(s) for s in stages]
    return [(s.inputBytes() > 0, s.numTasks()) for s in done if s.status().toString() == "COMPLETE"]


def test_store_query_reads_files_in_few_stages(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    start = time.perf_counter()
    frame = REGISTRY["feature_store"](spark, FOLDER)
    built = time.perf_counter() - start
    stages = executed(spark, lambda: frame.write.format("noop").mode("overwrite").save())
    reading = sum(reads for reads, _ in stages)
    print(f"built in {built:.1f} s, {len(stages)} stages, {reading} read files")
    assert reading <= 35


@pytest.fixture
def no_broadcast(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def test_store_by_joins_reads_each_group_from_its_table(spark, no_broadcast):
    """Groups are built when their tables are written; what follows reads bucketed tables and joins them as they lie."""
    frame = REGISTRY["store_left_joins"](spark, FOLDER)
    assert all("/store" not in f and FOLDER not in f for f in frame.inputFiles())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    joins = plan.count("SortMergeJoin")
    print(plan.count("Exchange hashpartitioning"), joins)
    assert joins >= 14
    # the spines and the join of the two sides; no exchange below a join of a group's table
    assert plan.count("Exchange hashpartitioning") <= 4


def test_defaults_of_a_group_come_from_one_aggregate(spark):
    sides = store.raw_sides(_raw_sides(StarSource(spark, FOLDER)))
    constants, queries = store.side_defaults(sides)
    assert queries and not set(constants) & set(queries)
    for _, column in queries.items():
        assert "struct(" in str(column)


def test_groups_of_the_store_read_their_months_written_once(spark):
    """No group parses all events again, or shuffles lines of orders outside its months."""
    frames = [frame for raw, dropped in _raw_sides(StarSource(spark, FOLDER)) for frame in [*raw.values(), dropped]]
    files = {f.split(FOLDER)[1] for frame in frames for f in frame.inputFiles() if FOLDER in f}
    assert files <= {"/customer.parquet", "/orders.parquet", "/part.parquet"}


def test_written_months_hold_what_the_tables_hold(spark, tmp_path):
    orders = (ORDERS_MONTH - 1, ORDERS_MONTH)
    plain = StarSource(spark, FOLDER)
    ready = plain.prepared(str(tmp_path), EVENTS_SPAN, orders)
    for table in SOURCE_COLUMNS:
        first, last = EVENTS_SPAN if table in EVENT_TABLES else orders
        for span in ((first, last), (last, last), (first - 1, last), (None, None)):
            ours, theirs = ready.scan_months(table, *span), plain.scan_months(table, *span)
            assert ours.columns == theirs.columns
            assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty(), (table, span)
