"""The shape of the physical plans."""

import re

import pytest

from moontally.plans.groups import GROUPS, cdr
from moontally.plans.pipeline import raw_features
from moontally.registry import REGISTRY, job_for
from moontally.sources.snapshots import SnapshotSource
from moontally.sources.star import StarSource

FOLDER = "/root/testdata/sf0.001"
WRITERS = {"scan_months", "scan_droplist", "sink_parquet_features", "sink_table_append", "sink_writer_cap"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - WRITERS))
def test_no_python_no_product_no_hint(spark, name):
    df = REGISTRY[name](spark, FOLDER)
    text = plan(df)
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|BroadcastNestedLoop", text)
    assert "SinglePartition" not in text or name in {
        "agg_global_max", "const_overwrite", "fill_query", "fg_arpu", "fg_postpaid", "fg_credit_management",
        "id_spine", "feature_store", "store_coalesce", "store_left_joins",
    }, "only scalar aggregates may end in one partition"
    for line in text.splitlines():
        if re.search(r"- Window \[", line):
            assert not re.search(r"\], \[\], \[", line), f"a window over one partition: {line[:200]}"
    assert "hint" not in df._jdf.queryExecution().logical().toString().lower()


def test_snapshot_scan_prunes_columns_and_skips_by_date(spark, tmp_path):
    star = StarSource(spark, FOLDER)
    source = SnapshotSource(spark, str(tmp_path))
    job = job_for("CDR")
    for month in range(job.target - 1, job.target + 1):
        star.scan_months("cdr", month, month).write.parquet(source.path("cdr", month))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        text = plan(raw_features(cdr.GROUP, source, job))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "IsNotNull(bib_id)" in pushed
    assert "GreaterThanOrEqual(date_key" in pushed and "LessThan(date_key" in pushed


def test_postpaid_limits_rows_before_the_shuffle(spark):
    text = plan(raw_features(GROUPS["PostPaid"], StarSource(spark, FOLDER), job_for("PostPaid")))
    partial = text.index("row_number(), 2, Partial")
    assert text.rindex("Exchange hashpartitioning", 0, partial) > 0


def test_drop_list_is_no_early_shuffle_join(spark):
    """A list too large to broadcast is joined to the one-row-per-key frame."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(REGISTRY["fg_recharge"](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = text.index("LeftAnti")
    assert "max(recharge_value_amt" in text[join:]
