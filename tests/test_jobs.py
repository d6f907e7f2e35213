"""Drop list, store and the three programs end to end, over written snapshots."""

import glob

import pytest
from pyspark.sql import functions as F

from check import sorted_rows
from fixture_tables import SOURCES, FixtureSource, make_rows
from moontally.functions.calendar import month_index_of, month_start
from moontally.plans import droplist, jobs, store
from moontally.plans.contracts import ContractError, group_contract
from moontally.plans.groups import GROUPS
from moontally.plans.spec import FeatureJob
from moontally.registry import EVENT_GROUPS
from moontally.sources.sinks import read_feature_table, sink_table_append, sink_writer_cap
from moontally.sources.snapshots import SchemaDriftError, SnapshotSource, at_source_schema, read_table
from moontally.sources.catalog import SOURCE_COLUMNS
from moontally.sources.star import EVENTS_MONTH, ORDERS_MONTH, StarSource


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "key string, owner string")


def values(df):
    return sorted(tuple(r) for r in df.collect())


def test_drop_list_by_hand(spark):
    current = pairs(spark, ("s1", "o1"), ("s1", "o2"), ("s2", "o3"), ("s3", "o4"), ("s3", "o4"), (None, "o9"), ("s9", None))
    previous = pairs(
        spark,
        ("s1", "o1"), ("s7", "o2"), ("s7", "o2"),  # owners that share a key now
        ("s4", "gone"), ("s4", "o3"),  # a key shared before, one of its owners gone now
        ("s5", "gone2"), ("s6", "o4"),
    )
    assert values(droplist.changed_now(current, previous)) == [("s1", "o1"), ("s7", "o2")]
    assert values(droplist.changed_before(current, previous)) == [("s4", "gone")]
    assert values(droplist.drop_list(current, previous)) == [("s1", "o1"), ("s4", "gone"), ("s7", "o2")]


def test_drop_list_of_hot_keys_and_owners_equals_sql(spark):
    """A key with a third of all rows and an owner with another third, repeated rows among them."""
    import duckdb

    def month(seed):
        n = lambda below, salt: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(below))
        key = F.when(n(3, 1) == 0, "hot").otherwise(F.concat(F.lit("k"), n(300, 2)))
        owner = F.when(n(3, 3) == 0, "hot").otherwise(F.concat(F.lit("o"), n(200 + 100 * seed, 4)))
        return spark.range(1500).select(key.alias("key"), F.when(n(50, 5) > 0, owner).alias("owner"))

    current, previous = month(1), month(2)
    db = duckdb.connect()
    cur, prev = (df.toPandas() for df in (current, previous))  # noqa: F841
    db.execute("CREATE VIEW c AS SELECT * FROM cur WHERE owner IS NOT NULL; CREATE VIEW p AS SELECT * FROM prev WHERE owner IS NOT NULL")
    several = "key IN (SELECT key FROM {0} GROUP BY key HAVING count(DISTINCT owner) > 1)"
    now = f"SELECT DISTINCT * FROM p WHERE owner IN (SELECT owner FROM c WHERE {several.format('c')})"
    before = f"SELECT DISTINCT * FROM p WHERE {several.format('p')} AND owner NOT IN (SELECT owner FROM c)"
    for ours, sql in ((droplist.changed_now, now), (droplist.changed_before, before), (droplist.drop_list, f"{now} UNION {before}")):
        assert values(ours(current, previous)) == sorted(db.execute(sql).fetchall())


def test_months_of_different_schema(spark, tmp_path):
    source = SnapshotSource(spark, str(tmp_path))
    days = [f"{month_start(m):%Y%m%d}" for m in (EVENTS_MONTH - 1, EVENTS_MONTH)]
    early = spark.createDataFrame([("a", 1, 0.5, days[0], "x")], "bib_id string, sms_count int, call_duration float, date_key string, note string")
    late = spark.createDataFrame([(7, 2, 3, 1.5, days[1], 9)], "BIB_ID long, sms_count long, voice_count long, call_duration double, date_key string, note int")
    for month, frame in ((EVENTS_MONTH - 1, early), (EVENTS_MONTH, late)):
        frame.write.parquet(source.path("cdr", month))
    both = read_table(source, "cdr", EVENTS_MONTH - 1, EVENTS_MONTH)
    picked = both.select("bib_id", "sms_count", "voice_count", "call_duration", "gprs_usage", "month_index")
    assert [t for _, t in picked.dtypes] == ["string", "bigint", "bigint", "double", "double", "int"]
    assert sorted(map(tuple, picked.collect()), key=repr) == [
        ("7", 2, 3, 1.5, None, EVENTS_MONTH), ("a", 1, None, 0.5, None, EVENTS_MONTH - 1),
    ]
    assert "note" not in source.scan_months("cdr", EVENTS_MONTH - 1, EVENTS_MONTH).columns
    assert "note" in source.scan_months("cdr", EVENTS_MONTH, EVENTS_MONTH).columns
    late.drop("date_key").withColumn("sms_count", F.lit("many")).write.parquet(source.path("cdr", EVENTS_MONTH + 1))
    with pytest.raises(SchemaDriftError, match=f"{EVENTS_MONTH + 1}.*sms_count is string, declared bigint.*date_key is missing"):
        source.scan_months("cdr", EVENTS_MONTH, EVENTS_MONTH + 1)


def test_source_schemas_are_those_of_the_tables_read(spark):
    star = StarSource(spark, "/root/testdata/sf0.001")
    for table in SOURCE_COLUMNS:
        at_source_schema(star.scan_all(table), table, table)


def test_ownership_takes_the_shared_key(spark):
    a = spark.createDataFrame([("1", "2", "3")], "fake_msisdn string, bib_id string, fake_ic_number string")
    b = spark.createDataFrame([("4", "5")], "bib_id string, fake_ic_number string")
    now, before = droplist.ownership(a, b)
    assert (values(now), values(before)) == ([("2", "3")], [("4", "5")])
    with pytest.raises(ValueError):
        droplist.ownership(a, b.drop("bib_id"))


def test_contracts_cover_the_store():
    contract = store.store_contract()
    assert len(contract.fields) == 264
    assert len(set(contract.names)) == 264
    widths = {name: len(group_contract(g, FeatureJob((1,))).fields) - 1 for name, g in GROUPS.items()}
    assert widths == {
        "CDR": 40, "Recharge": 18, "CreditManagement": 14, "UserInfo": 10, "DomesticTravel": 14, "LoanRec": 2,
        "LoanAssign": 14, "PackagePurchaseExtras": 22, "PackagePurchase": 28, "PostPaid": 15, "BankInfo": 10,
        "HandsetPrice": 32, "Package": 18, "Arpu": 27,
    }


def test_sink_is_idempotent_per_month_and_capped(spark, tmp_path):
    group = GROUPS["LoanRec"]
    contract = group_contract(group, FeatureJob((7,)))
    frame = spark.createDataFrame([(str(i), None, float(i)) for i in range(100)], contract).repartition(8)
    path = str(tmp_path / "t")
    for month, mode in ((6, "append"), (7, "append"), (7, "overwrite")):
        sink_table_append(frame, path, contract, month, mode=mode, cap=3)
    assert read_feature_table(spark, path, contract, 7).count() == 100
    assert read_feature_table(spark, path, contract, 6).count() == 100
    assert len(glob.glob(f"{path}/month_index=7/*.parquet")) <= 3
    sink_table_append(frame, path, contract, 7)
    assert read_feature_table(spark, path, contract, 7).count() == 200
    assert sink_writer_cap(frame, 0).rdd.getNumPartitions() == 8
    assert sink_writer_cap(frame, 20).rdd.getNumPartitions() <= 8
    assert sink_writer_cap(frame, 3).rdd.getNumPartitions() <= 3


def test_sink_takes_other_formats_and_only_declared_columns(spark, tmp_path):
    contract = group_contract(GROUPS["LoanRec"], FeatureJob((7,)))
    frame = spark.createDataFrame([("a", 1.0, 2.0)], contract)
    options = {"path": str(tmp_path / "t")}
    sink_table_append(frame, None, contract, 7, fmt="json", options=options)
    sink_table_append(frame, None, contract, 7, fmt="json", options=options)
    assert spark.read.json(options["path"]).count() == 2
    with pytest.raises(ContractError):
        sink_table_append(frame.drop("mean_time_to_repay_1"), None, contract, 7, fmt="json", options=options)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Snapshots of all tables, then drop list and feature tables through the jobs."""
    base = tmp_path_factory.mktemp("run")
    layout = jobs.Layout(f"{base}/in", f"{base}/drops", f"{base}/out", writer_cap=4)
    fixture = FixtureSource(spark, {view: make_rows(view, 5, 80) for view, _ in SOURCES.values()})
    for side, month in ((True, EVENTS_MONTH), (False, ORDERS_MONTH)):
        tables = {GROUPS[n].table for n in GROUPS if (n in EVENT_GROUPS) == side} | (set() if side else {"loan_assign"})
        for table in tables:
            rows = fixture.scan_months(table, 0, 0).collect()
            frame = fixture.scan_months(table, 0, 0)
            for m in (month - 1, month):
                kept = [r for r in rows if month_index_of(f"{r.date_key[:4]}-{r.date_key[4:6]}-{r.date_key[6:]}") == m]
                spark.createDataFrame(kept, frame.schema).coalesce(1).write.parquet(f"{base}/in/{m}/{table}")
        for m in (month - 1, month):
            owners = [("k2", "o1"), ("k2", "o2")] if m == month else [("k2", "o1"), ("k3", "o3")]
            spark.createDataFrame(owners, "bib_id string, fake_ic_number string").write.parquet(f"{base}/in/{m}/owners")
        jobs.run_drop_list(spark, layout, month_start(month), "owners")
    return layout, {
        name: jobs.run_features(spark, layout, month_start(EVENTS_MONTH if name in EVENT_GROUPS else ORDERS_MONTH), name)
        for name in GROUPS
    }


def test_feature_jobs_write_every_group_without_dropped_keys(built):
    _, tables = built
    for name, table in tables.items():
        keys = [r[0] for r in table.select(GROUPS[name].key).collect()]
        assert keys and len(keys) == len(set(keys))
        assert "k2" not in keys and None not in keys


def test_store_one_row_per_id_both_ways(built):
    _, tables = built
    wide, joined = store.wide_by_grouping(tables), store.wide_by_joins(tables)
    assert wide.columns == joined.columns == store.store_contract().names
    ours, theirs = (sorted_rows(df.columns, [tuple(r) for r in df.collect()]) for df in (wide, joined))
    assert ours == theirs
    ids = {r[0] for name, t in tables.items() for r in t.select(GROUPS[name].key).collect()}
    assert len(ours) == len(ids)


def test_store_job_is_idempotent_and_filled(spark, built):
    layout, _ = built
    names = [n for n in GROUPS if n in EVENT_GROUPS]
    first = jobs.run_feature_store(spark, layout, EVENTS_MONTH, names)
    rows = first.count()
    again = jobs.run_feature_store(spark, layout, EVENTS_MONTH, names)
    assert again.count() == rows == again.select("bib_id").distinct().count()
    assert not any(value is None for row in again.collect() for value in row)
