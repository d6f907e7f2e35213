"""Every feature group on random edge-case tables: against naive SQL, and against itself by range."""

import duckdb
import pytest

from check import sorted_rows
from fixture_tables import DROPPED, SOURCES, TABLES, FixtureSource, load_duck, make_rows
from moontally.plans.groups import GROUPS
from moontally.plans.pipeline import build_features, raw_features, raw_features_by_range
from moontally.plans.spec import FeatureJob
from moontally.registry import job_for
from oracle.groups import GROUPS as SQL_GROUPS

SIZE = 150


def tables_of(name: str) -> list[str]:
    tables = ["loan_assign", "loan_recovery"] if name == "LoanRec" else [GROUPS[name].table]
    return [SOURCES[t][0] for t in tables]


def fixture(name: str, seed: int) -> dict[str, list[dict]]:
    return {view: make_rows(view, seed, SIZE) for view in tables_of(name)}


def drop_list(spark):
    return spark.createDataFrame([(DROPPED,), ("nobody",)], "key string")


def expected(name: str, rows: dict[str, list[dict]]):
    db = duckdb.connect()
    instead = {view: load_duck(db, view, data) for view, data in rows.items()}
    if "recovery" in rows:  # recoveries are not cut by date
        instead["recovery"] = "SELECT * FROM fx_recovery WHERE bib_id IS NOT NULL"
    for owners in ("user_owner", "customer_owner"):
        instead[f"{owners}_drop"] = f"SELECT '{DROPPED}' AS \"key\", 'o' AS owner"
    result = db.execute(SQL_GROUPS[name].sql(instead))
    columns = [d[0] for d in result.description]
    return columns, sorted_rows(columns, result.fetchall())


def close(ours: list[tuple], theirs: list[tuple]) -> bool:
    return len(ours) == len(theirs) and all(
        a == b or (isinstance(a, float) and isinstance(b, float) and abs(a - b) <= 2e-6 * max(1, abs(a)))
        for left, right in zip(ours, theirs)
        for a, b in zip(left, right)
    )


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("name", list(GROUPS))
def test_group_equals_naive_sql(spark, name, seed):
    rows = fixture(name, seed)
    frame = build_features(GROUPS[name], FixtureSource(spark, rows), job_for(name), drop_list(spark))
    ours = sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    columns, theirs = expected(name, rows)
    assert sorted(columns) == sorted(frame.columns)
    assert ours, "the fixture must produce rows"
    names = sorted(columns)
    differing = [
        [(n, a, b) for n, a, b in zip(names, left, right) if a != b] for left, right in zip(ours, theirs) if left != right
    ]
    assert close(ours, theirs), differing[:3]


@pytest.mark.parametrize("name", [n for n in GROUPS if len(GROUPS[n].ranges) > 1])
def test_one_pass_equals_ranges_joined(spark, name):
    group, source, job = GROUPS[name], FixtureSource(spark, fixture(name, 3)), job_for(name)
    one = raw_features(group, source, job)
    joined = raw_features_by_range(group, source, job)
    assert set(one.columns) == set(joined.columns)
    order = sorted(one.columns)
    quoted = [f"`{c}`" for c in order]
    assert close(
        sorted_rows(order, [tuple(r) for r in one.select(*quoted).collect()]),
        sorted_rows(order, [tuple(r) for r in joined.select(*quoted).collect()]),
    )


@pytest.mark.parametrize("name", list(GROUPS))
def test_two_targets_equal_two_runs(spark, name):
    """Each target as if it were alone, also where formulas see more than their window."""
    group, source, job = GROUPS[name], FixtureSource(spark, fixture(name, 4)), job_for(name)
    targets = (job.target - 1, job.target)
    both = raw_features(group, source, FeatureJob(targets, as_of=job.as_of))
    for target in targets:
        alone = raw_features(group, source, FeatureJob((target,), as_of=job.as_of))
        names = [c for c in alone.columns if c != group.key]
        seen = [f"`{target}_{c}`" for c in names]
        order = [group.key, *names]
        ours = both.where(" OR ".join(f"{c} IS NOT NULL" for c in seen)).select(group.key, *seen)
        theirs = alone.select(group.key, *[f"`{c}`" for c in names])
        assert close(
            sorted_rows(order, [tuple(r) for r in ours.collect()]), sorted_rows(order, [tuple(r) for r in theirs.collect()])
        )


@pytest.mark.parametrize("name", ["CDR", "Recharge", "PackagePurchase", "HandsetPrice", "Package", "BankInfo", "DomesticTravel"])
def test_other_window_lengths(spark, name):
    """Declared lengths other than the usual: three months hold what three single months hold."""
    counts = {
        "CDR": "sms_count", "Recharge": "sum_recharge", "PackagePurchase": "sum_service_cnt",
        "HandsetPrice": "total_usage_days", "Package": "count_packages", "BankInfo": "bank_active_days_count",
        "DomesticTravel": "unique_travel_days",
    }
    feature, group, source = counts[name], GROUPS[name], FixtureSource(spark, fixture(name, 6))
    month = job_for(name).target
    wide = raw_features(group.declare({feature: (1, 3)}), source, FeatureJob((month,)))
    assert wide.columns == [group.key, f"{feature}_1", f"{feature}_3"]
    monthly = {}
    for target in (month - 2, month - 1, month):
        single = raw_features(group.declare({feature: (1,)}), source, FeatureJob((target,)))
        for row in single.collect():
            monthly[row[0]] = monthly.get(row[0], 0) + (row[1] or 0)
    got = {row[0]: row[2] or 0 for row in wide.collect()}
    assert got == pytest.approx(monthly)
    with pytest.raises(ValueError):
        group.declare({"nothing": (1,)})


def test_fixtures_hold_the_edge_cases():
    for view, (_, _, key, _, unique) in TABLES.items():
        rows = make_rows(view, 1, SIZE)
        keys = [row[key] for row in rows]
        assert DROPPED in keys
        assert None in keys
        if not unique:
            assert keys.count("k1") > len(rows) / 5
            assert len({tuple(r.values()) for r in rows}) < len(rows)


def test_bank_messages_of_any_size_and_sign(spark):
    """Negative counts, and totals beyond 10 ** 11, give the values of the plain SQL."""
    rows = fixture("BankInfo", 5)
    for i, row in enumerate(rows["bank"]):
        row["sms_cnt"] = (-3, 10**12 + i, 0, None, 7)[i % 5]
    frame = build_features(GROUPS["BankInfo"], FixtureSource(spark, rows), job_for("BankInfo"), drop_list(spark))
    columns, theirs = expected("BankInfo", rows)
    ours = sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert sorted(columns) == sorted(frame.columns) and ours and close(ours, theirs)


def test_three_targets_that_are_not_neighbours(spark):
    group, source, job = GROUPS["PostPaid"], FixtureSource(spark, fixture("PostPaid", 7)), job_for("PostPaid")
    targets = (job.target, job.target - 2, job.target - 4)
    both = raw_features(group, source, FeatureJob(targets))
    assert both.columns == [group.key, *[name for _, _, name in group.columns(FeatureJob(targets))]]
    for target in targets:
        alone = raw_features(group, source, FeatureJob((target,)))
        seen = [f"{target}_{c}" for c in alone.columns[1:]]
        ours = both.select(group.key, *[f"`{c}`" for c in seen]).where(" OR ".join(f"`{c}` IS NOT NULL" for c in seen))
        assert sorted(map(repr, map(tuple, ours.collect()))) == sorted(map(repr, map(tuple, alone.collect())))
