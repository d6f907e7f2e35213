"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry
from check import compare, database
from moontally.registry import REGISTRY
from oracle.queries import ORACLE

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(FOLDER)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_equals_sql(spark, db, name):
    verdict = compare(spark, db, FOLDER, name)
    assert verdict.startswith("ok") and "types" not in verdict, verdict


def test_entry(spark):
    assert entry(spark).count() > 0
