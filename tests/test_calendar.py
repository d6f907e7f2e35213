import datetime as dt

import pytest
from pyspark.sql import functions as F

from moontally.functions.calendar import month_index, month_index_of, month_span, month_start, parse_date_key, parse_ts

# First days of Persian years and days around a month's 20th, from published calendars.
ANCHORS = {
    "2020-03-20": 12 * 1399 + 1,
    "2021-03-20": 12 * 1399 + 12 + 1,
    "2021-03-21": 12 * 1400 + 1,
    "2024-03-20": 12 * 1403 + 1,
    "2025-03-20": 12 * 1403 + 12 + 1,
    "2025-03-21": 12 * 1404 + 1,
    "2024-09-09": 16842,
    "2024-09-10": 16843,
}


@pytest.mark.parametrize("day, index", ANCHORS.items())
def test_anchors(day, index):
    assert month_index_of(day) == index


def test_column_equals_driver_function_on_every_day(spark):
    first, days = dt.date(1990, 1, 1), 18262
    frame = spark.range(days).select(F.date_add(F.lit(first), F.col("id").cast("int")).alias("day"))
    rows = frame.select("day", month_index(F.col("day")).alias("i")).orderBy("day").collect()
    assert all(row.i == month_index_of(row.day) for row in rows)
    steps = [b.i - a.i for a, b in zip(rows, rows[1:])]
    assert set(steps) == {0, 1}


def test_month_start_is_the_first_day():
    for index in range(16400, 16900):
        start = month_start(index)
        assert month_index_of(start) == index
        assert month_index_of(start - dt.timedelta(days=1)) == index - 1
        assert 29 <= (month_start(index + 1) - start).days <= 31


def test_span_is_half_open():
    start, end = month_span(16834, 16835)
    assert (month_index_of(start), month_index_of(end)) == (16834, 16836)


def test_unreadable_dates_become_null(spark):
    frame = spark.createDataFrame([("20240131", "20240131 23:59:01"), ("2024-01-31", "x"), (None, None)], "d string, t string")
    rows = frame.select(
        parse_date_key(F.col("d")).alias("d"), parse_ts(F.col("t")).alias("t"), month_index(parse_date_key(F.col("d"))).alias("i")
    ).collect()
    assert rows[0] == (dt.date(2024, 1, 31), dt.datetime(2024, 1, 31, 23, 59, 1), 16835)
    assert rows[1] == rows[2] == (None, None, None)
