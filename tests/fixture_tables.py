"""Random source tables full of edge cases, for Spark and, as the same rows, for DuckDB.

Every table has a hot key with about a third of the rows, missing keys, exact copies,
rows two months back, dates on days 19 and 20 of the Persian month, and missing values.
"""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import types as T

from moontally.functions.calendar import month_index_of, month_start
from moontally.sources.star import EVENTS_MONTH, ORDERS_MONTH

KEYS = ["k1", "k2", "k3", "k4", "k5", "dropped"]
DROPPED = "dropped"
DUCK_TYPES = {
    T.StringType(): "VARCHAR", T.LongType(): "BIGINT", T.IntegerType(): "INTEGER", T.DoubleType(): "DOUBLE",
    T.DateType(): "DATE", T.TimestampNTZType(): "TIMESTAMP",
}
S, L, I, D, DATE, TS = (
    T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.DateType(), T.TimestampNTZType(),
)


class Random:
    def __init__(self, seed: int, month: int):
        self.r, self.month = random.Random(seed), month

    def key(self):
        return self.r.choice([None, "k1", "k1", "k1", *KEYS])

    def day(self) -> dt.date:
        """Mostly the last two months, their first and last days often; sometimes before."""
        starts = [month_start(self.month - 2), month_start(self.month - 1), month_start(self.month)]
        end = month_start(self.month + 1)
        edge = [*starts, end - dt.timedelta(days=1), *[s - dt.timedelta(days=1) for s in starts[1:]]]
        if self.r.random() < 0.3:
            return self.r.choice(edge)
        return starts[1] + dt.timedelta(days=self.r.randrange((end - starts[1]).days))

    def moment(self, day: dt.date) -> dt.datetime:
        hour = self.r.choice([0, 15, 15, 16, 23])
        return dt.datetime(day.year, day.month, day.day, hour, self.r.choice([0, 30]))

    def pick(self, *values):
        return self.r.choice(values)

    def money(self, *extra):
        return self.r.choice([round(self.r.uniform(0, 100), 2), *extra])


def _unique(rows: list[dict], key: str) -> list[dict]:
    """One row per key and date, for tables whose first and last row matter."""
    seen: dict = {}
    for row in rows:
        seen.setdefault((row[key], row["date"]), row)
    return list(seen.values())


def cdr(r: Random, day):
    return dict(
        bib_id=r.key(), date=day, sms_count=r.pick(0, 0, 1, 2, None), voice_count=r.pick(0, 1, 5),
        call_duration=r.money(0.0, None), gprs_usage=r.money(0.0, 0.0), voice_session_cost=r.pick(0.0, 1.5),
    )


def recharge(r: Random, day):
    before = r.money(0.0, None)
    amount = r.money(0.0, 0.0)
    return dict(
        bib_id=r.key(), date=day, amount=amount, recharge_dt=r.moment(day), origin_host_nm=r.pick("a", "b"),
        before_amt=before, after_amt=None if before is None else before + amount,
    )


def purchase(r: Random, day):
    services = ("Recharge Money", "DATA_BOLTON", "Pay Bill", "TDD_BOLTON", "GAMES", "MUSIC", None)
    return dict(
        fake_msisdn=r.key(), date=day, service_type=r.pick(*services), cnt=r.pick(0, 1, 2, 3, None),
        amount=r.money(0.0, None), source_system_cd=r.pick("BUNDLE_PURCHASE", "DIRECT_PURCHASE", "OTHER", None),
    )


def bank(r: Random, day):
    names = (
        "Bank Mellat", "bank-mellat", "V.Mellat", " v.sina", "Tejarat & Refah", "no match", "MELLI 24", "Sina", None
    )
    return dict(fake_msisdn=r.key(), date=day, bank_name=r.pick(*names), sms_cnt=r.pick(0, 1, 2, 2, 3, None))


def travel(r: Random, day):
    return dict(fake_msisdn=r.key(), date=day, sum_travel=r.pick(0, 0, 0, 1, None))


def handset(r: Random, day):
    brand = r.pick("SAMSUNG", "XIAOMI", "samsung", "APPLE", "Other", "Nokia", None)
    return dict(
        fake_msisdn=r.key(), date=day, handset_model=r.pick("m1", "m2", None), handset_brand=brand,
        cnt_of_days=r.pick(1, 15, 31, 0, None), month_id=r.pick("1", "2"),
    )


def arpu(r: Random, day):
    sites = ("Airport", "USO", "Road", "Village", "Main City", "Desert", None)
    return dict(
        fake_msisdn=r.key(), date=day, contract_type=r.pick("N", "P", "N", None), gender=r.pick("F", "M", None),
        age=r.pick(20, 44, None), site_type=r.pick(*sites), res_com_score=r.money(0.0, None),
        voice_revenue=r.money(0.0, None), gprs_revenue=r.pick(0.0, None), sms_revenue=r.money(0.0),
        subscription_revenue=r.money(0.0),
    )


def loan(r: Random, day):
    return dict(
        bib_id=r.key(), date=day, loan_id=r.r.randrange(60), loan_amount=r.pick(100, 200, 300), dt_sec=r.moment(day)
    )


def recovery(r: Random, day):
    return dict(bib_id=r.key(), date=day, loan_id=r.r.randrange(60), hsdp_recovery=r.pick(50.0, 100.0, 200.0), paid_at=r.moment(day))


def package(r: Random, day):
    names = ("5 GB", "500mb", "1.5gb", "gb free", "weekly", "2 GB + 100 MB", "Night 10 mb", None)
    start = r.moment(day)
    return dict(
        bib_id=r.key(), date=day, offering_code=r.pick("a 1", "a1", "b", None), offer_amount=r.money(0.0, None),
        offering_name=r.pick(*names), a_date=start, de_a_date=start + dt.timedelta(hours=r.pick(0, 24, 720)),
    )


def user_info(r: Random, day):
    statuses = ("ACTIVE", "ERASED", "HARD", "OTHER", "READY TO ACTIVATE SOFT", "READY TO ACTIVE", "SOFT", "x", None)
    return dict(
        bib_id=r.key(), date=day, contract_type_v=r.pick("N", "P", "?", None),
        registration_date=r.pick(dt.date(1990, 5, 1), dt.date(1996, 1, 1), None), ability_status=r.pick(*statuses),
        account_balance=r.money(-5.0, None),
    )


def post_paid(r: Random, day):
    paid = r.pick(day, day - dt.timedelta(days=90), day - dt.timedelta(days=91), None)
    return dict(
        fake_msisdn=r.key(), date=day, credit_limit=r.money(0.0, None), deposit_amt_n=r.money(0.0, None),
        outstanding_balance=r.money(-7.0, None), unbilled_amount=r.money(0.0, 0.0, None),
        last_status=r.pick("Hard", "Soft", "Active", None), last_payment_date=paid, suspension_flag=r.pick("Y", None),
    )


def credit(r: Random, day):
    due = day - dt.timedelta(days=r.pick(-10, 0, 1, 31, 32, 59, 60, 62, 63))
    return dict(
        fake_msisdn=r.key(), date=day, credit_assigned_date=r.pick(dt.date(2024, 12, 16), dt.date(2024, 12, 17)),
        loan_status=r.pick(1, 2, 3), installment_id=r.r.randrange(25), due=due, days_delayed=r.pick(-3, 0, 5, 40, None, None),
    )


# View name -> (row maker, month, key, types of the columns beside key and date, unique dates).
TABLES = {
    "cdr": (cdr, EVENTS_MONTH, "bib_id", dict(sms_count=L, voice_count=L, call_duration=D, gprs_usage=D, voice_session_cost=D), False),
    "recharge": (recharge, EVENTS_MONTH, "bib_id", dict(amount=D, recharge_dt=TS, origin_host_nm=S, before_amt=D, after_amt=D), False),
    "purchase": (purchase, EVENTS_MONTH, "fake_msisdn", dict(service_type=S, cnt=L, amount=D, source_system_cd=S), False),
    "bank": (bank, EVENTS_MONTH, "fake_msisdn", dict(bank_name=S, sms_cnt=L), False),
    "travel": (travel, EVENTS_MONTH, "fake_msisdn", dict(sum_travel=L), False),
    "handset": (handset, EVENTS_MONTH, "fake_msisdn", dict(handset_model=S, handset_brand=S, cnt_of_days=L, month_id=S), False),
    "arpu": (arpu, EVENTS_MONTH, "fake_msisdn", dict(contract_type=S, gender=S, age=I, site_type=S, res_com_score=D, voice_revenue=D, gprs_revenue=D, sms_revenue=D, subscription_revenue=D), True),
    "loan": (loan, ORDERS_MONTH, "bib_id", dict(loan_id=L, loan_amount=I, dt_sec=TS), False),
    "recovery": (recovery, ORDERS_MONTH, "bib_id", dict(loan_id=L, hsdp_recovery=D, paid_at=TS), False),
    "package": (package, ORDERS_MONTH, "bib_id", dict(offering_code=S, offer_amount=D, offering_name=S, a_date=TS, de_a_date=TS), False),
    "user_info": (user_info, ORDERS_MONTH, "bib_id", dict(contract_type_v=S, registration_date=DATE, ability_status=S, account_balance=D), False),
    "post_paid": (post_paid, ORDERS_MONTH, "fake_msisdn", dict(credit_limit=D, deposit_amt_n=D, outstanding_balance=D, unbilled_amount=D, last_status=S, last_payment_date=DATE, suspension_flag=S), True),
    "credit": (credit, ORDERS_MONTH, "fake_msisdn", dict(credit_assigned_date=DATE, loan_status=I, installment_id=L, due=DATE, days_delayed=I), False),
}


def make_rows(view: str, seed: int, size: int) -> list[dict]:
    make, month, key, _, unique = TABLES[view]
    r = Random(seed, month)
    rows = [make(r, r.day()) for _ in range(size)]
    rows += [dict(r.pick(*rows)) for _ in range(size // 10)]  # exact copies
    return _unique(rows, key) if unique else rows


def schema(view: str) -> T.StructType:
    _, _, key, types, _ = TABLES[view]
    return T.StructType([T.StructField(n, t) for n, t in {key: S, "date": DATE, **types}.items()])


def load_duck(db, view: str, rows: list[dict]) -> str:
    """A table ``fx_<view>`` and the SELECT that stands for the view."""
    _, month, key, _, _ = TABLES[view]
    fields = schema(view).fields
    columns = ", ".join(f"{f.name} {DUCK_TYPES[f.dataType]}" for f in fields)
    db.execute(f"CREATE OR REPLACE TABLE fx_{view} ({columns}, mi INTEGER)")
    values = [[*[row[f.name] for f in fields], month_index_of(row["date"])] for row in rows]
    db.executemany(f"INSERT INTO fx_{view} VALUES ({', '.join('?' * (len(fields) + 1))})", values)
    return f"SELECT * FROM fx_{view} WHERE {key} IS NOT NULL AND mi BETWEEN {month - 1} AND {month}"


# Source table -> (view, SQL expression per source column that is not a view column).
DAY = "date_format(date, 'yyyyMMdd') AS date_key"


def _moment(column: str, name: str) -> str:
    return f"date_format({column}, 'yyyyMMdd HH:mm:ss') AS {name}"


SOURCES = {
    "cdr": ("cdr", ["*", DAY]),
    "recharge": ("recharge", ["bib_id", "amount AS recharge_value_amt", _moment("recharge_dt", "recharge_dt"), "origin_host_nm", "before_amt AS account_balance_before_amt", "after_amt AS account_balance_after_amt", DAY]),
    "package_purchase": ("purchase", ["*", DAY]),
    "customer_person_type_bank_info": ("bank", ["*", DAY]),
    "domestic_travel": ("travel", ["*", DAY]),
    "handset_price": ("handset", ["*", "'smart' AS handset_type", DAY]),
    "arpu": ("arpu", ["*", "'1' AS registration_date", "'m' AS modem_model", "'t' AS flag_sim_tier", DAY]),
    "loan_assign": ("loan", ["bib_id", "cast(loan_id AS string) AS loan_id", "cast(loan_amount AS string) AS loan_amount", _moment("dt_sec", "date_timestamp"), DAY]),
    "loan_recovery": ("recovery", ["bib_id", "cast(loan_id AS string) AS loan_id", "'1' AS loan_amount", "hsdp_recovery", _moment("paid_at", "date_timestamp"), DAY]),
    "package": ("package", ["bib_id", "offering_code", "offer_amount", "offering_name", _moment("a_date", "activation_date"), _moment("de_a_date", "deactivation_date"), DAY]),
    "user_info": ("user_info", ["bib_id", "contract_type_v", "'' AS gender_v", "date_format(registration_date, 'yyyyMMdd') AS registration_date_d", "'' AS date_of_birth_d", "ability_status", "account_balance", "'' AS base_station_cd", "'' AS siteid", DAY]),
    "post_paid": ("post_paid", ["*", "0.0D AS avl_credit_limit", "'1' AS month_id", DAY]),
    "credit_management": ("credit", ["*", "1.0D AS credit_amount", "1L AS loan_id", "1.0D AS loan_amount", "1.0D AS installment_amount", "due AS installment_duedate", DAY]),
}


class FixtureSource:
    """Hands out whole fixture tables whatever months are asked for: readers must filter."""

    def __init__(self, spark, rows: dict[str, list[dict]]):
        self.spark, self.rows = spark, rows

    def scan_months(self, table: str, first: int, last: int):
        view, columns = SOURCES[table]
        tuples = [tuple(row[n] for n in schema(view).names) for row in self.rows[view]]
        base = self.spark.createDataFrame(tuples, schema(view))
        return base.selectExpr(*columns).select(*_source_columns(table))


def _source_columns(table: str):
    from moontally.sources.catalog import SOURCE_COLUMNS

    return SOURCE_COLUMNS[table]
