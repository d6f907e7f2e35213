"""The source tables as views over the star-schema test tables.

``StarSource`` stands where :class:`SnapshotSource` stands: it gives the rows of a span of
billing months in the shape of the monthly snapshots (text keys, text dates), so queries
on the test tables run through the readers that production snapshots run through.  The
months are a filter on the base table's own timestamp, which the parquet scan skips by.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moontally.functions.calendar import month_span

EVENTS_MONTH = 16835  # 2024-01-10 .. 2024-01-30: events holds this month and the one before
ORDERS_MONTH = 16528  # the month of 1998-06-15
AS_OF = dt.date(1998, 6, 15)
CREDIT_SHIFT_DAYS = 9700  # moves credit lines of the order months around the scoring start

# Sender names by k mod 10; the last one is missing.
SENDERS = (
    "Bank Mellat", "TEJARAT-BANK", "V.Mellat", "bank.melli", "Pasargad!",
    "Shop 24", "Keshavarzi & Refah", "SINA", "Mellat Iz", None,
)
# Brands by (user_id + k) mod 7; the last one is missing.
BRANDS = ("SAMSUNG", "XIAOMI", "HUAWEI", "APPLE", "Other", "Nokia", None)
# Services of the source, by k mod 8; the last one depends on the event.
SERVICES = ("Recharge Money", "DATA_BOLTON", "EREFILL", "DATA_BUYABLE", "BillPayment", "Pay Bill", "TDD_BOLTON")
# Purchase systems of the source.
SYSTEMS = ("BUNDLE_PURCHASE", "DIRECT_PURCHASE", "INDIRECT_PURCHASE")
# Site types of the source, by k mod 16 of a day's largest k.
SITES = (
    "Airport", "Industrial Area", "Island", "Oil Platform", "Port", "Touristic Area", "USO", "University",
    "Road", "Village", "Small City", "Capital City", "Main City", "Middle City", "Desert", None,
)
# Account statuses of the source.
STATUSES = ("ACTIVE", "ERASED", "HARD", "OTHER", "READY TO ACTIVATE SOFT", "READY TO ACTIVE", "SOFT")
PACKAGE_UNITS = (" GB", "MB", "", " gb plus")


def _pick(values: tuple, position: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), position.cast("int"))


def _text(value: Column) -> Column:
    return value.cast("string")


def _day_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd")


def _moment_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd HH:mm:ss")


def _between(rows: DataFrame, column: str, first: int, last: int) -> DataFrame:
    start, end = month_span(first, last)
    as_timestamp = lambda day: F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
    return rows.where((F.col(column) >= as_timestamp(start)) & (F.col(column) < as_timestamp(end)))


class StarSource:
    """Snapshots derived from the parquet files of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._tables: dict[str, DataFrame] = {}
        self._ready: dict[str, tuple[tuple[int, int], DataFrame]] = {}

    def prepared(self, folder: str, events: tuple[int, int], orders: tuple[int, int]) -> StarSource:
        """The same source with the rows of these months written below ``folder``, once for all their readers.

        Events are parsed once. Lines are those of orders in the months, all of them: what else ``lineitem`` holds
        is met by one semi-join and not shuffled by every reader.
        """
        source = StarSource(self.spark, self.folder)
        source._ready["events"] = events, self._written(self.events(*events).drop("props"), f"{folder}/events")
        source._ready["orders"] = orders, self._written(self.orders(*orders), f"{folder}/orders")
        keys = source.orders(*orders).select(F.col("o_orderkey").alias("l_orderkey"))
        source._ready["lineitem"] = orders, self._written(self.base("lineitem").join(keys, "l_orderkey", "left_semi"), f"{folder}/lineitem")
        return source

    def _written(self, frame: DataFrame, path: str) -> DataFrame:
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def _ready_for(self, name: str, first: int | None, last: int | None) -> DataFrame | None:
        """The written rows of a table, if they hold all of these months."""
        (start, end), frame = self._ready.get(name, ((0, -1), None))
        return frame if first is not None and start <= first and last <= end else None

    def scan_months(self, table: str, first: int | None, last: int | None) -> DataFrame:
        return getattr(self, f"_{table}")(first, last)

    def scan_all(self, table: str) -> DataFrame:
        return getattr(self, f"_{table}")(None, None)

    def base(self, name: str) -> DataFrame:
        """A table of the folder; its schema is read once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._tables[name]

    def events(self, first: int | None, last: int | None) -> DataFrame:
        """Events with their number ``k`` and their day as text."""
        if (ready := self._ready_for("events", first, last)) is not None:
            return _between(ready, "ts", first, last)
        k = F.regexp_extract("props", r'"k": (\d+)', 1).cast("int")
        return self._dated("events", "ts", first, last).withColumns({"k": k, "day_text": _day_text(F.col("ts"))})

    def orders(self, first: int | None, last: int | None) -> DataFrame:
        """Orders with their date as text: formatted here, once per order and not per line."""
        if (ready := self._ready_for("orders", first, last)) is not None:
            return _between(ready, "o_orderdate", first, last)
        moment = F.col("o_orderdate")
        dated = self._dated("orders", "o_orderdate", first, last)
        return dated.withColumns({"day_text": _day_text(moment), "moment_text": _moment_text(moment)})

    def order_lines(self, first: int | None, last: int | None) -> DataFrame:
        return self.orders(first, last).join(self.lines(first, last), F.col("o_orderkey") == F.col("l_orderkey"))

    def lines(self, first: int | None, last: int | None) -> DataFrame:
        """All lines of orders in these months, and maybe others."""
        ready = self._ready_for("lineitem", first, last)
        return self.base("lineitem") if ready is None else ready

    def _dated(self, name: str, column: str, first: int | None, last: int | None) -> DataFrame:
        return self.base(name) if first is None else _between(self.base(name), column, first, last)

    # Views over events.

    def _cdr(self, first: int | None, last: int | None) -> DataFrame:
        """One record per user, day and half day; equal halves are equal rows."""
        kind, value = F.col("event_type"), F.col("value")
        count_of = lambda name: F.count(F.when(kind == name, 1))
        value_of = lambda name: F.round(F.sum(F.when(kind == name, value).otherwise(0.0)), 2)
        half = F.when(F.hour("ts") < 12, 0).otherwise(1)
        return (
            self.events(first, last)
            .groupBy(_text(F.col("user_id")).alias("bib_id"), F.col("day_text").alias("date_key"), half.alias("half"))
            .agg(
                count_of("click").alias("sms_count"),
                count_of("view").alias("voice_count"),
                value_of("view").alias("call_duration"),
                value_of("purchase").alias("gprs_usage"),
                value_of("error").alias("voice_session_cost"),
            )
            .drop("half")
        )

    def _recharge(self, first: int | None, last: int | None) -> DataFrame:
        amount = F.when(F.col("k") % 17 == 0, 0.0).otherwise(F.col("value"))
        before = F.col("k").cast("double")
        return self.events(first, last).where(F.col("event_type") == "purchase").select(
            _text(F.col("user_id")).alias("bib_id"),
            amount.alias("recharge_value_amt"),
            _moment_text(F.col("ts")).alias("recharge_dt"),
            F.concat(F.lit("h"), F.col("event_id") % 3).alias("origin_host_nm"),
            before.alias("account_balance_before_amt"),
            (before + amount).alias("account_balance_after_amt"),
            F.col("day_text").alias("date_key"),
        )

    def _package_purchase(self, first: int | None, last: int | None) -> DataFrame:
        other = F.when(F.col("event_type") != "error", F.concat(F.lit("GAME "), F.col("event_type")))
        service = F.coalesce(_pick(SERVICES, F.col("k") % 8), other)
        return self.events(first, last).select(
            _text(F.col("user_id")).alias("fake_msisdn"),
            service.alias("service_type"),
            (F.col("k") % 5).cast("bigint").alias("cnt"),
            F.col("value").alias("amount"),
            _pick(SYSTEMS, F.col("event_id") % 3).alias("source_system_cd"),
            F.col("day_text").alias("date_key"),
        )

    def _customer_person_type_bank_info(self, first: int | None, last: int | None) -> DataFrame:
        return self.events(first, last).select(
            _text(F.col("user_id")).alias("fake_msisdn"),
            _pick(SENDERS, F.col("k") % 10).alias("bank_name"),
            (1 + F.col("k") % 4).cast("bigint").alias("sms_cnt"),
            F.col("day_text").alias("date_key"),
        )

    def _domestic_travel(self, first: int | None, last: int | None) -> DataFrame:
        """Per user, day and kind: trips of the day, unknown where there were three or more."""
        trips = F.count(F.when(F.col("k") >= 80, 1))
        return (
            self.events(first, last)
            .where(F.col("event_type").isin("signup", "view"))
            .groupBy(_text(F.col("user_id")).alias("fake_msisdn"), F.col("day_text").alias("date_key"), "event_type")
            .agg(F.when(trips < 3, trips).alias("sum_travel"))
            .drop("event_type")
        )

    def _handset_price(self, first: int | None, last: int | None) -> DataFrame:
        brand = _pick(BRANDS, (F.col("user_id") + F.col("k")) % 7)
        return self.events(first, last).select(
            _text(F.col("user_id")).alias("fake_msisdn"),
            F.concat(brand, F.lit("-"), F.col("k") % 3).alias("handset_model"),
            brand.alias("handset_brand"),
            F.lit("smart").alias("handset_type"),
            (1 + F.col("k") % 31).cast("bigint").alias("cnt_of_days"),
            F.date_format("ts", "yyyyMM").alias("month_id"),
            F.col("day_text").alias("date_key"),
        )

    def _arpu(self, first: int | None, last: int | None) -> DataFrame:
        """One record per user and day."""
        user, kind = F.col("user_id"), F.col("event_type")
        value_of = lambda name: F.round(F.sum(F.when(kind == name, F.col("value")).otherwise(0.0)), 2)
        daily = (
            self.events(first, last)
            .groupBy("user_id", F.col("day_text").alias("date_key"))
            .agg(
                F.min("event_id").alias("first_event"),
                F.max("k").alias("top_k"),
                F.max("value").alias("res_com_score"),
                value_of("view").alias("voice_revenue"),
                value_of("purchase").alias("gprs_revenue"),
                value_of("click").alias("sms_revenue"),
                value_of("signup").alias("subscription_revenue"),
            )
        )
        return daily.select(
            _text(user).alias("fake_msisdn"),
            F.when(F.col("first_event") % 12 == user % 12, "N").otherwise("P").alias("contract_type"),
            F.lit("20100101").alias("registration_date"),
            F.when(user % 2 == 0, "F").otherwise("M").alias("gender"),
            F.when(user % 7 != 0, (18 + user % 50).cast("int")).alias("age"),
            F.lit("m1").alias("modem_model"),
            F.lit("t1").alias("flag_sim_tier"),
            _pick(SITES, F.col("top_k") % 16).alias("site_type"),
            F.when(F.col("top_k") % 11 != 0, F.col("res_com_score")).alias("res_com_score"),
            "voice_revenue", "gprs_revenue", "sms_revenue", "subscription_revenue", "date_key",
        )

    def user_owners(self, month: int) -> DataFrame:
        """(key, owner) rows of one month: every tenth user has a second owner."""
        user = _text(F.col("user_id"))
        second = (F.col("k") >= 50) & (F.col("user_id") % 10 == 0)
        return self.events(month, month).select(
            user.alias("key"), F.when(second, F.concat(F.lit("x"), user)).otherwise(F.concat(F.lit("o"), user)).alias("owner")
        )

    # Views over orders.

    def _loan_assign(self, first: int | None, last: int | None) -> DataFrame:
        """An order is a loan over the whole-number prices of its lines."""
        lines = self.lines(first, last).groupBy("l_orderkey").agg(
            F.sum(F.floor("l_extendedprice").cast("bigint")).alias("priced")
        )
        loans = self.orders(first, last).join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        amount = F.coalesce("priced", F.floor("o_totalprice").cast("bigint"))
        return loans.select(
            _text(F.col("o_custkey")).alias("bib_id"),
            _text(F.col("o_orderkey")).alias("loan_id"),
            _text(amount).alias("loan_amount"),
            F.col("day_text").alias("date_key"),
            F.col("moment_text").alias("date_timestamp"),
        )

    def _loan_recovery(self, first: int | None, last: int | None) -> DataFrame:
        """Every line that was not returned pays its price, on the day it is shipped."""
        paid = F.floor("l_extendedprice")
        return self.order_lines(first, last).where(F.col("l_returnflag") != "R").select(
            _text(F.col("o_custkey")).alias("bib_id"),
            _text(F.col("o_orderkey")).alias("loan_id"),
            _text(paid.cast("bigint")).alias("loan_amount"),
            paid.cast("double").alias("hsdp_recovery"),
            _moment_text(F.col("l_shipdate")).alias("date_timestamp"),
            _day_text(F.col("l_shipdate")).alias("date_key"),
        )

    def _package(self, first: int | None, last: int | None) -> DataFrame:
        lines = self.order_lines(first, last).join(self.base("part"), F.col("l_partkey") == F.col("p_partkey"))
        size = F.when(F.col("l_linenumber") % 7 != 0, F.concat(F.lit(" "), F.col("p_size"))).otherwise(F.lit(""))
        return lines.select(
            _text(F.col("o_custkey")).alias("bib_id"),
            F.concat("p_brand", F.lit(" "), F.col("l_linenumber") % 2).alias("offering_code"),
            F.when(F.col("l_discount") == 0, 0.0).otherwise(F.col("l_extendedprice")).alias("offer_amount"),
            F.concat("p_type", size, _pick(PACKAGE_UNITS, F.col("l_linenumber") % 4)).alias("offering_name"),
            F.col("moment_text").alias("activation_date"),
            _moment_text(F.col("l_shipdate")).alias("deactivation_date"),
            F.col("day_text").alias("date_key"),
        )

    def _user_info(self, first: int | None, last: int | None) -> DataFrame:
        """Every customer once, most of them in the target month, the rest in the one before."""
        since = self.base("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("since"))
        customers = self.base("customer").join(since, F.col("c_custkey") == F.col("o_custkey"), "left")
        segment = F.col("c_mktsegment")
        day = F.when(F.col("c_custkey") % 5 == 0, "19980520").otherwise("19980615")
        users = customers.select(
            _text(F.col("c_custkey")).alias("bib_id"),
            F.when(segment == "BUILDING", "N").when(segment != "MACHINERY", "P").alias("contract_type_v"),
            F.lit(None).cast("string").alias("gender_v"),
            _day_text(F.col("since")).alias("registration_date_d"),
            F.lit(None).cast("string").alias("date_of_birth_d"),
            _pick(STATUSES, F.col("c_nationkey") % 7).alias("ability_status"),
            F.when(F.col("c_custkey") % 9 != 0, F.col("c_acctbal")).alias("account_balance"),
            F.lit(None).cast("string").alias("base_station_cd"),
            F.lit(None).cast("string").alias("siteid"),
            day.alias("date_key"),
        )
        return users

    def _post_paid(self, first: int | None, last: int | None) -> DataFrame:
        """One account record per customer and order day."""
        price, status = F.col("o_totalprice"), F.col("o_orderstatus")
        share = lambda part, *kinds: F.sum(F.when(status.isin(*kinds), price * part).otherwise(0.0))
        urgent, first_order = F.min("o_orderpriority"), F.min("o_orderkey")
        day = F.to_date("o_orderdate")
        return (
            self.orders(first, last)
            .groupBy(_text(F.col("o_custkey")).alias("fake_msisdn"), day.alias("day"))
            .agg(
                share(0.5, "F", "P").alias("credit_limit"),
                share(0.2, "O", "P").alias("deposit_amt_n"),
                (share(0.3, "P", "F") - 1000).alias("outstanding_balance"),
                share(0.1, "P").alias("unbilled_amount"),
                F.when(urgent == "1-URGENT", "Hard").when(urgent == "2-HIGH", "Soft").otherwise("Active").alias("last_status"),
                first_order.alias("first_order"),
                F.lit(0.0).alias("avl_credit_limit"),
                F.when(urgent == "3-MEDIUM", "Y").alias("suspension_flag"),
                F.lit("1").alias("month_id"),
            )
            .withColumn("date_key", _day_text(F.col("day")))
            .withColumn(
                "last_payment_date",
                F.when(F.col("first_order") % 5 != 0, F.date_sub("day", (F.col("first_order") % 130).cast("int"))),
            )
            .drop("day", "first_order")
        )

    def _credit_management(self, first: int | None, last: int | None) -> DataFrame:
        line = F.col("l_linenumber")
        return self.order_lines(first, last).select(
            _text(F.col("o_custkey")).alias("fake_msisdn"),
            F.col("o_totalprice").alias("credit_amount"),
            F.date_add(F.to_date("o_orderdate"), CREDIT_SHIFT_DAYS).alias("credit_assigned_date"),
            F.col("o_orderkey").alias("loan_id"),
            F.col("o_totalprice").alias("loan_amount"),
            (line % 4).cast("int").alias("loan_status"),
            (F.col("o_orderkey") * 10 + line).alias("installment_id"),
            F.col("l_extendedprice").alias("installment_amount"),
            F.to_date("l_shipdate").alias("installment_duedate"),
            F.when(F.col("l_linestatus") != "O", F.col("l_quantity").cast("int") - 25).alias("days_delayed"),
            F.col("day_text").alias("date_key"),
        )

    def part_owners(self, month: int | None) -> DataFrame:
        """(key, owner) rows of one month, or of all: parts and the customers that ordered them."""
        return self.order_lines(month, month).select(
            _text(F.col("l_partkey")).alias("key"), _text(F.col("o_custkey")).alias("owner")
        )

    def customer_owners(self, month: int | None) -> DataFrame:
        """(key, owner) rows of one month, or of all: orders in part delivery belong to a second owner."""
        customer = _text(F.col("o_custkey"))
        second = F.col("o_orderstatus") == "P"
        return self.orders(month, month).select(
            customer.alias("key"),
            F.when(second, F.concat(F.lit("p"), customer)).otherwise(F.concat(F.lit("c"), customer)).alias("owner"),
        )
