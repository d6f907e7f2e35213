"""Source tables: the columns their readers use, and their types."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the monthly source tables.
SOURCE_COLUMNS = {
    "package": (
        "bib_id", "offering_code", "offer_amount", "offering_name",
        "activation_date", "deactivation_date", "date_key",
    ),
    "cdr": (
        "bib_id", "sms_count", "voice_count", "call_duration", "gprs_usage", "voice_session_cost", "date_key",
    ),
    "user_info": (
        "bib_id", "contract_type_v", "gender_v", "registration_date_d", "date_of_birth_d",
        "ability_status", "account_balance", "base_station_cd", "siteid", "date_key",
    ),
    "package_purchase": (
        "fake_msisdn", "service_type", "cnt", "amount", "source_system_cd", "date_key",
    ),
    "handset_price": (
        "fake_msisdn", "handset_model", "handset_brand", "handset_type", "cnt_of_days", "month_id", "date_key",
    ),
    "arpu": (
        "fake_msisdn", "contract_type", "registration_date", "gender", "age", "modem_model", "flag_sim_tier",
        "site_type", "res_com_score", "voice_revenue", "gprs_revenue", "sms_revenue", "subscription_revenue",
        "date_key",
    ),
    "customer_person_type_bank_info": ("fake_msisdn", "bank_name", "sms_cnt", "date_key"),
    "recharge": (
        "bib_id", "recharge_value_amt", "recharge_dt", "origin_host_nm",
        "account_balance_before_amt", "account_balance_after_amt", "date_key",
    ),
    "loan_assign": ("bib_id", "loan_id", "loan_amount", "date_key", "date_timestamp"),
    "loan_recovery": ("bib_id", "loan_id", "loan_amount", "hsdp_recovery", "date_timestamp", "date_key"),
    "domestic_travel": ("fake_msisdn", "sum_travel", "date_key"),
    "post_paid": (
        "fake_msisdn", "credit_limit", "deposit_amt_n", "outstanding_balance", "unbilled_amount",
        "last_status", "last_payment_date", "avl_credit_limit", "suspension_flag", "month_id", "date_key",
    ),
    "credit_management": (
        "fake_msisdn", "credit_amount", "credit_assigned_date", "loan_id", "loan_amount", "loan_status",
        "installment_id", "installment_amount", "installment_duedate", "days_delayed", "date_key",
    ),
}

# Columns that are not text, by table.
_DOUBLES = {
    "package": ("offer_amount",),
    "cdr": ("call_duration", "gprs_usage", "voice_session_cost"),
    "user_info": ("account_balance",),
    "package_purchase": ("amount",),
    "arpu": ("res_com_score", "voice_revenue", "gprs_revenue", "sms_revenue", "subscription_revenue"),
    "recharge": ("recharge_value_amt", "account_balance_before_amt", "account_balance_after_amt"),
    "loan_recovery": ("hsdp_recovery",),
    "post_paid": ("credit_limit", "deposit_amt_n", "outstanding_balance", "unbilled_amount", "avl_credit_limit"),
    "credit_management": ("credit_amount", "loan_amount", "installment_amount"),
}
_LONGS = {
    "cdr": ("sms_count", "voice_count"),
    "package_purchase": ("cnt",),
    "handset_price": ("cnt_of_days",),
    "customer_person_type_bank_info": ("sms_cnt",),
    "domestic_travel": ("sum_travel",),
    "credit_management": ("loan_id", "installment_id"),
}
_INTS = {"arpu": ("age",), "credit_management": ("loan_status", "days_delayed")}
_DATES = {"post_paid": ("last_payment_date",), "credit_management": ("credit_assigned_date", "installment_duedate")}
_KINDS = ((_DOUBLES, T.DoubleType()), (_LONGS, T.LongType()), (_INTS, T.IntegerType()), (_DATES, T.DateType()))


def source_schema(table: str) -> T.StructType:
    """Declared columns of a table with their types."""

    def kind(name: str) -> T.DataType:
        return next((type_ for columns, type_ in _KINDS if name in columns.get(table, ())), T.StringType())

    return T.StructType([T.StructField(name, kind(name)) for name in SOURCE_COLUMNS[table]])


def key_column(table: str) -> str:
    """Subscriber key of a table."""
    return SOURCE_COLUMNS[table][0]
