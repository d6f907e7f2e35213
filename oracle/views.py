"""The source views over the test tables, in SQL."""

EVENTS_MONTH = 16835
ORDERS_MONTH = 16528
CREDIT_SHIFT_DAYS = 9700


def month_index(day: str) -> str:
    """Billing-month index of a DATE expression."""
    n = f"(date_diff('day', DATE '1600-01-01', {day}) - 79)"
    in_sub = f"({n} % 12053 % 1461)"
    year = (
        f"(979 + 33 * ({n} // 12053) + 4 * ({n} % 12053 // 1461)"
        f" + (CASE WHEN {in_sub} >= 366 THEN ({in_sub} - 1) // 365 ELSE 0 END))"
    )
    doy = f"(CASE WHEN {in_sub} >= 366 THEN ({in_sub} - 1) % 365 ELSE {in_sub} END)"
    month = f"(CASE WHEN {doy} < 186 THEN {doy} // 31 + 1 ELSE 7 + ({doy} - 186) // 30 END)"
    dom = f"(CASE WHEN {doy} < 186 THEN {doy} % 31 + 1 ELSE ({doy} - 186) % 30 + 1 END)"
    return f"CAST(12 * {year} + {month} + (CASE WHEN {dom} >= 20 THEN 1 ELSE 0 END) AS INTEGER)"


def pick(values: tuple, position: str) -> str:
    items = ", ".join("NULL" if v is None else f"'{v}'" for v in values)
    return f"[{items}][CAST({position} AS INTEGER) + 1]"


# Names of the source, in the order in which the test views deal them out.
SENDERS = (
    "Bank Mellat", "TEJARAT-BANK", "V.Mellat", "bank.melli", "Pasargad!",
    "Shop 24", "Keshavarzi & Refah", "SINA", "Mellat Iz", None,
)
BRANDS = ("SAMSUNG", "XIAOMI", "HUAWEI", "APPLE", "Other", "Nokia", None)
SERVICES = ("Recharge Money", "DATA_BOLTON", "EREFILL", "DATA_BUYABLE", "BillPayment", "Pay Bill", "TDD_BOLTON", None)
SYSTEMS = ("BUNDLE_PURCHASE", "DIRECT_PURCHASE", "INDIRECT_PURCHASE")
SITES = (
    "Airport", "Industrial Area", "Island", "Oil Platform", "Port", "Touristic Area", "USO", "University",
    "Road", "Village", "Small City", "Capital City", "Main City", "Middle City", "Desert", None,
)
STATUSES = ("ACTIVE", "ERASED", "HARD", "OTHER", "READY TO ACTIVATE SOFT", "READY TO ACTIVE", "SOFT")
UNITS = (" GB", "MB", "", " gb plus")
# The bank vocabulary.
BANKS = (
    "mellat", "tejarat", "keshavarzi", "refah", "melli", "pasargad", "maskan",
    "resalat", "ayandeh", "parsian", "enbank", "sina", "iz",
)

_E, _O = EVENTS_MONTH, ORDERS_MONTH

# Name -> SELECT.  Every view may use the ones before it.
VIEWS = {
    "ev": f"""SELECT * FROM (SELECT *, CAST(regexp_extract(props, '"k": (\\d+)', 1) AS INTEGER) AS k,
        CAST(ts AS DATE) AS date, {month_index('CAST(ts AS DATE)')} AS mi FROM events)
        WHERE mi BETWEEN {_E - 1} AND {_E}""",
    "ord": f"""SELECT * FROM (SELECT *, CAST(o_orderdate AS DATE) AS date,
        {month_index('CAST(o_orderdate AS DATE)')} AS mi FROM orders) WHERE mi BETWEEN {_O - 1} AND {_O}""",
    "ordl": "SELECT * FROM ord JOIN lineitem ON o_orderkey = l_orderkey",
    "cdr": """SELECT CAST(user_id AS VARCHAR) AS bib_id, date, mi,
        count(*) FILTER (event_type = 'click') AS sms_count,
        count(*) FILTER (event_type = 'view') AS voice_count,
        round(sum(CASE WHEN event_type = 'view' THEN value ELSE 0.0 END), 2) AS call_duration,
        round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END), 2) AS gprs_usage,
        round(sum(CASE WHEN event_type = 'error' THEN value ELSE 0.0 END), 2) AS voice_session_cost
        FROM ev GROUP BY user_id, date, mi, (hour(ts) < 12)""",
    "recharge": """SELECT CAST(user_id AS VARCHAR) AS bib_id, date, mi,
        CASE WHEN k % 17 = 0 THEN 0.0 ELSE value END AS amount, date_trunc('second', ts) AS recharge_dt,
        'h' || (event_id % 3) AS origin_host_nm, CAST(k AS DOUBLE) AS before_amt,
        k + CASE WHEN k % 17 = 0 THEN 0.0 ELSE value END AS after_amt
        FROM ev WHERE event_type = 'purchase'""",
    "purchase": f"""SELECT CAST(user_id AS VARCHAR) AS fake_msisdn, date, mi,
        coalesce({pick(SERVICES, 'k % 8')},
                 CASE WHEN event_type <> 'error' THEN 'GAME ' || event_type END) AS service_type,
        CAST(k % 5 AS BIGINT) AS cnt, value AS amount, {pick(SYSTEMS, 'event_id % 3')} AS source_system_cd FROM ev""",
    "bank": f"""SELECT CAST(user_id AS VARCHAR) AS fake_msisdn, date, mi, {pick(SENDERS, 'k % 10')} AS bank_name,
        CAST(1 + k % 4 AS BIGINT) AS sms_cnt FROM ev""",
    "travel": """SELECT fake_msisdn, date, mi, CASE WHEN n < 3 THEN n END AS sum_travel FROM (
        SELECT CAST(user_id AS VARCHAR) AS fake_msisdn, date, mi, event_type, count(*) FILTER (k >= 80) AS n
        FROM ev WHERE event_type IN ('signup', 'view') GROUP BY user_id, date, mi, event_type)""",
    "handset": f"""SELECT *, handset_brand || '-' || (k % 3) AS handset_model FROM (
        SELECT CAST(user_id AS VARCHAR) AS fake_msisdn, date, mi, k,
        {pick(BRANDS, '(user_id + k) % 7')} AS handset_brand, CAST(1 + k % 31 AS BIGINT) AS cnt_of_days,
        strftime(ts, '%Y%m') AS month_id FROM ev)""",
    "arpu": f"""SELECT CAST(user_id AS VARCHAR) AS fake_msisdn, date, mi,
        CASE WHEN min(event_id) % 12 = user_id % 12 THEN 'N' ELSE 'P' END AS contract_type,
        CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
        CASE WHEN user_id % 7 <> 0 THEN CAST(18 + user_id % 50 AS INTEGER) END AS age,
        {pick(SITES, 'max(k) % 16')} AS site_type,
        CASE WHEN max(k) % 11 <> 0 THEN max(value) END AS res_com_score,
        round(sum(CASE WHEN event_type = 'view' THEN value ELSE 0.0 END), 2) AS voice_revenue,
        round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END), 2) AS gprs_revenue,
        round(sum(CASE WHEN event_type = 'click' THEN value ELSE 0.0 END), 2) AS sms_revenue,
        round(sum(CASE WHEN event_type = 'signup' THEN value ELSE 0.0 END), 2) AS subscription_revenue
        FROM ev GROUP BY user_id, date, mi""",
    "user_owner": """SELECT CAST(user_id AS VARCHAR) AS "key",
        CASE WHEN k >= 50 AND user_id % 10 = 0 THEN 'x' ELSE 'o' END || user_id AS owner, mi FROM ev""",
    "loan": """SELECT CAST(o_custkey AS VARCHAR) AS bib_id, o_orderkey AS loan_id, o_orderdate AS dt_sec, date, mi,
        CAST(coalesce(p.amount, CAST(floor(o_totalprice) AS BIGINT)) AS INTEGER) AS loan_amount
        FROM ord LEFT JOIN (SELECT l_orderkey, sum(CAST(floor(l_extendedprice) AS BIGINT)) AS amount
        FROM lineitem GROUP BY l_orderkey) p ON o_orderkey = p.l_orderkey""",
    "recovery": """SELECT o_orderkey AS loan_id, floor(l_extendedprice) AS hsdp_recovery, l_shipdate AS paid_at
        FROM ordl WHERE l_returnflag <> 'R'""",
    "package": f"""SELECT CAST(o_custkey AS VARCHAR) AS bib_id, date, mi,
        p_brand || ' ' || (l_linenumber % 2) AS offering_code,
        CASE WHEN l_discount = 0 THEN 0.0 ELSE l_extendedprice END AS offer_amount,
        p_type || CASE WHEN l_linenumber % 7 <> 0 THEN ' ' || p_size ELSE '' END
        || {pick(UNITS, 'l_linenumber % 4')} AS offering_name,
        o_orderdate AS a_date, l_shipdate AS de_a_date
        FROM ordl JOIN part ON l_partkey = p_partkey""",
    "user_info": f"""SELECT * FROM (SELECT CAST(c_custkey AS VARCHAR) AS bib_id,
        CASE WHEN c_mktsegment = 'BUILDING' THEN 'N' WHEN c_mktsegment <> 'MACHINERY' THEN 'P' END AS contract_type_v,
        CAST(since AS DATE) AS registration_date, {pick(STATUSES, 'c_nationkey % 7')} AS ability_status,
        CASE WHEN c_custkey % 9 <> 0 THEN c_acctbal END AS account_balance,
        CASE WHEN c_custkey % 5 = 0 THEN {_O - 1} ELSE {_O} END AS mi
        FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS since FROM orders GROUP BY o_custkey)
        ON c_custkey = o_custkey)""",
    "post_paid": """SELECT *, CASE WHEN first_order % 5 <> 0 THEN date - CAST(first_order % 130 AS INTEGER) END
        AS last_payment_date FROM (
        SELECT CAST(o_custkey AS VARCHAR) AS fake_msisdn, date, mi, min(o_orderkey) AS first_order,
        sum(CASE WHEN o_orderstatus IN ('F', 'P') THEN o_totalprice * 0.5 ELSE 0.0 END) AS credit_limit,
        sum(CASE WHEN o_orderstatus IN ('O', 'P') THEN o_totalprice * 0.2 ELSE 0.0 END) AS deposit_amt_n,
        sum(CASE WHEN o_orderstatus IN ('P', 'F') THEN o_totalprice * 0.3 ELSE 0.0 END) - 1000
            AS outstanding_balance,
        sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 0.1 ELSE 0.0 END) AS unbilled_amount,
        CASE min(o_orderpriority) WHEN '1-URGENT' THEN 'Hard' WHEN '2-HIGH' THEN 'Soft' ELSE 'Active' END
            AS last_status,
        CASE WHEN min(o_orderpriority) = '3-MEDIUM' THEN 'Y' END AS suspension_flag
        FROM ord GROUP BY o_custkey, date, mi)""",
    "credit": f"""SELECT CAST(o_custkey AS VARCHAR) AS fake_msisdn, date, mi,
        date + {CREDIT_SHIFT_DAYS} AS credit_assigned_date, l_linenumber % 4 AS loan_status,
        o_orderkey * 10 + l_linenumber AS installment_id, CAST(l_shipdate AS DATE) AS due,
        CASE WHEN l_linestatus <> 'O' THEN CAST(l_quantity AS INTEGER) - 25 END AS days_delayed FROM ordl""",
    "part_owner": """SELECT CAST(l_partkey AS VARCHAR) AS "key", CAST(o_custkey AS VARCHAR) AS owner, mi FROM ordl""",
    "customer_owner": """SELECT CAST(o_custkey AS VARCHAR) AS "key",
        CASE WHEN o_orderstatus = 'P' THEN 'p' ELSE 'c' END || o_custkey AS owner, mi FROM ord""",
}


def drop_list(owners: str, month: int) -> dict[str, str]:
    """CTEs that end in ``<owners>_drop``: the (key, owner) rows to drop."""
    p = owners
    multi = "SELECT DISTINCT {t}.* FROM {t} WHERE \"key\" IN (SELECT \"key\" FROM {t} GROUP BY \"key\" HAVING count(DISTINCT owner) > 1)"
    return {
        f"{p}_cur": f'SELECT "key", owner FROM {p} WHERE mi = {month}',
        f"{p}_prev": f'SELECT "key", owner FROM {p} WHERE mi = {month - 1}',
        f"{p}_multi_cur": multi.format(t=f"{p}_cur"),
        f"{p}_multi_prev": multi.format(t=f"{p}_prev"),
        f"{p}_now": f"SELECT DISTINCT * FROM {p}_prev WHERE owner IN (SELECT owner FROM {p}_multi_cur)",
        f"{p}_before": f"SELECT DISTINCT * FROM {p}_multi_prev WHERE owner NOT IN (SELECT owner FROM {p}_cur)",
        f"{p}_drop": f"SELECT * FROM {p}_before UNION SELECT * FROM {p}_now",
    }


VIEWS.update(drop_list("user_owner", EVENTS_MONTH))
VIEWS.update(drop_list("customer_owner", ORDERS_MONTH))
VIEWS.update(drop_list("part_owner", ORDERS_MONTH))


def with_views(select: str, extra: dict[str, str] | None = None) -> str:
    """A query with the CTEs it needs: its own, and the views they mention."""
    import re

    ctes = {**VIEWS, **(extra or {})}
    needed, todo = set(), [select]
    while todo:
        text = todo.pop()
        for name in ctes:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                todo.append(ctes[name])
    parts = [f"{name} AS ({ctes[name]})" for name in ctes if name in needed]
    return f"WITH {', '.join(parts)} {select}" if parts else select
