"""Reference SQL by query name."""

from __future__ import annotations

from dataclasses import replace

from oracle import groups as g
from oracle.groups import GROUPS, by_month, div, typed
from oracle.views import EVENTS_MONTH, ORDERS_MONTH, VIEWS, month_index, with_views

E, O = EVENTS_MONTH, ORDERS_MONTH
# All orders instead of the two target months.
ALL_ORDERS = {
    "ord": f"""SELECT *, CAST(o_orderdate AS DATE) AS date, {month_index('CAST(o_orderdate AS DATE)')} AS mi
        FROM orders"""
}
CDR_COLUMNS = (
    "bib_id, date, mi AS month_index, sms_count, voice_count, (round_even(CAST(call_duration AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000) AS call_duration,"
    " (round_even(CAST(gprs_usage AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000) AS gprs_usage, (round_even(CAST(voice_session_cost AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000) AS voice_session_cost"
)
DAYS = """SELECT CAST(o_orderdate AS DATE) AS date FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem
    UNION SELECT CAST(ts AS DATE) FROM events"""


def some(group: g.SqlGroup, names: list[tuple], rows: dict[int, str], ctes: dict[str, str]) -> str:
    """Unfilled features over rows without the drop list."""
    return replace(group, features=names, rows=rows, ctes=ctes, extra={}).raw_sql()


def pick(group: g.SqlGroup, *names: str) -> list[tuple]:
    return [f for f in group.features if f[0] in names]


def undropped(name: str, *names: str) -> str:
    """A group's raw features with the drop list taken out of its row CTEs."""
    import re

    group = GROUPS[name]
    no_list = lambda sql: re.sub(r'\w+ NOT IN \(SELECT "key" FROM \w+_drop\)', "TRUE", sql)
    features = pick(group, *names) if names else group.features
    rows = {r: no_list(sql) for r, sql in group.rows.items()}
    return some(group, features, rows, {k: no_list(v) for k, v in group.ctes.items()})


def indexed_recharge() -> str:
    """Recharge features of both targets, prefixed by target."""
    frames, columns = {}, []
    base = "(SELECT DISTINCT * FROM recharge)"
    for target in (E - 1, E):
        for r in (1, 2):
            group = GROUPS["Recharge"]
            selected = []
            for rr, column, kind, formula, _ in group.columns():
                if rr == r:
                    name = f"{target}_{column}"
                    selected.append(f'{formula} AS "{name}"')
                    columns.append(f'{typed(chr(34) + name + chr(34), kind)} AS "{name}"')
            window = f"mi > {target - r} AND mi <= {target}"
            frames[f"w{target}_{r}"] = (
                f"SELECT bib_id, {', '.join(selected)} FROM {base} WHERE {window} GROUP BY bib_id"
            )
    names = list(frames)
    joined = f"{names[0]} " + " ".join(f"FULL JOIN {n} USING (bib_id)" for n in names[1:])
    return with_views(f"SELECT bib_id, {', '.join(columns)} FROM {joined}", frames)


def indexed_pivot() -> str:
    parts = []
    for t in (E - 1, E):
        window = f"mi > {t - 2} AND mi <= {t}"
        parts += [
            f'CAST(sum(sms_count) FILTER ({window}) AS BIGINT) AS "{t}_sms_sum"',
            f'max(voice_count) FILTER ({window}) AS "{t}_voice_max"',
            f'count(*) FILTER ({window}) AS n{t}',
        ]
    counts = ", ".join(f'nullif(n{t}, 0) AS "{t}_record_count"' for t in (E - 1, E))
    inner = f"SELECT bib_id, {', '.join(parts)} FROM cdr GROUP BY bib_id"
    return with_views(f"SELECT * EXCLUDE (n{E - 1}, n{E}), {counts} FROM ({inner})")


def registry_counts() -> str:
    event_views = {
        "cdr": "cdr",
        "recharge": "recharge",
        "package_purchase": "purchase",
        "customer_person_type_bank_info": "bank",
        "domestic_travel": "travel",
        "handset_price": "handset",
        "arpu": "arpu",
    }
    order_views = {
        "package": "package",
        "user_info": "user_info",
        "loan_assign": "loan",
        "loan_recovery": f"""(SELECT * FROM (SELECT {month_index('CAST(l_shipdate AS DATE)')} AS mi FROM ordl
            WHERE l_returnflag <> 'R') WHERE mi BETWEEN {O - 1} AND {O})""",
        "post_paid": "post_paid",
        "credit_management": "credit",
    }
    selects = [
        f"SELECT '{name}' AS source, mi AS month_index, count(*) AS n FROM {view} GROUP BY mi"
        for name, view in {**event_views, **order_views}.items()
    ]
    return with_views(" UNION ALL ".join(selects))


# Bank messages without the drop list, at the (key, sender, month) grain.
BANK_MONTHS = {
    "bank_matched": f"SELECT DISTINCT * FROM (SELECT *, {g.MATCHED} AS matched FROM bank) WHERE len(matched) > 0",
    "bank_per_row": """SELECT *, sum(sms_cnt) OVER (PARTITION BY fake_msisdn, bank_name, mi) AS total
        FROM bank_matched""",
    "bank_running": """SELECT *, sum(total) OVER (PARTITION BY fake_msisdn, bank_name ORDER BY total DESC) AS running
        FROM bank_per_row""",
    "bank_months": """SELECT fake_msisdn, bank_name, mi AS month_index, count(*) AS row_count,
        CAST(max(total) AS BIGINT) AS total_sms_count, CAST(max(running) AS BIGINT) AS total_sms_cnt_both
        FROM bank_running GROUP BY fake_msisdn, bank_name, mi""",
}
ARPU_RANKED = {k: v for k, v in g.ARPU_CTES.items() if k != "arpu_rows"}
ARPU_RANKED["arpu_latest"] = f"SELECT *, {g._LATEST} AS latest, {g._BEFORE} AS previous FROM arpu_months"


def arpu_at(expression: str, name: str) -> str:
    return with_views(
        f"SELECT DISTINCT fake_msisdn, mi AS month_index, {expression} AS {name} FROM arpu_latest", ARPU_RANKED
    )


def owners(select: str) -> str:
    return with_views(select)


STORE_ARPU = {
    **{f"{r}_1": f"{r}_first_1" for r in (*g.REVENUES, "res_com_score")},
    **{f"{r}_2": f"{r}_second_2" for r in g.REVENUES},
    "age_2": "age_1",
    "gender_2": "gender_1",
    "res_com_score_2": None,
}


def store(names: list[str], defaults: bool) -> str:
    """Spine of ids, one left join per group table, defaults on top."""
    import re

    ctes, spine, columns = {}, [], []
    for i, name in enumerate(names):
        group, tag = GROUPS[name], f"t{i}"
        local = {**group.all_ctes(), "final": group.table()}
        renames = {n: f"{tag}_{n}" for n in local}
        pattern = re.compile(r"\b(" + "|".join(renames) + r")\b")
        for n, text in local.items():
            ctes[renames[n]] = pattern.sub(lambda m: renames[m.group(1)], text)
        table = renames["final"]
        spine.append(f"SELECT {group.key} AS bib_id FROM {table}")
        for extra in group.extra:
            columns.append(f'{table}."{extra}"')
        for _, column, kind, _, default in group.columns():
            store_name = STORE_ARPU.get(column, column) if name == "Arpu" else column
            if store_name is None:
                continue
            value = f'{table}."{column}"'
            if defaults and default is not None:
                filler = f'(SELECT {default}("{column}") FROM {table})' if isinstance(default, str) else default
                value = f"coalesce({value}, {filler})"
            columns.append(f'{typed(value, kind)} AS "{store_name}"')
    ctes["ids"] = " UNION ".join(spine)
    joins = " ".join(
        f"LEFT JOIN t{i}_final ON ids.bib_id = t{i}_final.{GROUPS[n].key}" for i, n in enumerate(names)
    )
    return with_views(f"SELECT ids.bib_id, {', '.join(columns)} FROM ids {joins}", ctes)


def spine() -> str:
    return store(list(GROUPS), False).split("SELECT ids.bib_id")[0] + "SELECT bib_id FROM ids"


ALL = list(GROUPS)
_RECOVERED = "CAST(date_diff('second', TIMESTAMP '1970-01-01', recovered_time) AS BIGINT)"
_TRAVEL_DAYS = {
    "travel_distinct": "SELECT DISTINCT * FROM travel",
    "travel_days": """SELECT DISTINCT fake_msisdn, date,
        CAST(sum(sum_travel) OVER (PARTITION BY fake_msisdn, date) AS BIGINT) AS sum_travel,
        CAST(sum(sum_travel) OVER (PARTITION BY fake_msisdn) AS BIGINT) AS total_travel FROM travel_distinct""",
}
_PREVIOUS = ", ".join(
    f"CASE WHEN {m} > 0 THEN max(CASE WHEN {m} > 0 THEN date END) OVER w END AS {kind}_previous"
    for kind, m in g.CDR_ACTIVITY.items()
)
_CDR_DAYS = {
    "cdr_days": """SELECT bib_id, date, mi, CAST(sum(sms_count) AS BIGINT) AS sms_count,
        CAST(sum(voice_count) AS BIGINT) AS voice_count, sum(gprs_usage) AS gprs_usage
        FROM (SELECT DISTINCT * FROM cdr) GROUP BY bib_id, date, mi"""
}
_FRAME = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
_DERIVED = {
    **_CDR_DAYS,
    "cdr_assigned": f"""SELECT c.*, t AS target FROM cdr_days c, (VALUES ({E - 1}), ({E})) AS targets(t)
        WHERE mi > t - 2 AND mi <= t""",
}

ORACLE = {
    "scan_months": with_views(f"SELECT {CDR_COLUMNS} FROM cdr"),
    "scan_registry": registry_counts(),
    "time_range_filter": with_views(
        f"""SELECT CAST(o_custkey AS VARCHAR) AS bib_id, CAST(o_orderkey AS VARCHAR) AS loan_id, date,
        mi AS month_index FROM ord WHERE mi > {O - 1 - 2} AND mi <= {O}""",
        ALL_ORDERS,
    ),
    "scan_droplist": owners('SELECT DISTINCT "key" FROM part_owner_drop'),
    "distinct_keys": with_views('SELECT DISTINCT "key", owner FROM part_owner', ALL_ORDERS),
    "distinct_rows": with_views(f"SELECT DISTINCT {CDR_COLUMNS} FROM cdr"),
    "sink_parquet_features": GROUPS["Recharge"].sql(),
    "sink_table_append": GROUPS["Recharge"].sql(),
    "sink_writer_cap": GROUPS["Recharge"].sql(),
    "schema_contract": replace(
        GROUPS["Recharge"], ctes={"recharge_rows": "SELECT DISTINCT * FROM recharge"}
    ).sql(),
    "project_cols": with_views("SELECT fake_msisdn, service_type, cnt FROM purchase"),
    "notnull_key_filter": with_views(
        """SELECT fake_msisdn, handset_brand, handset_model, cnt_of_days, date FROM handset
        WHERE fake_msisdn IS NOT NULL AND handset_brand IS NOT NULL"""
    ),
    "value_filters": with_views(
        """SELECT fake_msisdn, service_type, cnt, (round_even(CAST(amount AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000) AS amount, source_system_cd, date,
        mi AS month_index FROM purchase WHERE amount > 0 AND cnt > 0"""
    ),
    "na_fill": with_views(
        """SELECT fake_msisdn, date, coalesce(age, 0) AS age, (round_even(CAST(coalesce(res_com_score, 0.0) AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000) AS res_com_score,
        site_type FROM arpu"""
    ),
    "cast_cols": with_views("SELECT bib_id, loan_id, loan_amount FROM loan", ALL_ORDERS),
    "month_index": f"SELECT date, {month_index('date')} AS month_index FROM ({DAYS})",
    "parse_date_key": f"""SELECT strftime(date, '%Y%m%d') AS date_key, date FROM ({DAYS})
        UNION ALL SELECT 'x' || strftime(date, '%Y%m%d'), NULL FROM ({DAYS})""",
    "parse_ts": """SELECT event_id, strftime(ts, '%Y%m%d %H:%M:%S') AS "text",
        CAST(date_diff('second', TIMESTAMP '1970-01-01', date_trunc('second', ts)) AS BIGINT) AS seconds FROM events""",
    "derived_phase_ab": with_views(
        f"""SELECT bib_id, date, CAST(target AS INTEGER) AS month_index, mi AS real_month,
        dayofweek(date) IN (4, 5) AS weekend, sms_count,
        CAST(CASE WHEN sms_count > 0 THEN date_diff('day', max(CASE WHEN sms_count > 0 THEN date END)
        OVER (PARTITION BY bib_id, target ORDER BY date {_FRAME}), date) * 86400 END AS INTEGER) AS gap_sms
        FROM cdr_assigned""",
        _DERIVED,
    ),
    "range_naming": undropped("Recharge"),
    "index_naming": indexed_recharge(),
    "const_overwrite": with_views(
        "SELECT fake_msisdn, installment_id, date, max_mi AS month_index FROM credit_scored", g.CREDIT_CTES
    ),
    "agg_global_max": with_views("SELECT max(mi) AS month_index FROM credit_scored", g.CREDIT_CTES),
    "anti_join_droplist": with_views(
        f'SELECT {CDR_COLUMNS} FROM cdr WHERE bib_id NOT IN (SELECT "key" FROM user_owner_drop)'
    ),
    "outer_join_ranges": undropped("LoanAssign"),
    "agg_recovery_rollup": with_views(
        f"SELECT loan_id, recovered_amt, {_RECOVERED} AS recovered_time FROM recovered", {**ALL_ORDERS, **g.RECOVERY_CTES}
    ),
    "right_join_recovery": with_views(
        f"""SELECT bib_id, loan_id, loan_amount, coalesce(recovered_amt, 0.0) AS recovered_amt,
        {_RECOVERED} AS recovered_time FROM loan LEFT JOIN recovered USING (loan_id)""",
        {**ALL_ORDERS, **g.RECOVERY_CTES},
    ),
    "inner_join_multi_owner": with_views(
        """SELECT DISTINCT "key", owner FROM part_owner WHERE "key" IN
        (SELECT "key" FROM part_owner GROUP BY "key" HAVING count(DISTINCT owner) > 1)""",
        ALL_ORDERS,
    ),
    "broadcast_inner_owner": owners("SELECT * FROM part_owner_now"),
    "broadcast_anti_owner": owners("SELECT * FROM part_owner_before"),
    "union_distinct": with_views(
        'SELECT "key", owner FROM part_owner UNION SELECT "key", owner FROM customer_owner', ALL_ORDERS
    ),
    "drop_list": owners("SELECT * FROM part_owner_drop"),
    "window_assign": with_views(
        f"""SELECT bib_id, date, CAST(t AS INTEGER) AS month_index, sms_count, voice_count,
        (round_even(CAST(call_duration AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000) AS call_duration FROM cdr, (VALUES ({E - 1}), ({E})) AS targets(t)
        WHERE mi > t - 2 AND mi <= t"""
    ),
    "pivot_features": indexed_pivot(),
    "group_two_level": undropped("PackagePurchase"),
    "agg_sum_coalesce": undropped("CDR", "sms_count", "voice_count", "call_duration_sum", "gprs_usage_sum"),
    "agg_count_distinct": undropped("CDR", "sms_activedays", "voice_activedays", "gprs_usage_activedays"),
    "agg_conditional": some(
        GROUPS["CDR"],
        [
            (name, kind, f"sum({m}) FILTER (dayofweek(date) IN (4, 5))", 0, (1, 2))
            for name, kind, m in (
                ("sms_sum_weekend", "bigint", "sms_count"),
                ("voice_sum_weekend", "bigint", "voice_count"),
                ("call_duration_sum_weekend", "double", "call_duration"),
                ("gprs_usag_sum_weekend", "double", "gprs_usage"),
            )
        ],
        by_month("(SELECT DISTINCT * FROM cdr)", E),
        {},
    ),
    "agg_basic": undropped(
        "Recharge", "count_recharge", "max_recharge", "min_recharge", "mean_recharge", "sum_recharge"
    ),
    "agg_ratio": undropped("Recharge", "ratio_afternoon_recharge", "ratio_weekend_recharge"),
    "agg_set_size": undropped("HandsetPrice", "total_unique_handsets", "total_unique_brands", "brand_diversity_ratio"),
    "agg_first_last": with_views(
        """SELECT fake_msisdn, (round_even(CAST(first(credit_limit ORDER BY date, credit_limit NULLS FIRST) AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000) AS first_limit,
        (round_even(CAST(last(credit_limit ORDER BY date, credit_limit NULLS FIRST) AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000) AS last_limit, first(last_status ORDER BY date, last_status NULLS FIRST) AS first_status,
        last(last_status ORDER BY date, last_status NULLS FIRST) AS last_status FROM post_paid GROUP BY fake_msisdn""",
        ALL_ORDERS,
    ),
    "one_hot_vocab": with_views(
        "SELECT fake_msisdn, date, handset_brand, "
        + ", ".join(
            f"CAST(CASE WHEN handset_brand = '{b}' THEN 1 ELSE 0 END AS INTEGER) AS brand_{i}"
            for i, b in enumerate(g.HANDSET_BRANDS)
        )
        + " FROM handset"
    ),
    "agg_installment_rollup": with_views(
        """SELECT fake_msisdn, installment_id, CAST(max(coalesce(days_delayed, date_diff('day', due, date))) AS INTEGER)
        AS days_delay_new, max(days_delayed) AS days_delayed,
        CAST(max(date_diff('day', due, date)) AS INTEGER) AS days_after_duedate, max(mi) AS month_index
        FROM credit WHERE loan_status <> 3 GROUP BY fake_msisdn, installment_id""",
        ALL_ORDERS,
    ),
    "debt_status": with_views(
        """SELECT fake_msisdn, installment_id, CAST(days_delay_new AS INTEGER) AS days_delay_new, days_delayed,
        CAST(days_after_duedate AS INTEGER) AS days_after_duedate, debt_status_1, debt_status_2, terrible_debt_status
        FROM credit_status""",
        {**ALL_ORDERS, **g.CREDIT_CTES, "credit_scored": "SELECT *, mi AS max_mi FROM credit"},
    ),
    "win_prev_active_day": with_views(
        f"""SELECT bib_id, date, {_PREVIOUS} FROM cdr_days
        WINDOW w AS (PARTITION BY bib_id ORDER BY date {_FRAME})""",
        _CDR_DAYS,
    ),
    "weekend_flag": with_views(
        "SELECT bib_id, date, sms_count, CAST(CASE WHEN dayofweek(date) IN (4, 5) THEN 1 ELSE 0 END AS INTEGER) AS weekend FROM cdr"
    ),
    "win_lag": with_views(
        """SELECT bib_id, mi AS month_index, seconds, n,
        seconds - lag(seconds) OVER (PARTITION BY bib_id ORDER BY seconds) AS "interval" FROM (
        SELECT bib_id, mi, CAST(date_diff('second', TIMESTAMP '1970-01-01', dt_sec) AS BIGINT) AS seconds, count(*) AS n
        FROM loan GROUP BY bib_id, mi, dt_sec)""",
        ALL_ORDERS,
    ),
    "win_row_number": with_views(
        """SELECT fake_msisdn, bank_name, month_index, total_sms_count, CAST(row_number() OVER (PARTITION BY fake_msisdn,
        month_index ORDER BY total_sms_count DESC, bank_name) AS INTEGER) AS rank_in_month FROM bank_months""",
        BANK_MONTHS,
    ),
    "win_rank": with_views(
        """SELECT fake_msisdn, bank_name, month_index, total_sms_count, CAST(rank() OVER (PARTITION BY fake_msisdn,
        month_index ORDER BY total_sms_count DESC) AS INTEGER) AS rank FROM bank_months""",
        BANK_MONTHS,
    ),
    "win_sum_running": with_views("SELECT * FROM bank_months", BANK_MONTHS),
    "win_collect_set_sum": with_views(
        """SELECT fake_msisdn, CAST(sum(DISTINCT total_sms_count) AS BIGINT) AS distinct_sum FROM bank_months
        GROUP BY fake_msisdn""",
        BANK_MONTHS,
    ),
    "win_dense_rank": arpu_at("CAST(dense_rank AS INTEGER)", "dense_rank"),
    "win_set_size": arpu_at("CAST(months AS BIGINT)", "count_dense_rank"),
    "win_distinct_list": arpu_at(
        "CAST(count(DISTINCT contract_type) OVER (PARTITION BY fake_msisdn ORDER BY mi) AS INTEGER)",
        "contract_type_count",
    ),
    "win_sum_conditional": arpu_at(
        "(round_even(CAST(sum(CASE WHEN latest THEN sms_revenue END) OVER (PARTITION BY fake_msisdn) AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000) AS sms_latest,"
        " (round_even(CAST(sum(CASE WHEN previous THEN sms_revenue ELSE 0 END) OVER (PARTITION BY fake_msisdn) AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000)",
        "sms_before",
    ),
    "win_first_last": with_views(
        """SELECT DISTINCT fake_msisdn, mi AS month_index, first_value(site_type) OVER w AS first_site,
        last_value(site_type) OVER w AS last_site, first_value(site_type IGNORE NULLS) OVER w AS first_known_site,
        last_value(site_type IGNORE NULLS) OVER w AS last_known_site FROM arpu
        WINDOW w AS (PARTITION BY fake_msisdn ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""
    ),
    "win_sum_partition": with_views("SELECT * FROM travel_days", _TRAVEL_DAYS),
    "travel_bucket": with_views(
        """SELECT *, CASE WHEN total_travel <= 5 THEN '1-5' WHEN total_travel <= 10 THEN '6-10' ELSE '11+' END
        AS travel_bucket FROM travel_days""",
        _TRAVEL_DAYS,
    ),
    "norm_string": with_views(
        f"SELECT bib_id, {g.NORM_NAME} AS name, lower(replace(offering_code, ' ', '')) AS code FROM package",
        ALL_ORDERS,
    ),
    "data_mb": with_views(
        f"SELECT bib_id, offering_name, (round_even(CAST({g.DATA_MB} AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000) AS data_mb FROM package", ALL_ORDERS
    ),
    "vocab_match": with_views(
        f"SELECT fake_msisdn, date, bank_name, array_to_string({g.MATCHED}, ',') AS matched_banks FROM bank"
    ),
    "afternoon_flag": with_views(
        """SELECT bib_id, strftime(recharge_dt, '%Y%m%d %H:%M:%S') AS recharge_dt, (round_even(CAST(amount AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000) AS recharge_value_amt,
        CAST(CASE WHEN amount > 0 AND hour(recharge_dt) > 15 THEN 1 ELSE 0 END AS INTEGER) AS afternoon FROM recharge"""
    ),
    "ratio_null_safe": with_views(
        f"""SELECT fake_msisdn, date, (round_even(CAST({div('outstanding_balance', 'credit_limit + deposit_amt_n')} AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000)
        AS credit_ratio, (round_even(CAST({div('deposit_amt_n', 'credit_limit')} AS DOUBLE) * 1000000 + 0.00001, 0) / 1000000) AS deposit_to_credit_ratio FROM post_paid""",
        ALL_ORDERS,
    ),
    "id_spine": spine(),
    "store_left_joins": store(ALL, False),
    "store_coalesce": store(ALL, True),
    "feature_store": store(ALL, True),
}


def _filled(name: str, only: dict | None = None, *features: str) -> str:
    """Raw features without drop list, with the given defaults (all declared ones if None)."""
    import re

    sql = undropped(name, *features)
    head, tail = sql.rsplit("SELECT ", 1)
    group = GROUPS[name]
    declared = {c: d for _, c, _, _, d in group.columns()} if only is None else only
    for column, default in declared.items():
        filler = f'(SELECT {default}("{column}") FROM joined)' if isinstance(default, str) else default
        tail = re.sub(rf'CAST\("{column}" AS', f'CAST(coalesce("{column}", {filler}) AS', tail)
    return f"{head}SELECT {tail}"


ORACLE["fill_const"] = _filled("LoanAssign")
ORACLE["fill_when_null"] = _filled(
    "LoanAssign", {"mean_time_interval_loan_1": 2592000, "loan_amount_sum_1": 0, "loan_amount_sum_2": 0}
)
ORACLE["fill_query"] = _filled(
    "PostPaid", {"days_since_last_payment_1": "max"}, "days_since_last_payment", "has_payment", "credit_limit_change"
)

for _query, _group in {
    "fg_cdr": "CDR",
    "fg_package": "Package",
    "fg_user_info": "UserInfo",
    "fg_package_purchase_extras": "PackagePurchaseExtras",
    "fg_package_purchase": "PackagePurchase",
    "fg_arpu": "Arpu",
    "fg_handset": "HandsetPrice",
    "fg_bank_info": "BankInfo",
    "fg_recharge": "Recharge",
    "fg_loan_assign": "LoanAssign",
    "fg_loan_rec": "LoanRec",
    "fg_domestic_travel": "DomesticTravel",
    "fg_postpaid": "PostPaid",
    "fg_credit_management": "CreditManagement",
}.items():
    ORACLE[_query] = GROUPS[_group].sql()
