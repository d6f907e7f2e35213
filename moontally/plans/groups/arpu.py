"""Revenue and subscriber profile per month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moontally.functions.scalars import flag, ratio
from moontally.operators.rows import distinct_rows, na_fill
from moontally.operators.windows import MonthWindow
from moontally.plans.spec import Feature, FeatureGroup, FeatureJob
from moontally.sources.snapshots import read_table

KEY = "fake_msisdn"
# Site types reported one by one, and the two grouped lists.
SITES = ("Airport", "Industrial Area", "Island", "Oil Platform", "Port", "Touristic Area", "USO", "University")
ROAD_VILLAGE = ("Road", "Road - Village", "Village", "Multi Villages", "Small City", "Residential Area")
LARGE_CITY = ("Capital City", "Main City", "Middle City")

SITE_CODES = {site: code for code, site in enumerate((*SITES, *ROAD_VILLAGE, *LARGE_CITY), start=1)}
SITE_BASE = 32  # above every code


def rows(source, job: FeatureJob, max_range: int) -> DataFrame:
    accounts = read_table(source, "arpu", *job.months(max_range)).drop("date_key")
    filled = distinct_rows(na_fill(accounts))
    return filled.withColumns({
        "site_code": _dated(site_code(), SITE_BASE),
        "female": _dated(flag(F.col("gender") == "F"), 2),
        "type_n": _dated(flag(F.col("contract_type") == "N"), 2),
    })


# First and last row of a key are taken by date; rows of one date resolve to the least
# (first) or greatest (last) code.  Date and code share one number, so that the
# aggregate stays a plain integer min / max.


def _dated(code: Column, base: int) -> Column:
    return F.unix_date(F.col("date")).cast("long") * base + code


def first_code(w: MonthWindow, dated: str, base: int) -> Column:
    return w.min(dated) % base


def last_code(w: MonthWindow, dated: str, base: int) -> Column:
    return w.max(dated) % base


def site_code() -> Column:
    """Position in the list of known sites, 0 for any other."""
    known = F.array(*[F.lit(site) for site in SITE_CODES])
    return F.coalesce(F.array_position(known, F.col("site_type")), F.lit(0))


def first_site(site: str):
    return lambda w: flag(first_code(w, "site_code", SITE_BASE) == SITE_CODES[site])


def last_site_among(sites: tuple[str, ...]):
    return lambda w: flag(last_code(w, "site_code", SITE_BASE).isin(*[SITE_CODES[s] for s in sites]))


def contract_type(w: MonthWindow) -> Column:
    return F.when(w.distinct("contract_type") == 2, 1).otherwise(last_code(w, "type_n", 2))


def _halves(w: MonthWindow) -> tuple[MonthWindow, MonthWindow]:
    return MonthWindow(w.target - 1, 1), MonthWindow(w.target, 1)


def change(measure: str):
    """Latest month over the month before, minus one; NULL without two months."""

    def formula(w: MonthWindow) -> Column:
        before, latest = _halves(w)
        both = (before.rows() > 0) & (latest.rows() > 0)
        return F.when(both, ratio(latest.sum(measure), before.sum(measure)) - 1.0)

    return formula


def score_change(w: MonthWindow) -> Column:
    """Last score of the latest month over last score of the month before, minus one."""
    before, latest = _halves(w)
    last_score = lambda half: F.max_by(half.only("res_com_score"), half.only("date"))
    return ratio(last_score(latest), last_score(before)) - 1.0


def _revenue(name: str) -> Feature:
    return Feature(name, "double", lambda w: w.sum(name))


GROUP = FeatureGroup(
    name="Arpu",
    table="arpu",
    key=KEY,
    rows=rows,
    features=(
        _revenue("sms_revenue"),
        _revenue("subscription_revenue"),
        Feature("age", "double", lambda w: w.max("age"), ranges=(2,), default=F.avg),
        _revenue("voice_revenue"),
        Feature("contract_type", "int", contract_type, ranges=(1,)),
        _revenue("gprs_revenue"),
        Feature(
            "prepaid_to_postpaid", "int", lambda w: flag(w.distinct("contract_type") == 2), ranges=(1,)
        ),
        Feature("res_com_score", "double", lambda w: w.max("res_com_score")),
        Feature("gender", "int", lambda w: last_code(w, "female", 2), ranges=(2,)),
        Feature("site__large_city", "int", last_site_among(LARGE_CITY), ranges=(2,)),
        Feature("gprs_revenue_change", "double", change("gprs_revenue"), ranges=(2,), lengths=(2,)),
        Feature("site__USO", "int", first_site("USO"), ranges=(2,)),
        Feature("site__Port", "int", first_site("Port"), ranges=(2,)),
        Feature("site__Oil Platform", "int", first_site("Oil Platform"), ranges=(2,)),
        Feature("voice_revenue_change", "double", change("voice_revenue"), ranges=(2,), lengths=(2,)),
        Feature("site__Industrial Area", "int", first_site("Industrial Area"), ranges=(2,)),
        Feature("site__Touristic Area", "int", first_site("Touristic Area"), ranges=(2,)),
        Feature("site__Island", "int", first_site("Island"), ranges=(2,)),
        Feature("sms_revenue_change", "double", change("sms_revenue"), ranges=(2,), lengths=(2,)),
        Feature("site__Airport", "int", first_site("Airport"), ranges=(2,)),
        Feature("site__road_village", "int", last_site_among(ROAD_VILLAGE), ranges=(2,)),
        Feature("site__University", "int", first_site("University"), ranges=(2,)),
    ),
    optional=(Feature("res_com_score_change", "double", score_change, ranges=(2,), lengths=(2,)),),
)

# The group's columns in the feature store, store name -> own name, in store order.
STORE_COLUMNS = {
    "sms_revenue_first_1": "sms_revenue_1",
    "subscription_revenue_first_1": "subscription_revenue_1",
    "age_1": "age_2",
    "voice_revenue_first_1": "voice_revenue_1",
    "contract_type_1": "contract_type_1",
    "gprs_revenue_first_1": "gprs_revenue_1",
    "prepaid_to_postpaid_1": "prepaid_to_postpaid_1",
    "res_com_score_first_1": "res_com_score_1",
    "gender_1": "gender_2",
    "site__large_city_2": "site__large_city_2",
    "gprs_revenue_change_2": "gprs_revenue_change_2",
    "site__USO_2": "site__USO_2",
    "site__Port_2": "site__Port_2",
    "site__Oil Platform_2": "site__Oil Platform_2",
    "voice_revenue_change_2": "voice_revenue_change_2",
    "subscription_revenue_second_2": "subscription_revenue_2",
    "voice_revenue_second_2": "voice_revenue_2",
    "site__Industrial Area_2": "site__Industrial Area_2",
    "site__Touristic Area_2": "site__Touristic Area_2",
    "site__Island_2": "site__Island_2",
    "sms_revenue_change_2": "sms_revenue_change_2",
    "site__Airport_2": "site__Airport_2",
    "sms_revenue_second_2": "sms_revenue_2",
    "gprs_revenue_second_2": "gprs_revenue_2",
    "site__road_village_2": "site__road_village_2",
    "site__University_2": "site__University_2",
}
