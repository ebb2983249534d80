"""Operator-level queries: sources, filters, measures, joins,
aggregates, first-row flags and set operations, each on whole fixture tables.

Every key pairs a Spark function built from the library's own building blocks
with an independent DuckDB statement over the same test tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart import oracle as O
from salesmart import rules as R
from salesmart.functions import measures as M
from salesmart.operators.first_rows import flag_first_in_group
from salesmart.operators.joins import left_lookup, prefixed
from salesmart.plans import activity, deals
from salesmart.plans.catalog import Inputs
from salesmart.sources.snapshot import key_values_day_filter, snapshot_day_filter

AS_OF = R.DEFAULT_RULES.as_of
LOOKBACK = AS_OF - dt.timedelta(days=2)
A = O.d(AS_OF)
START = "COALESCE(career_start, start_date)"

UNITS: dict[str, tuple[Callable[[Inputs], DataFrame], str | None]] = {}


def unit(key: str, sql: str | None):
    def register(fn: Callable[[Inputs], DataFrame]):
        UNITS[key] = (fn, sql)
        return fn
    return register


def _i(col: str) -> str:
    return f"CAST({col} AS INTEGER)"


# --- 2.1 sources ------------------------------------------------------------------

for _name in ("users", "accounting", "deal", "objects", "bid", "calendar"):
    unit(f"src_{_name}", O.q(f"SELECT * FROM {_name}"))(lambda i, n=_name: getattr(i, n))

unit("src_daily_personnel", O.q("SELECT * FROM daily_personnel"))(lambda i: i.snapshot())

_METRIC_LONG_SQL = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS metric, CAST({key} AS BIGINT) AS person_id, year, month, CAST({value} AS BIGINT) AS value FROM {name}"
    for name, (key, value, _out) in activity.DATED_METRIC_COLUMNS.items()) + "".join(
    f"\nUNION ALL\nSELECT '{name}', responsible_id, NULL, NULL, {value} FROM {rel}"
    for name, (rel, value) in O.STANDING.items())


@unit("src_metrics", O.q(_METRIC_LONG_SQL))
def _src_metrics(i: Inputs) -> DataFrame:
    parts = [i.fx.relation(name).select(F.lit(name).alias("metric"), F.col(key).cast("long").alias("person_id"),
                                        "year", "month", F.col(value).cast("long").alias("value"))
             for name, (key, value, _out) in activity.DATED_METRIC_COLUMNS.items()]
    standing = activity.undated_metrics(i.metrics())
    for name in ("all_objects", *activity.AD_COLUMNS, "avician"):
        parts.append(standing.where(F.col(name).isNotNull()).select(
            F.lit(name).alias("metric"), F.col("id").alias("person_id"), F.lit(None).cast("int").alias("year"),
            F.lit(None).cast("int").alias("month"), F.col(name).cast("long").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# --- 2.2 filters ------------------------------------------------------------------

@unit("flt_snapshot_day", O.q("SELECT date, id, experience FROM daily_personnel WHERE day(date) = 5"))
def _flt_snapshot_day(i: Inputs) -> DataFrame:
    return i.snapshot(snapshot_day_filter()).where(F.dayofmonth("date") == 5).select("date", "id", "experience")


@unit("flt_as_of_day", O.q(f"SELECT date, id, experience FROM daily_personnel WHERE date = {O.d(LOOKBACK)}"))
def _flt_as_of_day(i: Inputs) -> DataFrame:
    day = F.col("date") == F.lit(LOOKBACK)
    return i.snapshot(day).where(day).select("date", "id", "experience")


@unit("flt_closed_company", O.q(f"SELECT id, responsible_id, realization_date FROM accounting "
                                f"WHERE company = {O.HOME} AND status = {O.CLOSED}"))
def _flt_closed_company(i: Inputs) -> DataFrame:
    return i.accounting.where((F.col("company") == R.HOME_COMPANY) & (F.col("status") == R.CLOSED_STATUS)) \
        .select("id", "responsible_id", "realization_date")


@unit("flt_not_rental_office", O.q(f"SELECT id, office FROM accounting WHERE office <> {O.RENTAL}"))
def _flt_not_rental_office(i: Inputs) -> DataFrame:
    return i.accounting.where(F.col("office") != R.RENTAL_OFFICE).select("id", "office")


@unit("flt_in_list", O.q("SELECT id, position FROM users WHERE position IN "
                         "('Эксперт по недвижимости', 'Специалист по недвижимости', 'Специалист отдела коммерческой недвижимости')"))
def _flt_in_list(i: Inputs) -> DataFrame:
    return i.users.where(F.col("position").isin(*R.AGENT_POSITIONS)).select("id", "position")


@unit("flt_not_in_or_null", O.q("SELECT id, contract_name FROM accounting WHERE contract_name NOT IN "
                                "('Договор аренды', 'Эксклюзивный договор аренды помещения') OR contract_name IS NULL"))
def _flt_not_in_or_null(i: Inputs) -> DataFrame:
    c = F.col("contract_name")
    return i.accounting.where(~c.isin(*R.RENTAL_CONTRACT_NAMES) | c.isNull()).select("id", "contract_name")


@unit("flt_like_prefix", O.q("SELECT id, company FROM users WHERE company LIKE 'Города%'"))
def _flt_like_prefix(i: Inputs) -> DataFrame:
    return i.users.where(F.col("company").like(R.COMPANY_FAMILY_PREFIX + "%")).select("id", "company")


@unit("flt_ilike", O.q("SELECT id, company, department FROM users WHERE company ILIKE 'Города%' AND department ILIKE 'Команда%'"))
def _flt_ilike(i: Inputs) -> DataFrame:
    return i.users.where(F.col("company").ilike(R.COMPANY_FAMILY_PREFIX + "%")
                         & F.col("department").ilike(R.SALES_TEAM_PREFIX + "%")).select("id", "company", "department")


@unit("flt_not_ilike", O.q(f"SELECT id, contract_name FROM accounting WHERE contract_name NOT ILIKE {O.RENT_LIKE}"))
def _flt_not_ilike(i: Inputs) -> DataFrame:
    return i.accounting.where(~M.is_rental_text("contract_name")).select("id", "contract_name")


@unit("flt_between_tenure", O.q(f"SELECT id, {_i(O.md(A, START))} AS tenure FROM users "
                                f"WHERE {O.md(A, START)} BETWEEN 7 AND 12"))
def _flt_between_tenure(i: Inputs) -> DataFrame:
    t = M.tenure_months(AS_OF)
    return i.users.where(t.between(7, 12)).select("id", t.alias("tenure"))


@unit("flt_null_tests", O.q("SELECT id, realization_date IS NULL AS undated, deal_id IS NULL AS no_deal FROM accounting "
                            "WHERE realization_date IS NULL OR deal_id IS NULL OR contract_name IS NOT NULL AND status IS NULL"))
def _flt_null_tests(i: Inputs) -> DataFrame:
    a = i.accounting
    keep = F.col("realization_date").isNull() | F.col("deal_id").isNull() | (
        F.col("contract_name").isNotNull() & F.col("status").isNull())
    return a.where(keep).select("id", F.col("realization_date").isNull().alias("undated"),
                                F.col("deal_id").isNull().alias("no_deal"))


@unit("flt_newcomer_month", O.q(f"SELECT a.id AS ata_id, u.id AS user_id FROM accounting a JOIN users u ON a.responsible_id = u.id "
                                f"WHERE {O.md('a.realization_date', 'COALESCE(u.career_start, u.start_date)')} = 0"))
def _flt_newcomer_month(i: Inputs) -> DataFrame:
    u = i.users.select(F.col("id").alias("user_id"), "career_start", "start_date")
    a = i.accounting.select(F.col("id").alias("ata_id"), F.col("responsible_id").alias("user_id"), "realization_date")
    return a.join(u, "user_id").where(M.tenure_months("realization_date") == 0).select("ata_id", "user_id")


@unit("flt_retention", O.q(f"SELECT id, is_active, {_i(f'COALESCE({O.md(A, 'deactivation_date')}, 0)')} AS deactivation_period "
                           f"FROM users WHERE is_active = TRUE OR COALESCE({O.md(A, 'deactivation_date')}, 0) < 5"))
def _flt_retention(i: Inputs) -> DataFrame:
    since = M.months_since("deactivation_date", AS_OF)
    return i.users.where((F.col("is_active") == F.lit(True)) | (since < 5)).select(
        "id", "is_active", since.alias("deactivation_period"))


# --- 2.3 measures ----------------------------------------------------------------

def _users_measure(key: str, spark_col: Callable[[], object], sql_expr: str):
    unit(key, O.q(f"SELECT id, {sql_expr} AS value FROM users"))(lambda i: i.users.select("id", spark_col().alias("value")))


_AGE_SQL = f"CAST(date_part('year', age({A}, birth_date)) AS INTEGER)"
_EXP_SQL = _i(O.md(A, START))
_BDAY = f"birth_date + to_years(CAST(year({A}) - year(birth_date) AS INTEGER))"

_users_measure("m_tenure_months", lambda: M.tenure_months(AS_OF), _EXP_SQL)
_users_measure("m_deactivation_period", lambda: M.months_since("deactivation_date", AS_OF),
               _i(f"COALESCE({O.md(A, 'deactivation_date')}, 0)"))
_users_measure("m_age_decimal", lambda: M.age_decimal("birth_date", AS_OF),
               f"CAST(ROUND(CAST({O.md(A, 'birth_date')} AS DECIMAL(10,0)) / 12, 2) AS DECIMAL(10,2))")
_users_measure("m_age_years", lambda: M.age_years("birth_date", AS_OF), _AGE_SQL)
_users_measure("m_days_to_birthday", lambda: M.days_to_birthday("birth_date", AS_OF),
               f"CAST(CASE WHEN birth_date IS NULL THEN 9999 ELSE datediff('day', {A}, CAST(CASE WHEN CAST({_BDAY} AS DATE) < {A} "
               f"THEN {_BDAY} + INTERVAL 1 YEAR ELSE {_BDAY} END AS DATE)) END AS INTEGER)")
_users_measure("m_age_group", lambda: M.age_group(M.age_years("birth_date", AS_OF)),
               f"CASE WHEN {_AGE_SQL} BETWEEN 18 AND 25 THEN '18–25' WHEN {_AGE_SQL} BETWEEN 26 AND 35 THEN '26–35' "
               f"WHEN {_AGE_SQL} BETWEEN 36 AND 45 THEN '36–45' WHEN {_AGE_SQL} BETWEEN 46 AND 55 THEN '46–55' "
               f"WHEN {_AGE_SQL} >= 56 THEN '56+' ELSE 'Не указан / ошибка' END")
_users_measure("m_exp_group_hr", lambda: M.exp_group_hr(M.tenure_months(AS_OF)),
               f"CASE WHEN {_EXP_SQL} BETWEEN 0 AND 6 THEN '0-6' WHEN {_EXP_SQL} BETWEEN 7 AND 12 THEN '07-12' "
               f"WHEN {_EXP_SQL} BETWEEN 13 AND 24 THEN '13-24' WHEN {_EXP_SQL} >= 25 THEN '25+' END")
_users_measure("m_active_label", lambda: M.active_label("is_active"),
               "CASE WHEN is_active = FALSE THEN 'Уволен' ELSE 'Активен' END")
_users_measure("m_masked_deactivation", lambda: M.masked_deactivation("deactivation_date", "is_active"),
               "CASE WHEN is_active = TRUE THEN NULL ELSE deactivation_date END")


@unit("m_exp_flags", O.q(f"SELECT id, CASE WHEN {_EXP_SQL} >= 3 THEN TRUE ELSE FALSE END AS exp3plus, "
                         f"CASE WHEN {_EXP_SQL} >= 7 THEN TRUE ELSE FALSE END AS exp7plus FROM users"))
def _m_exp_flags(i: Inputs) -> DataFrame:
    t = M.tenure_months(AS_OF)
    return i.users.select("id", M.exp_at_least(t, 3).alias("exp3plus"), M.exp_at_least(t, 7).alias("exp7plus"))


@unit("m_exp_category_rds", O.q("SELECT date, id, CASE WHEN experience > 24 THEN '24+' WHEN experience > 12 AND experience < 25 "
                                "THEN '13-24' WHEN experience > 6 AND experience < 13 THEN '07-12' WHEN experience > 2 AND "
                                "experience < 7 THEN '03-06' ELSE CONCAT('0', CAST(experience AS VARCHAR)) END AS exp_category "
                                "FROM daily_personnel WHERE day(date) = 5"))
def _m_exp_category_rds(i: Inputs) -> DataFrame:
    return i.snapshot(snapshot_day_filter()).where(F.dayofmonth("date") == 5).select(
        "date", "id", M.exp_category_rds("experience").alias("exp_category"))


# Per-person membership of the overlapping head-count buckets (P7's conditions).
def _headcount_sql() -> str:
    flags = ", ".join(f"COALESCE(bool_or(m.label = '{label}'), FALSE) AS b{n}" for n, label in enumerate(O.BUCKETS))
    return O.q(f"SELECT u.id, CAST(ANY_VALUE(f.t) AS VARCHAR) AS month_label, {flags} FROM users u "
               "LEFT JOIN member m ON m.id = u.id LEFT JOIN fresh f ON f.id = u.id "
               f"WHERE u.is_active AND u.company = {O.HOME} GROUP BY u.id", *O.p7_ctes())


@unit("m_headcount_bucket", _headcount_sql())
def _m_headcount_bucket(i: Inputs) -> DataFrame:
    from salesmart.plans.people import _headcount_conditions
    monthly, fixed = _headcount_conditions(i.rules)
    base = i.users.where((F.col("company") == R.HOME_COMPANY) & (F.col("is_active") == F.lit(True))) \
        .withColumn("tenure", M.tenure_months(AS_OF))
    return base.select("id", F.when(monthly, F.col("tenure").cast("string")).alias("month_label"),
                       *[F.coalesce(cond, F.lit(False)).alias(f"b{n}") for n, (cond, _) in enumerate(fixed.values())])


_PT_FROM = ("FROM accounting a LEFT JOIN deal d ON a.deal_id = d.id LEFT JOIN objects o ON d.object_id = o.id "
            "LEFT JOIN bid b ON b.id = d.bid_id")


@unit("m_property_type", O.q(f"SELECT a.id AS ata_id, {O.PROPERTY_TYPE} AS property_type {_PT_FROM}"))
def _m_property_type(i: Inputs) -> DataFrame:
    a = i.accounting.select(F.col("id").alias("ata_id"), "deal_id")
    return deals.with_property_type(a, i.deal, i.objects, i.bid).select("ata_id", "property_type")


@unit("m_deal_category", O.q(
    f"SELECT a.id AS ata_id, CASE WHEN COALESCE({O.PROPERTY_TYPE}, a.contract_name) IS NULL THEN NULL "
    f"WHEN COALESCE({O.PROPERTY_TYPE}, a.contract_name) ILIKE {O.RENT_LIKE} THEN 'Аренда' ELSE 'Продажа' END AS deal_category "
    f"{_PT_FROM}"))
def _m_deal_category(i: Inputs) -> DataFrame:
    a = i.accounting.select(F.col("id").alias("ata_id"), "deal_id", "contract_name")
    typed = deals.with_property_type(a, i.deal, i.objects, i.bid)
    return typed.select("ata_id", M.deal_category(F.coalesce("property_type", "contract_name")).alias("deal_category"))


@unit("m_first_valid_deal", O.q("SELECT user_id, year, month, ata_id, is_first_valid_deal FROM dm", *O.P2_CTES))
def _m_first_valid_deal(i: Inputs) -> DataFrame:
    return i.p2().select("user_id", "year", "month", "ata_id", "is_first_valid_deal")


def _acct_measure(key: str, spark_cols: Callable[[], list], sql_cols: str):
    unit(key, O.q(f"SELECT id, {sql_cols} FROM accounting"))(lambda i: i.accounting.select("id", *spark_cols()))


_acct_measure("m_deal_flag", lambda: [M.deal_flag("contract_name", "status").alias("deal")],
              f"CASE WHEN contract_name ILIKE {O.RENT_LIKE} OR status <> {O.CLOSED} OR status IS NULL THEN 0 ELSE 1 END AS deal")
_acct_measure("m_status_label", lambda: [M.status_label("status").alias("status_label")],
              f"CASE WHEN status = {O.CLOSED} THEN {O.CLOSED} ELSE 'Нет данных' END AS status_label")
_acct_measure("m_contract_label", lambda: [M.contract_label("contract_name", "status").alias("contract_label")],
              f"CASE WHEN contract_name IS NULL AND status = {O.CLOSED} THEN 'Новостройка' WHEN contract_name IS NULL "
              "THEN 'Нет данных' ELSE contract_name END AS contract_label")
_acct_measure("m_default_fills", lambda: [M.fill("contract_id", 1).alias("contract_id"),
                                  M.fill("deal_type", R.NOT_LABELLED).alias("deal_type"),
                                  M.fill("deal_id", 0).alias("deal_id")],
              "COALESCE(contract_id, 1) AS contract_id, COALESCE(deal_type, 'Не размечено') AS deal_type, "
              "COALESCE(deal_id, 0) AS deal_id")

# --- 2.4 joins ----------------------------------------------------------------------

_STAR_PEOPLE = f"SELECT id, {O.month_of('date')} AS ym, {O.MONTH.format('date')}, {O.YEAR.format('date')} FROM daily_personnel WHERE day(date) = 5"
_STAR_SELECT = O.pivoted(_STAR_PEOPLE, ["month", "year", "id"])


@unit("join_metric_star", O.q(_STAR_SELECT, *O.metric_ctes()))
def _join_metric_star(i: Inputs) -> DataFrame:
    people = i.snapshot(snapshot_day_filter()).where(F.dayofmonth("date") == 5).select(
        F.month("date").alias("month"), F.year("date").alias("year"), "id")
    return activity.attach_metrics(people, i.metrics())


@unit("m_all_sum", O.q(f"SELECT month, year, id, all_sum FROM ({_STAR_SELECT}) s", *O.metric_ctes()))
def _m_all_sum(i: Inputs) -> DataFrame:
    return _join_metric_star(i).select("month", "year", "id", "all_sum")


@unit("join_inner_users", O.q("SELECT a.id AS ata_id, u.id AS user_id, u.full_name FROM accounting a JOIN users u ON a.responsible_id = u.id"))
def _join_inner_users(i: Inputs) -> DataFrame:
    u = i.users.select(F.col("id").alias("user_id"), "full_name")
    return i.accounting.select(F.col("id").alias("ata_id"), F.col("responsible_id").alias("user_id")) \
        .join(u, "user_id", "inner").select("ata_id", "user_id", "full_name")


@unit("join_fk_chain", O.q(f"SELECT a.id AS ata_id, d.deal_type, d.developer, o.land_status, o.property_type AS object_type, "
                           f"b.object_type AS bid_type {_PT_FROM}"))
def _join_fk_chain(i: Inputs) -> DataFrame:
    a = i.accounting.select(F.col("id").alias("ata_id"), "deal_id")
    d = prefixed(i.deal.select("id", "object_id", "bid_id", "deal_type", "developer"), "d_")
    o = prefixed(i.objects.select("id", "land_status", "property_type"), "o_")
    b = prefixed(i.bid.select("id", "object_type"), "b_")
    x = left_lookup(a, d, "deal_id", "d_id")
    x = left_lookup(x, o, "d_object_id", "o_id")
    x = left_lookup(x, b, "d_bid_id", "b_id")
    return x.select("ata_id", F.col("d_deal_type").alias("deal_type"), F.col("d_developer").alias("developer"),
                    F.col("o_land_status").alias("land_status"), F.col("o_property_type").alias("object_type"),
                    F.col("b_object_type").alias("bid_type"))


@unit("join_person_month", O.q("SELECT user_id, year, month, ata_id, realization_date, property_type FROM dm", *O.P2_CTES))
def _join_person_month(i: Inputs) -> DataFrame:
    staff = deals.staff_on_snapshot_day(i.snapshot(snapshot_day_filter())) \
        .unionByName(deals.newcomers(i.accounting, i.users)).distinct()
    vd = deals.valid_deals(i.accounting, i.deal, i.objects, i.bid)
    return staff.join(vd, deals.PERSON_MONTH, "left").select(
        "user_id", "year", "month", "ata_id", "realization_date", "property_type")


@unit("join_snapshot_accounting", O.q(
    "SELECT dp.date, dp.id, a.id AS ata_id FROM daily_personnel dp LEFT JOIN accounting a ON dp.id = a.responsible_id "
    "AND month(dp.date) = month(a.realization_date) AND year(dp.date) = year(a.realization_date) WHERE day(dp.date) = 5"))
def _join_snapshot_accounting(i: Inputs) -> DataFrame:
    dp = i.snapshot(snapshot_day_filter()).where(F.dayofmonth("date") == 5).select(
        "date", F.col("id").alias("user_id"), F.year("date").alias("year"), F.month("date").alias("month"))
    recs = activity.dated_records(i.accounting).select("user_id", "year", "month", F.col("id").alias("ata_id"))
    return dp.join(recs, ["user_id", "year", "month"], "left").select("date", F.col("user_id").alias("id"), "ata_id")


@unit("join_left_null_rejected", O.q(f"SELECT a.id AS ata_id, u.id AS user_id FROM accounting a LEFT JOIN users u "
                                     f"ON a.responsible_id = u.id WHERE u.company = {O.HOME}"))
def _join_left_null_rejected(i: Inputs) -> DataFrame:
    u = i.users.select(F.col("id").alias("user_id"), "company")
    a = i.accounting.select(F.col("id").alias("ata_id"), F.col("responsible_id").alias("user_id"))
    return a.join(u, "user_id", "left").where(F.col("company") == R.HOME_COMPANY).select("ata_id", "user_id")


@unit("join_cross_calendar", O.q(f"SELECT c.date, u.id FROM users u CROSS JOIN calendar c "
                                 f"WHERE c.date = {A} AND u.company LIKE 'Города%'"))
def _join_cross_calendar(i: Inputs) -> DataFrame:
    from salesmart.sources.snapshot import company_family
    day = F.col("date") == F.lit(AS_OF)
    people = company_family(i.users).where(i.calendar.where(day).exists())
    return people.select(F.lit(AS_OF).alias("date"), "id")


# --- 2.5 aggregates ---------------------------------------------------------------

@unit("agg_sum_income", O.q("SELECT responsible_id, CAST(SUM(income) AS DECIMAL(28,2)) AS income FROM accounting GROUP BY 1"))
def _agg_sum_income(i: Inputs) -> DataFrame:
    return i.accounting.groupBy("responsible_id").agg(F.sum("income").cast("decimal(28,2)").alias("income"))


@unit("agg_count_col", O.q("SELECT status, COUNT(contract_name) AS named, COUNT(*) AS records FROM accounting GROUP BY 1"))
def _agg_count_col(i: Inputs) -> DataFrame:
    return i.accounting.groupBy("status").agg(F.count("contract_name").alias("named"), F.count(F.lit(1)).alias("records"))


@unit("agg_conditional_sum", O.q(
    f"SELECT responsible_id, CAST(COALESCE(SUM(CASE WHEN status = {O.CLOSED} THEN income ELSE 0 END), 0) AS DECIMAL(28,2)) AS income, "
    f"CAST(SUM(CASE WHEN contract_name ILIKE {O.RENT_LIKE} OR status <> {O.CLOSED} OR status IS NULL THEN 0 ELSE 1 END) AS BIGINT) AS deal "
    "FROM accounting GROUP BY 1"))
def _agg_conditional_sum(i: Inputs) -> DataFrame:
    closed = F.col("status") == R.CLOSED_STATUS
    return i.accounting.groupBy("responsible_id").agg(
        F.coalesce(F.sum(F.when(closed, F.col("income")).otherwise(F.lit(0))), F.lit(0)).cast("decimal(28,2)").alias("income"),
        F.sum(M.deal_flag("contract_name", "status")).cast("long").alias("deal"))


@unit("agg_case_over_sum", O.q(
    f"SELECT responsible_id, status, CAST(CASE WHEN status = {O.CLOSED} THEN SUM(income) ELSE 0 END AS DECIMAL(28,2)) AS income "
    "FROM accounting GROUP BY responsible_id, status"))
def _agg_case_over_sum(i: Inputs) -> DataFrame:
    g = i.accounting.groupBy("responsible_id", "status").agg(F.sum("income").alias("s"))
    return g.select("responsible_id", "status",
                    F.when(F.col("status") == R.CLOSED_STATUS, F.col("s")).otherwise(F.lit(0)).cast("decimal(28,2)").alias("income"))


@unit("agg_avg_cheque", O.q(
    f"SELECT responsible_id, COUNT(contract_name) AS named, CAST(ROUND(SUM(income) / NULLIF(COUNT(contract_name), 0)) AS DECIMAL(28,0)) "
    f"AS avg_income FROM accounting WHERE status = {O.CLOSED} GROUP BY 1"))
def _agg_avg_cheque(i: Inputs) -> DataFrame:
    g = i.accounting.where(F.col("status") == R.CLOSED_STATUS).groupBy("responsible_id").agg(
        F.count("contract_name").alias("named"), F.sum("income").alias("s"))
    avg = F.round(F.try_divide(F.col("s"), F.col("named").cast("decimal(20,0)")), 0).cast("decimal(28,0)")
    return g.select("responsible_id", "named", avg.alias("avg_income"))


@unit("agg_by_expression", O.q(
    f"SELECT {_i('year(realization_date)')} AS year, {_i('month(realization_date)')} AS month, COUNT(id) AS records, "
    "CAST(SUM(income) AS DECIMAL(28,2)) AS income FROM accounting GROUP BY year(realization_date), month(realization_date)"))
def _agg_by_expression(i: Inputs) -> DataFrame:
    return i.accounting.groupBy(F.year("realization_date").alias("year"), F.month("realization_date").alias("month")).agg(
        F.count("id").alias("records"), F.sum("income").cast("decimal(28,2)").alias("income"))


@unit("agg_group_as_distinct", O.q("SELECT department, position FROM daily_personnel WHERE day(date) = 5 GROUP BY department, position"))
def _agg_group_as_distinct(i: Inputs) -> DataFrame:
    # GROUP BY without aggregates is a de-duplication.
    return i.snapshot(snapshot_day_filter()).where(F.dayofmonth("date") == 5).select("department", "position").distinct()


@unit("agg_select_distinct", O.q(
    f"SELECT DISTINCT responsible_id, {_i('year(realization_date)')} AS year, {_i('month(realization_date)')} AS month "
    f"FROM accounting WHERE status = {O.CLOSED}"))
def _agg_select_distinct(i: Inputs) -> DataFrame:
    return i.accounting.where(F.col("status") == R.CLOSED_STATUS).select(
        "responsible_id", F.year("realization_date").alias("year"), F.month("realization_date").alias("month")).distinct()


@unit("agg_two_level", O.q(
    f"SELECT company, CAST(SUM(n) AS BIGINT) AS over_24 FROM (SELECT company, COUNT(id) AS n FROM users "
    f"WHERE {O.md(A, START)} > 24 GROUP BY company, {O.md(A, START)}) base GROUP BY company"))
def _agg_two_level(i: Inputs) -> DataFrame:
    over = M.tenure_months(AS_OF) > 24
    return i.users.where(over).groupBy("company").agg(F.sum(F.when(over, 1)).cast("long").alias("over_24"))


@unit("agg_global_count", O.q(f"SELECT COUNT(id) AS users_count FROM users WHERE company = {O.HOME} AND is_active = TRUE "
                              f"AND office <> {O.RENTAL} AND position = 'Менеджер отдела продаж'"))
def _agg_global_count(i: Inputs) -> DataFrame:
    """Global COUNT without GROUP BY: always one row (0 on an empty selection)."""
    cond = ((F.col("company") == R.HOME_COMPANY) & (F.col("is_active") == F.lit(True))
            & (F.col("office") != R.RENTAL_OFFICE) & (F.col("position") == R.SALES_MANAGER_POSITION))
    return i.users.agg(F.count(F.when(cond, F.col("id"))).alias("users_count"))


@unit("agg_by_text_tenure", O.q(f"SELECT CAST({_EXP_SQL} AS VARCHAR) AS exp, COUNT(id) AS users_count FROM users "
                                f"WHERE company = {O.HOME} GROUP BY 1"))
def _agg_by_text_tenure(i: Inputs) -> DataFrame:
    return i.users.where(F.col("company") == R.HOME_COMPANY).groupBy(
        M.tenure_months(AS_OF).cast("string").alias("exp")).agg(F.count("id").alias("users_count"))


# --- 2.6 first-row flags -----------------------------------------------------------

@unit("win_first_deal", O.q(
    f"SELECT responsible_id AS user_id, id AS ata_id, CASE WHEN ROW_NUMBER() OVER (PARTITION BY year(realization_date), "
    "month(realization_date), responsible_id ORDER BY realization_date NULLS LAST, id NULLS LAST) = 1 THEN 1 ELSE 0 END AS is_first "
    f"FROM accounting WHERE company = {O.HOME} AND office <> {O.RENTAL} AND status = {O.CLOSED} AND realization_date IS NOT NULL"))
def _win_first_deal(i: Inputs) -> DataFrame:
    recs = deals.home_sales_records(i.accounting).select(
        F.col("responsible_id").alias("user_id"), F.year("realization_date").alias("year"),
        F.month("realization_date").alias("month"), "realization_date", F.col("id").alias("ata_id"))
    return flag_first_in_group(recs, ["user_id", "year", "month"], ["realization_date", "ata_id"], "is_first") \
        .select("user_id", "ata_id", "is_first")


@unit("win_first_occurrence", O.q("SELECT month, year, user_id, ata_id, is_first_occurrence FROM arm_a", *O.P4_CTES))
def _win_first_occurrence(i: Inputs) -> DataFrame:
    return activity.traffic_arm_snapshot(i.snapshot(snapshot_day_filter()), i.accounting).select(
        "month", "year", "user_id", "ata_id", "is_first_occurrence")


@unit("win_global_first", O.q("SELECT user_id, realization_date, ata_id, is_first_occurrence FROM arm_b", *O.P4_CTES))
def _win_global_first(i: Inputs) -> DataFrame:
    return activity.traffic_arm_newcomers(i.accounting, i.users).select(
        "user_id", "realization_date", "ata_id", "is_first_occurrence")


# --- 2.8 set operations ----------------------------------------------------------

@unit("set_union_staff", O.q("SELECT * EXCLUDE (ym) FROM crew", *O.P2_CTES))
def _set_union_staff(i: Inputs) -> DataFrame:
    return deals.staff_on_snapshot_day(i.snapshot(snapshot_day_filter())) \
        .unionByName(deals.newcomers(i.accounting, i.users)).distinct()


def _or_rewrite_sql() -> str:
    cols = (f"{_i('month(dp.date)')} AS month, {_i('year(dp.date)')} AS year, dp.id, dp.full_name, dp.department, "
            f"dp.position, {_i(O.md('dp.date', 'dp.career_start'))} AS experience")
    return O.q(f"SELECT {cols} FROM daily_personnel dp WHERE day(dp.date) = 5 AND dp.experience > 0 UNION "
               f"SELECT {cols} FROM daily_personnel dp WHERE {O.md(A, 'dp.career_start')} = 0 AND dp.date = {O.d(LOOKBACK)}")


@unit("set_union_or_rewrite", _or_rewrite_sql())
def _set_union_or_rewrite(i: Inputs) -> DataFrame:
    return activity.key_value_people(i.snapshot(key_values_day_filter()))


@unit("set_union_traffic", O.q("SELECT DISTINCT month, year, user_id, full_name, ata_id FROM traffic", *O.P4_CTES))
def _set_union_traffic(i: Inputs) -> DataFrame:
    return i.p4().select("month", "year", "user_id", "full_name", "ata_id").distinct()
