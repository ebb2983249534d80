"""Upsert sinks as queries: the mart tables after one refresh.

The old target is the mart computed on an earlier state of the inputs
(records before 2000-01-01, staff hired before 1999-01-01, or an earlier run
date); the source is the mart on the full inputs.  Each query returns the
target after the upsert, computed with ``operators.upsert.merge`` (a full
outer join on the NULL-safe conflict key).  The file write path
(``upsert_table``) is exercised by the tests.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart import oracle as O
from salesmart.operators.upsert import ACTION, insert_if_absent, merge
from salesmart.plans.catalog import Inputs
from salesmart.plans.units import unit
from salesmart.rules import Rules
from salesmart.sources.snapshot import daily_personnel_history

CUTOFF = dt.date(2000, 1, 1)
HIRED_BEFORE = dt.date(1999, 1, 1)
EARLIER_RUN = dt.date(2000, 1, 20)

# target -> (conflict key, columns updated on conflict; None = every non-key column)
KEYS = {
    "daily_personnel": (["date", "id"], None),
    "dm_sales_staff_deals": (["user_id", "year", "month", "ata_id"], None),
    "sales_staff_agg_income": (["year", "month", "full_name", "property_type", "department", "position"],
                               ["deal_category", "deal_count", "deal_income", "avg_income"]),
    "traffic_light_1m": (["month", "year", "user_id", "ata_id"], None),
    "rds_on_5th_day": (["month", "year", "user_id", "status"], None),
    "key_values": (["month", "year", "id"], None),
    "operational_headcount_report": (["date", "exp"], ["users_count"]),
    "operational_sales_report": (["realization_date", "property_type"], ["income", "deals_count"]),
    "hr_employee_analytics": (["id"], None),
}


def merge_sql(old_sql: str, new_sql: str, columns: list[str], keys: list[str], update: list[str] | None,
              counts: bool = False) -> str:
    upd = [c for c in columns if c not in keys] if update is None else update
    on = " AND ".join(f"t.{k} IS NOT DISTINCT FROM s.{k}" for k in keys)
    if counts:
        sel = ("CAST(SUM(CASE WHEN s._p AND t._p IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS inserted, "
               "CAST(SUM(CASE WHEN s._p AND t._p THEN 1 ELSE 0 END) AS BIGINT) AS updated, "
               "CAST(SUM(CASE WHEN s._p IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS kept, "
               "CAST(SUM(CASE WHEN s._p THEN 1 ELSE 0 END) AS BIGINT) AS row_count")
    else:
        sel = ", ".join(
            f"CASE WHEN s._p THEN s.{c} ELSE t.{c} END AS {c}" if (c in keys or c in upd)
            else f"CASE WHEN t._p THEN t.{c} ELSE s.{c} END AS {c}" for c in columns)
    return (f"WITH t AS (SELECT *, TRUE AS _p FROM ({old_sql}) x), s AS (SELECT *, TRUE AS _p FROM ({new_sql}) y) "
            f"SELECT {sel} FROM t FULL OUTER JOIN s ON {on}")


OLD_ACCOUNTING = O.base_ctes(accounting_before=CUTOFF)
OLD_USERS = O.base_ctes(users_hired_before=HIRED_BEFORE)
OLD_RUN = O.base_ctes(as_of=EARLIER_RUN)

P1_COLS = ["date", "id", "full_name", "company", "department", "position", "career_start", "office", "is_active",
           "deactivation_date", "deactivation_period", "experience", "gender", "birth_date", "age"]
P2_COLS = ["year", "month", "user_id", "full_name", "department", "position", "is_active", "experience", "company",
           "realization_date", "income", "ata_id", "property_type", "deal_category", "is_first_valid_deal"]
P3_COLS = ["year", "month", "full_name", "department", "position", "company", "property_type", "deal_category",
           "deal_count", "deal_income", "avg_income"]
P4_COLS = ["month", "year", "user_id", "full_name", "department", "position", "is_active", "experience", "ata_id",
           "status", "realization_date", "contract_id", "contract_name", "deal_type", "income", "payment", "deal",
           "is_first_occurrence"]
P5_COLS = ["month", "year", "user_id", "full_name", "department", "position", "is_active", "experience",
           "exp_category", "status", "income", "deal"]
P6_COLS = ["month", "year", "id", "full_name", "department", "position", "experience", "nvstr", "exclusives", "deals",
           "mortgage_leads", "mortgage_consult", "all_objects", "new_objects", "cost_change_count", "bids", "ads_count",
           "avito_count", "cian_count", "yandex_count", "domclick_count", "all_sum", "avician"]
P7_COLS = ["date", "users_count", "exp"]
P8_COLS = ["realization_date", "property_type", "income", "deals_count"]
P9_COLS = ["id", "full_name", "company", "office", "department", "position", "birth_date", "age", "gender",
           "career_start", "experience", "is_active", "deactivation_date", "age_group", "exp_group", "exp3plus",
           "exp7plus", "days_to_birthday"]

_DP_OLD_DAYS = f"date IN ({O.d(O.AS_OF - dt.timedelta(days=2))}, {O.d(O.AS_OF)})"


def _old_dp(i: Inputs) -> DataFrame:
    days = F.col("date").isin(O.AS_OF - dt.timedelta(days=2), O.AS_OF)
    return daily_personnel_history(i.users, i.fx.presence, i.rules, days)


def _merge(target: str, old: DataFrame, new: DataFrame, with_action: bool = False) -> DataFrame:
    keys, update = KEYS[target]
    return merge(old, new, keys, update, with_action=with_action)


def _sql(target: str, old_sql: str, new_sql: str, cols: list[str], counts: bool = False) -> str:
    keys, update = KEYS[target]
    return merge_sql(old_sql, new_sql, cols, keys, update, counts)


def _old(spark_i: Inputs, **kw) -> Inputs:
    return Inputs(spark_i.fx.spark, spark_i.fx.sf_dir, **kw)


@unit("upsert_daily_personnel", _sql("daily_personnel", O.q(f"SELECT * FROM daily_personnel WHERE {_DP_OLD_DAYS}"),
                                     O.q(O.p1_sql()), P1_COLS))
def _k1(i: Inputs) -> DataFrame:
    return _merge("daily_personnel", _old_dp(i), i.p1())


_P2_OLD = O.q("SELECT * FROM dm", *O.P2_CTES, base=OLD_ACCOUNTING)
_P2_NEW = O.q("SELECT * FROM dm", *O.P2_CTES)


@unit("upsert_dm_deals", _sql("dm_sales_staff_deals", _P2_OLD, f"SELECT * FROM ({_P2_NEW}) n WHERE ata_id IS NOT NULL", P2_COLS))
def _k2(i: Inputs) -> DataFrame:
    old = _old(i, accounting_before=CUTOFF).p2()
    return _merge("dm_sales_staff_deals", old, i.p2().where(F.col("ata_id").isNotNull()))


# Old target of the insert-if-absent step: the mart as it was with the staff hired before 1999.
_P2_OLD_STAFF = O.q("SELECT * FROM dm", *O.P2_CTES, base=OLD_USERS)
_ABSENT_SQL = (f"SELECT n.* FROM ({_P2_NEW}) n WHERE n.ata_id IS NULL AND NOT EXISTS (SELECT 1 FROM ({_P2_OLD_STAFF}) e "
               "WHERE e.user_id = n.user_id AND e.year = n.year AND e.month = n.month AND e.ata_id IS NULL)")


@unit("join_anti_absent", _ABSENT_SQL)
def _j9(i: Inputs) -> DataFrame:
    old = _old(i, users_hired_before=HIRED_BEFORE).p2().where(F.col("ata_id").isNull()).select("user_id", "year", "month")
    empty = i.p2().where(F.col("ata_id").isNull())
    return empty.join(old, ["user_id", "year", "month"], "left_anti")


@unit("insert_if_absent_dm", f"SELECT * FROM ({_P2_OLD_STAFF}) o UNION ALL {_ABSENT_SQL}")
def _k10(i: Inputs) -> DataFrame:
    old = _old(i, users_hired_before=HIRED_BEFORE).p2()
    return insert_if_absent(old, i.p2().where(F.col("ata_id").isNull()), ["user_id", "year", "month"],
                            absent_when=F.col("ata_id").isNull())


@unit("upsert_agg_income", _sql("sales_staff_agg_income", O.q(O.P3_SELECT, *O.P2_CTES, base=OLD_ACCOUNTING),
                                O.q(O.P3_SELECT, *O.P2_CTES), P3_COLS))
def _k3(i: Inputs) -> DataFrame:
    return _merge("sales_staff_agg_income", _old(i, accounting_before=CUTOFF).p3(), i.p3())


@unit("upsert_traffic", _sql("traffic_light_1m", O.q(O.P4_SELECT, *O.P4_CTES, base=OLD_ACCOUNTING),
                             O.q(O.P4_SELECT, *O.P4_CTES), P4_COLS))
def _k4(i: Inputs) -> DataFrame:
    return _merge("traffic_light_1m", _old(i, accounting_before=CUTOFF).p4(), i.p4())


@unit("upsert_rds", _sql("rds_on_5th_day", O.q(O.P5_SELECT, *O.P5_CTES, base=OLD_ACCOUNTING),
                         O.q(O.P5_SELECT, *O.P5_CTES), P5_COLS))
def _k5(i: Inputs) -> DataFrame:
    return _merge("rds_on_5th_day", _old(i, accounting_before=CUTOFF).p5(), i.p5())


_P6_OLD = O.q(O.P6_SELECT, *O.p6_ctes(EARLIER_RUN), base=OLD_RUN)
_P6_NEW = O.q(O.P6_SELECT, *O.p6_ctes())


def _k6_frames(i: Inputs) -> tuple[DataFrame, DataFrame]:
    return _old(i, rules=Rules(as_of=EARLIER_RUN)).p6(), i.p6()


@unit("upsert_key_values", _sql("key_values", _P6_OLD, _P6_NEW, P6_COLS))
def _k6(i: Inputs) -> DataFrame:
    return _merge("key_values", *_k6_frames(i))


@unit("upsert_row_count", _sql("key_values", _P6_OLD, _P6_NEW, P6_COLS, counts=True))
def _k11(i: Inputs) -> DataFrame:
    """Rows affected by the key-values upsert (inserted + updated), as the refresh reports it."""
    merged = _merge("key_values", *_k6_frames(i), with_action=True)
    a = F.col(ACTION)
    return merged.agg(
        F.count(F.when(a == "inserted", 1)).alias("inserted"), F.count(F.when(a == "updated", 1)).alias("updated"),
        F.count(F.when(a == "kept", 1)).alias("kept"), F.count(F.when(a != "kept", 1)).alias("row_count"))


@unit("upsert_headcount", _sql("operational_headcount_report", O.p7_sql(base=OLD_USERS), O.p7_sql(), P7_COLS))
def _k7(i: Inputs) -> DataFrame:
    return _merge("operational_headcount_report", _old(i, users_hired_before=HIRED_BEFORE).p7(), i.p7())


@unit("upsert_sales", _sql("operational_sales_report", O.q(O.P8_SELECT, base=OLD_ACCOUNTING), O.q(O.P8_SELECT), P8_COLS))
def _k8(i: Inputs) -> DataFrame:
    return _merge("operational_sales_report", _old(i, accounting_before=CUTOFF).p8(), i.p8())


@unit("upsert_hr", _sql("hr_employee_analytics", O.p9_sql(base=OLD_USERS), O.p9_sql(), P9_COLS))
def _k9(i: Inputs) -> DataFrame:
    return _merge("hr_employee_analytics", _old(i, users_hired_before=HIRED_BEFORE).p9(), i.p9())


# --- README-level features: drill-down, row-level security, incremental sync ---------

@unit("row_level_filter", O.q(
    f"SELECT * FROM ({O.P3_SELECT}) WHERE department IN (SELECT department FROM users WHERE position = 'Руководитель')",
    *O.P2_CTES))
def _r2(i: Inputs) -> DataFrame:
    from salesmart.plans.access import department_heads, row_level_filter
    heads = department_heads(i.users)
    return row_level_filter(i.p3(), heads, viewers=heads.select("viewer_id"))


_DRILL_ON = " AND ".join(f"k.{c} IS NOT DISTINCT FROM d.{c}" for c in
                         ["year", "month", "full_name", "department", "position", "company", "property_type", "deal_category"])


@unit("drilldown_kpi_to_deals", O.q(
    "SELECT k.year, k.month, k.full_name, k.department, k.position, k.company, k.property_type, k.deal_category, "
    "k.deal_count, k.deal_income, d.user_id, d.ata_id, d.realization_date, d.income "
    f"FROM ({O.P3_SELECT}) k JOIN dm d ON {_DRILL_ON}", *O.P2_CTES))
def _r3(i: Inputs) -> DataFrame:
    from salesmart.plans.access import drilldown
    from salesmart.plans.deals import sales_staff_agg_income
    p2 = i.p2()
    return drilldown(sales_staff_agg_income(p2), p2)


_INC_SQL = (_sql("dm_sales_staff_deals", _P2_OLD, f"SELECT * FROM ({_P2_NEW}) n WHERE ata_id IS NOT NULL", P2_COLS)
            + f" UNION ALL SELECT n.* FROM ({_P2_NEW}) n WHERE n.ata_id IS NULL AND NOT EXISTS (SELECT 1 FROM ({_P2_OLD}) e "
            "WHERE e.user_id = n.user_id AND e.year = n.year AND e.month = n.month AND e.ata_id IS NULL)")


@unit("inc_refresh_deals", _INC_SQL)
def _r1(i: Inputs) -> DataFrame:
    """Target after an incremental refresh: mart on records before the cut-off, then the later records
    arrive as a file stream in several micro-batches.  Must equal the full refresh (K2 + K10)."""
    from salesmart.plans.deals import DM_DEALS_COLUMNS, dm_sales_staff_deals
    from salesmart.operators.versioned import publish, read_table
    from salesmart.sources.snapshot import snapshot_day_filter
    from salesmart.streaming.incremental import run_incremental_refresh, scratch_folder

    spark = i.fx.spark
    records = i.accounting
    date = F.col("realization_date")
    base = records.where(date.isNull() | (date < F.lit(CUTOFF)))
    landed = records.where(date >= F.lit(CUTOFF))
    root = scratch_folder(spark, "inc-refresh")
    landing, staging, target, ckpt = (f"{root}/{n}" for n in ("landing", "staging", "target", "stream-checkpoint"))
    landed.write.parquet(landing)
    snapshot = i.snapshot(snapshot_day_filter(i.rules))

    def mart_for(recs: DataFrame, touched: DataFrame | None) -> DataFrame:
        return dm_sales_staff_deals(snapshot, i.users, recs, i.fx.deal, i.fx.objects, i.fx.bid, i.rules, only=touched)

    publish(spark, target, mart_for(base, None), ["year", "month"])
    run_incremental_refresh(spark, landing, records.schema, base, staging, target, ckpt, mart_for)
    return read_table(spark, target).select(*DM_DEALS_COLUMNS)


@unit("inc_refresh_rds", _sql("rds_on_5th_day", O.q(O.P5_SELECT, *O.P5_CTES, base=OLD_ACCOUNTING),
                              O.q(O.P5_SELECT, *O.P5_CTES), P5_COLS))
def _r1_rds(i: Inputs) -> DataFrame:
    """The 5th-day report refreshed incrementally from the same file stream; must equal its full upsert (K5)."""
    from salesmart.plans.activity import RDS_COLUMNS, rds_on_5th_day
    from salesmart.operators.versioned import publish, read_table
    from salesmart.sources.snapshot import snapshot_day_filter
    from salesmart.streaming.incremental import run_incremental_refresh, scratch_folder, upsert_on

    spark = i.fx.spark
    records = i.accounting
    date = F.col("realization_date")
    base = records.where(date.isNull() | (date < F.lit(CUTOFF)))
    landed = records.where(date >= F.lit(CUTOFF))
    root = scratch_folder(spark, "inc-refresh-rds")
    landing, staging, target, ckpt = (f"{root}/{n}" for n in ("landing", "staging", "target", "stream-checkpoint"))
    landed.write.parquet(landing)
    snapshot = i.snapshot(snapshot_day_filter(i.rules))

    def mart_for(recs: DataFrame, touched: DataFrame | None) -> DataFrame:
        return rds_on_5th_day(snapshot, recs, i.rules, only=touched)

    publish(spark, target, mart_for(base, None), ["year", "month"])
    run_incremental_refresh(spark, landing, records.schema, base, staging, target, ckpt, mart_for,
                            apply=upsert_on(KEYS["rds_on_5th_day"][0]))
    return read_table(spark, target).select(*RDS_COLUMNS)
