"""The refresh jobs: compute a mart and upsert it into its stored table.

One function per refresh of the source system, same name, same effect:
read the inputs (and the stored snapshot / deal mart where the source system
does), compute the mart, and upsert it into a parquet table under the
warehouse root, rewriting only the partitions it touches.  An orchestrator
runs them in dependency order (``refresh_all``): personnel first, then the
deal mart, then its aggregate, then the rest.

Table layout (partition columns chosen so that each refresh rewrites few):
daily_personnel and the head count by date; the monthly marts by (year, month);
the sales report and HR tables unpartitioned (aggregates bounded by dates x
types and by people: small, written anew as a whole). Every write is published
in one step (``operators.versioned``).
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.upsert import UpsertResult, check_unique, rewrite_partitions, upsert_table
from salesmart.operators.versioned import read_table
from salesmart.plans import activity, deals, people
from salesmart.rules import Rules
from salesmart.streaming.incremental import apply_refresh

# table -> (conflict key, partition columns, update columns or None for all non-key columns)
TABLES = {
    "daily_personnel": (["date", "id"], ["date"], None),
    "dm_sales_staff_deals": (["user_id", "year", "month", "ata_id"], ["year", "month"], None),
    "sales_staff_agg_income": (["year", "month", "full_name", "property_type", "department", "position"],
                               ["year", "month"], ["deal_category", "deal_count", "deal_income", "avg_income"]),
    "traffic_light_1m": (["month", "year", "user_id", "ata_id"], ["year", "month"], None),
    "rds_on_5th_day": (["month", "year", "user_id", "status"], ["year", "month"], None),
    "key_values": (["month", "year", "id"], ["year", "month"], None),
    "operational_headcount_report": (["date", "exp"], ["date"], ["users_count"]),
    "operational_sales_report": (["realization_date", "property_type"], [], ["income", "deals_count"]),
    "hr_employee_analytics": (["id"], [], None),
}


@dataclass
class Warehouse:
    """Folder of mart tables (shared storage on a cluster)."""

    root: str

    def path(self, table: str) -> str:
        return os.path.join(self.root, table)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        return read_table(spark, self.path(table))


@dataclass
class Staging:
    """The staging relations a refresh reads."""

    users: DataFrame
    calendar: DataFrame
    accounting: DataFrame
    deal: DataFrame
    objects: DataFrame
    bid: DataFrame
    metrics: dict[str, DataFrame]


def _upsert(spark: SparkSession, wh: Warehouse, table: str, rows: DataFrame) -> UpsertResult:
    keys, parts, update = TABLES[table]
    return upsert_table(spark, wh.path(table), rows, keys, parts, update)


def update_daily_personnel(spark: SparkSession, wh: Warehouse, st: Staging, rules: Rules) -> UpsertResult:
    return _upsert(spark, wh, "daily_personnel", people.daily_personnel(st.users, st.calendar, rules))


def _snapshot(spark: SparkSession, wh: Warehouse) -> DataFrame:
    """The stored snapshot; readers' day filters become partition filters on ``date``."""
    return wh.read(spark, "daily_personnel")


def refresh_dm_sales_staff_deals(spark: SparkSession, wh: Warehouse, st: Staging,
                                 rules: Rules) -> int:
    """Deal rows are upserted, empty person-month rows inserted where absent; returns partitions rewritten."""
    fresh = deals.dm_sales_staff_deals(_snapshot(spark, wh), st.users, st.accounting, st.deal, st.objects, st.bid,
                                       rules)
    keys, parts, _ = TABLES["dm_sales_staff_deals"]
    return rewrite_partitions(spark, wh.path("dm_sales_staff_deals"), fresh, apply_refresh, parts,
                              check=lambda rows: check_unique(rows.where(F.col("ata_id").isNotNull()), keys))


def refresh_sales_staff_agg_income(spark: SparkSession, wh: Warehouse) -> UpsertResult:
    return _upsert(spark, wh, "sales_staff_agg_income",
                   deals.sales_staff_agg_income(wh.read(spark, "dm_sales_staff_deals")))


def update_traffic_light_1m(spark: SparkSession, wh: Warehouse, st: Staging, rules: Rules) -> UpsertResult:
    return _upsert(spark, wh, "traffic_light_1m",
                   activity.traffic_light_1m(_snapshot(spark, wh), st.accounting, st.users, rules))


def update_rds_on_5th_day(spark: SparkSession, wh: Warehouse, st: Staging, rules: Rules) -> UpsertResult:
    return _upsert(spark, wh, "rds_on_5th_day", activity.rds_on_5th_day(_snapshot(spark, wh), st.accounting, rules))


def update_key_values(spark: SparkSession, wh: Warehouse, st: Staging, rules: Rules) -> int:
    """Returns the number of rows inserted or updated, as the source system's refresh does."""
    return _upsert(spark, wh, "key_values", activity.key_values(_snapshot(spark, wh), st.metrics, rules)).row_count


def update_operational_headcount(spark: SparkSession, wh: Warehouse, st: Staging,
                                 rules: Rules) -> UpsertResult:
    return _upsert(spark, wh, "operational_headcount_report", people.operational_headcount(st.users, rules))


def update_operational_sales_report(spark: SparkSession, wh: Warehouse, st: Staging,
                                    rules: Rules) -> UpsertResult:
    return _upsert(spark, wh, "operational_sales_report",
                   deals.operational_sales_report(st.accounting, st.deal, st.objects, st.users, st.bid, rules))


def update_hr_employee_analytics(spark: SparkSession, wh: Warehouse, st: Staging,
                                 rules: Rules) -> UpsertResult:
    return _upsert(spark, wh, "hr_employee_analytics", people.hr_employee_analytics(st.users, rules))


def refresh_all(spark: SparkSession, wh: Warehouse, st: Staging, rules: Rules) -> dict:
    """All refreshes in dependency order: snapshot, deal mart, its aggregate, then the independent marts."""
    out = {"daily_personnel": update_daily_personnel(spark, wh, st, rules)}
    out["dm_sales_staff_deals"] = refresh_dm_sales_staff_deals(spark, wh, st, rules)
    out["sales_staff_agg_income"] = refresh_sales_staff_agg_income(spark, wh)
    out["traffic_light_1m"] = update_traffic_light_1m(spark, wh, st, rules)
    out["rds_on_5th_day"] = update_rds_on_5th_day(spark, wh, st, rules)
    out["key_values"] = update_key_values(spark, wh, st, rules)
    out["operational_headcount_report"] = update_operational_headcount(spark, wh, st, rules)
    out["operational_sales_report"] = update_operational_sales_report(spark, wh, st, rules)
    out["hr_employee_analytics"] = update_hr_employee_analytics(spark, wh, st, rules)
    return out


__all__ = ["Warehouse", "Staging", "TABLES", "refresh_all"]
