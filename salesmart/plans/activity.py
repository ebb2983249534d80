"""Snapshot-driven marts: traffic light (P4), 5th-day report (P5), key values.

Each reads the month's snapshot-day rows of ``daily_personnel`` and attaches
per person-month facts.  Facts are reduced before the join wherever the
output allows it (P5 pre-aggregates records, P6 pivots its eight dated metric
relations in one aggregate instead of eight joins).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart import rules as R
from salesmart.functions import measures as M
from salesmart.operators.first_rows import FIRST, flag_global_first, group_minimum
from salesmart.rules import DEFAULT_RULES, Rules

PERSON_MONTH = ["user_id", "year", "month"]


def snapshot_staff(daily_personnel: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Snapshot-day rows outside the rental office with positive tenure (any company of the family)."""
    return daily_personnel.where(
        (F.dayofmonth("date") == rules.snapshot_day) & (F.col("office") != rules.rental_office)
        & (F.col("experience") > 0))


def dated_records(accounting: DataFrame) -> DataFrame:
    """Accounting records keyed by their person-month (undated records match no month)."""
    return accounting.where(F.col("realization_date").isNotNull()).withColumns({
        "user_id": F.col("responsible_id"), "year": F.year("realization_date"), "month": F.month("realization_date")})


# --- P5 -------------------------------------------------------------------------

RDS_COLUMNS = ["month", "year", "user_id", "full_name", "department", "position", "is_active",
               "experience", "exp_category", "status", "income", "deal"]


def restrict_to(daily_personnel: DataFrame, accounting: DataFrame, only: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Snapshot rows and records of the person-months in ``only`` (user_id, year, month): two semi joins."""
    keys = only.select(*PERSON_MONTH).distinct()
    dp = (daily_personnel.withColumns({"_y": F.year("date"), "_m": F.month("date")})
          .join(keys.select(F.col("user_id").alias("id"), F.col("year").alias("_y"), F.col("month").alias("_m")),
                ["id", "_y", "_m"], "left_semi").drop("_y", "_m"))
    recs = (dated_records(accounting).join(keys, PERSON_MONTH, "left_semi").drop(*PERSON_MONTH))
    return dp, recs


def rds_on_5th_day(daily_personnel: DataFrame, accounting: DataFrame, rules: Rules = DEFAULT_RULES,
                   only: DataFrame | None = None) -> DataFrame:
    """P5: closed income and deal count per person-month and record status for staff on the snapshot day.

    Records are summed per (person, year, month, status) before the join, so
    the join sees at most one row per status instead of every record.
    A person-month without records gets one row: status 'no data', zeros.
    ``only`` restricts the computation to the given person-months.
    """
    if only is not None:
        daily_personnel, accounting = restrict_to(daily_personnel, accounting, only)
    closed = F.col("status") == rules.closed_status
    facts = dated_records(accounting).groupBy(*PERSON_MONTH, "status").agg(
        F.sum(F.when(closed, F.col("income")).otherwise(F.lit(0))).alias("income"),
        F.sum(M.deal_flag("contract_name", "status", rules)).alias("deal"))
    staff = snapshot_staff(daily_personnel, rules).select(
        F.col("id").alias("user_id"), F.year("date").alias("year"), F.month("date").alias("month"),
        "full_name", "department", "position", "is_active", "experience")
    joined = staff.join(facts, PERSON_MONTH, "left")
    return joined.select(
        "month", "year", "user_id", "full_name", "department", "position",
        M.active_label("is_active").alias("is_active"), F.col("experience").cast("int").alias("experience"),
        M.exp_category_rds("experience").alias("exp_category"),
        F.coalesce(F.col("status"), F.lit(R.NO_DATA)).alias("status"),
        F.coalesce(F.col("income"), F.lit(0)).cast("decimal(28,2)").alias("income"),
        F.coalesce(F.col("deal"), F.lit(0)).cast("long").alias("deal"))


# --- P4 -------------------------------------------------------------------------

TRAFFIC_COLUMNS = ["month", "year", "user_id", "full_name", "department", "position", "is_active", "experience",
                   "ata_id", "status", "realization_date", "contract_id", "contract_name", "deal_type",
                   "income", "payment", "deal", "is_first_occurrence"]


def _traffic_measures(rules: Rules) -> list:
    closed = F.col("status") == rules.closed_status
    money = lambda c: F.when(closed, F.col(c)).otherwise(F.lit(0)).cast("decimal(28,2)")
    return [
        F.coalesce(F.col("ata_id"), F.lit(0)).cast("long").alias("ata_id"),
        M.status_label("status", rules).alias("status"), "realization_date",
        F.coalesce(F.col("contract_id"), F.lit(1)).cast("long").alias("contract_id"),
        M.contract_label("contract_name", "status", rules).alias("contract_name"),
        F.coalesce(F.col("deal_type"), F.lit(R.NOT_LABELLED)).alias("deal_type"),
        money("income").alias("income"), money("payment").alias("payment"),
        M.deal_flag("contract_name", "status", rules).alias("deal"),
    ]


RECORD_LABELS = ["realization_date", "ata_id", "status", "contract_id", "contract_name", "deal_type"]
RECORD_MONEY = ["income", "payment"]


def _summed_records(records: DataFrame, keys: list[str]) -> DataFrame:
    """One row per record with its labels: the money of a repeated record id is added up."""
    return records.groupBy(*keys, *RECORD_LABELS).agg(*[F.sum(c).alias(c) for c in RECORD_MONEY])


def traffic_arm_snapshot(daily_personnel: DataFrame, accounting: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """P4 arm A: each snapshot person-month with each of its records, or one empty row.

    The first row of each person-month (earliest date, then record id, then
    the labels) is flagged; the minimum is an aggregate over the summed records
    (combined map-side), joined back on the same keys.  It carries all their
    columns, so both reads of the sums share one exchange.
    """
    rec_cols = RECORD_LABELS + RECORD_MONEY
    records = _summed_records(dated_records(accounting).withColumnRenamed("id", "ata_id"), PERSON_MONTH)
    staff = snapshot_staff(daily_personnel, rules).select(
        F.year("date").alias("year"), F.month("date").alias("month"), F.col("id").alias("user_id"),
        "full_name", "department", "position", "is_active", "experience")
    first = group_minimum(records, PERSON_MONTH, rec_cols)
    staff_first = staff.join(first, PERSON_MONTH, "left")
    with_records = staff_first.join(records, PERSON_MONTH, "inner").select(
        *staff.columns, *rec_cols, F.struct(*rec_cols).eqNullSafe(F.col(FIRST)).cast("int").alias("is_first_occurrence"))
    without = staff_first.where(F.col(FIRST).isNull()).select(
        *staff.columns, *[F.lit(None).cast(records.schema[c].dataType).alias(c) for c in rec_cols],
        F.lit(1).alias("is_first_occurrence"))
    return with_records.unionByName(without).select(
        "month", "year", "user_id", "full_name", "department", "position", "is_active",
        F.col("experience").cast("int").alias("experience"), *_traffic_measures(rules), "is_first_occurrence")


def traffic_arm_newcomers(accounting: DataFrame, users: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """P4 arm B: home-company records of people in their first month (name and team from the record).

    Exactly one row of the whole arm is flagged: the smallest (person, date,
    record), found by a scalar-subquery minimum instead of a global window.
    """
    starts = M.start_month_keys(users, [F.col("position").alias("u_position"), F.col("is_active").alias("u_is_active")])
    fresh = accounting.where((F.col("company") == rules.home_company) & (F.col("office") != rules.rental_office))
    fresh = _summed_records(dated_records(fresh).withColumnRenamed("id", "ata_id"),
                            [*PERSON_MONTH, "responsible_name", "team"])
    # Tenure 0 at the record = the record's month is the start month: an equi-join on (person, year, month).
    arm = fresh.join(starts, PERSON_MONTH, "inner").select(
        "month", "year", "user_id",
        F.col("responsible_name").alias("full_name"), F.col("team").alias("department"),
        F.col("u_position").alias("position"), F.col("u_is_active").alias("is_active"),
        F.lit(0).alias("experience"), *_traffic_measures(rules))
    order = ["user_id", "realization_date", "ata_id"]
    return flag_global_first(arm, order + [c for c in arm.columns if c not in order], "is_first_occurrence")


def traffic_light_1m(daily_personnel: DataFrame, accounting: DataFrame, users: DataFrame,
                     rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Snapshot person-months with their records (arm A) plus newcomers' records (arm B), distinct."""
    arm_a = traffic_arm_snapshot(daily_personnel, accounting, rules).select(*TRAFFIC_COLUMNS)
    arm_b = traffic_arm_newcomers(accounting, users, rules).select(*TRAFFIC_COLUMNS)
    return arm_a.unionByName(arm_b).distinct()


# --- P6 -------------------------------------------------------------------------

# metric relation -> (person key column, value column, output name)
DATED_METRIC_COLUMNS = {
    "count_developer_deals": ("responsible_id", "deals", "nvstr"),
    "exclusive_contract": ("agent_id", "count", "exclusives"),
    "deal_count": ("agents_id", "deals", "deals"),
    "mortgage_count_leads": ("id", "leads", "mortgage_leads"),
    "mortgage_consult_count": ("id", "leads", "mortgage_consult"),
    "monthly_objects": ("responsible_id", "objects_count", "new_objects"),
    "cost_change_objects": ("responsible_id", "cost_change_count", "cost_change_count"),
    "bid_buy_count": ("id", "bids", "bids"),
}
AD_COLUMNS = ["ads_count", "avito_count", "cian_count", "yandex_count", "domclick_count"]
SUMMED = ["nvstr", "exclusives", "deals", "mortgage_leads", "mortgage_consult", "all_objects",
          "new_objects", "cost_change_count", "bids", "ads_count"]
KEY_VALUES_COLUMNS = ["month", "year", "id", "full_name", "department", "position", "experience",
                      "nvstr", "exclusives", "deals", "mortgage_leads", "mortgage_consult", "all_objects",
                      "new_objects", "cost_change_count", "bids", *AD_COLUMNS, "all_sum", "avician"]


def _unique_value(value, rows, what: str):
    """The group's value, or a job failure when the relation holds the key more than once (asserted in-plan)."""
    return F.when(rows > 1, F.raise_error(F.lit(f"duplicate key in metric relation {what}"))).otherwise(value)


def dated_metrics_wide(metrics: dict[str, DataFrame]) -> DataFrame:
    """The eight dated metric relations as one row per (id, year, month): one union, one aggregate.

    Equivalent to eight LEFT JOINs when each relation has one row per key,
    and that uniqueness is asserted in the same aggregate (a repeated key
    fails the job, where eight joins would fan rows out); eight joins would
    also shuffle the snapshot eight times.
    """
    parts = []
    for name, (key, value, out) in DATED_METRIC_COLUMNS.items():
        parts.append(metrics[name].select(F.col(key).cast("long").alias("id"), F.col("year").cast("int").alias("year"),
                                          F.col("month").cast("int").alias("month"),
                                          F.lit(out).alias("metric"), F.col(value).cast("long").alias("value")))
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    outs = {out: name for name, (_, _, out) in DATED_METRIC_COLUMNS.items()}
    return long.groupBy("id", "year", "month").agg(*[
        _unique_value(F.sum(F.when(F.col("metric") == out, F.col("value"))),
                      F.count(F.when(F.col("metric") == out, 1)), name).alias(out)
        for out, name in outs.items()])


def undated_metrics(metrics: dict[str, DataFrame]) -> DataFrame:
    """Per-person metrics without a month (current objects, ad counts): one row per id, uniqueness asserted."""
    ao = metrics["actual_objects"].select(F.col("responsible_id").cast("long").alias("id"),
                                          F.col("objects_count").alias("all_objects"), F.lit(1).alias("_ao"))
    ads = metrics["ad_tables_count"].select(F.col("responsible_id").cast("long").alias("id"), *AD_COLUMNS,
                                            F.col("avician_count").alias("avician"), F.lit(1).alias("_ads"))
    both = ao.unionByName(ads, allowMissingColumns=True)
    return both.groupBy("id").agg(
        _unique_value(F.sum("all_objects"), F.count("_ao"), "actual_objects")
        .cast(ao.schema["all_objects"].dataType).alias("all_objects"),
        *[_unique_value(F.sum(c), F.count("_ads"), "ad_tables_count").alias(c) for c in AD_COLUMNS + ["avician"]])


def key_value_people(daily_personnel: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """P6 rows before the metrics: snapshot-day rows with positive tenure, plus newcomers seen on
    the look-back day (tenure 0 at the run date).

    Both arms project the same columns, so UNION of the two arms is one scan
    with an OR filter followed by a distinct (partitioned by the join keys,
    which the metric join then reuses).
    """
    as_of = rules.as_of
    lookback = as_of - dt.timedelta(days=rules.newcomer_lookback_days)
    snapshot_arm = (F.dayofmonth("date") == rules.snapshot_day) & (F.col("experience") > 0)
    newcomer_arm = (M.month_diff(F.lit(as_of), "career_start") == 0) & (F.col("date") == F.lit(lookback))
    return daily_personnel.where(snapshot_arm | newcomer_arm).select(
        F.month("date").alias("month"), F.year("date").alias("year"), "id", "full_name", "department", "position",
        M.month_diff("date", "career_start").alias("experience")).repartition("id", "year", "month").distinct()


def attach_metrics(people: DataFrame, metrics: dict[str, DataFrame]) -> DataFrame:
    """LEFT JOIN people (id, year, month, ...) with the ten metric relations, zero-filled, with ``all_sum``.

    Undated metrics repeat on every month of a person.
    """
    joined = people.join(dated_metrics_wide(metrics), ["id", "year", "month"], "left") \
                   .join(undated_metrics(metrics), "id", "left")
    filled = joined.select(*people.columns,
                           *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in SUMMED[:-1] + AD_COLUMNS + ["avician"]])
    return filled.withColumn("all_sum", M.total(SUMMED).cast("long"))


def key_values(daily_personnel: DataFrame, metrics: dict[str, DataFrame], rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Ten activity metrics and their total per person-month, active people only (total > 0)."""
    rows = attach_metrics(key_value_people(daily_personnel, rules), metrics)
    return rows.where(F.col("all_sum") > 0).select(*KEY_VALUES_COLUMNS)
