"""The person-day snapshot (``daily_personnel``).

In production the snapshot is a stored table partitioned by ``date``, one
partition per daily run of the personnel mart, and readers prune it with
``dayofmonth(date) = 5`` or ``date = d``.  For the test data it is derived
from ``users`` and the days each of them is on the books (``presence``): one
row per person and such day, with that day as the clock.  Callers pass the day
filter they need, which cuts the days before the join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions import measures as M
from salesmart.rules import DEFAULT_RULES, Rules

SNAPSHOT_COLUMNS = (
    "date", "id", "full_name", "company", "department", "position", "career_start", "office",
    "is_active", "deactivation_date", "deactivation_period", "experience", "gender", "birth_date", "age",
)


def personnel_projection(people: DataFrame, clock: Column, now: Column) -> DataFrame:
    """Snapshot row of each person: ``clock`` dates the row, ``now`` measures time since leaving."""
    start = M.effective_start("career_start", "start_date")
    return people.select(
        clock.alias("date"), "id", "full_name", "company", "department", "position",
        start.alias("career_start"), "office", "is_active", "deactivation_date",
        M.months_since("deactivation_date", now).alias("deactivation_period"),
        M.month_diff(clock, start).alias("experience"),
        "gender", F.col("birth_date").cast("date").alias("birth_date"),
        M.age_decimal("birth_date", clock).alias("age"),
    )


def company_family(users: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """People of the company family (case-sensitive prefix)."""
    return users.where(F.col("company").like(rules.company_prefix + "%"))


def daily_personnel_history(users: DataFrame, presence: DataFrame, rules: Rules = DEFAULT_RULES,
                            day_filter: Column | None = None) -> DataFrame:
    """``daily_personnel`` of each person's (wanted) days in ``presence`` (id, date), each day its own clock."""
    days = presence if day_filter is None else presence.where(day_filter)
    return personnel_projection(company_family(users, rules).join(days, "id"), F.col("date"), F.col("date"))


def snapshot_day_filter(rules: Rules = DEFAULT_RULES) -> Column:
    """Days read by the monthly marts: the snapshot day of each month."""
    return F.dayofmonth("date") == rules.snapshot_day


def key_values_day_filter(rules: Rules = DEFAULT_RULES) -> Column:
    """Days read by the activity mart: snapshot days and the newcomer look-back day."""
    lookback = F.date_sub(F.lit(rules.as_of), rules.newcomer_lookback_days)
    return snapshot_day_filter(rules) | (F.col("date") == lookback)
