"""People marts: daily personnel snapshot (P1), head count (P7), HR analytics.

All three read ``users`` once and need no shuffle except P7's tiny aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart import rules as R
from salesmart.functions import measures as M
from salesmart.rules import DEFAULT_RULES, Rules
from salesmart.sources.snapshot import company_family, personnel_projection


def daily_personnel(users: DataFrame, calendar: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """today's snapshot row of every person in the company family who is active or left < 5 months ago.

    The run date must be a calendar day: an uncorrelated EXISTS over the
    calendar cut to that day (evaluated once, no join).
    """
    as_of = F.lit(rules.as_of)
    retained = (F.col("is_active") == F.lit(True)) | (M.months_since("deactivation_date", as_of) < rules.retention_months)
    is_calendar_day = calendar.where(F.col("date") == as_of).exists()
    people = company_family(users, rules).where(retained & is_calendar_day)
    return personnel_projection(people, as_of, as_of)


# --- P7 head count ----------------------------------------------------------

#: agents with a tenure below this many months are counted by month
FRESH_BELOW = 7


def headcount_buckets(rules: Rules):
    """The agents who are counted by tenure month, and label -> (who, least tenure, most tenure, empty gives NULL not 0)."""
    dept, pos, office = F.col("department"), F.col("position"), F.col("office")
    sales_office = office != rules.rental_office
    rental_office = office == rules.rental_office
    sales_team = dept.ilike(R.SALES_TEAM_PREFIX + "%") | dept.isin(R.COMMERCIAL_DEPARTMENT)
    agents = sales_office & sales_team & pos.isin(*R.AGENT_POSITIONS)
    rental_specialist = rental_office & (pos == R.RENTAL_SPECIALIST_POSITION)
    buckets = {
        ">24": (agents, 25, None, True),
        "7-12": (agents, 7, 12, True),
        "13-24": (agents, 13, 24, True),
        "Менеджеры ОП": (sales_office & sales_team & (pos == R.SALES_MANAGER_POSITION), None, None, False),
        "Помощники ОП": (sales_office & sales_team & pos.isin(*R.ASSISTANT_POSITIONS), None, None, False),
        "Декрет": (sales_office & (pos == R.SENIOR_AGENT_POSITION), None, None, False),
        "Группа 0": (sales_office & (pos == R.AGENT_POSITION), None, None, False),
        "АУП ОП": (~dept.ilike(R.SALES_TEAM_PREFIX + "%") & ~dept.isin(*R.NON_ADMIN_DEPARTMENTS)
                   & sales_office & ~pos.isin(*R.ASSISTANT_POSITIONS), None, None, False),
        "Менеджеры ОА": (rental_office & (pos == R.RENTAL_MANAGER_POSITION), None, None, False),
        "Помощники ОА": (rental_office & (pos == R.RENTAL_ASSISTANT_POSITION), None, None, False),
        "АУП ОА": (rental_office & pos.isin(*R.RENTAL_ADMIN_POSITIONS), None, None, False),
        ">6": (rental_specialist, 7, None, False),
        "0-3": (rental_specialist, 0, 3, False),
        "4-6": (rental_specialist, 4, 6, False),
    }
    assert tuple(buckets) == R.HEADCOUNT_LABELS
    return agents, buckets


def _headcount_conditions(rules: Rules):
    """The same as conditions on a row with its tenure."""
    tenure = F.col("tenure")
    agents, buckets = headcount_buckets(rules)

    def within(who, lo, hi):
        who = who if lo is None else who & (tenure >= lo)
        return who if hi is None else who & (tenure <= hi)

    return agents & (tenure < FRESH_BELOW), {
        label: (within(who, lo, hi), empty_null) for label, (who, lo, hi, empty_null) in buckets.items()}


def operational_headcount(users: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Head count of active home-company staff per tenure month (< 7) and per role bucket.

    One scan of ``users``: rows are grouped by their monthly label (NULL when
    outside the monthly bucket) with one conditional count per role bucket
    (partial aggregation map-side).  Rows with a monthly label are result rows as
    they are; a second, global aggregate sums the buckets into one row that an
    ``explode`` of the fixed bucket list turns into rows.  Buckets
    overlap, so each is counted on its own.  Sum-style buckets give NULL when
    empty, count-style buckets 0; an empty monthly label gives no row.
    """
    monthly, fixed = _headcount_conditions(rules)
    base = users.where((F.col("company") == rules.home_company) & (F.col("is_active") == F.lit(True))) \
                .select("id", "department", "position", "office", M.tenure_months(F.lit(rules.as_of)).alias("tenure"))
    names = {label: f"b{i}" for i, label in enumerate(fixed)}
    level1 = base.groupBy(F.when(monthly, F.col("tenure").cast("string")).alias("month_label")).agg(
        F.count("id").cast("long").alias("month_count"),
        *[(F.sum(F.when(cond, 1)) if empty_null else F.count(F.when(cond, F.col("id")))).alias(names[label])
          for label, (cond, empty_null) in fixed.items()])
    entry = lambda exp, n: F.struct(exp.alias("exp"), n.cast("long").alias("users_count"))
    level2 = level1.agg(
        *[(F.sum(names[label]) if empty_null else F.coalesce(F.sum(names[label]), F.lit(0))).alias(names[label])
          for label, (_, empty_null) in fixed.items()])
    buckets = F.array(*[entry(F.lit(label), F.col(names[label])) for label in fixed])
    months = level1.where(F.col("month_label").isNotNull()).select(
        entry(F.col("month_label"), F.col("month_count")).alias("r"))
    rows = months.unionByName(level2.select(F.explode(buckets).alias("r")))
    return rows.select(M.report_date(rules.as_of).alias("date"), "r.users_count", "r.exp")


# --- P9 HR analytics ----------------------------------------------------------

HR_COLUMNS = [
    "id", "full_name", "company", "office", "department", "position", "birth_date", "age", "gender",
    "career_start", "experience", "is_active", "deactivation_date", "age_group", "exp_group",
    "exp3plus", "exp7plus", "days_to_birthday",
]


def hr_employee_analytics(users: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per person of the company family (case-insensitive prefix)."""
    as_of = F.lit(rules.as_of)
    people = users.where(F.col("company").ilike(rules.company_prefix + "%"))
    base = people.select(
        "id", "full_name", "company", "office", "department", "position",
        F.col("birth_date").cast("date").alias("birth_date"),
        M.age_years("birth_date", as_of).alias("age"), "gender",
        M.effective_start().alias("career_start"),
        M.tenure_months(as_of).alias("experience"), "is_active",
        M.masked_deactivation("deactivation_date", "is_active").alias("deactivation_date"))
    return base.select(
        *[c for c in HR_COLUMNS if c in base.columns],
        M.age_group("age").alias("age_group"), M.exp_group_hr("experience").alias("exp_group"),
        M.exp_at_least("experience", 3).alias("exp3plus"), M.exp_at_least("experience", 7).alias("exp7plus"),
        M.days_to_birthday("birth_date", as_of).alias("days_to_birthday")).select(*HR_COLUMNS)
