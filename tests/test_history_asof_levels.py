"""Head count over days against day-by-day runs, as-of lookups against brute force, levels that add up."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from salesmart import rules as R
from salesmart.operators.asof_join import asof_lookup
from salesmart.plans.access import DRILL_PATH, below, drilldown_levels
from salesmart.plans.catalog import Inputs
from salesmart.plans.headcount_history import headcount_history
from salesmart.plans.people import operational_headcount
from salesmart.rules import Rules

HOME, D = R.HOME_COMPANY, dt.date
STAFF = ("id long, company string, department string, position string, office string, is_active boolean, "
         "career_start date, valid_from date, valid_to date")


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- head count ---------------------------------------------------------------------------

def staff_rows():
    """People who change team, post and office, with starts before, in and after the range, and missing values."""
    rng = random.Random(5)
    posts = [*R.AGENT_POSITIONS, R.SALES_MANAGER_POSITION, *R.ASSISTANT_POSITIONS, R.SENIOR_AGENT_POSITION,
             R.AGENT_POSITION, R.RENTAL_MANAGER_POSITION, *R.RENTAL_ADMIN_POSITIONS, R.RENTAL_SPECIALIST_POSITION, None]
    teams = ["Команда 1", "команда 2", R.COMMERCIAL_DEPARTMENT, "Декрет", "Бухгалтерия", None]
    out = []
    for n in range(150):
        day = D(1999, 10, 1) + dt.timedelta(days=rng.randrange(150))
        start = rng.choice([None, D(1996, 1, 31), D(1999, 8, 31), D(1999, 12, 1), D(2000, 3, 15), D(1998, 12, 2)])
        for _ in range(rng.randrange(1, 4)):
            end = day + dt.timedelta(days=rng.randrange(0, 70))
            out.append((n, rng.choice([HOME, HOME, HOME, "Города Бердск", None]), rng.choice(teams), rng.choice(posts),
                        rng.choice(["Центр", R.RENTAL_OFFICE, None]), rng.choice([True, True, False, None]), start, day,
                        end))
            day = end + dt.timedelta(days=rng.randrange(1, 9))
        if n % 5 == 0:
            out[-1] = (*out[-1][:-1], None)
    return out


def test_history_equals_the_head_count_of_each_day(spark):
    staff = spark.createDataFrame(staff_rows(), STAFF)
    days = [D(1999, 9, 1), D(1999, 12, 31), D(2000, 1, 1), D(2000, 2, 29), D(2000, 3, 1), D(2000, 7, 3)]
    got = headcount_history(staff, spark.createDataFrame([(x,) for x in [*days, days[2], None]], "date date"))
    want = []
    for day in days:
        there = staff.where((F.col("valid_from") <= F.lit(day)) & (F.coalesce("valid_to", F.lit(day)) >= F.lit(day)))
        want += rows(operational_headcount(there.withColumn("start_date", F.lit(None).cast("date")), Rules(as_of=day)))
    assert rows(got) == sorted(want)


def test_history_of_no_staff_and_of_no_days(spark):
    days = spark.createDataFrame([(D(2000, 1, 1),)], "date date")
    nobody = spark.createDataFrame([], STAFF)
    held = {r.exp: r.users_count for r in headcount_history(nobody, days).collect()}
    assert set(held) == set(R.HEADCOUNT_LABELS) and held[">24"] is None and held["0-3"] == 0
    assert headcount_history(spark.createDataFrame(staff_rows(), STAFF), days.limit(0)).count() == 0


def test_history_has_no_product_of_people_and_days(spark):
    staff = spark.createDataFrame(staff_rows(), STAFF)
    plan = plan_text(headcount_history(staff, spark.createDataFrame([(D(2000, 1, 1),)], "date date")))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "Python" not in plan


# --- as-of lookup ---------------------------------------------------------------------------

def brute(left, right):
    out = []
    for who, at, tag in left:
        best = max(((t, (v is not None, v)) for k, t, v in right
                    if None not in (who, at, k, t) and k == who and t <= at), default=None)
        out.append((who, at, tag, best and best[1][1], best and best[0]))
    return sorted(map(str, out))


@pytest.mark.parametrize("range_days", [1, 30, 366, 100_000])
def test_asof_equals_brute_force_whatever_the_ranges(spark, range_days):
    rng = random.Random(range_days)
    def when():
        return rng.choice([None, *[D(1969, 6, 1) + dt.timedelta(days=rng.randrange(900)) for _ in range(30)]])
    def who():
        return rng.choice([None, 1, 1, 1, 1, 2, 3, 4, 5, 6])
    right = [(who(), when(), rng.choice([None, 1, 2, 3, 4, 5])) for _ in range(150)]
    left = [(who(), when(), n % 7) for n in range(300)]
    left += left[:20]
    got = asof_lookup(spark.createDataFrame(left, "k long, at date, tag int"),
                      spark.createDataFrame(right, "k long, since date, v int"),
                      ["k"], "at", "since", ["v"], "known", range_days=range_days)
    assert got.columns == ["k", "at", "tag", "v", "known"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(left, right)


def test_asof_of_timestamps_empty_sides_and_clashing_names(spark):
    t = lambda h: dt.datetime(2000, 1, 1, h)
    left = spark.createDataFrame([(1, t(3)), (1, t(5)), (2, t(5))], "k int, at timestamp")
    right = spark.createDataFrame([(1, t(4), "a", 1), (1, t(5), "b", None)], "k int, at timestamp, v string, w int")
    got = asof_lookup(left, right, ["k"], "at", "at", ["v", "w"])
    assert sorted(map(str, (tuple(r)[2:] for r in got.collect()))) == ["('b', None)", "(None, None)", "(None, None)"]
    assert asof_lookup(left.limit(0), right, ["k"], "at", "at", ["v"]).count() == 0
    assert [r.v for r in asof_lookup(left, right.limit(0), ["k"], "at", "at", ["v"]).collect()] == [None] * 3
    with pytest.raises(ValueError):
        asof_lookup(left.withColumn("v", F.lit(1)), right, ["k"], "at", "at", ["v"])


def test_asof_of_a_busy_key_spreads_over_its_ranges(spark):
    """A third of the rows have one key: no partition by (key, range) holds more than its range's days."""
    n = 20_000
    left = spark.range(n).selectExpr("IF(id % 3 = 0, 0, id) AS k", "date_add(DATE'1990-01-01', CAST(id % 3650 AS INT)) AS at")
    right = left.selectExpr("k", "date_add(at, 1) AS since", "dayofyear(at) AS v")
    got = asof_lookup(left, right, ["k"], "at", "since", ["v"], "known")
    assert got.count() == n
    hot = got.where("k = 0").selectExpr("datediff(at, known) AS gap").groupBy("gap").count().collect()
    assert {r.gap for r in hot} <= {0, 1, 2, 3, None}
    plan = plan_text(got)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


# --- drill path -------------------------------------------------------------------------------

def test_levels_add_up_to_their_parents(spark):
    levels = drilldown_levels(Inputs(spark, SF_SMALL).p2()).cache()
    assert {r.level for r in levels.select("level").distinct().collect()} == set(range(len(DRILL_PATH) + 1))
    own = levels.where(F.col("level") < len(DRILL_PATH)).select(
        "year", "month", "node", "deal_count", "deal_income")
    summed = levels.where("level > 0").groupBy("year", "month", F.col("parent").alias("node")).agg(
        F.sum("deal_count").alias("deal_count"), F.sum("deal_income").cast("decimal(28,2)").alias("deal_income"))
    assert rows(own) == rows(summed)
    top = levels.where("level = 0 AND parent IS NULL")
    assert top.count() == levels.select("year", "month").distinct().count()
    levels.unpersist()


def test_a_missing_department_is_not_the_level_above(spark):
    deals = spark.createDataFrame([
        (2000, 1, "c", None, 1, "flat", 7, 1.0), (2000, 1, "c", "d", 2, "flat", 8, 2.0), (2000, 1, "c", "d", 2, None, 9, 4.0),
        (2000, 1, "c", "d", 2, "flat", None, 8.0), (2000, 2, "c", "d", 2, "flat", 8, None)],
        "year int, month int, company string, department string, user_id long, property_type string, ata_id long, income double")
    levels = drilldown_levels(deals)
    january = {r.node: (r.level, r.parent, r.deal_count, r.deal_income and float(r.deal_income))
               for r in levels.where("month = 1").collect()}
    assert january["[]"] == (0, None, 2, 3.0) and january['["c"]'] == (1, "[]", 2, 3.0)
    assert january['["c",null]'] == (2, '["c"]', 1, 1.0) and january['["c","d"]'] == (2, '["c"]', 1, 2.0)
    assert january['["c","d","2","flat"]'] == (4, '["c","d","2"]', 1, 2.0) and len(january) == 8
    assert sorted(r.node for r in below(levels.where("month = 1"), '["c"]').collect()) == ['["c","d"]', '["c",null]']
    assert drilldown_levels(deals.limit(0)).where("level > 0").count() == 0
