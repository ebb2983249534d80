"""The snapshot as intervals: the same rows for any days, and as few intervals as people change."""

import datetime as dt

from pyspark.sql import functions as F

from paths import SF_SMALL
from salesmart.plans.activity import rds_on_5th_day
from salesmart.plans.catalog import Inputs
from salesmart.sources.intervals import INTERVAL_COLUMNS, compact, expand
from salesmart.sources.snapshot import SNAPSHOT_COLUMNS, snapshot_day_filter


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_marts_read_from_intervals_are_the_same(spark):
    i = Inputs(spark, SF_SMALL)
    days = i.presence.select("date").distinct()
    held = compact(i.snapshot(), days)
    assert held.columns == INTERVAL_COLUMNS and held.count() < i.snapshot().count()
    fifth = expand(held, days.where(snapshot_day_filter(i.rules)))
    want = i.snapshot(snapshot_day_filter(i.rules))
    assert rows(fifth) == rows(want)
    assert rows(rds_on_5th_day(fifth, i.accounting, i.rules)) == rows(rds_on_5th_day(want, i.accounting, i.rules))


def test_an_interval_ends_at_a_change_and_at_a_missing_day(spark):
    d = dt.date
    taken = [d(2000, 1, 5), d(2000, 1, 6), d(2000, 1, 9), d(2000, 2, 1), d(2000, 2, 2)]
    team = {taken[0]: "a", taken[1]: "a", taken[2]: "b", taken[3]: "b", taken[4]: "a"}
    data = [(day, 1, team[day]) for day in taken] + [(day, 2, None) for day in taken if day != taken[2]]
    snapshot = spark.createDataFrame(data, "date date, id long, department string")
    for name, kind in (("full_name", "string"), ("company", "string"), ("position", "string"), ("career_start", "date"),
                       ("office", "string"), ("is_active", "boolean"), ("deactivation_date", "date"), ("gender", "string"),
                       ("birth_date", "date")):
        snapshot = snapshot.withColumn(name, F.lit(None).cast(kind))
    days = spark.createDataFrame([(x,) for x in taken], "date date")
    held = compact(snapshot, days)
    assert sorted((r.id, str(r.department), r.valid_from, r.valid_to) for r in held.collect()) == [
        (1, "a", taken[0], taken[1]), (1, "a", taken[4], taken[4]), (1, "b", taken[2], taken[3]),
        (2, "None", taken[0], taken[1]), (2, "None", taken[3], taken[4])]
    back = expand(held, days)
    assert back.columns == list(SNAPSHOT_COLUMNS)
    assert sorted((r.date, r.id, r.department) for r in back.collect()) == sorted(data)
    assert expand(held, days.limit(0)).count() == 0 and compact(snapshot.limit(0), days).count() == 0


def attributes_of(rows):
    """Snapshot rows of (date, id, department) with all other columns null."""
    for name in SNAPSHOT_COLUMNS:
        if name not in rows.columns:
            kind = {"is_active": "boolean", "career_start": "date", "deactivation_date": "date", "birth_date": "date"}
            rows = rows.withColumn(name, F.lit(None).cast(kind.get(name, "string")))
    return rows


def test_runs_over_more_days_than_a_word_has_bits(spark):
    import random
    rng = random.Random(3)
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=2 * n) for n in range(200)]
    team = {(p, d): rng.choice(["a", "a", "a", "b", None]) if p else "a" for p in range(4) for d in days
            if p == 0 or rng.random() < 0.9}
    want = []
    for p in range(4):
        for k, d in enumerate(days):
            if (p, d) in team:
                before = days[k - 1] if k else None
                if want and want[-1][0] == p and want[-1][3] == before and want[-1][1] == team[p, d]:
                    want[-1][3] = d
                else:
                    want.append([p, team[p, d], d, d])
    rows = [(d, p, t) for (p, d), t in team.items()]
    snapshot = attributes_of(spark.createDataFrame(rows + rows[:50], "date date, id long, department string"))
    held = compact(snapshot, spark.createDataFrame([(d,) for d in days], "date date"))
    assert sorted(map(str, ([r.id, r.department, r.valid_from, r.valid_to] for r in held.collect()))) == sorted(map(str, want))


def test_a_persons_wide_rows_are_not_sorted_by_day(spark):
    i = Inputs(spark, SF_SMALL)
    days = i.presence.select("date").distinct()
    plan = compact(i.snapshot(), days)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(id" not in plan and "bit_or" in plan
    wide = [line for line in expand(compact(i.snapshot(), days), days)._jdf.queryExecution().executedPlan().toString()
            .split("\n") if "hashpartitioning(_month" in line]
    assert not wide, "intervals are not dealt by the few months there are"
