"""Record versions: edits, moves, withdrawals, replays and late versions; only touched months are read."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from paths import SF_SMALL
from salesmart.operators import versioned as V
from salesmart.plans.activity import RDS_COLUMNS, rds_on_5th_day
from salesmart.plans.catalog import Inputs
from salesmart.plans.deals import operational_sales_report, sales_report_rows
from salesmart.sources.snapshot import snapshot_day_filter
from salesmart.streaming import edits as E

COLUMNS = "id long, responsible_id long, realization_date date, income long"
VERSIONS = f"{COLUMNS}, record_version long, withdrawn boolean"
D = dt.date


def money(df):
    return df.withColumn("income", F.col("income").cast("decimal(18,2)"))


def store_of(spark, root, rows):
    store = E.RecordStore(spark, f"{root}/store", ["id", "responsible_id", "realization_date", "income"], buckets=4)
    store.load(money(spark.createDataFrame(rows, COLUMNS)))
    return store


def content(store):
    return sorted((r.id, r.responsible_id, r.realization_date, float(r.income or 0)) for r in store.read().collect())


def feed(spark, store, batch_id, *rows):
    store.handle(money(spark.createDataFrame(rows, VERSIONS)), batch_id)


def test_moves_withdrawals_and_late_versions(spark, scratch):
    store = store_of(spark, scratch, [(1, 7, D(2000, 1, 5), 10), (2, 7, D(2000, 1, 6), 20), (3, 8, None, 30)])
    touched = []
    store.marts.append(lambda s, c: touched.append(sorted(tuple(r) for r in c.person_months().collect())))
    feed(spark, store, 0, (1, 9, D(2000, 3, 1), 11, 2, False), (1, 9, D(2000, 2, 1), 12, 1, False),
         (4, 7, D(2001, 1, 1), 40, 0, False))
    assert touched[-1] == [(7, 2000, 1), (7, 2001, 1), (9, 2000, 3)]
    feed(spark, store, 1, (1, 7, D(2000, 1, 1), 99, 1, False), (3, 8, D(2000, 5, 5), 30, 1, False))   # the first is late
    assert content(store) == [(1, 9, D(2000, 3, 1), 11.0), (2, 7, D(2000, 1, 6), 20.0), (3, 8, D(2000, 5, 5), 30.0),
                              (4, 7, D(2001, 1, 1), 40.0)]
    feed(spark, store, 2, (2, None, None, None, 1, True), (77, 1, D(2000, 1, 1), 1, 3, True))
    assert touched[-1] == [(7, 2000, 1)]
    assert "year=2000/month=1" not in V.partitions(spark, store.path("records")), "a month without records leaves"
    feed(spark, store, 3, (2, 7, D(2000, 1, 6), 20, 0, False), (77, 1, D(2000, 1, 1), 1, 2, False))   # after the withdrawal
    assert [r[0] for r in content(store)] == [1, 3, 4]
    feed(spark, store, 4, (2, 7, D(2000, 1, 6), 21, 5, False))
    assert [r[0] for r in content(store)] == [1, 2, 3, 4]


def test_a_replayed_batch_changes_nothing(spark, scratch):
    """Also when the first run ended between the store's tables and a mart: the mart still gets the old person-months."""
    store = store_of(spark, scratch, [(i, i % 3, D(2000, 1 + i % 5, 3), i) for i in range(40)])
    seen = []

    def mart(s, change):
        seen.append(sorted(tuple(r) for r in change.person_months().collect()))
        if len(seen) == 1:
            raise RuntimeError("executor lost")
    store.marts.append(mart)
    rows = [(i, 5, D(2001, 2, 3), 1, 1, i % 4 == 0) for i in range(0, 40, 2)]
    with pytest.raises(RuntimeError):
        feed(spark, store, 0, *rows)
    feed(spark, store, 0, *rows)
    assert seen[0] == seen[1] and (0, 2000, 1) in seen[1] and (5, 2001, 2) in seen[1]
    after = content(store)
    feed(spark, store, 0, *rows)
    assert content(store) == after and len(after) == 30


def test_only_touched_months_are_read(spark, scratch):
    store = store_of(spark, scratch, [(i, i % 3, D(1995 + i // 12 % 6, 1 + i % 12, 3), i) for i in range(300)])
    all_files = store.read().inputFiles()
    read = []
    real = store.read
    store.read = lambda months=None: read.append(real(months).inputFiles()) or real(months)
    feed(spark, store, 0, (5, 1, D(1995, 6, 9), 5, 1, False))
    feed(spark, store, 1, (6, 1, D(1998, 2, 9), 5, 1, False))
    months = [{re.search(r"year=(\d+)/month=(\d+)", f).groups() for f in files} for files in read]
    assert set().union(*months[:2]) == {("1995", "6")}
    assert set().union(*months[2:]) == {("1995", "7"), ("1998", "2")}
    assert all(len(files) < len(all_files) / 10 for files in read)


@pytest.fixture(scope="module")
def inputs(spark):
    return Inputs(spark, SF_SMALL)


def test_sales_partials_equal_the_report_through_edits(spark, scratch, inputs):
    i = inputs
    records = i.accounting
    base = records.where("id % 3 <> 0")
    store = E.RecordStore(spark, f"{scratch}/store", records.columns)
    store.load(base)

    def rows(recs, keep):
        return sales_report_rows(recs, i.deal, i.objects, i.users, i.bid, i.rules, tuple(keep))
    partials = E.SalesPartials(f"{scratch}/sales", rows)
    partials.load(spark, store.read().select(*store.columns))
    store.marts.append(partials)

    def report(recs):
        return sorted(map(tuple, operational_sales_report(recs, i.deal, i.objects, i.users, i.bid, i.rules).collect()), key=str)
    stamp = {E.VERSION: F.lit(1).cast("long"), E.WITHDRAWN: F.lit(False)}
    # new records only: nothing old is replaced
    new = records.where("id % 3 = 0").withColumns(stamp)
    store.handle(new, 0)
    assert spark.read.parquet(store.path("changes/old/batch_id=0")).count() == 0
    assert sorted(map(tuple, partials.report(spark).collect()), key=str) == report(records)
    # one group loses its incomes, one its rows
    gone = records.where("year(realization_date) = 1996").withColumns({**stamp, E.VERSION: F.lit(2).cast("long"),
                                                                      E.WITHDRAWN: F.lit(True)})
    nulls = records.where("year(realization_date) = 1997").withColumn("income", F.lit(None).cast("decimal(18,2)"))
    batch = gone.unionByName(nulls.withColumns({**stamp, E.VERSION: F.lit(2).cast("long")}))
    store.handle(batch, 1)
    want = records.where("realization_date IS NULL OR year(realization_date) NOT IN (1996, 1997)").unionByName(nulls)
    assert sorted(map(tuple, partials.report(spark).collect()), key=str) == report(want)
    partials(store, store._changes(batch, 1))   # a replay of the mart alone
    assert sorted(map(tuple, partials.report(spark).collect()), key=str) == report(want)


def test_5th_day_report_through_edits(spark, scratch, inputs):
    """Another person-month mart on the same store: P5 equals its full refresh of the final records."""
    i = inputs
    snapshot = i.snapshot(snapshot_day_filter(i.rules))
    records = i.accounting
    store = E.RecordStore(spark, f"{scratch}/store", records.columns)
    earlier = records.withColumn("realization_date", F.when(F.col("id") % 5 == 0, F.date_sub("realization_date", 35))
                                 .otherwise(F.col("realization_date")))
    store.load(earlier)
    mart_for = lambda recs, touched: rds_on_5th_day(snapshot, recs, i.rules, only=touched)
    target = f"{scratch}/rds"
    V.publish(spark, target, mart_for(store.read().select(*store.columns), None), E.MONTH)
    store.marts.append(E.person_month_mart(target, mart_for))
    stamp = {E.VERSION: F.lit(1).cast("long"), E.WITHDRAWN: F.lit(False)}
    store.handle(records.where("id % 5 = 0").withColumns(stamp), 0)
    rows = lambda df: sorted(map(tuple, df.select(*RDS_COLUMNS).collect()), key=str)
    assert rows(V.read_table(spark, target)) == rows(mart_for(records, None))
