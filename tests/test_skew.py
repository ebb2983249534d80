"""A third of all records on one person: the marts stay exact (checked against DuckDB on the same data)."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from paths import SF_MID, SF_SMALL
from salesmart import oracle as O
from salesmart.plans.catalog import Inputs
from salesmart.sources.fixtures import TEST_TABLES

HOT = 7   # an existing person id


class HotInputs(Inputs):
    @property
    def accounting(self):
        a = super().accounting
        return a.withColumn("responsible_id", F.when(F.col("id") % 3 == 0, F.lit(HOT).cast("long"))
                            .otherwise(F.col("responsible_id")))


def hot_base():
    out = []
    for name, text in O.base_ctes():
        if name == "accounting":
            text = (f"SELECT * REPLACE (CASE WHEN id % 3 = 0 THEN CAST({HOT} AS BIGINT) ELSE responsible_id END "
                    f"AS responsible_id) FROM ({text})")
        out.append((name, text))
    return out


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TEST_TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _same(df, rel):
    cols = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in cols)) for r in df.collect())
    idx = [rel.columns.index(c) for c in cols]
    want = sorted(repr(tuple(r[i] for i in idx)) for r in rel.fetchall())
    return got == want


def test_hot_person_is_a_third_of_records(spark):
    a = HotInputs(spark, SF_SMALL).accounting
    share = a.where(F.col("responsible_id") == HOT).count() / a.count()
    assert share > 0.33


@pytest.mark.parametrize("mart,select,ctes", [
    ("p2", "SELECT * FROM dm", O.P2_CTES), ("p4", O.P4_SELECT, O.P4_CTES), ("p5", O.P5_SELECT, O.P5_CTES)])
def test_marts_exact_under_hot_key(spark, duck, mart, select, ctes):
    df = getattr(HotInputs(spark, SF_SMALL), mart)()
    rel = duck.sql(O.q(select, *ctes, base=hot_base()))
    assert _same(df, rel)


def test_hot_month_has_one_first_deal(spark):
    i = HotInputs(spark, SF_MID)
    p2 = i.p2().where(F.col("user_id") == HOT)
    per_month = p2.groupBy("year", "month").agg(F.sum("is_first_valid_deal").alias("n"), F.count("*").alias("rows"))
    assert per_month.agg(F.max("rows")).first()[0] > 10
    assert per_month.agg(F.max("n")).first()[0] <= 1


def test_busy_person_month_is_split_by_aqe(spark):
    """All records of one month on one person: the deals side of P2's join comes from its own shuffle and is split."""
    class OneMonth(HotInputs):
        @property
        def accounting(self):
            a = super().accounting
            busy = F.col("responsible_id") == HOT
            return a.withColumn("realization_date", F.when(busy, F.lit("2000-03-10").cast("date")).otherwise(F.col("realization_date")))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = OneMonth(spark, SF_MID).p2()
        execution = df._jdf.queryExecution()
        execution.toRdd().count()
        assert "skew=true" in execution.executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
