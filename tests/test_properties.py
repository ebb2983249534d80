"""Invariants of the marts on the driver's fixture tables."""

from pyspark.sql import functions as F

from paths import SF_MID
from salesmart.plans import activity
from salesmart.plans.catalog import Inputs
from salesmart.sources.snapshot import snapshot_day_filter


def test_agg_income_total_equals_typed_deal_income(spark):
    i = Inputs(spark, SF_MID)
    p2 = i.p2()
    lhs = i.p3().agg(F.sum("deal_income")).first()[0]
    rhs = p2.where(F.col("property_type").isNotNull()).agg(F.sum("income")).first()[0]
    assert lhs == rhs


def test_at_most_one_first_flag_per_person_month(spark):
    i = Inputs(spark, SF_MID)
    for df, flag in ((i.p2(), "is_first_valid_deal"),
                     (activity.traffic_arm_snapshot(i.snapshot(snapshot_day_filter()), i.accounting), "is_first_occurrence")):
        worst = df.groupBy("user_id", "year", "month").agg(F.sum(flag).alias("n")).agg(F.max("n")).first()[0]
        assert worst <= 1


def test_newcomer_arm_has_exactly_one_flag(spark):
    i = Inputs(spark, SF_MID)
    assert activity.traffic_arm_newcomers(i.accounting, i.users).agg(F.sum("is_first_occurrence")).first()[0] == 1


def test_empty_rows_only_without_deals(spark):
    p2 = Inputs(spark, SF_MID).p2()
    keys = ["user_id", "year", "month"]
    empty = p2.where(F.col("ata_id").isNull()).select(*keys)
    with_deals = p2.where(F.col("ata_id").isNotNull()).select(*keys)
    assert empty.join(with_deals, keys, "left_semi").count() == 0
    assert empty.count() == empty.distinct().count()


def test_result_independent_of_shuffle_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = sorted(map(tuple, Inputs(spark, SF_MID).p4().collect()))
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        b = sorted(map(tuple, Inputs(spark, SF_MID).p4().collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_mart_keys_are_unique(spark):
    i = Inputs(spark, SF_MID)
    checks = [(i.p2().where(F.col("ata_id").isNotNull()), ["user_id", "year", "month", "ata_id"]),
              (i.p4(), ["month", "year", "user_id", "ata_id"]), (i.p5(), ["month", "year", "user_id", "status"]),
              (i.p6(), ["month", "year", "id"]), (i.p7(), ["date", "exp"]), (i.p9(), ["id"])]
    for df, keys in checks:
        assert df.groupBy(*keys).count().where("count > 1").count() == 0, keys
