"""Reconciliation of stored marts, writers that meet, retention, and the hot-key lookup."""

import pytest
from pyspark.sql import functions as F

from salesmart.operators import versioned as V
from salesmart.operators.hot_join import hot_keys, hot_left_lookup
from salesmart.operators.reconcile import ACTION, reconcile, reconcile_table
from salesmart.operators.upsert import upsert_table

COLS = "year int, month int, id long, v string, note string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_reconcile_ends_owned_rows_only(spark):
    old = spark.createDataFrame([(2000, 1, 1, "a", "x"), (2000, 1, 2, "b", "x"), (1999, 1, 3, "c", "x"), (None, None, None, "n", "x"),
                                 (2000, 2, None, "d", "x")], COLS)
    new = spark.createDataFrame([(2000, 1, 1, "A", "y"), (2000, 3, 9, "new", "y"), (2000, 2, None, "D", "y")], COLS)
    keys = ["year", "month", "id"]
    got = reconcile(old, new, keys, F.col("year") == 2000, update_cols=["v"])
    assert rows(got) == sorted([(2000, 1, 1, "A", "x"), (2000, 3, 9, "new", "y"), (2000, 2, None, "D", "x"),
                                (1999, 1, 3, "c", "x"), (None, None, None, "n", "x")], key=str)
    marked = reconcile(old, new, keys, F.col("year") == 2000, ended={"note": F.lit("ended")}, with_action=True)
    assert {(r.id, r.note) for r in marked.collect() if r[ACTION] == "ended"} == {(2, "ended")}
    assert sorted(r[ACTION] for r in marked.collect()) == ["ended", "inserted", "kept", "kept", "updated", "updated"]
    with pytest.raises(ValueError, match="differ"):
        reconcile(old, new.drop("v"), keys, F.lit(True))
    with pytest.raises(ValueError, match="lacks"):
        reconcile(old, new, keys, F.lit(True), ended={"closed": F.lit(1)})


def test_reconcile_table_drops_partitions_that_became_empty(spark, scratch):
    path = f"{scratch}/t"
    old = [(2000, 1, 1, "a", ""), (2000, 2, 2, "b", ""), (2000, 2, 3, "c", ""), (1999, 5, 4, "d", "")]
    V.publish(spark, path, spark.createDataFrame(old, COLS), ["year", "month"])
    new = spark.createDataFrame([(2000, 2, 2, "B", ""), (2000, 4, 8, "e", "")], COLS)
    owned = ["year=2000/month=1", "year=2000/month=2", "year=2000/month=4"]
    got = reconcile_table(spark, path, new, ["year", "month", "id"], ["year", "month"], owned)
    assert got == {"inserted": 1, "updated": 1, "kept": 0, "ended": 2}
    assert V.partitions(spark, path) == ["year=1999/month=5", "year=2000/month=2", "year=2000/month=4"]
    assert rows(V.read_table(spark, path)) == sorted([(2000, 2, 2, "B", ""), (2000, 4, 8, "e", ""), (1999, 5, 4, "d", "")], key=str)
    with pytest.raises(ValueError, match="does not own"):
        reconcile_table(spark, path, new, ["year", "month", "id"], ["year", "month"], owned[:1])
    empty = reconcile_table(spark, path, new.limit(0), ["year", "month", "id"], ["year", "month"], owned)
    assert empty["ended"] == 2 and V.partitions(spark, path) == ["year=1999/month=5"]


def test_a_writer_that_started_from_an_older_state_fails(spark, scratch):
    path = f"{scratch}/t"
    one = spark.createDataFrame([(2000, 1, 1, "a", "")], COLS)
    V.publish(spark, path, one, ["year", "month"])
    known = V.snapshot(spark, path)
    V.publish(spark, path, one.withColumn("v", F.lit("other writer")), ["year", "month"])
    with pytest.raises(RuntimeError, match="published first"):
        V.publish(spark, path, one.withColumn("v", F.lit("late")), ["year", "month"], known=known)
    assert [r.v for r in V.read_table(spark, path).collect()] == ["other writer"]


def test_an_upsert_fails_when_another_write_came_between(spark, scratch, monkeypatch):
    path = f"{scratch}/t"
    df = spark.createDataFrame([(2000, 1, 1, "a", "")], COLS)
    upsert_table(spark, path, df, ["id"], ["year", "month"])
    real = V.stage

    def stage(*args):
        monkeypatch.setattr(V, "stage", real)
        V.publish(spark, path, df.withColumn("id", F.lit(2).cast("long")), ["year", "month"])
        return real(*args)
    monkeypatch.setattr(V, "stage", stage)
    with pytest.raises(RuntimeError, match="published first"):
        upsert_table(spark, path, df.withColumn("v", F.lit("b")), ["id"], ["year", "month"])
    assert [(r.id, r.v) for r in V.read_table(spark, path).collect()] == [(2, "a")]


def test_an_unfinished_manifest_is_passed_over(spark, scratch):
    path = f"{scratch}/t"
    df = spark.createDataFrame([(2000, 1, 1, "a", "")], COLS)
    V.publish(spark, path, df, ["year", "month"])
    with open(f"{path}/_manifest/{2:012d}.json", "w") as f:
        f.write('{"schema": {')
    assert V.read_table(spark, path).count() == 1
    V.publish(spark, path, df.withColumn("v", F.lit("b")), ["year", "month"])
    assert [r.v for r in V.read_table(spark, path).collect()] == ["b"]


def test_retention_keeps_the_newest_state(spark, scratch):
    path = f"{scratch}/t"
    for i in range(4):
        V.publish(spark, path, spark.createDataFrame([(2000, 1 + i % 2, i, "a", "")], COLS), ["year", "month"])
    before = rows(V.read_table(spark, path))
    assert V.retain(spark, path, 1) == 2
    assert rows(V.read_table(spark, path)) == before == [(2000, 1, 2, "a", ""), (2000, 2, 3, "a", "")]
    with pytest.raises(ValueError):
        V.retain(spark, path, 0)


def test_hot_key_lookup_equals_the_plain_join_and_spreads(spark):
    """A third of the facts on one key, many NULLs: no partition of the join gets more than 3 times the median."""
    n = 60_000
    fact = spark.range(n).select(F.col("id").alias("ata_id"), F.when(F.col("id") % 3 == 0, F.lit(7)).when(
        F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") % 9973).alias("deal_id"))
    dim = spark.range(9000).select(F.col("id").alias("d_id"), F.concat(F.lit("d"), "id").alias("label"))
    assert hot_keys(fact, "deal_id") == [7]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = hot_left_lookup(fact, dim, "deal_id", "d_id")
        sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect())
        want = fact.join(dim, fact["deal_id"] == dim["d_id"], "left").drop("d_id")
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
        plain = sorted(r["count"] for r in want.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2]
    assert plain[-1] > 3 * plain[len(plain) // 2], "the plain join is skewed"


def test_hot_key_lookup_edges(spark):
    fact = spark.createDataFrame([(1, None), (2, 5), (2, 5)], "ata_id long, deal_id long")
    dim = spark.createDataFrame([(5, "x"), (None, "null key")], "d_id long, label string")
    assert rows(hot_left_lookup(fact, dim, "deal_id", "d_id")) == [(1, None, None), (2, 5, "x"), (2, 5, "x")]
    assert hot_left_lookup(fact.limit(0), dim, "deal_id", "d_id").count() == 0
    with pytest.raises(ValueError, match="both sides"):
        hot_left_lookup(fact, dim.withColumnRenamed("label", "ata_id"), "deal_id", "d_id")
