"""Upsert semantics and the partition-rewriting write path."""

import os

import pytest
from pyspark.sql import functions as F

from salesmart.operators.upsert import (ACTION, DuplicateKeyError, check_unique, insert_if_absent, merge,
                                        rewrite_partitions, upsert_table)
from salesmart.operators.versioned import read_table

SCHEMA = "year int, month int, k string, v int, note string"


def _key(t):
    return tuple((x is None, "" if x is None else x) for x in t)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=_key)


def test_merge_insert_update_keep(spark):
    t = spark.createDataFrame([(2000, 1, "a", 1, "t"), (2000, 1, "b", 2, "t"), (2000, 1, None, 3, "t")], SCHEMA)
    s = spark.createDataFrame([(2000, 1, "a", 10, "s"), (2000, 1, "c", 30, "s"), (2000, 1, None, 40, "s")], SCHEMA)
    out = merge(t, s, ["year", "month", "k"], update_cols=["v"], with_action=True)
    got = {(r.k, r.v, r.note, r[ACTION]) for r in out.collect()}
    assert got == {("a", 10, "t", "updated"), ("b", 2, "t", "kept"), ("c", 30, "s", "inserted"),
                   (None, 40, "t", "updated")}


def test_merge_nulls_distinct_appends(spark):
    t = spark.createDataFrame([(2000, 1, None, 3, "t")], SCHEMA)
    s = spark.createDataFrame([(2000, 1, None, 40, "s")], SCHEMA)
    assert merge(t, s, ["year", "month", "k"], nulls_distinct=True).count() == 2


def test_duplicate_source_key_rejected(spark):
    s = spark.createDataFrame([(2000, 1, "a", 1, "x"), (2000, 1, "a", 2, "y")], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        check_unique(s, ["year", "month", "k"])


def test_insert_if_absent(spark):
    t = spark.createDataFrame([(2000, 1, None, 1, "t"), (2000, 2, "x", 1, "t")], SCHEMA)
    s = spark.createDataFrame([(2000, 1, None, 5, "s"), (2000, 2, None, 6, "s")], SCHEMA)
    out = insert_if_absent(t, s, ["year", "month"], absent_when=F.col("k").isNull())
    assert rows(out) == sorted([(2000, 1, None, 1, "t"), (2000, 2, "x", 1, "t"), (2000, 2, None, 6, "s")], key=_key)


def _files(path):
    out = {}
    for root, _dirs, files in os.walk(path):
        for f in files:
            if f.endswith(".parquet"):
                p = os.path.join(root, f)
                out[p] = os.path.getmtime(p)
    return out


def test_upsert_table_rewrites_only_touched_partitions_and_is_idempotent(spark, scratch):
    path = os.path.join(scratch, "mart")
    first = spark.createDataFrame([(2000, 1, "a", 1, "t"), (2000, 2, "b", 2, "t"), (2000, 3, "c", 3, "t")], SCHEMA)
    res = upsert_table(spark, path, first, ["year", "month", "k"], partition_cols=["year", "month"])
    assert (res.inserted, res.updated) == (3, 0)
    before = _files(path)
    untouched = {p: m for p, m in before.items() if "month=3" in p}
    src = spark.createDataFrame([(2000, 1, "a", 10, "s"), (2000, 2, "z", 9, "s")], SCHEMA)
    res = upsert_table(spark, path, src, ["year", "month", "k"], partition_cols=["year", "month"])
    assert (res.inserted, res.updated, res.kept, res.partitions_rewritten) == (1, 1, 1, 2)
    after = _files(path)
    assert {p: m for p, m in after.items() if "month=3" in p} == untouched
    table = read_table(spark, path).select("year", "month", "k", "v", "note")
    expected = sorted([(2000, 1, "a", 10, "s"), (2000, 2, "b", 2, "t"), (2000, 2, "z", 9, "s"), (2000, 3, "c", 3, "t")],
                      key=_key)
    assert rows(table) == expected
    upsert_table(spark, path, src, ["year", "month", "k"], partition_cols=["year", "month"])   # run again
    assert rows(read_table(spark, path).select("year", "month", "k", "v", "note")) == expected


def test_upsert_into_empty_target_is_source(spark, scratch):
    path = os.path.join(scratch, "fresh")
    src = spark.createDataFrame([(2000, 1, "a", 1, "s"), (2000, 1, None, 2, "s")], SCHEMA)
    upsert_table(spark, path, src, ["year", "month", "k"])
    assert rows(read_table(spark, path).select("year", "month", "k", "v", "note")) == rows(src)


def test_precedence_chooses_among_duplicate_keys(spark, scratch):
    path = os.path.join(scratch, "prec")
    src = spark.createDataFrame([(2000, 1, "a", 1, "old"), (2000, 1, "a", 5, "new"), (2000, 1, "b", 2, "x")], SCHEMA)
    upsert_table(spark, path, src, ["year", "month", "k"], partition_cols=["year", "month"], precedence=["v"])
    got = rows(read_table(spark, path).select("year", "month", "k", "v", "note"))
    assert got == sorted([(2000, 1, "a", 5, "new"), (2000, 1, "b", 2, "x")], key=_key)


def test_rebuild_replaces_touched_partitions(spark, scratch):
    path = os.path.join(scratch, "rebuild")
    first = spark.createDataFrame([(2000, 1, "a", 1, "t"), (2000, 2, "b", 2, "t")], SCHEMA)
    upsert_table(spark, path, first, ["year", "month", "k"], partition_cols=["year", "month"])
    src = spark.createDataFrame([(2000, 1, "c", 3, "s")], SCHEMA)
    res = upsert_table(spark, path, src, ["year", "month", "k"], partition_cols=["year", "month"], rebuild=True)
    assert (res.inserted, res.updated, res.kept) == (1, 0, 0)
    got = rows(read_table(spark, path).select("year", "month", "k", "v", "note"))
    assert got == sorted([(2000, 1, "c", 3, "s"), (2000, 2, "b", 2, "t")], key=_key)


def test_upsert_table_rejects_duplicate_keys_before_writing(spark, scratch):
    path = os.path.join(scratch, "dups")
    first = spark.createDataFrame([(2000, 1, "a", 1, "t")], SCHEMA)
    upsert_table(spark, path, first, ["year", "month", "k"], partition_cols=["year", "month"])
    dup = spark.createDataFrame([(2000, 1, "b", 1, "x"), (2000, 1, "b", 2, "y")], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        upsert_table(spark, path, dup, ["year", "month", "k"], partition_cols=["year", "month"])
    assert rows(read_table(spark, path).select("year", "month", "k", "v", "note")) == [(2000, 1, "a", 1, "t")]


def test_failed_write_leaves_the_table_and_the_next_run_completes_it(spark, scratch):
    for parts in ([], ["year", "month"]):
        path = os.path.join(scratch, f"fail{len(parts)}")
        first = spark.createDataFrame([(2000, 1, "a", 1, "t"), (2000, 2, "b", 2, "t")], SCHEMA)
        upsert_table(spark, path, first, ["year", "month", "k"], parts)
        src = spark.createDataFrame([(2000, 1, "a", 10, "s"), (2000, 2, "c", 3, "s")], SCHEMA)
        broken = F.when(F.col("k") == "c", F.raise_error(F.lit("lost"))).otherwise(F.col("v")).cast("int")

        def combine(current, staged):
            return merge(current.select(*staged.columns), staged, ["year", "month", "k"]).withColumn("v", broken)
        with pytest.raises(Exception, match="lost"):
            rewrite_partitions(spark, path, src, combine, parts)
        assert rows(read_table(spark, path).select(*first.columns)) == rows(first)
        upsert_table(spark, path, src, ["year", "month", "k"], parts)
        assert [r[2:4] for r in rows(read_table(spark, path).select(*first.columns))] == [("a", 10), ("b", 2), ("c", 3)]


def test_nulls_distinct_still_rejects_repeated_whole_keys(spark, scratch):
    src = spark.createDataFrame([(2000, 1, "a", 1, "x"), (2000, 1, "a", 2, "y"), (2000, 1, None, 1, "x")], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        upsert_table(spark, os.path.join(scratch, "nd"), src, ["year", "month", "k"], nulls_distinct=True)
    twice = src.where("k IS NULL").unionAll(src.where("k IS NULL"))
    upsert_table(spark, os.path.join(scratch, "nd"), twice, ["year", "month", "k"], nulls_distinct=True)
    assert read_table(spark, os.path.join(scratch, "nd")).count() == 2
