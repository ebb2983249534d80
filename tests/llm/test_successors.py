"""The successor of every document, against a sorted list, with ranges of a few rows."""

import pytest
import xxhash
from pyspark.sql import functions as F

from salesmart.llm import fingerprints


def successors(docs, **limits):
    rows, w = fingerprints.with_next(docs, **limits)
    return rows.withColumn("next_text", F.lead("text").over(w)).where("NOT ghost")


def signed(text):
    h = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return h - (1 << 64) if h >> 63 else h


def brute_force(pairs):
    order = sorted(((i, t or "") for i, t in pairs), key=lambda p: (p[0] is None, -(p[0] or 0), signed(p[1])))
    return sorted(((i is None, i or 0, t, order[(j + 1) % len(order)][1]) for j, (i, t) in enumerate(order)))


def made(n):
    out = [(i * 7919 % 1009 - 500, f"text {i}") for i in range(n)]
    out += [(None, f"no id {i}") for i in range(n // 3)] + [(None, None)]     # as many rows without an id as a third
    out += [(5, f"same id {i}") for i in range(n // 3)] + [(7, "same row")] * 40
    return out + [((1 << 62) + 1, "big"), ((1 << 62) + 2, "bigger"), (-(1 << 63) + 1, "smallest")]


@pytest.mark.parametrize("limits", [{}, {"range_rows": 3}, {"range_rows": 1}, {"range_rows": 3, "max_ranges": 4}])
def test_successors_equal_those_of_a_sorted_list(spark, limits):
    pairs = made(300)
    df = spark.createDataFrame(pairs, "doc_id long, text string").repartition(5)
    got = [(r.doc_id is None, r.doc_id or 0, r.text, r.next_text) for r in successors(df, **limits).collect()]
    assert sorted(got) == brute_force(pairs)


def test_one_row_is_its_own_successor(spark):
    df = spark.createDataFrame([(3, "alone")], "doc_id long, text string")
    assert [r.next_text for r in successors(df).collect()] == ["alone"]


def test_ranges_grow_in_number_and_not_in_size(spark, monkeypatch):
    def largest(n):
        rows, _ = fingerprints.with_next(spark.range(n).selectExpr("id AS doc_id", "'t' AS text"), range_rows=50)
        sizes = [r["count"] for r in rows.where("NOT ghost").groupBy("r").count().collect()]
        assert sum(sizes) == n
        return max(sizes), len(sizes)
    monkeypatch.setattr(fingerprints, "GROUP", 8)
    assert largest(1_000) == (50, 20)
    assert largest(20_000) == (50, 400)
