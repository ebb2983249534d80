"""Operator 13, filter interaction audit by failing-id relations.

Every filter gets a stored table of the ids that fail it. Going through the filters once, the rows are split at each by
a left-semi and a left-anti join with its table: what fails goes on with the filter's bit set, what does not goes on as
it is. After the last filter each row stands in the cell of exactly those filters it fails, and two more semi/anti
splits with the ids of good and of toxic rows give the label losses. A prefix's survivors, removals and redundancies,
in whatever order its filters came, are unions of cells, so the cells' counts (2^filters a part at most) give the rows
of all orders without another join.

Rows meet by (id, hash of the text), with a value in place of a null id and that it was null in the hash: all filters but the last depend on the text alone and that one on both, so rows
that repeat both share their fate; they are counted before the first join and stay one row of it. Joins read stored
tables, so a busy id can be split.

Defined cases: null text counts as empty, and an empty text has no words (it fails the word count and nothing else by
its text); a null id is never a copy of a smaller id and has no label; of rows that repeat an id, equal texts are no
copies of each other; a null part is the empty string; labels may repeat an id (one good row makes it good) and hold
nulls; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import SPACE, Scratch, crosscheck_columns, let, table

KEY = ["id", "h"]
#: Most filters of one audit: their orders are listed in the result, n! a part.
MOST_FILTERS = 6


def short(text: Column, ws: Column) -> Column:
    return F.size(ws) < 100


def repetitive(text: Column, ws: Column) -> Column:
    return F.size(F.array_distinct(ws)) * 100 < F.size(ws) * 80


def shouting(text: Column, ws: Column) -> Column:
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return capitals.cast("long") * 100 > F.char_length(text).cast("long") * 10


def symbols(text: Column, ws: Column) -> Column:
    return text.rlike(r"[#$%&*|]")


#: Filters by letter: true where a text fails. COPY is the filter on the whole table: equal to a smaller id's text.
TEXT_FILTERS: dict[str, Callable[[Column, Column], Column]] = {"A": short, "B": repetitive, "C": shouting, "D": symbols}
COPY = "E"


def facts(docs: DataFrame, filters: dict[str, Callable[[Column, Column], Column]], part: str) -> DataFrame:
    """One row per (doc_id, text, part): its count, the text's digest, and whether it fails each filter on texts."""
    body = docs.select("doc_id", F.coalesce(F.col(part), F.lit("")).alias("part"),
                       F.coalesce(F.col("text"), F.lit("")).alias("text"))
    ws = F.array_remove(F.split("text", SPACE), "")
    failing = let(ws, lambda w: F.struct(*[test(F.col("text"), w).alias(name) for name, test in filters.items()]))
    h = F.xxhash64("text", F.col("doc_id").isNull())
    rows = body.select("doc_id", "part", h.alias("h"), F.unhex(F.sha2("text", 256)).alias("digest"), failing.alias("fails"))
    flags = [F.col(f"fails.{name}").alias(f"fails_{name}") for name in filters]
    names = [f"fails_{name}" for name in filters]
    return (rows.select("doc_id", "part", "h", "digest", *flags)
            .groupBy("doc_id", "part", "h", "digest", *names).agg(F.count("*").alias("n"))
            .withColumn("id", F.coalesce("doc_id", F.lit(0))))


def copies(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Keys of rows whose text a smaller id has too."""
    first = scratch.stage(rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
                          .where("last > first").select("digest", "first"), "texts")
    return rows.join(first, "digest").where("doc_id > first").select(*KEY).distinct()


def split(rows: DataFrame, ids: DataFrame, on: list[str], bit: int) -> DataFrame:
    """All rows, those found in ids by a semi join with the bit set in their mask, the others by an anti join."""
    held = rows.join(ids, on, "left_semi").withColumn("mask", F.col("mask").bitwiseOR(F.lit(bit)))
    return held.select(*rows.columns).unionByName(rows.join(ids, on, "left_anti").select(*rows.columns))


def cells(docs: DataFrame, labels: DataFrame, filters=None, copy: str = COPY, part: str = "lang") -> DataFrame:
    """Rows per part and set of failed filters (a bit each, in the order of the filters): n, good, toxic."""
    filters = TEXT_FILTERS if filters is None else filters
    crosscheck_columns(docs, "doc_id", "text", part)
    crosscheck_columns(labels, "doc_id", "quality", "toxic")
    scratch = Scratch(docs.sparkSession)
    all_rows = scratch.stage(facts(docs, filters, part), "facts")
    relations = [(all_rows.where(f"fails_{name}").select(*KEY).distinct(), KEY) for name in filters]
    relations.append((copies(all_rows, scratch), KEY))
    label = labels.where("doc_id is not null")
    relations += [(label.where(f"{name} = 1").select("doc_id").distinct(), ["doc_id"]) for name in ("quality", "toxic")]
    stored = [(scratch.stage(ids, "failing"), on) for ids, on in relations]
    rows = all_rows.select(*KEY, "doc_id", "part", "n", F.lit(0).alias("mask"))
    for i, (ids, on) in enumerate(stored):
        rows = scratch.stage(split(rows, ids, on, 1 << i), "split")
    k = len(filters) + 1

    def losses(bit: int) -> Column:
        return F.sum(F.when(F.col("mask").bitwiseAND(F.lit(1 << bit)) != 0, F.col("n")).otherwise(0))
    mask = F.col("mask").bitwiseAND(F.lit((1 << k) - 1))
    return rows.groupBy("part", mask.alias("fails")).agg(
        F.sum("n").alias("n"), losses(k).alias("good"), losses(k + 1).alias("toxic"))


def report(found: DataFrame, names: list[str]) -> DataFrame:
    """One row per part, order of the filters and step, from the cells' counts."""
    if len(names) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters can be audited in all their orders; there are {len(names)}")
    orders = ["".join(p) for p in permutations(names)]
    # a part has at most 2^filters cells, so its list is bounded
    by_part = found.groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("cells"))
    rows = by_part.select("part", "cells", F.explode(F.array(*map(F.lit, orders))).alias("filter_order"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.lit(len(names)))).alias("step"))

    def bits(condition) -> Column:
        total = F.lit(0)
        for i, name in enumerate(names):
            total = total + F.when(condition(F.instr("filter_order", name)), F.lit(1 << i)).otherwise(F.lit(0))
        return total
    rows = rows.select("*", bits(lambda at: at < F.col("step")).alias("before"),
                       bits(lambda at: at == F.col("step")).alias("own"))
    before, own = F.col("before"), F.col("own")

    def total(value: Callable[[Column], Column], holds: Callable[[Column], Column]) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"),
                           lambda acc, c: acc + F.when(holds(c["fails"]), value(c)).otherwise(F.lit(0).cast("long")))

    def count(c: Column) -> Column:
        return c["n"]

    def fails(m: Column) -> Column:
        return m.bitwiseAND(own) != 0

    def gone(m: Column) -> Column:
        return m.bitwiseAND(before) != 0

    def removed(m: Column) -> Column:
        return fails(m) & ~gone(m)
    # of the orders of the filters that a row fails, an equal share has each of them first
    def first_orders(c: Column) -> Column:
        k, weight = F.bit_count(c["fails"]), F.lit(0).cast("long")
        for failed in range(1, len(names) + 1):
            weight = F.when(k == failed, F.lit(len(orders) // failed).cast("long")).otherwise(weight)
        return c["n"] * weight
    return rows.select(
        "part", "filter_order", "step",
        total(count, lambda m: ~gone(m) & ~fails(m)).alias("kept"), total(count, removed).alias("removed"),
        total(count, lambda m: fails(m) & gone(m)).alias("redundant"),
        total(count, lambda m: m == own).alias("unique_fails"),
        total(lambda c: c["good"], removed).alias("good_lost"), total(lambda c: c["toxic"], removed).alias("toxic_lost"),
        total(first_orders, fails).alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, filters=None, copy: str = COPY, part: str = "lang") -> DataFrame:
    """The audit of the filters on texts and of the copy filter, for every part and order."""
    filters = TEXT_FILTERS if filters is None else filters
    return report(cells(docs, labels, filters, copy, part), [*filters, copy])


def query(spark, sf_dir):
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
f AS (
  SELECT d.part, len(ws) < 100 AS a, 100 * len(list_distinct(ws)) < 80 * len(ws) AS b,
         100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), FALSE) AS e,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL), FALSE) AS good,
         coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL), FALSE) AS toxic FROM d),
x AS (
  SELECT *, CAST(a AS INT) + CAST(b AS INT) + CAST(c AS INT) + CAST(d AS INT) + CAST(e AS INT) AS fails FROM f),
l(letter) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM l a, l b, l c, l d, l e
  WHERE len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5),
cells AS (
  SELECT part, a, b, c, d, e, fails, count(*) AS n, count(*) FILTER (WHERE good) AS good,
         count(*) FILTER (WHERE toxic) AS toxic FROM x GROUP BY ALL),
s AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter, n, good, toxic, fails,
         (a AND instr(filter_order, 'A') < step) OR (b AND instr(filter_order, 'B') < step)
         OR (c AND instr(filter_order, 'C') < step) OR (d AND instr(filter_order, 'D') < step)
         OR (e AND instr(filter_order, 'E') < step) AS gone,
         CASE substr(filter_order, step, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END
         AS bad
  FROM cells, o, (VALUES (1), (2), (3), (4), (5)) v(step)),
r AS (
  SELECT part, filter_order, step, any_value(letter) AS letter,
         coalesce(sum(n) FILTER (WHERE NOT gone AND NOT bad), 0) AS kept,
         coalesce(sum(n) FILTER (WHERE NOT gone AND bad), 0) AS removed,
         coalesce(sum(n) FILTER (WHERE gone AND bad), 0) AS redundant,
         coalesce(sum(n) FILTER (WHERE bad AND fails = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (WHERE NOT gone AND bad), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (WHERE NOT gone AND bad), 0) AS toxic_lost
  FROM s GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM r
"""
