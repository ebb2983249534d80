"""Operator 10, exact dedup by progressive refinement: length, then prefix hash, then full hash.

The first scan gives each row only its length and the hash of a short prefix. Rows alone in their length, or alone
in their (length, prefix) group, can have no copy and go. Only for the surviving groups is the whole text hashed.
All grouping is on narrow rows with map-side combining; the wide text is never grouped.

Defined cases: null text counts as empty; texts are equal when identical after white-space runs become one space;
of equal texts the smallest doc_id stays (null ids only if there is no other); rows that repeat an id and a text
are copies in the count and share the flag; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import SPACE, crosscheck_columns, marked, stage, table

#: Code points of the prefix that the second level hashes.
PREFIX = 64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def copy_groups(docs: DataFrame, prefix: int = PREFIX) -> DataFrame:
    """One row per text that occurs more than once: digest (sha256 hex), keep_id, group_size."""
    crosscheck_columns(docs, "doc_id", "text")
    rows = docs.select(F.col("doc_id"), normalised(F.col("text")).alias("body"))
    key = rows.select(F.char_length("body").alias("len"), F.xxhash64(F.left("body", F.lit(prefix))).alias("head"))
    # level 2 counts contain level 1: their sums by length give the lengths that more than one row has
    heads = stage(key.groupBy("len", "head").agg(F.count("*").alias("n")), "heads")
    lengths = heads.groupBy("len").agg(F.sum("n").alias("n")).where("n > 1").select("len")
    left = (heads.join(lengths, "len", "left_semi").where("n > 1")
            .select(F.xxhash64("len", "head").alias("key")))
    # level 3: whole texts of surviving groups only, hashed in the scan; a row that a bitmap collision lets through has
    # no equal digest and goes with the count
    key = F.xxhash64(F.char_length("body"), F.xxhash64(F.left("body", F.lit(prefix))))
    full = marked(rows, key, left).where("maybe").select("doc_id", F.sha2("body", 256).alias("digest"))
    return (full.groupBy("digest").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
            .where("group_size > 1"))


def exact_dedup(docs: DataFrame, prefix: int = PREFIX) -> DataFrame:
    """Every row with keep_id, group_size, kept and text_sha256; dropped rows too."""
    groups = stage(copy_groups(docs, prefix), "copies").withColumnRenamed("digest", "text_sha256")
    rows = docs.select("doc_id", F.sha2(normalised(F.col("text")), 256).alias("text_sha256"))
    # groups is read back from files, so both sides meet in plain exchanges and a hot digest can be split
    out = rows.join(groups, "text_sha256", "left")
    return out.select("doc_id", F.coalesce("keep_id", "doc_id").alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                      F.col("doc_id").eqNullSafe(F.coalesce("keep_id", "doc_id")).alias("kept"), "text_sha256")


def query(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id IS NOT DISTINCT FROM min(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
