"""Operator 5, document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the sorted array of the k smallest distinct hashes of a text's five-word shingles. Sketches of parts merge
into the sketch of the whole; two sketches estimate resemblance and containment, one estimates the number of distinct
shingles. Everything is built-in SQL functions. With fewer than k distinct shingles all estimates are exact.

``with_next`` gives each document its successor in descending id order without a global sort in one task. Only narrow
keys, the id and a hash of the text, are sorted, over as many partitions as they need; every RANGE_ROWS-th key heads a
range, so the ranges grow in number and not in size. Each document finds its range by halving the sorted heads, in two
levels of GROUP; the head of a range is repeated as a ghost row at the end of the range before (cyclically), and a window
inside each range looks one row ahead. Whole texts are shuffled once. There are at most MAX_RANGES heads (and one for
each SORTED_ROWS keys) of 16 bytes; only beyond RANGE_ROWS * MAX_RANGES documents ranges become longer.

Defined cases: null text counts as empty; an empty sketch resembles another empty one fully and others not at all;
fewer than five words form one shingle; null ids come after all others; rows that repeat an id are ordered by the hash
of their text, so an id of very many rows spreads too; a table of one row is its own successor; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.llm.common import Scratch, crosscheck_columns, let, shingle_hashes, table, words

K = 128
SHINGLE = 5
#: Rows in a range; ranges at most (their heads are broadcast); keys that one task sorts.
RANGE_ROWS = 2048
MAX_RANGES = 1 << 20
SORTED_ROWS = 1 << 20
#: Heads in a group; the driver sees the first one of each group.
GROUP = 1024
_LAST = -(1 << 63)
_IN_PARTITION = (1 << 33) - 1


def sketch(text: Column, k: int = K, n: int = SHINGLE) -> Column:
    return F.slice(F.sort_array(F.array_distinct(shingle_hashes(words(text), n))), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two parts' shingle sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Jaccard estimate: the share of the union's k smallest hashes that both sketches hold."""
    def of(u):
        both = F.size(F.array_intersect(F.array_intersect(u, a), b))
        return F.when(F.size(u) == 0, F.lit(1.0)).otherwise(both / F.size(u))
    return let(merge(a, b, k), of)


def distinct_count(a: Column, k: int = K) -> Column:
    """Distinct shingles: exact below k, else (k - 1) over the share of the hash range below the k-th value."""
    part = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / part)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Share of a's shingles that b holds too, from the resemblance and the sketches' distinct counts."""
    r = resemblance(a, b, k)
    both = r / (1 + r) * (distinct_count(a, k) + distinct_count(b, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / distinct_count(a, k)))


def to_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def _heads(keys: DataFrame, range_rows: int, max_ranges: int) -> DataFrame:
    """One row: the sorted array of the keys (o, h) that head a range."""
    n = keys.count()
    every = max(range_rows, -(-n // max_ranges))
    dealt = keys.repartitionByRange(max(1, -(-n // SORTED_ROWS)), "o", "h").sortWithinPartitions("o", "h")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))
    heads = dealt.withColumn("place", place).where(F.col("place") % every == 0)
    return heads.agg(F.array_sort(F.collect_set(F.struct("o", "h"))).alias("heads"))


def _range(key: Column, heads: Column) -> Column:
    """Number of the range of a key: the heads at or below it, found by halving, less one."""
    def find(all_heads):
        def step(at, _):
            mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
            right = (at["lo"] < at["hi"]) & (F.get(all_heads, mid) <= key)
            return F.struct(F.when(right, mid + 1).otherwise(at["lo"]).alias("lo"),
                            F.when(right | (at["lo"] >= at["hi"]), at["hi"]).otherwise(mid).alias("hi"))
        start = F.struct(F.lit(0).alias("lo"), F.size(all_heads).alias("hi"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(31)), start, step)["lo"] - 1
    return let(heads, find)


def with_next(docs: DataFrame, range_rows: int = RANGE_ROWS, max_ranges: int = MAX_RANGES) -> tuple[DataFrame, Window]:
    """(o, h, doc_id, text, r, ghost) rows with ghosts, and the window in which the next row is the successor."""
    crosscheck_columns(docs, "doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    # ascending o is descending id, with null ids last
    order = F.bitwise_not(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))).alias("o")
    rows = docs.select(order, F.xxhash64(text).alias("h"), "doc_id", text.alias("text"))
    heads = Scratch(docs.sparkSession).stage(_heads(rows.select("o", "h"), range_rows, max_ranges), "heads")
    ghosts = heads.select(F.size("heads").alias("m"), F.posexplode("heads").alias("i", "head")).select(
        F.pmod(F.col("i") - 1, F.col("m")).alias("r"), F.col("head.o").alias("o"), F.col("head.h").alias("h"))
    # max_ranges rows at most, and one text of each
    ghosts = rows.join(F.broadcast(ghosts), ["o", "h"]).withColumn("ghost", F.lit(True)).dropDuplicates(["r"])
    starts = F.sequence(F.lit(0), F.greatest(F.size("heads") - 1, F.lit(0)), F.lit(GROUP))
    groups = heads.select(F.posexplode(F.transform(starts, lambda i: F.slice("heads", i + 1, GROUP))).alias("g", "fine"))
    firsts = heads.select(F.transform(starts, lambda i: F.get("heads", i)).alias("firsts")).first().firsts
    firsts = ", ".join(f"named_struct('o', {f.o}L, 'h', {f.h}L)" for f in firsts if f) or "named_struct('o', 0L, 'h', 0L)"
    key = F.struct("o", "h")
    rows = rows.withColumn("g", _range(key, F.expr(f"array({firsts})"))).join(F.broadcast(groups), "g")
    rows = rows.withColumn("r", F.col("g") * GROUP + _range(key, F.col("fine"))).drop("g", "fine")
    rows = rows.withColumn("ghost", F.lit(False))
    return rows.unionByName(ghosts), Window.partitionBy("r").orderBy("ghost", "o", "h")


def edited_fingerprints(docs: DataFrame, k: int = K, n: int = SHINGLE) -> DataFrame:
    """Fingerprints of every text and of its edited form: the last half replaced by the next document's start."""
    rows, w = with_next(docs)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("next_text", F.lead("text").over(w)).withColumn("n_chars", F.char_length("text"))
    edited = F.concat(F.left("text", F.col("n_chars") - half), F.left("next_text", half))
    rows = rows.withColumn("fp", sketch(F.col("text"), k, n)).withColumn("edited", edited)
    rows = rows.withColumn("next_fp", F.lead("fp").over(w)).where("NOT ghost")
    return rows.withColumn("edited_fp", sketch(F.col("edited"), k, n)).select(
        "doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        "fp", "edited_fp", resemblance(F.col("fp"), F.col("edited_fp"), k).alias("near_edited"),
        resemblance(F.col("fp"), F.col("next_fp"), k).alias("near_next"),
        distinct_count(F.col("fp"), k).alias("n_distinct"),
        containment(F.col("fp"), F.col("edited_fp"), k).alias("contained"))


def query(spark, sf_dir):
    out = edited_fingerprints(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", "edited_sha256", to_text(F.col("fp")).alias("fingerprint"),
                      to_text(F.col("edited_fp")).alias("edited_fingerprint"), "near_edited", "near_next",
                      "n_distinct", "contained")


ORACLE = None
