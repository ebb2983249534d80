"""Operator 1, variable-capacity best-fit packing of documents into training sequences.

Documents become pieces of at most the largest permitted length. Pieces are dealt to shards by a hash, so that a shard
holds about SHARD_ITEMS pieces whatever the input; only (id, lengths) go through Python, never texts. In a shard the
pieces are placed largest first, each in the open bin it fits most tightly. Where none fits, the bin size of least
cost per token that it can be expected to hold is opened. Several limits on the size to open are tried jointly; every
plan's bins are then downsized to the smallest permitted length that holds their contents, and the plan of least total
cost stays. The cost of a sequence is its length plus a fixed overhead.

Defined cases: null or empty text gives one piece without tokens and without a bin; texts longer than the largest
length give several pieces; ties are broken by (doc_id, copy, piece), so results do not depend on row order; repeated
rows of one id are packed as copies 0, 1, ...; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.common import ID, crosscheck_columns, packed_id, stage, table, unpacked_id, words

#: Permitted sequence lengths in tokens, the overhead of a sequence, and pieces in a shard on average.
CAPACITIES = (512, 1024, 2048, 4096, 8192)
OVERHEAD = 32
SHARD_ITEMS = 4096


def pack(sizes: list[int], capacities: tuple[int, ...], overhead: int, largest: int) -> tuple[list[int], list[int]]:
    """Place sizes (largest first, all positive) opening bins of at most ``largest`` where the item allows it.

    Returns each item's bin and each bin's opened capacity.
    """
    ahead = sum(sizes)
    free: list[tuple[int, int]] = []  # (room, bin), sorted
    where, opened = [], []
    for s in sizes:
        ahead -= s
        k = bisect_left(free, (s, -1))
        if k < len(free):
            room, b = free.pop(k)
        else:
            fits = [c for c in capacities if c >= s]
            allowed = [c for c in fits if c <= largest] or fits[:1]
            room = min(allowed, key=lambda c: ((c + overhead) / (s + min(c - s, ahead)), c))
            b = len(opened)
            opened.append(room)
        where.append(b)
        if room > s:
            insort(free, (room - s, b))
    return where, opened


def best_plan(sizes: list[int], capacities: tuple[int, ...], overhead: int) -> tuple[list[int], list[int], int]:
    """The cheapest plan after downsizing: each item's bin, each bin's final capacity, the total cost."""
    best = None
    for largest in capacities:
        where, opened = pack(sizes, capacities, overhead, largest)
        fill = [0] * len(opened)
        for s, b in zip(sizes, where):
            fill[b] += s
        final = [capacities[bisect_left(capacities, f)] for f in fill]
        cost = sum(final) + overhead * len(final)
        if best is None or cost < best[2]:
            best = where, final, cost
    return best


def _pack_shard(capacities: tuple[int, ...], overhead: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_tokens", "no_id", "doc_id", "copy", "piece"],
                              ascending=[False, True, True, True, True],
                              kind="stable").reset_index(drop=True)
        sizes = [int(n) for n in pdf["n_tokens"]]
        where, final, _ = best_plan(sizes, capacities, overhead)
        offset, used = [], [0] * len(final)
        for s, b in zip(sizes, where):
            offset.append(used[b])
            used[b] += s
        pdf["bin"] = where
        pdf["bin_offset"] = offset
        pdf["capacity"] = [final[b] for b in where]
        pdf["bin_tokens"] = [used[b] for b in where]
        return pdf[["doc_id", "no_id", "copy", "piece", "start", "n_tokens", "shard", "bin", "bin_offset", "capacity",
                    "bin_tokens"]]
    return run


def best_fit_pack(docs: DataFrame, capacities: tuple[int, ...] = CAPACITIES, overhead: int = OVERHEAD,
                  shard_items: int = SHARD_ITEMS) -> DataFrame:
    """One row per piece: doc_id, copy, piece, start, n_tokens, shard, bin, bin_offset, capacity, bin_tokens.

    (shard, bin) names a sequence; start is the piece's first token in the document, bin_offset its place in the
    sequence. Pieces of documents without tokens have null shard and bin.
    """
    crosscheck_columns(docs, "doc_id", "text")
    capacities = tuple(sorted(set(capacities)))
    top = capacities[-1]
    # equal (id, length) rows are counted first, then numbered: no id that repeats gathers in one shard
    docs = docs.select("doc_id", F.size(words(F.col("text"))).alias("tokens"))
    docs = docs.groupBy("doc_id", "tokens").agg(F.count("*").alias("n"))
    docs = docs.select("doc_id", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
    last = F.greatest(F.ceil(F.col("tokens") / top).cast("int") - 1, F.lit(0))
    pieces = docs.select("doc_id", "copy", "tokens", F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    pieces = pieces.select("doc_id", "copy", "piece", (F.col("piece") * top).alias("start"),
                           F.least(F.lit(top), F.col("tokens") - F.col("piece") * top).alias("n_tokens"))
    pieces = stage(pieces, "pieces")
    filled = pieces.where("n_tokens > 0")
    shards = max(1, -(-filled.count() // shard_items))
    shard = F.pmod(F.xxhash64("doc_id", "copy", "piece", "n_tokens"), F.lit(shards)).cast("int")
    schema = (f"{ID}, copy long, piece int, start int, n_tokens int, shard int, bin int, bin_offset int, "
              "capacity int, bin_tokens int")
    items = filled.select(*packed_id(F.col("doc_id")), "copy", "piece", "start", "n_tokens", shard.alias("shard"))
    packed = items.groupBy("shard").applyInPandas(_pack_shard(capacities, overhead), schema)
    packed = packed.withColumn("doc_id", unpacked_id()).drop("no_id")
    none = F.lit(None).cast("int")
    empty = pieces.where("n_tokens = 0").select("*", *[none.alias(c) for c in (
        "shard", "bin", "bin_offset", "capacity", "bin_tokens")])
    return packed.unionByName(empty)


def query(spark, sf_dir):
    return best_fit_pack(table(spark, sf_dir, "documents"))


ORACLE = None
