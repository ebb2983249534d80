"""Lookup join that survives hot foreign keys.

``left_lookup`` (operators.joins) salts NULL keys. A value can be just as hot: a third of all facts on one deal lands in
one shuffle partition. ``hot_left_lookup`` finds such keys first, by a sketch of fixed size over the fact keys, then
deals the facts of each over ``spread`` partitions and repeats that key's dimension rows as often. All other keys meet as
in a plain join; there is one join, no second scan of the dimension and no union.

The sketch (frequent items) is made in one pass with map-side merging and holds at most ``capacity`` counters, so what
reaches the driver is bounded whatever the input. It only decides where rows meet: a key that it misses or takes in by
mistake costs time, never a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.operators.joins import null_salt

#: Share of all facts above which a key is hot, counters of the sketch, partitions that a hot key is dealt over.
HOT_SHARE, CAPACITY, SPREAD = 1 / 200, 4096, 64


def hot_keys(fact: DataFrame, key: str, share: float = HOT_SHARE, capacity: int = CAPACITY) -> list:
    """Keys that more than ``share`` of the rows have (estimated from above, NULL left out): at most 1 / share of them."""
    top = min(int(1 / share) + 1, capacity // 4)
    found = fact.where(F.col(key).isNotNull()).agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k({key}, {top}, {capacity})").alias("top")).first()
    return [x["item"] for x in found.top or [] if x["count"] > share * found.n]


def hot_left_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, share: float = HOT_SHARE,
                    spread: int = SPREAD, hot: list | None = None) -> DataFrame:
    """``fact LEFT JOIN dim ON fact_key = dim_key``, hot and NULL fact keys dealt over partitions.

    ``hot`` gives the hot keys where they are known; else they are looked for. Columns must not clash; the dimension's
    key is dropped.
    """
    dim_cols = [c for c in dim.columns if c != dim_key]
    clash = set(dim_cols) & set(fact.columns)
    if clash:
        raise ValueError(f"columns on both sides of the lookup: {sorted(clash)}")
    hot = hot_keys(fact, fact_key, share) if hot is None else hot
    # rows are dealt by the hash of all their columns: a retried task deals them alike
    by_row = F.pmod(F.expr("xxhash64(*)"), F.lit(spread))
    salt = F.when(F.col(fact_key).isin(hot), by_row).otherwise(null_salt(fact, fact_key, spread)) if hot else null_salt(
        fact, fact_key, spread)
    facts = fact.withColumn("_fact_salt", salt)
    digits = F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))
    own = F.array(F.lit(0).cast("long"))
    dims = dim.withColumn("_dim_salt", F.explode(F.when(F.col(dim_key).isin(hot), digits).otherwise(own) if hot else own))
    on = (facts[fact_key] == dims[dim_key]) & (facts["_fact_salt"] == dims["_dim_salt"])
    return facts.join(dims, on, "left").select(*fact.columns, *dim_cols)
