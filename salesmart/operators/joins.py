"""Join helpers for fact-to-dimension lookups.

``left_lookup`` is a LEFT JOIN on one key that keeps NULL keys from piling up
in one task.  Hash partitioning sends every NULL key to the same shuffle
partition, and a NULL foreign key can be a large share of a fact table.  The
join therefore uses a second key, the same on both sides: 0 for a row with a
key, a hash bucket of the row for a row without one.  Keyed rows meet their
dimension row exactly as before; NULL-key rows are spread over
``salt_buckets`` partitions and, having a NULL key, still match nothing.
One pass, no union, no second scan.  (The salt is computed from the key, not
written as a constant, so the optimizer keeps it as a join key.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NULL_SALT_BUCKETS = 256


def left_lookup(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                salt_buckets: int = NULL_SALT_BUCKETS) -> DataFrame:
    """``fact LEFT JOIN dim ON fact_key = dim_key`` with NULL fact keys salted over partitions.

    ``dim`` columns must not clash with ``fact`` columns (rename first); the
    dimension key column is dropped from the output.
    """
    dim_cols = [c for c in dim.columns if c != dim_key]
    clash = set(dim_cols) & set(fact.columns)
    if clash:
        raise ValueError(f"columns on both sides of the lookup: {sorted(clash)}")
    salted = fact.withColumn("_fact_salt", null_salt(fact, fact_key, salt_buckets))
    keyed_dim = dim.withColumn("_dim_salt", null_salt(dim, dim_key, salt_buckets))
    cond = (salted[fact_key] == keyed_dim[dim_key]) & (salted["_fact_salt"] == keyed_dim["_dim_salt"])
    return salted.join(keyed_dim, cond, "left").select(*fact.columns, *dim_cols)


def null_salt(df: DataFrame, key: str, buckets: int = NULL_SALT_BUCKETS):
    """0 when ``key`` is set, else a bucket of the row's hash (spreads NULL keys over partitions)."""
    row_hash = F.expr("xxhash64(*)")   # every column of the row (deterministic, so retried tasks agree)
    return F.when(F.col(key).isNull(), F.pmod(row_hash, F.lit(buckets))).otherwise(F.lit(0).cast("long"))

def prefixed(df: DataFrame, prefix: str, keep: dict[str, str] | None = None) -> DataFrame:
    """Rename every column to ``prefix + name`` (or to the name given in ``keep``)."""
    keep = keep or {}
    return df.select(*[F.col(c).alias(keep.get(c, prefix + c)) for c in df.columns])
