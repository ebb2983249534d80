"""First-row flags without sorting whole groups in one task.

``ROW_NUMBER() OVER (PARTITION BY k ORDER BY o) = 1`` as a flag needs only the
smallest ``o`` of each group.  That minimum is an aggregate: it is combined
map-side before the shuffle, so a hot group (a third of all rows under one
key) costs one partial row per task instead of one task sorting the group.
The flag is then a join of the rows with their group's minimum on the same
keys, which reuses the rows' partitioning.

The global variant (no PARTITION BY) computes the minimum as a scalar
subquery (partial minimum per task, then one row) instead of a window that
would move every row into a single partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST = "_first_key"


def order_key(order_cols: list[str]) -> Column:
    """Ascending sort key; ties are impossible when the last column is unique."""
    return F.struct(*[F.col(c) for c in order_cols])


def group_minimum(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per group with the smallest order key (partial + final aggregate)."""
    return df.groupBy(*keys).agg(F.min(order_key(order_cols)).alias(FIRST))


def flag_first_in_group(df: DataFrame, keys: list[str], order_cols: list[str], flag: str,
                        minimum: DataFrame | None = None) -> DataFrame:
    """Add ``flag`` = 1 on the row holding its group's smallest order key, else 0.

    Order columns must be non-NULL on the rows of ``df`` (rows without a sort
    key are handled by the caller).  ``minimum`` may be passed when the caller
    already built it with ``group_minimum``.
    """
    minimum = group_minimum(df, keys, order_cols) if minimum is None else minimum
    return (df.join(minimum, keys, "inner")
              .withColumn(flag, order_key(order_cols).eqNullSafe(F.col(FIRST)).cast("int"))
              .drop(FIRST))


def flag_global_first(df: DataFrame, order_cols: list[str], flag: str) -> DataFrame:
    """Add ``flag`` = 1 on the single row with the smallest order key of the whole frame.

    The minimum is a lazy scalar subquery, so building the plan starts no job.
    Give every column in ``order_cols`` where keys can tie: one row is flagged, and
    the subquery then shares the exchanges of the rows' own plan.
    """
    top = df.agg(F.min(order_key(order_cols)).alias(FIRST)).scalar()
    return df.withColumn(flag, F.coalesce(order_key(order_cols).eqNullSafe(top).cast("int"), F.lit(0)))
