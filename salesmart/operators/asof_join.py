"""As-of lookup: each row with the last value known at its time.

Spark has no as-of join, and a join on the key with a range filter pairs every row of a key with all its earlier values.
Here both sides become one relation ordered by time inside (key, time range), and a row takes the last value before it.
What was known before a range starts is carried in: one head per (key, range), so a key that holds a third of all rows
spreads over its ranges and only its heads, as many as it has ranges, meet in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_AT, _RANGE, _ASKED, _SEEN, _BEFORE = "_asof_at", "_asof_range", "_asof_asked", "_asof_seen", "_asof_before"


def _range_of(at: Column, days: int) -> Column:
    return F.floor(F.unix_date(at.cast("date")) / days)


def asof_lookup(left: DataFrame, right: DataFrame, by: list[str], left_time: str, right_time: str,
                values: list[str], known_at: str | None = None, range_days: int = 366) -> DataFrame:
    """``left`` with the ``values`` of the last row of ``right`` of the same key at or before its time.

    Both sides have the columns ``by``; the times are dates or timestamps. ``known_at`` names a column for the time of
    the value. Each left row comes back once. Of several values at one time the largest (by ``values`` in order, NULL
    smallest) counts. A value that is NULL is a value: it is not replaced by an older one. Rows without a key or a time
    match nothing; nothing known yet gives NULLs. ``left`` must not have columns named like the added ones.
    """
    added = [*values, *([known_at] if known_at else [])]
    if clash := set(added) & set(left.columns):
        raise ValueError(f"left already has {sorted(clash)}")
    keys = [f"_asof_k{n}" for n in range(len(by))]
    key_columns = [F.col(c).alias(k) for c, k in zip(by, keys)]

    def complete(time: str) -> Column:
        return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*by, time]])

    # one row per key and time on either side: repeated times are combined before anything is sorted
    known = right.where(complete(right_time)).groupBy(*key_columns, F.col(right_time).alias(_AT)).agg(
        F.max(F.struct(*values)).alias("v"))
    asked = left.where(complete(left_time)).select(*key_columns, F.col(left_time).alias(_AT)).distinct()
    seen_type = known.select(F.struct(_AT, "v").alias(_SEEN)).schema[_SEEN].dataType
    rows = known.select(*keys, _AT, F.lit(False).alias(_ASKED), F.struct(_AT, "v").alias(_SEEN)).unionByName(
        asked.select(*keys, _AT, F.lit(True).alias(_ASKED), F.lit(None).cast(seen_type).alias(_SEEN)))
    rows = rows.withColumn(_RANGE, _range_of(F.col(_AT), range_days))

    heads = rows.groupBy(*keys, _RANGE).agg(F.max(_SEEN).alias(_SEEN))
    earlier = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(*keys, _RANGE, F.last(_SEEN, ignorenulls=True).over(earlier).alias(_BEFORE))
    so_far = Window.partitionBy(*keys, _RANGE).orderBy(_AT, _ASKED).rowsBetween(Window.unboundedPreceding, 0)
    inside = rows.withColumn(_SEEN, F.last(_SEEN, ignorenulls=True).over(so_far)).where(F.col(_ASKED))
    found = F.coalesce(F.col(_SEEN), F.col(_BEFORE))
    answers = inside.join(heads, [*keys, _RANGE]).select(
        *keys, _AT, found[_AT].alias("_asof_found"), found["v"].alias("_asof_v"))

    same = [F.col(c) == F.col(k) for c, k in zip([*by, left_time], [*keys, _AT])]
    met = left.where(complete(left_time)).join(answers, reduce(lambda a, b: a & b, same), "left").select(
        *left.columns, *[F.col("_asof_v")[v].alias(v) for v in values],
        *([F.col("_asof_found").alias(known_at)] if known_at else []))
    # rows without a key or a time stay out of the join: they would all hash to one task
    kinds = {f.name: f.dataType for f in met.schema.fields}
    without = left.where(~complete(left_time)).select(
        *left.columns, *[F.lit(None).cast(kinds[c]).alias(c) for c in added])
    return met.unionByName(without)
