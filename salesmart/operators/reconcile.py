"""Reconciliation: rows of a stored mart that its refreshed source no longer has are ended.

An upsert never takes a row away, so a deal that lost its closed status stays in the mart. ``reconcile`` is an upsert
that owns a range: the refresh states which rows of the target it speaks for (the months it recomputed, say). A row of
that range that the source lacks is ended; a row outside it is none of the refresh's business and is kept.

Presence is told by marker columns of one full outer join on the NULL-safe key, so target and source are read once, and
a partition that became empty is handled like any other: its rows have no source marker.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators import versioned as V

ACTION = "upsert_action"


def reconcile(target: DataFrame, source: DataFrame, keys: list[str], owned: Column, update_cols: list[str] | None = None,
              ended: dict[str, Column] | None = None, with_action: bool = False) -> DataFrame:
    """``source`` merged into ``target`` with the owned rows that it lacks ended.

    ``owned`` is a condition on the target's columns; NULL counts as not owned. Ended rows are left out, or, with
    ``ended``, kept with these columns set (a closing date, a flag). ``update_cols`` are the columns taken from the
    source on a match (default: every non-key column). With ``with_action`` a column says inserted, updated, kept or
    ended, the ended rows included. Source keys have to be unique.
    """
    columns = target.columns
    if set(source.columns) != set(columns):
        raise ValueError(f"target and source differ in columns: {sorted(set(source.columns) ^ set(columns))}")
    update_cols = [c for c in columns if c not in keys] if update_cols is None else list(update_cols)
    unknown = set(ended or {}) - set(columns)
    if unknown:
        raise ValueError(f"columns to set on ended rows that the target lacks: {sorted(unknown)}")
    t = target.select(*columns, F.coalesce(owned, F.lit(False)).alias("_owned"), F.lit(True).alias("_there")).alias("t")
    s = source.select(*columns, F.lit(True).alias("_here")).alias("s")
    on = reduce(lambda a, b: a & b, [F.col(f"t.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys])
    here, there = F.col("s._here").isNotNull(), F.col("t._there").isNotNull()
    gone = there & ~here & F.col("t._owned")
    values = []
    for c in columns:
        taken = here if c in keys or c in update_cols else here & ~there
        value = F.when(taken, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        if ended and c in ended:
            value = F.when(gone, ended[c]).otherwise(value)
        values.append(value.alias(c))
    action = F.when(gone, "ended").when(here & there, "updated").when(here, "inserted").otherwise("kept").alias(ACTION)
    rows = t.join(s, on, "full_outer").select(*values, action)
    if not with_action:
        rows = (rows if ended else rows.where(F.col(ACTION) != "ended")).drop(ACTION)
    return rows


def reconcile_table(spark: SparkSession, path: str, source: DataFrame, keys: list[str], partition_cols: list[str],
                    owned_partitions: list[str], update_cols: list[str] | None = None,
                    ended: dict[str, Column] | None = None) -> dict[str, int]:
    """Reconcile the stored table's owned partitions (relative folders, such as ``year=2000/month=5``) with ``source``.

    Partitions that the source has rows in must be owned. The source is computed once into a staging folder; the owned
    partitions are replaced in one publication, those without rows afterwards leave the table. Returns counts by action.
    """
    known = V.snapshot(spark, path)
    staged, touched, folder = V.stage(spark, path, source, partition_cols)
    foreign = sorted(set(touched) - set(owned_partitions))
    if foreign:
        raise ValueError(f"the source has rows in partitions that the refresh does not own: {foreign[:5]}")
    current = V.read_partitions(spark, path, owned_partitions, known)
    if current is None:
        current = spark.createDataFrame([], staged.schema)
    rows = reconcile(current.select(*staged.columns), staged, keys, F.lit(True), update_cols, ended, with_action=True)
    out = V.stage(spark, path, rows, partition_cols)
    counts = {r[ACTION]: r["count"] for r in out[0].groupBy(ACTION).count().collect()}  # four actions at most
    left = (out[0] if ended else out[0].where(F.col(ACTION) != "ended")).drop(ACTION)
    V.publish(spark, path, left, partition_cols, replaced=owned_partitions, known=known)
    for done in (folder, out[2]):
        V.discard(spark, done)
    return {a: counts.get(a, 0) for a in ("inserted", "updated", "kept", "ended")}
