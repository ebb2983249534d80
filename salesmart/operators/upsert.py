"""Upsert into versioned parquet tables (the marts' ``INSERT ... ON CONFLICT``).

``merge`` is the pure part: a full outer join of target and source on the
conflict key.  Source rows replace the update columns of matching target rows,
new keys are inserted, target-only rows are kept, nothing is deleted.

``upsert_table`` is the write path.  A table is a folder of version folders
(``operators.versioned``): the touched partitions are written into a new one,
and one new manifest file publishes them all at once.  No live file is ever
overwritten or removed, so a job that fails at any point leaves the table as
it was, and running it again gives the full result.

``insert_if_absent`` is ``INSERT ... WHERE NOT EXISTS``: a left anti join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from salesmart.operators import versioned as V

ACTION = "upsert_action"
_S, _T = "_src_present", "_tgt_present"


class DuplicateKeyError(ValueError):
    """The source holds one conflict key twice (the row would be changed twice)."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (an aggregate; NULL key parts group together)."""
    return df.groupBy(*keys).count().where(F.col("count") > 1)


def check_unique(df: DataFrame, keys: list[str], sample: int = 5) -> None:
    """Raise ``DuplicateKeyError`` naming up to ``sample`` duplicated keys."""
    found = duplicate_keys(df, keys).limit(sample).collect()
    if found:
        raise DuplicateKeyError(f"duplicate source keys on {keys}: {[r.asDict() for r in found]}")


def _key_match(keys: list[str], nulls_distinct: bool) -> Column:
    conds = [(F.col("t." + k) == F.col("s." + k)) if nulls_distinct else F.col("t." + k).eqNullSafe(F.col("s." + k))
             for k in keys]
    return reduce(lambda a, b: a & b, conds)


def merge(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str] | None = None,
          nulls_distinct: bool = False, with_action: bool = False, insert_only: Column | None = None) -> DataFrame:
    """Upsert ``source`` into ``target`` and return the resulting rows.

    ``update_cols`` (default: every non-key column) take the source value on a
    match; other non-key columns keep the target value.  With
    ``nulls_distinct`` a NULL key part never matches (PostgreSQL's default
    unique index); by default NULL matches NULL so a refresh is idempotent.
    ``insert_only`` (a condition on the source row, columns as ``s.<name>``)
    marks rows that are inserted when absent but never overwrite a match
    (``INSERT ... WHERE NOT EXISTS`` folded into the same join).
    """
    columns = source.columns
    missing = set(columns) ^ set(target.columns)
    if missing:
        raise ValueError(f"target and source differ in columns: {sorted(missing)}")
    update_cols = [c for c in columns if c not in keys] if update_cols is None else list(update_cols)
    t = target.select(*columns, F.lit(True).alias(_T)).alias("t")
    s = source.select(*columns, F.lit(True).alias(_S)).alias("s")
    joined = t.join(s, _key_match(keys, nulls_distinct), "full_outer")
    in_s, in_t = F.col("s." + _S).isNotNull(), F.col("t." + _T).isNotNull()
    if insert_only is not None:
        in_s = in_s & ~(in_t & F.coalesce(insert_only, F.lit(False)))   # a matched insert-only row keeps the target
    out = []
    for c in columns:
        if c in keys or c in update_cols:
            out.append(F.when(in_s, F.col("s." + c)).otherwise(F.col("t." + c)).alias(c))
        else:
            out.append(F.when(in_t, F.col("t." + c)).otherwise(F.col("s." + c)).alias(c))
    if with_action:
        out.append(F.when(in_s & in_t, "updated").when(in_s, "inserted").otherwise("kept").alias(ACTION))
    return joined.select(*out)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: list[str], absent_when: Column | None = None) -> DataFrame:
    """Target plus the source rows whose key has no target row (among ``absent_when`` rows if given)."""
    existing = (target if absent_when is None else target.where(absent_when)).select(*keys).alias("e")
    cond = reduce(lambda a, b: a & b, [F.col("s." + k).eqNullSafe(F.col("e." + k)) for k in keys])
    new_rows = source.alias("s").join(existing, cond, "left_anti")
    return target.unionByName(new_rows)


@dataclass
class UpsertResult:
    inserted: int
    updated: int
    kept: int
    partitions_rewritten: int

    @property
    def row_count(self) -> int:
        """Rows affected, as the database reports for INSERT ... ON CONFLICT."""
        return self.inserted + self.updated


def rewrite_partitions(spark: SparkSession, path: str, source: DataFrame,
                       combine: Callable[[DataFrame | None, DataFrame], DataFrame], partition_cols: list[str],
                       observe: tuple[Observation, list[Column]] | None = None,
                       check: Callable[[DataFrame], None] | None = None) -> int:
    """Replace the partitions that ``source`` has rows in with ``combine(current rows of those, source)``.

    The source is computed once, into a staging folder laid out like the
    table, so the touched partitions are its folders and only the table's
    files of the same partitions are read.  ``check`` may inspect the staged
    rows and raise.  Columns whose names start with ``upsert_`` are
    bookkeeping and are not stored; ``observe`` (an ``Observation`` and its
    metric columns) is evaluated during the write.  Returns the number of
    partitions rewritten.
    """
    known = V.snapshot(spark, path)   # one state of the table for the read and for the write
    staged, touched, folder = V.stage(spark, path, source, partition_cols)
    if check is not None:
        check(staged)
    out = combine(V.read_partitions(spark, path, touched, known), staged)
    if observe is not None:
        out = out.observe(observe[0], *observe[1])
    out = out.drop(*[c for c in out.columns if c.startswith("upsert_")])
    published = V.publish(spark, path, out, partition_cols, known=known)
    V.discard(spark, folder)
    return published


def keep_by_precedence(df: DataFrame, keys: list[str], precedence: list[str]) -> DataFrame:
    """One row per key: the one with the largest ``precedence`` values (then the largest remaining columns).

    A grouped ``max`` over a struct, combined map-side: no window, no group
    gathered in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in precedence]
    best = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in precedence + rest])).alias("_best"))
    return best.select(*keys, *[F.col("_best." + c).alias(c) for c in precedence + rest]).select(*df.columns)


def upsert_table(spark: SparkSession, path: str, source: DataFrame, keys: list[str],
                 partition_cols: list[str] | None = None, update_cols: list[str] | None = None,
                 nulls_distinct: bool = False, precedence: list[str] | None = None,
                 rebuild: bool = False) -> UpsertResult:
    """Upsert ``source`` into the table at ``path``, rewriting only touched partitions.

    Duplicate source keys raise ``DuplicateKeyError`` (before anything is
    written) unless ``precedence`` names the columns that choose the surviving
    row; with ``nulls_distinct`` only keys without NULL parts can repeat.
    ``rebuild`` ignores the current content of the touched partitions (a fresh
    write of them).  The inserted / updated / kept counts are observed during
    the write itself.
    """
    partition_cols = list(partition_cols or [])
    if precedence:
        source = keep_by_precedence(source, keys, precedence)

    def check(staged: DataFrame) -> None:
        if not precedence:
            check_unique(staged.dropna(subset=keys) if nulls_distinct else staged, keys)

    def combine(current: DataFrame | None, staged: DataFrame) -> DataFrame:
        if current is None or rebuild:
            return staged.withColumn(ACTION, F.lit("inserted"))
        return merge(current.select(*staged.columns), staged, keys, update_cols, nulls_distinct, with_action=True)

    obs = Observation("upsert")
    a = F.col(ACTION)
    n_parts = rewrite_partitions(spark, path, source, combine, partition_cols, observe=(obs, [
        F.count(F.when(a == "inserted", 1)).alias("inserted"), F.count(F.when(a == "updated", 1)).alias("updated"),
        F.count(F.when(a == "kept", 1)).alias("kept")]), check=check)
    stats = obs.get
    return UpsertResult(stats["inserted"], stats["updated"], stats["kept"], n_parts)
