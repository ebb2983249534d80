"""Incremental refresh of the person-month marts with Structured Streaming.

Shown for the salesperson-month deal mart (P2) and the 5th-day report (P5):
their rows for a person-month depend on nothing but that person-month.

The staging sync lands new accounting records as files.  A file stream
(``readStream.parquet``) delivers them in micro-batches; ``foreachBatch``

1. appends the batch to the staging table under its batch id (overwrite of
   that batch's folder, so a replayed batch is written once);
2. takes the person-months the batch touches;
3. recomputes the mart for those person-months only, from the base records
   plus every staged batch;
4. rewrites the target partitions (year, month) of those person-months:
   deal rows are upserted on (user_id, year, month, ata_id), empty
   person-month rows are inserted only where none exists.

Person-months the feed never touches keep their rows, so after the feed is
drained the target equals a full refresh of the mart.  The stream's own
checkpoint (offsets and commits) and the idempotent per-batch writes make a
restarted query resume without double counting.  Records are appended, not
edited: a record that moved to another month would also need its old month
recomputed, which needs the record's previous version.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators.upsert import merge, rewrite_partitions
from salesmart.plans.deals import DM_DEALS_COLUMNS

DEAL_KEYS = ["user_id", "year", "month", "ata_id"]
PARTITIONS = ["year", "month"]


def touched_person_months(records: DataFrame) -> DataFrame:
    """(user_id, year, month) of dated records: the only rows of the mart they can change."""
    return (records.where(F.col("realization_date").isNotNull())
            .select(F.col("responsible_id").alias("user_id"), F.year("realization_date").alias("year"),
                    F.month("realization_date").alias("month"))
            .distinct())


def apply_refresh(current: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """New content of the touched partitions: deal rows upserted, empty rows inserted where absent.

    One full outer join on the NULL-safe key (user, year, month, record): an
    empty row (record NULL) matches the person-month's existing empty row and
    then keeps it, which is the ``NOT EXISTS`` test; ``fresh`` is read once.
    """
    if current is None:
        return fresh
    return merge(current.select(*DM_DEALS_COLUMNS), fresh.select(*DM_DEALS_COLUMNS), DEAL_KEYS,
                 insert_only=F.col("s.ata_id").isNull())


def upsert_on(keys: list[str]) -> Callable[[DataFrame | None, DataFrame], DataFrame]:
    """Plain upsert of the fresh rows on ``keys`` (for marts without insert-only rows)."""
    def apply(current: DataFrame | None, fresh: DataFrame) -> DataFrame:
        return fresh if current is None else merge(current.select(*fresh.columns), fresh, keys)
    return apply


def make_batch_handler(spark: SparkSession, base_records: DataFrame, staging_path: str, target_path: str,
                       mart_for: Callable[[DataFrame, DataFrame], DataFrame],
                       apply: Callable[[DataFrame | None, DataFrame], DataFrame] = apply_refresh,
                       partitions: list[str] = PARTITIONS) -> Callable[[DataFrame, int], None]:
    """foreachBatch handler; ``mart_for(records, touched)`` computes the mart rows of ``touched`` and
    ``apply(current, fresh)`` gives the new content of their partitions (default: the deal mart's rule)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(staging_path, f"batch_id={batch_id}"))
        touched = touched_person_months(batch).checkpoint(eager=True)
        staged = spark.read.schema(base_records.schema).parquet(staging_path).select(*base_records.columns)
        records = base_records.unionByName(staged)
        fresh = mart_for(records, touched)
        rewrite_partitions(spark, target_path, fresh, apply, partitions)

    return handle


def run_incremental_refresh(spark: SparkSession, landing_path: str, schema, base_records: DataFrame,
                            staging_path: str, target_path: str, checkpoint_path: str,
                            mart_for: Callable[[DataFrame, DataFrame], DataFrame],
                            files_per_batch: int | None = None, bytes_per_batch: str | None = None,
                            apply: Callable[[DataFrame | None, DataFrame], DataFrame] = apply_refresh) -> None:
    """Drain the landing folder (``availableNow``) through the incremental refresh.

    All waiting files form one micro-batch unless ``files_per_batch`` (Spark's
    ``maxFilesPerTrigger``) or ``bytes_per_batch`` (``maxBytesPerTrigger``, such as "64g") bounds it.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if bytes_per_batch is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    feed = reader.parquet(landing_path)
    query = (feed.writeStream
             .foreachBatch(make_batch_handler(spark, base_records, staging_path, target_path, mart_for, apply))
             .option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir`` (shared storage on a cluster)."""
    from salesmart.session import ensure_checkpoint_dir
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")
