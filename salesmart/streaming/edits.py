"""Incremental refresh from record versions: edited, moved and withdrawn records.

``streaming.incremental`` takes records that are only ever appended. Here the feed delivers *versions* of records:
(record columns, ``record_version``, ``withdrawn``). An edit can move a record to another month or person; then the old
person-month has to be recomputed too, and aggregates have to give back what they took from the old version.

``RecordStore`` keeps two tables (``operators.versioned``) under its root:

* ``records``: the newest version of every record, laid out by (year, month) of its date, so that a batch reads and
  rewrites the months it touches and no others; undated records have a partition of their own;
* ``index``: id -> version and (person, year, month) of that version, laid out by buckets of the id. Withdrawn records
  stay in it, so a late older version does not bring them back.

``RecordStore.handle`` is the ``foreachBatch`` function. It first writes what the batch changes (new versions, and the
old ones they replace) under the batch id, then updates both tables, then calls the marts. A batch that is replayed finds
its changes written and does the rest again: replacing records, index rows and person-months twice changes nothing, and
``SalesPartials`` keeps the number of the last batch with its sums.

The lists that the driver holds are partitions (months, buckets), never rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.operators import versioned as V

VERSION, WITHDRAWN = "record_version", "withdrawn"
MONTH = ["year", "month"]
PERSON_MONTH = ["user_id", *MONTH]


def month_columns(date: str = "realization_date") -> dict[str, Column]:
    return {"year": F.year(date), "month": F.month(date)}


def folders(rows: DataFrame, columns: list[str]) -> list[str]:
    """The partition folders that the rows' values of columns name (as many as there are partitions)."""
    found = rows.select(*columns).distinct().collect()
    return sorted("/".join(f"{c}={'__HIVE_DEFAULT_PARTITION__' if r[c] is None else r[c]}" for c in columns) for r in found)


@dataclass
class Change:
    """What one batch changes: new versions (withdrawn ones too) and the versions they replace, with their months."""

    batch_id: int
    new: DataFrame
    old: DataFrame
    #: partition folders of records that the batch touches
    months: list[str]

    def person_months(self) -> DataFrame:
        """(user_id, year, month) of all dated old and new versions: the only rows of a person-month mart to recompute."""
        both = self.old.unionByName(self.new.where(f"NOT {WITHDRAWN}").drop(WITHDRAWN))
        return both.where("year IS NOT NULL").select(F.col("responsible_id").alias("user_id"), *MONTH).distinct()


@dataclass
class RecordStore:
    spark: SparkSession
    root: str
    #: names of a record's own columns; id, responsible_id and realization_date must be among them
    columns: list[str]
    buckets: int = 64
    marts: list[Callable[[RecordStore, Change], None]] = field(default_factory=list)

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("id"), F.lit(self.buckets)).cast("int").alias("bucket")

    def _index_rows(self, versions: DataFrame) -> DataFrame:
        return versions.select("id", VERSION, WITHDRAWN, self._bucket())

    def load(self, records: DataFrame) -> None:
        """The first state: every record at version 0."""
        rows = records.select(*self.columns).withColumns(
            {VERSION: F.lit(0).cast("long"), **month_columns()})
        V.publish(self.spark, self.path("records"), rows, MONTH)
        V.publish(self.spark, self.path("index"), self._months_of(self.read(), F.lit(False)), ["bucket"])

    def _months_of(self, rows: DataFrame, withdrawn: Column) -> DataFrame:
        return rows.select("id", VERSION, withdrawn.alias(WITHDRAWN), *MONTH, self._bucket())

    def read(self, months: list[str] | None = None) -> DataFrame:
        """Records of the given months (all without them): only their folders are listed and read."""
        if months is None:
            return V.read_table(self.spark, self.path("records"))
        found = V.read_partitions(self.spark, self.path("records"), months)
        return found if found is not None else V.read_table(self.spark, self.path("records")).where("false")

    def _changes(self, batch: DataFrame, batch_id: int) -> Change:
        """The batch's changes, written once under its number and read back."""
        new_path, old_path = (self.path(f"changes/{side}/batch_id={batch_id}") for side in ("new", "old"))
        if not V.file_exists(self.spark, f"{old_path}/_SUCCESS"):
            # of several versions of a record in one batch the last counts; equal versions by their columns
            last = batch.groupBy("id").agg(F.max(F.struct(VERSION, WITHDRAWN, *[c for c in self.columns if c != "id"])).alias("v"))
            last = last.select("id", "v.*").withColumns(month_columns())
            last.write.mode("overwrite").parquet(f"{new_path}-all")
            last = self.spark.read.schema(last.schema).parquet(f"{new_path}-all")
            known = V.read_partitions(self.spark, self.path("index"), folders(last.select(self._bucket()), ["bucket"]))
            if known is not None:
                before = known.select("id", F.col(VERSION).alias("_v"), F.col(WITHDRAWN).alias("_w"),
                                      F.col("year").alias("_y"), F.col("month").alias("_m"))
                last = last.join(before, "id", "left").where(f"_v IS NULL OR _v < {VERSION}")
            else:
                last = last.selectExpr("*", "CAST(NULL AS BIGINT) AS _v", "FALSE AS _w", "CAST(NULL AS INT) AS _y",
                                       "CAST(NULL AS INT) AS _m")
            last.write.mode("overwrite").parquet(new_path)
            last = self.spark.read.schema(last.schema).parquet(new_path)
            replaced = last.where("_v IS NOT NULL AND NOT _w")
            had = folders(replaced.select(F.col("_y").alias("year"), F.col("_m").alias("month")), MONTH)
            old = self.read(had).join(replaced.select("id"), "id", "left_semi")
            old.write.mode("overwrite").parquet(old_path)
        new = self.spark.read.parquet(new_path)
        old = self.spark.read.parquet(old_path)
        own = [*self.columns, VERSION, *MONTH]
        new = new.select(*own, WITHDRAWN)
        old = old.select(*own)
        months = folders(old.select(*MONTH).unionByName(new.where(f"NOT {WITHDRAWN}").select(*MONTH)), MONTH)
        return Change(batch_id, new, old, months)

    def handle(self, batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        change = self._changes(batch, batch_id)
        stay = self.read(change.months).join(change.new.select("id"), "id", "left_anti")
        rows = stay.unionByName(change.new.where(f"NOT {WITHDRAWN}").drop(WITHDRAWN).select(*stay.columns))
        V.publish(self.spark, self.path("records"), rows, MONTH, replaced=change.months)
        index = change.new.select("id", VERSION, WITHDRAWN, *MONTH, self._bucket())
        buckets = folders(index, ["bucket"])
        known = V.read_partitions(self.spark, self.path("index"), buckets)
        if known is not None:
            index = known.join(index.select("id"), "id", "left_anti").unionByName(index)
        V.publish(self.spark, self.path("index"), index, ["bucket"], replaced=buckets)
        for mart in self.marts:
            mart(self, change)


def person_month_mart(path: str, mart_for: Callable[[DataFrame, DataFrame], DataFrame]):
    """A mart whose rows depend on their person-month alone, stored by (year, month): the touched person-months' rows
    are replaced by what ``mart_for(records of the touched months, touched person-months)`` gives."""
    def refresh(store: RecordStore, change: Change) -> None:
        spark = store.spark
        touched = change.person_months()
        dated = [m for m in change.months if "__HIVE_DEFAULT_PARTITION__" not in m]
        if not dated:
            return
        fresh = mart_for(store.read(dated).select(*store.columns), touched)
        current = V.read_partitions(spark, path, dated)
        if current is not None:
            fresh = current.join(touched, PERSON_MONTH, "left_anti").unionByName(fresh.select(*current.columns))
        V.publish(spark, path, fresh, MONTH, replaced=dated)
    return refresh


SUMS = ["income_sum", "income_n", "deals_count", "row_n"]


@dataclass
class SalesPartials:
    """The sales report as mergeable partial sums per (realization_date, property_type), stored by year.

    A batch's rows go in with a sign: +1 for new versions, -1 for the ones they replace. A group whose row count comes
    to zero leaves the table. Old records are not read for it: what they gave is in the sums.
    """

    path: str
    #: (records, columns to keep) -> rows of the report: realization_date, property_type, income, id and the kept ones
    report_rows: Callable[[DataFrame, list[str]], DataFrame]

    KEYS = ("realization_date", "property_type")

    def _sums(self, signed: DataFrame) -> DataFrame:
        sign = F.col("sign")
        rows = self.report_rows(signed, ["sign"])
        return rows.groupBy(*self.KEYS).agg(
            F.sum(F.col("income") * sign).cast("decimal(28,2)").alias("income_sum"),
            F.sum(F.when(F.col("income").isNotNull(), sign).otherwise(0)).cast("long").alias("income_n"),
            F.sum(F.when(F.col("id").isNotNull(), sign).otherwise(0)).cast("long").alias("deals_count"),
            F.sum(sign).cast("long").alias("row_n")).withColumn("year", F.year("realization_date"))

    def load(self, spark: SparkSession, records: DataFrame) -> None:
        V.publish(spark, self.path, self._sums(records.withColumn("sign", F.lit(1))), ["year"], note={"batch": -1})

    def __call__(self, store: RecordStore, change: Change) -> None:
        spark = store.spark
        known = V.snapshot(spark, self.path)
        if known[1] is not None and known[1].get("note", {}).get("batch", -1) >= change.batch_id:
            return  # a replay: its rows are in the sums
        plus = change.new.where(f"NOT {WITHDRAWN}").select(*store.columns, F.lit(1).alias("sign"))
        minus = change.old.select(*store.columns, F.lit(-1).alias("sign"))
        delta = self._sums(plus.unionByName(minus))
        years = folders(delta, ["year"])
        current = V.read_partitions(spark, self.path, years, known)
        if current is not None:
            delta = current.unionByName(delta.select(*current.columns))
        merged = delta.groupBy(*self.KEYS, "year").agg(*[F.sum(c).alias(c) for c in SUMS])
        merged = merged.withColumn("income_sum", F.col("income_sum").cast("decimal(28,2)")).where("row_n <> 0")
        V.publish(spark, self.path, merged, ["year"], replaced=years, known=known, note={"batch": change.batch_id})

    def report(self, spark: SparkSession) -> DataFrame:
        """The report: a group whose incomes are all NULL has a NULL income."""
        rows = V.read_table(spark, self.path)
        return rows.select(*self.KEYS, F.when(F.col("income_n") != 0, F.coalesce("income_sum", F.lit(0))).cast(
            "decimal(28,2)").alias("income"), "deals_count")


def run_edit_feed(spark: SparkSession, landing: str, schema, store: RecordStore, checkpoint: str,
                  files_per_batch: int | None = None) -> None:
    """Drain the landed record versions (parquet files) through the store and its marts."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (reader.parquet(landing).writeStream.foreachBatch(store.handle).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
