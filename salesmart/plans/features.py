"""Queries of the ingest, of incremental refresh by record versions, of reconciliation, of the hot-key and as-of lookups,
of the head count over days and of the drill path's levels.

Each prepares its state from the given tables in a scratch folder of the checkpoint directory, runs the library's
operator on it, and returns the outcome; the oracle SQL states what the outcome has to be.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart import oracle as O
from salesmart.operators import versioned as V
from salesmart.operators.asof_join import asof_lookup
from salesmart.operators.hot_join import hot_left_lookup
from salesmart.operators.reconcile import reconcile_table
from salesmart.plans import sinks as S
from salesmart.plans.access import DRILL_PATH, drilldown_levels
from salesmart.plans.catalog import Inputs
from salesmart.plans.deals import DM_DEALS_COLUMNS, dm_sales_staff_deals, sales_report_rows
from salesmart.plans.headcount_history import headcount_history
from salesmart.plans.units import unit
from salesmart.sources.ingest import RAW, IngestTable, Landed
from salesmart.sources.intervals import compact, expand
from salesmart.sources.snapshot import snapshot_day_filter
from salesmart.streaming import edits as E
from salesmart.streaming.incremental import scratch_folder

# --- S10: staging ingest ---------------------------------------------------------------

#: Damaged lines that are delivered with the records: an expression over a record, which ids have it, and the reason.
DAMAGED = [
    ("concat('{\"id\":', cast(id AS VARCHAR(20)), ',\"inco')", "id % 41 = 7", "malformed"),
    ("concat('{\"id\":\"n', cast(id AS VARCHAR(20)), '\",\"realization_date\":\"1999-02-30\"}')", "id % 53 = 8",
     "bad type: id, realization_date"),
    ("concat('{\"responsible_id\":', cast(id AS VARCHAR(20)), '}')", "id % 67 = 9", "missing: id"),
]


def landed_accounting(i: Inputs, root: str) -> tuple[str, str]:
    """The accounting records as delivered files: JSON lines by year with damaged lines between, and a second delivery
    that has some of the first one's files again under other names."""
    spark = i.fx.spark
    first, second = f"{root}/landing/first", f"{root}/landing/second"
    damaged = [F.when(F.expr(ids), F.expr(text.replace("VARCHAR(20)", "STRING"))) for text, ids, _ in DAMAGED]
    lines = i.accounting.select(F.year("realization_date").alias("y"), F.explode(F.array_compact(
        F.array(F.to_json(F.struct("*")), *damaged))).alias("line"))
    early = F.coalesce("y", F.lit(0)) < 1996
    lines.where(early).write.partitionBy("y").text(first)
    lines.where(~early).write.partitionBy("y").text(second)
    fs = spark._jvm.org.apache.hadoop.fs
    source, copy = fs.Path(f"{first}/y=1994"), fs.Path(f"{second}/again")
    conf = spark._jsc.hadoopConfiguration()
    store = source.getFileSystem(conf)
    if store.exists(source):
        fs.FileUtil.copy(store, source, store, copy, False, conf)
    return first, second


def _ingested(i: Inputs) -> IngestTable:
    """Both deliveries, and the whole landing folder once more (a retry): nothing counts twice."""
    spark = i.fx.spark
    root = scratch_folder(spark, "ingest")
    first, second = landed_accounting(i, root)
    table = IngestTable(f"{root}/staging", Landed(i.accounting.schema, required=("id",)))
    for path in (first, second, f"{root}/landing"):
        table.deliver(spark, path)
    return table


@unit("src_staging_ingest", O.q("SELECT * FROM accounting"))
def _s10(i: Inputs) -> DataFrame:
    return _ingested(i).rows(i.fx.spark)


@unit("src_staging_quarantine", O.q(" UNION ALL ".join(
    f"SELECT {text} AS raw_line, '{reason}' AS reason FROM accounting WHERE {ids}" for text, ids, reason in DAMAGED)))
def _s10_quarantine(i: Inputs) -> DataFrame:
    return _ingested(i).quarantine(i.fx.spark).select(RAW, "reason")


# --- S2 / P1: the snapshot as intervals ---------------------------------------------------

@unit("src_daily_personnel_intervals", O.q("SELECT * FROM daily_personnel"))
def _s2_intervals(i: Inputs) -> DataFrame:
    """The snapshot of all days, from its validity intervals."""
    snapshot = i.snapshot()
    days = i.fx.presence.select("date").distinct()
    return expand(compact(snapshot, days), days)


# --- P7 over all days, P6's values as known then, R3's levels --------------------------------

@unit("headcount_history", O.p7_daily_sql())
def _p7_history(i: Inputs) -> DataFrame:
    """The head count of every snapshot day, in one sweep over the intervals of the snapshot."""
    days = i.fx.presence.select("date").distinct()
    return headcount_history(compact(i.snapshot(), days), days, i.rules)


_MONTH_END = "CAST(last_day(make_date(year, month, 1)) AS DATE)"


@unit("join_metric_asof", O.q(
    f"""SELECT p.*, o.objects_count, o.objects_since, r.income, r.deal_date FROM (SELECT *, {_MONTH_END} AS month_end FROM (
  SELECT DISTINCT id, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM daily_personnel
  WHERE day(date) = 5)) p
 ASOF LEFT JOIN (SELECT responsible_id AS id, {_MONTH_END} AS objects_since, objects_count FROM monthly_objects) o
  ON o.id = p.id AND o.objects_since <= p.month_end
 ASOF LEFT JOIN (SELECT responsible_id AS id, realization_date AS deal_date, CAST(SUM(income) AS DECIMAL(28,2)) AS income
  FROM accounting WHERE realization_date IS NOT NULL GROUP BY ALL) r ON r.id = p.id AND r.deal_date <= p.month_end"""))
def _j6_asof(i: Inputs) -> DataFrame:
    """Each person-month with the objects and the last deal day's income as known at the month's end."""
    people = i.snapshot(snapshot_day_filter(i.rules)).select(
        "id", F.year("date").alias("year"), F.month("date").alias("month")).distinct().withColumn(
        "month_end", F.expr(_MONTH_END))
    objects = i.fx.monthly_objects.select(F.col("responsible_id").alias("id"), F.expr(_MONTH_END).alias("at"), "objects_count")
    deals = i.accounting.groupBy(F.col("responsible_id").alias("id"), F.col("realization_date").alias("at")).agg(
        F.sum("income").cast("decimal(28,2)").alias("income"))
    with_objects = asof_lookup(people, objects, ["id"], "month_end", "at", ["objects_count"], "objects_since")
    return asof_lookup(with_objects, deals, ["id"], "month_end", "at", ["income"], "deal_date")


_PLACE = "[company, department, CAST(user_id AS VARCHAR), property_type]"
_SETS = ", ".join(f"({', '.join(['year', 'month', *DRILL_PATH[:k]])})" for k in range(len(DRILL_PATH) + 1))


@unit("drilldown_levels", O.q(
    f"""SELECT year, month, level, CAST(to_json({_PLACE}[1:level]) AS VARCHAR) AS node,
 IF(level > 0, CAST(to_json({_PLACE}[1:level - 1]) AS VARCHAR), NULL) AS parent, {', '.join(DRILL_PATH)}, deal_count, deal_income
 FROM (SELECT year, month, {', '.join(DRILL_PATH)},
  CAST({len(DRILL_PATH)} - {' - '.join(f'GROUPING({c})' for c in DRILL_PATH)} AS INTEGER) AS level,
  COUNT(*) AS deal_count, CAST(SUM(income) AS DECIMAL(28,2)) AS deal_income
  FROM dm WHERE ata_id IS NOT NULL AND property_type IS NOT NULL GROUP BY GROUPING SETS ({_SETS}))""", *O.P2_CTES))
def _r3_levels(i: Inputs) -> DataFrame:
    return drilldown_levels(i.p2())


# --- R1: edited, moved and withdrawn records --------------------------------------------

def _first_versions(records: DataFrame) -> DataFrame:
    """An earlier state of the records: some in another month, with another person or status, and some that go later."""
    person = F.when(F.col("id") % 14 == 3, F.col("responsible_id") % 50 + 1).otherwise(F.col("responsible_id"))
    date = F.when(F.col("id") % 7 == 3, F.date_sub("realization_date", 40)).otherwise(F.col("realization_date"))
    income = F.when(F.col("id") % 7 == 4, (F.col("income") + 5).cast("decimal(18,2)")).otherwise(F.col("income"))
    changed = records.where("id % 13 <> 6").withColumns({"responsible_id": person, "realization_date": date, "income": income})
    return changed.unionByName(records.where("id % 19 = 5").withColumn("id", F.col("id") + 1_000_000_000_000))


def _versions(records: DataFrame) -> DataFrame:
    """What the feed brings then: the records as they are, some of them after an older version, and the withdrawals."""
    later = records.where("id % 7 IN (3, 4) OR id % 14 = 3 OR id % 13 = 6").selectExpr(
        "*", f"CAST(2 AS BIGINT) AS {E.VERSION}", f"FALSE AS {E.WITHDRAWN}")
    older = later.where("id % 7 = 3").withColumns({
        "realization_date": F.date_add("realization_date", 31), E.VERSION: F.lit(1).cast("long")})
    gone = records.where("id % 19 = 5").withColumns({
        "id": F.col("id") + 1_000_000_000_000, E.VERSION: F.lit(1).cast("long"), E.WITHDRAWN: F.lit(True)})
    # a version that is late: the withdrawal is newer
    late = gone.where("id % 2 = 0").withColumns({E.VERSION: F.lit(0).cast("long"), E.WITHDRAWN: F.lit(False)})
    return later.unionByName(older).unionByName(gone).unionByName(late)


def _fed(i: Inputs, name: str) -> tuple[E.RecordStore, str, object]:
    spark = i.fx.spark
    root = scratch_folder(spark, name)
    records = i.accounting
    store = E.RecordStore(spark, f"{root}/store", records.columns)
    store.load(_first_versions(records))
    feed = _versions(records)
    # two waves of files, so that there are several batches; the records are read by all tasks, not by those of the files
    for wave in (0, 1):
        feed.where(F.pmod(F.xxhash64("id", E.VERSION), F.lit(2)) == wave).repartition(4, "id", E.VERSION).write.mode(
            "append").parquet(f"{root}/landing")
    return store, root, feed.schema


@unit("inc_refresh_edits", O.q("SELECT * FROM dm", *O.P2_CTES))
def _r1_edits(i: Inputs) -> DataFrame:
    """The deal mart after a feed of edits, moves and withdrawals: equal to the full refresh of the final records."""
    spark = i.fx.spark
    store, root, schema = _fed(i, "inc-edits")
    snapshot = i.snapshot(snapshot_day_filter(i.rules))

    def mart_for(records: DataFrame, touched: DataFrame | None) -> DataFrame:
        return dm_sales_staff_deals(snapshot, i.users, records, i.fx.deal, i.fx.objects, i.fx.bid, i.rules, only=touched)

    target = f"{root}/mart"
    V.publish(spark, target, mart_for(store.read().select(*store.columns), None), E.MONTH)
    store.marts.append(E.person_month_mart(target, mart_for))
    E.run_edit_feed(spark, f"{root}/landing", schema, store, f"{root}/stream-checkpoint", files_per_batch=4)
    return V.read_table(spark, target).select(*DM_DEALS_COLUMNS)


@unit("inc_refresh_sales", O.q(O.P8_SELECT))
def _r1_sales(i: Inputs) -> DataFrame:
    """The sales report kept by signed partial sums of the same feed: equal to the full report of the final records."""
    spark = i.fx.spark
    store, root, schema = _fed(i, "inc-sales")

    def report_rows(records: DataFrame, keep: list[str]) -> DataFrame:
        return sales_report_rows(records, i.fx.deal, i.fx.objects, i.users, i.fx.bid, i.rules, tuple(keep))

    partials = E.SalesPartials(f"{root}/sales", report_rows)
    partials.load(spark, store.read().select(*store.columns))
    store.marts.append(partials)
    E.run_edit_feed(spark, f"{root}/landing", schema, store, f"{root}/stream-checkpoint", files_per_batch=4)
    return partials.report(spark)


# --- K2: reconciliation ------------------------------------------------------------------

#: A month whose records all lose their closed status, and a person whose records do.
LOST = "year(realization_date) = 1995 AND month(realization_date) = 3 OR id % 23 = 1"
LOST_STATUS = f"CASE WHEN {LOST} THEN 'В работе' ELSE status END"
_LOST_BASE = O.base_ctes(accounting_status=LOST_STATUS)
_REFRESHED = "year >= 1995"


@unit("upsert_reconcile", (
    f"SELECT * FROM ({O.q('SELECT * FROM dm', *O.P2_CTES)}) o WHERE ata_id IS NOT NULL AND NOT ({_REFRESHED}) UNION ALL "
    f"SELECT * FROM ({O.q('SELECT * FROM dm', *O.P2_CTES, base=_LOST_BASE)}) n WHERE ata_id IS NOT NULL AND {_REFRESHED}"))
def _k2_reconcile(i: Inputs) -> DataFrame:
    """The stored deal rows after a refresh of the years from 1995 on, in which some deals lost their closed status: their
    rows are ended, also where a month is left without any; earlier years are not the refresh's and stay."""
    spark = i.fx.spark
    path = f"{scratch_folder(spark, 'reconcile')}/dm"
    snapshot = i.snapshot(snapshot_day_filter(i.rules))

    def deals(records: DataFrame) -> DataFrame:
        rows = dm_sales_staff_deals(snapshot, i.users, records, i.fx.deal, i.fx.objects, i.fx.bid, i.rules)
        return rows.where("ata_id IS NOT NULL")

    V.publish(spark, path, deals(i.accounting), E.MONTH)
    source = deals(i.accounting.withColumn("status", F.expr(LOST_STATUS))).where(_REFRESHED)
    owned = [p for p in V.partitions(spark, path) if int(p.split("/")[0].split("=")[1]) >= 1995]
    owned = sorted({*owned, *E.folders(source, E.MONTH)})
    reconcile_table(spark, path, source, S.KEYS["dm_sales_staff_deals"][0], E.MONTH, owned)
    return V.read_table(spark, path).select(*DM_DEALS_COLUMNS)


# --- J2: hot foreign keys ------------------------------------------------------------------

_HOT_DEAL = "CASE WHEN id % 3 = 0 THEN (SELECT min(id) FROM deal) ELSE deal_id END"


@unit("join_hot_key", O.q(f"SELECT a.id AS ata_id, a.deal_id, d.object_id, d.bid_id, d.deal_type, d.developer "
                          f"FROM (SELECT id, {_HOT_DEAL} AS deal_id FROM accounting) a LEFT JOIN deal d ON d.id = a.deal_id"))
def _j2_hot(i: Inputs) -> DataFrame:
    """Records with a third of them on one deal (and some on none), each with its deal."""
    deal = i.fx.deal.select(F.col("id").alias("d_id"), "object_id", "bid_id", "deal_type", "developer")
    least = i.fx.deal.agg(F.min("id")).first()[0]
    fact = i.accounting.select(F.col("id").alias("ata_id"), F.when(F.col("id") % 3 == 0, F.lit(least)).otherwise(
        F.col("deal_id")).alias("deal_id"))
    return hot_left_lookup(fact, deal, "deal_id", "d_id")
