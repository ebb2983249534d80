"""Dashboard access patterns: row-level security (R2), KPI drill-down and its levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart import rules as R

KPI_GROUP = ["year", "month", "full_name", "department", "position", "company", "property_type", "deal_category"]


def department_heads(users: DataFrame) -> DataFrame:
    """Entitlements derived from the staff table: each head may see the rows of their own department."""
    return users.where(F.col("position") == R.HEAD_POSITION).select(F.col("id").alias("viewer_id"), "department")


def row_level_filter(mart: DataFrame, entitlements: DataFrame, viewers: DataFrame, column: str = "department") -> DataFrame:
    """Rows of ``mart`` that at least one of ``viewers`` (viewer_id) may see, each once: semi joins with their
    entitlements (viewer_id, column), so the result never has more rows than the mart.

    Usually ``viewers`` is the one person who opened a report.  Rows with a NULL value are visible to nobody.
    """
    granted = entitlements.join(viewers, "viewer_id", "left_semi").select(column).distinct()
    return mart.join(granted, column, "left_semi").select(*mart.columns)


def drilldown(kpi: DataFrame, deals: DataFrame, group: list[str] = KPI_GROUP) -> DataFrame:
    """Each KPI row with the deal rows behind it (NULL-safe match on the KPI's group columns).

    The KPI side has one row per group, so a group holding many deals only
    repeats one row; nothing is collected per group.
    """
    k = kpi.alias("k")
    d = deals.alias("d")
    cond = reduce(lambda a, b: a & b, [F.col("k." + c).eqNullSafe(F.col("d." + c)) for c in group])
    return k.join(d, cond, "inner").select(
        *[F.col("k." + c).alias(c) for c in group], F.col("k.deal_count"), F.col("k.deal_income"),
        F.col("d.user_id"), F.col("d.ata_id"), F.col("d.realization_date"), F.col("d.income"))


#: Levels of the drill path below the month, from the top down.
DRILL_PATH = ["company", "department", "user_id", "property_type"]


def drilldown_levels(deals: DataFrame, path: list[str] = DRILL_PATH, period: list[str] = ["year", "month"]) -> DataFrame:
    """Deal count and income of each period on all levels of the drill path, as one relation.

    ``level`` 0 is the whole period, level k the first k columns of ``path`` (the others NULL). ``node`` is the row's own
    place in the path and ``parent`` the place above it (NULL on level 0): JSON lists, in which a missing department is a
    null and so not mixed up with the level above. The rows of one parent add up to it.

    Deals are summed on the lowest level first (combined map-side), so the grouping sets repeat sums, not deals.
    """
    leaves = deals.where(F.col("ata_id").isNotNull() & F.col("property_type").isNotNull()).groupBy(*period, *path).agg(
        F.count("*").alias("n"), F.sum("income").alias("s"))
    sets = [[F.col(c) for c in [*period, *path[:k]]] for k in range(len(path) + 1)]
    rolled = reduce(lambda a, b: a + b, [F.grouping(c).cast("int") for c in path])
    sums = leaves.groupingSets(sets, *period, *path).agg(
        (F.lit(len(path)) - rolled).alias("level"), F.sum("n").alias("deal_count"),
        F.sum("s").cast("decimal(28,2)").alias("deal_income"))
    place = F.array(*[F.col(c).cast("string") for c in path])

    def key(depth) -> Column:
        return F.to_json(F.slice(place, F.lit(1), depth))

    return sums.select(*period, "level", key(F.col("level")).alias("node"),
                       F.when(F.col("level") > 0, key(F.greatest(F.col("level") - 1, F.lit(0)))).alias("parent"),
                       *path, "deal_count", "deal_income")


def below(levels: DataFrame, node: str) -> DataFrame:
    """The rows one step below a place of the drill path, in all periods."""
    return levels.where(F.col("parent") == node)
