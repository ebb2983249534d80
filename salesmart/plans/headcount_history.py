"""Head count of a range of days in one pass (P7 for many run days).

P7 counts the staff of one day. Run for each day of a year it reads all people 365 times. Here a person's stay in a
bucket is a span of days: the validity of the attributes cut to the months in which the tenure lies in the bucket. Each
span is +1 on its first day and -1 after its last. The events are summed by bucket and day (combined map-side), so what
is sorted is at most one row per bucket and day, however many people there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.plans.people import FRESH_BELOW, headcount_buckets
from salesmart.rules import DEFAULT_RULES, Rules


def _month_number(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date)


def _first_day(month: Column) -> Column:
    return F.add_months(F.lit("0001-01-01").cast("date"), (month - 13).cast("int"))


def _span(label: Column, fresh: bool, start: Column, lo: Column | None, hi: Column | None) -> Column:
    """The days of the row's validity on which the tenure (months since ``start``) is from ``lo`` to ``hi``."""
    first, last = F.col("valid_from"), F.col("valid_to")
    if lo is not None:
        first = F.greatest(first, _first_day(start + lo))
    if hi is not None:
        last = F.least(last, F.date_sub(_first_day(start + hi + 1), 1))
    return F.struct(label.alias("exp"), F.lit(fresh).alias("fresh"), first.alias("first"), last.alias("last"))


def _spans(staff: DataFrame, rules: Rules) -> DataFrame:
    agents, buckets = headcount_buckets(rules)
    start = _month_number(F.col("career_start"))
    number = lambda n: None if n is None else F.lit(n)
    fixed = [F.when(who & (F.lit(True) if lo is None and hi is None else start.isNotNull()),
                    _span(F.lit(label), False, start, number(lo), number(hi)))
             for label, (who, lo, hi, _) in buckets.items()]
    from_month, to_month = (_month_number(F.col(c)) - start for c in ("valid_from", "valid_to"))
    until = F.least(to_month, F.lit(FRESH_BELOW - 1))
    months = F.when(agents & (from_month <= until), F.sequence(from_month, until))
    fresh = F.transform(F.coalesce(months, F.array().cast("array<int>")),
                        lambda t: _span(t.cast("string"), True, start, t, t))
    spans = F.concat(F.array_compact(F.array(*fixed)), fresh)
    return staff.select(F.explode(spans).alias("s")).select("s.*").where("first <= last")


def headcount_history(staff: DataFrame, days: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """P7's rows (date, users_count, exp) of each run day in ``days`` (date); a row is dated the day before its run.

    ``staff`` is the snapshot as intervals (``sources.intervals``): id, company, department, position, office, is_active,
    career_start, valid_from, valid_to (NULL: still valid), at most one interval of a person on a day. As in P7, buckets
    overlap and each counts on its own; a fixed bucket has a row on every day (NULL or 0 when empty, as P7 has it), a
    tenure month only where somebody is in it. People without an id are not counted.
    """
    days = days.select("date").where(F.col("date").isNotNull()).distinct()
    least, most = (days.agg(f("date")).scalar() for f in (F.min, F.max))
    held = staff.where((F.col("company") == rules.home_company) & (F.col("is_active") == F.lit(True))
                       & F.col("id").isNotNull()).withColumns({
        "valid_from": F.greatest(F.col("valid_from"), least), "valid_to": F.least(F.col("valid_to"), most)})
    spans = _spans(held, rules)
    events = spans.select("exp", "fresh", F.explode(F.array(
        F.struct(F.col("first").alias("date"), F.lit(1).alias("n")),
        F.struct(F.date_add("last", 1).alias("date"), F.lit(-1).alias("n")))).alias("e"))
    change = events.groupBy("exp", "fresh", F.col("e.date").alias("date")).agg(F.sum("e.n").alias("n"))
    by = Window.partitionBy("exp", "fresh").orderBy("date")
    runs = change.select("exp", "fresh", F.sum("n").over(by).alias("users_count"), F.col("date").alias("first"),
                         F.date_sub(F.lead("date").over(by), 1).alias("last")).where("users_count > 0")
    counts = runs.select("exp", "fresh", "users_count", F.explode(F.sequence("first", "last")).alias("date"))

    _, buckets = headcount_buckets(rules)
    listed = F.array(*[F.struct(F.lit(label).alias("exp"), F.lit(empty).alias("null_if_empty"))
                       for label, (_, _, _, empty) in buckets.items()])
    fixed = days.select("date", F.explode(listed).alias("b")).select("date", "b.*")
    fixed = fixed.join(counts.where("NOT fresh").drop("fresh"), ["date", "exp"], "left").select(
        "date", F.when(F.col("null_if_empty"), F.col("users_count")).otherwise(
            F.coalesce("users_count", F.lit(0).cast("long"))).alias("users_count"), "exp")
    months = counts.where("fresh").join(days, "date", "left_semi").select("date", "users_count", "exp")
    return fixed.unionByName(months).withColumn("date", F.date_sub("date", 1))
