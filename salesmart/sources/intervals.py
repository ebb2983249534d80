"""The personnel snapshot as validity intervals.

A row per person and day grows with head count times days although people rarely change. ``compact`` keeps one row for
each run of consecutive snapshot days on which a person's attributes are the same (gaps and islands). The days on which a
person has the same attributes are bits, WORD of them in a number, which a hash aggregate brings together: the wide rows
of a person's days are never sorted or kept, and the islands are the runs of bits.

Measures that depend on the day itself (tenure, age, months since leaving) are no attributes: they would end an interval
every month. They are computed again from the day when a day is looked up (``expand``), which gives the same rows.

A day is looked up by month: an interval is repeated for each month it covers, so the join is on equal (person, month)
keys with the range as a filter, never a range product. Whole snapshots come back by the calendar of the snapshot's days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions import measures as M
from salesmart.sources.snapshot import SNAPSHOT_COLUMNS

#: What a person is on a day, whatever the day.
ATTRIBUTES = ["full_name", "company", "department", "position", "career_start", "office", "is_active", "deactivation_date",
              "gender", "birth_date"]
INTERVAL_COLUMNS = ["id", *ATTRIBUTES, "valid_from", "valid_to"]


#: Days that share a number of bits.
WORD = 64


def _runs(words: Column) -> Column:
    """The runs (first, last) of the day numbers whose bits are set in the words (word, bits), in any order."""
    def numbers(w):
        return F.filter(F.sequence(w["word"] * WORD, w["word"] * WORD + (WORD - 1)), lambda n: F.call_function(
            "shiftright", w["bits"], F.pmod(n, F.lit(WORD))).bitwiseAND(F.lit(1)) == 1)

    def of(ns):
        firsts = F.filter(ns, lambda n, k: (k == 0) | (F.get(ns, k - 1) < n - 1))
        lasts = F.filter(ns, lambda n, k: (k == F.size(ns) - 1) | (F.get(ns, k + 1) > n + 1))
        return F.arrays_zip(firsts.alias("first"), lasts.alias("last"))
    all_numbers = F.flatten(F.transform(F.array_sort(words), numbers))
    return F.transform(F.array(all_numbers), of)[0]


def compact(snapshot: DataFrame, days: DataFrame) -> DataFrame:
    """Intervals (id, attributes, valid_from, valid_to) of a snapshot; ``days`` (date) are the days a snapshot was taken.

    Two of a person's rows are consecutive when no snapshot day lies between them. Days are numbered through a table as
    long as the calendar, which every task gets whole. A person's words meet in one task: as many as snapshot days / WORD.
    """
    taken = days.select("date").distinct()
    numbered = taken.select("date", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("date")).alias("no"))
    rows = snapshot.select("date", "id", *ATTRIBUTES).join(F.broadcast(numbered), "date")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("no", F.lit(WORD)))
    words = rows.groupBy("id", *ATTRIBUTES, F.floor(F.col("no") / WORD).cast("int").alias("word")).agg(
        F.bit_or(bit).alias("bits"))
    held = words.groupBy("id", *ATTRIBUTES).agg(F.collect_list(F.struct("word", "bits")).alias("words"))
    runs = held.select("id", *ATTRIBUTES, F.inline(_runs(F.col("words"))).alias("first", "last"))
    for no, date in (("first", "valid_from"), ("last", "valid_to")):
        at = numbered.select(F.col("no").alias(no), F.col("date").alias(date))
        runs = runs.join(F.broadcast(at), no)
    return runs.select(*INTERVAL_COLUMNS)


def _month(date: Column) -> Column:
    return F.year(date) * 12 + F.month(date)


def expand(intervals: DataFrame, days: DataFrame) -> DataFrame:
    """The snapshot rows of the wanted ``days`` (date): each day's people with the measures of that day."""
    months = F.sequence(_month(F.col("valid_from")), _month(F.col("valid_to")))
    by_month = intervals.withColumn("_month", F.explode(months))
    # the wanted days are a calendar: every task gets them whole, so that the intervals stay where they are
    wanted = F.broadcast(days.select("date").distinct().withColumn("_month", _month(F.col("date"))))
    rows = by_month.join(wanted, (by_month["_month"] == wanted["_month"])
                         & wanted["date"].between(by_month["valid_from"], by_month["valid_to"]))
    date = F.col("date")
    return rows.select("date", "id", *ATTRIBUTES, M.months_since("deactivation_date", date).alias("deactivation_period"),
                       M.month_diff(date, "career_start").alias("experience"),
                       M.age_decimal("birth_date", date).alias("age")).select(*SNAPSHOT_COLUMNS)
