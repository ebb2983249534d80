"""Derived measures as Spark Column expressions (all JVM-side, codegen friendly).

Month arithmetic is calendar arithmetic on the year and month parts only: the
day of month is ignored, results are whole ints and may be negative.  This is
not ``months_between``, which is fractional and day-aware.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesmart import rules as R

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date(x: ColumnOrName | dt.date) -> Column:
    return F.lit(x) if isinstance(x, dt.date) else _c(x)


# --- dates and tenure -------------------------------------------------------

def effective_start(career_start: ColumnOrName = "career_start", start_date: ColumnOrName = "start_date") -> Column:
    """The career start if known, else the hiring date."""
    return F.coalesce(_c(career_start), _c(start_date))


def month_diff(ref: ColumnOrName | dt.date, start: ColumnOrName | dt.date) -> Column:
    """M1: whole calendar months from ``start`` to ``ref``; NULL if either is NULL."""
    ref_c, start_c = as_date(ref), as_date(start)
    return ((F.year(ref_c) - F.year(start_c)) * 12 + (F.month(ref_c) - F.month(start_c))).cast("int")


def tenure_months(ref: ColumnOrName | dt.date,
                  career_start: ColumnOrName = "career_start",
                  start_date: ColumnOrName = "start_date") -> Column:
    """M1 with the effective start date."""
    return month_diff(ref, effective_start(career_start, start_date))


def start_month_keys(users, extra: list[str] | None = None):
    """(user_id, year, month) of each person's effective start, plus ``extra`` user columns.

    "Tenure 0 at a record" (M1 = 0) is the record's (year, month) equal to the
    start (year, month), so it can be an equi-join on these three keys instead
    of a join on the person followed by a filter.  People without a start
    date have NULL keys and, like NULL tenure, match nothing.
    """
    start = effective_start()
    return users.select(F.col("id").alias("user_id"), F.year(start).alias("year"), F.month(start).alias("month"),
                        *(extra or []))


def months_since(date: ColumnOrName, as_of: ColumnOrName | dt.date) -> Column:
    """M2: months since ``date`` at ``as_of``; a NULL date counts as 0."""
    return F.coalesce(month_diff(as_of, date), F.lit(0))


def age_decimal(birth_date: ColumnOrName, ref: ColumnOrName | dt.date) -> Column:
    """M3: age in years with two decimals, from year and month parts only."""
    months = month_diff(ref, birth_date).cast("decimal(10,0)")
    return F.round(months / F.lit(12).cast("decimal(10,0)"), 2).cast("decimal(10,2)")


def age_years(birth_date: ColumnOrName, as_of: ColumnOrName | dt.date) -> Column:
    """M4: completed years of age; a birthday later in the year is not yet counted."""
    b, a = _c(birth_date), as_date(as_of)
    before_birthday = (F.month(a) < F.month(b)) | ((F.month(a) == F.month(b)) & (F.dayofmonth(a) < F.dayofmonth(b)))
    return (F.year(a) - F.year(b) - F.when(before_birthday, 1).otherwise(0)).cast("int")


def days_to_birthday(birth_date: ColumnOrName, as_of: ColumnOrName | dt.date) -> Column:
    """M5: days until the next birthday, 0 on the day, 9999 when unknown.

    The birthday of this year is the birth date moved by whole years (29 Feb
    becomes 28 Feb in a common year); if it is past, one more year is added to
    that already clipped date.
    """
    b, a = _c(birth_date), as_date(as_of)
    this_year = F.add_months(b, (F.year(a) - F.year(b)) * 12)
    upcoming = F.when(this_year < a, F.add_months(this_year, 12)).otherwise(this_year)
    return F.when(b.isNull(), F.lit(R.NO_BIRTHDAY)).otherwise(F.datediff(upcoming, a)).cast("int")


# --- bands and labels ---------------------------------------------------------

def age_group(age: ColumnOrName) -> Column:
    """M6: age band; under 18 and unknown share one label."""
    a = _c(age)
    b = R.AGE_BANDS
    return (F.when(a.between(18, 25), b[0]).when(a.between(26, 35), b[1]).when(a.between(36, 45), b[2])
             .when(a.between(46, 55), b[3]).when(a >= 56, b[4]).otherwise(R.NOT_GIVEN))


def exp_group_hr(exp: ColumnOrName) -> Column:
    """M7: HR tenure band; negative or unknown tenure has no band (NULL)."""
    e = _c(exp)
    b = R.EXP_BANDS_HR
    return F.when(e.between(0, 6), b[0]).when(e.between(7, 12), b[1]).when(e.between(13, 24), b[2]).when(e >= 25, b[3])


def exp_category_rds(exp: ColumnOrName) -> Column:
    """M8: snapshot tenure band; below 3 months the label is '0' followed by the month count.

    The text concatenation skips a NULL count (giving '0'), as SQL CONCAT does.
    """
    e = _c(exp)
    b = R.EXP_BANDS_RDS
    return (F.when(e > 24, b[0]).when((e > 12) & (e < 25), b[1]).when((e > 6) & (e < 13), b[2])
             .when((e > 2) & (e < 7), b[3]).otherwise(F.concat_ws("", F.lit("0"), e.cast("int").cast("string"))))


def exp_at_least(exp: ColumnOrName, n: int) -> Column:
    """Tenure of at least n months; unknown tenure is false."""
    return F.coalesce(_c(exp) >= n, F.lit(False))


def property_type(deal_type: ColumnOrName = "deal_type", developer: ColumnOrName = "developer",
                  bid_object_type: ColumnOrName = "bid_object_type", land_status: ColumnOrName = "land_status",
                  object_property_type: ColumnOrName = "object_property_type",
                  deal_object_type: ColumnOrName = "deal_object_type") -> Column:
    """Property type of a deal from the deal, its bid and its object.

    Developer deals are split by developer and bid type; industrial land is
    commercial; else the object's own type, falling back to the deal's.
    """
    dtype, dev, btype = _c(deal_type), _c(developer), _c(bid_object_type)
    from_developer = dtype == R.DEVELOPER_DEAL_TYPE
    other_developer = (dev != R.IN_HOUSE_DEVELOPER) | dev.isNull()
    case = (F.when(from_developer & (dev == R.IN_HOUSE_DEVELOPER), R.SUBURBAN_NEW_BUILD)
             .when(from_developer & other_developer & (btype.isNull() | (btype != R.COMMERCIAL)), R.NEW_BUILD)
             .when(from_developer & other_developer & (btype == R.COMMERCIAL), R.COMMERCIAL)
             .when(_c(land_status) == R.INDUSTRIAL_LAND, R.COMMERCIAL)
             .otherwise(_c(object_property_type)))
    return F.coalesce(case, _c(deal_object_type))


def is_rental_text(text: ColumnOrName, rules: R.Rules = R.DEFAULT_RULES) -> Column:
    """Case-insensitive 'contains the rental word' (NULL stays NULL)."""
    return _c(text).ilike(rules.rental_pattern)


def deal_category(ptype: ColumnOrName, rules: R.Rules = R.DEFAULT_RULES) -> Column:
    """NULL, rent or sale."""
    p = _c(ptype)
    return F.when(p.isNull(), F.lit(None).cast("string")).when(is_rental_text(p, rules), R.CATEGORY_RENT).otherwise(R.CATEGORY_SALE)


def deal_flag(contract_name: ColumnOrName, status: ColumnOrName, rules: R.Rules = R.DEFAULT_RULES) -> Column:
    """1 for a closed, non-rental deal.  A NULL contract name of a closed deal counts."""
    s = _c(status)
    zero = is_rental_text(contract_name, rules) | (s != rules.closed_status) | s.isNull()
    return F.when(zero, F.lit(0)).otherwise(F.lit(1))


def status_label(status: ColumnOrName, rules: R.Rules = R.DEFAULT_RULES) -> Column:
    """Closed, or 'no data' for anything else."""
    return F.when(_c(status) == rules.closed_status, F.lit(rules.closed_status)).otherwise(F.lit(R.NO_DATA))


def contract_label(contract_name: ColumnOrName, status: ColumnOrName, rules: R.Rules = R.DEFAULT_RULES) -> Column:
    """A missing contract name is a new build when closed, else 'no data'."""
    n = _c(contract_name)
    return (F.when(n.isNull() & (_c(status) == rules.closed_status), F.lit(R.NEW_BUILD))
             .when(n.isNull(), F.lit(R.NO_DATA)).otherwise(n))


def active_label(is_active: ColumnOrName) -> Column:
    """Only an explicit false is 'dismissed'; NULL counts as active."""
    return F.when(_c(is_active) == F.lit(False), F.lit(R.DISMISSED_LABEL)).otherwise(F.lit(R.ACTIVE_LABEL))


def masked_deactivation(deactivation_date: ColumnOrName, is_active: ColumnOrName) -> Column:
    """No leaving date while the person is active."""
    return F.when(_c(is_active) == F.lit(True), F.lit(None).cast("date")).otherwise(_c(deactivation_date))


def fill(col: ColumnOrName, default) -> Column:
    """Default for a missing value."""
    return F.coalesce(_c(col), F.lit(default))


def total(cols: list[ColumnOrName]) -> Column:
    """Sum of already filled columns."""
    out = _c(cols[0])
    for c in cols[1:]:
        out = out + _c(c)
    return out


def report_date(as_of: dt.date, days_back: int = 1) -> Column:
    """The report is dated ``days_back`` days before the run."""
    return F.lit(as_of - dt.timedelta(days=days_back))
