"""Deal marts: salesperson-month deals (P2), income aggregate (P3), sales report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions import measures as M
from salesmart.operators.first_rows import FIRST, group_minimum
from salesmart.operators.joins import left_lookup, prefixed
from salesmart.rules import DEFAULT_RULES, RENTAL_CONTRACT_NAMES, Rules

PERSON_MONTH = ["user_id", "year", "month"]

DM_DEALS_COLUMNS = [
    "year", "month", "user_id", "full_name", "department", "position", "is_active",
    "experience", "company", "realization_date", "income", "ata_id",
    "property_type", "deal_category", "is_first_valid_deal",
]


def with_property_type(fact: DataFrame, deal: DataFrame, objects: DataFrame, bid: DataFrame,
                       deal_key: str = "deal_id", out: str = "property_type") -> DataFrame:
    """Attach M11's property type to fact rows: fact -> deal -> object, deal -> bid.

    The fact is filtered before this call, so only its deals are looked up.
    Each step is a left lookup with NULL keys salted (a third of the facts
    may lack a deal, an object or a bid); small dimensions are broadcast by
    AQE when their measured size allows.  Only ``out`` is added.
    """
    d = prefixed(deal.select("id", "object_id", "bid_id", "deal_type", "developer", "object_type"), "d_")
    o = prefixed(objects.select("id", "property_type", "land_status"), "o_")
    b = prefixed(bid.select("id", "object_type"), "b_")
    x = left_lookup(fact, d, deal_key, "d_id")
    x = left_lookup(x, o, "d_object_id", "o_id")
    x = left_lookup(x, b, "d_bid_id", "b_id")
    ptype = M.property_type("d_deal_type", "d_developer", "b_object_type", "o_land_status",
                            "o_property_type", "d_object_type")
    return x.select(*fact.columns, ptype.alias(out))


def home_sales_records(accounting: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Closed, dated records of the home company outside the rental office."""
    return accounting.where(
        (F.col("company") == rules.home_company) & (F.col("office") != rules.rental_office)
        & (F.col("status") == rules.closed_status) & F.col("realization_date").isNotNull())


def staff_on_snapshot_day(daily_personnel: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Sales staff as recorded on each month's snapshot day, tenure above zero."""
    return daily_personnel.where(
        (F.dayofmonth("date") == rules.snapshot_day) & (F.col("office") != rules.rental_office)
        & (F.col("company") == rules.home_company) & (F.col("experience") > 0)
    ).select(F.col("id").alias("user_id"), "full_name", "department", "position", "is_active",
             "experience", "company", F.year("date").alias("year"), F.month("date").alias("month"))


#: The order of a month's deals: by date and record id, as the report has it; the rest decides between records of one id.
#: No two rows of ``valid_deals`` agree in all of it.
RECORD_ORDER = ["realization_date", "ata_id", "income", "contract_name", "deal_order"]


def _deal_order() -> Column:
    """The deal id as a number that is never NULL, so that its minimum stays in the hash aggregate."""
    return F.coalesce(F.col("deal_id"), F.lit(-2**63))


def deal_months(accounting: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Person-months with a closed deal and the smallest RECORD_ORDER of each: one aggregate, combined map-side."""
    records = home_sales_records(accounting, rules).select(
        F.col("responsible_id").alias("user_id"), F.year("realization_date").alias("year"),
        F.month("realization_date").alias("month"), "realization_date", F.col("id").alias("ata_id"), "income",
        "contract_name", _deal_order().alias("deal_order"))
    return group_minimum(records, PERSON_MONTH, RECORD_ORDER)


def newcomers(accounting: DataFrame, users: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """People with a closed deal in the month they started (tenure 0 at the deal).

    "Started that month" is an equi-join of the deal months on (person, year,
    month) with the people's start months, so only newcomer months come out
    and one person's records spread over their months.
    """
    # the test on FIRST, which is never null here, keeps its column, so that all readers of the aggregate share its exchange
    months = deal_months(accounting, rules).where(F.col(FIRST).isNotNull())
    starts = M.start_month_keys(users, ["full_name", "department", "position", "is_active", "company"])
    return (months.join(starts, PERSON_MONTH, "inner")
                  .select("user_id", "full_name", "department", "position", "is_active",
                          F.lit(0).alias("experience"), "company", "year", "month")
                  .distinct())


def valid_deals(accounting: DataFrame, deal: DataFrame, objects: DataFrame, bid: DataFrame,
                rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Closed home-company deals with their property type (contract name as fallback).

    Rows are distinct with their contract name, which the result leaves out:
    two records that differ only there stay two.  Rows are made distinct by
    all columns, so a busy person-month spreads over the tasks; of the records
    that become one row the smallest deal id stands for it (``deal_order``).
    """
    records = home_sales_records(accounting, rules).select(
        "realization_date", F.year("realization_date").alias("year"), F.month("realization_date").alias("month"),
        F.col("responsible_id").alias("user_id"), "income", F.col("id").alias("ata_id"), "contract_name", "deal_id")
    typed = with_property_type(records, deal, objects, bid, out="object_property")
    distinct = typed.groupBy(*[c for c in typed.columns if c != "deal_id"]).agg(F.min(_deal_order()).alias("deal_order"))
    return distinct.select(
        "realization_date", "year", "month", "user_id", "income", "ata_id",
        F.coalesce("object_property", "contract_name").alias("property_type"), "contract_name", "deal_order")


def sales_staff(daily_personnel: DataFrame, accounting: DataFrame, users: DataFrame,
                rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Distinct staff rows of each person-month, the smallest of them marked by ``leads``.

    A person-month has the row of its snapshot day and the newcomer's row at
    most, so the set that is sorted has two rows, whoever it is.  The rows stay
    laid out by person-month for the join with the months' first deals.
    """
    rows = staff_on_snapshot_day(daily_personnel, rules).unionByName(newcomers(accounting, users, rules))
    others = [c for c in rows.columns if c not in PERSON_MONTH]
    held = rows.groupBy(*PERSON_MONTH).agg(F.sort_array(F.collect_set(F.struct(*others))).alias("held"))
    return held.select(*PERSON_MONTH, F.posexplode("held").alias("n", "r")).select(
        *[F.col("r")[c].alias(c) if c in others else F.col(c) for c in rows.columns], (F.col("n") == 0).alias("leads"))


def _month_number() -> Column:
    return F.col("year") * 12 + F.col("month")


def dm_sales_staff_deals(daily_personnel: DataFrame, users: DataFrame, accounting: DataFrame, deal: DataFrame,
                         objects: DataFrame, bid: DataFrame, rules: Rules = DEFAULT_RULES,
                         only: DataFrame | None = None) -> DataFrame:
    """Every salesperson-month with each valid deal, or one empty row without deals.

    ``is_first_valid_deal`` marks the month's earliest deal (date, then record
    id) when it is dated, typed and not a rental; if the earliest deal is a
    rental nobody is flagged that month.  Exactly one row is the earliest, also
    where records share an id or a person has two staff rows in the month.

    ``only`` (user_id, year, month) restricts the computation to those
    person-months (semi joins on the snapshot and the records); the rows of a
    person-month do not depend on any other person-month.
    """
    if only is not None:
        from salesmart.plans.activity import restrict_to
        daily_personnel, accounting = restrict_to(daily_personnel, accounting, only)
    staff = sales_staff(daily_personnel, accounting, users, rules)
    staff_columns = [c for c in staff.columns if c != "leads"]
    deals = valid_deals(accounting, deal, objects, bid, rules)
    # Months without a minimum have no deals.  The two branches read the same subtree of staff and minimum.
    staff_first = staff.join(deal_months(accounting, rules), PERSON_MONTH, "left")
    # The deals join on (person, month number): other keys than those staff_first is laid out by, so both sides come
    # from a shuffle of their own and AQE can split a busy person-month. The keys are never NULL (a person without an id
    # has a text that no id has), else a test for NULL would be pushed into this branch's staff and the other branch
    # would compute the staff again.
    by_month = staff_first.withColumns({"_n": F.coalesce(_month_number(), F.lit(-1)),
                                        "_who": F.coalesce(F.col("user_id").cast("string"), F.lit(""))})
    deals = deals.where(F.col("user_id").isNotNull()).withColumns({
        "_n": F.coalesce(_month_number(), F.lit(-1)), "_who": F.coalesce(F.col("user_id").cast("string"), F.lit(""))
    }).drop("user_id", "year", "month")
    is_first = F.col("leads") & F.struct(*RECORD_ORDER).eqNullSafe(F.col(FIRST))
    valid_first = is_first & F.col("property_type").isNotNull() & ~M.is_rental_text("property_type", rules)
    with_deals = by_month.join(deals, ["_who", "_n"], "inner").select(
        *staff_columns, "realization_date", "income", "ata_id", "property_type",
        F.when(valid_first, 1).otherwise(0).alias("is_first_valid_deal"))
    without = staff_first.where(F.col(FIRST).isNull()).select(
        *staff_columns, F.lit(None).cast("date").alias("realization_date"),
        F.lit(None).cast(deals.schema["income"].dataType).alias("income"),
        F.lit(None).cast("long").alias("ata_id"), F.lit(None).cast("string").alias("property_type"),
        F.lit(0).alias("is_first_valid_deal"))
    rows = with_deals.unionByName(without)
    return rows.select(*[c for c in DM_DEALS_COLUMNS if c != "deal_category"],
                       M.deal_category("property_type", rules).alias("deal_category")).select(*DM_DEALS_COLUMNS)


def sales_staff_agg_income(dm_deals: DataFrame) -> DataFrame:
    """Deals, income and average cheque per person, property type and month.

    ``COUNT(full_name)`` skips unnamed rows; an average over zero named rows is NULL.
    """
    typed = dm_deals.where(F.col("property_type").isNotNull() & F.col("deal_category").isNotNull())
    agg = typed.groupBy("year", "month", "full_name", "department", "position", "company",
                        "property_type", "deal_category").agg(
        F.count("full_name").alias("deal_count"), F.sum("income").alias("deal_income"))
    avg = F.round(F.try_divide(F.col("deal_income"), F.col("deal_count").cast("decimal(20,0)")), 0)
    return agg.select("year", "month", "full_name", "department", "position", "company", "property_type",
                      "deal_category", "deal_count", F.col("deal_income").cast("decimal(28,2)").alias("deal_income"),
                      avg.cast("decimal(28,0)").alias("avg_income"))


def sales_report_rows(accounting: DataFrame, deal: DataFrame, objects: DataFrame, users: DataFrame, bid: DataFrame,
                      rules: Rules = DEFAULT_RULES, keep: tuple[str, ...] = ()) -> DataFrame:
    """The records behind P8 (id, realization_date, income, property_type and the columns to keep).

    The users join only keeps records of home-company people (a semi join).
    """
    rental_contract = F.col("contract_name").isin(*RENTAL_CONTRACT_NAMES)
    records = accounting.where((F.col("status") == rules.closed_status)
                               & (~rental_contract | F.col("contract_name").isNull()))
    records = records.select("id", "responsible_id", "realization_date", "deal_id", "income", *keep)
    home = users.where(F.col("company") == rules.home_company).select(F.col("id").alias("responsible_id"))
    records = records.join(home, "responsible_id", "left_semi")
    return with_property_type(records, deal, objects, bid)


def operational_sales_report(accounting: DataFrame, deal: DataFrame, objects: DataFrame, users: DataFrame,
                             bid: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Closed non-rental-contract income and deal count per realization date and property type.

    The aggregate is combined map-side, so only (date, type) partials shuffle.
    """
    typed = sales_report_rows(accounting, deal, objects, users, bid, rules)
    return typed.groupBy("realization_date", "property_type").agg(
        F.sum("income").cast("decimal(28,2)").alias("income"), F.count("id").alias("deals_count"))

