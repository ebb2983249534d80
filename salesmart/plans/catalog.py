"""Registry of runnable queries: key -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's test tables through the fixture adapter and
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.plans import activity, deals, people
from salesmart.rules import DEFAULT_RULES, Rules
from salesmart.sources.fixtures import shared_fixtures
from salesmart.sources.snapshot import daily_personnel_history, key_values_day_filter, snapshot_day_filter

class Inputs:
    """Domain relations for one test-data directory, optionally restricted to an earlier state."""

    def __init__(self, spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT_RULES,
                 accounting_before: dt.date | None = None, users_hired_before: dt.date | None = None):
        self.fx = shared_fixtures(spark, sf_dir, rules)
        self.rules = rules
        self.accounting_before = accounting_before
        self.users_hired_before = users_hired_before

    @property
    def users(self) -> DataFrame:
        u = self.fx.users
        if self.users_hired_before is not None:
            u = u.where(F.coalesce("career_start", "start_date") < F.lit(self.users_hired_before))
        return u

    @property
    def accounting(self) -> DataFrame:
        a = self.fx.accounting
        if self.accounting_before is not None:
            a = a.where(F.col("realization_date") < F.lit(self.accounting_before))
        return a

    def __getattr__(self, name: str) -> DataFrame:
        return getattr(self.fx, name)

    def snapshot(self, day_filter=None) -> DataFrame:
        """The derived snapshot for the wanted days (a lazy plan, built once per fixture, day filter and staff state)."""
        key = ("snapshot", repr(day_filter), self.users_hired_before)
        cache = self.fx.plans
        if key not in cache:
            cache[key] = daily_personnel_history(self.users, self.fx.presence, self.rules, day_filter)
        return cache[key]

    # --- marts -----------------------------------------------------------------
    def p1(self) -> DataFrame:
        return people.daily_personnel(self.users, self.fx.calendar, self.rules)

    def p2(self) -> DataFrame:
        return deals.dm_sales_staff_deals(self.snapshot(snapshot_day_filter(self.rules)), self.users, self.accounting,
                                          self.fx.deal, self.fx.objects, self.fx.bid, self.rules)

    def p3(self) -> DataFrame:
        return deals.sales_staff_agg_income(self.p2())

    def p4(self) -> DataFrame:
        return activity.traffic_light_1m(self.snapshot(snapshot_day_filter(self.rules)), self.accounting,
                                         self.users, self.rules)

    def p5(self) -> DataFrame:
        return activity.rds_on_5th_day(self.snapshot(snapshot_day_filter(self.rules)), self.accounting, self.rules)

    def p6(self) -> DataFrame:
        return activity.key_values(self.snapshot(key_values_day_filter(self.rules)), self.fx.metrics(), self.rules)

    def p7(self) -> DataFrame:
        return people.operational_headcount(self.users, self.rules)

    def p8(self) -> DataFrame:
        return deals.operational_sales_report(self.accounting, self.fx.deal, self.fx.objects, self.users,
                                              self.fx.bid, self.rules)

    def p9(self) -> DataFrame:
        return people.hr_employee_analytics(self.users, self.rules)


Query = Callable[[SparkSession, str], DataFrame]


def _mart(method: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return getattr(Inputs(spark, sf_dir), method)()
    run.__name__ = method
    return run


MARTS: dict[str, Query] = {
    "mart_daily_personnel": _mart("p1"),
    "mart_dm_sales_staff_deals": _mart("p2"),
    "mart_sales_staff_agg_income": _mart("p3"),
    "mart_traffic_light": _mart("p4"),
    "mart_rds_5th_day": _mart("p5"),
    "mart_key_values": _mart("p6"),
    "mart_headcount": _mart("p7"),
    "mart_operational_sales": _mart("p8"),
    "mart_hr_analytics": _mart("p9"),
}


def _unit(fn: Callable[[Inputs], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "unit")
    return run


def queries() -> dict[str, Query]:
    from salesmart.plans import features, sinks  # noqa: F401  (they register their queries)
    from salesmart.plans.units import UNITS
    out: dict[str, Query] = {}
    out.update(MARTS)
    out.update({key: _unit(fn) for key, (fn, _sql) in UNITS.items()})
    return out
