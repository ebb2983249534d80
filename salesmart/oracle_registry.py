"""Oracle SQL per registered query key."""

from __future__ import annotations

from salesmart import oracle


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(oracle.mart_sql())
    from salesmart.plans import features, sinks  # noqa: F401
    from salesmart.plans.units import UNITS
    out.update({key: sql for key, (_fn, sql) in UNITS.items() if sql is not None})
    return out
