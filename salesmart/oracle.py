"""DuckDB SQL for every registered query (the correctness oracle).

Each text runs on the driver's test tables (views named like the parquet
files); the domain relations come from the shared fixture texts in
``sources.fixtures``.  The marts are stated here from their rules in another
way than the Spark plans compute them: the first record of a group is the one
that no earlier record precedes (an anti join), the activity metrics are one
long table that is pivoted, head-count buckets and bands are small rule tables.
"""

from __future__ import annotations

import datetime as dt

from salesmart.rules import DEFAULT_RULES
from salesmart.sources.fixtures import RELATIONS, relation_sql

AS_OF = DEFAULT_RULES.as_of
CUTOFF = dt.date(2000, 1, 1)

HOME = "'Города Новосибирск'"
RENTAL = "'Аренда'"
CLOSED = "'Проведен'"
RENT_LIKE = "'%аренд%'"


def d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def md(ref: str, start: str) -> str:
    """Whole calendar months from start to ref."""
    return f"((year({ref}) - year({start})) * 12 + (month({ref}) - month({start})))"


def snapshot_sql(day_filter: str | None = None) -> str:
    where = "u.company LIKE 'Города%'" + (f" AND ({day_filter})" if day_filter else "")
    start = "COALESCE(u.career_start, u.start_date)"
    return f"""
SELECT c.date, u.id, u.full_name, u.company, u.department, u.position, {start} AS career_start, u.office,
 u.is_active, u.deactivation_date,
 CAST(COALESCE({md('c.date', 'u.deactivation_date')}, 0) AS INTEGER) AS deactivation_period,
 CAST({md('c.date', start)} AS INTEGER) AS experience, u.gender, u.birth_date,
 CAST(ROUND(CAST({md('c.date', 'u.birth_date')} AS DECIMAL(10,0)) / 12, 2) AS DECIMAL(10,2)) AS age
FROM users u JOIN presence c ON c.id = u.id WHERE {where}"""


def base_ctes(as_of: dt.date = AS_OF, accounting_before: dt.date | None = None,
              users_hired_before: dt.date | None = None, accounting_status: str | None = None) -> list[tuple[str, str]]:
    """``accounting_status`` is an expression that replaces the records' status."""
    ctes = []
    for name in RELATIONS:
        text = relation_sql(name, as_of)
        if name == "accounting" and accounting_before is not None:
            text = f"SELECT * FROM ({text}) WHERE realization_date < {d(accounting_before)}"
        if name == "accounting" and accounting_status is not None:
            text = f"SELECT * REPLACE ({accounting_status} AS status) FROM ({text})"
        if name == "users" and users_hired_before is not None:
            text = f"SELECT * FROM ({text}) WHERE COALESCE(career_start, start_date) < {d(users_hired_before)}"
        ctes.append((name, text))
    ctes.append(("daily_personnel", snapshot_sql()))
    return ctes


def q(select: str, *ctes: tuple[str, str], base: list[tuple[str, str]] | None = None) -> str:
    allc = (base if base is not None else base_ctes()) + list(ctes)
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in allc) + "\n" + select


#: The property type of a record, as a decision tree over its deal d, the deal's object o and bid b.
PROPERTY_TYPE = """COALESCE(IF(d.deal_type = 'От застройщика',
  IF(COALESCE(d.developer, '') = 'Риелторское агентство Города', 'Загородная новостройка',
     IF(COALESCE(b.object_type, '') = 'Коммерция', 'Коммерция', 'Новостройка')),
  IF(COALESCE(o.land_status, '') = 'Промназначения', 'Коммерция', o.property_type)), d.object_type)"""

#: deal id -> property type
DEAL_KIND = ("deal_kind", f"""SELECT d.id AS deal_id, {PROPERTY_TYPE} AS kind
 FROM deal d LEFT JOIN objects o ON o.id = d.object_id LEFT JOIN bid b ON b.id = d.bid_id""")

IS_CLOSED = f"COALESCE(status = {CLOSED}, FALSE)"
IS_RENT = f"COALESCE(contract_name ILIKE {RENT_LIKE}, FALSE)"
YEAR, MONTH = "CAST(year({0}) AS INTEGER) AS year", "CAST(month({0}) AS INTEGER) AS month"


def month_of(date: str) -> str:
    return f"CAST(date_trunc('month', {date}) AS DATE)"


def not_preceded(rows: str, keys: list[str]) -> str:
    """Rows of a relation with (realization_date, ata_id) that no other row of the same keys comes before."""
    same = " AND ".join(f"e.{k} = r.{k}" for k in keys)
    return f"""SELECT r.* FROM {rows} r ANTI JOIN {rows} e ON {same} AND (e.realization_date < r.realization_date
 OR (e.realization_date = r.realization_date AND e.ata_id < r.ata_id))"""


# --- P1: the snapshot of the run date without people who left five or more months ago ---

def p1_sql(as_of: dt.date = AS_OF) -> str:
    return f"SELECT * FROM daily_personnel WHERE date = {d(as_of)} AND (is_active OR deactivation_period < 5)"


# --- P2 / P3: sales people by month, their sales, and the sale that opens the month -------

P2_CTES = [
    DEAL_KIND,
    ("sale", f"""SELECT responsible_id AS user_id, {month_of('realization_date')} AS ym, realization_date, income,
 id AS ata_id, contract_name, kind FROM accounting LEFT JOIN deal_kind USING (deal_id)
 WHERE realization_date IS NOT NULL AND {IS_CLOSED} AND company = {HOME} AND office <> {RENTAL} GROUP BY ALL"""),
    ("opener", not_preceded("sale", ["user_id", "ym"])),
    ("hired", f"""SELECT id AS user_id, full_name, department, position, is_active, company,
 {month_of('COALESCE(career_start, start_date)')} AS ym FROM users"""),
    ("crew", f"""SELECT user_id, full_name, department, position, is_active, experience, company,
 {YEAR.format('ym')}, {MONTH.format('ym')}, ym FROM (
  SELECT id AS user_id, full_name, department, position, is_active, experience, company, {month_of('date')} AS ym
  FROM daily_personnel WHERE day(date) = 5 AND experience > 0 AND company = {HOME} AND office <> {RENTAL}
  UNION ALL SELECT user_id, full_name, department, position, is_active, 0, company, ym
  FROM hired SEMI JOIN sale USING (user_id, ym)) GROUP BY ALL"""),
    ("sold", """SELECT c.*, s.realization_date, s.income, s.ata_id, COALESCE(s.kind, s.contract_name) AS property_type,
 EXISTS (SELECT 1 FROM opener x WHERE x.user_id = s.user_id AND x.ym = s.ym AND x.ata_id = s.ata_id) AS opens
 FROM crew c JOIN sale s USING (user_id, ym)"""),
    ("dm", f"""SELECT year, month, user_id, full_name, department, position, is_active, experience, company,
 realization_date, income, ata_id, property_type,
 IF(property_type IS NULL, NULL, IF(property_type ILIKE {RENT_LIKE}, 'Аренда', 'Продажа')) AS deal_category,
 CAST(COALESCE(opens AND property_type NOT ILIKE {RENT_LIKE}, FALSE) AS INTEGER) AS is_first_valid_deal
 FROM (SELECT * EXCLUDE (ym) FROM sold
  UNION ALL BY NAME SELECT c.* EXCLUDE (ym) FROM crew c ANTI JOIN sale s USING (user_id, ym))"""),
]

P3_SELECT = """SELECT *, CAST(IF(deal_count = 0, NULL, ROUND(deal_income / deal_count)) AS DECIMAL(28,0)) AS avg_income
FROM (SELECT year, month, full_name, department, position, company, property_type, deal_category,
  COUNT(full_name) AS deal_count, CAST(SUM(income) AS DECIMAL(28,2)) AS deal_income
  FROM dm WHERE deal_category IS NOT NULL GROUP BY ALL)"""

# --- P4: records summed by id and labels, met by the month's staff; newcomers' records -------


def _summed(more: str, where: str) -> str:
    return f"""SELECT responsible_id AS user_id, {month_of('realization_date')} AS ym, {more} id AS ata_id, realization_date,
 status, contract_id, contract_name, deal_type, SUM(income) AS income, SUM(payment) AS payment
 FROM accounting WHERE realization_date IS NOT NULL AND {where} GROUP BY ALL"""


def _labelled(rows: str) -> str:
    """The columns of the mart from rows with month ym, a person, a record (or nulls) and first."""
    return f"""SELECT {MONTH.format('ym')}, {YEAR.format('ym')}, user_id, full_name, department, position, is_active,
 CAST(experience AS INTEGER) AS experience, COALESCE(ata_id, 0) AS ata_id,
 IF({IS_CLOSED}, status, 'Нет данных') AS status, realization_date, COALESCE(contract_id, 1) AS contract_id,
 COALESCE(contract_name, IF({IS_CLOSED}, 'Новостройка', 'Нет данных')) AS contract_name,
 COALESCE(deal_type, 'Не размечено') AS deal_type,
 CAST(IF({IS_CLOSED}, income, 0) AS DECIMAL(28,2)) AS income, CAST(IF({IS_CLOSED}, payment, 0) AS DECIMAL(28,2)) AS payment,
 CAST({IS_CLOSED} AND NOT {IS_RENT} AS INTEGER) AS deal, CAST(first AS INTEGER) AS is_first_occurrence FROM ({rows})"""


P4_CTES = [
    ("record", _summed("", "TRUE")),
    ("earliest", not_preceded("record", ["user_id", "ym"])),
    ("present", f"""SELECT id AS user_id, {month_of('date')} AS ym, full_name, department, position, is_active, experience
 FROM daily_personnel WHERE day(date) = 5 AND experience > 0 AND office <> {RENTAL}"""),
    ("arm_a", _labelled("""SELECT p.*, r.* EXCLUDE (user_id, ym), r.user_id IS NULL OR EXISTS (SELECT 1 FROM earliest e
  WHERE e.user_id = r.user_id AND e.ym = r.ym AND e.ata_id = r.ata_id) AS first
  FROM present p LEFT JOIN record r ON r.user_id = p.user_id AND r.ym = p.ym""")),
    ("debut", f"""SELECT r.*, u.position, u.is_active, 0 AS experience FROM (
  {_summed("responsible_name AS full_name, team AS department,", f"company = {HOME} AND office <> {RENTAL}")}) r
  JOIN users u ON u.id = r.user_id AND {month_of('COALESCE(u.career_start, u.start_date)')} = r.ym"""),
    ("arm_b", _labelled("""SELECT *, (user_id, realization_date, ata_id) = (SELECT MIN((user_id, realization_date, ata_id))
  FROM debut) AS first FROM debut""")),
    ("traffic", "SELECT * FROM (SELECT * FROM arm_a UNION ALL BY NAME SELECT * FROM arm_b) GROUP BY ALL"),
]
P4_SELECT = "SELECT * FROM traffic"

# --- P5: monthly totals per status, spread over the staff present on the 5th ----------

P5_CTES = [
    ("band", "SELECT * FROM (VALUES (25, 100000, '24+'), (13, 24, '13-24'), (7, 12, '07-12'), (3, 6, '03-06')) v(lo, hi, label)"),
    ("total", f"""SELECT responsible_id AS id, {month_of('realization_date')} AS ym, status,
 SUM(income) FILTER (WHERE {IS_CLOSED}) AS income, COUNT(*) FILTER (WHERE {IS_CLOSED} AND NOT {IS_RENT}) AS deal
 FROM accounting WHERE realization_date IS NOT NULL GROUP BY ALL"""),
    ("rds", f"""SELECT {MONTH.format('p.date')}, {YEAR.format('p.date')}, p.id AS user_id, p.full_name, p.department, p.position,
 IF(NOT p.is_active, 'Уволен', 'Активен') AS is_active, p.experience,
 COALESCE(band.label, '0' || p.experience) AS exp_category, COALESCE(t.status, 'Нет данных') AS status,
 CAST(COALESCE(t.income, 0) AS DECIMAL(28,2)) AS income, COALESCE(t.deal, 0) AS deal
 FROM daily_personnel p LEFT JOIN total t ON t.id = p.id AND t.ym = {month_of('p.date')}
 LEFT JOIN band ON p.experience BETWEEN band.lo AND band.hi
 WHERE day(p.date) = 5 AND p.experience > 0 AND p.office <> {RENTAL}"""),
]
P5_SELECT = "SELECT * FROM rds"

# --- P6: every metric as (person, month or none, name, value), pivoted over the staff ------

#: output column -> (relation, person column, value column); then those that hold for every month of a person
MONTHLY = {"nvstr": ("count_developer_deals", "responsible_id", "deals"), "exclusives": ("exclusive_contract", "agent_id", "count"),
           "deals": ("deal_count", "agents_id", "deals"), "mortgage_leads": ("mortgage_count_leads", "id", "leads"),
           "mortgage_consult": ("mortgage_consult_count", "id", "leads"),
           "new_objects": ("monthly_objects", "responsible_id", "objects_count"),
           "cost_change_count": ("cost_change_objects", "responsible_id", "cost_change_count"),
           "bids": ("bid_buy_count", "id", "bids")}
STANDING = {"all_objects": ("actual_objects", "objects_count")} | {
    c: ("ad_tables_count", c) for c in ("ads_count", "avito_count", "cian_count", "yandex_count", "domclick_count")} | {
    "avician": ("ad_tables_count", "avician_count")}
#: columns that do not count in the total: parts of the advertisement count
PARTS = ("avito_count", "cian_count", "yandex_count", "domclick_count", "avician")


def metric_ctes() -> list[tuple[str, str]]:
    arms = [f"SELECT {who} AS id, make_date(year, month, 1) AS ym, '{out}' AS name, \"{value}\" AS n FROM {rel}"
            for out, (rel, who, value) in MONTHLY.items()]
    arms += [f"SELECT responsible_id AS id, NULL AS ym, '{out}' AS name, {value} AS n FROM {rel}"
             for out, (rel, value) in STANDING.items()]
    return [("metric", " UNION ALL ".join(arms))]


def pivoted(people: str, columns: list[str]) -> str:
    """people (a relation with id, ym and columns) with one column for each metric and the total."""
    def of(name: str) -> str:
        kind = "INTEGER" if name == "all_objects" else "BIGINT"
        return f"CAST(COALESCE(SUM(n) FILTER (WHERE name = '{name}'), 0) AS {kind}) AS {name}"
    parts = ", ".join(f"'{p}'" for p in PARTS)
    mine = ", ".join(f"p.{c}" for c in columns)
    return f"""SELECT {mine}, {", ".join(of(c) for c in [*MONTHLY, *STANDING])},
 CAST(COALESCE(SUM(n) FILTER (WHERE name NOT IN ({parts})), 0) AS BIGINT) AS all_sum
 FROM ({people}) p LEFT JOIN metric m ON m.id = p.id AND (m.ym = p.ym OR m.ym IS NULL) GROUP BY p.ym, {mine}"""


def p6_ctes(as_of: dt.date = AS_OF) -> list[tuple[str, str]]:
    people = f"""SELECT DISTINCT id, full_name, department, position, {month_of('date')} AS ym, {MONTH.format('date')},
 {YEAR.format('date')}, CAST({md('date', 'career_start')} AS INTEGER) AS experience FROM daily_personnel
 WHERE (day(date) = 5 AND daily_personnel.experience > 0)
  OR (date = {d(as_of - dt.timedelta(days=2))} AND {month_of('career_start')} = {month_of(d(as_of))})"""
    columns = ["month", "year", "id", "full_name", "department", "position", "experience"]
    return metric_ctes() + [("kv", f"SELECT * FROM ({pivoted(people, columns)}) WHERE all_sum > 0")]


P6_SELECT = "SELECT * FROM kv"

# --- P7: a table of roles and one of buckets, joined to the people ----------------------

#: (rental office, position) -> role
_ROLES = [
    (False, "Эксперт по недвижимости", "agent"), (False, "Специалист по недвижимости", "agent"),
    (False, "Специалист отдела коммерческой недвижимости", "agent"), (False, "Менеджер отдела продаж", "manager"),
    (False, "Помощник специалиста", "helper"), (False, "Помощник менеджера", "helper"),
    (False, "Старший агент по недвижимости", "leave"), (False, "Агент по недвижимости", "starter"),
    (True, "Менеджер отдела аренды", "manager"), (True, "Помощник специалиста", "helper"),
    (True, "Администратор", "office"), (True, "Руководитель", "office"), (True, "Специалист по аренде недвижимости", "agent"),
]
#: bucket, rental office, only in sales teams, role, tenure from and to, and whether an empty bucket counts NULL
_BUCKETS = [
    (">24", False, True, "agent", 25, 9999, True), ("7-12", False, True, "agent", 7, 12, True),
    ("13-24", False, True, "agent", 13, 24, True), ("Менеджеры ОП", False, True, "manager", None, None, False),
    ("Помощники ОП", False, True, "helper", None, None, False), ("Декрет", False, False, "leave", None, None, False),
    ("Группа 0", False, False, "starter", None, None, False), ("АУП ОП", False, False, "back office", None, None, False),
    ("Менеджеры ОА", True, False, "manager", None, None, False), ("Помощники ОА", True, False, "helper", None, None, False),
    ("АУП ОА", True, False, "office", None, None, False), (">6", True, False, "agent", 7, 9999, False),
    ("0-3", True, False, "agent", 0, 3, False), ("4-6", True, False, "agent", 4, 6, False),
]
BUCKETS = [b[0] for b in _BUCKETS]


def _values(rows: list[tuple]) -> str:
    def of(x) -> str:
        return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x).upper()
    return "VALUES " + ", ".join("(" + ", ".join(of(x) for x in r) + ")" for r in rows)


def p7_ctes(as_of: dt.date = AS_OF) -> list[tuple[str, str]]:
    return [
        ("roles", f"SELECT * FROM ({_values(_ROLES)}) v(rental, position, role)"),
        ("bucket", f"SELECT * FROM ({_values(_BUCKETS)}) v(label, rental, team_only, role, lo, hi, null_if_empty)"),
        ("worker", f"""SELECT id, position, department, office = {RENTAL} AS rental, {md(d(as_of), 'COALESCE(career_start, start_date)')} AS t,
 COALESCE(department ILIKE 'Команда%' OR department = 'Отдел коммерческой недвижимости', FALSE) AS team
 FROM users WHERE is_active AND company = {HOME} AND office IS NOT NULL"""),
        # the back office is told by what people are not; it may overlap with the other roles
        ("acting", """SELECT w.*, r.role FROM worker w JOIN roles r USING (rental, position)
 UNION ALL SELECT w.*, 'back office' FROM worker w LEFT JOIN roles r USING (rental, position)
 WHERE NOT w.rental AND NOT w.team AND w.department NOT IN ('Декрет', 'Группа 0', 'Технические аккаунты')
  AND w.position IS NOT NULL AND r.role IS DISTINCT FROM 'helper'"""),
        ("member", """SELECT a.id, b.label FROM bucket b JOIN acting a ON a.rental = b.rental AND a.role = b.role
  AND (a.team OR NOT b.team_only) AND (b.lo IS NULL OR a.t BETWEEN b.lo AND b.hi)"""),
        ("fresh", "SELECT id, t FROM acting WHERE NOT rental AND team AND role = 'agent' AND t < 7"),
    ]


def p7_sql(as_of: dt.date = AS_OF, base: list | None = None) -> str:
    sel = f"""SELECT {d(as_of - dt.timedelta(days=1))} AS date, users_count, exp FROM (
 SELECT COUNT(id) AS users_count, CAST(t AS VARCHAR) AS exp FROM fresh GROUP BY t
 UNION ALL SELECT IF(b.null_if_empty, NULLIF(COUNT(m.id), 0), COUNT(m.id)), b.label
 FROM bucket b LEFT JOIN member m USING (label) GROUP BY b.label, b.null_if_empty)"""
    return q(sel, *p7_ctes(as_of), base=base)


def p7_daily_sql() -> str:
    """P7 of every snapshot day, counted day by day."""
    ctes = dict(p7_ctes())
    ctes["worker"] = f"""SELECT date, id, position, department, office = {RENTAL} AS rental, experience AS t,
 COALESCE(department ILIKE 'Команда%' OR department = 'Отдел коммерческой недвижимости', FALSE) AS team
 FROM daily_personnel WHERE is_active AND company = {HOME} AND office IS NOT NULL"""
    ctes["member"] = ctes["member"].replace("SELECT a.id", "SELECT a.date, a.id")
    ctes["fresh"] = ctes["fresh"].replace("SELECT id", "SELECT date, id")
    sel = """SELECT CAST(date - INTERVAL 1 DAY AS DATE) AS date, users_count, exp FROM (
 SELECT date, COUNT(id) AS users_count, CAST(t AS VARCHAR) AS exp FROM fresh GROUP BY date, t
 UNION ALL SELECT s.date, IF(s.null_if_empty, NULLIF(COUNT(m.id), 0), COUNT(m.id)), s.label
 FROM (SELECT * FROM (SELECT DISTINCT date FROM presence), bucket) s
 LEFT JOIN member m ON m.label = s.label AND m.date = s.date GROUP BY s.date, s.label, s.null_if_empty)"""
    return q(sel, *ctes.items())


# --- P8, P9 ---------------------------------------------------------------------

P8_SELECT = f"""SELECT realization_date, kind AS property_type, CAST(SUM(income) AS DECIMAL(28,2)) AS income,
 COUNT(id) AS deals_count FROM accounting LEFT JOIN ({DEAL_KIND[1]}) USING (deal_id)
 WHERE {IS_CLOSED} AND responsible_id IN (SELECT id FROM users WHERE company = {HOME})
  AND COALESCE(contract_name, '') NOT IN ('Договор аренды', 'Эксклюзивный договор аренды помещения') GROUP BY ALL"""


def p9_sql(as_of: dt.date = AS_OF, base: list | None = None) -> str:
    a = d(as_of)
    ages = _values([(18, 25, "18–25"), (26, 35, "26–35"), (36, 45, "36–45"), (46, 55, "46–55"), (56, 9999, "56+")])
    tenures = _values([(0, 6, "0-6"), (7, 12, "07-12"), (13, 24, "13-24"), (25, 99999, "25+")])
    person = f"""SELECT id, full_name, company, office, department, position, birth_date,
 CAST(date_sub('year', birth_date, {a}) AS INTEGER) AS age, gender, COALESCE(career_start, start_date) AS career_start,
 CAST({md(a, 'COALESCE(career_start, start_date)')} AS INTEGER) AS experience, is_active,
 IF(is_active, NULL, deactivation_date) AS deactivation_date FROM users WHERE company ILIKE 'Города%'"""
    # this year's birthday and next year's; the first that is not over counts
    days = f"""list_min(list_filter([date_diff('day', {a}, CAST(birth_date + to_years(CAST(year({a}) + k - year(birth_date) AS INTEGER)) AS DATE))
 for k in [0, 1]], lambda n: n >= 0))"""
    sel = f"""SELECT person.*, COALESCE(g.label, 'Не указан / ошибка') AS age_group, x.label AS exp_group,
 COALESCE(experience >= 3, FALSE) AS exp3plus, COALESCE(experience >= 7, FALSE) AS exp7plus,
 CAST(COALESCE({days}, 9999) AS INTEGER) AS days_to_birthday FROM person
 LEFT JOIN ({ages}) g(lo, hi, label) ON age BETWEEN g.lo AND g.hi
 LEFT JOIN ({tenures}) x(lo, hi, label) ON experience BETWEEN x.lo AND x.hi"""
    return q(sel, ("person", person), base=base)


def mart_sql() -> dict[str, str]:
    return {
        "mart_daily_personnel": q(p1_sql()),
        "mart_dm_sales_staff_deals": q("SELECT * FROM dm", *P2_CTES),
        "mart_sales_staff_agg_income": q(P3_SELECT, *P2_CTES),
        "mart_traffic_light": q(P4_SELECT, *P4_CTES),
        "mart_rds_5th_day": q(P5_SELECT, *P5_CTES),
        "mart_key_values": q(P6_SELECT, *p6_ctes()),
        "mart_headcount": p7_sql(),
        "mart_operational_sales": q(P8_SELECT),
        "mart_hr_analytics": p9_sql(),
    }
