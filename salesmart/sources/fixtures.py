"""Adapter from the driver's TPC-H-like test tables to the domain relations.

The test data carries no people, deals or property objects, so each domain
relation is defined as one SQL text over a test table (see FIXTURES.md).  The
same text runs in Spark (``spark.sql`` with DataFrame arguments, no global
views) and in DuckDB (the oracle), so both engines see identical inputs.

Placeholders: ``{customer}``, ``{orders}``, ``{part}``, ``{supplier}``,
``{events}``, ``{lineitem}`` name test tables; ``@AS_OF@`` and ``@AS_OF_MINUS_2@`` are the
refresh clock.  The texts are fixture definitions, not mart logic.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from salesmart.rules import DEFAULT_RULES, Rules

TEST_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

USERS_SQL = """
SELECT c_custkey AS id, c_name AS full_name,
 CASE c_custkey % 20 WHEN 0 THEN 'Города Томск' WHEN 1 THEN 'ГОРОДА Новосибирск' WHEN 2 THEN 'Прочее' ELSE 'Города Новосибирск' END AS company,
 CASE WHEN c_custkey % 6 = 0 THEN 'Аренда' WHEN c_custkey % 31 = 1 THEN NULL ELSE 'Продажа' END AS office,
 CASE c_custkey % 10 WHEN 0 THEN 'Отдел коммерческой недвижимости' WHEN 1 THEN 'команда 7' WHEN 2 THEN 'Декрет' WHEN 3 THEN 'Группа 0' WHEN 4 THEN 'Технические аккаунты' WHEN 5 THEN 'Бухгалтерия' WHEN 6 THEN NULL ELSE 'Команда ' || CAST(c_nationkey AS VARCHAR(10)) END AS department,
 CASE c_custkey % 13 WHEN 0 THEN 'Эксперт по недвижимости' WHEN 1 THEN 'Специалист по недвижимости' WHEN 2 THEN 'Специалист отдела коммерческой недвижимости' WHEN 3 THEN 'Менеджер отдела продаж' WHEN 4 THEN 'Помощник специалиста' WHEN 5 THEN 'Помощник менеджера' WHEN 6 THEN 'Старший агент по недвижимости' WHEN 7 THEN 'Агент по недвижимости' WHEN 8 THEN 'Менеджер отдела аренды' WHEN 9 THEN 'Администратор' WHEN 10 THEN 'Руководитель' ELSE CASE WHEN c_custkey % 6 = 0 THEN 'Специалист по аренде недвижимости' ELSE 'Эксперт по недвижимости' END END AS position,
 CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN DATE '1998-01-01' + CAST(c_custkey * 37 % 910 AS INT) ELSE DATE '1994-06-01' + CAST(c_custkey * 37 % 2300 AS INT) END AS start_date,
 CASE WHEN c_custkey % 4 = 0 OR c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN DATE '1998-01-01' + CAST(c_custkey * 41 % 910 AS INT) ELSE DATE '1994-01-01' + CAST(c_custkey * 41 % 2350 AS INT) END AS career_start,
 CASE WHEN c_acctbal < 0 THEN FALSE ELSE TRUE END AS is_active,
 CASE WHEN c_acctbal >= 0 OR c_custkey % 7 = 0 THEN NULL ELSE DATE '2000-06-20' - CAST(c_custkey % 300 AS INT) END AS deactivation_date,
 CASE WHEN c_custkey % 2 = 0 THEN 'м' ELSE 'ж' END AS gender,
 CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN DATE '1960-02-29' ELSE DATE '1935-01-15' + CAST(c_custkey * 53 % 18000 AS INT) END AS birth_date
 FROM {customer}
"""

ACCOUNTING_SQL = """
SELECT o_orderkey AS id, o_custkey AS responsible_id, 'Resp ' || CAST(o_custkey AS VARCHAR(20)) AS responsible_name, 'Команда ' || CAST(o_custkey % 25 AS VARCHAR(10)) AS team,
 CASE WHEN o_orderkey % 20 = 0 THEN 'Города Томск' ELSE 'Города Новосибирск' END AS company,
 CASE WHEN o_orderkey % 9 = 0 THEN 'Аренда' WHEN o_orderkey % 31 = 1 THEN NULL ELSE 'Продажа' END AS office,
 CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS realization_date,
 CASE o_orderstatus WHEN 'F' THEN 'Проведен' WHEN 'O' THEN 'В работе' ELSE NULL END AS status,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 7 + 2 END AS contract_id,
 CASE substr(o_orderpriority,1,1) WHEN '1' THEN 'Договор аренды' WHEN '2' THEN 'Эксклюзивный договор аренды помещения' WHEN '3' THEN NULL WHEN '4' THEN 'Договор купли-продажи' ELSE 'СУБАРЕНДА ПЛЮС' END AS contract_name,
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE 'Вторичка' END AS deal_type,
 CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderkey END AS deal_id,
 CAST(o_totalprice AS DECIMAL(18,2)) AS income, CAST(o_totalprice AS DECIMAL(18,2)) - 100 AS payment FROM {orders}
"""

DEAL_SQL = """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE l.part END AS object_id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE l.supp END AS bid_id,
 CASE WHEN o_orderkey % 4 = 0 THEN 'От застройщика' ELSE 'Вторичка' END AS deal_type,
 CASE WHEN o_orderkey % 12 = 0 THEN 'Риелторское агентство Города' WHEN o_orderkey % 8 = 4 THEN NULL ELSE 'СтройДом' END AS developer,
 CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Комната' WHEN 2 THEN NULL ELSE 'Квартира' END AS object_type
 FROM {orders} LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS part, MIN(l_suppkey) AS supp FROM {lineitem} GROUP BY l_orderkey) l ON l_orderkey = o_orderkey
"""

OBJECTS_SQL = """
SELECT p_partkey AS id, CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_type END AS property_type, CASE WHEN p_size % 13 = 0 THEN 'Промназначения' ELSE NULL END AS land_status FROM {part}
"""

BID_SQL = """
SELECT s_suppkey AS id, CASE s_suppkey % 3 WHEN 0 THEN 'Коммерция' WHEN 1 THEN NULL ELSE 'Жилая' END AS object_type FROM {supplier}
"""

CALENDAR_SQL = """
SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) + 4 AS date FROM {orders} UNION SELECT DATE '@AS_OF_MINUS_2@' UNION SELECT DATE '@AS_OF@'
"""

# Days on which each person is on the books: the 5th of the months they have orders in and of the month after, and the
# two days a refresh looks at. It grows with the orders, not with people times days.
PRESENCE_SQL = """
SELECT o_custkey AS id, CAST(date_trunc('month', o_orderdate) AS DATE) + 4 AS date FROM {orders}
UNION SELECT o_custkey, CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) + 4 FROM {orders}
UNION SELECT c_custkey, DATE '@AS_OF_MINUS_2@' FROM {customer} UNION SELECT c_custkey, DATE '@AS_OF@' FROM {customer}
"""

# Eight dated metric relations: (person key, year, month, value) = count of kept orders.
# name -> (person key column, value column, predicate over orders)
DATED_METRICS = {
    "count_developer_deals": ("responsible_id", "deals", "o_orderpriority = '2-HIGH'"),
    "exclusive_contract": ("agent_id", "count", "o_orderpriority = '1-URGENT'"),
    "deal_count": ("agents_id", "deals", "o_orderstatus = 'F'"),
    "mortgage_count_leads": ("id", "leads", "o_orderpriority = '3-MEDIUM'"),
    "mortgage_consult_count": ("id", "leads", "o_orderpriority = '4-NOT SPECIFIED'"),
    "monthly_objects": ("responsible_id", "objects_count", "o_orderstatus = 'O'"),
    "cost_change_objects": ("responsible_id", "cost_change_count", "o_orderpriority = '5-LOW'"),
    "bid_buy_count": ("id", "bids", "o_orderstatus = 'P'"),
}

DATED_METRIC_SQL = """
SELECT o_custkey AS {key}, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT) AS year, CAST(EXTRACT(MONTH FROM o_orderdate) AS INT) AS month, COUNT(*) AS {value}
FROM {{orders}} WHERE {pred}
GROUP BY o_custkey, CAST(EXTRACT(YEAR FROM o_orderdate) AS INT), CAST(EXTRACT(MONTH FROM o_orderdate) AS INT)
"""

ACTUAL_OBJECTS_SQL = """
SELECT c_custkey AS responsible_id, c_nationkey AS objects_count FROM {customer}
"""

AD_TABLES_COUNT_SQL = """
SELECT user_id AS responsible_id,
 COUNT(CASE WHEN event_type <> 'error' THEN 1 END) AS ads_count,
 COUNT(CASE WHEN event_type = 'view' THEN 1 END) AS avito_count,
 COUNT(CASE WHEN event_type = 'click' THEN 1 END) AS cian_count,
 COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS yandex_count,
 COUNT(CASE WHEN event_type = 'signup' THEN 1 END) AS domclick_count,
 COUNT(CASE WHEN event_type IN ('view', 'click') THEN 1 END) AS avician_count
FROM {events} GROUP BY user_id
"""

# relation name -> (SQL text, test tables it reads)
RELATIONS: dict[str, tuple[str, tuple[str, ...]]] = {
    "users": (USERS_SQL, ("customer",)),
    "accounting": (ACCOUNTING_SQL, ("orders",)),
    "deal": (DEAL_SQL, ("orders", "lineitem")),
    "objects": (OBJECTS_SQL, ("part",)),
    "bid": (BID_SQL, ("supplier",)),
    "calendar": (CALENDAR_SQL, ("orders",)),
    "presence": (PRESENCE_SQL, ("orders", "customer")),
    "actual_objects": (ACTUAL_OBJECTS_SQL, ("customer",)),
    "ad_tables_count": (AD_TABLES_COUNT_SQL, ("events",)),
}
for _name, (_key, _value, _pred) in DATED_METRICS.items():
    RELATIONS[_name] = (DATED_METRIC_SQL.format(key=_key, value=_value, pred=_pred), ("orders",))

METRIC_RELATIONS = tuple(DATED_METRICS) + ("actual_objects", "ad_tables_count")


def _clock(text: str, as_of: dt.date) -> str:
    return (text.replace("@AS_OF_MINUS_2@", (as_of - dt.timedelta(days=2)).isoformat())
                .replace("@AS_OF@", as_of.isoformat()))


def relation_sql(name: str, as_of: dt.date = DEFAULT_RULES.as_of) -> str:
    """SQL text of one domain relation with test-table names filled in (for DuckDB)."""
    text, tables = RELATIONS[name]
    return _clock(text, as_of).format(**{t: t for t in tables})


def read_table(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


class Fixtures:
    """Lazily built domain relations over one test-data directory.

    Every relation is a lazy DataFrame; nothing is read until an action runs,
    and Catalyst prunes the test-table columns each mart does not use.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT_RULES):
        self.spark = spark
        self.sf_dir = sf_dir
        self.rules = rules
        self._tables: dict[str, DataFrame] = {}
        self._relations: dict[str, DataFrame] = {}
        self.plans: dict[tuple, DataFrame] = {}   # derived lazy plans shared by the queries (never data)

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    def relation(self, name: str) -> DataFrame:
        if name not in self._relations:
            text, tables = RELATIONS[name]
            self._relations[name] = self.spark.sql(
                _clock(text, self.rules.as_of), **{t: self.table(t) for t in tables})
        return self._relations[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in RELATIONS:
            return self.relation(name)
        raise AttributeError(name)

    def metrics(self) -> dict[str, DataFrame]:
        return {name: self.relation(name) for name in METRIC_RELATIONS}


_SHARED: dict[tuple, Fixtures] = {}


def shared_fixtures(spark: SparkSession, sf_dir: str, rules: Rules = DEFAULT_RULES) -> Fixtures:
    """One ``Fixtures`` per (session, directory, rules): the relations are analyzed once and reused.

    Only lazy plans are kept, never data.
    """
    key = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"), rules)
    if key not in _SHARED:
        _SHARED[key] = Fixtures(spark, sf_dir, rules)
    return _SHARED[key]
