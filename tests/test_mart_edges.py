"""Hand-made inputs for mart edge cases the fixture tables do not pin down."""

import datetime as dt
from decimal import Decimal

from salesmart.plans import activity, deals, people
from salesmart.rules import Rules
from salesmart.sources import snapshot

D = dt.date
USERS = ("id bigint, full_name string, company string, office string, department string, position string, "
         "start_date date, career_start date, is_active boolean, deactivation_date date, gender string, birth_date date")
ACCOUNTING = ("id bigint, responsible_id bigint, responsible_name string, team string, company string, office string, "
              "realization_date date, status string, contract_id bigint, contract_name string, deal_type string, "
              "deal_id bigint, income decimal(18,2), payment decimal(19,2)")
HOME = "Города Новосибирск"


def daily_personnel_history(users, calendar):
    """Everyone present on every day of a small calendar."""
    return snapshot.daily_personnel_history(users, users.select("id").crossJoin(calendar))


def user(spark, uid, name="A", office="Продажа", start=D(1999, 1, 10), active=True, position="Эксперт по недвижимости",
         department="Команда 1", company=HOME):
    return (uid, name, company, office, department, position, start, start, active, None, "ж", D(1980, 1, 1))


def record(rid, uid, day, contract, status="Проведен", income="100.00", deal_id=None):
    return (rid, uid, f"Resp {uid}", "Команда 1", HOME, "Продажа", day, status, None, contract, None, deal_id,
            Decimal(income), Decimal(income) - 100)


def empty_dims(spark):
    return (spark.createDataFrame([], "id bigint, object_id bigint, bid_id bigint, deal_type string, developer string, object_type string"),
            spark.createDataFrame([], "id bigint, property_type string, land_status string"),
            spark.createDataFrame([], "id bigint, object_type string"))


def test_first_deal_of_month_is_rental_so_nobody_is_flagged(spark):
    users = spark.createDataFrame([user(spark, 1)], USERS)
    cal = spark.createDataFrame([(D(2000, 3, 5),)], "date date")
    recs = spark.createDataFrame([record(10, 1, D(2000, 3, 10), "Договор аренды"),
                                  record(11, 1, D(2000, 3, 12), "Договор купли-продажи")], ACCOUNTING)
    dp = daily_personnel_history(users, cal)
    out = deals.dm_sales_staff_deals(dp, users, recs, *empty_dims(spark)).collect()
    assert sorted((r.ata_id, r.is_first_valid_deal, r.deal_category) for r in out) == [(10, 0, "Аренда"), (11, 0, "Продажа")]


def test_first_deal_uses_date_then_record_and_empty_month_row(spark):
    users = spark.createDataFrame([user(spark, 1)], USERS)
    cal = spark.createDataFrame([(D(2000, 3, 5),), (D(2000, 4, 5),)], "date date")
    recs = spark.createDataFrame([record(12, 1, D(2000, 3, 10), "Договор купли-продажи"),
                                  record(11, 1, D(2000, 3, 10), "Договор купли-продажи"),
                                  record(9, 1, D(2000, 3, 11), None, income="50.00")], ACCOUNTING)
    dp = daily_personnel_history(users, cal)
    out = deals.dm_sales_staff_deals(dp, users, recs, *empty_dims(spark)).collect()
    got = sorted((r.month, r.ata_id, r.is_first_valid_deal) for r in out)
    # record 9 has no contract name and no deal: property type NULL, category NULL
    assert got == [(3, 9, 0), (3, 11, 1), (3, 12, 0), (4, None, 0)]


def test_agg_income_null_name_counts_zero_and_average_is_null(spark):
    rows = [(2000, 3, 1, None, "Команда 1", "Эксперт", True, 5, HOME, D(2000, 3, 10), Decimal("100.00"), 10, "Квартира",
             "Продажа", 1)]
    schema = ("year int, month int, user_id bigint, full_name string, department string, position string, is_active boolean, "
              "experience int, company string, realization_date date, income decimal(18,2), ata_id bigint, "
              "property_type string, deal_category string, is_first_valid_deal int")
    out = deals.sales_staff_agg_income(spark.createDataFrame(rows, schema)).collect()
    assert [(r.deal_count, r.deal_income, r.avg_income) for r in out] == [(0, Decimal("100.00"), None)]


def test_headcount_empty_buckets_null_vs_zero(spark):
    users = spark.createDataFrame([user(spark, 1, position="Бухгалтер", department="Бухгалтерия")], USERS)
    out = {r.exp: r.users_count for r in people.operational_headcount(users, Rules(as_of=D(2000, 6, 20))).collect()}
    assert out[">24"] is None and out["7-12"] is None and out["13-24"] is None
    assert out["Менеджеры ОП"] == 0 and out["АУП ОП"] == 1
    assert not any(k.lstrip("-").isdigit() for k in out)   # no monthly rows
    assert len(out) == 14


def test_headcount_negative_tenure_month_label(spark):
    users = spark.createDataFrame([user(spark, 1, start=D(2000, 8, 1))], USERS)
    out = {r.exp: r.users_count for r in people.operational_headcount(users, Rules(as_of=D(2000, 6, 20))).collect()}
    assert out["-2"] == 1


def test_personnel_needs_calendar_day(spark):
    users = spark.createDataFrame([user(spark, 1)], USERS)
    cal = spark.createDataFrame([(D(2000, 6, 19),)], "date date")
    assert people.daily_personnel(users, cal, Rules(as_of=D(2000, 6, 20))).count() == 0
    cal = spark.createDataFrame([(D(2000, 6, 20),)], "date date")
    assert people.daily_personnel(users, cal, Rules(as_of=D(2000, 6, 20))).count() == 1


def test_personnel_retention(spark):
    rows = [user(spark, 1, active=False), user(spark, 2, active=False), user(spark, 3, active=False)]
    rows[0] = rows[0][:9] + (D(2000, 2, 1),) + rows[0][10:]   # left 4 months ago -> kept
    rows[1] = rows[1][:9] + (D(2000, 1, 31),) + rows[1][10:]  # 5 months -> dropped
    users = spark.createDataFrame(rows, USERS)               # id 3: no leaving date -> 0 months -> kept
    cal = spark.createDataFrame([(D(2000, 6, 20),)], "date date")
    got = sorted(r.id for r in people.daily_personnel(users, cal, Rules(as_of=D(2000, 6, 20))).collect())
    assert got == [1, 3]


def test_rds_status_groups_and_empty_month(spark):
    users = spark.createDataFrame([user(spark, 1)], USERS)
    cal = spark.createDataFrame([(D(2000, 3, 5),), (D(2000, 4, 5),)], "date date")
    recs = spark.createDataFrame([record(10, 1, D(2000, 3, 10), "СУБАРЕНДА", income="10.00"),
                                  record(11, 1, D(2000, 3, 12), None, income="20.00"),
                                  record(12, 1, D(2000, 3, 12), None, status="В работе", income="40.00")], ACCOUNTING)
    out = activity.rds_on_5th_day(daily_personnel_history(users, cal), recs).collect()
    got = sorted((r.month, r.status, str(r.income), r.deal, r.exp_category) for r in out)
    assert got == [(3, "В работе", "0.00", 0, "13-24"), (3, "Проведен", "30.00", 1, "13-24"),
                   (4, "Нет данных", "0.00", 0, "13-24")]


def test_traffic_newcomer_arm_flags_exactly_one_row(spark):
    users = spark.createDataFrame([user(spark, 1, start=D(2000, 3, 1)), user(spark, 2, start=D(2000, 3, 1))], USERS)
    recs = spark.createDataFrame([record(20, 2, D(2000, 3, 3), None), record(21, 1, D(2000, 3, 9), None),
                                  record(22, 1, D(2000, 3, 2), None)], ACCOUNTING)
    out = activity.traffic_arm_newcomers(recs, users).collect()
    assert sorted((r.ata_id, r.is_first_occurrence) for r in out) == [(20, 0), (21, 0), (22, 1)]


def test_traffic_sums_a_repeated_record_id(spark):
    users = spark.createDataFrame([user(spark, 1), user(spark, 2, start=D(2000, 3, 1))], USERS)
    dp = daily_personnel_history(users.where("id = 1"), spark.createDataFrame([(D(2000, 3, 5),)], "date date"))
    recs = spark.createDataFrame([record(10, 1, D(2000, 3, 10), None, income="100.00"),
                                  record(10, 1, D(2000, 3, 10), None, income="50.00"),
                                  record(20, 2, D(2000, 3, 10), None, income="7.00"),
                                  record(20, 2, D(2000, 3, 10), None, income="7.00")], ACCOUNTING)
    out = activity.traffic_light_1m(dp, recs, users).collect()
    assert sorted((r.ata_id, str(r.income), r.is_first_occurrence) for r in out) == [(10, "150.00", 1), (20, "14.00", 1)]


def _metrics(spark, dup_name=None):
    out = {}
    for name, (key, value, _out) in activity.DATED_METRIC_COLUMNS.items():
        rows = [(1, 2000, 3, 1)] + ([(1, 2000, 3, 2)] if name == dup_name else [])
        out[name] = spark.createDataFrame(rows, f"{key} bigint, year int, month int, {value} bigint")
    out["actual_objects"] = spark.createDataFrame([(1, 4)], "responsible_id bigint, objects_count int")
    out["ad_tables_count"] = spark.createDataFrame(
        [(1, 1, 1, 0, 0, 0, 1)], "responsible_id bigint, ads_count bigint, avito_count bigint, cian_count bigint, "
                                 "yandex_count bigint, domclick_count bigint, avician_count bigint")
    return out


def test_key_values_sums_metrics_and_rejects_duplicate_metric_keys(spark):
    import pytest
    users = spark.createDataFrame([user(spark, 1)], USERS)
    dp = daily_personnel_history(users, spark.createDataFrame([(D(2000, 3, 5),)], "date date"))
    row = activity.key_values(dp, _metrics(spark), Rules(as_of=D(2000, 6, 20))).collect()[0]
    assert (row.all_sum, row.all_objects, row.avician) == (8 + 4 + 1, 4, 1)
    with pytest.raises(Exception, match="duplicate key in metric relation deal_count"):
        activity.key_values(dp, _metrics(spark, "deal_count"), Rules(as_of=D(2000, 6, 20))).collect()


def test_one_first_deal_where_records_share_an_id(spark):
    """Records of one id that differ in contract, in money or in nothing the report shows: one row is the first."""
    users = spark.createDataFrame([user(spark, 1)], USERS)
    dp = daily_personnel_history(users, spark.createDataFrame([(D(2000, 3, 5),)], "date date"))
    sale, day = "Договор купли-продажи", D(2000, 3, 10)
    _, objects, bid = empty_dims(spark)
    deal = spark.createDataFrame([(5, None, None, None, None, "Квартира"), (6, None, None, None, None, "Дом")],
                                 empty_dims(spark)[0].schema)
    # records 10: a type from the deal each, or their contract name; two of them differ only in the name the report hides
    cases = [
        [record(10, 1, day, sale), record(10, 1, day, "Договор уступки")],
        [record(10, 1, day, sale, income="1.00"), record(10, 1, day, sale, income="2.00")],
        [record(10, 1, day, sale, deal_id=5), record(10, 1, day, "Договор уступки", deal_id=5)],
        [record(10, 1, day, sale, deal_id=5), record(10, 1, day, sale, deal_id=6), record(10, 1, day, sale)],
        [record(10, 1, day, sale), record(10, 1, day, sale), record(10, 1, day, sale, deal_id=9)],
    ]
    for want, recs in zip([2, 2, 2, 3, 1], cases):
        recs = spark.createDataFrame([*recs, record(11, 1, day, sale)], ACCOUNTING)
        out = deals.dm_sales_staff_deals(dp, users, recs, deal, objects, bid).collect()
        assert sorted(r.ata_id for r in out) == [10] * want + [11]
        assert [(r.ata_id, r.is_first_valid_deal) for r in out if r.is_first_valid_deal] == [(10, 1)]


def test_one_first_deal_of_a_person_with_two_staff_rows(spark):
    """The snapshot knew an earlier start than the staff table has now: a snapshot row and a newcomer's row."""
    now = spark.createDataFrame([user(spark, 1, start=D(2000, 3, 1))], USERS)
    then = spark.createDataFrame([user(spark, 1)], USERS)
    dp = daily_personnel_history(then, spark.createDataFrame([(D(2000, 3, 5),), (D(2000, 4, 5),)], "date date"))
    recs = spark.createDataFrame([record(10, 1, D(2000, 3, 10), "Договор купли-продажи"),
                                  record(11, 1, D(2000, 3, 11), "Договор купли-продажи")], ACCOUNTING)
    out = deals.dm_sales_staff_deals(dp, now, recs, *empty_dims(spark)).collect()
    assert sorted((r.month, r.ata_id, r.experience, r.is_first_valid_deal) for r in out if r.month == 3) == [
        (3, 10, 0, 1), (3, 10, 14, 0), (3, 11, 0, 0), (3, 11, 14, 0)]
    assert [(r.ata_id, r.is_first_valid_deal) for r in out if r.month == 4] == [(None, 0)]
