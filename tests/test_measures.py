"""Hand-made edge rows for the derived measures (calendar rules, NULL logic, labels)."""

import datetime as dt

from pyspark.sql import functions as F

from salesmart.functions import measures as M

D = dt.date


def one(spark, rows, schema, col):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_month_diff_ignores_days_and_can_be_negative(spark):
    rows = [(D(2000, 6, 30), D(2000, 6, 1)), (D(2000, 6, 1), D(2000, 5, 31)), (D(2000, 1, 5), D(2000, 3, 1)), (None, D(2000, 1, 1))]
    got = one(spark, rows, "ref date, start date", M.month_diff("ref", "start"))
    assert got == [0, 1, -2, None]


def test_months_since_null_is_zero(spark):
    got = one(spark, [(None,), (D(2000, 1, 31),)], "d date", M.months_since("d", D(2000, 6, 20)))
    assert got == [0, 5]


def test_age_years_uses_completed_years_not_months_between(spark):
    rows = [(D(2000, 2, 29), D(2023, 2, 28)), (D(2000, 2, 29), D(2023, 3, 1)), (D(1990, 6, 20), D(2000, 6, 20)),
            (D(1990, 6, 21), D(2000, 6, 20)), (None, D(2000, 6, 20))]
    got = one(spark, rows, "b date, a date", M.age_years("b", "a"))
    assert got == [22, 23, 10, 9, None]


def test_days_to_birthday_feb29_clips_then_adds_year(spark):
    rows = [(D(2000, 2, 29), D(2023, 2, 28)), (D(2000, 2, 29), D(2023, 3, 1)), (D(1980, 6, 20), D(2000, 6, 20)),
            (D(1980, 6, 21), D(2000, 6, 20)), (None, D(2000, 6, 20))]
    got = one(spark, rows, "b date, a date", M.days_to_birthday("b", "a"))
    # 2023-02-28 is the clipped birthday (today); from 2023-03-01 the next is 2024-02-28 (clipped date + 1 year)
    assert got == [0, 364, 0, 1, 9999]


def test_age_decimal_from_year_and_month_parts(spark):
    got = one(spark, [(D(1990, 7, 31), D(2000, 6, 1))], "b date, a date", M.age_decimal("b", "a"))
    assert str(got[0]) == "9.92"   # 119 months / 12


def test_age_and_tenure_bands(spark):
    ages = one(spark, [(17,), (18,), (25,), (26,), (56,), (None,)], "a int", M.age_group("a"))
    assert ages == ["Не указан / ошибка", "18–25", "18–25", "26–35", "56+", "Не указан / ошибка"]
    hr = one(spark, [(-1,), (0,), (7,), (24,), (25,), (None,)], "e int", M.exp_group_hr("e"))
    assert hr == [None, "0-6", "07-12", "13-24", "25+", None]
    rds = one(spark, [(1,), (2,), (3,), (7,), (13,), (25,), (-3,), (None,)], "e int", M.exp_category_rds("e"))
    assert rds == ["01", "02", "03-06", "07-12", "13-24", "24+", "0-3", "0"]


def test_exp_flags_null_is_false(spark):
    got = one(spark, [(None,), (2,), (3,), (7,)], "e int", F.struct(M.exp_at_least("e", 3), M.exp_at_least("e", 7)))
    assert [tuple(g) for g in got] == [(False, False), (False, False), (True, False), (True, True)]


def test_deal_flag_three_valued_logic(spark):
    rows = [("Договор купли-продажи", "Проведен"), (None, "Проведен"), ("СУБАРЕНДА ПЛЮС", "Проведен"),
            ("Договор купли-продажи", "В работе"), ("Договор купли-продажи", None), (None, None)]
    got = one(spark, rows, "n string, s string", M.deal_flag("n", "s"))
    assert got == [1, 1, 0, 0, 0, 0]


def test_labels(spark):
    got = one(spark, [(True,), (False,), (None,)], "a boolean", M.active_label("a"))
    assert got == ["Активен", "Уволен", "Активен"]
    masked = one(spark, [(True, D(2000, 1, 1)), (False, D(2000, 1, 1)), (None, D(2000, 1, 1))], "a boolean, d date",
                 M.masked_deactivation("d", "a"))
    assert masked == [None, D(2000, 1, 1), D(2000, 1, 1)]
    contract = one(spark, [(None, "Проведен"), (None, "В работе"), ("X", None)], "n string, s string",
                   M.contract_label("n", "s"))
    assert contract == ["Новостройка", "Нет данных", "X"]
    cat = one(spark, [(None,), ("Офис в АРЕНДУ",), ("Квартира",)], "p string", M.deal_category("p"))
    assert cat == [None, "Аренда", "Продажа"]


def test_property_type_branches(spark):
    rows = [
        ("От застройщика", "Риелторское агентство Города", None, None, "p", "o"),
        ("От застройщика", None, None, None, "p", "o"),
        ("От застройщика", "СтройДом", "Коммерция", None, "p", "o"),
        ("Вторичка", None, None, "Промназначения", "p", "o"),
        ("Вторичка", None, None, None, "p", "o"),
        ("Вторичка", None, None, None, None, "o"),
        (None, None, None, None, None, None),
    ]
    schema = "dt string, dev string, bt string, land string, opt string, dot string"
    got = one(spark, rows, schema, M.property_type("dt", "dev", "bt", "land", "opt", "dot"))
    assert got == ["Загородная новостройка", "Новостройка", "Коммерция", "Коммерция", "p", "o", None]
