"""Staging ingest: typed rows, quarantine and ledger; deliveries that come twice or are cut off."""

import datetime as dt
import decimal
import os

import pytest
from pyspark.sql import types as T

from salesmart.sources.ingest import IngestTable, Landed, ingest

SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("day", T.DateType()),
    T.StructField("income", T.DecimalType(18, 2)), T.StructField("is_active", T.BooleanType()),
    T.StructField("rate", T.DoubleType())])
JSON = Landed(SCHEMA, required=("id", "day"))

GOOD = [
    '{"id":1,"name":"a","day":"2000-01-31","income":12.5,"is_active":true,"rate":0.25}',
    '{"id":1152921504606846977,"day":"2000-02-29","income":1234567890123456.78,"name":"two, \\"x\\""}',
    '{"day":"2000-03-01","id":3,"income":"7.00","unknown":1}',
    '  {"id":-4,"day":"1999-12-31","income":null,"name":""}  ',
]
BAD = [
    ('{"id":5,"day":"2000-01', "malformed"), ("not json", "malformed"), ("[1,2]", "malformed"), ("17", "malformed"),
    ('{"id":"x5","day":"2000-01-01"}', "bad type: id"), ('{"id":1.5,"day":"2000-01-01"}', "bad type: id"),
    ('{"id":6,"day":"2000-02-30","income":"a"}', "bad type: day, income"),
    ('{"id":7,"day":"2000-01-01","income":1.005}', "bad type: income"),
    ('{"id":99999999999999999999,"day":"2000-01-01"}', "bad type: id"),
    ('{"id":8,"day":"2000-01-01","is_active":"maybe"}', "bad type: is_active"),
    ('{"day":"2000-01-01"}', "missing: id"), ('{"name":"z"}', "missing: id, day"),
]


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


def test_rows_are_typed_or_quarantined_with_a_reason(spark, scratch):
    put(scratch, "a.json", [*GOOD, "", "   ", *[line for line, _ in BAD]])
    got = ingest(spark, scratch, JSON)
    assert got.accepted.schema == SCHEMA
    rows = {r.id: r for r in got.accepted.collect()}
    assert set(rows) == {1, (1 << 60) + 1, 3, -4}
    assert rows[1].day == dt.date(2000, 1, 31) and rows[1].is_active is True and rows[1].rate == 0.25
    assert rows[(1 << 60) + 1].income == decimal.Decimal("1234567890123456.78"), "money does not pass through doubles"
    assert rows[(1 << 60) + 1].name == 'two, "x"' and rows[3].income == decimal.Decimal("7.00") and rows[-4].name == ""
    assert sorted((r.raw_line, r.reason) for r in got.quarantine.collect()) == sorted(BAD)
    ledger = got.ledger.collect()
    assert [(r.lines, r.accepted, r.quarantined, r.status) for r in ledger] == [(16, 4, 12, "loaded")]


def test_csv_files_with_headers(spark, scratch):
    head = ",".join(SCHEMA.names)
    put(scratch, "a.csv", [head, '1,"a, b",2000-01-31,12.50,true,1e3', "2,,2000-02-01,,,", "3,x,2000-02-01"])
    put(scratch, "b.csv", [head, "x,y,2000-01-01,1,false,2", "4,y,,1,false,2"])
    got = ingest(spark, scratch, Landed(SCHEMA, required=("id", "day"), fmt="csv"))
    rows = {r.id: r for r in got.accepted.collect()}
    assert set(rows) == {1, 2} and rows[1].name == "a, b" and rows[1].rate == 1000.0 and rows[2].income is None
    assert {r.raw_line: r.reason for r in got.quarantine.collect()} == {
        "3,x,2000-02-01": "malformed", "x,y,2000-01-01,1,false,2": "bad type: id", "4,y,,1,false,2": "missing: day"}


def test_a_file_delivered_twice_counts_once(spark, scratch):
    put(f"{scratch}/in/1", "a.json", GOOD[:2] + GOOD[:1])   # equal lines within a file are rows of their own
    put(f"{scratch}/in/2", "b.json", GOOD[:1] + GOOD[:2])   # the same content in another order and under another name
    put(f"{scratch}/in/3", "c.json", GOOD[:2])              # other content
    got = ingest(spark, f"{scratch}/in", JSON)
    assert got.accepted.count() == 5
    assert sorted(r.status for r in got.ledger.collect()) == ["loaded", "loaded", "repeated"]


def test_deliveries_add_up_and_repeat_without_effect(spark, scratch):
    table = IngestTable(f"{scratch}/staging", JSON)
    assert table.rows(spark).count() == 0 and table.rows(spark).schema == SCHEMA
    put(f"{scratch}/in", "a.json", GOOD[:2] + [BAD[0][0]])
    assert table.deliver(spark, f"{scratch}/in") == {"files": 1, "repeated": 0, "accepted": 2, "quarantined": 1}
    assert table.deliver(spark, f"{scratch}/in")["files"] == 0
    put(f"{scratch}/in", "b.json", GOOD[2:])
    put(f"{scratch}/in", "again.json", GOOD[:2] + [BAD[0][0]])
    assert table.deliver(spark, f"{scratch}/in") == {"files": 2, "repeated": 1, "accepted": 2, "quarantined": 0}
    assert sorted(r.id for r in table.rows(spark).collect()) == sorted([1, (1 << 60) + 1, 3, -4])
    assert table.quarantine(spark).count() == 1
    assert sorted(r.status for r in table.ledger(spark).collect()) == ["loaded", "loaded", "repeated"]


def test_a_delivery_that_was_cut_off_is_written_again_whole(spark, scratch, monkeypatch):
    """The ledger is written last: rows of a cut-off delivery are overwritten, not added to."""
    table = IngestTable(f"{scratch}/staging", JSON)
    put(f"{scratch}/in", "a.json", [*GOOD, BAD[0][0]])
    from salesmart.sources import ingest as module
    real, calls = module.checked, []

    def failing(lines, landed):
        calls.append(1)
        rows = real(lines, landed)
        return rows if len(calls) < 2 else rows.where("raise_error('executor lost') IS NULL")
    monkeypatch.setattr(module, "checked", failing)
    with pytest.raises(Exception, match="executor lost"):
        table.deliver(spark, f"{scratch}/in")
    monkeypatch.setattr(module, "checked", real)
    assert table.ledger(spark).count() == 0
    assert table.deliver(spark, f"{scratch}/in")["accepted"] == 4
    assert table.rows(spark).count() == 4 and table.quarantine(spark).count() == 1


def test_empty_folder_and_wrong_settings(spark, scratch):
    put(scratch, "empty.json", [""])
    got = ingest(spark, scratch, JSON)
    assert got.accepted.count() == got.quarantine.count() == got.ledger.count() == 0
    assert IngestTable(f"{scratch}/t", JSON).deliver(spark, scratch)["files"] == 0
    with pytest.raises(ValueError, match="format"):
        Landed(SCHEMA, fmt="xml")
    with pytest.raises(ValueError, match="lacks"):
        Landed(SCHEMA, required=("other",))


def test_a_line_is_parsed_once_for_all_its_columns(spark, scratch):
    """A test of the reason pushed below the parsed columns would hold the parser once for each use of a column."""
    put(scratch, "a.json", [*GOOD, BAD[0][0]])
    got = ingest(spark, scratch, JSON)
    for rows in (got.accepted, got.quarantine):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert 1 <= plan.count("from_json") <= 4, "the texts (whether they are whole, and what they are) and exact decimals"


def test_a_delivery_parses_its_lines_in_one_job(spark, scratch, monkeypatch):
    """Each line passes the parser once, whatever is stored of it: the rows are counted by an accumulator above it."""
    from pyspark.sql import functions as F

    from salesmart.sources import ingest as module
    put(f"{scratch}/in", "a.json", [*GOOD, BAD[0][0]])
    seen, real = spark.sparkContext.accumulator(0), module.checked

    @F.udf("boolean")
    def passes(_line):
        seen.add(1)
        return True
    monkeypatch.setattr(module, "checked", lambda lines, landed: real(lines.where(passes.asNondeterministic()("raw_line")), landed))
    table = IngestTable(f"{scratch}/staging", JSON)
    assert table.deliver(spark, f"{scratch}/in") == {"files": 1, "repeated": 0, "accepted": 4, "quarantined": 1}
    assert seen.value == len(GOOD) + 1
    assert table.rows(spark).count() == 4 and [r.reason for r in table.quarantine(spark).collect()] == ["malformed"]
    assert os.listdir(f"{scratch}/staging/_pending") == []
