import json
from datetime import date
from decimal import Decimal

import pytest
from times import utc
from pyspark.sql import functions as F

from pricemart.operators import ingest
from pricemart.sources import feed

LOAD = utc(2024, 6, 1)
FULL = {
    "ticker": "KOBOLD", "date": "2023-11-08", "open": "41.25", "close": "40.875", "high": "41.5", "low": "40", "volume": "73200",
    "split_ratio": "2.0", "ex-dividend": "0.31", "adj_close": "40.5", "adj_open": "2", "adj_high": "3", "adj_low": "4", "adj_volume": "5",
}


@pytest.fixture
def transform(spark):
    def run(*records):
        rows = [("s1", "i1", "p", n, r) for n, r in enumerate(records)]
        schema = "source_id string, instrument_id string, page string, position int, record map<string,string>"
        return ingest.transform_records(spark.createDataFrame(rows, schema), LOAD)

    return run


def test_full_row(transform):
    row = ingest.accepted(transform(FULL)).first()
    assert (row.record_date, row.record_year) == (date(2023, 11, 8), 2023)
    assert (row.open_price, row.close_price, row.volume, row.split_ratio) == (Decimal("41.25"), Decimal("40.875"), 73200, 2)
    assert (row.ex_dividend, row.adj_close, row.low_price) == (Decimal("0.31"), Decimal("40.5"), 40)
    assert row.extra_indicators == {}
    assert row.system_date == row.ingested_at


def test_unknown_fields_are_kept_as_text(transform):
    row = ingest.accepted(transform({"date": "2022-02-01", "close": "7", "mood": "calm", "lot": None, "x y": ""})).first()
    assert row.extra_indicators == {"mood": "calm", "lot": "None", "x y": ""}


@pytest.mark.parametrize("text, value", [
    ("102.30", Decimal("102.3")), (" 7 ", 7), ("1e3", 1000), ("-.5", Decimal("-0.5")), ("5.", 5), ("1_000", 1000),
    ("", None), (" ", None), ("abc", None), (None, None), ("12d", None), ("0x10", None), ("1__0", None), ("1,000", None),
])
def test_decimal_text(spark, text, value):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(ingest.to_decimal(F.col("t"))).first()[0] == value


@pytest.mark.parametrize("text, value", [
    ("12.9", 12), ("-12.9", -12), ("1e3", 1000), ("1500000", 1500000), ("", None), ("x", None), ("nan", None), (None, None),
])
def test_integer_text(spark, text, value):
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(ingest.to_integer(F.col("t"))).first()[0] == value


DATES = [
    "2024-01-15", "20240115", "2024-02-29", "2023-02-29", "2024-13-01", "2024-01", "2024", "", "x", "2024-1-5", "0000-01-01",
    "2024-W03", "2024-W03-2", "2024W032", "2024W03", "2020-W53-5", "2021-W53", "2024-W00", "2024-W03-8", "2024-01-15 ", "0001-W01-1",
]


@pytest.mark.parametrize("text", DATES)
def test_date_text_is_iso(spark, text):
    try:
        wanted = date.fromisoformat(text)
    except ValueError:
        wanted = None
    frame = spark.createDataFrame([(text,)], "t string")
    assert frame.select(ingest.to_date(F.col("t"))).first()[0] == wanted


@pytest.mark.parametrize("change, reason", [
    ({"date": None}, "date must be text"),
    ({"date": "2024-01"}, "Invalid isoformat string: '2024-01'"),
    ({"close": "NaN"}, "close_price is not a finite number"),
    ({"adj_close": "-Infinity"}, "adj_close is not a finite number"),
    ({"open": "1e30"}, "open_price does not fit decimal(38,18)"),
    ({"volume": "inf"}, "volume does not fit a 64-bit integer"),
    ({"volume": "1e19"}, "volume does not fit a 64-bit integer"),
])
def test_rejected_rows(transform, change, reason):
    rows = transform({**FULL, **change})
    assert ingest.accepted(rows).count() == 0
    assert ingest.load_errors(rows).first().error_message == f"Row transform error: {reason}"


def test_bad_number_text_is_null_and_not_rejected(transform):
    row = ingest.accepted(transform({"date": "2024-01-01", "close": "abc", "volume": "nan", "open": ""})).first()
    assert (row.close_price, row.volume, row.open_price) == (None, None, None)


def test_log_counts_and_messages(transform):
    rows = transform(FULL, {"ticker": "KOBOLD"}, {"date": "x"}, {"date": "y"}, {**FULL, "low": "inf"}, {**FULL, "low": "1e40"}, {"date": None})
    log = ingest.load_log(rows, 1200).first()
    assert (log.status, log.fetched, log.record_count, log.skipped, log.log_year, log.duration_ms) == ("success", 7, 1, 6, 2024, 1200)
    assert log.error_message == (
        "1 rows without date; 1 rows with a date that is no text; 2 rows with an unreadable date; "
        "1 rows with a number that does not fit; 1 rows with a number that is not finite")
    assert ingest.job_outcomes(ingest.load_log(rows)).first().status == "failed"
    assert ingest.job_outcomes(ingest.load_log(transform(FULL))).first().status == "completed"


def test_many_rejects_are_whole_in_the_errors(transform):
    rows = transform(*({"date": f"bad{n}"} for n in range(30)), FULL)
    log = ingest.load_log(rows).first()
    assert (log.skipped, log.record_count, log.error_message) == (30, 1, "30 rows with an unreadable date")
    assert sorted(r.position for r in ingest.load_errors(rows).collect()) == list(range(30))


def test_the_last_row_of_a_key_is_stored(transform):
    rows = transform({**FULL, "close": "1"}, FULL, {**FULL, "date": "2023-11-09"}, {**FULL, "close": "3"})
    kept = ingest.last_of_load(ingest.accepted(rows)).orderBy("record_date").collect()
    assert [(r.record_date.day, r.close_price) for r in kept] == [(8, 3), (9, Decimal("40.875"))]


def test_numbers_are_read_once(transform):
    plan = ingest.accepted(transform(FULL))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("AS close_price") + plan.count("close_price,") > 0 and plan.count("decimal(38,18)") < 80


def test_failed_loads(spark, transform):
    failures = spark.createDataFrame([("s2", "i2", LOAD, "API down")], "source_id string, instrument_id string, ingested_at timestamp, error string")
    log = {r.source_id: r for r in ingest.load_log(transform(FULL), failures=failures).collect()}
    assert (log["s2"].status, log["s2"].record_count, log["s2"].error_message) == ("error", 0, "API down")
    assert (log["s1"].status, log["s1"].record_count, log["s1"].error_message) == ("success", 1, None)


def test_observed_columns_include_rejected_rows(spark, transform):
    seen = ingest.observed_columns(transform({"date": "2024-01-01", "b": "1"}, {"a": "x"}))
    assert seen.first().attributes == ["a", "b", "date"]
    sources = spark.createDataFrame([("s1", ["old"]), ("s2", ["kept"])], "source_id string, attributes array<string>")
    got = {r.source_id: r.attributes for r in ingest.with_observed_columns(sources, seen).collect()}
    assert got == {"s1": ["a", "b", "date"], "s2": ["kept"]}


def page(columns, data, cursor=None):
    return json.dumps({"datatable": {"columns": [{"name": c} for c in columns], "data": data}, "meta": {"next_cursor_id": cursor}})


def test_pages_from_files(spark, tmp_path):
    first = page(["date", "close", "close"], [["2024-01-15", 1, 100.0], ["2024-01-16"]], "next")
    second = page(["date", "close"], [["2024-01-17", None, "dropped"], []])
    (tmp_path / "source_id=s1").mkdir()
    (tmp_path / "source_id=s1" / "a.json").write_text(first + "\n" + second + "\n")
    (tmp_path / "source_id=s1" / "b.json").write_text('{"meta": {}}\n')
    rows = feed.page_records(feed.read_pages(spark, str(tmp_path))).collect()
    got = sorted((sorted(r.record.items(), key=str) for r in rows), key=str)
    assert got == sorted([
        [("close", "100.0"), ("date", "2024-01-15")], [("date", "2024-01-16")], [("close", None), ("date", "2024-01-17")], [],
    ], key=str)
    assert {r.source_id for r in rows} == {"s1"}
