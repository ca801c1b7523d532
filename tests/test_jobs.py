import json
import uuid
from datetime import date, timedelta
from decimal import Decimal

import pytest
from times import utc
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from pricemart.functions.text import is_uuid, stable_id
from pricemart.operators import audit
from pricemart.plans import jobs
from pricemart.sources import tables
from pricemart.streaming.feed_stream import start_feed_load
from pricemart.streaming.job_stream import current_job_states, start_job_states


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "warehouse")


def test_rolling_job_can_run_again(spark, root, prices):
    tables.append(prices(*({"close_price": Decimal(n)} for n in range(1, 6)), {"instrument_id": "b", "close_price": Decimal(9)}), root, "prices")
    assert jobs.rolling_average_job(spark, root, 3) == 6
    assert jobs.rolling_average_job(spark, root, 3, jobs.PriceRange(instrument_id="b")) == 1
    assert jobs.rolling_average_job(spark, root, 2, jobs.PriceRange(start_date=date(2024, 1, 3))) == 4
    rows = tables.scan(spark, root, "rolling_averages")
    assert {(r.window_days, r["count"]) for r in rows.groupBy("window_days").count().collect()} == {(3, 6), (2, 4)}


def walk(prices, name="i1", n=30):
    return prices(*(
        {"instrument_id": name, "close_price": Decimal(100 + (k * 37) % 11), "volume": k * k % 7, "record_date": date(2024, 1, 1) + timedelta(days=k)}
        for k in range(n)
    ))


def test_regression_jobs(spark, root, prices, tmp_path):
    tables.append(walk(prices).unionByName(walk(prices, "short", 6)), root, "prices")
    path = str(tmp_path / "model")
    part = jobs.PriceRange(instrument_id="i1", source_id="s1")
    result = jobs.series_regression_job(spark, root, part, path)
    assert result["training_rows"] == 26 and result["last_record_date"] == date(2024, 1, 30)
    assert len(LinearRegressionModel.load(path).coefficients) == 6
    jobs.series_regression_job(spark, root, part, path, write_prediction=False)
    with pytest.raises(Exception, match="already exists"):
        jobs.series_regression_job(spark, root, part, path, overwrite_model=False)
    with pytest.raises(ValueError):
        jobs.series_regression_job(spark, root, jobs.PriceRange(), path)
    run_id = jobs.all_series_regression_job(spark, root)
    predictions = {r.model_run_id: r for r in tables.scan(spark, root, "price_predictions").collect()}
    assert len(predictions) == 2
    assert predictions[run_id].predicted_next_close == pytest.approx(result["predicted_next_close"], rel=1e-6)


def page(rows):
    columns = ["ticker", "date", "close", "volume", "note"]
    return json.dumps({"datatable": {"columns": [{"name": c} for c in columns], "data": rows}, "meta": {"next_cursor_id": None}})


def land(folder, name, rows):
    target = folder / "source_id=s1"
    target.mkdir(parents=True, exist_ok=True)
    (target / name).write_text(page(rows) + "\n")


def test_feed_stream_is_incremental(spark, root, tmp_path):
    landed, state = tmp_path / "landed", str(tmp_path / "state")
    source = spark.createDataFrame([("s1", "NASDAQ", "rest")], "source_id string, source_name string, source_type string")
    tables.append(source, root, "data_sources")
    land(landed, "a.json", [["AAPL", "2024-01-15", "100.0", "5", "x"], ["AAPL", "bad", "1", "1", None]])
    start_feed_load(spark, str(landed), root, state).awaitTermination()
    land(landed, "b.json", [["AAPL", "2024-01-16", "101.0", "6", "y"], ["MSFT", "2024-01-16", "50", "1", "z"], [None, "2024-01-17"]])
    start_feed_load(spark, str(landed), root, state).awaitTermination()

    symbols = {r.symbol: r.instrument_id for r in tables.scan(spark, root, "financial_instruments").collect()}
    assert set(symbols) == {"AAPL", "MSFT"}
    loaded = tables.scan(spark, root, "prices").collect()
    assert sorted((r.instrument_id == symbols["AAPL"], r.record_date.day, float(r.close_price)) for r in loaded) == [
        (False, 16, 50.0), (True, 15, 100.0), (True, 16, 101.0),
    ]
    assert {r.extra_indicators["note"] for r in loaded} == {"x", "y", "z"}
    errors = spark.read.parquet(tables.table_path(root, "load_errors")).collect()
    assert sorted(e.error_message for e in errors) == [
        "Row transform error: Invalid isoformat string: 'bad'", "Row transform error: Row names no known instrument",
    ]
    assert tables.scan(spark, root, "data_sources").first().attributes == ["close", "date", "note", "ticker", "volume"]
    log = tables.scan(spark, root, "ingest_log")
    assert log.agg(F.sum("record_count")).first()[0] == 3
    assert log.where("status <> 'success'").isEmpty()


def test_a_load_with_broken_pages_of_a_new_source(spark, root, tmp_path):
    landed = tmp_path / "landed"
    land(landed, "a.json", [["KOBOLD", "2024-02-01", "9.5", "5", "x"], ["KOBOLD", "2024-02-01", "9.75", "6", "y"]])
    (landed / "source_id=s1" / "b.json").write_text('{"datatable": {"columns": [{"na\n{"error": {"code": 7}}\n')
    start_feed_load(spark, str(landed), root, str(tmp_path / "state")).awaitTermination()
    assert [float(r.close_price) for r in tables.scan(spark, root, "prices").collect()] == [9.75]
    log = {r.status: r for r in tables.scan(spark, root, "ingest_log").collect()}
    assert (log["error"].error_message, log["error"].record_count) == ("2 pages could not be read", 0)
    assert (log["success"].record_count, log["success"].error_message) == (2, None)
    source = tables.scan(spark, root, "data_sources").first()
    assert (source.source_id, source.source_name, source.attributes) == ("s1", "s1", ["close", "date", "note", "ticker", "volume"])
    assert sorted(r.status for r in current_job_states(spark, root).collect()) == ["completed", "failed"]


EVENTS = [
    ("j1", "AAPL", "W", "queued", utc(2024, 1, 1), None, None),
    ("j1", "AAPL", "W", "running", utc(2024, 1, 1, 1), None, None),
    ("j2", "MSFT", "W", "queued", utc(2024, 1, 1), None, None),
    ("j1", "AAPL", "W", "completed", utc(2024, 1, 1, 2), 100, None),
    ("j2", "MSFT", "W", "running", utc(2024, 1, 1, 3), None, None),
    ("j2", "MSFT", "W", "failed", utc(2024, 1, 1, 4), 3, "boom"),
]
EVENT_SCHEMA = "job_id string, symbol string, datatable_code string, status string, event_time timestamp, record_count int, error_message string"


def states(frame):
    return {r.job_id: r for r in frame.collect()}


def test_job_states(spark):
    got = states(audit.job_states(spark.createDataFrame(EVENTS, EVENT_SCHEMA)))
    assert (got["j1"].status, got["j1"].record_count) == ("completed", 100)
    assert (got["j2"].status, got["j2"].error_message) == ("failed", "boom")
    assert got["j1"].queued_at < got["j1"].started_at < got["j1"].completed_at
    running = states(audit.job_states(spark.createDataFrame(EVENTS[:2], EVENT_SCHEMA)))["j1"]
    assert (running.status, running.completed_at) == ("running", None)


def test_job_stream_equals_batch(spark, root, tmp_path):
    landed, state = str(tmp_path / "landed"), str(tmp_path / "state")
    for part in (EVENTS[:3], EVENTS[3:]):
        spark.createDataFrame(part, EVENT_SCHEMA).write.mode("append").json(landed)
        start_job_states(spark, landed, root, state).awaitTermination()
    columns = ["job_id", "symbol", "status", "queued_at", "started_at", "completed_at", "record_count", "error_message"]
    streamed = current_job_states(spark, root).select(*columns)
    batch = audit.job_states(spark.createDataFrame(EVENTS, EVENT_SCHEMA)).select(*columns)
    assert sorted(streamed.collect()) == sorted(batch.collect())


def test_recent_log(spark):
    rows = [("s", 2024, utc(2024, m, 1), f"l{m}") for m in range(1, 8)] + [("s", 2023, utc(2023, 1, 1), "old"), ("t", 2024, utc(2024, 1, 1), "t1")]
    log = spark.createDataFrame(rows, "source_id string, log_year int, ingested_at timestamp, log_id string")
    assert [r.log_id for r in audit.recent_load_log(log, "s", 2, 2024).collect()] == ["l7", "l6"]
    assert sorted(r.log_id for r in audit.recent_load_log_per_source(log, 2, 2024).collect()) == ["l6", "l7", "t1"]
    assert audit.recent_load_log(log, "s").count() == 0, "the current year has no rows here"


def test_ids(spark):
    frame = spark.createDataFrame([("a", None), (None, "a")], "x string, y string")
    ids = [r[0] for r in frame.select(stable_id(F.col("x"), F.col("y"))).collect()]
    assert len(set(ids)) == 2
    assert frame.select(is_uuid(stable_id(F.col("x"), F.col("y"))).alias("ok")).where("not ok").isEmpty()
    texts = [
        "nope", "", "123e4567-e89b-12d3-a456-42661417400", "123E4567-E89B-12D3-A456-426614174000",
        "{123e4567-e89b-12d3-a456-426614174000}", "urn:uuid:123e4567-e89b-12d3-a456-426614174000", "0" * 32, "g" * 32,
    ]

    def valid(text):
        try:
            uuid.UUID(text)
        except ValueError:
            return False
        return True

    rows = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    assert [r[0] for r in rows.select(is_uuid(F.col("t"))).collect()] == [*map(valid, texts), False]
