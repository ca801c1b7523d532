"""Questions to log rows: the plan of what is asked (again), reports, and log rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricemart.operators import answers
from pricemart.operators import questions as ops

LISTING = [("i1", "AAA", 0), ("i2", "BBB", 1), ("i3", "CCC", 2)]


@pytest.fixture
def listing(spark):
    rows = spark.createDataFrame(LISTING, "instrument_id string, symbol string, position long")
    return rows.withColumns({"name": F.col("symbol"), "instrument_class": F.lit("stock"), "region": F.lit("US")})


@pytest.fixture
def sources(spark):
    return spark.createDataFrame([("s1", "one", "rest"), ("s2", "two", "rest")], "source_id string, source_name string, source_type string")


@pytest.fixture
def history(prices):
    return prices(
        {"instrument_id": "i2", "close_price": Decimal(100), "volume": 5}, {"instrument_id": "i2", "close_price": Decimal(120)},
        {"instrument_id": "i1", "close_price": Decimal(10)},
    )


def asked(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "q int, user_prompt string")


RUNS = "q int, seq int, name string, raw string, error string"


@pytest.mark.parametrize("text, earlier, instruments, planned", [
    ("average close and trend", [], 2, ["get_analytics", "get_trend"]),
    ("average close and trend", [("get_trend", None)], 2, ["get_analytics"]),
    ("trend", [("get_trend", "too little")], 2, ["get_trend"]),
    ("trend", [("get_trend", "too little"), ("get_trend", None)], 2, []),
    ("compare them", [], 1, []),
    ("compare them", [], 2, ["compare_assets"]),
    ("predict risk", [("get_analytics", None)], 2, ["get_forecast", "get_risk_signal"]),
    ("hello", [], 2, []),
    (None, [], 2, []),
])
def test_retry_plan(spark, text, earlier, instruments, planned):
    runs = spark.createDataFrame([(0, n, name, "{}", error) for n, (name, error) in enumerate(earlier)], RUNS)
    (row,) = answers.retry_plan(ops.intents(asked(spark, text)), runs, ["q"], instruments).collect()
    assert row.requests == planned


def test_answers(spark, listing, sources, history):
    texts = ["what is the trend of bbb?", "average close please", "risk of CCC", "compare BBB with the rest", "hello"]
    log = answers.answer_questions(asked(spark, *texts), listing, sources, history, ["q"])
    rows = {r.q: r for r in log.collect()}
    assert log.columns == ["q", "user_prompt", "llm_response", "tools_invoked"] and len(rows) == 5
    lists = "list_instruments, list_sources"
    assert [rows[n].tools_invoked for n in range(5)] == [
        f"{lists}, get_trend", f"{lists}, get_analytics", f"{lists}, get_risk_signal", f"{lists}, compare_assets", lists]
    assert all(r.llm_response.startswith("Found 3 instruments in the warehouse.\nSample instruments: AAA (i1), BBB (i2), CCC (i3).\n")
               for r in rows.values())
    assert "Trend summary: direction=up, change=20, change_pct=20." in rows[0].llm_response
    assert "Analytics summary: count=1, min_close=10, max_close=10, avg_close=10, total_volume=0." in rows[1].llm_response
    # nothing is known of CCC: the failed run is mentioned and shows no sentence
    assert ops.SOME_FAILED in rows[2].llm_response and "Risk summary" not in rows[2].llm_response
    assert ("Comparison summary: instrument_a_count=2, instrument_b_count=2, instrument_a_avg_close=110, instrument_b_avg_close=110, "
            "avg_close_diff=0.") in rows[3].llm_response
    assert '- list_sources: [{"source_id":"s1","name":"one","type":"rest"},{"source_id":"s2","name":"two","type":"rest"}]' in rows[4].llm_response


def test_earlier_runs_are_kept_and_not_repeated(spark, listing, sources, history):
    earlier = spark.createDataFrame([
        (0, 0, "get_trend", '{"direction":"down","change":"-1","change_pct":null}', None),
        (1, 0, "get_trend", '{"direction":"flat"}', ops.NO_TREND),
    ], RUNS)
    log = answers.answer_questions(asked(spark, "trend of bbb", "trend of bbb"), listing, sources, history, ["q"], earlier)
    rows = {r.q: r for r in log.collect()}
    assert rows[0].tools_invoked == "list_instruments, list_sources, get_trend"
    assert "direction=down, change=-1, change_pct=None." in rows[0].llm_response
    assert rows[1].tools_invoked == "list_instruments, list_sources, get_trend, get_trend"
    assert "direction=up" in rows[1].llm_response and ops.SOME_FAILED in rows[1].llm_response


def test_long_lists_are_counted_whole(spark, sources, history):
    many = spark.range(300).selectExpr("concat('i', id) AS instrument_id", "concat('S', id) AS symbol", "id AS position",
                                       "'n' AS name", "'stock' AS instrument_class", "'US' AS region")
    (row,) = answers.answer_questions(asked(spark, "hi"), many, sources, history, ["q"]).collect()
    assert row.llm_response.startswith("Found 300 instruments in the warehouse.\nSample instruments: S0 (i0), S1 (i1), S2 (i2), S3 (i3), S4 (i4).")


def test_no_questions_and_empty_lists(spark, listing, sources, history):
    assert answers.answer_questions(asked(spark, "x").where("false"), listing, sources, history, ["q"]).count() == 0
    (row,) = answers.answer_questions(asked(spark, "trend"), listing.where("false"), sources.where("false"), history, ["q"]).collect()
    assert row.llm_response.startswith("Found 0 instruments in the warehouse.")
