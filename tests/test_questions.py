import json
import random
from decimal import Decimal

import pytest

from pricemart.functions.automaton import Automaton, parts
from pricemart.operators import metrics
from pricemart.operators import questions as ops

LISTING = [("QZ", "1", 0), ("kobold", "2", 1), ("ZZORB", "3", 2), ("", "4", 3), ("qz", "7", 4), ("7", "8", 5), ("zzo", "9", 6)]
ASKED = [
    (1, "Has Kobold fallen since May?"), (2, "tell me about qz"), (3, "is kobold ahead of QZ"),
    (4, "any news at all"), (5, None), (6, "unzzorbed"), (7, ""), (8, "y" * 5000 + "ZzOrB"), (9, "pizzo"), (10, "7"),
]


@pytest.fixture
def dictionary(spark):
    return ops.symbol_dictionary(spark.createDataFrame(LISTING, "symbol string, instrument_id string, position int"))


def test_dictionary_keeps_first_place_and_last_id(dictionary):
    assert sorted(tuple(r) for r in dictionary.collect()) == [
        ("7", "8", 5), ("KOBOLD", "2", 1), ("QZ", "7", 0), ("ZZO", "9", 6), ("ZZORB", "3", 2)]


#: In one automaton, in one for each symbol, and joined.
WAYS = [{}, {"cells": 1}, {"driver_chars": 0}]


@pytest.mark.parametrize("way", WAYS)
def test_first_symbol(spark, dictionary, way):
    """The first listed symbol found anywhere in the text."""
    asked = spark.createDataFrame(ASKED, "q int, user_prompt string")
    got = {r.q: r.instrument_id for r in ops.first_symbol(asked, dictionary, ["q"], **way).collect()}
    assert got == {1: "2", 2: "7", 3: "7", 4: None, 5: None, 6: "3", 7: None, 8: "3", 9: "9", 10: "8"}


def test_symbols_of_one_stem_and_long_texts(spark):
    rng = random.Random(4)
    symbols = ["SAME" + "".join(rng.choice("ABC") for _ in range(rng.randrange(1, 9))) for _ in range(300)]
    listing = [(s, n, n) for n, s in enumerate(dict.fromkeys(symbols))]
    texts = ["".join(rng.choice("SAMEABC") for _ in range(n)) for n in (0, 1, 40, 3000)]
    texts += [("q" * 255 + listing[n][0] + "z") * 2 for n in (5, 77)] + ["same" * 400 + listing[9][0].lower()]
    asked = spark.createDataFrame(list(enumerate(texts)), "q int, user_prompt string")
    frame = spark.createDataFrame(listing, "symbol string, instrument_id long, position long")
    for way in WAYS[::2]:
        got = {r.q: r.symbol for r in ops.first_symbol(asked, frame, ["q"], **way).collect()}
        assert got == {n: next((s for s, _, _ in listing if s in t.upper()), None) for n, t in enumerate(texts)}


@pytest.mark.parametrize("seed", range(8))
def test_automaton_against_brute_force(seed):
    rng = random.Random(seed)
    words = list(dict.fromkeys("".join(rng.choice("abé𝒳") for _ in range(rng.randrange(1, 6))) for _ in range(25)))
    texts = [None, "", "zzz"] + ["".join(rng.choice("abé𝒳z") for _ in range(rng.randrange(1, 700))) for _ in range(30)]
    expected = [next((n for n, w in enumerate(words) if w in (t or "")), len(words)) for t in texts]
    assert Automaton(words).first_words(texts).tolist() == expected
    groups = parts(words, 60)
    assert sorted(n for g in groups for n in g) == list(range(len(words))) and len(groups) > 1
    assert all(Automaton([words[n] for n in g]).next.size <= 60 for g in groups if len(g) > 1)


def test_first_symbol_of_repeated_and_null_keys(spark, dictionary):
    asked = spark.createDataFrame([(1, "kobold?"), (1, "qz again"), (None, "zzorb"), (None, "none")], "q int, user_prompt string")
    got = sorted((str(r.q), str(r.symbol)) for r in ops.first_symbol(asked, dictionary, ["q"]).collect())
    assert got == [("1", "KOBOLD"), ("1", "QZ"), ("None", "None"), ("None", "ZZORB")]


def test_first_symbol_with_empty_dictionary(spark, dictionary):
    asked = spark.createDataFrame(ASKED, "q int, user_prompt string")
    got = ops.first_symbol(asked, dictionary.where("false"), ["q"])
    assert got.count() == len(ASKED) and got.where("instrument_id is not null").isEmpty()


@pytest.mark.parametrize("text, wanted", [
    ("What is the Average Close of X?", {"needs_source", "wants_analytics"}),
    ("Explain a change in price", {"wants_trend"}),
    ("Forecast the next day", {"needs_source", "wants_forecast"}),
    ("risk and drawdown", {"needs_source", "wants_risk"}),
    ("Compare A and B", {"needs_source", "wants_compare"}),
    ("hello", set()),
    (None, set()),
])
def test_intents(spark, text, wanted):
    row = ops.intents(spark.createDataFrame([(text,)], "user_prompt string")).first()
    assert {name for name in ops.INTENTS if row[name]} == wanted


def test_fact_sheets_and_flags(prices):
    report = metrics.metrics_report(prices(
        {"close_price": Decimal("100"), "volume": 10}, {"close_price": Decimal("150.50"), "volume": 5},
        {"instrument_id": "one", "close_price": Decimal("7")}, {"instrument_id": "none"},
    ))
    runs = {(r.instrument_id, r.name): r for r in ops.fact_sheets(report).collect()}
    assert json.loads(runs["i1", "get_analytics"].raw) == {
        "count": 2, "min_close": "100", "max_close": "150.5", "avg_close": "125.25", "total_volume": 15,
    }
    assert json.loads(runs["i1", "get_trend"].raw)["change"] == "50.5"
    assert json.loads(runs["i1", "get_forecast"].raw) == {"method": "naive_last_close", "predicted_next_close": "150.5"}
    assert json.loads(runs["one", "get_risk_signal"].raw)["signal"] == "insufficient_data"
    flags = {r.instrument_id: r for r in ops.insufficient_flags(report).collect()}
    assert (flags["one"].trend, flags["one"].analytics, flags["one"].forecast) == (ops.NO_TREND, None, None)
    assert (flags["none"].analytics, flags["none"].forecast, flags["none"].risk_signal) == (
        ops.NO_ANALYTICS, ops.NO_FORECAST, ops.NO_RISK,
    )
    assert runs["none", "get_forecast"].error == ops.NO_FORECAST and runs["i1", "get_trend"].error is None


def reports(spark, *runs):
    frame = spark.createDataFrame(runs, "k string, seq int, name string, raw string, error string")
    return {r.k: r.report for r in ops.grounded_reports(frame, ["k"]).collect()}


def test_report_text(spark):
    listed = json.dumps([{"instrument_id": str(n), "symbol": f"S{n}"} for n in range(7)])
    got = reports(
        spark,
        ("a", 0, "list_instruments", listed, None),
        ("a", 1, "list_sources", "[]", None),
        ("a", 2, "get_analytics", '{"count": 1}', None),
        ("a", 3, "get_analytics", '{"count": 10, "min_close": "1", "max_close": null, "avg_close": "1.5", "total_volume": 100}', None),
        ("a", 4, "get_time_series", '[{"date": "x"}, {"date": "y"}]', None),
        ("a", 5, "get_trend", "{}", "Insufficient data"),
        ("a", 6, "get_forecast", '{"method": "m",\n "predicted_next_close": "' + "9" * 300 + '"}', None),
    )["a"].split("\n")
    assert got[0] == "Found 7 instruments in the warehouse."
    assert got[1] == "Sample instruments: S0 (0), S1 (1), S2 (2), S3 (3), S4 (4)."
    assert got[2] == "Analytics summary: count=10, min_close=1, max_close=None, avg_close=1.5, total_volume=100."
    assert got[3].startswith("Forecast summary: method=m, predicted_next_close=999")
    assert got[4] == "Fetched 2 time-series rows."
    assert got[5] == "Some tool calls failed and were ignored for the final summary."
    assert got[6:8] == ["", "Grounding evidence:"]
    assert [line.split(":")[0] for line in got[8:]] == ["- get_analytics", "- get_analytics", "- get_time_series", "- get_forecast"]
    shown = got[-1].removeprefix("- get_forecast: ")
    assert len(shown) == 220 and shown.endswith("9...")


def test_report_without_results(spark):
    got = reports(
        spark, ("bad", 0, "get_trend", "{}", "down"), ("other", 0, "list_sources", "[]", None), ("empty", 0, "list_instruments", "[]", None),
    )
    assert got["bad"] == "I could not produce a grounded answer because all tool calls failed."
    assert got["other"].startswith("Tool calls completed, but no usable payload was returned.\n\nGrounding evidence:\n- list_sources: []")
    assert got["empty"].startswith("Found 0 instruments in the warehouse.\n\nGrounding")


def test_question_log(spark):
    answers = spark.createDataFrame([("s", ["a", "b"]), ("t", [])], "session_id string, tools array<string>")
    log = ops.question_log_rows(answers)
    assert {r.session_id: r.tools_invoked for r in log.collect()} == {"s": "a, b", "t": None}
    assert {r.tool: r.uses for r in ops.tool_usage(log).collect()} == {"a": 1, "b": 1}


def test_documents(spark):
    current = spark.createDataFrame(
        [("1", "AAPL", "stock", "Apple", None, "USD")],
        "instrument_id string, symbol string, instrument_class string, name string, region string, currency string",
    )
    assert json.loads(ops.instrument_listing(current).first().raw) == {
        "instrument_id": "1", "symbol": "AAPL", "name": "Apple", "class": "stock", "region": None,
    }
    assert json.loads(ops.instrument_details(current).first().raw)["currency"] == "USD"
    sources = spark.createDataFrame([("s", "NASDAQ", "rest")], "source_id string, source_name string, source_type string")
    assert json.loads(ops.source_listing(sources).first().raw) == {"source_id": "s", "name": "NASDAQ", "type": "rest"}
