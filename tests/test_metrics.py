from datetime import date
from decimal import Decimal

import pytest
from times import utc

from pricemart.operators import metrics

D = Decimal


def closes(*values, **more):
    return [{"close_price": None if v is None else D(str(v)), **more} for v in values]


def one(frame):
    (row,) = frame.collect()
    return row


def test_aggregates_of_three_points(prices):
    rows = prices(
        {"close_price": D("100"), "volume": 1000}, {"close_price": D("200"), "volume": 2000},
        {"close_price": D("150"), "volume": 500},
    )
    got = one(metrics.aggregates(rows))
    assert (got["count"], got.min_close, got.max_close, got.avg_close, got.total_volume) == (3, 100, 200, 150, 3500)


def test_aggregates_count_rows_without_close(prices):
    got = one(metrics.aggregates(prices({"volume": 500}, {"close_price": D("100"), "volume": 500})))
    assert (got["count"], got.min_close, got.max_close, got.total_volume) == (2, 100, 100, 1000)


def test_aggregates_of_requested_series_without_rows(prices):
    rows = prices({"close_price": D("1")})
    got = one(metrics.aggregates(rows.where("false"), requested=rows))
    assert (got["count"], got.min_close, got.avg_close, got.total_volume) == (0, None, None, 0)


def test_trend(prices):
    got = one(metrics.trend(prices(*closes(100, 110, 120))))
    assert (got.direction, got.start_close, got.end_close, got.change) == ("up", 100, 120, 20)
    assert got.change_pct == pytest.approx(20)


def test_trend_from_zero_has_no_percentage(prices):
    got = one(metrics.trend(prices(*closes(0, 5))))
    assert (got.direction, got.change, got.change_pct) == ("up", 5, None)


def test_trend_of_one_close_is_flat_and_empty(prices):
    got = one(metrics.trend(prices(*closes(5, None))))
    assert (got.direction, got.start_close, got.change) == ("flat", None, None)


def test_versions_of_a_day_count_newest_first(prices):
    """The last close of a day with several versions is its oldest version."""
    day = {"record_date": date(2024, 1, 2)}
    rows = prices(
        {"close_price": D("10"), "record_date": date(2024, 1, 1)},
        {"close_price": D("20"), "system_date": utc(2024, 6, 1), **day},
        {"close_price": D("30"), "system_date": utc(2024, 6, 2), **day},
    )
    assert one(metrics.forecast(rows)).predicted_next_close == 20
    assert one(metrics.forecast(rows, "latest")).predicted_next_close == 30
    assert one(metrics.aggregates(rows, "latest"))["count"] == 2


def test_forecast_is_last_close(prices):
    got = one(metrics.forecast(prices(*closes("101.0", "103.5", None))))
    assert (got.method, got.predicted_next_close) == ("naive_last_close", D("103.5"))


@pytest.mark.parametrize("values, signal, volatility, drawdown", [
    ((100, 80), "high", 20, 20),
    ((100, 101), "medium", 1, 0),
    ((100, 103), "high", 3, 0),
    ((100, "100.5", 100), "low", None, None),
    ((10, 10, 10), "low", 0, 0),
    (("33", "31.35", "31.35", "31.35", "31.35", "31.35", "31.35", "31.35"), "medium", None, 5),
    ((0, 0), "low", None, 0),
    ((0, 5, 4), "high", 20, 20),
    ((7,), "insufficient_data", None, None),
])
def test_risk_classes(prices, values, signal, volatility, drawdown):
    got = one(metrics.risk_signal(prices(*closes(*values))))
    assert got.signal == signal
    if volatility is not None:
        assert got.volatility_pct == pytest.approx(volatility)
    if drawdown is not None:
        assert got.max_drawdown_pct == pytest.approx(drawdown)


def test_risk_summary_text(prices):
    assert one(metrics.risk_signal(prices(*closes(100, 80)))).summary == (
        "Risk is high (volatility=20.00%, max_drawdown=20.00%)."
    )
    assert one(metrics.risk_signal(prices(*closes(7)))).summary == (
        "Need at least two close values to estimate risk."
    )
    # halves go to the even digit
    assert "volatility=0.12%" in one(metrics.risk_signal(prices(*closes(800, 801)))).summary


def test_negative_closes_follow_the_running_peak(prices):
    values = [-5, -10, 4, -2, 8, -16]
    peak, worst = values[0], 0.0
    for value in values[1:]:
        peak = max(peak, value)
        worst = max(worst, (peak - value) / peak * 100)
    for max_rows in (1, 2, 100):
        got = one(metrics.risk_signal(prices(*closes(*values)), max_rows=max_rows))
        assert got.max_drawdown_pct == pytest.approx(worst)


def test_returns_skip_a_previous_zero(prices):
    got = metrics.returns(prices(*closes(0, 10, None, 15))).collect()
    assert [(r.previous_close, r.return_pct) for r in got] == [(10, 50)]


def test_compare_only_requested_pairs(spark, prices):
    rows = prices(
        *closes(10, 14, instrument_id="a"), *closes(8, 10, instrument_id="b"), *closes(1, instrument_id="c"),
    )
    pairs = spark.createDataFrame([("s1", "a", "b"), ("s1", "a", "z")], "source_id string, instrument_a_id string, instrument_b_id string")
    got = {r.instrument_b_id: r for r in metrics.compare_pairs(rows, pairs).collect()}
    assert set(got) == {"b", "z"}
    assert (got["b"].instrument_a_avg_close, got["b"].instrument_b_avg_close, got["b"].avg_close_diff) == (12, 9, 3)
    assert (got["z"].instrument_b_count, got["z"].instrument_b_avg_close, got["z"].avg_close_diff) == (0, None, None)


def test_report_agrees_with_single_metrics(prices):
    rows = prices(*closes(100, 90, None, 120), *closes(5, instrument_id="other"))
    for versions in ("all", "latest"):
        report = {r.instrument_id: r for r in metrics.metrics_report(rows, versions=versions).collect()}
        for part in (metrics.aggregates, metrics.trend, metrics.forecast, metrics.risk_signal):
            for row in part(rows, versions).collect():
                whole = report[row.instrument_id].asDict()
                assert {k: whole[k] for k in row.asDict()} == row.asDict()


def test_report_range_is_inclusive_and_may_be_empty(prices):
    rows = prices(*closes(1, 2, 3, 4))
    assert one(metrics.metrics_report(rows, date(2024, 1, 2), date(2024, 1, 3)))["count"] == 2
    assert metrics.metrics_report(rows, date(2024, 1, 3), date(2024, 1, 2)).collect() == []


def test_requested_series_without_rows(spark, prices):
    rows = prices({"close_price": Decimal(2)}, {"close_price": Decimal(3)})
    asked = rows.select("instrument_id", "source_id").unionByName(spark.createDataFrame([("none", "s1")], "instrument_id string, source_id string"))
    gone = {name: {r.instrument_id: r for r in frame.collect()}["none"] for name, frame in {
        "trend": metrics.trend(rows, requested=asked), "forecast": metrics.forecast(rows, requested=asked),
        "risk": metrics.risk_signal(rows, requested=asked), "report": metrics.metrics_report(rows, requested=asked),
    }.items()}
    assert (gone["trend"].direction, gone["trend"].start_close) == ("flat", None)
    assert (gone["forecast"].method, gone["forecast"].predicted_next_close) == ("naive_last_close", None)
    assert (gone["risk"].signal, gone["risk"].volatility_pct) == ("insufficient_data", None)
    report = gone["report"]
    assert (report["count"], report.total_volume, report.direction, report.signal) == (0, 0, "flat", "insufficient_data")


def test_extreme_closes_do_not_end_the_report(prices):
    rows = prices({"close_price": Decimal("1e-18")}, {"close_price": Decimal(10) ** 9})
    assert metrics.risk_signal(rows).first().signal == "high"
