"""Price metrics, for every (instrument, source) at once.

Input rows are price rows of a range. With ``versions='all'`` every stored version counts, in the order
record_date ascending, system_date descending; with ``versions='latest'`` each date counts once, by its
newest version that has a close.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemart.functions.series import MAX_ROWS_PER_TASK, SeriesOrder, by_day, ordered_scan, previous, running_max
from pricemart.functions.text import two_decimals
from pricemart.operators.prices import SERIES, default_range, latest_daily_prices, scan_range

FORECAST_METHOD = "naive_last_close"
TOO_FEW_CLOSES = "Need at least two close values to estimate risk."

# fixed thresholds of the risk classes, in percent, all inclusive
HIGH_VOLATILITY, HIGH_DRAWDOWN = 3, 15
MEDIUM_VOLATILITY, MEDIUM_DRAWDOWN = 1, 5


def points_of(prices: DataFrame, versions: str = "all") -> DataFrame:
    """The rows that the metrics count."""
    if versions == "latest":
        return latest_daily_prices(prices)
    if versions == "all":
        return prices
    raise ValueError("versions must be 'all' or 'latest'")


def _by_day_only(points: DataFrame) -> bool:
    return "system_date" not in points.columns


def price_rank(points: DataFrame) -> Column:
    """The place of a row in its series as one fixed-width number, which hash aggregation can hold."""
    days = F.unix_date(F.col("record_date"))
    if _by_day_only(points):
        return days
    return days.cast("decimal(38,0)") * F.lit(10**18).cast("decimal(19,0)") - F.unix_micros(
        F.col("system_date").cast("timestamp")
    )


def price_order(points: DataFrame, keys: Sequence[str] = SERIES) -> SeriesOrder:
    """Rows of a series by date ascending and, inside a date, newest version first."""
    days = F.unix_date(F.col("record_date")).cast("long")
    if _by_day_only(points):
        return by_day(keys, days)
    return by_day(keys, days, -F.unix_micros(F.col("system_date").cast("timestamp")))


def _aggregate_columns() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("count"),
        F.min("close_price").alias("min_close"),
        F.max("close_price").alias("max_close"),
        F.avg("close_price").alias("avg_close"),
        F.coalesce(F.sum("volume"), F.lit(0)).alias("total_volume"),
    ]


def aggregates(prices: DataFrame, versions: str = "all", requested: DataFrame | None = None) -> DataFrame:
    """Row count, min, max and average close, and total volume per series.

    Rows without a close count as rows only. ``requested`` series without any row report zero.
    """
    found = points_of(prices, versions).groupBy(*SERIES).agg(*_aggregate_columns())
    return _with_requested(found, requested, "count", "total_volume")


def _with_requested(found: DataFrame, requested: DataFrame | None, *zero: str) -> DataFrame:
    """``found`` for every requested series, or as it is; a series without rows has nulls, and 0 in ``zero``."""
    if requested is None:
        return found
    rows = requested.select(*SERIES).distinct().join(found, list(SERIES), "left")
    return rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in zero})


def _first_and_last(points: DataFrame) -> list[Column]:
    place = F.when(F.col("close_price").isNotNull(), price_rank(points))
    return [
        F.min_by("close_price", place).alias("_first"),
        F.max_by("close_price", place).alias("_last"),
        F.count("close_price").alias("_closes"),
    ]


def _trend_columns() -> dict[str, Column]:
    enough = F.col("_closes") >= 2
    start, end = F.when(enough, F.col("_first")), F.when(enough, F.col("_last"))
    change = end - start
    return {
        "direction": F.when(change > 0, "up").when(change < 0, "down").otherwise("flat"),
        "start_close": start,
        "end_close": end,
        "change": change,
        "change_pct": F.when(start != 0, change.cast("double") / start.cast("double") * 100),
    }


def trend(prices: DataFrame, versions: str = "all", requested: DataFrame | None = None) -> DataFrame:
    """First and last close of the range, the change between them and its direction.

    ``requested`` series without any row are flat.
    """
    points = points_of(prices, versions)
    ends = _with_requested(points.groupBy(*SERIES).agg(*_first_and_last(points)), requested)
    return ends.select(*SERIES, *(c.alias(name) for name, c in _trend_columns().items()))


def forecast(prices: DataFrame, versions: str = "all", requested: DataFrame | None = None) -> DataFrame:
    """The last close, taken as the next one; none for ``requested`` series without any row."""
    points = points_of(prices, versions)
    place = F.when(F.col("close_price").isNotNull(), price_rank(points))
    last = points.groupBy(*SERIES).agg(F.max_by("close_price", place).alias("predicted_next_close"))
    return _with_requested(last, requested).select(
        *SERIES, F.lit(FORECAST_METHOD).alias("method"), "predicted_next_close"
    )


def price_steps(points: DataFrame, max_rows: int = MAX_ROWS_PER_TASK, keys: Sequence[str] = SERIES) -> DataFrame:
    """Every row with the close before it, the peak so far, the return and the drawdown in percent.

    ``keys`` may add columns to those of a series; then each part of it begins anew.
    """
    doubles = points.withColumn("_close", F.col("close_price").cast("double"))
    columns = {"previous_close": previous("_close"), "peak_close": running_max("_close")}
    if _by_day_only(points):
        # one row per date: a series is no longer than its calendar, no need to look at its size
        max_rows = None
    scanned = ordered_scan(doubles, price_order(points, keys), columns, max_rows)
    close, before, peak = F.col("_close"), F.col("previous_close"), F.col("peak_close")
    return scanned.withColumns({
        "return_pct": F.when(before != 0, (close - before) / before * 100),
        "drawdown_pct": F.when((peak != 0) & before.isNotNull(), (peak - close) / peak * 100),
    })


def returns(prices: DataFrame, versions: str = "all", max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Percent change of each close on the one before it; none after a close of zero."""
    steps = price_steps(points_of(prices, versions), max_rows)
    kept = [c for c in (*SERIES, "record_date", "system_date") if c in steps.columns]
    return steps.where(F.col("close_price").isNotNull() & F.col("return_pct").isNotNull()).select(
        *kept, "close_price", "previous_close", "return_pct"
    )


def _risk_inputs() -> list[Column]:
    return [
        F.count("_close").alias("_closes"),
        F.avg(F.abs("return_pct")).alias("_volatility"),
        F.greatest(F.lit(0.0), F.max("drawdown_pct")).alias("_drawdown"),
    ]


def _risk_columns() -> dict[str, Column]:
    enough = F.col("_closes") >= 2
    volatility = F.coalesce("_volatility", F.lit(0.0))
    drawdown = F.coalesce("_drawdown", F.lit(0.0))
    # the percentages are doubles; without their last digits an exact threshold stays exact
    vol, down = F.round(volatility, 10), F.round(drawdown, 10)
    level = (
        F.when((vol >= HIGH_VOLATILITY) | (down >= HIGH_DRAWDOWN), "high")
        .when((vol >= MEDIUM_VOLATILITY) | (down >= MEDIUM_DRAWDOWN), "medium")
        .otherwise("low")
    )
    text = F.concat(
        F.lit("Risk is "), level, F.lit(" (volatility="), two_decimals(volatility),
        F.lit("%, max_drawdown="), two_decimals(drawdown), F.lit("%)."),
    )
    return {
        "signal": F.when(enough, level).otherwise("insufficient_data"),
        "volatility_pct": F.when(enough, F.col("_volatility")),
        "max_drawdown_pct": F.when(enough, drawdown),
        "summary": F.when(enough, text).otherwise(TOO_FEW_CLOSES),
    }


def risk_signal(
    prices: DataFrame, versions: str = "all", max_rows: int = MAX_ROWS_PER_TASK, requested: DataFrame | None = None
) -> DataFrame:
    """Volatility (mean absolute return), maximum drawdown and the risk class from both.

    ``requested`` series without any row have insufficient data.
    """
    steps = price_steps(points_of(prices, versions), max_rows)
    return _with_requested(steps.groupBy(*SERIES).agg(*_risk_inputs()), requested).select(
        *SERIES, *(c.alias(name) for name, c in _risk_columns().items())
    )


def compare_pairs(prices: DataFrame, pairs: DataFrame, versions: str = "all") -> DataFrame:
    """Row counts and average closes of two instruments of one source, for each requested pair.

    ``pairs`` has source_id, instrument_a_id and instrument_b_id. Only these pairs are built.
    """
    totals = points_of(prices, versions).groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("count"), F.avg("close_price").alias("avg_close")
    )

    def side(name: str) -> DataFrame:
        return totals.select(
            "source_id",
            F.col("instrument_id").alias(f"instrument_{name}_id"),
            F.col("count").alias(f"instrument_{name}_count"),
            F.col("avg_close").alias(f"instrument_{name}_avg_close"),
        )

    both = (
        pairs.select("source_id", "instrument_a_id", "instrument_b_id")
        .join(side("a"), ["source_id", "instrument_a_id"], "left")
        .join(side("b"), ["source_id", "instrument_b_id"], "left")
    )
    return both.select(
        "source_id", "instrument_a_id", "instrument_b_id",
        F.coalesce("instrument_a_count", F.lit(0)).alias("instrument_a_count"),
        F.coalesce("instrument_b_count", F.lit(0)).alias("instrument_b_count"),
        "instrument_a_avg_close", "instrument_b_avg_close",
        (F.col("instrument_a_avg_close") - F.col("instrument_b_avg_close")).alias("avg_close_diff"),
    )


def metrics_report(
    prices: DataFrame,
    start_date: date | None = None,
    end_date: date | None = None,
    versions: str = "all",
    max_rows: int = MAX_ROWS_PER_TASK,
    requested: DataFrame | None = None,
) -> DataFrame:
    """Aggregates, trend, forecast and risk of every series in a date range, in one pass over the rows.

    ``requested`` series without any row are reported as each of these does.
    """
    start, end = default_range(start_date, end_date)
    points = points_of(scan_range(prices, start, end), versions)
    steps = price_steps(points, max_rows)
    _, *risk_inputs = _risk_inputs()
    totals = steps.groupBy(*SERIES).agg(*_aggregate_columns(), *_first_and_last(points), *risk_inputs)
    return report_of(_with_requested(totals, requested, "count", "total_volume"), start, end)


def report_of(totals: DataFrame, start: date, end: date) -> DataFrame:
    """The columns of a report from totals: aggregates, _first, _last, _closes, _volatility and _drawdown of every series."""
    return totals.select(
        *SERIES,
        F.lit(start).alias("start_date"), F.lit(end).alias("end_date"),
        "count", "min_close", "max_close", "avg_close", "total_volume",
        *(c.alias(name) for name, c in _trend_columns().items()),
        F.lit(FORECAST_METHOD).alias("method"),
        F.col("_last").alias("predicted_next_close"),
        *(c.alias(name) for name, c in _risk_columns().items()),
    )
