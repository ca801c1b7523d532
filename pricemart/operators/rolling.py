"""Rolling averages of daily closes over the last N observations."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricemart.operators.prices import SERIES

DEFAULT_WINDOW = 7


def _last_rows(window_days: int):
    if window_days < 1:
        raise ValueError("window_days must be at least 1")
    return Window.partitionBy(*SERIES).orderBy("record_date").rowsBetween(-(window_days - 1), Window.currentRow)


def rolling_average(
    daily: DataFrame, window_days: int = DEFAULT_WINDOW, computed_at: datetime | None = None
) -> DataFrame:
    """Average and number of closes in the last ``window_days`` rows, the current one included.

    ``daily`` has one row per series and date (see ``latest_daily_prices``).
    """
    rows = _last_rows(window_days)
    stamp = F.lit(computed_at).cast("timestamp") if computed_at else F.current_timestamp()
    return daily.select(
        *SERIES,
        F.lit(window_days).cast("int").alias("window_days"),
        "record_date",
        "close_price",
        F.avg("close_price").over(rows).alias("rolling_avg_close"),
        F.count("close_price").over(rows).cast("int").alias("observation_count"),
        stamp.alias("computed_at"),
    )


def rolling_averages(daily: DataFrame, windows: Sequence[int]) -> DataFrame:
    """Several window lengths side by side; they share one shuffle and one sort."""
    return daily.select(
        *SERIES, "record_date", "close_price",
        *(F.avg("close_price").over(_last_rows(n)).alias(f"rolling_avg_{n}") for n in windows),
        *(F.count("close_price").over(_last_rows(n)).cast("int").alias(f"observations_{n}") for n in windows),
    )
