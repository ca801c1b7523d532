"""Metrics of any range from stored summaries of whole years, and raw rows of the two years that the range cuts.

A summary is what one series has in one year, in a form that can be merged: counts, sums, extremes, first and last
close, the sum of the absolute returns inside the year, and its greatest fall. Merged in order of years, the return
from one year's last close to the next one's first is added, and the fall from the highest close before to a
year's lowest. The latter is exact where no close is negative, as then a higher peak can only deepen a fall; series
with negative closes are scanned.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemart.functions.series import MAX_ROWS_PER_TASK
from pricemart.operators.metrics import price_rank, price_steps, report_of
from pricemart.operators.prices import SERIES, default_range, scan_range
from pricemart.sources import tables

YEAR = (*SERIES, "record_year")
#: Series with negative closes that are broadcast, at most, as far as the summaries tell.
MOST_BROADCAST = 100_000


def year_summaries(prices: DataFrame, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """One row per series and year, of all versions."""
    steps = price_steps(prices, max_rows, YEAR)
    place = F.when(F.col("close_price").isNotNull(), price_rank(prices))
    return steps.groupBy(*YEAR).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("close_price").alias("close_count"),
        F.min("close_price").alias("min_close"), F.max("close_price").alias("max_close"),
        F.sum("close_price").alias("sum_close"), F.coalesce(F.sum("volume"), F.lit(0)).alias("total_volume"),
        F.min_by("close_price", place).alias("first_close"), F.max_by("close_price", place).alias("last_close"),
        F.coalesce(F.sum(F.abs("return_pct")), F.lit(0.0)).alias("return_sum"), F.count("return_pct").alias("return_count"),
        F.greatest(F.lit(0.0), F.max("drawdown_pct")).alias("fall"),
    )


def refresh_summaries(spark: SparkSession, root: str, *years: int) -> None:
    """Compute the stored summaries of the given years, or of all, anew from the price table."""
    prices = tables.scan(spark, root, "prices")
    if years:
        prices = prices.where(F.col("record_year").isin(*years))
    tables.upsert(spark, root, "price_summaries", year_summaries(prices))


def _merged(years: Column) -> Column:
    """Risk totals of a list of summaries in order of years."""
    nothing = F.lit(None).cast("double")
    start = F.struct(
        nothing.alias("last"), nothing.alias("peak"), F.lit(0.0).alias("fall"), F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n")
    )

    def add(total: Column, year: Column) -> Column:
        first, before = year["first_close"].cast("double"), total["last"]
        step = F.when(before != 0, F.abs((first - before) / before * 100))
        deep = F.when(total["peak"] > 0, (total["peak"] - year["min_close"].cast("double")) / total["peak"] * 100)
        return F.struct(
            F.coalesce(year["last_close"].cast("double"), before).alias("last"),
            F.greatest(total["peak"], year["max_close"].cast("double")).alias("peak"),
            F.greatest(total["fall"], year["fall"], deep).alias("fall"),
            (total["sum"] + year["return_sum"] + F.coalesce(step, F.lit(0.0))).alias("sum"),
            (total["n"] + year["return_count"] + F.when(step.isNull(), 0).otherwise(1)).cast("long").alias("n"),
        )

    return F.aggregate(years, start, add)


def report_from_summaries(
    summaries: DataFrame, prices: DataFrame, start_date: date | None = None, end_date: date | None = None,
    max_rows: int = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """What ``metrics_report`` gives for a range, from summaries where a whole year is in it.

    Of ``prices`` only the years that the range cuts are read, and all years of series with a negative close.
    """
    start, end = default_range(start_date, end_date)
    cut = sorted({d.year for d, whole in ((start, date(start.year, 1, 1)), (end, date(end.year, 12, 31))) if d != whole})
    whole = F.col("record_year").between(start.year, end.year) & ~F.col("record_year").isin(*cut)
    parts = summaries.where(whole).select(*YEAR, *_SUMMARY)
    if cut and start <= end:
        ends = scan_range(prices, start, end).where(F.col("record_year").isin(*cut))
        parts = parts.unionByName(year_summaries(ends, max_rows).select(*parts.columns))

    by_year = F.sort_array(F.collect_list(F.struct("record_year", *_SUMMARY)))
    series = parts.groupBy(*SERIES).agg(
        F.sum("row_count").alias("count"), F.sum("close_count").alias("_closes"), F.min("min_close").alias("min_close"),
        F.max("max_close").alias("max_close"), F.sum("sum_close").alias("_sum"), F.sum("total_volume").alias("total_volume"),
        F.min_by("first_close", F.when(F.col("close_count") > 0, F.col("record_year"))).alias("_first"),
        F.max_by("last_close", F.when(F.col("close_count") > 0, F.col("record_year"))).alias("_last"),
        _merged(by_year).alias("_risk"),
    )
    average = prices.agg(F.avg("close_price")).schema[0].dataType
    mean = F.when(F.col("_closes") > 0, F.col("_sum") / F.col("_closes")).cast(average).alias("avg_close")
    risk = (F.try_divide(F.col("_risk.sum"), F.col("_risk.n")).alias("_volatility"), F.col("_risk.fall").alias("_drawdown"))
    merged = series.select("*", mean, *risk).drop("_risk", "_sum")
    plain = merged.where(~F.coalesce(F.col("min_close") < 0, F.lit(False)))

    negative = merged.where(F.col("min_close") < 0).drop("_volatility", "_drawdown")
    wanted = negative.select(*SERIES)
    if summaries.where(F.col("min_close") < 0).select(*SERIES).distinct().count() <= MOST_BROADCAST:
        # few or none: rows are then read after it is known which
        wanted = F.broadcast(wanted)
    rows = scan_range(prices, start, end).join(wanted, list(SERIES), "left_semi")
    scanned = price_steps(rows, max_rows).groupBy(*SERIES).agg(
        F.avg(F.abs("return_pct")).alias("_volatility"), F.greatest(F.lit(0.0), F.max("drawdown_pct")).alias("_drawdown")
    )
    return report_of(plain.unionByName(negative.join(scanned, list(SERIES))), start, end)


_SUMMARY = (
    "row_count", "close_count", "min_close", "max_close", "sum_close", "total_volume", "first_close", "last_close",
    "return_sum", "return_count", "fall",
)
