"""Bitemporal price rows: scans, latest versions, tombstones and as-of reads.

A price is identified by (instrument_id, source_id, record_date); every load adds a version with a new
``system_date``. Ids may be of any type.
"""

from __future__ import annotations

from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemart.functions.series import MAX_ROWS_PER_TASK, by_time, last_known, newest, newest_n, ordered_scan
from pricemart.functions.text import number_text

SERIES = ("instrument_id", "source_id")
PRICE_KEY = ("instrument_id", "source_id", "record_date")
DEFAULT_START = date(2000, 1, 1)
DELETED = {"_deleted": "true"}


def price_projection(prices: DataFrame) -> DataFrame:
    """Ids, date, load time, and close and volume as doubles."""
    return prices.select(
        *SERIES,
        F.col("record_date").cast("date").alias("record_date"),
        "system_date",
        F.col("close_price").cast("double").alias("close_price"),
        F.col("volume").cast("double").alias("volume"),
    )


def latest_daily_prices(prices: DataFrame) -> DataFrame:
    """One row per (instrument, source, date): the newest version among those that have a close.

    A newer version without a close does not hide an older one; tombstones count. Versions are merged
    map-side, so a date with very many versions shuffles one row per task, and what is left of a
    series is bounded by the calendar: later windows over a series are safe.
    """
    return (
        price_projection(prices)
        .where(F.col("close_price").isNotNull())
        .groupBy(*PRICE_KEY)
        .agg(
            F.max_by("close_price", "system_date").alias("close_price"),
            F.max_by("volume", "system_date").alias("volume"),
        )
    )


def latest_point(prices: DataFrame) -> DataFrame:
    """The newest version per (instrument, source, date), whether or not it has a close."""
    return newest(prices, PRICE_KEY, F.col("system_date").desc())


def filter_price_history(
    prices: DataFrame,
    *,
    instrument_id: Any = None,
    source_id: Any = None,
    start_date: date | None = None,
    end_date: date | None = None,
) -> DataFrame:
    """Optional filters, both dates inclusive; an empty argument does not filter.

    The literal takes the column's type, so that the predicate reaches the scan; where the table is
    laid out by ``record_year`` a year predicate is added for partition pruning.
    """
    for name, wanted in (("instrument_id", instrument_id), ("source_id", source_id)):
        if wanted not in (None, ""):
            prices = prices.where(F.col(name) == F.lit(str(wanted)).cast(prices.schema[name].dataType))
    by_year = "record_year" in prices.columns
    if start_date:
        prices = prices.where(F.col("record_date") >= F.lit(start_date))
        if by_year:
            prices = prices.where(F.col("record_year") >= start_date.year)
    if end_date:
        prices = prices.where(F.col("record_date") <= F.lit(end_date))
        if by_year:
            prices = prices.where(F.col("record_year") <= end_date.year)
    return prices


def default_range(start_date: date | None, end_date: date | None) -> tuple[date, date]:
    """Missing ends of a range: from 2000-01-01, up to today."""
    return start_date or DEFAULT_START, end_date or date.today()


def scan_range(prices: DataFrame, start_date: date | None = None, end_date: date | None = None) -> DataFrame:
    """All versions, tombstones included, in an inclusive date range; nothing if it is empty."""
    start, end = default_range(start_date, end_date)
    return filter_price_history(prices, start_date=start, end_date=end)


def partition_scan(prices: DataFrame, instrument_id: Any, source_id: Any, record_year: int) -> DataFrame:
    """All versions of one series in one year."""
    one = filter_price_history(prices, instrument_id=instrument_id, source_id=source_id)
    return one.where(F.col("record_year") == record_year)


def reading_order() -> list[Column]:
    """Ascending years; inside a year newest date first, newest version first."""
    return [F.col("record_year").asc(), F.col("record_date").desc(), F.col("system_date").desc()]


def price_history_page(
    prices: DataFrame,
    instrument_id: Any,
    source_id: Any,
    start_date: date | None = None,
    end_date: date | None = None,
    page_size: int = 1000,
) -> DataFrame:
    """The first ``page_size`` rows of one series in reading order."""
    if not 1 <= page_size <= 10_000:
        raise ValueError("page_size must be between 1 and 10000")
    one = filter_price_history(prices, instrument_id=instrument_id, source_id=source_id)
    return scan_range(one, start_date, end_date).orderBy(*reading_order()).limit(page_size)


def price_history_pages(
    prices: DataFrame, start_date: date | None = None, end_date: date | None = None, page_size: int = 1000
) -> DataFrame:
    """The same page for every series at once."""
    if not 1 <= page_size <= 10_000:
        raise ValueError("page_size must be between 1 and 10000")
    return newest_n(scan_range(prices, start_date, end_date), SERIES, page_size, *reading_order())


def price_tombstones(prices: DataFrame, keys: DataFrame, deleted_at: datetime) -> DataFrame:
    """The rows to append to delete ``keys``: each newest version, marked and stamped anew.

    A key without a price gives no row. The close stays in place.
    """
    key_columns = [k for k in ("instrument_id", "source_id", "record_year", "record_date") if k in keys.columns]
    found = prices.join(keys.select(*key_columns).distinct(), key_columns, "left_semi")
    marker = F.create_map(*[F.lit(x) for pair in DELETED.items() for x in pair])
    stamp = F.lit(deleted_at).cast("timestamp")
    return latest_point(found).withColumns(
        {"extra_indicators": marker, "system_date": stamp, "ingested_at": stamp}
    ).select(*prices.columns)


def without_tombstones(prices: DataFrame) -> DataFrame:
    """Newest versions that are not marked as deleted (extension; the metrics count tombstones)."""
    return latest_point(prices).where(F.coalesce(F.col("extra_indicators")["_deleted"], F.lit("")) != "true")


def known_at(prices: DataFrame, moment: datetime) -> DataFrame:
    """Only the versions already loaded at ``moment`` (extension)."""
    return prices.where(F.col("system_date") <= F.lit(moment).cast("timestamp"))


def prices_as_of(prices: DataFrame, requests: DataFrame, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """For each request row (instrument, source, record_date, known_at) the version known then (extension).

    Versions and requests are merged into one time line per price and the last version is carried
    forward: one shuffle, no range join, and a price with very many versions is split.
    """
    values = [c for c in prices.columns if c not in PRICE_KEY]
    version = F.struct(*values)
    line = prices.select(
        *PRICE_KEY, F.col("system_date").alias("known_at"), F.lit(0).alias("_request"), version.alias("_version")
    ).unionByName(
        requests.select(*PRICE_KEY, "known_at", F.lit(1).alias("_request")), allowMissingColumns=True
    )
    order = by_time(PRICE_KEY, F.unix_micros(F.col("known_at").cast("timestamp")), F.col("_request"))
    merged = ordered_scan(line, order, {"_known": last_known("_version")}, max_rows)
    return merged.where(F.col("_request") == 1).select(
        *PRICE_KEY, "known_at", *(F.col("_known")[c].alias(c) for c in values)
    )


def price_json(prices: DataFrame) -> DataFrame:
    """One JSON document per row: date, prices as text, volume as a number, nulls kept."""
    document = F.struct(
        F.col("record_date").cast("string").alias("date"),
        *(number_text(F.col(f"{p}_price"), prices.schema[f"{p}_price"].dataType).alias(p)
          for p in ("open", "close", "high", "low")),
        F.col("volume").alias("volume"),
    )
    return prices.select(
        *PRICE_KEY, "system_date", F.to_json(document, {"ignoreNullFields": "false"}).alias("price_json")
    )
