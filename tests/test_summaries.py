"""Metrics of ranges from stored summaries equal those of the raw rows."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from pricemart.operators.metrics import metrics_report
from pricemart.operators.summaries import refresh_summaries, report_from_summaries, year_summaries
from pricemart.sources import tables
from times import utc


def shown(report):
    return sorted(
        tuple(round(float(v), 8) if isinstance(v, (float, Decimal)) else str(v) for v in r) for r in report.select(sorted(report.columns)).collect()
    )


@pytest.fixture
def walk(prices):
    """Four years of three series: one with gaps and several versions a day, one short, one with negative closes."""
    rng, points = random.Random(11), []
    for name, least, step in (("a", 1, 9), ("b", 0, 200), ("c", -50, 17)):
        day = date(2020, 2, 1)
        while day < date(2024, 3, 1):
            for version in range(rng.choice((1, 1, 3))):
                close = rng.choice([None, Decimal(rng.randint(least, 90)), Decimal(rng.randint(least, 90)) / 4])
                points.append({"instrument_id": name, "record_date": day, "close_price": close, "volume": rng.randint(0, 9),
                               "system_date": utc(2024, 6, 1 + version)})
            day += timedelta(days=rng.randint(1, 2 * step))
    return prices(*points)


@pytest.mark.parametrize("start, end", [
    (date(2020, 1, 1), date(2023, 12, 31)), (date(2020, 6, 5), date(2023, 5, 6)), (date(2021, 3, 1), date(2021, 9, 9)),
    (date(2021, 12, 31), date(2022, 1, 1)), (date(2019, 1, 1), date(2030, 1, 1)), (date(2021, 1, 1), date(2021, 12, 31)),
])
@pytest.mark.parametrize("max_rows", [20, 10**6])
def test_any_range_equals_the_raw_scan(walk, start, end, max_rows):
    got = report_from_summaries(year_summaries(walk, max_rows), walk, start, end, max_rows)
    want = metrics_report(walk, start, end)
    assert sorted(got.columns) == sorted(want.columns)
    assert {f.name: f.dataType for f in got.schema}["avg_close"] == {f.name: f.dataType for f in want.schema}["avg_close"]
    assert shown(got) == shown(want)


def test_stored_summaries_are_refreshed_by_year_and_read_instead_of_rows(spark, tmp_path, walk):
    root = str(tmp_path)
    plain = walk.where("instrument_id <> 'c'")
    tables.append(plain, root, "prices")
    refresh_summaries(spark, root)
    more = plain.where("record_year = 2022").withColumns({"system_date": F.lit(utc(2024, 7, 1)), "close_price": F.col("close_price") * 2})
    tables.append(more.withColumn("close_price", F.col("close_price").cast("decimal(38,18)")), root, "prices")
    refresh_summaries(spark, root, 2022)
    stored, rows = tables.scan(spark, root, "price_summaries"), tables.scan(spark, root, "prices")
    assert stored.count() == len({(r.instrument_id, r.record_year) for r in rows.collect()})

    start, end = date(2020, 6, 5), date(2023, 5, 6)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    try:
        report = report_from_summaries(stored, rows, start, end)
        assert shown(report) == shown(metrics_report(rows, start, end))
        report.collect()
        final = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in final.splitlines() if "FileScan" in line and "system_date" in line]
    assert scans and all(" IN (2020,2023)" in s for s in scans), scans
