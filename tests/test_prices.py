import json
from datetime import date
from decimal import Decimal

import pytest
from times import utc
from pyspark.sql import functions as F

from pricemart.operators import prices as ops
from pricemart.operators import rolling

D = Decimal


def test_newer_version_without_close_hides_nothing(prices):
    day = {"record_date": date(2024, 1, 1)}
    rows = prices(
        {"close_price": D("10"), "volume": 1, "system_date": utc(2024, 6, 1), **day},
        {"close_price": None, "volume": 2, "system_date": utc(2024, 6, 2), **day},
    )
    (daily,) = ops.latest_daily_prices(rows).collect()
    assert (daily.close_price, daily.volume) == (10.0, 1.0)
    (point,) = ops.latest_point(rows).collect()
    assert (point.close_price, point.volume) == (None, 2)


def test_latest_daily_prices_have_unique_keys(prices):
    rows = prices(*({"record_date": date(2024, 1, 1 + n % 3), "system_date": utc(2024, 6, 1 + n), "close_price": D(n)} for n in range(9)))
    got = {r.record_date.day: r.close_price for r in ops.latest_daily_prices(rows).collect()}
    assert got == {1: 6, 2: 7, 3: 8}


def test_range_across_years_in_reading_order(prices):
    days = [date(2023, 10, 31), date(2023, 11, 1), date(2023, 12, 5), date(2024, 1, 7), date(2024, 3, 31), date(2024, 4, 1)]
    rows = prices(*({"record_date": d} for d in days))
    got = ops.price_history_page(rows, "i1", "s1", date(2023, 11, 1), date(2024, 3, 31))
    assert [r.record_date for r in got.collect()] == [days[2], days[1], days[4], days[3]]
    assert [r.record_date for r in ops.price_history_page(rows, "i1", "s1", page_size=1).collect()] == [days[2]]
    with pytest.raises(ValueError):
        ops.price_history_page(rows, "i1", "s1", page_size=0)


def test_pages_of_all_series_agree_with_one(prices):
    rows = prices(*({"instrument_id": i, "record_date": date(2020 + n, 3, 1)} for n in range(4) for i in "ab"))
    pages = ops.price_history_pages(rows, page_size=2)
    one = ops.price_history_page(rows, "a", "s1", page_size=2)
    assert sorted(pages.where("instrument_id = 'a'").collect()) == sorted(one.collect())
    assert pages.count() == 4


def test_filters_and_partition_scan(prices):
    rows = prices({"instrument_id": "a"}, {"instrument_id": "b"}, {"instrument_id": "b", "record_date": date(2023, 1, 1)})
    assert ops.filter_price_history(rows).count() == 3
    assert ops.filter_price_history(rows, instrument_id="b", source_id="s1").count() == 2
    assert ops.filter_price_history(rows, start_date=date(2024, 1, 1)).count() == 2
    assert ops.scan_range(rows, date(2024, 2, 1), date(2024, 1, 1)).count() == 0
    assert ops.partition_scan(rows, "b", "s1", 2023).count() == 1


def test_tombstone_copies_the_newest_version(spark, prices):
    rows = prices(
        {"close_price": D("1"), "system_date": utc(2024, 6, 1), "record_date": date(2024, 1, 1), "extra_indicators": {"x": "1"}},
        {"close_price": D("2"), "system_date": utc(2024, 6, 2), "record_date": date(2024, 1, 1)},
        {"close_price": D("3"), "record_date": date(2024, 1, 2)},
    )
    keys = spark.createDataFrame(
        [("i1", "s1", date(2024, 1, 1)), ("i1", "s1", date(2024, 5, 5))], "instrument_id string, source_id string, record_date date"
    )
    marks = ops.price_tombstones(rows, keys, utc(2024, 7, 1))
    (mark,) = marks.collect()
    assert mark.close_price == 2 and mark.extra_indicators == {"_deleted": "true"}
    after = rows.unionByName(marks)
    assert ops.latest_daily_prices(after).count() == 2, "metrics count tombstones"
    assert [r.record_date.day for r in ops.without_tombstones(after).collect()] == [2]
    assert ops.without_tombstones(ops.known_at(after, utc(2024, 6, 15))).count() == 2


def test_price_documents(prices):
    rows = prices({"close_price": D("150.0"), "open_price": D("100"), "volume": 1000000})
    assert json.loads(ops.price_json(rows).first().price_json) == {
        "date": "2024-01-01", "open": "100", "close": "150", "high": None, "low": None, "volume": 1000000,
    }


def test_rolling_average_over_observations(prices):
    daily = ops.latest_daily_prices(prices(*({"close_price": D(v)} for v in (1, 2, 3, 4))))
    got = rolling.rolling_average(daily, 3, utc(2024, 7, 1)).orderBy("record_date").collect()
    assert [r.rolling_avg_close for r in got] == [1, 1.5, 2, 3]
    assert [r.observation_count for r in got] == [1, 2, 3, 3]
    assert got[0].window_days == 3
    assert got[0].__fields__ == [
        "instrument_id", "source_id", "window_days", "record_date", "close_price", "rolling_avg_close",
        "observation_count", "computed_at",
    ]


def test_rolling_average_of_one_is_the_close(prices):
    daily = ops.latest_daily_prices(prices(*({"close_price": D(v)} for v in (5, 9, 2))))
    assert rolling.rolling_average(daily, 1).where(F.col("close_price") != F.col("rolling_avg_close")).count() == 0
    with pytest.raises(ValueError):
        rolling.rolling_average(daily, 0)


def test_several_windows_agree_with_single_ones(prices):
    daily = ops.latest_daily_prices(prices(*({"close_price": D(v)} for v in (5, 9, 2, 7))))
    wide = {r.record_date: r for r in rolling.rolling_averages(daily, (2, 3)).collect()}
    for n in (2, 3):
        for row in rolling.rolling_average(daily, n).collect():
            assert wide[row.record_date][f"rolling_avg_{n}"] == row.rolling_avg_close
