"""Cutting a long series into pieces must not change any result."""

import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from times import utc
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricemart.functions.series import SeriesOrder, last_known, newest, newest_n, ordered_scan, previous, running_max
from pricemart.operators import metrics
from pricemart.operators.instruments import version_history
from pricemart.operators.prices import prices_as_of

SCHEMA = "k string, t long, v double"
COLUMNS = {"before": previous("v"), "known": last_known("v"), "peak": running_max("v")}


def brute_force(rows):
    out = []
    for key in {k for k, _, _ in rows}:
        last = peak = None
        for _, t, v in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            before = last
            if v is not None:
                last = v
                peak = v if peak is None else max(peak, v)
            out.append((key, t, v, before, last, peak))
    return sorted(out, key=lambda r: r[:2])


def rounded(frame):
    """Rows whose sums of doubles may have been added up in another order."""
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in frame.collect())


def scan(spark, rows, max_rows):
    order = SeriesOrder(("k",), F.floor(F.col("t") / 100), F.floor(F.col("t") / 10), (F.col("t"),))
    frame = ordered_scan(spark.createDataFrame(rows, SCHEMA), order, COLUMNS, max_rows)
    return sorted((tuple(r) for r in frame.collect()), key=lambda r: (r[0] or "", r[1]))


@pytest.mark.parametrize("max_rows", [1, 7, 50, 10_000])
def test_hot_series_in_pieces(spark, max_rows):
    draw = random.Random(3)
    rows = [("hot", t, draw.choice([None, draw.uniform(-9, 9)])) for t in range(400)]
    rows += [(f"k{i % 9}", t, draw.uniform(0, 5)) for i, t in enumerate(range(200))]
    assert scan(spark, rows, max_rows) == brute_force(rows)


def test_series_without_key_in_pieces(spark):
    rows = [(None, t, float(t % 5)) for t in range(50)] + [("a", t, 1.0) for t in range(5)]
    got = scan(spark, [(k or None, t, v) for k, t, v in rows], 7)
    assert [r for r in got if r[0] == "a"] == brute_force(rows[50:])
    assert [r[1:] for r in got if r[0] is None] == [r[1:] for r in brute_force([("x", t, v) for _, t, v in rows[:50]])]


def test_all_rows_at_one_place(spark):
    """Rows of one place come in any order, but each sees another number of rows before it."""
    rows = spark.range(3000).selectExpr("'hot' AS k", "5L AS t", "id AS v")
    order = SeriesOrder(("k",), F.col("t"), F.col("t"), (F.col("t"),))
    got = ordered_scan(rows, order, COLUMNS, 100).cache()
    assert got.count() == 3000 and got.where("before IS NULL").count() == 1
    assert got.where("known <> v OR peak < v OR peak < before").count() == 0
    # every value but the last one is the one before of exactly one other
    assert got.select("before").distinct().count() == 3000
    assert got.agg(F.max("peak")).first()[0] == 2999


def test_one_plan_for_every_size(spark, prices):
    """Nothing runs while the frame is built."""
    tracker = spark.sparkContext.statusTracker()
    rows = prices(*({"close_price": Decimal(n + 1)} for n in range(5)))
    spark.sparkContext.setJobGroup("built", "built")
    try:
        for max_rows in (1, 10**6):
            metrics.metrics_report(rows, max_rows=max_rows)
            metrics.returns(rows, max_rows=max_rows)
        assert not tracker.getJobIdsForGroup("built")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("ab"), st.floats(-5, 5) | st.none()), min_size=1, max_size=40), st.integers(1, 9))
def test_any_series_in_pieces(spark, values, max_rows):
    rows = [(k, t, v) for t, (k, v) in enumerate(values)]
    assert scan(spark, rows, max_rows) == brute_force(rows)


def test_pieces_when_most_rows_share_one_day(spark, prices):
    """Nine tenths of the versions belong to one day of one instrument."""
    draw = random.Random(5)
    points = [
        {"record_date": date(2024, 1, 5), "system_date": utc(2024, 6, 1) + timedelta(seconds=n), "close_price": Decimal(draw.randint(1, 99))}
        for n in range(180)
    ] + [{"record_date": date(2024, 1, 1 + n), "instrument_id": f"j{n}", "close_price": Decimal(n + 1)} for n in range(20)]
    rows = prices(*points)
    whole, cut = metrics.metrics_report(rows), metrics.metrics_report(rows, max_rows=10)
    assert rounded(whole) == rounded(cut)
    steps, cut_steps = metrics.returns(rows), metrics.returns(rows, max_rows=10)
    assert steps.count() == 179
    assert rounded(steps) == rounded(cut_steps)


def test_history_and_as_of_in_pieces(spark, prices):
    versions = spark.createDataFrame(
        [("a", utc(2024, 1, 1) + timedelta(hours=7 * n), n, "update", False, None, None, "x") for n in range(60)],
        "instrument_id string, valid_from timestamp, version_id long, change_type string, is_delete_marker boolean,"
        " snapshot string, valid_to timestamp, changed_by string",
    )
    assert sorted(version_history(versions, 4).collect()) == sorted(version_history(versions).collect())
    rows = prices(*(
        {"record_date": date(2024, 1, 1), "system_date": utc(2024, 6, 1) + timedelta(hours=n), "close_price": Decimal(n)} for n in range(50)
    ))
    asked = rows.select("instrument_id", "source_id", "record_date", (F.col("system_date") + F.expr("interval 10 minutes")).alias("known_at"))
    picked = prices_as_of(rows.select("instrument_id", "source_id", "record_date", "system_date", "close_price"), asked, 5)
    assert sorted(int(r.close_price) for r in picked.collect()) == list(range(50))


def test_newest_keeps_one_row_per_key(spark):
    rows = spark.createDataFrame([("a", 1, 1.0), ("a", 2, None), ("b", 1, 3.0)], SCHEMA)
    assert sorted(tuple(r) for r in newest(rows, ["k"], F.col("t").desc()).collect()) == [("a", 2, None), ("b", 1, 3.0)]


def test_large_top_n_in_two_steps(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("cold")).otherwise("hot").alias("k"), F.col("id").alias("t"))
    rows = rows.withColumn("m", F.create_map(F.lit("a"), F.col("t")))
    got = newest_n(rows, ["k"], 150, F.col("t").desc())
    assert got.columns == ["k", "t", "m"]
    per_key = {r.k: (r.n, r.least) for r in got.groupBy("k").agg(F.count("*").alias("n"), F.min("t").alias("least")).collect()}
    assert per_key == {"cold": (150, 2550), "hot": (150, 2776)}
