"""Checked queries: every operator run over whole tables, with the same result stated in SQL.

Dates come out as text and times as microseconds, so that both engines print them alike. Doubles are
rounded far above their noise.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricemart.functions.text import is_uuid, normal_symbol, stable_id
from pricemart.operators import answers, audit, ingest, instruments, metrics, prices, questions, regression, rolling
from pricemart.operators import summaries as stored_summaries
from pricemart.plans.jobs import load_records, rolling_average_job
from pricemart.session import configure, scratch_path
from pricemart.sources import driver_tables as driver
from pricemart.sources import feed, tables
from pricemart.streaming.feed_stream import start_feed_load
from pricemart.streaming.job_stream import current_job_states, start_job_states

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

IDS = ["instrument_id", "source_id"]
LOADED = datetime(2024, 6, 1, tzinfo=timezone.utc)
LOADED_US = 1717200000000000


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def configured(spark: SparkSession, folder: str) -> DataFrame:
            return run(configure(spark), folder)

        QUERIES[run.__name__] = configured
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


def day(name: str = "record_date") -> Column:
    return F.col(name).cast("string").alias(name)


def micros(name: str, alias: str | None = None) -> Column:
    return F.coalesce(F.unix_micros(F.col(name)), F.lit(-1)).alias(alias or f"{name}_us")


def rounded(name: str, digits: int = 6) -> Column:
    # plain arithmetic stays in generated code; round() would make a big decimal of every value
    return (F.floor(F.col(name).cast("double") * 10**digits + 0.5) / F.lit(float(10**digits))).alias(name)


# ---- shared SQL -------------------------------------------------------------------------------------

EVENT_PRICES = """ep AS (
  SELECT user_id AS instrument_id, event_type AS source_id, year(ts) AS record_year,
         CAST(ts AS DATE) AS record_date, epoch_us(ts) AS system_us,
         CASE WHEN event_id % 97 <> 0
              THEN CAST(500 AS DOUBLE) + value * (user_id % 10) / CAST(23.57 AS DOUBLE) END AS close_price,
         CAST(500 AS DOUBLE) + value * (user_id % 10) / CAST(23.57 AS DOUBLE) AS raw_close,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS volume,
         event_id % 89 = 0 AS deleted
  FROM events)"""

LINE_PRICES = """lp AS (
  SELECT l_suppkey AS instrument_id, l_linestatus AS source_id, year(l_shipdate) AS record_year,
         CAST(l_shipdate AS DATE) AS record_date,
         epoch_us(l_shipdate) + (l_orderkey * 8 + l_linenumber) * 100000 + l_partkey % 100000 AS system_us,
         l_extendedprice / (l_quantity + CAST(0.37 AS DOUBLE)) AS close_price,
         CAST(l_quantity AS BIGINT) AS volume
  FROM lineitem)"""


def daily_sql(name: str) -> str:
    return f"""{name}_daily AS (
  SELECT instrument_id, source_id, record_date, close_price, CAST(volume AS DOUBLE) AS volume
  FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id, source_id, record_date
                                     ORDER BY system_us DESC) AS rn
        FROM {name} WHERE close_price IS NOT NULL) WHERE rn = 1)"""


EVENTS = f"WITH {EVENT_PRICES}"
EVENTS_DAILY = f"WITH {EVENT_PRICES}, {daily_sql('ep')}"
LINES = f"WITH {LINE_PRICES}"
LINES_DAILY = f"WITH {LINE_PRICES}, {daily_sql('lp')}"

# the last row per (instrument, valid_from) is the last written
VERSIONS = """v AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn
                 FROM orders) WHERE rn = 1),
newest AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rk
                 FROM v) WHERE rk = 1)"""


def described_sql(version: str) -> str:
    """Columns of an instrument described by a version row of ``orders``, else by ``customer``."""
    snap = f"({version}.o_orderkey IS NOT NULL AND {version}.o_orderpriority <> '5-LOW')"
    return f"""
  CASE WHEN {snap} THEN ' sym' || CAST(c_custkey % 500 AS VARCHAR) || ' ' ELSE c_name END AS symbol,
  CASE WHEN {snap} THEN {version}.o_orderpriority ELSE c_mktsegment END AS instrument_class,
  CASE WHEN {snap} THEN 'Order ' || CAST({version}.o_orderkey AS VARCHAR) ELSE c_name END AS name,
  CASE WHEN {snap} THEN {version}.o_orderstatus ELSE n_name END AS region,
  CASE WHEN {snap} THEN 'EUR' ELSE 'USD' END AS currency,
  CASE WHEN {snap} THEN CAST(CAST({version}.o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS description,
  epoch_us(CASE WHEN {snap} THEN {version}.o_orderdate ELSE TIMESTAMP '1994-01-01' END) AS created_us"""


CURRENT = f"""WITH {VERSIONS}, live AS (
  SELECT c_custkey AS instrument_id, {described_sql('newest')}
  FROM customer LEFT JOIN newest ON o_custkey = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey
  WHERE coalesce(o_orderstatus, '') <> 'P')"""


def current(spark: SparkSession, folder: str) -> DataFrame:
    return instruments.current_instruments(driver.instruments(spark, folder), driver.instrument_versions(spark, folder))


def shown_instruments(frame: DataFrame, *more: Column) -> DataFrame:
    names = ("symbol", "instrument_class", "name", "region", "currency", "description")
    return frame.select("instrument_id", *names, micros("created_at", "created_us"), *more)


# ---- price versions ---------------------------------------------------------------------------------

@query(f"""{EVENTS_DAILY}
SELECT instrument_id, source_id, CAST(record_date AS VARCHAR) AS record_date,
       round(close_price, 6) AS close_price, volume FROM ep_daily""")
def latest_daily_prices(spark, folder):
    found = prices.latest_daily_prices(driver.event_prices(spark, folder))
    return found.select(*IDS, day(), rounded("close_price"), "volume")


@query(f"""{EVENTS}
SELECT instrument_id, source_id, CAST(record_date AS VARCHAR) AS record_date, system_us AS system_date_us,
       round(close_price, 6) AS close_price, volume
FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id, source_id, record_date ORDER BY system_us DESC) AS rn
      FROM ep) WHERE rn = 1""")
def latest_point(spark, folder):
    found = prices.latest_point(driver.event_prices(spark, folder))
    return found.select(*IDS, day(), micros("system_date"), rounded("close_price"), "volume")


@query(f"""{EVENTS}
SELECT instrument_id, source_id, CAST(record_date AS VARCHAR) AS record_date, system_us AS system_date_us,
       round(close_price, 6) AS close_price
FROM ep WHERE record_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""")
def price_range_filter(spark, folder):
    found = prices.scan_range(driver.event_prices(spark, folder), date(2024, 1, 5), date(2024, 1, 20))
    return found.select(*IDS, day(), micros("system_date"), rounded("close_price"))


@query(f"""{LINES}
SELECT instrument_id, source_id, CAST(record_date AS VARCHAR) AS record_date, system_us AS system_date_us,
       round(close_price, 4) AS close_price
FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id, source_id
                                   ORDER BY record_year, record_date DESC, system_us DESC) AS rn FROM lp
      WHERE record_date BETWEEN DATE '1996-06-01' AND DATE '2024-12-31')
WHERE rn <= 100""")
def price_history_pages(spark, folder):
    """The first hundred rows of every series, oldest year first and newest dates first inside it."""
    found = prices.price_history_pages(
        driver.lineitem_prices(spark, folder), date(1996, 6, 1), date(2024, 12, 31), page_size=100
    )
    return found.select(*IDS, day(), micros("system_date"), rounded("close_price", 4))


@query(f"""{EVENTS}
SELECT instrument_id, source_id, CAST(record_date AS VARCHAR) AS record_date, system_us AS system_date_us
FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id, source_id, record_date ORDER BY system_us DESC) AS rn
      FROM ep) WHERE rn = 1 AND NOT deleted""")
def tombstone_view(spark, folder):
    found = prices.without_tombstones(driver.event_prices(spark, folder))
    return found.select(*IDS, day(), micros("system_date"))


@query(f"""{EVENTS}, keys AS (
  SELECT DISTINCT instrument_id, source_id, record_date FROM ep WHERE close_price > 520)
SELECT instrument_id, source_id, CAST(record_date AS VARCHAR) AS record_date, 'true' AS deleted,
       CAST({LOADED_US} AS BIGINT) AS system_date_us, round(close_price, 6) AS close_price
FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id, source_id, record_date ORDER BY system_us DESC) AS rn
      FROM ep JOIN keys USING (instrument_id, source_id, record_date)) WHERE rn = 1""")
def price_tombstones(spark, folder):
    """Tombstones for every date on which a series closed above 520."""
    rows = driver.event_prices(spark, folder)
    marked = prices.price_tombstones(rows, rows.where("close_price > 520"), LOADED)
    return marked.select(
        *IDS, day(), F.col("extra_indicators")["_deleted"].alias("deleted"), micros("system_date"),
        rounded("close_price"),
    )


@query(f"""WITH {EVENT_PRICES.replace("FROM events)", "FROM events WHERE ts <= TIMESTAMP '2024-01-15 12:00:00')")},
{daily_sql('ep')}
SELECT instrument_id, source_id, CAST(record_date AS VARCHAR) AS record_date,
       round(close_price, 6) AS close_price FROM ep_daily""")
def price_asof(spark, folder):
    """Daily prices as they were known at noon of January 15."""
    known = prices.known_at(driver.event_prices(spark, folder), datetime(2024, 1, 15, 12, tzinfo=timezone.utc))
    return prices.latest_daily_prices(known).select(*IDS, day(), rounded("close_price"))


@query(f"""{EVENTS}, requests AS (
  SELECT DISTINCT instrument_id, source_id, record_date,
         epoch_us(CAST(record_date AS TIMESTAMP)) + 43200000000 AS known_us FROM ep)
SELECT r.instrument_id, r.source_id, CAST(r.record_date AS VARCHAR) AS record_date,
       r.known_us AS known_at_us, coalesce(ep.system_us, -1) AS system_date_us,
       round(ep.close_price, 6) AS close_price
FROM requests r ASOF LEFT JOIN ep
  ON r.instrument_id = ep.instrument_id AND r.source_id = ep.source_id AND r.record_date = ep.record_date
 AND r.known_us >= ep.system_us""")
def price_asof_requests(spark, folder):
    """What was known of each price at noon of its own day."""
    rows = driver.event_prices(spark, folder)
    noon = F.timestamp_seconds(F.unix_date("record_date").cast("bigint") * 86400 + 43200)
    requests = rows.select(*prices.PRICE_KEY).distinct().withColumn("known_at", noon)
    found = prices.prices_as_of(rows.select(*prices.PRICE_KEY, "system_date", "close_price"), requests)
    return found.select(*IDS, day(), micros("known_at"), micros("system_date"), rounded("close_price"))


@query(f"""{EVENTS}
SELECT instrument_id, source_id, system_us AS system_date_us, CAST(record_date AS VARCHAR) AS price_date,
       volume, close_price IS NULL AS no_close,
       round(coalesce(close_price, -1), 6) AS close_text
FROM ep""")
def price_json(spark, folder):
    """JSON price documents, read back field by field."""
    found = prices.price_json(driver.event_prices(spark, folder))
    field = lambda name: F.get_json_object("price_json", f"$.{name}")
    return found.select(
        *IDS, micros("system_date"), field("date").alias("price_date"), field("volume").cast("bigint").alias("volume"),
        field("close").isNull().alias("no_close"),
        F.round(F.coalesce(field("close").cast("double"), F.lit(-1.0)), 6).alias("close_text"),
    )


# ---- windows ----------------------------------------------------------------------------------------

@query(f"""{LINES_DAILY}
SELECT instrument_id, source_id, 7 AS window_days, CAST(record_date AS VARCHAR) AS record_date,
       round(close_price, 4) AS close_price, round(avg(close_price) OVER w, 4) AS rolling_avg_close,
       count(close_price) OVER w AS observation_count
FROM lp_daily
WINDOW w AS (PARTITION BY instrument_id, source_id ORDER BY record_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def rolling_avg_7(spark, folder):
    daily = prices.latest_daily_prices(driver.lineitem_prices(spark, folder))
    return rolling.rolling_average(daily, 7).select(
        *IDS, "window_days", day(), rounded("close_price", 4), rounded("rolling_avg_close", 4), "observation_count"
    )


@query(f"""{LINES_DAILY}
SELECT instrument_id, source_id, 5 AS window_days, CAST(record_date AS VARCHAR) AS record_date,
       round(avg(close_price) OVER w, 3) AS rolling_avg_close, count(close_price) OVER w AS observation_count
FROM lp_daily
WINDOW w AS (PARTITION BY instrument_id, source_id ORDER BY record_date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def rolling_job_table(spark, folder):
    """All prices appended to the price table, the rolling job run on it, its table read back."""
    root = scratch_path(spark, "rolling-job")
    tables.append(driver.lineitem_prices(spark, folder).withColumn("ingested_at", F.col("system_date")), root, "prices")
    rolling_average_job(spark, root, 5)
    return tables.scan(spark, root, "rolling_averages").select(
        F.col("instrument_id").cast("bigint").alias("instrument_id"), "source_id", "window_days", day(),
        rounded("rolling_avg_close", 3), "observation_count",
    )


@query(f"""{LINES} SELECT instrument_id, source_id, CAST(record_date AS VARCHAR) AS record_date, system_us AS system_date_us,
       round(close_price, 4) AS close_price, volume FROM lp WHERE instrument_id = 1 AND source_id = 'O' AND year(record_date) = 1998""")
def price_partition(spark, folder):
    """All versions of one series in one year."""
    found = prices.partition_scan(driver.lineitem_prices(spark, folder), 1, "O", 1998)
    return found.select(*IDS, day(), micros("system_date"), rounded("close_price", 4), "volume")


@query(f"""{EVENTS_DAILY}
SELECT instrument_id, source_id, 7 AS window_days, CAST(record_date AS VARCHAR) AS record_date,
       round(close_price, 6) AS close_price, round(avg(close_price) OVER w, 6) AS rolling_avg_close,
       count(close_price) OVER w AS observation_count
FROM ep_daily
WINDOW w AS (PARTITION BY instrument_id, source_id ORDER BY record_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
def rolling_avg_7_events(spark, folder):
    daily = prices.latest_daily_prices(driver.event_prices(spark, folder))
    return rolling.rolling_average(daily, 7).select(
        *IDS, "window_days", day(), rounded("close_price"), rounded("rolling_avg_close"), "observation_count"
    )


@query(f"""{LINES_DAILY}
SELECT instrument_id, source_id, 30 AS window_days, CAST(record_date AS VARCHAR) AS record_date,
       round(close_price, 4) AS close_price, round(avg(close_price) OVER w, 4) AS rolling_avg_close,
       count(close_price) OVER w AS observation_count
FROM lp_daily WHERE record_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
WINDOW w AS (PARTITION BY instrument_id, source_id ORDER BY record_date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")
def rolling_avg_30_range(spark, folder):
    """Thirty observations, warming up anew at the start of the range."""
    part = prices.filter_price_history(
        prices.latest_daily_prices(driver.lineitem_prices(spark, folder)),
        start_date=date(1996, 1, 1), end_date=date(1998, 12, 31),
    )
    return rolling.rolling_average(part, 30).select(
        *IDS, "window_days", day(), rounded("close_price", 4), rounded("rolling_avg_close", 4), "observation_count"
    )


@query(f"""{LINES_DAILY}
SELECT instrument_id, source_id, CAST(record_date AS VARCHAR) AS record_date, round(close_price, 4) AS close_price,
       round(avg(close_price) OVER (s ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS rolling_avg_7,
       round(avg(close_price) OVER (s ROWS BETWEEN 29 PRECEDING AND CURRENT ROW), 4) AS rolling_avg_30,
       round(avg(close_price) OVER (s ROWS BETWEEN 89 PRECEDING AND CURRENT ROW), 4) AS rolling_avg_90,
       count(*) OVER (s ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS observations_7,
       count(*) OVER (s ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS observations_30,
       count(*) OVER (s ROWS BETWEEN 89 PRECEDING AND CURRENT ROW) AS observations_90
FROM lp_daily WINDOW s AS (PARTITION BY instrument_id, source_id ORDER BY record_date)""")
def rolling_avg_several(spark, folder):
    daily = prices.latest_daily_prices(driver.lineitem_prices(spark, folder))
    windows = (7, 30, 90)
    return rolling.rolling_averages(daily, windows).select(
        *IDS, day(), rounded("close_price", 4), *(rounded(f"rolling_avg_{n}", 4) for n in windows),
        *(f"observations_{n}" for n in windows),
    )


# ---- metrics ----------------------------------------------------------------------------------------

def _aggregates_sql(source: str, digits: int) -> str:
    return f"""
SELECT instrument_id, source_id, count(*) AS count, round(min(close_price), {digits}) AS min_close,
       round(max(close_price), {digits}) AS max_close, round(avg(close_price), {digits}) AS avg_close,
       CAST(coalesce(sum(volume), 0) AS DOUBLE) AS total_volume
FROM {source} GROUP BY ALL"""


def _aggregates(frame: DataFrame, digits: int) -> DataFrame:
    return frame.select(
        *IDS, "count", *(rounded(c, digits) for c in ("min_close", "max_close", "avg_close")),
        F.col("total_volume").cast("double").alias("total_volume"),
    )


@query(LINES + _aggregates_sql("lp", 4))
def aggregates_all(spark, folder):
    return _aggregates(metrics.aggregates(driver.lineitem_prices(spark, folder)), 4)


@query(EVENTS + _aggregates_sql("ep", 6))
def aggregates_with_gaps(spark, folder):
    """Rows without a close count as rows only."""
    return _aggregates(metrics.aggregates(driver.event_prices(spark, folder)), 6)


@query(EVENTS_DAILY + _aggregates_sql("ep_daily", 6))
def aggregates_latest(spark, folder):
    return _aggregates(metrics.aggregates(driver.event_prices(spark, folder), "latest"), 6)


@query(f"""{EVENTS}, g AS (SELECT instrument_id, source_id, count(*) AS n, avg(close_price) AS a, sum(volume) AS v
      FROM ep WHERE record_date >= DATE '2024-01-25' GROUP BY ALL)
SELECT instrument_id, source_id, coalesce(n, 0) AS count, round(a, 6) AS avg_close,
       CAST(coalesce(v, 0) AS BIGINT) AS total_volume
FROM (SELECT DISTINCT instrument_id, source_id FROM ep) LEFT JOIN g USING (instrument_id, source_id)""")
def aggregates_requested(spark, folder):
    """The last days of January for every series of the month; those without a row report zero."""
    rows = driver.event_prices(spark, folder)
    found = metrics.aggregates(prices.scan_range(rows, date(2024, 1, 25)), requested=rows)
    return found.select(*IDS, "count", rounded("avg_close"), "total_volume")


def _trend_sql(rows: str, order: str, series: str | None = None) -> str:
    return f"""
, o AS (SELECT *, row_number() OVER (PARTITION BY instrument_id, source_id ORDER BY {order}) AS a,
               count(*) OVER (PARTITION BY instrument_id, source_id) AS n
        FROM {rows} WHERE close_price IS NOT NULL),
e AS (SELECT instrument_id, source_id, max(n) AS n, max(CASE WHEN a = 1 THEN close_price END) AS s,
             max(CASE WHEN a = n THEN close_price END) AS e FROM o GROUP BY ALL),
series AS (SELECT DISTINCT instrument_id, source_id FROM {series or rows})
SELECT instrument_id, source_id,
       CASE WHEN n >= 2 AND e > s THEN 'up' WHEN n >= 2 AND e < s THEN 'down' ELSE 'flat' END AS direction,
       round(CASE WHEN n >= 2 THEN s END, 6) AS start_close, round(CASE WHEN n >= 2 THEN e END, 6) AS end_close,
       round(CASE WHEN n >= 2 THEN e - s END, 6) AS change,
       round(CASE WHEN n >= 2 AND s <> 0 THEN (e - s) / s * 100 END, 6) AS change_pct
FROM series LEFT JOIN e USING (instrument_id, source_id)"""


def _trend(frame: DataFrame) -> DataFrame:
    numbers = ("start_close", "end_close", "change", "change_pct")
    return frame.select(*IDS, "direction", *(rounded(c) for c in numbers))


@query(EVENTS + _trend_sql("ep", "record_date, system_us DESC"))
def trend(spark, folder):
    return _trend(metrics.trend(driver.event_prices(spark, folder)))


#: Prices of the last days of January; series of the month without any are requested too.
LATE = EVENTS + ", late AS (SELECT * FROM ep WHERE record_date >= DATE '2024-01-25')"
LATE_START = date(2024, 1, 25)


@query(LATE + _trend_sql("late", "record_date, system_us DESC", "ep"))
def trend_requested(spark, folder):
    rows = driver.event_prices(spark, folder)
    return _trend(metrics.trend(prices.scan_range(rows, LATE_START), requested=rows))


@query(LATE + """, o AS (
  SELECT *, row_number() OVER (PARTITION BY instrument_id, source_id ORDER BY record_date DESC, system_us) AS b
  FROM late WHERE close_price IS NOT NULL)
SELECT instrument_id, source_id, 'naive_last_close' AS method, round(o.close_price, 6) AS predicted_next_close
FROM (SELECT DISTINCT instrument_id, source_id FROM ep)
LEFT JOIN (SELECT * FROM o WHERE b = 1) o USING (instrument_id, source_id)""")
def forecast_requested(spark, folder):
    rows = driver.event_prices(spark, folder)
    found = metrics.forecast(prices.scan_range(rows, LATE_START), requested=rows)
    return found.select(*IDS, "method", rounded("predicted_next_close"))


@query(EVENTS_DAILY + _trend_sql("ep_daily", "record_date"))
def trend_latest(spark, folder):
    return _trend(metrics.trend(driver.event_prices(spark, folder), "latest"))


@query(f"""{EVENTS}, o AS (
  SELECT *, row_number() OVER (PARTITION BY instrument_id, source_id ORDER BY record_date DESC, system_us) AS b
  FROM ep WHERE close_price IS NOT NULL)
SELECT instrument_id, source_id, 'naive_last_close' AS method, round(o.close_price, 6) AS predicted_next_close
FROM (SELECT DISTINCT instrument_id, source_id FROM ep)
LEFT JOIN (SELECT * FROM o WHERE b = 1) o USING (instrument_id, source_id)""")
def forecast_last_close(spark, folder):
    found = metrics.forecast(driver.event_prices(spark, folder))
    return found.select(*IDS, "method", rounded("predicted_next_close"))


def _steps_sql(rows: str, order: str) -> str:
    return f"""
, steps AS (SELECT *, lag(close_price) OVER w AS p,
                  max(close_price) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS peak
           FROM {rows} WHERE close_price IS NOT NULL
           WINDOW w AS (PARTITION BY instrument_id, source_id ORDER BY {order}))"""


@query(LINES + _steps_sql("lp", "record_date, system_us DESC") + """
SELECT instrument_id, source_id, CAST(record_date AS VARCHAR) AS record_date, system_us AS system_date_us,
       round(close_price, 4) AS close_price, round(p, 4) AS previous_close,
       round((close_price - p) / p * 100, 6) AS return_pct
FROM steps WHERE p <> 0""")
def returns(spark, folder):
    found = metrics.returns(driver.lineitem_prices(spark, folder))
    return found.select(
        *IDS, day(), micros("system_date"), rounded("close_price", 4), rounded("previous_close", 4),
        rounded("return_pct"),
    )


@query(EVENTS_DAILY + _steps_sql("ep_daily", "record_date") + """
SELECT instrument_id, source_id, CAST(record_date AS VARCHAR) AS record_date, round(close_price, 6) AS close_price,
       round(p, 6) AS previous_close, round((close_price - p) / p * 100, 6) AS return_pct
FROM steps WHERE p <> 0""")
def returns_latest(spark, folder):
    found = metrics.returns(driver.event_prices(spark, folder), "latest")
    return found.select(*IDS, day(), rounded("close_price"), rounded("previous_close"), rounded("return_pct"))


def _risk_sql(rows: str, digits: int, series: str | None = None) -> str:
    return f"""
, m AS (SELECT instrument_id, source_id, count(*) AS n, avg(CASE WHEN p <> 0 THEN abs((close_price - p) / p * 100) END) AS v,
               greatest(CAST(0 AS DOUBLE), max(CASE WHEN peak <> 0 THEN (peak - close_price) / peak * 100 END)) AS d
        FROM steps GROUP BY ALL),
r AS (SELECT series.instrument_id, series.source_id, coalesce(n, 0) AS n, v, d,
             CASE WHEN coalesce(n, 0) < 2 THEN 'insufficient_data'
                  WHEN round(coalesce(v, 0), 10) >= 3 OR round(d, 10) >= 15 THEN 'high'
                  WHEN round(coalesce(v, 0), 10) >= 1 OR round(d, 10) >= 5 THEN 'medium' ELSE 'low' END AS signal
      FROM (SELECT DISTINCT instrument_id, source_id FROM {series or rows}) series LEFT JOIN m USING (instrument_id, source_id))
SELECT instrument_id, source_id, signal, round(CASE WHEN n >= 2 THEN v END, {digits}) AS volatility_pct,
       round(CASE WHEN n >= 2 THEN d END, {digits}) AS max_drawdown_pct,
       CASE WHEN n < 2 THEN 'Need at least two close values to estimate risk.'
            ELSE printf('Risk is %s (volatility=%.2f%%, max_drawdown=%.2f%%).', signal, coalesce(v, 0), d) END AS summary
FROM r"""


def _risk(frame: DataFrame, digits: int) -> DataFrame:
    return frame.select(
        *IDS, "signal", rounded("volatility_pct", digits), rounded("max_drawdown_pct", digits), "summary"
    )


@query(EVENTS + _steps_sql("ep", "record_date, system_us DESC") + _risk_sql("ep", 6))
def risk_signal(spark, folder):
    return _risk(metrics.risk_signal(driver.event_prices(spark, folder)), 6)


@query(LATE + _steps_sql("late", "record_date, system_us DESC") + _risk_sql("late", 6, "ep"))
def risk_requested(spark, folder):
    rows = driver.event_prices(spark, folder)
    return _risk(metrics.risk_signal(prices.scan_range(rows, LATE_START), requested=rows), 6)


@query(EVENTS_DAILY + _steps_sql("ep_daily", "record_date") + _risk_sql("ep_daily", 6))
def risk_signal_latest(spark, folder):
    return _risk(metrics.risk_signal(driver.event_prices(spark, folder), "latest"), 6)


@query(LINES + _steps_sql("lp", "record_date, system_us DESC") + _risk_sql("lp", 4))
def risk_signal_long(spark, folder):
    return _risk(metrics.risk_signal(driver.lineitem_prices(spark, folder)), 4)


@query(f"""{EVENTS}, g AS (
  SELECT instrument_id, source_id, count(*) AS n, avg(close_price) AS a FROM ep GROUP BY ALL)
SELECT a.source_id, a.instrument_id AS instrument_a_id, a.instrument_id + 1 AS instrument_b_id,
       a.n AS instrument_a_count, coalesce(b.n, 0) AS instrument_b_count, round(a.a, 6) AS instrument_a_avg_close,
       round(b.a, 6) AS instrument_b_avg_close, round(a.a - b.a, 6) AS avg_close_diff
FROM g a LEFT JOIN g b ON a.source_id = b.source_id AND a.instrument_id + 1 = b.instrument_id""")
def compare_pairs(spark, folder):
    """Each instrument against the next one of its source."""
    rows = driver.event_prices(spark, folder)
    pairs = rows.select(
        "source_id", F.col("instrument_id").alias("instrument_a_id"), (F.col("instrument_id") + 1).alias("instrument_b_id")
    ).distinct()
    found = metrics.compare_pairs(rows, pairs)
    averages = ("instrument_a_avg_close", "instrument_b_avg_close", "avg_close_diff")
    return found.select(
        "source_id", "instrument_a_id", "instrument_b_id", "instrument_a_count", "instrument_b_count",
        *(rounded(c) for c in averages),
    )


def _report(spark: SparkSession, folder: str) -> DataFrame:
    rows = driver.event_prices(spark, folder)
    return metrics.metrics_report(rows, date(2024, 1, 3), date(2024, 1, 28))


def _whole_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report from the first date of the table to its last."""
    rows = driver.event_prices(spark, folder)
    return metrics.metrics_report(rows, *rows.agg(F.min("record_date"), F.max("record_date")).first())


EVENTS_REPORT = EVENTS + """
, part AS (SELECT * FROM ep WHERE record_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28')""" + _steps_sql(
    "part", "record_date, system_us DESC"
) + """
, o AS (SELECT instrument_id, source_id, close_price,
               row_number() OVER (PARTITION BY instrument_id, source_id ORDER BY record_date, system_us DESC) AS a,
               row_number() OVER (PARTITION BY instrument_id, source_id ORDER BY record_date DESC, system_us) AS b
        FROM part WHERE close_price IS NOT NULL),
g AS (SELECT instrument_id, source_id, count(*) AS n, count(close_price) AS closes, avg(close_price) AS mean,
             CAST(sum(volume) AS BIGINT) AS volume FROM part GROUP BY ALL),
m AS (SELECT instrument_id, source_id, avg(abs((close_price - p) / p * 100)) AS v,
             greatest(CAST(0 AS DOUBLE), max((peak - close_price) / peak * 100)) AS d FROM steps GROUP BY ALL),
r AS (SELECT g.*, f.close_price AS s, l.close_price AS e, m.v, m.d,
             CASE WHEN closes < 2 THEN 'insufficient_data' WHEN round(v, 10) >= 3 OR round(d, 10) >= 15 THEN 'high'
                  WHEN round(v, 10) >= 1 OR round(d, 10) >= 5 THEN 'medium' ELSE 'low' END AS signal,
             CASE WHEN closes >= 2 AND l.close_price > f.close_price THEN 'up'
                  WHEN closes >= 2 AND l.close_price < f.close_price THEN 'down' ELSE 'flat' END AS direction
      FROM g LEFT JOIN (SELECT * FROM o WHERE a = 1) f USING (instrument_id, source_id)
             LEFT JOIN (SELECT * FROM o WHERE b = 1) l USING (instrument_id, source_id)
             LEFT JOIN m USING (instrument_id, source_id))"""

WHOLE_REPORT = EVENTS_REPORT.replace(" WHERE record_date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'", "")


@query(EVENTS_REPORT + """
SELECT instrument_id, source_id, '2024-01-03' AS start_date, '2024-01-28' AS end_date, n AS count,
       round(mean, 6) AS avg_close, volume AS total_volume, direction,
       round(CASE WHEN closes >= 2 THEN e - s END, 6) AS change,
       'naive_last_close' AS method, round(e, 6) AS predicted_next_close, signal,
       round(CASE WHEN closes >= 2 THEN v END, 6) AS volatility_pct,
       round(CASE WHEN closes >= 2 THEN d END, 6) AS max_drawdown_pct
FROM r""")
def metrics_report(spark, folder):
    return _report(spark, folder).select(
        *IDS, day("start_date"), day("end_date"), "count", rounded("avg_close"), "total_volume", "direction",
        rounded("change"), "method", rounded("predicted_next_close"), "signal", rounded("volatility_pct"),
        rounded("max_drawdown_pct"),
    )


# ---- instruments ------------------------------------------------------------------------------------

@query(f"{CURRENT} SELECT * FROM live")
def instrument_current(spark, folder):
    return shown_instruments(current(spark, folder))


@query(f"{CURRENT} SELECT * FROM live WHERE instrument_id = 42")
def instrument_one(spark, folder):
    return shown_instruments(instruments.instrument_by_id(current(spark, folder), 42))


@query(f"{CURRENT} SELECT instrument_id, symbol, instrument_class, name, region FROM live ORDER BY instrument_id LIMIT 1000")
def instrument_summaries(spark, folder):
    return instruments.instrument_summaries(current(spark, folder))


@query(f"""{CURRENT} SELECT symbol_key, instrument_id, created_us FROM (
  SELECT *, upper(trim(symbol)) AS symbol_key, row_number() OVER (
    PARTITION BY upper(trim(symbol)) ORDER BY created_us DESC, instrument_id) AS rn FROM live) WHERE rn = 1""")
def instrument_by_symbol(spark, folder):
    found = instruments.instruments_by_symbol(current(spark, folder))
    return found.select("symbol_key", "instrument_id", micros("created_at", "created_us"))


@query("""SELECT c_custkey AS instrument_id, c_name AS symbol, c_mktsegment AS instrument_class, c_name AS name,
       n_name AS region FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey WHERE c_mktsegment = 'MACHINERY'""")
def instrument_by_class(spark, folder):
    return instruments.summaries_of_class(driver.instruments(spark, folder), "MACHINERY")


@query(f"""WITH {VERSIONS} SELECT c_custkey AS instrument_id, coalesce(o_orderstatus = 'P', false) AS is_deleted
FROM customer LEFT JOIN newest ON o_custkey = c_custkey""")
def instrument_deleted_flag(spark, folder):
    return instruments.deleted_flags(driver.instruments(spark, folder), driver.instrument_versions(spark, folder))


@query(f"""WITH {VERSIONS} SELECT o_custkey AS instrument_id, o_orderkey AS version_id,
  CASE WHEN o_orderstatus = 'P' THEN 'delete_marker' ELSE 'update' END AS change_type,
  epoch_us(o_orderdate) AS valid_from_us,
  coalesce(epoch_us(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate)), -1) AS valid_to_us
FROM v""")
def instrument_history(spark, folder):
    found = instruments.version_history(driver.instrument_versions(spark, folder))
    return found.select("instrument_id", "version_id", "change_type", micros("valid_from"), micros("valid_to"))


@query(f"""WITH {VERSIONS} SELECT o_custkey AS instrument_id, o_orderkey AS version_id, epoch_us(o_orderdate) AS valid_from_us
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rk FROM v) WHERE rk <= 3""")
def instrument_newest_versions(spark, folder):
    found = instruments.newest_versions(driver.instrument_versions(spark, folder), 3)
    return found.select("instrument_id", "version_id", micros("valid_from"))


@query(f"""WITH {VERSIONS}, requests AS (
  SELECT o_custkey AS k, o_orderdate + INTERVAL 30 DAY AS known_at FROM orders)
SELECT c_custkey AS instrument_id, epoch_us(known_at) AS known_at_us, {described_sql('v')}
FROM requests ASOF LEFT JOIN v ON k = v.o_custkey AND known_at >= v.o_orderdate
JOIN customer ON c_custkey = k LEFT JOIN nation ON n_nationkey = c_nationkey
WHERE coalesce(v.o_orderstatus, '') <> 'P'""")
def instrument_as_of(spark, folder):
    """Each instrument as it was thirty days after each of its orders."""
    versions = driver.instrument_versions(spark, folder)
    requests = versions.select("instrument_id", (F.col("valid_from") + F.expr("interval 30 days")).alias("known_at"))
    found = instruments.instruments_as_of(driver.instruments(spark, folder), versions, requests)
    return shown_instruments(found, micros("known_at"))


PATCHES = """patches AS (
  SELECT o_custkey AS k, epoch_us(o_orderdate) + o_orderkey AS patched_us,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'P' || CAST(o_orderkey AS VARCHAR) WHEN '2-HIGH' THEN '' END AS symbol,
         CASE o_orderpriority WHEN '2-HIGH' THEN 'name of ' || CAST(o_orderkey AS VARCHAR) END AS name,
         CASE o_orderstatus WHEN 'F' THEN '' WHEN 'O' THEN CAST(o_orderkey AS VARCHAR) END AS description
  FROM orders)"""


def _patches(spark: SparkSession, folder: str) -> DataFrame:
    o = driver.table(spark, folder, "orders")
    key = F.col("o_orderkey").cast("string")
    urgent, high = F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority") == "2-HIGH"
    return o.select(
        F.col("o_custkey").alias("instrument_id"),
        F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey")).alias("patched_at"),
        F.when(urgent, F.concat(F.lit("P"), key)).when(high, F.lit("")).alias("symbol"),
        F.when(high, F.concat(F.lit("name of "), key)).alias("name"),
        F.when(F.col("o_orderstatus") == "F", F.lit("")).when(F.col("o_orderstatus") == "O", key).alias("description"),
    )


@query(f"""{CURRENT}, {PATCHES}, folded AS (
  SELECT k, patched_us, last_value(nullif(symbol, '') IGNORE NULLS) OVER w AS s,
         last_value(nullif(name, '') IGNORE NULLS) OVER w AS n, last_value(description IGNORE NULLS) OVER w AS d
  FROM patches WINDOW w AS (PARTITION BY k ORDER BY patched_us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT instrument_id, coalesce(s, symbol) AS symbol, instrument_class, coalesce(n, name) AS name, region, currency,
       coalesce(d, description) AS description, patched_us AS created_us
FROM folded JOIN live ON instrument_id = k""")
def instrument_patch(spark, folder):
    """Every order patches its customer's instrument, in the order of time."""
    updated, _ = instruments.patch_instruments(_patches(spark, folder), current(spark, folder))
    return shown_instruments(updated)


@query(f"""{CURRENT}, {PATCHES}
SELECT k AS instrument_id, patched_us AS patched_at_us FROM patches WHERE k NOT IN (SELECT instrument_id FROM live)""")
def instrument_patch_rejects(spark, folder):
    _, rejected = instruments.patch_instruments(_patches(spark, folder), current(spark, folder))
    return rejected.select("instrument_id", micros("patched_at"))


@query(f"""{CURRENT}
SELECT l_partkey AS instrument_id, CASE WHEN c_custkey IS NULL THEN 'create' ELSE 'update' END AS change_type,
       epoch_us(l_shipdate) AS valid_from_us, false AS is_delete_marker, 'part ' || CAST(l_partkey AS VARCHAR) AS name
FROM (SELECT l_partkey, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY 1)
LEFT JOIN customer ON c_custkey = l_partkey""")
def instrument_save(spark, folder):
    """Saving an instrument per part: an update where a customer has the id already, else a creation."""
    li = driver.table(spark, folder, "lineitem")
    entities = li.groupBy(F.col("l_partkey").alias("instrument_id")).agg(
        F.max("l_shipdate").cast("timestamp").alias("created_at")
    ).select(
        "instrument_id", F.concat(F.lit("PART"), "instrument_id").alias("symbol"), F.lit("stock").alias("instrument_class"),
        F.concat(F.lit("part "), "instrument_id").alias("name"), F.lit("US").alias("region"), F.lit("USD").alias("currency"),
        F.lit(None).cast("string").alias("exchange_id"), F.lit(None).cast("string").alias("description"), "created_at",
    )
    _, versions = instruments.save_instruments(entities, driver.instruments(spark, folder))
    return versions.select(
        "instrument_id", "change_type", micros("valid_from"), "is_delete_marker",
        F.get_json_object("snapshot", "$.name").alias("name"),
    )


@query(f"""{CURRENT}
SELECT o_custkey AS instrument_id, 'delete_marker' AS change_type, true AS is_delete_marker,
       epoch_us(o_orderdate) AS valid_from_us
FROM orders WHERE o_custkey IN (SELECT instrument_id FROM live)""")
def instrument_delete(spark, folder):
    """Delete requests at every order's time; only live instruments accept them."""
    base = driver.instruments(spark, folder)
    requests = driver.instrument_versions(spark, folder).select("instrument_id", "valid_from")
    live, _ = instruments.split_delete_requests(requests, current(spark, folder))
    markers = instruments.delete_markers(live, base, LOADED)
    return markers.select("instrument_id", "change_type", "is_delete_marker", micros("valid_from"))


@query(f"""{CURRENT}, known AS (SELECT symbol_key, instrument_id FROM (
  SELECT *, upper(trim(symbol)) AS symbol_key, row_number() OVER (
    PARTITION BY upper(trim(symbol)) ORDER BY created_us DESC, instrument_id) AS rn FROM live) WHERE rn = 1)
SELECT p_partkey AS request_order, coalesce(known.instrument_id, -1) AS instrument_id, known.symbol_key IS NULL AS created
FROM part LEFT JOIN known ON known.symbol_key = 'SYM' || CAST(p_partkey % 700 AS VARCHAR)""")
def instrument_resolve(spark, folder):
    """Symbols asked for by part: some name a live instrument, the others get a new one."""
    requests = driver.table(spark, folder, "part").select(
        F.concat(F.lit("Sym"), F.col("p_partkey") % 700).alias("symbol"), F.col("p_partkey").alias("request_order")
    )
    resolved, created = instruments.resolve_instruments(requests, current(spark, folder), LOADED)
    fresh = created.select("instrument_id", F.lit(True).alias("created"))
    return resolved.join(fresh, "instrument_id", "left").select(
        "request_order",
        F.when(F.col("created"), F.lit(-1)).otherwise(F.col("instrument_id")).alias("instrument_id"),
        F.coalesce("created", F.lit(False)).alias("created"),
    )


@query("""SELECT n_nationkey AS source_id, n_name AS source_name, r_name AS source_type
FROM nation LEFT JOIN region ON r_regionkey = n_regionkey ORDER BY 1 LIMIT 1000""")
def source_summaries(spark, folder):
    return instruments.source_summaries(driver.data_sources(spark, folder))


# ---- tables -----------------------------------------------------------------------------------------

@query(f"""WITH {VERSIONS} SELECT o_custkey AS instrument_id, epoch_us(o_orderdate) AS valid_from_us,
  o_orderkey AS version_id FROM v""")
def upsert_last_write(spark, folder):
    rows = driver.instrument_versions(spark, folder)
    kept = tables.last_write(rows, ("instrument_id", "valid_from"), F.col("version_id"))
    return kept.select("instrument_id", micros("valid_from"), "version_id")


PORTFOLIO_WRITES = """orders_by AS (SELECT o_custkey, max(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F' GROUP BY 1)"""


@query(f"""WITH {PORTFOLIO_WRITES}
SELECT CAST(c_nationkey AS VARCHAR) AS owner_id, CAST(c_custkey AS VARCHAR) AS portfolio_id,
       CASE WHEN k IS NULL THEN c_name ELSE 'renamed by ' || CAST(k AS VARCHAR) END AS name, k IS NULL AS is_active
FROM customer LEFT JOIN orders_by ON o_custkey = c_custkey
WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA')""")
def table_upsert_and_delete(spark, folder):
    """Portfolios written to a table, renamed by key through later writes, then deleted by owner."""
    root = scratch_path(spark, "portfolios")
    customers = driver.table(spark, folder, "customer").select(
        F.col("c_nationkey").alias("owner_id"), F.col("c_custkey").alias("portfolio_id"), F.col("c_name").alias("name"),
        F.lit("USD").alias("base_currency"), F.lit(True).alias("is_active"),
    )
    tables.upsert(spark, root, "portfolios", customers)
    filled = driver.table(spark, folder, "orders").where(F.col("o_orderstatus") == "F")
    renames = filled.join(customers, F.col("o_custkey") == F.col("portfolio_id")).select(
        "owner_id", "portfolio_id", F.concat(F.lit("renamed by "), "o_orderkey").alias("name"), "base_currency",
        F.lit(False).alias("is_active"), F.col("o_orderkey").alias("written"),
    )
    tables.upsert(spark, root, "portfolios", renames, F.col("written"))
    asian = driver.data_sources(spark, folder).where(F.col("source_type") == "ASIA")
    tables.delete(spark, root, "portfolios", asian.select(F.col("source_id").cast("string").alias("owner_id")))
    return tables.scan(spark, root, "portfolios").select("owner_id", "portfolio_id", "name", "is_active")


LOG = """log AS (SELECT * FROM (
  SELECT l_suppkey AS source_id, year(l_shipdate) AS log_year, epoch_us(l_shipdate) AS ingested_at_us,
         l_orderkey * 8 + l_linenumber AS log_id, l_partkey AS instrument_id,
         CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'success' END AS status,
         CAST(l_quantity AS BIGINT) AS record_count,
         row_number() OVER (PARTITION BY l_suppkey, l_shipdate
                            ORDER BY l_orderkey * 8 + l_linenumber DESC, l_partkey DESC) AS rn
  FROM lineitem) WHERE rn = 1)"""


def _log(spark: SparkSession, folder: str) -> DataFrame:
    rows = driver.ingest_log(spark, folder)
    return tables.last_write(rows, ("source_id", "log_year", "ingested_at"), F.col("log_id"), F.col("instrument_id"))


@query(f"""WITH {LOG} SELECT source_id, log_year, ingested_at_us, log_id, status, record_count FROM (
  SELECT *, row_number() OVER (PARTITION BY source_id, log_year ORDER BY ingested_at_us DESC) AS rk FROM log) WHERE rk = 1""")
def latest_by_key(spark, folder):
    """The newest log row of every source and year."""
    found = tables.latest(_log(spark, folder), "ingest_log")
    return found.select("source_id", "log_year", micros("ingested_at"), "log_id", "status", "record_count")


@query(f"""WITH {LOG} SELECT source_id, ingested_at_us, log_id, status, record_count FROM (
  SELECT *, row_number() OVER (PARTITION BY source_id ORDER BY ingested_at_us DESC, log_id) AS rk
  FROM log WHERE log_year = 1998) WHERE rk <= 50""")
def recent_load_log(spark, folder):
    found = audit.recent_load_log_per_source(_log(spark, folder), year=1998)
    return found.select("source_id", micros("ingested_at"), "log_id", "status", "record_count")


JOB_STATES = """WITH e AS (
  SELECT CAST(o_custkey AS VARCHAR) AS job_id, epoch_us(o_orderdate) + o_orderkey AS t, o_orderkey, o_orderpriority AS symbol,
         CASE o_orderstatus WHEN 'O' THEN 'running' WHEN 'F' THEN 'completed' ELSE 'failed' END AS status FROM orders),
g AS (SELECT job_id, max(t) AS last_t, min(t) AS queued_at_us, min(CASE WHEN status = 'running' THEN t END) AS started,
             max(CASE WHEN status <> 'running' THEN t END) AS done FROM e GROUP BY 1)
SELECT g.job_id, e.symbol, e.status, queued_at_us, coalesce(started, -1) AS started_at_us,
       CASE WHEN e.status = 'running' THEN -1 ELSE done END AS completed_at_us,
       CASE WHEN e.status = 'completed' THEN o_orderkey % 1000 ELSE -1 END AS record_count,
       CASE WHEN e.status = 'failed' THEN 'order ' || CAST(o_orderkey AS VARCHAR) END AS error_message
FROM g JOIN e ON g.job_id = e.job_id AND g.last_t = e.t"""


def _job_states(frame: DataFrame) -> DataFrame:
    return frame.select(
        "job_id", "symbol", "status", micros("queued_at"), micros("started_at"), micros("completed_at"),
        F.coalesce("record_count", F.lit(-1)).alias("record_count"), "error_message",
    )


@query(JOB_STATES)
def job_latest_state(spark, folder):
    return _job_states(audit.job_states(driver.job_events(spark, folder)))


# ---- feed -------------------------------------------------------------------------------------------

def _records(spark: SparkSession, folder: str) -> DataFrame:
    pages = feed.parse_pages(driver.feed_documents(spark, folder), "document")
    return _with_suppliers(spark, folder, feed.page_records(pages))


def _with_suppliers(spark: SparkSession, folder: str, records: DataFrame) -> DataFrame:
    symbols = driver.table(spark, folder, "supplier").select(
        normal_symbol(F.col("s_name")).alias("symbol_key"), F.col("s_suppkey").alias("instrument_id")
    )
    records = records.withColumn("symbol_key", normal_symbol(F.col("record")["ticker"]))
    return records.join(symbols, "symbol_key", "left").drop("symbol_key")


def _transformed(spark: SparkSession, folder: str) -> DataFrame:
    return ingest.transform_records(_records(spark, folder), LOADED)


@query("""SELECT l_linestatus AS source_id, l_orderkey || '-' || l_linenumber || '-' || l_partkey AS page, 0 AS position,
       'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS ticker, 5 AS fields,
       round(l_extendedprice, 2) AS close_value FROM lineitem
UNION ALL
SELECT l_linestatus, l_orderkey || '-' || l_linenumber || '-' || l_partkey, 1,
       'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0'), 1, -1 FROM lineitem WHERE l_linenumber = 7""")
def feed_records(spark, folder):
    """Name-to-text records of landed pages, with short rows and a repeated column."""
    pages = feed.parse_pages(driver.feed_documents(spark, folder), "document")
    record = F.col("record")
    return feed.page_records(pages).select(
        "source_id", "page", "position", record["ticker"].alias("ticker"), F.size(record).alias("fields"),
        F.coalesce(record["close"].cast("double"), F.lit(-1.0)).alias("close_value"),
    )


@query(f"""SELECT l_suppkey AS instrument_id, l_linestatus AS source_id, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS record_date,
       year(l_shipdate) AS record_year, round(l_extendedprice, 2) AS close_price, CAST(l_quantity AS BIGINT) AS volume,
       CASE WHEN l_discount = 0 THEN 'None' ELSE l_returnflag END AS flag, CAST({LOADED_US} AS BIGINT) AS system_date_us
FROM lineitem""")
def feed_casts(spark, folder):
    """Typed price rows of the feed, with the field that the map does not know."""
    return ingest.accepted(_transformed(spark, folder)).select(
        *IDS, day(), "record_year", rounded("close_price", 2), "volume",
        F.col("extra_indicators")["flag"].alias("flag"), micros("system_date"),
    )


@query("""SELECT l_linestatus AS source_id, l_suppkey AS instrument_id,
  'Row transform error: Row is missing required ''date'' field: {"ticker":"Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0')
  || '"}' AS error_message, count(*) AS rows
FROM lineitem WHERE l_linenumber = 7 GROUP BY ALL""")
def feed_rejects(spark, folder):
    rejected = ingest.load_errors(_transformed(spark, folder))
    return rejected.groupBy("source_id", "instrument_id", "error_message").agg(F.count(F.lit(1)).alias("rows"))


@query("""SELECT CASE WHEN l_discount = 0 THEN 'None' ELSE l_returnflag END AS flag, l_linestatus AS source_id, count(*) AS rows
FROM lineitem GROUP BY ALL""")
def extra_indicators(spark, folder):
    """What the unknown field holds, over all accepted rows."""
    extra = ingest.accepted(_transformed(spark, folder)).select("source_id", F.explode("extra_indicators").alias("name", "flag"))
    return extra.groupBy("flag", "source_id").agg(F.count(F.lit(1)).alias("rows"))


@query("""SELECT DISTINCT l_linestatus AS source_id, 'close,date,flag,ticker,volume' AS attributes FROM lineitem""")
def observed_columns(spark, folder):
    found = ingest.observed_columns(_records(spark, folder))
    return found.select("source_id", F.array_join("attributes", ",").alias("attributes"))


FEED_LOG = """g AS (
  SELECT l_linestatus AS source_id, l_suppkey AS instrument_id, count(*) AS stored,
         count(*) FILTER (l_linenumber = 7) AS skipped FROM lineitem GROUP BY ALL),
shown AS (SELECT *, CASE WHEN skipped > 0 THEN skipped || ' rows without date' END AS error_message FROM g)"""


@query(f"""WITH {FEED_LOG}
SELECT source_id, instrument_id, 2024 AS log_year, 'success' AS status, stored + skipped AS fetched, stored AS record_count,
       skipped, error_message FROM shown""")
def load_log(spark, folder):
    found = ingest.load_log(_transformed(spark, folder))
    return found.select(
        "source_id", "instrument_id", "log_year", "status", "fetched", "record_count", "skipped", "error_message"
    )


@query("""SELECT l_linestatus AS source_id, l_suppkey AS instrument_id, 'success' AS status, count(*) + count(*) FILTER (l_linenumber = 7) AS fetched,
       CASE WHEN count(*) FILTER (l_linenumber = 7) > 0 THEN count(*) FILTER (l_linenumber = 7) || ' rows without date' END AS error_message
FROM lineitem WHERE l_linenumber <> 6 GROUP BY ALL
UNION ALL
SELECT l_linestatus, NULL, 'error', 0, count(*) || ' pages could not be read' FROM lineitem WHERE l_linenumber = 6 GROUP BY ALL""")
def broken_pages_log(spark, folder):
    """The log of a feed whose sixth lines of an order are cut off."""
    cut = F.when(F.split("page", "-")[1] == "6", F.substring("document", 1, 40)).otherwise(F.col("document"))
    pages = feed.parse_pages(driver.feed_documents(spark, folder).withColumn("document", cut), "document")
    failures = feed.page_failures(pages).withColumn("ingested_at", F.lit(LOADED).cast("timestamp"))
    records = _with_suppliers(spark, folder, feed.page_records(pages))
    found = ingest.load_log(ingest.transform_records(records, LOADED), failures=failures)
    return found.select("source_id", "instrument_id", "status", "fetched", "error_message")


@query(f"""WITH {FEED_LOG}
SELECT source_id, instrument_id, CASE WHEN error_message IS NULL THEN 'completed' ELSE 'failed' END AS status,
       stored AS record_count, error_message FROM shown""")
def job_outcomes(spark, folder):
    found = ingest.job_outcomes(ingest.load_log(_transformed(spark, folder)))
    return found.select("source_id", "instrument_id", "status", "record_count", "error_message")


#: What a load keeps: the last row of every instrument, source and day, in page order.
LAST_OF_LOAD = """FROM lineitem QUALIFY row_number() OVER (
  PARTITION BY l_suppkey, l_linestatus, CAST(l_shipdate AS DATE)
  ORDER BY l_orderkey || '-' || l_linenumber || '-' || l_partkey DESC) = 1"""


@query(f"""SELECT l_linestatus AS source_id, l_suppkey AS instrument_id, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS record_date,
       round(l_extendedprice, 2) AS close_price, CAST(l_quantity AS BIGINT) AS volume {LAST_OF_LOAD}""")
def batch_feed_load(spark, folder):
    """A load written to the price table, and the table read back."""
    root = scratch_path(spark, "batch-load")
    load_records(spark, root, _records(spark, folder), LOADED, "first")
    loaded = tables.scan(spark, root, "prices")
    return loaded.select(
        "source_id", F.col("instrument_id").cast("bigint").alias("instrument_id"), day(), rounded("close_price", 2), "volume"
    )


@query("""SELECT l_linestatus AS source_id, count(DISTINCT l_suppkey) AS jobs, count(DISTINCT CASE WHEN l_linenumber = 7 THEN l_suppkey END) AS failed,
       'close,date,flag,ticker,volume' AS attributes FROM lineitem GROUP BY ALL""")
def load_leaves_jobs_and_sources(spark, folder):
    """What a load of an unknown source leaves: its jobs' states and the source with its columns."""
    root = scratch_path(spark, "load-states")
    records = _records(spark, folder)
    load_records(spark, root, records, LOADED, "first")
    named = records.select("source_id", "instrument_id").distinct().withColumn("job_id", stable_id(F.col("source_id"), F.col("instrument_id")))
    states = current_job_states(spark, root).join(named.drop("instrument_id"), "job_id").groupBy("source_id").agg(
        F.count("job_id").alias("jobs"), F.count_if(F.col("status") == "failed").alias("failed")
    )
    sources = tables.scan(spark, root, "data_sources").select("source_id", F.array_join("attributes", ",").alias("attributes"))
    return states.join(sources, "source_id")


@query(f"""SELECT l_linestatus AS source_id, 'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS symbol,
       CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS record_date, round(l_extendedprice, 2) AS close_price,
       CAST(l_quantity AS BIGINT) AS volume {LAST_OF_LOAD}""")
def stream_feed_load(spark, folder):
    """Landed pages loaded by the streaming job, read back with the instruments that it made."""
    landed, root, state = (scratch_path(spark, f"feed-{part}") for part in ("landed", "tables", "state"))
    # files and lines are in page order
    pages = driver.feed_documents(
        spark, folder, lambda rows: rows.repartitionByRange("source_id", "page").sortWithinPartitions("source_id", "page")
    )
    pages.select("source_id", F.col("document").alias("value")).write.partitionBy("source_id").text(landed, compression="gzip")
    start_feed_load(spark, landed, root, state).awaitTermination()
    names = tables.scan(spark, root, "financial_instruments").select("instrument_id", "symbol")
    return tables.scan(spark, root, "prices").join(names, "instrument_id").select(
        "source_id", "symbol", day(), rounded("close_price", 2), "volume"
    )


@query(JOB_STATES)
def stream_job_state(spark, folder):
    """Job events folded by the streaming job."""
    landed, root, state = (scratch_path(spark, f"jobs-{part}") for part in ("landed", "tables", "state"))
    driver.job_events(spark, folder).write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(landed)
    start_job_states(spark, landed, root, state).awaitTermination()
    return _job_states(current_job_states(spark, root))


# ---- regression -------------------------------------------------------------------------------------

def _features(spark: SparkSession, folder: str) -> DataFrame:
    return regression.price_features(prices.latest_daily_prices(driver.lineitem_prices(spark, folder)))


FEATURES = f"""{LINES_DAILY}, f AS (
  SELECT instrument_id, source_id, record_date, close_price, coalesce(volume, 0) AS volume,
         CAST(row_number() OVER w AS DOUBLE) AS day_index, lag(close_price, 1) OVER w AS lag_1_close,
         lag(close_price, 2) OVER w AS lag_2_close, lag(close_price, 3) OVER w AS lag_3_close,
         lead(close_price, 1) OVER w AS label
  FROM lp_daily WINDOW w AS (PARTITION BY instrument_id, source_id ORDER BY record_date))"""
_FEATURE_COLUMNS = ("close_price", "volume", "day_index", "lag_1_close", "lag_2_close", "lag_3_close")


def _feature_sql(columns: tuple[str, ...]) -> str:
    return "instrument_id, source_id, CAST(record_date AS VARCHAR) AS record_date, " + ", ".join(
        f"round({c}, 4) AS {c}" for c in columns
    )


@query(f"{FEATURES} SELECT {_feature_sql((*_FEATURE_COLUMNS, 'label'))} FROM f")
def features(spark, folder):
    return _features(spark, folder).select(*IDS, day(), *(rounded(c, 4) for c in (*_FEATURE_COLUMNS, "label")))


@query(f"""{FEATURES} SELECT {_feature_sql((*_FEATURE_COLUMNS, 'label'))} FROM f
WHERE lag_3_close IS NOT NULL AND label IS NOT NULL""")
def training_rows(spark, folder):
    found = regression.training_rows(_features(spark, folder))
    return found.select(*IDS, day(), *(rounded(c, 4) for c in (*_FEATURE_COLUMNS, "label")))


@query(f"""{FEATURES} SELECT {_feature_sql(_FEATURE_COLUMNS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY instrument_id, source_id ORDER BY record_date DESC) AS rn FROM f
  WHERE lag_3_close IS NOT NULL) WHERE rn = 1""")
def latest_features(spark, folder):
    found = regression.latest_features(_features(spark, folder))
    return found.select(*IDS, day(), *(rounded(c, 4) for c in _FEATURE_COLUMNS))


@query(f"""{FEATURES} SELECT instrument_id, source_id, count(*) AS training_rows, round(avg(label), 3) AS mean_label,
       round(stddev_pop(label), 3) AS deviation_label, round(corr(close_price, label), 6) AS close_label,
       round(corr(lag_3_close, label), 6) AS lag_3_label, round(corr(day_index, volume), 6) AS day_volume
FROM f WHERE lag_3_close IS NOT NULL AND label IS NOT NULL GROUP BY ALL""")
def regression_statistics(spark, folder):
    """Some of the moments that the models of all series are solved from, as correlations."""
    columns = [*regression.FEATURES, "label"]

    def covariance(a: str, b: str) -> Column:
        return F.col("covariances")[columns.index(a) * len(columns) + columns.index(b)]

    def correlation(a: str, b: str) -> Column:
        spread = F.sqrt(covariance(a, a)) * F.sqrt(covariance(b, b))
        return F.round(F.try_divide(covariance(a, b), spread), 6)

    return regression.series_statistics(_features(spark, folder)).select(
        *IDS, "training_rows", F.round(F.col("means")[columns.index("label")], 3).alias("mean_label"),
        F.round(F.sqrt(covariance("label", "label")), 3).alias("deviation_label"),
        correlation("close_price", "label").alias("close_label"),
        correlation("lag_3_close", "label").alias("lag_3_label"),
        correlation("day_index", "volume").alias("day_volume"),
    )


@query(f"""{FEATURES.replace("lp_daily WINDOW", "ep_daily WINDOW").replace(LINES_DAILY, EVENTS_DAILY)}
SELECT * FROM (SELECT instrument_id, source_id,
  count(*) FILTER (lag_3_close IS NOT NULL AND label IS NOT NULL) AS training_rows FROM f GROUP BY ALL)
WHERE training_rows < 10""")
def short_series(spark, folder):
    """Event series that are too short to train on."""
    daily = prices.latest_daily_prices(driver.event_prices(spark, folder))
    return regression.short_series(regression.price_features(daily))


def _models_sql() -> str:
    """Least squares of every series: covariances scaled to correlations, elimination, back substitution."""
    names, size = regression.FEATURES, len(regression.FEATURES)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    moments = ", ".join([
        *(f"avg({n}) AS m{i}" for i, n in enumerate(names)), "avg(label) AS m", "var_pop(label) AS cy",
        *(f"covar_pop({names[i]}, {names[j]}) AS c{i}_{j}" for i, j in pairs), *(f"covar_pop({n}, label) AS c{i}" for i, n in enumerate(names)),
    ])
    scaled = ", ".join([
        *(f"c{i}_{j} / sqrt(c{i}_{i} * c{j}_{j}) AS a{i}_{j}" for i, j in pairs), *(f"c{i} / sqrt(c{i}_{i}) AS b{i}" for i in range(size)),
    ])
    steps = []
    for k in range(size - 1):
        left = [f"a{i}_{j} - a{k}_{i} * a{k}_{j} / a{k}_{k} AS a{i}_{j}" for i, j in pairs if i > k]
        left += [f"b{i} - a{k}_{i} * b{k} / a{k}_{k} AS b{i}" for i in range(k + 1, size)]
        steps.append(f"e{k + 1} AS (SELECT * REPLACE ({', '.join(left)}) FROM e{k})")
    back = f"e{size - 1}"
    for i in reversed(range(size)):
        known = "".join(f" - a{i}_{j} * x{j}" for j in range(i + 1, size))
        steps.append(f"x{i}s AS (SELECT *, (b{i}{known}) / a{i}_{i} AS x{i} FROM {back})")
        back = f"x{i}s"
    weights = ", ".join(f"x{i} / sqrt(c{i}_{i}) AS w{i}" for i in range(size))
    return f"""{FEATURES},
moments AS (SELECT instrument_id, source_id, count(*) AS training_rows, {moments} FROM f
            WHERE lag_3_close IS NOT NULL AND label IS NOT NULL GROUP BY ALL HAVING count(*) >= {regression.MIN_TRAINING_ROWS}),
e0 AS (SELECT *, {scaled} FROM moments), {", ".join(steps)},
weighted AS (SELECT *, {weights} FROM {back}),
models AS (SELECT *, m{"".join(f" - w{i} * m{i}" for i in range(size))} AS intercept,
                  sqrt(greatest(CAST(0 AS DOUBLE), cy{"".join(f" - w{i} * c{i}" for i in range(size))})) AS training_rmse FROM weighted)"""


@query(_models_sql() + f"""
SELECT instrument_id, source_id, training_rows, round(intercept, 3) AS intercept, round(training_rmse, 3) AS training_rmse,
       {", ".join(f"round(w{i}, 4) AS weight_{n}" for i, n in enumerate(regression.FEATURES))} FROM models""")
def ols_per_series(spark, folder):
    """Fitted coefficients of every series; compared with MLlib and numpy too, in the tests."""
    fitted = regression.series_models(_features(spark, folder))
    return fitted.select(
        *IDS, "training_rows", rounded("intercept", 3), rounded("training_rmse", 3),
        *(F.round(F.col("coefficients")[i], 4).alias(f"weight_{name}") for i, name in enumerate(regression.FEATURES)),
    )


@query(_models_sql() + f"""
SELECT instrument_id, source_id, CAST(record_date AS VARCHAR) AS last_record_date, training_rows, round(training_rmse, 3) AS training_rmse,
       round(intercept{"".join(f" + w{i} * {n}" for i, n in enumerate(regression.FEATURES))}, 3) AS predicted_next_close
FROM models JOIN (SELECT *, row_number() OVER (PARTITION BY instrument_id, source_id ORDER BY record_date DESC) AS rn FROM f
                  WHERE lag_3_close IS NOT NULL) USING (instrument_id, source_id) WHERE rn = 1""")
def ols_predictions(spark, folder):
    """The next close of every series by its own model."""
    frame = _features(spark, folder)
    found = regression.predict_next(regression.series_models(frame), frame)
    return found.select(
        *IDS, day("last_record_date"), rounded("predicted_next_close", 3), "training_rows", rounded("training_rmse", 3)
    )


# ---- questions --------------------------------------------------------------------------------------

# a sharp s has no single upper-case letter in full case mapping
UPPER_TEXT = "upper(replace(text, 'ß', 'ss'))"

DICTIONARY = f"""dictionary AS (
  SELECT split_part({UPPER_TEXT}, ' ', 1) AS symbol, arg_max(conv_id, conv_id * 1000 + turn) AS instrument_id,
         min(conv_id * 1000 + turn) AS position
  FROM conversations WHERE role = 'assistant' GROUP BY 1 HAVING split_part({UPPER_TEXT}, ' ', 1) <> '')"""


@query(f"WITH {DICTIONARY} SELECT * FROM dictionary")
def symbol_dictionary(spark, folder):
    return questions.symbol_dictionary(driver.symbol_listing(spark, folder))


@query(f"""WITH {DICTIONARY}, q AS (
  SELECT conv_id AS session_id, turn AS asked_order, {UPPER_TEXT} AS t FROM conversations WHERE role = 'user'),
hits AS (SELECT session_id, asked_order, arg_min(symbol, position) AS symbol, arg_min(instrument_id, position) AS instrument_id
         FROM q JOIN dictionary ON contains(t, symbol) GROUP BY ALL)
SELECT session_id, asked_order, hits.symbol, coalesce(hits.instrument_id, -1) AS instrument_id
FROM q LEFT JOIN hits USING (session_id, asked_order)""")
def symbol_mentions(spark, folder):
    """The first symbol that occurs in each question."""
    found = questions.first_symbol(
        driver.questions(spark, folder), questions.symbol_dictionary(driver.symbol_listing(spark, folder)),
        ["session_id", "asked_order"],
    )
    return found.select("session_id", "asked_order", "symbol", F.coalesce("instrument_id", F.lit(-1)).alias("instrument_id"))


def _intents_sql() -> str:
    flags = ", ".join(
        f"regexp_matches(lower(text), '{'|'.join(words)}') AS {name}" for name, words in questions.INTENTS.items()
    )
    return f"SELECT conv_id AS session_id, turn AS asked_order, {flags} FROM conversations WHERE role = 'user'"


@query(_intents_sql())
def question_intents(spark, folder):
    return questions.intents(driver.questions(spark, folder)).drop("user_prompt")


@query(WHOLE_REPORT + f"""
SELECT instrument_id, source_id, CASE WHEN mean IS NULL THEN '{questions.NO_ANALYTICS}' END AS analytics,
       CASE WHEN closes < 2 THEN '{questions.NO_TREND}' END AS trend,
       CASE WHEN e IS NULL THEN '{questions.NO_FORECAST}' END AS forecast,
       CASE WHEN closes < 2 THEN '{questions.NO_RISK}' END AS risk_signal,
       CASE WHEN n = 0 THEN '{questions.NO_SERIES}' END AS time_series
FROM r""")
def insufficient_flags(spark, folder):
    return questions.insufficient_flags(_whole_report(spark, folder))


@query(WHOLE_REPORT + f"""
SELECT instrument_id, source_id, 0 AS seq, 'get_analytics' AS name, CAST(n AS VARCHAR) AS shown,
       CASE WHEN mean IS NULL THEN '{questions.NO_ANALYTICS}' END AS error FROM r
UNION ALL SELECT instrument_id, source_id, 1, 'get_trend', direction,
       CASE WHEN closes < 2 THEN '{questions.NO_TREND}' END FROM r
UNION ALL SELECT instrument_id, source_id, 2, 'get_forecast', 'naive_last_close',
       CASE WHEN e IS NULL THEN '{questions.NO_FORECAST}' END FROM r
UNION ALL SELECT instrument_id, source_id, 3, 'get_risk_signal', signal,
       CASE WHEN closes < 2 THEN '{questions.NO_RISK}' END FROM r""")
def fact_sheets(spark, folder):
    """One JSON fact sheet per series and metric; shown is its first field."""
    first = F.coalesce(*(
        F.get_json_object("raw", f"$.{field}") for field in ("count", "direction", "method", "signal")
    ))
    return questions.fact_sheets(_whole_report(spark, folder)).select(*IDS, "seq", "name", first.alias("shown"), "error")


@query(WHOLE_REPORT + f"""
SELECT instrument_id, source_id, CASE WHEN mean IS NULL THEN '{questions.NO_ANALYTICS}' END AS analytics,
       CASE WHEN closes < 2 THEN '{questions.NO_TREND}' END AS trend,
       CASE WHEN e IS NULL THEN '{questions.NO_FORECAST}' END AS forecast,
       CASE WHEN closes < 2 THEN '{questions.NO_RISK}' END AS risk_signal,
       CASE WHEN n = 0 THEN '{questions.NO_SERIES}' END AS time_series
FROM r""")
def insufficient_flags_all_dates(spark, folder):
    return questions.insufficient_flags(_whole_report(spark, folder))


SHEET_NUMBERS = (
    "count", "min_close", "max_close", "avg_close", "total_volume", "start_close", "end_close", "change", "change_pct",
    "predicted_next_close", "volatility_pct", "max_drawdown_pct",
)
SHEET_TEXTS = ("direction", "method", "signal", "summary")


@query(WHOLE_REPORT + f"""
, x AS (SELECT instrument_id, source_id, min(close_price) AS low, max(close_price) AS high FROM part GROUP BY ALL),
sheets AS (
  SELECT instrument_id, source_id, 0 AS seq, 'get_analytics' AS name,
         CASE WHEN mean IS NULL THEN '{questions.NO_ANALYTICS}' END AS error, n AS count, low AS min_close,
         high AS max_close, mean AS avg_close, volume AS total_volume
  FROM r JOIN x USING (instrument_id, source_id)
  UNION ALL BY NAME
  SELECT instrument_id, source_id, 1 AS seq, 'get_trend' AS name,
         CASE WHEN closes < 2 THEN '{questions.NO_TREND}' END AS error, direction,
         CASE WHEN closes >= 2 THEN s END AS start_close, CASE WHEN closes >= 2 THEN e END AS end_close,
         CASE WHEN closes >= 2 THEN e - s END AS change,
         CASE WHEN closes >= 2 AND s <> 0 THEN (e - s) / s * 100 END AS change_pct FROM r
  UNION ALL BY NAME
  SELECT instrument_id, source_id, 2 AS seq, 'get_forecast' AS name,
         CASE WHEN e IS NULL THEN '{questions.NO_FORECAST}' END AS error, 'naive_last_close' AS method,
         e AS predicted_next_close FROM r
  UNION ALL BY NAME
  SELECT instrument_id, source_id, 3 AS seq, 'get_risk_signal' AS name,
         CASE WHEN closes < 2 THEN '{questions.NO_RISK}' END AS error, signal,
         CASE WHEN closes >= 2 THEN v END AS volatility_pct, CASE WHEN closes >= 2 THEN d END AS max_drawdown_pct,
         CASE WHEN closes < 2 THEN '{metrics.TOO_FEW_CLOSES}'
              ELSE printf('Risk is %s (volatility=%.2f%%, max_drawdown=%.2f%%).', signal, coalesce(v, 0), d) END AS summary
  FROM r)
SELECT instrument_id, source_id, seq, name, error, {", ".join(SHEET_TEXTS)},
       {", ".join(f"round({c}, 6) AS {c}" for c in SHEET_NUMBERS)} FROM sheets""")
def fact_sheets_all_dates(spark, folder):
    """One row per series and sheet over all dates, with every field of the sheet in a column of its name."""
    sheets = questions.fact_sheets(_whole_report(spark, folder))
    read = F.from_json("raw", ", ".join(f"{c} string" for c in SHEET_NUMBERS + SHEET_TEXTS)).alias("read")
    return sheets.select(*IDS, "seq", "name", "error", read).select(*IDS, "seq", "name", "error", "read.*").select(
        *IDS, "seq", "name", "error", *SHEET_TEXTS, *(rounded(c) for c in SHEET_NUMBERS)
    )


@query(f"""{EVENTS}, g AS (SELECT instrument_id, source_id, count(*) AS n, avg(close_price) AS a FROM ep GROUP BY ALL)
SELECT a.source_id, a.instrument_id AS instrument_a_id, a.n AS instrument_a_count, coalesce(b.n, 0) AS instrument_b_count,
       round(coalesce(a.a - b.a, -1), 6) AS avg_close_diff
FROM g a LEFT JOIN g b ON a.source_id = b.source_id AND a.instrument_id + 1 = b.instrument_id""")
def comparison_sheets(spark, folder):
    rows = driver.event_prices(spark, folder)
    pairs = rows.select(
        "source_id", F.col("instrument_id").alias("instrument_a_id"), (F.col("instrument_id") + 1).alias("instrument_b_id")
    ).distinct()
    field = lambda name: F.get_json_object("raw", f"$.{name}")
    return questions.comparison_sheets(metrics.compare_pairs(rows, pairs)).select(
        "source_id", "instrument_a_id", field("instrument_a_count").cast("bigint").alias("instrument_a_count"),
        field("instrument_b_count").cast("bigint").alias("instrument_b_count"),
        F.round(F.coalesce(field("avg_close_diff").cast("double"), F.lit(-1.0)), 6).alias("avg_close_diff"),
    )


@query(f"""{CURRENT} SELECT instrument_id, CAST(instrument_id AS VARCHAR) AS id_text, symbol, name, instrument_class AS class,
       region, currency FROM live""")
def instrument_documents(spark, folder):
    """One JSON document per live instrument, read back."""
    names = ("symbol", "name", "class", "region", "currency")
    return questions.instrument_details(current(spark, folder)).select(
        "instrument_id", F.get_json_object("raw", "$.instrument_id").alias("id_text"),
        *(F.get_json_object("raw", f"$.{n}").alias(n) for n in names),
    )


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS source_id, n_name AS name, r_name AS type
FROM nation LEFT JOIN region ON r_regionkey = n_regionkey""")
def source_documents(spark, folder):
    return questions.source_listing(driver.data_sources(spark, folder)).select(
        *(F.get_json_object("raw", f"$.{n}").alias(n) for n in ("source_id", "name", "type"))
    )


@query(f"""WITH q AS ({_intents_sql()}),
t AS (SELECT 'list_instruments' AS tool FROM q UNION ALL SELECT 'list_sources' FROM q
      UNION ALL SELECT 'get_analytics' FROM q WHERE wants_analytics UNION ALL SELECT 'get_trend' FROM q WHERE wants_trend
      UNION ALL SELECT 'get_forecast' FROM q WHERE wants_forecast UNION ALL SELECT 'get_risk_signal' FROM q WHERE wants_risk
      UNION ALL SELECT 'compare_assets' FROM q WHERE wants_compare)
SELECT tool, count(*) AS uses FROM t GROUP BY 1""")
def tool_usage(spark, folder):
    """What the question log says was requested, from the questions and their intents."""
    asked = questions.intents(driver.questions(spark, folder))
    wanted = {
        "wants_analytics": "get_analytics", "wants_trend": "get_trend", "wants_forecast": "get_forecast",
        "wants_risk": "get_risk_signal", "wants_compare": "compare_assets",
    }
    tools = F.array_compact(F.array(
        F.lit("list_instruments"), F.lit("list_sources"),
        *(F.when(F.col(flag), F.lit(tool)) for flag, tool in wanted.items()),
    ))
    answers = asked.select("session_id", "asked_order", "user_prompt", tools.alias("tools"))
    return questions.tool_usage(questions.question_log_rows(answers))


# ---- reports and answers ----------------------------------------------------------------------------

#: Numbers of texts are compared to six digits after the point.
def six_digits(name: str) -> Column:
    return F.regexp_replace(name, r"(\d\.\d{6})\d+", "$1").alias(name)


def _number_sql(value: str) -> str:
    return rf"regexp_replace(CAST(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,12)) AS VARCHAR), '\.?0+$', '')"


def _json_sql(value: str) -> str:
    return f"""coalesce('"' || {_number_sql(value)} || '"', 'null')"""


def _shown_sql(value: str) -> str:
    return f"coalesce({_number_sql(value)}, 'None')"


#: Facts of every series that is asked for, also of one without prices; ``requested`` names them.
FACTS = f"""
x AS (SELECT instrument_id, source_id, min(close_price) AS low, max(close_price) AS high FROM part GROUP BY ALL),
facts AS (
  SELECT instrument_id, source_id, coalesce(n, 0) AS n, coalesce(closes, 0) >= 2 AS enough, low, high, mean,
         coalesce(volume, 0) AS volume, coalesce(direction, 'flat') AS direction, coalesce(signal, 'insufficient_data') AS signal,
         CASE WHEN closes >= 2 THEN s END AS s, CASE WHEN closes >= 2 THEN r.e END AS e2, r.e,
         CASE WHEN closes >= 2 THEN r.e - s END AS change, CASE WHEN closes >= 2 AND s <> 0 THEN (r.e - s) / s * 100 END AS pct,
         CASE WHEN closes >= 2 THEN v END AS v, CASE WHEN closes >= 2 THEN d END AS d,
         CASE WHEN coalesce(closes, 0) < 2 THEN '{metrics.TOO_FEW_CLOSES}'
              ELSE printf('Risk is %s (volatility=%.2f%%, max_drawdown=%.2f%%).', signal, coalesce(v, 0), d) END AS summary
  FROM requested LEFT JOIN r USING (instrument_id, source_id) LEFT JOIN x USING (instrument_id, source_id)),
sheets AS (
  SELECT instrument_id, source_id, 0 AS seq, 'get_analytics' AS name,
         CASE WHEN mean IS NULL THEN '{questions.NO_ANALYTICS}' END AS error,
         '{{"count":' || n || ',"min_close":' || {_json_sql('low')} || ',"max_close":' || {_json_sql('high')} ||
         ',"avg_close":' || {_json_sql('mean')} || ',"total_volume":' || volume || '}}' AS raw,
         'Analytics summary: count=' || n || ', min_close=' || {_shown_sql('low')} || ', max_close=' || {_shown_sql('high')} ||
         ', avg_close=' || {_shown_sql('mean')} || ', total_volume=' || volume || '.' AS line FROM facts
  UNION ALL
  SELECT instrument_id, source_id, 1, 'get_trend', CASE WHEN NOT enough THEN '{questions.NO_TREND}' END,
         '{{"direction":"' || direction || '","start_close":' || {_json_sql('s')} || ',"end_close":' || {_json_sql('e2')} ||
         ',"change":' || {_json_sql('change')} || ',"change_pct":' || {_json_sql('pct')} || '}}',
         'Trend summary: direction=' || direction || ', change=' || {_shown_sql('change')} || ', change_pct=' || {_shown_sql('pct')} || '.'
  FROM facts
  UNION ALL
  SELECT instrument_id, source_id, 2, 'get_forecast', CASE WHEN e IS NULL THEN '{questions.NO_FORECAST}' END,
         '{{"method":"naive_last_close","predicted_next_close":' || {_json_sql('e')} || '}}',
         'Forecast summary: method=naive_last_close, predicted_next_close=' || {_shown_sql('e')} || '.' FROM facts
  UNION ALL
  SELECT instrument_id, source_id, 3, 'get_risk_signal', CASE WHEN NOT enough THEN '{questions.NO_RISK}' END,
         '{{"signal":"' || signal || '","volatility_pct":' || {_json_sql('v')} || ',"max_drawdown_pct":' || {_json_sql('d')} ||
         ',"summary":"' || summary || '"}}',
         'Risk summary: signal=' || signal || ', volatility_pct=' || {_shown_sql('v')} || ', max_drawdown_pct=' || {_shown_sql('d')} || '.'
  FROM facts)"""


def _reports_sql(keys: str, name: str) -> str:
    """The report of every key of ``runs`` (keys, seq, name, raw, error, line)."""
    places = " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(questions.REPORT_ORDER))
    return f"""
good AS (SELECT *, row_number() OVER (PARTITION BY {keys}, name ORDER BY seq DESC) AS back,
                row_number() OVER (PARTITION BY {keys} ORDER BY seq DESC) AS last,
                CASE WHEN length(raw) > 220 THEN raw[1:217] || '...' ELSE raw END AS snippet FROM runs WHERE error IS NULL),
texts AS (
  SELECT {keys}, string_agg(line, chr(10) ORDER BY CASE name {places} END) FILTER (WHERE back = 1 AND line IS NOT NULL) AS lines,
         string_agg('- ' || name || ': ' || snippet, chr(10) ORDER BY seq) FILTER (WHERE last <= {questions.EVIDENCE_RUNS}) AS evidence
  FROM good GROUP BY {keys}),
reports AS (
  SELECT {keys}, regexp_replace(CASE WHEN evidence IS NULL THEN '{questions.NOTHING_WORKED}'
         ELSE coalesce(lines, '{questions.NOTHING_USABLE}') || chr(10) ||
              CASE WHEN failed THEN '{questions.SOME_FAILED}' || chr(10) ELSE '' END || chr(10) ||
              '{questions.EVIDENCE_TITLE}' || chr(10) || evidence END, '([0-9]\\.[0-9]{{6}})[0-9]+', '\\1', 'g') AS {name}
  FROM (SELECT {keys}, bool_or(error IS NOT NULL) AS failed FROM runs GROUP BY {keys}) LEFT JOIN texts USING ({keys}))"""


@query(WHOLE_REPORT + f""",
requested AS (SELECT DISTINCT instrument_id, source_id FROM ep), {FACTS},
runs AS (SELECT * FROM sheets), {_reports_sql("instrument_id, source_id", "report")}
SELECT instrument_id, source_id, report FROM reports""")
def grounded_reports(spark, folder):
    """Report text of every series from its fact sheets."""
    return questions.grounded_reports(questions.fact_sheets(_whole_report(spark, folder)), IDS).select(*IDS, six_digits("report"))


def _earlier_runs(asked: DataFrame) -> DataFrame:
    """What was asked before: a trend without data in every third session, a forecast in the next one."""
    third = F.col("session_id") % 3
    run = F.when(third == 0, F.struct(F.lit("get_trend").alias("name"), F.lit('{"direction":"flat"}').alias("raw"), F.lit(questions.NO_TREND).alias("error")))
    run = run.when(third == 1, F.struct(
        F.lit("get_forecast").alias("name"), F.lit('{"method":"mean","predicted_next_close":"7"}').alias("raw"), F.lit(None).cast("string").alias("error")))
    return asked.select("session_id", "asked_order", F.lit(5).alias("seq"), run.alias("run")).where("run IS NOT NULL").select(
        "session_id", "asked_order", "seq", "run.*")


def _answers_sql() -> str:
    wants = "\n  UNION ALL ".join(
        f"SELECT q.*, {1_000_000 + n} AS seq, '{name}' AS name FROM q WHERE {flag}"
        + {"get_trend": "", "get_forecast": " AND session_id % 3 <> 1"}.get(name, "")
        for n, (flag, name) in enumerate(answers.REQUESTS.items())
    )
    keys = "session_id, asked_order"
    return WHOLE_REPORT + f""", {DICTIONARY},
listing AS (SELECT split_part(text, ' ', 1) AS symbol, conv_id AS instrument_id, conv_id * 1000 + turn AS position
            FROM conversations WHERE role = 'assistant'),
documents_of AS (
  SELECT instrument_id, '{{"instrument_id":"' || instrument_id || '","symbol":' || CAST(to_json(symbol) AS VARCHAR) || ',"name":' ||
         CAST(to_json(symbol) AS VARCHAR) || ',"class":"stock","region":"US"}}' AS raw, symbol,
         row_number() OVER (ORDER BY position) AS rank FROM listing),
kinds AS (SELECT DISTINCT event_type AS source_id FROM events),
lists AS (
  SELECT (SELECT '[' || string_agg(raw, ',' ORDER BY rank) || ']' FROM documents_of WHERE rank <= 7) AS instruments,
         (SELECT '[' || string_agg('{{"source_id":"' || source_id || '","name":"' || source_id || '","type":"event"}}', ',' ORDER BY source_id)
                 || ']' FROM (SELECT * FROM kinds ORDER BY 1 LIMIT 7)) AS sources,
         (SELECT 'Found ' || count(*) || ' instruments in the warehouse.' FROM listing) || chr(10) || 'Sample instruments: ' ||
         (SELECT string_agg(symbol || ' (' || instrument_id || ')', ', ' ORDER BY rank) FROM documents_of WHERE rank <= 5) || '.' AS found),
flags AS ({_intents_sql()}),
asked AS (SELECT conv_id AS session_id, turn AS asked_order, text AS user_prompt, {UPPER_TEXT} AS t FROM conversations WHERE role = 'user'),
hits AS (SELECT {keys}, arg_min(instrument_id, position) AS found_id FROM asked JOIN dictionary ON contains(t, symbol) GROUP BY ALL),
q AS (SELECT flags.*, coalesce(found_id, (SELECT instrument_id FROM documents_of WHERE rank = 1)) AS instrument_id,
             (SELECT min(source_id) FROM kinds) AS source_id, (SELECT instrument_id FROM documents_of WHERE rank = 2) AS other_id
      FROM flags LEFT JOIN hits USING ({keys})),
asks AS ({wants}),
requested AS (SELECT DISTINCT instrument_id, source_id FROM asks WHERE name <> 'compare_assets'), {FACTS},
means AS (SELECT instrument_id, source_id, count(*) AS n, avg(close_price) AS mean FROM ep GROUP BY ALL),
compared AS (
  SELECT DISTINCT asks.instrument_id, source_id, coalesce(a.n, 0) AS an, coalesce(b.n, 0) AS bn, a.mean AS am, b.mean AS bm, a.mean - b.mean AS diff
  FROM asks LEFT JOIN means a USING (instrument_id, source_id)
  LEFT JOIN means b ON b.instrument_id = other_id AND b.source_id = asks.source_id WHERE name = 'compare_assets'),
runs AS (
  SELECT {keys}, seq, name, raw, error, line FROM asks JOIN (SELECT * EXCLUDE (seq) FROM sheets) USING (instrument_id, source_id, name)
  UNION ALL
  SELECT {keys}, seq, name, '{{"instrument_a_count":' || an || ',"instrument_b_count":' || bn || ',"instrument_a_avg_close":' || {_json_sql('am')} ||
         ',"instrument_b_avg_close":' || {_json_sql('bm')} || ',"avg_close_diff":' || {_json_sql('diff')} || '}}', NULL,
         'Comparison summary: instrument_a_count=' || an || ', instrument_b_count=' || bn || ', instrument_a_avg_close=' || {_shown_sql('am')} ||
         ', instrument_b_avg_close=' || {_shown_sql('bm')} || ', avg_close_diff=' || {_shown_sql('diff')} || '.'
  FROM asks JOIN compared USING (instrument_id, source_id) WHERE name = 'compare_assets'
  UNION ALL SELECT {keys}, -2, 'list_instruments', instruments, NULL, found FROM q, lists
  UNION ALL SELECT {keys}, -1, 'list_sources', sources, NULL, NULL FROM q, lists
  UNION ALL SELECT {keys}, 5, 'get_trend', '{{"direction":"flat"}}', '{questions.NO_TREND}', NULL FROM q WHERE session_id % 3 = 0
  UNION ALL SELECT {keys}, 5, 'get_forecast', '{{"method":"mean","predicted_next_close":"7"}}', NULL,
                   'Forecast summary: method=mean, predicted_next_close=7.' FROM q WHERE session_id % 3 = 1),
{_reports_sql(keys, "llm_response")},
tools AS (SELECT {keys}, string_agg(name, ', ' ORDER BY seq) AS tools_invoked FROM runs GROUP BY {keys})
SELECT {keys}, user_prompt, tools_invoked, llm_response FROM asked JOIN tools USING ({keys}) JOIN reports USING ({keys})"""


@query(_answers_sql())
def answered_questions(spark, folder):
    """Questions, partly asked before, to log rows: symbols, plan, facts, report."""
    rows = driver.event_prices(spark, folder)
    listing = driver.symbol_listing(spark, folder).withColumns({
        "name": F.col("symbol"), "instrument_class": F.lit("stock"), "region": F.lit("US")})
    sources = rows.select("source_id").distinct().withColumns({"source_name": F.col("source_id"), "source_type": F.lit("event")})
    asked = driver.questions(spark, folder)
    log = answers.answer_questions(asked, listing, sources, rows, ["session_id", "asked_order"], _earlier_runs(asked))
    return log.select("session_id", "asked_order", "user_prompt", "tools_invoked", six_digits("llm_response"))


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS source_id, n_name AS source_name, r_name AS source_type
FROM nation LEFT JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey = 7""")
def source_one(spark, folder):
    """All details of one source by its id."""
    found = instruments.source_by_id(driver.data_sources(spark, folder), 7)
    return found.select(F.col("source_id").cast("string").alias("source_id"), "source_name", "source_type")


# ---- entity tables ----------------------------------------------------------------------------------

def _kept(spark: SparkSession, name: str, rows: DataFrame) -> DataFrame:
    """Rows appended to a table in two writes and read back."""
    root = scratch_path(spark, name)
    odd = F.pmod(F.xxhash64(*rows.columns), F.lit(2)) == 1
    for part in (rows.where(odd), rows.where(~odd)):
        tables.append(part, root, name)
    return tables.scan(spark, root, name)


@query("""SELECT 'exchanges' AS kind, CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, r_name AS detail
FROM nation LEFT JOIN region ON r_regionkey = n_regionkey
UNION ALL SELECT 'owners', CAST(s_suppkey AS VARCHAR), s_name, CASE WHEN s_acctbal < 0 THEN 'closed' ELSE 'firm' END FROM supplier
UNION ALL SELECT 'users', CAST(c_custkey AS VARCHAR), c_name, CASE WHEN k IS NULL THEN 'viewer' ELSE 'last order ' || CAST(k AS VARCHAR) END
FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS k FROM orders GROUP BY 1) ON o_custkey = c_custkey
WHERE c_acctbal >= 0""")
def entities_written(spark, folder):
    """Exchanges, owners and users saved by key, changed by key, users in debt deleted, all read back."""
    root = scratch_path(spark, "entities")
    read = lambda name: driver.table(spark, folder, name)
    nation, customer = driver.data_sources(spark, folder), read("customer")
    tables.upsert(spark, root, "exchanges", nation.select(
        F.col("source_id").alias("exchange_id"), F.col("source_name").alias("exchange_name"), F.col("source_type").alias("country")))
    firms = read("supplier").select(F.col("s_suppkey").alias("owner_id"), F.lit("firm").alias("owner_type"), F.col("s_name").alias("name"), "s_acctbal")
    tables.upsert(spark, root, "owners", firms.withColumn("created_at", F.lit(LOADED)))
    tables.upsert(spark, root, "owners", firms.where("s_acctbal < 0").withColumns({"owner_type": F.lit("closed"), "created_at": F.lit(LOADED)}))
    users = customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("owner_id"), F.col("c_name").alias("username"),
        F.lit("viewer").alias("role"), F.lit(LOADED).alias("registered_at"))
    tables.upsert(spark, root, "users", users)
    seen = read("orders").join(users, F.col("o_custkey") == F.col("user_id")).select(
        *users.columns[:3], F.concat(F.lit("last order "), "o_orderkey").alias("role"), "registered_at", "o_orderkey")
    tables.upsert(spark, root, "users", seen, F.col("o_orderkey"))
    tables.delete(spark, root, "users", customer.where("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("user_id")))

    def shown(name: str, *columns: str) -> DataFrame:
        names = ("id", "name", "detail")
        return tables.scan(spark, root, name).select(F.lit(name).alias("kind"), *(F.col(c).alias(n) for c, n in zip(columns, names)))

    return shown("exchanges", "exchange_id", "exchange_name", "country").unionByName(
        shown("owners", "owner_id", "name", "owner_type")).unionByName(shown("users", "user_id", "username", "role"))


#: The newest order of every group; orders of one moment are one row, the first by key.
def _newest_orders(group: str) -> str:
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR)) AS rn
  FROM orders) WHERE rn = 1"""


@query(f"""SELECT CAST(o_custkey AS VARCHAR) AS portfolio_id, o_orderpriority AS instrument_id, epoch_us(max(o_orderdate)) AS added_at_us
FROM orders GROUP BY ALL""")
def portfolio_assets_latest(spark, folder):
    """The last time each asset was added to each portfolio."""
    o = driver.table(spark, folder, "orders")
    rows = o.select(
        F.col("o_custkey").alias("portfolio_id"), F.col("o_orderpriority").alias("instrument_id"), F.col("o_orderdate").alias("added_at"),
        F.col("o_orderpriority").alias("symbol"), F.lit("stock").alias("instrument_class"))
    found = tables.latest(_kept(spark, "portfolio_assets", rows), "portfolio_assets")
    return found.select("portfolio_id", "instrument_id", micros("added_at"))


@query(f"""SELECT CAST(o_custkey AS VARCHAR) AS instrument_id, o_orderstatus AS source_id, CAST(o_orderkey AS VARCHAR) AS result_id,
       epoch_us(o_orderdate) AS computed_at_us, round(o_totalprice, 2) AS metric_value
FROM ({_newest_orders("o_custkey, o_orderstatus")})""")
def analytics_results_latest(spark, folder):
    """The newest stored metric of every series."""
    o = driver.table(spark, folder, "orders")
    rows = o.select(
        F.col("o_custkey").alias("instrument_id"), F.col("o_orderstatus").alias("source_id"), F.col("o_orderdate").alias("computed_at"),
        F.col("o_orderkey").alias("result_id"), F.lit("avg_close").alias("metric_type"), F.col("o_totalprice").alias("metric_value"))
    found = tables.latest(_kept(spark, "analytics_results", rows), "analytics_results")
    return found.select("instrument_id", "source_id", "result_id", micros("computed_at"), rounded("metric_value", 2))


@query(f"""SELECT CAST(o_custkey AS VARCHAR) AS instrument_id, CAST(o_orderkey AS VARCHAR) AS signal_id, epoch_us(o_orderdate) AS generated_at_us,
       CASE WHEN o_totalprice > 200000 THEN 'high' ELSE 'low' END AS severity FROM ({_newest_orders("o_custkey")})""")
def risk_signals_latest(spark, folder):
    """The newest stored risk signal of every instrument."""
    o = driver.table(spark, folder, "orders")
    rows = o.select(
        F.col("o_custkey").alias("instrument_id"), F.col("o_orderdate").alias("generated_at"), F.col("o_orderkey").alias("signal_id"),
        F.lit("volatility").alias("signal_type"), F.when(F.col("o_totalprice") > 200000, "high").otherwise("low").alias("severity"))
    found = tables.latest(_kept(spark, "risk_signals", rows), "risk_signals")
    return found.select("instrument_id", "signal_id", micros("generated_at"), "severity")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS user_id, epoch_us(max(o_orderdate)) AS created_at_us FROM orders GROUP BY 1""")
def recommendations_latest(spark, folder):
    """When every user was last given a recommendation."""
    o = driver.table(spark, folder, "orders")
    rows = o.select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("created_at"), F.lit("hold").alias("action"), F.lit(False).alias("was_acted_on"))
    return tables.latest(_kept(spark, "recommendations", rows), "recommendations").select("user_id", micros("created_at"))


@query("""SELECT CAST(conv_id AS VARCHAR) AS session_id, turn, text AS user_prompt, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS place
FROM conversations WHERE role = 'user'""")
def question_log_history(spark, folder):
    """The question log written and read back, newest question first in every session."""
    asked = driver.questions(spark, folder).select(
        F.lit("u").alias("user_id"), "session_id", F.timestamp_seconds("asked_order").alias("asked_at"),
        F.concat_ws("-", "session_id", "asked_order").alias("query_id"), "user_prompt")
    log = tables.history(_kept(spark, "question_log", asked), "question_log", user_id="u")
    place = F.row_number().over(Window.partitionBy("session_id").orderBy(F.col("asked_at").desc()))
    return log.select("session_id", F.unix_seconds("asked_at").alias("turn"), "user_prompt", place.alias("place"))


_UUID_TEXT = """CASE o_orderkey % 7 WHEN 0 THEN h WHEN 1 THEN upper(h) WHEN 2 THEN '{' || h[1:8] || '-' || h[9:] || '}' WHEN 3 THEN 'urn:uuid:' || h
  WHEN 4 THEN h[1:31] WHEN 5 THEN 'g' || h[2:] ELSE '' END"""


@query(f"""SELECT o_orderkey, regexp_matches(regexp_replace(regexp_replace(t, 'urn:|uuid:', '', 'g'), '^[{{}}]+|[{{}}]+$|-', '', 'g'),
       '^[0-9a-fA-F]{{32}}$') AS valid
FROM (SELECT o_orderkey, {_UUID_TEXT} AS t FROM (SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR)) AS h FROM orders))""")
def uuid_check(spark, folder):
    """Which texts are UUIDs, in all the forms they may have."""
    o = driver.table(spark, folder, "orders")
    h, kind = F.md5(F.col("o_orderkey").cast("string").cast("binary")), F.col("o_orderkey") % 7
    dashed = F.concat(F.lit("{"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 32), F.lit("}"))
    forms = (h, F.upper(h), dashed, F.concat(F.lit("urn:uuid:"), h), F.substring(h, 1, 31), F.concat(F.lit("g"), F.substring(h, 2, 31)))
    text = F.lit("")
    for n, form in enumerate(forms):
        text = F.when(kind == n, form).otherwise(text)
    return o.select("o_orderkey", is_uuid(text).alias("valid"))


@query(f"""{LINES} SELECT instrument_id, source_id, CAST(record_date AS VARCHAR) AS record_date, system_us AS system_date_us,
       round(close_price, 4) AS close_price FROM lp WHERE instrument_id = 3""")
def price_one_instrument_compacted(spark, folder):
    """Prices of one load for every ship year, compacted, then read by instrument."""
    root = scratch_path(spark, "compacted")
    rows = driver.lineitem_prices(spark, folder).withColumn("ingested_at", F.col("system_date"))
    for name, part in (("early", rows.where("record_year < 1996")), ("late", rows.where("record_year >= 1996"))):
        tables.append_load(part, root, "prices", name)
    tables.compact(spark, root, "prices")
    found = tables.scan_key(spark, root, "prices", 3)
    return found.select(
        F.col("instrument_id").cast("bigint").alias("instrument_id"), "source_id", day(), micros("system_date"), rounded("close_price", 4))


# ---- stored summaries -------------------------------------------------------------------------------

_REPORT_COLUMNS = """
SELECT instrument_id, source_id, n AS count, round(mean, 4) AS avg_close, volume AS total_volume, direction,
       round(CASE WHEN closes >= 2 THEN e - s END, 4) AS change, round(e, 4) AS predicted_next_close, signal,
       round(CASE WHEN closes >= 2 THEN v END, 4) AS volatility_pct, round(CASE WHEN closes >= 2 THEN d END, 4) AS max_drawdown_pct
FROM r"""
LINES_REPORT = LINES + EVENTS_REPORT[len(EVENTS):].replace("FROM ep ", "FROM lp ").replace("2024-01-03", "1993-03-10").replace(
    "2024-01-28", "1997-10-20")


@query(LINES_REPORT + _REPORT_COLUMNS)
def metrics_report_from_summaries(spark, folder):
    """A range of five years: three from stored summaries of whole years, raw rows only of the two that it cuts."""
    rows = driver.lineitem_prices(spark, folder)
    root = scratch_path(spark, "summaries")
    tables.upsert(spark, root, "price_summaries", stored_summaries.year_summaries(rows))
    stored = tables.scan(spark, root, "price_summaries").withColumn("instrument_id", F.col("instrument_id").cast("bigint"))
    stored = stored.select(*(F.col(f).cast("double").alias(f) if f.endswith("_close") else F.col(f) for f in stored.columns))
    report = stored_summaries.report_from_summaries(stored, rows, date(1993, 3, 10), date(1997, 10, 20))
    numbers = ("change", "predicted_next_close", "volatility_pct", "max_drawdown_pct", "avg_close")
    return report.select(*IDS, "count", "total_volume", "direction", "signal", *(rounded(c, 4) for c in numbers))
