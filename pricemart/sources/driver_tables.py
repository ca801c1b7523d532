"""The benchmark's star-schema tables read as warehouse tables.

Every mapping is a plain projection of one table (or a join with a small dimension), so it runs inside
the scan stage of whatever reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemart.functions.rows import once_per_row


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def event_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Prices from ``events``: one series per user and event type, about a month of dates.

    A day with several events has several versions. Every 97th event lacks a close and every 89th is a
    tombstone; users divisible by ten have a constant price.
    """
    e = table(spark, folder, "events")
    loaded = F.col("ts").cast("timestamp")
    close = F.lit(500.0) + F.col("value") * (F.col("user_id") % 10) / 23.57
    props = F.from_json("props", "map<string,string>")
    return e.select(
        F.col("user_id").alias("instrument_id"),
        F.col("event_type").alias("source_id"),
        F.year("ts").alias("record_year"),
        F.col("ts").cast("date").alias("record_date"),
        loaded.alias("system_date"),
        F.lit(None).cast("double").alias("open_price"),
        F.when(F.col("event_id") % 97 != 0, close).alias("close_price"),
        (close + 1).alias("high_price"),
        (close - 1).alias("low_price"),
        F.lit(None).cast("double").alias("adj_close"),
        props["k"].cast("bigint").alias("volume"),
        F.lit(None).cast("double").alias("ex_dividend"),
        F.lit(None).cast("double").alias("split_ratio"),
        F.when(F.col("event_id") % 89 == 0, F.create_map(F.lit("_deleted"), F.lit("true")))
        .otherwise(props).alias("extra_indicators"),
        loaded.alias("ingested_at"),
    )


def lineitem_prices(spark: SparkSession, folder: str) -> DataFrame:
    """Prices from ``lineitem``: one long series per supplier and line status, several years of dates."""
    li = table(spark, folder, "lineitem")
    step = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 100_000 + F.col("l_partkey") % 100_000
    loaded = F.timestamp_micros(F.unix_micros(F.col("l_shipdate").cast("timestamp")) + step)
    return li.select(
        F.col("l_suppkey").alias("instrument_id"),
        F.col("l_linestatus").alias("source_id"),
        F.year("l_shipdate").alias("record_year"),
        F.col("l_shipdate").cast("date").alias("record_date"),
        loaded.alias("system_date"),
        (F.col("l_extendedprice") / (F.col("l_quantity") + 0.37)).alias("close_price"),
        F.col("l_quantity").cast("bigint").alias("volume"),
    )


def data_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Data sources from ``nation``; the region is the source type."""
    region = table(spark, folder, "region")
    return (
        table(spark, folder, "nation")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("n_nationkey").alias("source_id"),
            F.col("n_name").alias("source_name"),
            F.col("r_name").alias("source_type"),
            F.concat(F.lit("https://example.com/"), F.lower("n_name")).alias("base_url"),
            (F.col("n_nationkey") % 2 == 0).alias("api_key_required"),
            F.lit(None).cast("string").alias("description"),
        )
    )


def instruments(spark: SparkSession, folder: str) -> DataFrame:
    """Instruments from ``customer``; the nation is the region."""
    nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
    return (
        table(spark, folder, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("instrument_id"),
            F.col("c_name").alias("symbol"),
            F.col("c_mktsegment").alias("instrument_class"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("region"),
            F.lit("USD").alias("currency"),
            F.lit(None).cast("string").alias("exchange_id"),
            F.lit(None).cast("string").alias("description"),
            F.lit("1994-01-01").cast("timestamp").alias("created_at"),
        )
    )


def instrument_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Instrument versions from ``orders``: status P is a delete marker, priority 5-LOW has no snapshot.

    ``version_id`` is the order key; where two versions share a key and time, the greater one was
    written last.
    """
    o = table(spark, folder, "orders")
    moment = F.col("o_orderdate").cast("timestamp")
    marker = F.col("o_orderstatus") == "P"
    snapshot = F.to_json(F.struct(
        F.concat(F.lit(" sym"), F.col("o_custkey") % 500, F.lit(" ")).alias("symbol"),
        F.col("o_orderpriority").alias("instrument_class"),
        F.concat(F.lit("Order "), F.col("o_orderkey")).alias("name"),
        F.col("o_orderstatus").alias("region"),
        F.lit("EUR").alias("currency"),
        F.lit(None).cast("string").alias("exchange_id"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("description"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
    ), {"ignoreNullFields": "false"})
    return o.select(
        F.col("o_custkey").alias("instrument_id"),
        moment.alias("valid_from"),
        F.col("o_orderkey").alias("version_id"),
        F.when(marker, "delete_marker").otherwise("update").alias("change_type"),
        marker.alias("is_delete_marker"),
        F.when(~marker & (F.col("o_orderpriority") != "5-LOW"), snapshot).alias("snapshot"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit("system").alias("changed_by"),
    )


def ingest_log(spark: SparkSession, folder: str) -> DataFrame:
    """Load log from ``lineitem``: one entry per line, by supplier and ship year."""
    li = table(spark, folder, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("source_id"),
        F.year("l_shipdate").alias("log_year"),
        F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("log_id"),
        F.col("l_partkey").alias("instrument_id"),
        F.when(F.col("l_returnflag") == "R", "error").otherwise("success").alias("status"),
        F.col("l_quantity").cast("int").alias("record_count"),
        F.when(F.col("l_returnflag") == "R", F.lit("returned")).alias("error_message"),
        F.col("l_extendedprice").cast("bigint").alias("duration_ms"),
    )


def job_events(spark: SparkSession, folder: str) -> DataFrame:
    """Job life-cycle events from ``orders``: one job per customer, status by order status."""
    o = table(spark, folder, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "O", "running").when(F.col("o_orderstatus") == "F", "completed")
        .otherwise("failed")
    )
    moment = F.timestamp_micros(F.unix_micros(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey"))
    return o.select(
        F.col("o_custkey").cast("string").alias("job_id"),
        F.col("o_orderpriority").alias("symbol"),
        F.lit("WIKI/PRICES").alias("datatable_code"),
        status.alias("status"),
        moment.alias("event_time"),
        F.when(status == "completed", (F.col("o_orderkey") % 1000).cast("int")).alias("record_count"),
        F.when(status == "failed", F.concat(F.lit("order "), F.col("o_orderkey"))).alias("error_message"),
    )


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """User questions from ``conversations``."""
    return table(spark, folder, "conversations").where(F.col("role") == "user").select(
        F.col("conv_id").alias("session_id"), F.col("turn").alias("asked_order"), F.col("text").alias("user_prompt")
    )


def symbol_listing(spark: SparkSession, folder: str) -> DataFrame:
    """A symbol listing from ``conversations``: the first word of every assistant turn, by conversation."""
    c = table(spark, folder, "conversations").where(F.col("role") == "assistant")
    return c.select(
        F.split_part("text", F.lit(" "), F.lit(1)).alias("symbol"),
        F.col("conv_id").alias("instrument_id"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("position"),
    )


def feed_documents(
    spark: SparkSession, folder: str, deal: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Feed pages as JSON text, one for each row of ``lineitem``.

    The close column comes twice, first as zero. Returned lines have their date without dashes, lines
    without discount a null in the column that the feed map does not know, and every seventh line of an
    order a second data row that stops after the ticker. ``deal`` may move and sort the rows by source_id and page
    before their texts are made.
    """
    li = table(spark, folder, "lineitem")
    names = ("ticker", "date", "close", "volume", "flag", "close")
    header = ",".join(f'{{"name":"{n}"}}' for n in names)
    ticker = F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"))
    day = F.when(F.col("l_returnflag") == "R", F.date_format("l_shipdate", "yyyyMMdd")).otherwise(
        F.date_format("l_shipdate", "yyyy-MM-dd")
    )
    flag = F.when(F.col("l_discount") == 0, "null").otherwise(
        F.concat(F.lit('"'), F.col("l_returnflag"), F.lit('"'))
    )
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    short = F.when(F.col("l_linenumber") == 7, F.concat(F.lit(',["'), ticker, F.lit('"]'))).otherwise("")
    document = F.concat(
        F.lit('{"datatable":{"columns":[' + header + '],"data":[["'), ticker, F.lit('","'), day,
        F.lit('",0,"'), F.col("l_quantity").cast("string"), F.lit('",'), flag, F.lit(","), price, F.lit("]"),
        short, F.lit(']},"meta":{"next_cursor_id":null}}'),
    )
    page = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey")
    pages = li.select("*", F.col("l_linestatus").alias("source_id"), page.alias("page"))
    pages = deal(pages) if deal else pages
    # a parser would have the text put together without generated code
    return once_per_row(pages, {"document": document}).select("source_id", "page", "document")
