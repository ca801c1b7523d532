"""Warehouse jobs: read tables, run operators, write tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pricemart.functions.text import normal_symbol, stable_id
from pricemart.operators import ingest
from pricemart.operators.instruments import (
    current_instruments,
    instruments_by_symbol,
    resolve_instruments,
    save_instruments,
)
from pricemart.operators.prices import filter_price_history, latest_daily_prices
from pricemart.operators.regression import (
    MIN_TRAINING_ROWS,
    latest_features,
    predict_next,
    prediction_rows,
    price_features,
    series_models,
    train_series,
)
from pricemart.operators.rolling import DEFAULT_WINDOW, rolling_average
from pricemart.session import scratch_path, shared_dir
from pricemart.sources import tables
from pricemart.sources.commits import Folder


@dataclass(frozen=True)
class PriceRange:
    """Which part of the price history a job reads; empty means all."""

    instrument_id: Any = None
    source_id: Any = None
    start_date: date | None = None
    end_date: date | None = None

    def of(self, prices: DataFrame) -> DataFrame:
        return filter_price_history(
            prices, instrument_id=self.instrument_id, source_id=self.source_id,
            start_date=self.start_date, end_date=self.end_date,
        )


def daily_prices(spark: SparkSession, root: str, part: PriceRange) -> DataFrame:
    """Latest daily prices of a range; the filters reach the scan."""
    return latest_daily_prices(part.of(tables.scan(spark, root, "prices")))


def rolling_average_job(
    spark: SparkSession, root: str, window_days: int = DEFAULT_WINDOW, part: PriceRange = PriceRange()
) -> int:
    """Write rolling averages of the range and return how many rows there are."""
    averages = rolling_average(daily_prices(spark, root, part), window_days, datetime.now(timezone.utc))
    # counted while they are written
    counted = Observation("rolling averages")
    tables.upsert(spark, root, "rolling_averages", averages.observe(counted, F.count(F.lit(1)).alias("rows")))
    return counted.get["rows"]


def series_regression_job(
    spark: SparkSession,
    root: str,
    part: PriceRange,
    model_path: str,
    min_training_rows: int = MIN_TRAINING_ROWS,
    overwrite_model: bool = True,
    write_prediction: bool = True,
) -> dict[str, Any]:
    """Train on one series, save the model and append its prediction."""
    if part.instrument_id in (None, "") or part.source_id in (None, ""):
        raise ValueError("a single-series model needs an instrument and a source")
    features = price_features(daily_prices(spark, root, part)).persist()
    try:
        if latest_features(features).isEmpty():
            raise ValueError("the series has no row with all features, so there is nothing to predict from")
        model, prediction, count, rmse = train_series(features, min_training_rows)
        writer = model.write().overwrite() if overwrite_model else model.write()
        writer.save(model_path)
        row = prediction.select("record_date", "prediction").first()
        run_id = str(uuid.uuid4())
        if write_prediction:
            record = prediction_rows(prediction, run_id, model_path, count, rmse, datetime.now(timezone.utc))
            tables.append(record, root, "price_predictions")
    finally:
        features.unpersist()
    return {
        "model_run_id": run_id, "last_record_date": row["record_date"],
        "predicted_next_close": row["prediction"], "training_rows": count, "training_rmse": rmse,
    }


def all_series_regression_job(
    spark: SparkSession,
    root: str,
    part: PriceRange = PriceRange(),
    min_training_rows: int = MIN_TRAINING_ROWS,
) -> str:
    """Fit every series of the range; write the coefficient table and the predictions. Returns the run id."""
    run_id, now = str(uuid.uuid4()), datetime.now(timezone.utc)
    features = price_features(daily_prices(spark, root, part))
    path = f"{tables.table_path(root, 'series_models')}/model_run_id={run_id}"
    series_models(features, min_training_rows).write.mode("overwrite").parquet(path)
    models = spark.read.parquet(path)
    predictions = predict_next(models, features).withColumns({
        "prediction_generated_at": F.lit(now).cast("timestamp"),
        "model_run_id": F.lit(run_id), "model_path": F.lit(path),
    })
    tables.append(predictions, root, "price_predictions")
    return run_id


def with_instruments(records: DataFrame, current: DataFrame) -> DataFrame:
    """Feed records with the instrument that their ticker names."""
    symbols = instruments_by_symbol(current).select("symbol_key", "instrument_id")
    keyed = records.withColumn("symbol_key", normal_symbol(F.col("record")["ticker"]))
    return keyed.join(symbols, "symbol_key", "left").drop("symbol_key")


def create_missing_instruments(spark: SparkSession, root: str, records: DataFrame, load_time: datetime) -> None:
    """Append instruments for tickers that no live instrument has."""
    base, versions = tables.scan(spark, root, "financial_instruments"), tables.scan(spark, root, "instrument_versions")
    ticker = F.col("record")["ticker"].alias("symbol")
    requests = records.select(ticker).where(F.col("symbol").isNotNull()).distinct().withColumn(
        "request_order", F.col("symbol")
    )
    _, created = resolve_instruments(requests, current_instruments(base, versions), load_time)
    shared_dir(spark)
    created = created.checkpoint()
    new_base, new_versions = save_instruments(created, base, load_time)
    tables.append(new_versions, root, "instrument_versions")
    tables.append(new_base, root, "financial_instruments")


def load_records(
    spark: SparkSession, root: str, records: DataFrame, load_time: datetime, load_batch: str,
    failures: DataFrame | None = None,
) -> None:
    """Load feed records that carry source_id and instrument_id: prices, rejects, log, jobs, sources.

    ``failures`` (source_id, instrument_id, error) are logged with status ``error``. A source that is not
    known yet is saved with the columns that were seen. Every output is keyed by ``load_batch``: loading the
    same batch again replaces what it wrote.
    """
    # kept as a compressed table: every later step reads only its own columns, in parts that do not grow with those of the feed
    kept = scratch_path(spark, "transformed")
    ingest.transform_records(records, load_time).write.parquet(kept)
    transformed = spark.read.parquet(kept)
    try:
        tables.append_load(ingest.last_of_load(ingest.accepted(transformed)), root, "prices", load_batch)
        errors = ingest.load_errors(transformed).withColumn("load_batch", F.lit(load_batch))
        errors.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load_batch").parquet(tables.table_path(root, "load_errors"))
        took = int((datetime.now(timezone.utc) - load_time).total_seconds() * 1000)
        if failures is not None:
            # one row per source, read by the log and by the jobs
            failures = failures.withColumn("ingested_at", F.lit(load_time).cast("timestamp")).checkpoint()
        log = ingest.load_log(transformed, took, failures)
        tables.append_load(log, root, "ingest_log", load_batch)
        states = ingest.job_outcomes(log).select(
            stable_id(F.col("source_id"), F.col("instrument_id")).alias("job_id"), "status", "record_count", "error_message",
            F.col("ingested_at").alias("started_at"), F.lit(datetime.now(timezone.utc)).cast("timestamp").alias("completed_at"),
        )
        tables.append_load(states, root, "ingest_job_changes", load_batch)
        sources = tables.scan(spark, root, "data_sources")
        seen = ingest.observed_columns(transformed)
        loaded = seen.select(F.col("source_id").cast("string")).join(sources, "source_id", "left")
        loaded = loaded.withColumn("source_name", F.coalesce("source_name", "source_id"))
        tables.upsert(spark, root, "data_sources", ingest.with_observed_columns(loaded, seen))
    finally:
        Folder(spark, kept).remove("")
