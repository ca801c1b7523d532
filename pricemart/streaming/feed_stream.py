"""Incremental load of landed feed pages."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pricemart.operators.instruments import current_instruments
from pricemart.plans.jobs import create_missing_instruments, load_records, with_instruments
from pricemart.sources import tables
from pricemart.sources.feed import BROKEN, page_failures, page_records, with_broken, with_page_name


def start_feed_load(spark: SparkSession, landed: str, root: str, checkpoint: str) -> StreamingQuery:
    """Load all pages landed so far under ``landed/source_id=.../`` and stop.

    Each micro-batch is one load, named by its batch id, so a batch that Spark runs again after a
    failure replaces its own rows.
    """
    schema = T.StructType([*with_broken().fields, T.StructField("source_id", T.StringType())])
    pages = with_page_name(spark.readStream.schema(schema).option("columnNameOfCorruptRecord", BROKEN).json(landed))

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # streams run without AQE, but a load is batch work that wants its skew handling and file sizes
        session.conf.set("spark.sql.adaptive.enabled", "true")
        try:
            _load(session, root, page_records(batch), f"{batch_id:012d}", page_failures(batch))
        finally:
            session.conf.set("spark.sql.adaptive.enabled", "false")

    return (
        pages.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _load(spark: SparkSession, root: str, records: DataFrame, load_batch: str, failures: DataFrame) -> None:
    now = datetime.now(timezone.utc)
    create_missing_instruments(spark, root, records, now)
    current = current_instruments(
        tables.scan(spark, root, "financial_instruments"), tables.scan(spark, root, "instrument_versions")
    )
    load_records(spark, root, with_instruments(records, current), now, load_batch, failures)
