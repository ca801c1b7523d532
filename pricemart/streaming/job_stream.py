"""Current job states kept up to date from a stream of life-cycle events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pricemart.functions.series import newest
from pricemart.operators.audit import job_states
from pricemart.schemas import JOB_EVENT
from pricemart.sources import tables


def start_job_states(spark: SparkSession, landed: str, root: str, checkpoint: str) -> StreamingQuery:
    """Fold all events landed so far into job states and stop; state is one row per job.

    Each micro-batch appends the jobs that changed, keyed by its batch id.
    """
    events = spark.readStream.schema(JOB_EVENT).json(landed)

    def save(changed: DataFrame, batch_id: int) -> None:
        tables.append_load(changed, root, "ingest_job_changes", f"{batch_id:012d}")

    return (
        job_states(events).writeStream.outputMode("update").foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def current_job_states(spark: SparkSession, root: str) -> DataFrame:
    """The last written state of every job."""
    changes = tables.scan(spark, root, "ingest_job_changes", with_load=True)
    return newest(changes, ["job_id"], F.col("load_batch").desc()).drop("load_batch")
