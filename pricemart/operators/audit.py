"""Reports on the load log and on job states."""

from __future__ import annotations

from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemart.functions.series import newest_n

RECENT_LIMIT = 50


def _this_year(year: int | None) -> int:
    return year or datetime.now(timezone.utc).year


def recent_load_log(log: DataFrame, source_id: Any, limit: int = RECENT_LIMIT, year: int | None = None) -> DataFrame:
    """Newest log rows of one source in a year, the current one by default."""
    one = log.where(F.col("source_id") == F.lit(source_id).cast(log.schema["source_id"].dataType))
    return one.where(F.col("log_year") == _this_year(year)).orderBy(F.col("ingested_at").desc(), "log_id").limit(limit)


def recent_load_log_per_source(log: DataFrame, limit: int = RECENT_LIMIT, year: int | None = None) -> DataFrame:
    """The same for every source; each map task keeps ``limit`` rows per source before the shuffle."""
    this = log.where(F.col("log_year") == _this_year(year))
    return newest_n(this, ["source_id"], limit, F.col("ingested_at").desc(), F.col("log_id"))


def job_states(events: DataFrame) -> DataFrame:
    """The current state of every job from its life-cycle events, as one combinable aggregation.

    The first queueing time is kept when the job starts.
    """
    moment = F.col("event_time")
    done = F.col("status").isin("completed", "failed")
    newest = F.max_by(F.struct("status", "symbol", "datatable_code", "record_count", "error_message"), moment)
    return events.groupBy("job_id").agg(
        newest.alias("_last"),
        F.min(moment).alias("queued_at"),
        F.min(F.when(F.col("status") == "running", moment)).alias("started_at"),
        F.max(F.when(done, moment)).alias("_done_at"),
    ).select(
        "job_id", "_last.symbol", "_last.datatable_code", "_last.status", "queued_at", "started_at",
        F.when(F.col("_last.status").isin("completed", "failed"), F.col("_done_at")).alias("completed_at"),
        "_last.record_count", "_last.error_message",
    )
