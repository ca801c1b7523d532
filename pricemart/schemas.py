"""Table schemas, keys and delete policies of the warehouse."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PRICE = T.DecimalType(38, 18)
TEXT = T.StringType()
TIME = T.TimestampType()


def _struct(required: dict[str, T.DataType], optional: dict[str, T.DataType]) -> T.StructType:
    fields = [T.StructField(name, kind, False) for name, kind in required.items()]
    fields += [T.StructField(name, kind, True) for name, kind in optional.items()]
    return T.StructType(fields)


@dataclass(frozen=True)
class TableSpec:
    """How one table is keyed, laid out and deleted from.

    ``key`` is the full primary key: two writes with the same key are one row.
    ``group`` is its leading part, inside which ``newest_by`` (descending) picks the latest row.
    ``delete`` is one of ``remove`` (physically), ``keep`` (append-only, deletes do nothing),
    ``refuse`` (deletes are an error) and ``marker`` (deletes append a row).
    ``by_load`` tables are append-only and keep the rows of every load under a name of its own.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    group: tuple[str, ...]
    newest_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    delete: str = "keep"
    by_load: bool = False


INSTRUMENT_FIELDS = ("symbol", "instrument_class", "name", "region", "currency", "exchange_id", "description", "created_at")

JOB = _struct(
    {"job_id": TEXT},
    {
        "symbol": TEXT, "datatable_code": TEXT, "status": TEXT, "queued_at": TIME, "started_at": TIME,
        "completed_at": TIME, "record_count": T.IntegerType(), "error_message": TEXT,
    },
)

_SPECS = [
    TableSpec(
        "financial_instruments",
        _struct(
            {"instrument_id": TEXT},
            {
                "symbol": TEXT, "instrument_class": TEXT, "name": TEXT, "region": TEXT, "currency": TEXT,
                "exchange_id": TEXT, "description": TEXT, "created_at": TIME,
            },
        ),
        key=("instrument_id",), group=("instrument_id",), delete="marker",
    ),
    TableSpec(
        "instrument_versions",
        _struct(
            {"instrument_id": TEXT, "valid_from": TIME, "version_id": TEXT, "change_type": TEXT},
            {
                "is_delete_marker": T.BooleanType(), "snapshot": TEXT, "valid_to": TIME, "changed_by": TEXT,
                "written_at": TIME,
            },
        ),
        key=("instrument_id", "valid_from"), group=("instrument_id",), newest_by=("valid_from",), delete="keep",
    ),
    TableSpec(
        "data_sources",
        _struct(
            {"source_id": TEXT, "source_name": TEXT, "source_type": TEXT},
            {
                "base_url": TEXT, "api_key_required": T.BooleanType(), "description": TEXT,
                "attributes": T.ArrayType(TEXT), "created_at": TIME,
            },
        ),
        key=("source_id",), group=("source_id",), delete="remove",
    ),
    TableSpec(
        "prices",
        _struct(
            {
                "instrument_id": TEXT, "source_id": TEXT, "record_year": T.IntegerType(),
                "record_date": T.DateType(), "system_date": TIME,
            },
            {
                "open_price": PRICE, "close_price": PRICE, "high_price": PRICE, "low_price": PRICE,
                "adj_close": PRICE, "volume": T.LongType(), "ex_dividend": PRICE, "split_ratio": PRICE,
                "extra_indicators": T.MapType(TEXT, TEXT), "ingested_at": TIME,
            },
        ),
        key=("instrument_id", "source_id", "record_year", "record_date", "system_date"),
        group=("instrument_id", "source_id", "record_date"),
        newest_by=("system_date",), partition_by=("source_id", "record_year"), delete="marker", by_load=True,
    ),
    TableSpec(
        "price_summaries",
        _struct(
            {"instrument_id": TEXT, "source_id": TEXT, "record_year": T.IntegerType()},
            {
                "row_count": T.LongType(), "close_count": T.LongType(), "min_close": PRICE, "max_close": PRICE, "sum_close": PRICE,
                "total_volume": T.LongType(), "first_close": PRICE, "last_close": PRICE, "return_sum": T.DoubleType(),
                "return_count": T.LongType(), "fall": T.DoubleType(),
            },
        ),
        key=("instrument_id", "source_id", "record_year"), group=("instrument_id", "source_id"),
        newest_by=("record_year",), partition_by=("record_year",), delete="keep",
    ),
    TableSpec(
        "rolling_averages",
        _struct(
            {
                "instrument_id": TEXT, "source_id": TEXT, "window_days": T.IntegerType(), "record_date": T.DateType(),
            },
            {
                "close_price": T.DoubleType(), "rolling_avg_close": T.DoubleType(),
                "observation_count": T.IntegerType(), "computed_at": TIME,
            },
        ),
        key=("instrument_id", "source_id", "window_days", "record_date"),
        group=("instrument_id", "source_id", "window_days"), newest_by=("record_date",),
        partition_by=("window_days", "source_id"), delete="keep",
    ),
    TableSpec(
        "price_predictions",
        _struct(
            {"instrument_id": TEXT, "source_id": TEXT, "prediction_generated_at": TIME, "model_run_id": TEXT},
            {
                "last_record_date": T.DateType(), "predicted_next_close": T.DoubleType(), "model_path": TEXT,
                "training_rows": T.LongType(), "training_rmse": T.DoubleType(),
            },
        ),
        key=("instrument_id", "source_id", "prediction_generated_at", "model_run_id"),
        group=("instrument_id", "source_id"), newest_by=("prediction_generated_at",), delete="keep",
    ),
    TableSpec(
        "ingest_jobs",
        JOB,
        key=("job_id",), group=("job_id",), delete="refuse",
    ),
    TableSpec(
        "ingest_job_changes",
        JOB,
        key=("job_id",), group=("job_id",), delete="refuse", by_load=True,
    ),
    TableSpec(
        "ingest_log",
        _struct(
            {"source_id": TEXT, "log_year": T.IntegerType(), "ingested_at": TIME},
            {
                "log_id": TEXT, "instrument_id": TEXT, "status": TEXT, "record_count": T.LongType(),
                "error_message": TEXT, "duration_ms": T.LongType(),
            },
        ),
        key=("source_id", "log_year", "ingested_at", "log_id"), group=("source_id", "log_year"),
        newest_by=("ingested_at",), partition_by=("log_year",), delete="keep", by_load=True,
    ),
    TableSpec(
        "question_log",
        _struct(
            {"user_id": TEXT, "session_id": TEXT, "asked_at": TIME},
            {
                "query_id": TEXT, "user_prompt": TEXT, "tools_invoked": TEXT, "llm_response": TEXT,
                "duration_ms": T.LongType(),
            },
        ),
        key=("user_id", "session_id", "asked_at"), group=("user_id", "session_id"),
        newest_by=("asked_at",), delete="keep",
    ),
    TableSpec(
        "exchanges",
        _struct(
            {"exchange_id": TEXT, "exchange_name": TEXT},
            {"country": TEXT, "timezone": TEXT, "currency": TEXT, "open_time": TEXT, "close_time": TEXT},
        ),
        key=("exchange_id",), group=("exchange_id",), delete="remove",
    ),
    TableSpec(
        "owners",
        _struct(
            {"owner_id": TEXT, "owner_type": TEXT, "name": TEXT},
            {"email": TEXT, "phone": TEXT, "country": TEXT, "created_at": TIME},
        ),
        key=("owner_id",), group=("owner_id",), delete="remove",
    ),
    TableSpec(
        "users",
        _struct(
            {"user_id": TEXT, "owner_id": TEXT, "username": TEXT, "role": TEXT},
            {"registered_at": TIME, "last_login_at": TIME},
        ),
        key=("user_id",), group=("user_id",), delete="remove",
    ),
    TableSpec(
        "portfolios",
        _struct(
            {"owner_id": TEXT, "portfolio_id": TEXT, "name": TEXT, "base_currency": TEXT},
            {"description": TEXT, "created_at": TIME, "is_active": T.BooleanType()},
        ),
        key=("owner_id", "portfolio_id"), group=("owner_id", "portfolio_id"), delete="remove",
    ),
    TableSpec(
        "portfolio_assets",
        _struct(
            {"portfolio_id": TEXT, "instrument_id": TEXT, "added_at": TIME, "symbol": TEXT, "instrument_class": TEXT},
            {"removed_at": TIME, "quantity": PRICE, "purchase_price": PRICE, "notes": TEXT},
        ),
        key=("portfolio_id", "instrument_id", "added_at"), group=("portfolio_id", "instrument_id"),
        newest_by=("added_at",), delete="remove",
    ),
    TableSpec(
        "analytics_results",
        _struct(
            {"instrument_id": TEXT, "source_id": TEXT, "computed_at": TIME, "result_id": TEXT, "metric_type": TEXT},
            {"metric_value": PRICE, "window_days": T.IntegerType(), "notes": TEXT},
        ),
        key=("instrument_id", "source_id", "computed_at", "result_id"),
        group=("instrument_id", "source_id"), newest_by=("computed_at",), delete="keep",
    ),
    TableSpec(
        "risk_signals",
        _struct(
            {"instrument_id": TEXT, "generated_at": TIME, "signal_id": TEXT, "signal_type": TEXT, "severity": TEXT},
            {"value": PRICE, "explanation": TEXT, "result_id": TEXT},
        ),
        key=("instrument_id", "generated_at", "signal_id"), group=("instrument_id",),
        newest_by=("generated_at",), delete="keep",
    ),
    TableSpec(
        "recommendations",
        _struct(
            {"user_id": TEXT, "created_at": TIME, "action": TEXT},
            {
                "recommendation_id": TEXT, "portfolio_id": TEXT, "signal_id": TEXT, "rationale": TEXT,
                "expires_at": TIME, "was_acted_on": T.BooleanType(),
            },
        ),
        key=("user_id", "created_at", "recommendation_id"), group=("user_id",),
        newest_by=("created_at",), delete="keep",
    ),
]

TABLES: dict[str, TableSpec] = {spec.name: spec for spec in _SPECS}

# one landed feed page: a column header, data rows as arrays of scalars, a cursor to the next page
FEED_PAGE = T.StructType([
    T.StructField("datatable", T.StructType([
        T.StructField("columns", T.ArrayType(T.StructType([T.StructField("name", TEXT)]))),
        T.StructField("data", T.ArrayType(T.ArrayType(TEXT))),
    ])),
    T.StructField("meta", T.StructType([T.StructField("next_cursor_id", TEXT)])),
])

JOB_EVENT = T.StructType([
    T.StructField("job_id", TEXT, False),
    T.StructField("symbol", TEXT),
    T.StructField("datatable_code", TEXT),
    T.StructField("status", TEXT),
    T.StructField("event_time", TIME),
    T.StructField("record_count", T.IntegerType()),
    T.StructField("error_message", TEXT),
])
