"""From feed records to typed, provenance-stamped price rows, with rejects and a load log."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemart.functions.rows import once_per_row
from pricemart.functions.series import newest
from pricemart.functions.text import stable_id
from pricemart.schemas import PRICE

# fixed values: vendor field -> price column
DECIMAL_FIELDS = {
    "open": "open_price",
    "high": "high_price",
    "low": "low_price",
    "close": "close_price",
    "adj_close": "adj_close",
    "ex-dividend": "ex_dividend",
    "split_ratio": "split_ratio",
}
# fixed values: vendor fields that are known but not stored
DROPPED_FIELDS = ("adj_open", "adj_high", "adj_low", "adj_volume", "ticker")
KNOWN_FIELDS = ("date", "volume", *DECIMAL_FIELDS, *DROPPED_FIELDS)

LOAD_KEY = ("source_id", "instrument_id")

#: What a row can be rejected for: how the log calls it, and what its message holds.
REJECT_KINDS = {
    "without date": "is missing required 'date' field",
    "with a date that is no text": "date must be text",
    "with an unreadable date": "Invalid isoformat string",
    "with a number that does not fit": " does not fit ",
    "with a number that is not finite": "is not a finite number",
    "of no known instrument": "Row names no known instrument",
}

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_NOT_FINITE = r"(?i)^[+-]?(s?nan[0-9]*|inf|infinity)$"
_INFINITE = r"(?i)^[+-]?(inf|infinity)$"


def _plain(text: Column) -> Column:
    """Number text without outer blanks and without underscores between digits."""
    trimmed = F.trim(text)
    joined = F.regexp_replace(trimmed, "(?<=[0-9])_(?=[0-9])", "")
    return F.when(trimmed.contains("_"), joined).otherwise(trimmed)


def to_decimal(text: Column) -> Column:
    """Decimal from any finite number text, exponents included; otherwise null."""
    # the cast leaves out blanks by itself, and reads no text with an underscore
    return F.coalesce(text.try_cast(PRICE), F.when(text.contains("_"), _plain(text).try_cast(PRICE)))


def to_integer(text: Column) -> Column:
    """Integer from number text by way of a double, cut towards zero; otherwise null."""
    number = to_decimal(text)
    # a double of few digits is the same by either way, and read much faster from text
    short = F.when(F.length(text) <= 15, text.try_cast("double"))
    return F.when(number.isNotNull(), F.coalesce(short, number.cast("double")).try_cast("bigint"))


def to_date(text: Column) -> Column:
    """Date from ISO text: calendar date, with or without dashes, or week date; otherwise null."""
    dashed = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    calendar = F.when(F.length(text) == 8, dashed).otherwise(text).try_cast("date")
    return F.when(
        text.rlike(r"^[0-9]{4}(-[0-9]{2}-[0-9]{2}|[0-9]{4})$"), F.when(~text.startswith("0000"), calendar)
    ).when(text.rlike(r"^[0-9]{4}(-W[0-9]{2}(-[1-7])?|W[0-9]{2}[1-7]?)$"), _once(text, _week_date))


def _once(value: Column, use) -> Column:
    """``use(value)`` with a value that is needed many times; keeps the generated code small."""
    return F.get(F.transform(F.array(value), use), 0)


def _week_date(dashed: Column) -> Column:
    text = F.regexp_replace(dashed, "-", "")
    year = F.substring(text, 1, 4).cast("int")
    week = F.substring(text, 6, 2).cast("int")
    weekday = F.when(F.length(text) == 8, F.substring(text, 8, 1).cast("int")).otherwise(1)
    # the fourth of January always lies in week one
    january_4 = F.make_date(F.greatest(year, F.lit(1)), F.lit(1), F.lit(4))
    found = F.date_add(january_4, (week - 1) * 7 + weekday - 1 - F.weekday(january_4))
    return F.when((week >= 1) & (F.extract(F.lit("YEAROFWEEK"), found) == year), found)


def extra_indicators(record: Column) -> Column:
    """Every field the feed map does not know, as text; a null becomes the text None."""
    unknown = F.map_filter(record, lambda name, _: ~name.isin(*KNOWN_FIELDS))
    return F.transform_values(unknown, lambda _, value: F.coalesce(value, F.lit("None")))


def _unread_reason(field: Column) -> Column:
    """Why a number that was sent came out null; null for text that is no number at all."""
    name, plain = field["name"], _plain(field["text"])
    is_volume = name == "volume"
    endless = F.when(is_volume, plain.rlike(_INFINITE)).otherwise(plain.rlike(_NOT_FINITE))
    kind = F.when(is_volume, F.lit(" does not fit a 64-bit integer")).when(
        endless, F.lit(" is not a finite number")
    ).otherwise(F.lit(" does not fit decimal(38,18)"))
    return F.when(endless | plain.rlike(_NUMBER), F.concat(name, kind))


def _reject_reason() -> Column:
    record = F.col("record")
    date_text = record["date"]
    numbers = [*DECIMAL_FIELDS.items(), ("volume", "volume")]
    unread = [F.col(column).isNull() & record[name].isNotNull() for name, column in numbers]
    texts = F.array(*(
        F.when(missing, F.struct(F.lit(column).alias("name"), record[name].alias("text")))
        for (name, column), missing in zip(numbers, unread)
    ))
    # looked into only for rows with some number that was sent and not read
    unread_reason = F.get(F.array_compact(F.transform(texts, _unread_reason)), 0)
    reason = F.coalesce(
        F.when(date_text.isNull(), _once(record, lambda r: F.when(
            F.coalesce(F.map_contains_key(r, "date"), F.lit(False)), F.lit("date must be text")
        ).otherwise(F.concat(
            F.lit("Row is missing required 'date' field: "), F.coalesce(F.to_json(r), F.lit("{}"))
        )))),
        F.when(F.col("record_date").isNull(), F.concat(F.lit("Invalid isoformat string: '"), date_text, F.lit("'"))),
        F.when(reduce(lambda a, b: a | b, unread), unread_reason),
        F.when(F.col("instrument_id").isNull(), F.lit("Row names no known instrument")),
    )
    return F.concat(F.lit("Row transform error: "), reason)


def transform_records(records: DataFrame, load_time: datetime | Column) -> DataFrame:
    """Typed price columns for every record, and ``reject_reason`` for those that cannot be stored.

    ``records`` has source_id, instrument_id and record. All rows of a load carry the same load time.
    """
    stamp = (load_time if isinstance(load_time, Column) else F.lit(load_time)).cast("timestamp")
    record = F.col("record")
    made = {
        "record_date": to_date(record["date"]),
        **{column: to_decimal(record[name]) for name, column in DECIMAL_FIELDS.items()},
        "volume": to_integer(record["volume"]),
        "extra_indicators": extra_indicators(record),
        "system_date": stamp,
        "ingested_at": stamp,
    }
    kept = [F.col(f"`{c}`") for c in records.columns if c not in made]
    typed = records.select(*kept, *(c.alias(name) for name, c in made.items()))
    checked = typed.withColumns({"record_year": F.year("record_date"), "reject_reason": _reject_reason()})
    # a projection generates code for all but its lambdas, so the work is done there, and only kept from being done again here
    return once_per_row(checked, {"reject_reason": F.col("reject_reason")})


def accepted(transformed: DataFrame) -> DataFrame:
    """The rows to store as prices."""
    return transformed.where(F.col("reject_reason").isNull()).drop("record", "reject_reason")


def last_of_load(rows: DataFrame) -> DataFrame:
    """The accepted rows of a load that are left under the price key: the last in page and row order.

    Every map task keeps one row per key before the shuffle.
    """
    places = [F.col(c).desc_nulls_last() for c in ("landed", "page", "position") if c in rows.columns]
    key = ("instrument_id", "source_id", "record_date", "system_date")
    return newest(rows, key, *places) if places else rows.dropDuplicates(list(key))


def load_errors(transformed: DataFrame) -> DataFrame:
    """One row per rejected record, with its whole content and message."""
    kept = [c for c in ("page", "position") if c in transformed.columns]
    return transformed.where(F.col("reject_reason").isNotNull()).select(
        *LOAD_KEY, "ingested_at", *kept, "record", F.col("reject_reason").alias("error_message")
    )


def load_log(transformed: DataFrame, duration_ms: int | None = None, failures: DataFrame | None = None) -> DataFrame:
    """One log row per load with fetched, stored and skipped counts.

    Rejected rows leave the status at ``success``; only a load listed in ``failures`` (source_id,
    instrument_id, ingested_at, error) is an ``error``. The message says how many rows were rejected for
    each of REJECT_KINDS, in that order, and ends with the failure; every single message is a row of the load
    errors. All of it is counts, combined map-side, whatever the size of a load.
    """
    load = [*LOAD_KEY, "ingested_at"]
    reason = F.col("reject_reason")
    kind = F.coalesce(*(F.when(reason.contains(mark), F.lit(name)) for name, mark in REJECT_KINDS.items()))
    counts = transformed.withColumn("_kind", kind).groupBy(*load).agg(
        F.count(F.lit(1)).alias("fetched"),
        F.count_if(reason.isNull()).alias("stored"),
        F.count_if(reason.isNotNull()).alias("skipped"),
        *(F.count_if(F.col("_kind") == name).alias(f"_rows_{n}") for n, name in enumerate(REJECT_KINDS)),
    )
    if failures is None:
        counts = counts.withColumn("error", F.lit(None).cast("string"))
    else:
        # pages that name no instrument are a load of their own
        lost = failures.select(*(F.col(c).alias(f"_lost_{c}") for c in load), "error")
        same = reduce(lambda a, b: a & b, (counts[c].cast("string").eqNullSafe(lost[f"_lost_{c}"].cast("string")) for c in load))
        counts = counts.join(lost, same, "full_outer").withColumns(
            {c: F.coalesce(c, F.col(f"_lost_{c}").cast(counts.schema[c].dataType)) for c in load}
        )
    messages = [
        F.when(F.col(f"_rows_{n}") > 0, F.concat(F.col(f"_rows_{n}").cast("string"), F.lit(f" rows {name}")))
        for n, name in enumerate(REJECT_KINDS)
    ]
    message = F.concat_ws("; ", *messages, "error")
    zero = F.lit(0).cast("bigint")
    return counts.select(
        *load,
        F.year("ingested_at").alias("log_year"),
        stable_id(*(F.col(c) for c in load)).alias("log_id"),
        F.when(F.col("error").isNull(), "success").otherwise("error").alias("status"),
        F.coalesce("fetched", zero).alias("fetched"),
        F.coalesce("stored", zero).alias("record_count"),
        F.coalesce("skipped", zero).alias("skipped"),
        F.when(message != "", message).alias("error_message"),
        F.lit(duration_ms).cast("bigint").alias("duration_ms"),
    )


def job_outcomes(log: DataFrame) -> DataFrame:
    """How the job of each load ends: completed only without any message."""
    return log.select(
        *LOAD_KEY, "ingested_at",
        F.when(F.col("error_message").isNull(), "completed").otherwise("failed").alias("status"),
        "record_count", "error_message",
    )


def observed_columns(records: DataFrame) -> DataFrame:
    """Sorted field names seen per source, rejected records included."""
    names = records.select("source_id", F.explode(F.map_keys("record")).alias("name")).distinct()
    return names.groupBy("source_id").agg(F.sort_array(F.collect_set("name")).alias("attributes"))


def with_observed_columns(sources: DataFrame, observed: DataFrame) -> DataFrame:
    """Sources with their attributes replaced where a load saw columns."""
    seen = observed.select("source_id", F.col("attributes").alias("_seen"))
    columns = [
        F.coalesce("_seen", "attributes").alias("attributes") if c == "attributes" else F.col(c)
        for c in sources.columns
    ]
    return sources.join(seen, "source_id", "left").select(*columns)
