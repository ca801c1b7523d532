"""The versioned instrument dimension: base rows, appended versions, delete markers, current snapshots.

Nothing is changed in place. A version holds the whole instrument as JSON from ``valid_from`` on; a
delete marker is a version without one. The newest version is the one with the greatest ``valid_from``,
even if that lies in the future.
"""

from __future__ import annotations

from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.functions.series import (
    MAX_ROWS_PER_TASK,
    by_time,
    last_known,
    newest,
    newest_n,
    ordered_scan,
    previous,
)
from pricemart.functions.text import normal_symbol, stable_id
from pricemart.schemas import INSTRUMENT_FIELDS

SUMMARY = ("instrument_id", "symbol", "instrument_class", "name", "region")
REPLACED_IF_GIVEN = ("symbol", "instrument_class", "name", "region", "currency")
REPLACED_IF_NOT_NULL = ("description", "exchange_id")
NEW_INSTRUMENT_DEFAULTS = {"instrument_class": "stock", "region": "US", "currency": "USD"}

_SNAPSHOT = T.StructType([T.StructField(name, T.StringType()) for name in INSTRUMENT_FIELDS])
_JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _written(versions: DataFrame) -> tuple[Column, ...]:
    """What orders versions of one instrument and time: when they were written; ids settle the rest."""
    when = [F.col("written_at")] if "written_at" in versions.columns else []
    return (*when, F.col("version_id"))


def _last_written_first(versions: DataFrame) -> list[Column]:
    return [c.desc_nulls_last() for c in _written(versions)]


def _newest_version(versions: DataFrame) -> DataFrame:
    # versions of one (instrument, valid_from) are one row, the last written
    return newest(versions, ["instrument_id"], F.col("valid_from").desc(), *_last_written_first(versions)).select(
        "instrument_id", "valid_from", "version_id", "is_delete_marker", "snapshot"
    )


def _parsed(snapshot: str) -> Column:
    """A version's JSON as a struct of texts; null where there is none. Parse it before joining."""
    return F.from_json(F.nullif(F.col(snapshot), F.lit("")), _SNAPSHOT).alias("_snap")


def _snapshot_or_base(rows: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """Rows with base columns and ``_snap``: the snapshot's fields where there is one."""

    def field(name: str) -> Column:
        value = F.col("_snap")[name].try_cast(rows.schema[name].dataType)
        return F.when(F.col("_snap").isNotNull(), value).otherwise(F.col(name)).alias(name)

    return rows.select(*extra, "instrument_id", *(field(name) for name in INSTRUMENT_FIELDS))


def current_instruments(base: DataFrame, versions: DataFrame) -> DataFrame:
    """Live instruments as their newest version describes them.

    No version: the base row. Newest version a delete marker: absent. No snapshot in it: the base row.
    """
    latest = _newest_version(versions).select("instrument_id", "is_delete_marker", _parsed("snapshot"))
    joined = base.join(latest, "instrument_id", "left")
    return _snapshot_or_base(joined.where(~F.coalesce("is_delete_marker", F.lit(False))))


def deleted_flags(base: DataFrame, versions: DataFrame) -> DataFrame:
    """Per instrument whether its newest version is a delete marker."""
    latest = _newest_version(versions).select("instrument_id", "is_delete_marker")
    return base.select("instrument_id").join(latest, "instrument_id", "left").select(
        "instrument_id", F.coalesce("is_delete_marker", F.lit(False)).alias("is_deleted")
    )


def instrument_summaries(current: DataFrame, page_size: int = 1000) -> DataFrame:
    """Short form of the first ``page_size`` live instruments, by id."""
    if not 1 <= page_size <= 10_000:
        raise ValueError("page_size must be between 1 and 10000")
    return current.select(*SUMMARY).orderBy("instrument_id").limit(page_size)


def instrument_by_id(current: DataFrame, instrument_id: Any) -> DataFrame:
    """The live instrument with this id, or nothing."""
    kind = current.schema["instrument_id"].dataType
    return current.where(F.col("instrument_id") == F.lit(instrument_id).cast(kind))


def source_summaries(sources: DataFrame, page_size: int = 1000) -> DataFrame:
    """Short form of the first ``page_size`` data sources, by id."""
    if not 1 <= page_size <= 10_000:
        raise ValueError("page_size must be between 1 and 10000")
    return sources.select("source_id", "source_name", "source_type").orderBy("source_id").limit(page_size)


def source_by_id(sources: DataFrame, source_id: Any) -> DataFrame:
    """All details of the data source with this id, or nothing."""
    kind = sources.schema["source_id"].dataType
    return sources.where(F.col("source_id") == F.lit(source_id).cast(kind))


def instruments_by_symbol(current: DataFrame) -> DataFrame:
    """One live instrument per symbol, compared trimmed and upper-cased: the one created last."""
    keyed = current.withColumn("symbol_key", normal_symbol(F.col("symbol")))
    return newest(keyed, ["symbol_key"], F.col("created_at").desc(), F.col("instrument_id"))


def find_by_symbol(current: DataFrame, symbol: str) -> DataFrame:
    """The live instrument with this symbol that was created last, or nothing."""
    matches = current.where(normal_symbol(F.col("symbol")) == normal_symbol(F.lit(symbol)))
    return matches.orderBy(F.col("created_at").desc(), "instrument_id").limit(1)


def summaries_of_class(base: DataFrame, instrument_class: str) -> DataFrame:
    """Short form of the base rows of a class; versions and deletes do not count here."""
    return base.where(F.col("instrument_class") == instrument_class).select(*SUMMARY)


def version_history(versions: DataFrame, max_rows: int = MAX_ROWS_PER_TASK) -> DataFrame:
    """Every version with ``valid_to`` closed by the next one (extension; stored rows leave it open).

    Versions with the same key and time are one row, the last written.
    """
    rows = newest(versions, ["instrument_id", "valid_from"], *_last_written_first(versions))
    newest_first = by_time(["instrument_id"], -F.unix_micros("valid_from"))
    closed = ordered_scan(rows.drop("valid_to"), newest_first, {"valid_to": previous("valid_from")}, max_rows)
    return closed.select(*versions.columns)


def newest_versions(versions: DataFrame, n: int) -> DataFrame:
    """The newest ``n`` versions of every instrument."""
    rows = newest(versions, ["instrument_id", "valid_from"], *_last_written_first(versions))
    return newest_n(rows, ["instrument_id"], n, F.col("valid_from").desc())


def instruments_as_of(
    base: DataFrame, versions: DataFrame, requests: DataFrame, max_rows: int = MAX_ROWS_PER_TASK
) -> DataFrame:
    """For each request (instrument_id, known_at) the instrument as of then, absent if deleted (extension)."""
    line = versions.select(
        "instrument_id", F.col("valid_from").alias("known_at"), F.lit(0).alias("_request"),
        F.struct(*_written(versions)).alias("_written"),
        F.struct("is_delete_marker", "snapshot").alias("_version"),
    ).unionByName(
        requests.select("instrument_id", "known_at", F.lit(1).alias("_request")), allowMissingColumns=True
    )
    # of versions with the same time the last written comes last
    order = by_time(["instrument_id"], F.unix_micros("known_at"), F.col("_request"), F.col("_written"))
    merged = ordered_scan(line, order, {"_known": last_known("_version")}, max_rows).where(F.col("_request") == 1)
    live = merged.where(~F.coalesce(F.col("_known.is_delete_marker"), F.lit(False)))
    described = live.select("instrument_id", "known_at", _parsed("_known.snapshot"))
    return _snapshot_or_base(described.join(base, "instrument_id"), ("known_at",))


def snapshot_json(frame: DataFrame) -> Column:
    """The whole instrument as JSON, nulls kept."""
    fields = F.struct("instrument_id", *(F.col(name) for name in INSTRUMENT_FIELDS))
    return F.to_json(fields, {"ignoreNullFields": "false", "timestampFormat": _JSON_TIME})


def save_instruments(
    entities: DataFrame, base: DataFrame, written_at: datetime | None = None
) -> tuple[DataFrame, DataFrame]:
    """(new base rows, new versions) to append for whole instruments, one row per id.

    An id without a base row is a ``create``; any other gets a version only. Of versions with the same
    ``created_at`` the one with the later ``written_at`` (now, if not given) counts.
    """
    known = base.select("instrument_id", F.lit(True).alias("_known"))
    marked = entities.join(known, "instrument_id", "left")
    created = marked.where(F.col("_known").isNull()).select("instrument_id", *INSTRUMENT_FIELDS)
    change = F.when(F.col("_known").isNull(), "create").otherwise("update")
    return created, _versions(marked, F.col("created_at"), change, False, snapshot_json(marked), written_at=written_at)


def delete_markers(
    requests: DataFrame, base: DataFrame, deleted_at: datetime, changed_by: str = "system",
    written_at: datetime | None = None,
) -> DataFrame:
    """Delete markers to append for requested ids that have a base row.

    ``requests`` may carry its own ``valid_from``; otherwise the marker is valid from ``deleted_at``.
    """
    now = F.lit(deleted_at).cast("timestamp")
    valid_from = F.coalesce("valid_from", now) if "valid_from" in requests.columns else now
    found = requests.join(base.select("instrument_id"), "instrument_id", "left_semi")
    return _versions(found, valid_from, F.lit("delete_marker"), True, F.lit(None).cast("string"), changed_by, written_at)


def _versions(
    rows: DataFrame, valid_from: Column, change: Column, marker: bool, snapshot: Column, changed_by: str = "system",
    written_at: datetime | None = None,
) -> DataFrame:
    written = F.lit(written_at or datetime.now(timezone.utc)).cast("timestamp")
    return rows.select(
        "instrument_id",
        valid_from.alias("valid_from"),
        stable_id(F.col("instrument_id"), F.unix_micros(valid_from), change, F.unix_micros(written)).alias("version_id"),
        change.alias("change_type"),
        F.lit(marker).alias("is_delete_marker"),
        snapshot.alias("snapshot"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(changed_by).alias("changed_by"),
        written.alias("written_at"),
    )


def patch_instruments(
    patches: DataFrame, current: DataFrame, max_rows: int = MAX_ROWS_PER_TASK
) -> tuple[DataFrame, DataFrame]:
    """(updated instruments, rejected patches) for patches with instrument_id and ``patched_at``.

    Symbol, class, name, region and currency change only to a non-empty value, description and
    exchange to any non-null one. Several patches of one instrument apply in time order, each giving
    one updated row, created at its own time. A patch of an instrument that is not live is rejected.
    """
    empty = F.lit("")
    given = {
        **{name: F.nullif(F.col(name), empty) for name in REPLACED_IF_GIVEN if name in patches.columns},
        **{name: F.col(name) for name in REPLACED_IF_NOT_NULL if name in patches.columns},
    }
    rows = patches.select("instrument_id", "patched_at", *(c.alias(f"_given_{n}") for n, c in given.items()))
    order = by_time(["instrument_id"], F.unix_micros("patched_at"))
    folded = ordered_scan(rows, order, {f"_new_{n}": last_known(f"_given_{n}") for n in given}, max_rows)
    updated = folded.join(current, "instrument_id").select(
        "instrument_id",
        *(
            (F.coalesce(F.col(f"_new_{n}"), F.col(n)) if n in given else F.col(n)).alias(n)
            for n in INSTRUMENT_FIELDS if n != "created_at"
        ),
        F.col("patched_at").alias("created_at"),
    )
    return updated, patches.join(current.select("instrument_id"), "instrument_id", "left_anti")


def split_delete_requests(requests: DataFrame, current: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(requests for live instruments, rejected requests)."""
    live = current.select("instrument_id")
    return requests.join(live, "instrument_id", "left_semi"), requests.join(live, "instrument_id", "left_anti")


def resolve_instruments(
    requests: DataFrame, current: DataFrame, created_at: datetime
) -> tuple[DataFrame, DataFrame]:
    """(requests with their instrument_id, instruments to create) for requested symbols.

    A live instrument with the symbol is taken; otherwise one is made, with defaults for what the
    request leaves out. Requests of one symbol in one batch share the new instrument, described by the
    first of them in ``request_order``. Its id is computed from symbol and time, so that a rerun gives
    the same id.
    """
    stamp = F.lit(created_at).cast("timestamp")
    keyed = requests.withColumn("symbol_key", normal_symbol(F.col("symbol")))
    found = instruments_by_symbol(current).select("symbol_key", F.col("instrument_id").alias("_found_id"))
    matched = keyed.join(found, "symbol_key", "left")
    new_id = stable_id(F.col("symbol_key"), F.unix_micros(stamp))
    kind = current.schema["instrument_id"].dataType
    if not isinstance(kind, T.StringType):
        new_id = F.xxhash64("symbol_key", F.unix_micros(stamp)).cast(kind)
    resolved = matched.withColumn("instrument_id", F.coalesce("_found_id", new_id))
    firsts = newest(resolved.where(F.col("_found_id").isNull()), ["symbol_key"], F.col("request_order"))

    def described(name: str) -> Column:
        if name in ("symbol", "name"):
            return F.col("symbol")
        default = F.lit(NEW_INSTRUMENT_DEFAULTS.get(name)).cast("string")
        return F.coalesce(F.col(name), default) if name in requests.columns else default

    created = firsts.select(
        "instrument_id",
        *(described(n).alias(n) for n in INSTRUMENT_FIELDS if n != "created_at"),
        stamp.alias("created_at"),
    )
    return resolved.drop("symbol_key", "_found_id"), created
