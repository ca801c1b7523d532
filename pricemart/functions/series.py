"""Ordered columns over a series of any length: windows over pieces of it, and summaries that carry over.

A window over ``partitionBy(series)`` puts a whole series into one task. Series with more than ``max_rows`` rows are
cut along their own order, by time buckets; the window runs inside (series, bucket), every bucket is reduced to one
summary row, the summaries are carried forward over the buckets of a series, and joined back. A bucket with more than
``max_rows`` rows is cut further, by shorter parts of time; a part with more than that by the exact place, and rows
of one place, which may come in any order, by a hash. It is one plan for every size: where no series is that long,
adaptive execution finds the parts about pieces empty and leaves them out. Where the cuts are changes no result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_ROWS_PER_TASK = 4_000_000
#: Pieces that rows of one and the same place are dealt to, where there are too many.
EQUAL_PLACES = 64

_MICROS_A_DAY = 86_400_000_000
_BUCKET_DAYS = 32
#: A part is 2**32 microseconds, an hour and a bit.
_PART_BITS = 32


@dataclass(frozen=True)
class SeriesOrder:
    """The key of a series and the order of its rows.

    ``place`` lists ascending expressions that order the rows of one series; rows that are equal in all of them may
    come in any order. ``bucket`` and ``part`` never decrease along that order, ``part`` inside a bucket; they are
    used only to cut pieces.
    """

    keys: tuple[str, ...]
    bucket: Column
    part: Column
    place: tuple[Column, ...]


def by_day(keys: Sequence[str], day: Column, *then: Column) -> SeriesOrder:
    """Rows by day, a number, and inside it by ``then``; the first of these, if any, is in microseconds."""
    part = F.struct(day.alias("day"), F.shiftright(then[0].cast("long"), _PART_BITS).alias("part")) if then else day
    return SeriesOrder(tuple(keys), F.floor(day / _BUCKET_DAYS), part, (day, *then))


def by_time(keys: Sequence[str], micros: Column, *then: Column) -> SeriesOrder:
    """Rows by time in microseconds, then by ``then``."""
    bucket = F.floor(F.shiftright(micros, _PART_BITS) / (_BUCKET_DAYS * _MICROS_A_DAY >> _PART_BITS))
    return SeriesOrder(tuple(keys), bucket, F.shiftright(micros, _PART_BITS), (micros, *then))


def previous(value: str) -> tuple[str, str]:
    """The last non-null ``value`` before this row."""
    return ("previous", value)


def last_known(value: str) -> tuple[str, str]:
    """The last non-null ``value`` up to and including this row."""
    return ("last_known", value)


def running_max(value: str) -> tuple[str, str]:
    """The greatest ``value`` up to and including this row."""
    return ("running_max", value)


def newest(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row per key in ``order``. Every map task keeps one row per key before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def newest_n(df: DataFrame, keys: Sequence[str], n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows per key in ``order``, limited map-side in the same way.

    The rows that many tasks keep for one hot key are limited once more in groups of their own, as many as
    the square root of the number of tasks, so neither step gathers more than that many times ``n`` rows.
    """
    salts = math.ceil(math.sqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*_hashable(df)), F.lit(salts)))
    return _first_rows(_first_rows(salted, [*keys, "_salt"], n, order).drop("_salt"), keys, n, order)


def _hashable(df: DataFrame) -> list[Column]:
    """The columns of a frame that can be hashed: all but those that hold maps."""
    return [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]


def _first_rows(df: DataFrame, keys: Sequence[str], n: int, order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def ordered_scan(
    df: DataFrame,
    series: SeriesOrder,
    columns: dict[str, tuple[str, str]],
    max_rows: int | None = MAX_ROWS_PER_TASK,
) -> DataFrame:
    """Add ``columns`` (see :func:`previous`, :func:`last_known`, :func:`running_max`) to every row.

    ``max_rows=None`` says that the length of a series is bounded, and leaves it in one piece.
    """
    if max_rows is None:
        window = Window.partitionBy(*series.keys).orderBy(*series.place)
        return df.select("*", *(_in_window(spec, window).alias(name) for name, spec in columns.items()))

    pieces = _in_pieces(df, series, max_rows)
    window = Window.partitionBy("_piece").orderBy(*series.place)
    local = pieces.select("*", *(_in_window(spec, window).alias(f"_in_{name}") for name, spec in columns.items()))

    place = F.struct(*series.place)
    summary = pieces.where(F.col("_piece.at").isNotNull()).groupBy("_piece").agg(
        *(_summary(spec, place).alias(f"_all_{name}") for name, spec in columns.items())
    )
    before = Window.partitionBy("_piece.series").orderBy("_piece.at").rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        "_piece",
        *(_carry(spec, F.col(f"_all_{name}")).over(before).alias(f"_before_{name}") for name, spec in columns.items()),
    )
    # the rows already lie by piece, a struct, which is never null: only the summaries are moved to them
    joined = local.join(carried, "_piece", "left")
    return joined.select(
        *(F.col(f"`{c}`") for c in df.columns),
        *(
            _combine(spec, F.col(f"_in_{name}"), F.col(f"_before_{name}")).alias(name)
            for name, spec in columns.items()
        ),
    )


def _in_pieces(df: DataFrame, series: SeriesOrder, max_rows: int) -> DataFrame:
    """``df`` with ``_piece``: the series, and the place of the piece in it, null for series that are one piece."""
    # a struct of the keys is never null, so series without a key meet in plain joins
    rows = df.select("*", F.struct(*series.keys).alias("_series"), series.bucket.alias("_bucket"))
    sizes = rows.groupBy("_series", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    crowded = F.collect_list(F.when(F.col("_n") > max_rows, F.col("_bucket"))).alias("_crowded")
    # fewer than all rows divided by max_rows, both the series and what they list
    long = sizes.groupBy("_series").agg(F.sum("_n").alias("_n"), crowded).where(F.col("_n") > max_rows)
    rows = rows.join(F.broadcast(long.select("_series", "_crowded")), "_series", "left")
    part = F.when(F.array_contains("_crowded", F.col("_bucket")), series.part).alias("_part")

    group = ["_series", "_bucket", "_part"]
    rows = rows.select("*", part)
    parts = rows.where("_part IS NOT NULL").groupBy(*group).agg(F.count(F.lit(1)).alias("_full")).where(F.col("_full") > max_rows)
    share = F.pmod(F.xxhash64(*_hashable(df)), F.lit(EQUAL_PLACES))
    within = F.when(F.col("_full").isNotNull(), F.struct(F.struct(*series.place).alias("place"), share.alias("share")))
    at = F.when(F.col("_crowded").isNotNull(), F.struct("_bucket", "_part", within.alias("within")))
    piece = F.struct(F.col("_series").alias("series"), at.alias("at")).alias("_piece")
    return rows.join(F.broadcast(parts), group, "left").select(*(F.col(f"`{c}`") for c in df.columns), piece)


def _in_window(spec: tuple[str, str], window) -> Column:
    kind, value = spec
    if kind == "previous":
        return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))
    if kind == "last_known":
        return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return F.max(value).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))


def _summary(spec: tuple[str, str], place: Column) -> Column:
    kind, value = spec
    if kind == "running_max":
        return F.max(value)
    return F.max_by(value, F.when(F.col(value).isNotNull(), place))


def _carry(spec: tuple[str, str], summary: Column) -> Column:
    return F.max(summary) if spec[0] == "running_max" else F.last(summary, ignorenulls=True)


def _combine(spec: tuple[str, str], inside: Column, before: Column) -> Column:
    return F.greatest(inside, before) if spec[0] == "running_max" else F.coalesce(inside, before)
