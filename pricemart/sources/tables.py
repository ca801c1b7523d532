"""Parquet tables: scan, append, upsert by key, delete by policy, compaction, latest and history reads.

Every change writes to a folder of its own and counts at once, when the table's list of live folders names it
(:mod:`pricemart.sources.commits`). Tables kept by load carry the name of its load with every row.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.functions.series import newest
from pricemart.schemas import TABLES, TableSpec
from pricemart.sources import commits
from pricemart.sources.commits import Entry, Folder


class DeleteRefused(RuntimeError):
    """The table keeps its history and accepts no such delete."""


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def scan(spark: SparkSession, root: str, name: str, with_load: bool = False) -> DataFrame:
    """A table by name, with its declared schema; empty if nothing was written yet.

    ``with_load`` adds the ``load_batch`` of the rows of a table kept by load.
    """
    _, entries = commits.live(Folder(spark, table_path(root, name)))
    return _read(spark, root, TABLES[name], [e.path for e in entries], with_load)


def scan_key(spark: SparkSession, root: str, name: str, value: Any) -> DataFrame:
    """The rows whose first key column is ``value``; of compacted folders only the files that can have it are read."""
    spec, path = TABLES[name], table_path(root, name)
    kind = spec.schema[spec.key[0]].dataType
    _, entries = commits.live(Folder(spark, path))
    files = [e.path for e in entries if not e.ranges]
    for entry in (e for e in entries if e.ranges):
        ranges = spark.read.parquet(f"{path}/{entry.ranges}")
        meets = ranges.where(F.lit(value).cast(kind).between(F.col("least"), F.col("greatest")))
        files += [f"{entry.path}/{r['file']}" for r in meets.select("file").collect()]
    return _read(spark, root, spec, files).where(F.col(spec.key[0]) == F.lit(value).cast(kind))


def _read(spark: SparkSession, root: str, spec: TableSpec, live: list[str], with_load: bool = False) -> DataFrame:
    schema, columns = spec.schema, list(spec.schema.names)
    if spec.by_load:
        schema = T.StructType([*schema, T.StructField("load_batch", T.StringType())])
        columns += ["load_batch"] * with_load
    if not live:
        return spark.createDataFrame([], schema).select(*columns)
    path = table_path(root, spec.name)
    rows = spark.read.schema(schema).option("basePath", path).parquet(*(f"{path}/{part}" for part in live))
    return rows.select(*columns)


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns of the table in its order and types; those not supplied are null."""
    given = set(df.columns)
    return df.select(*(
        (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name) for f in spec.schema
    ))


def _write(df: DataFrame, root: str, spec: TableSpec, load: str | None = None) -> list[Entry]:
    """Write rows to a new folder and list it, or its partitions where a table replaces partitions. Nothing counts yet."""
    name, path = commits.new_commit(), table_path(root, spec.name)
    partitions = list(spec.partition_by)
    if partitions:
        # AQE sizes the output files and splits a partition value that holds much of the data
        df = df.hint("rebalance", *partitions)
    if load is not None:
        df = df.withColumn("load_batch", F.lit(load))
    writer = df.write.partitionBy(*partitions) if partitions else df.write
    writer.parquet(f"{path}/{name}")
    if spec.by_load:
        return [Entry(name, (load,))]
    return [Entry(found) for found in _partitions(Folder(df.sparkSession, path), name, len(partitions))]


def _partitions(folder: Folder, name: str, depth: int) -> list[str]:
    if not depth:
        return [name]
    inner = [n for n in folder.names(name) if "=" in n]
    return [p for n in inner for p in _partitions(folder, f"{name}/{n}", depth - 1)]


def _place(entry: Entry) -> str:
    """The partition of an entry, whatever commit it is from."""
    return entry.path.partition("/")[2]


def append(df: DataFrame, root: str, name: str) -> None:
    """Add rows to an append-only table."""
    spec = TABLES[name]
    new = _write(conform(df, spec), root, spec, commits.new_commit() if spec.by_load else None)
    commits.commit(Folder(df.sparkSession, table_path(root, name)), lambda live: live + new)


def append_load(df: DataFrame, root: str, name: str, load_batch: str) -> None:
    """Add the rows of one load. Writing the same load again replaces it, so a retry adds nothing.

    A load that was compacted is closed: it is all there, and is not written again.
    """
    spec, folder = TABLES[name], Folder(df.sparkSession, table_path(root, name))
    if not spec.by_load:
        raise ValueError(f"{name} is not kept by load")

    def closed(live: list[Entry]) -> bool:
        return any(e.ranges and load_batch in e.loads for e in live)

    if closed(commits.live(folder)[1]):
        return
    new = _write(conform(df, spec), root, spec, load_batch)

    def change(live: list[Entry]) -> list[Entry]:
        return live if closed(live) else [e for e in live if load_batch not in e.loads] + new

    commits.commit(folder, change)


def last_write(rows: DataFrame, key: tuple[str, ...], *written: Column) -> DataFrame:
    """One row per key: the last in ``written`` (ascending order of writing)."""
    return newest(rows, key, *(w.desc() for w in written))


def upsert(spark: SparkSession, root: str, name: str, new: DataFrame, *written: Column) -> None:
    """Write rows by primary key. Only the partitions present in ``new`` are rewritten.

    Without ``written`` the new rows must have distinct keys. They are computed and written once; then the old rows
    of the same partitions that they do not replace are written beside them, and both count at once.
    """
    spec, folder = TABLES[name], Folder(spark, table_path(root, name))
    if spec.by_load:
        raise ValueError(f"{name} is append-only; collapse its versions when reading, with last_write")
    if written:
        new = last_write(new, spec.key, *written)
    fresh = _write(conform(new, spec), root, spec)
    touched = {_place(e) for e in fresh}

    def changed(before: list[Entry]) -> list[Entry]:
        old = [e for e in before if _place(e) in touched]
        if not old:
            return before + fresh
        rows, keys = (_read(spark, root, spec, [e.path for e in part]) for part in (old, fresh))
        left = _write(rows.join(keys.select(*spec.key), list(spec.key), "left_anti").select(*rows.columns), root, spec)
        return [e for e in before if e not in old] + fresh + left

    _replace(folder, changed)


def _replace(folder: Folder, changed: Callable[[list[Entry]], list[Entry]]) -> None:
    """Put what is ``changed`` in place of what is live; if another writer comes first, it is made anew."""
    while True:
        number, before = commits.live(folder)
        if commits.replace(folder, number, changed(before)):
            return


def delete(spark: SparkSession, root: str, name: str, keys: DataFrame) -> None:
    """Delete the rows that match ``keys`` (all or some of the key columns), as the table allows."""
    spec = TABLES[name]
    if spec.delete == "keep":
        return
    if spec.delete == "refuse":
        raise DeleteRefused(f"{name} is append-only")
    if spec.delete == "marker":
        raise DeleteRefused(f"{name} keeps its history; append delete markers instead")
    columns = [k for k in spec.key if k in keys.columns]
    if not columns:
        raise ValueError(f"keys must name at least one of {spec.key}")
    gone = keys.select(*columns).distinct()
    # a partition that lost all its rows goes too
    def changed(before: list[Entry]) -> list[Entry]:
        old = _read(spark, root, spec, [e.path for e in before])
        return _write(old.join(gone, columns, "left_anti").select(*old.columns), root, spec)

    _replace(Folder(spark, table_path(root, name)), changed)


def compact(spark: SparkSession, root: str, name: str) -> None:
    """Rewrite all loads of a table kept by load as few files, each with a range of its first key column.

    The ranges are kept beside, so that :func:`scan_key` reads only what it needs. The loads are closed by it.
    """
    spec, path = TABLES[name], table_path(root, name)
    if not spec.by_load:
        raise ValueError(f"{name} is not kept by load")
    folder, by = Folder(spark, path), spec.key[0]
    _, before = commits.live(folder)
    if not before:
        return
    rows = _read(spark, root, spec, [e.path for e in before], with_load=True)
    order = [*spec.partition_by, by]
    made = commits.new_commit()
    # AQE makes as many ranges as the size of the data needs
    writer = rows.repartitionByRange(*order).sortWithinPartitions(*order).write
    (writer.partitionBy(*spec.partition_by) if spec.partition_by else writer).parquet(f"{path}/{made}")
    ranges = made.replace("commit=", "_ranges=")
    written = spark.read.option("basePath", path).parquet(f"{path}/{made}")
    within = F.substring_index(F.col("_metadata.file_path"), f"/{made}/", -1).alias("file")
    written.select(within, by).groupBy("file").agg(F.min(by).alias("least"), F.max(by).alias("greatest")).write.parquet(f"{path}/{ranges}")
    loads = tuple(sorted({load for e in before for load in e.loads}))
    done = set(before)
    commits.commit(folder, lambda live: [e for e in live if e not in done] + [Entry(made, loads, ranges)])


def vacuum(spark: SparkSession, root: str, name: str, older_than: timedelta = timedelta(days=7)) -> list[str]:
    """Delete what no reader that started within ``older_than`` can still need. Returns the names of what went."""
    return commits.vacuum(Folder(spark, table_path(root, name)), older_than.total_seconds())


def latest(rows: DataFrame, name: str) -> DataFrame:
    """The newest row of every group of a table."""
    spec = TABLES[name]
    if not spec.newest_by:
        return rows
    ties = [k for k in spec.key if k not in spec.group and k not in spec.newest_by and k in rows.columns]
    return newest(rows, spec.group, *(F.col(c).desc() for c in spec.newest_by), *(F.col(c) for c in ties))


def history(rows: DataFrame, name: str, **group: Any) -> DataFrame:
    """The rows of one group of a table, newest first. Any leading part of the group may be given."""
    spec = TABLES[name]
    for column, value in group.items():
        rows = rows.where(F.col(column) == F.lit(value).cast(rows.schema[column].dataType))
    return rows.orderBy(*(F.col(c).desc() for c in spec.newest_by)) if spec.newest_by else rows
