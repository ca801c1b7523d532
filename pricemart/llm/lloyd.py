"""Centroid clustering by Lloyd's algorithm with the dimensions dealt to shards.

Vectors become integers, so every sum is exact and no result hangs on an order of addition. They are put together in
chunks of ``CHUNK_ROWS``, and a chunk is cut by columns into blocks of ``BLOCK_DIMS`` dimensions. One shard
is one (chunk, block); shards are dealt over the tasks once and stay where they are. In every round

1. each shard gives its part of the squared distances of its rows to all centroids, from its slice of these alone;
2. the parts of a chunk are added up and every row takes the nearest centroid;
3. the assignments go back to the shards of the chunk, each of which adds up its own columns by centroid, and the sums
   of all chunks give the new slice of every block.

At scale: what moves in a round is a number per (row, block, centroid) and an assignment per (row, block), never a
vector. Only the centroids reach the driver, ``k`` times the dimensions. The shards are a table in the shared folder; a
lost executor costs its cached shards, which are read from it again, and a round never hangs on an earlier one but for
its centroids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import saved, stored, tasks

CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
CHUNK_ROWS = 4096
BLOCK_DIMS = 16

#: Below this size of all components, squared distances and their sums over the dimensions fit 64 bits.
_NARROW = 2**26
#: Above it no squared distance fits the decimals of Spark.
_WIDE = 2**57

Centroids = list[list[int]]

_RESULT = [
    T.StructField("cluster", T.IntegerType()),
    *(T.StructField(name, T.LongType()) for name in ("distance", "cluster_inertia", "inertia")),
    T.StructField("centroid", T.ArrayType(T.LongType())),
]


def fit_to_cluster(vector: Column, dims: int) -> Column:
    """Whether a vector takes part: ``dims`` components, none null, infinite or not a number."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) == dims) & fine, F.lit(False))


def clusters(
    vectors: DataFrame, dims: int = 64, k: int = CLUSTERS, rounds: int = ROUNDS, scale: int = SCALE, seed: str = "3",
    id_column: str = "vec_id", vector_column: str = "embedding", chunk_rows: int = CHUNK_ROWS, block_dims: int = BLOCK_DIMS,
) -> DataFrame:
    """One row per vector that takes part: vec_id, cluster, distance, cluster_inertia, inertia, centroid.

    A component x counts as floor(scale * x), x as double. The first centroids are the ``k`` vectors with the smallest
    sha256 of ``<seed>:<id>`` as text, in that order (equal ids by their components, null ids last); fewer vectors
    give fewer centroids. Every round assigns each vector to the nearest centroid by squared distance, the
    first of equals, and moves every centroid that has vectors to the floor of their mean; then they are
    assigned once more. ``distance`` is squared, inertias are its sums, ``centroid`` lists the components as integers.
    Repeated rows are vectors of their own. Only the named columns are read; no rows give no rows. Components
    of 2**57 or more in size, and distances or sums that no long can hold, are an error.
    """
    rows = vectors.select(F.col(id_column).alias("vec_id"), F.col(vector_column).cast("array<double>").alias("x"))
    rows = rows.where(fit_to_cluster(F.col("x"), dims))
    id_type = rows.schema["vec_id"].dataType
    chunks = stored(rows.mapInArrow(lambda it: _chunks(it, scale, chunk_rows, block_dims), T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("block", T.IntegerType()),
        T.StructField("n", T.IntegerType()), T.StructField("most", T.DoubleType()),
        T.StructField("x", T.BinaryType()), T.StructField("ids", T.ArrayType(id_type)),
    ])), "lloyd")
    most = chunks.agg(F.max("most")).first()[0]
    if most is None:
        return vectors.sparkSession.createDataFrame([], T.StructType([T.StructField("vec_id", id_type), *_RESULT]))
    if not most < _WIDE:
        raise ValueError(f"components of {most} are too large for exact distances")
    centroids, narrow = _first_centroids(rows, k, scale, seed), most < _NARROW
    shards = chunks.drop("ids", "most").repartition(tasks(vectors.sparkSession), "chunk", "block")
    shards = shards.persist(StorageLevel.DISK_ONLY)
    for _ in range(rounds):
        centroids = _moved(shards, _assigned(shards, centroids, narrow, block_dims), centroids, narrow, block_dims)
    assigned = saved(_assigned(shards, centroids, narrow, block_dims))
    shards.unpersist()
    return _with_inertias(chunks, assigned, centroids)


def _chunks(batches: Iterator[pa.RecordBatch], scale: int, chunk_rows: int, block_dims: int) -> Iterator[pa.RecordBatch]:
    """The column blocks of runs of rows; the first block of a chunk carries the ids."""
    number = TaskContext.get().partitionId() << 33
    for batch in batches:
        for lo in range(0, batch.num_rows, chunk_rows):
            part = batch.slice(lo, chunk_rows)
            n, ids = part.num_rows, part.column("vec_id")
            x = np.floor(part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1) * scale)
            cuts = range(0, x.shape[1], block_dims)
            blocks = [np.ascontiguousarray(x[:, c : c + block_dims]) for c in cuts]
            lists = pa.ListArray.from_arrays(pa.array([0] + [n] * len(blocks), pa.int32()), ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * len(blocks), pa.int64()), pa.array(range(len(blocks)), pa.int32()),
                 pa.array([n] * len(blocks), pa.int32()), pa.array([float(np.abs(b).max(initial=0)) for b in blocks]),
                 pa.array([b.tobytes() for b in blocks], pa.binary()), lists],
                ["chunk", "block", "n", "most", "x", "ids"],
            )
            number += 1


def _first_centroids(rows: DataFrame, k: int, scale: int, seed: str) -> Centroids:
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.select(order.alias("order"), "x").orderBy(F.col("order").asc_nulls_last(), "x").limit(k).collect()
    return [[math.floor(v * scale) for v in r["x"]] for r in first]


def _slices(centroids: Centroids, narrow: bool, block_dims: int) -> list[np.ndarray]:
    """The columns of the centroids that belong to every block."""
    whole = np.array(centroids, np.int64 if narrow else object)
    return [whole[:, c : c + block_dims] for c in range(0, whole.shape[1], block_dims)]


def _components(n: int, x: bytes, narrow: bool) -> np.ndarray:
    values = np.frombuffer(x, np.float64).reshape(n, -1).astype(np.int64)
    return values if narrow else values.astype(object)


def _assigned(shards: DataFrame, centroids: Centroids, narrow: bool, block_dims: int) -> DataFrame:
    """(chunk, cluster, distance): the nearest centroid of every row of a chunk, as arrays."""
    slices = _slices(centroids, narrow, block_dims)
    number = "long" if narrow else "decimal(38,0)"

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                chunk, block, n, x = (batch.column(c)[row].as_py() for c in ("chunk", "block", "n", "x"))
                x, own = _components(n, x, narrow), slices[block]
                found = np.stack([((x - centre) ** 2).sum(axis=1) for centre in own], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), _list(found.ravel(), narrow)], ["chunk", "part"])

    def nearest(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in range(batch.num_rows):
                part = _numbers(batch.column("part")[row].values, narrow)
                total = part if total is None else total + part
        total = total.reshape(-1, len(centroids))
        best = total.argmin(axis=1)
        least = total[np.arange(len(total)), best]
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()]), _list(best.astype(np.int32), True, pa.int32()), _list(least, narrow)],
            ["chunk", "cluster", "distance"],
        )

    found = shards.mapInArrow(parts, f"chunk long, part array<{number}>")
    return found.groupBy("chunk").applyInArrow(nearest, f"chunk long, cluster array<int>, distance array<{number}>")


def _list(values: np.ndarray, narrow: bool, kind: pa.DataType | None = None) -> pa.Array:
    """One row with the list of the numbers."""
    flat = pa.array(values, kind or pa.int64()) if narrow else pa.array(_decimals(values), pa.decimal128(38, 0))
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), flat)


def _decimals(values: np.ndarray) -> list:
    return [Decimal(v) for v in values.tolist()]


def _numbers(values: pa.Array, narrow: bool) -> np.ndarray:
    return values.to_numpy() if narrow else np.array([int(v) for v in values.to_pylist()], object)


def _moved(shards: DataFrame, assigned: DataFrame, centroids: Centroids, narrow: bool, block_dims: int) -> Centroids:
    """The centroids after one round: every block adds up its own columns and divides them by its counts."""
    number = "long" if narrow else "decimal(38,0)"

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block, n, x = (batch.column(c)[row].as_py() for c in ("block", "n", "x"))
                x, cluster = _components(n, x, narrow), batch.column("cluster")[row].values.to_numpy()
                names, counts = np.unique(cluster, return_counts=True)
                total = np.concatenate([x[cluster == c].sum(axis=0) for c in names])
                each = x.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(names, each), pa.int32()),
                     pa.array(np.tile(np.arange(each) + block * block_dims, len(names)), pa.int32()),
                     pa.array(np.repeat(counts, each), pa.int64()), _list(total, narrow).values],
                    ["cluster", "dim", "n", "total"],
                )

    back = assigned.select("chunk", "cluster")
    blocks = F.explode(F.sequence(F.lit(0), F.lit((len(centroids[0]) - 1) // block_dims))).alias("block")
    back = back.select("chunk", blocks, "cluster")
    found = shards.join(back, ["chunk", "block"]).mapInArrow(sums, f"cluster int, dim int, n long, total {number}")
    found = found.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    moved = [list(c) for c in centroids]
    for r in found.collect():  # as many rows as the centroids have components
        moved[r["cluster"]][r["dim"]] = int(r["total"]) // r["n"]
    return moved


def _with_inertias(chunks: DataFrame, assigned: DataFrame, centroids: Centroids) -> DataFrame:
    each = assigned.select(F.explode(F.arrays_zip("cluster", "distance")).alias("r")).groupBy("r.cluster")
    each = each.agg(F.sum(F.col("r.distance").cast("decimal(38,0)")).alias("inertia")).collect()  # a row per centroid
    total = sum(int(r["inertia"]) for r in each)
    if total >= 2**63:
        raise ValueError(f"an inertia of {total} does not fit a long")
    places = [(r["cluster"], int(r["inertia"]), total, centroids[r["cluster"]]) for r in each]
    kinds = "cluster int, cluster_inertia long, inertia long, centroid array<long>"
    places = chunks.sparkSession.createDataFrame(places, kinds)
    rows = chunks.where("block = 0").select("chunk", "ids").join(assigned, "chunk")
    rows = rows.select(F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("r")).select(
        F.col("r.ids").alias("vec_id"), "r.cluster", F.col("r.distance").cast("long").alias("distance")
    )
    return rows.join(F.broadcast(places), "cluster").select("vec_id", *(f.name for f in _RESULT))
