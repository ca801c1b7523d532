"""Exact top-k search by inner product with MaxScore over shards of dense postings.

Every dimension is a term; its posting is the column of that dimension over a block of vectors, with the
smallest and largest component as bounds. For a query, a term adds at most q * bound. With the k-th best score
so far as threshold, the terms of smallest range whose ranges together cannot lift a vector above it are
non-essential: the essential postings are traversed in full, the others only for vectors that can still
compete, which are fewer after every term. Ties at the threshold are kept, so the result is exact.

At scale: vectors are dealt by a hash of the row to shards of about ``SHARD_ROWS`` or less, so that every task has
one; every shard gets every query, streamed in batches against the vectors it holds, and gives k rows per query;
these are merged by a top-k window that is limited map-side. The queries are a stated set against all rows, so the work is queries times
rows; no task holds more than a shard and a batch.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import one_batch, row_number, saved, tasks

K = 10
SCALE = 1024
SHARD_ROWS = 65_536

_BLOCK_ROWS = 4096
#: Products of components below this fit 64 bits, also added up; vectors with others are scored by wide integers.
_NARROW = 2**27
_DIGIT_BITS = 20
_FOUND = "query_row long, query_id long, row long, vec_id long, score long, wide_score decimal(38,0)"


def components_of(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of all components, as doubles, which hold them exactly; null where the vector takes no part.

    That is: a null vector, or one with a null or non-finite component.
    """
    def floor(x: Column) -> Column:
        product = F.lit(float(scale)) * x.cast("double")
        # larger doubles are integers
        return F.when(F.abs(product) < 2.0**53, F.floor(product).cast("double")).otherwise(product)

    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return F.when(finite, F.transform(vector, floor))


def top_k(
    vectors: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id", vector_column: str = "embedding",
    scale: int = SCALE, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``k`` best other rows for every row where ``is_query``.

    Equal scores go to the smaller vec_id, null last, then the earlier row. A query's own row is no candidate;
    repeated rows are. With fewer than ``k`` candidates all are given. Vectors of different length are compared
    as if the shorter ended in zeros. See :func:`components_of` for vectors that take no part. A score that no long
    can hold is an error if it is one of the ``k`` best, or has more than 38 digits. Only the named
    columns and those of ``is_query`` are read; rows come from files or a checkpoint. No rows give no rows.
    """
    spark = vectors.sparkSession
    rows = saved(vectors.select(
        row_number().alias("row"), F.col(id_column).alias("vec_id"), components_of(F.col(vector_column), scale).alias("parts"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("parts").isNotNull()))
    n = rows.count()
    shards = max(1, math.ceil(n / shard_rows), min(tasks(spark), math.ceil(n / _BLOCK_ROWS)))
    held = rows.select(
        F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("side"), "row", "vec_id", "parts"
    )
    asked = rows.where("asks").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("side"), "row", "vec_id", "parts"
    )
    dealt = held.unionByName(asked).repartition(min(shards, tasks(spark)), "shard").sortWithinPartitions("shard", "side")
    found = dealt.mapInArrow(lambda it: _search(it, k), _FOUND)
    exact = F.coalesce("wide_score", F.col("score").cast("decimal(38,0)"))
    best = Window.partitionBy("query_row").orderBy(exact.desc(), F.asc_nulls_last("vec_id"), "row")
    too_large = F.raise_error(F.lit("a score does not fit a long")).cast("long")
    wide = F.col("wide_score")
    score = F.when(wide.isNull(), F.col("score")).when(wide.between(-(2**63), 2**63 - 1), wide.cast("long")).otherwise(too_large)
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", score.alias("score")
    )


class Shard:
    """The vectors of one shard, best first by length, in blocks of columns with bounds; wide ones apart."""

    def __init__(self, row: np.ndarray, vec_id: np.ndarray, parts: np.ndarray):
        narrow = (np.abs(parts) < _NARROW).all(axis=1)
        self.wide = list(zip(vec_id[~narrow].tolist(), row[~narrow].tolist(), map(_integers, parts[~narrow])))
        row, vec_id, parts = row[narrow], vec_id[narrow], parts[narrow].astype(np.int64)
        order = np.argsort(-(parts.astype(np.float64) ** 2).sum(axis=1), kind="stable")
        self.row, self.vec_id, self.dims = row[order], vec_id[order], parts.shape[1]
        columns = np.ascontiguousarray(parts[order].T)
        self.blocks = []
        for lo in range(0, len(row), _BLOCK_ROWS):
            block = columns[:, lo : lo + _BLOCK_ROWS]
            self.blocks.append((lo, np.ascontiguousarray(block), block.min(axis=1), block.max(axis=1)))

    def best(self, own_row: int, query: np.ndarray, k: int) -> list[tuple[int, int, int]]:
        """(row, vec_id, score) of the ``k`` best vectors but for the query's own; scores of any size."""
        if (np.abs(query) < _NARROW).all():
            places, scores = self.search(own_row, query[: self.dims].astype(np.int64), k)
            found = list(zip((-scores).tolist(), self.vec_id[places].tolist(), self.row[places].tolist()))
        else:
            totals = self._wide_scores(_integers(query))
            found = [(-s, v, r) for s, v, r in zip(totals, self.vec_id.tolist(), self.row.tolist()) if r != own_row]
        numbers = _integers(query) if self.wide else []
        found += [(-sum(a * b for a, b in zip(numbers, x)), v, r) for v, r, x in self.wide if r != own_row]
        return [(r, v, -s) for s, v, r in sorted(found)[:k]]

    def _wide_scores(self, query: list[int]) -> list[int]:
        """Scores of all narrow vectors, digit by digit of the query."""
        totals = [0] * len(self.row)
        digits = max((abs(q).bit_length() for q in query), default=0)
        for shift in range(0, digits, _DIGIT_BITS):
            part = [(abs(q) >> shift & (1 << _DIGIT_BITS) - 1) * (1 if q >= 0 else -1) for q in query[: self.dims]]
            part = np.array(part, np.int64)
            found = [part[: len(columns)] @ columns for _, columns, _, _ in self.blocks]
            for n, score in enumerate(np.concatenate(found).tolist() if found else []):
                totals[n] += score << shift
        return totals

    def search(self, own_row: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the ``k`` best narrow vectors but for the query's own, by MaxScore."""
        places, scores, threshold = np.zeros(0, np.int64), np.zeros(0, np.int64), None
        for lo, columns, low, high in self.blocks:
            place, score = _max_score(columns, low, high, query, threshold)
            keep = self.row[lo + place] != own_row
            places, scores = np.concatenate([places, lo + place[keep]]), np.concatenate([scores, score[keep]])
            best = np.lexsort((self.row[places], self.vec_id[places], -scores))[:k]
            places, scores = places[best], scores[best]
            if len(scores) == k:
                threshold = int(scores[-1])
        return places, scores


def _integers(parts: np.ndarray) -> list[int]:
    return [int(x) for x in parts.tolist()]


def _max_score(
    columns: np.ndarray, low: np.ndarray, high: np.ndarray, query: np.ndarray, threshold: int | None
) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of all vectors of a block that reach the threshold."""
    ends = np.stack([query * low, query * high])
    base = int(ends.min(axis=0).sum())
    gain = ends.max(axis=0) - ends.min(axis=0)
    terms = np.argsort(-gain, kind="stable")
    left = np.concatenate([np.cumsum(gain[terms][::-1])[::-1], [0]])
    essential = len(terms) if threshold is None else int(np.argmax(left <= max(0, threshold - base)))
    score = np.zeros(columns.shape[1], np.int64)
    for t in terms[:essential]:
        score += query[t] * columns[t]
    spent = int(ends.min(axis=0)[terms[:essential]].sum())
    place = np.arange(columns.shape[1])
    for n in range(essential, len(terms)):
        possible = score + int(left[n]) + base - spent >= threshold
        if not possible.all():
            place, score = place[possible], score[possible]
        if not len(place):
            return place, score
        t = terms[n]
        score = score + query[t] * columns[t][place]
        spent += int(ends[:, t].min())
    if threshold is not None:
        reached = score >= threshold
        place, score = place[reached], score[reached]
    return place, score


def _matrix(parts: pa.Array, dims: int | None = None) -> np.ndarray:
    sizes = np.diff(parts.offsets.to_numpy())
    dims = dims or max(1, int(sizes.max(initial=0)))
    out = np.zeros((len(sizes), max(dims, int(sizes.max(initial=0)))))
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = parts.flatten().to_numpy(zero_copy_only=False)
    return out


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    shard, held, index = None, [], None
    last = np.iinfo(np.int64).max

    def built():
        if not held:
            return None
        whole = one_batch(held)
        ids = whole.column("vec_id").fill_null(last).to_numpy()
        return Shard(whole.column("row").to_numpy(), ids, _matrix(whole.column("parts")))

    for batch in batches:
        names, side = batch.column("shard").to_numpy(), batch.column("side").to_numpy()
        cuts = np.flatnonzero(np.diff(names * 2 + side)) + 1
        out = []
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            if hi == lo:
                continue
            part = batch.slice(lo, hi - lo)
            if names[lo] != shard:
                shard, held, index = names[lo], [], None
            if side[lo] == 0:
                held.append(part)
                continue
            index = index or built()
            if index is None:
                continue
            queries = _matrix(part.column("parts"), index.dims)
            for row, query_id, query in zip(part.column("row").to_pylist(), part.column("vec_id").to_pylist(), queries):
                for r, v, s in index.best(row, query, k):
                    fits = -(2**63) <= s < 2**63
                    out.append((row, query_id, r, None if v == last else v, s if fits else None, None if fits else Decimal(s)))
        columns = list(zip(*out)) or [()] * 6
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.decimal128(38, 0))],
            ["query_row", "query_id", "row", "vec_id", "score", "wide_score"],
        )
