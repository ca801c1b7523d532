"""Line dedup with two Bloom filters: only lines that may be repeated are ever compared as texts.

1. Every task sends the hashes of its lines to the filter shard that the hash names: packed, each once per
   slice of documents, twice if several documents of the slice have the line.
2. A shard keeps a filter of hashes seen once and one of hashes seen twice, sized by what it got, and names
   the hashes that the second holds. Every repeated line is among them; a wrong one costs only work.
3. Lines of those hashes are shuffled as texts, counted exactly by document, and the first document of each is
   chosen in the same aggregation.
4. Texts meet the repeated lines they hold, and lose them.

At scale: hashes take eight bytes a line, and a line of a third of all documents sends one or two per slice;
counts are combined map-side; equal texts are combined first and worked on once. Whole texts are shuffled once
and all steps read that exchange. Joins on lines are equi-joins that adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import runs, stored, tasks, text_key
from .words import slices

MIN_CHARS, MIN_DOCS = 1, 10

_BITS_PER_HASH, _PROBES = 12, 4
_SHARDS_PER_TASK = 4


class Bloom:
    """A Bloom filter of 64-bit hashes."""

    def __init__(self, expected: int):
        self._mask = np.uint64((1 << max(10, (_BITS_PER_HASH * expected - 1).bit_length())) - 1)
        self._bits = np.zeros((int(self._mask) + 1) // 8, np.uint8)

    def _places(self, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        for k in range(_PROBES):
            bit = (hashes + np.uint64(k) * step) & self._mask
            yield (bit >> np.uint64(3)).astype(np.int64), np.left_shift(1, (bit & np.uint64(7)).astype(np.uint8), dtype=np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        for byte, bit in self._places(hashes):
            np.bitwise_or.at(self._bits, byte, bit)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for byte, bit in self._places(hashes):
            found &= (self._bits[byte] & bit) > 0
        return found


def repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, suspected, repeated) of ``docs``.

    texts: key, text, copies, first_id of every distinct text. suspected: key, line of every line that may be
    repeated. repeated: line, n_docs, first_id of every line of ``min_chars`` characters or more in at least
    ``min_docs`` rows. A line stands for all that are equal after stripping white space and lower-casing A-Z.
    """
    shards = _SHARDS_PER_TASK * tasks(docs.sparkSession)
    docs = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    sent = docs.select("text").mapInArrow(lambda it: _hashes(it, min_chars, shards), "shard int, hashes binary")
    twice = sent.repartition(tasks(docs.sparkSession), "shard").sortWithinPartitions("shard").mapInArrow(
        lambda it: runs(it, "shard", _seen_twice), "hash long"
    )
    texts = docs.withColumn("key", text_key()).groupBy("key").agg(
        F.first("text").alias("text"), F.count("key").alias("copies"), F.min("id").alias("first_id")
    )
    # every step takes all columns and all rows, so that all read the same exchange
    lines = texts.mapInArrow(lambda it: _lines(it, min_chars), "key binary, hash long")
    hits = lines.join(twice, "hash").groupBy("key").agg(F.collect_list("hash").alias("hashes"))
    suspected = stored(
        texts.join(hits, "key", "left").withColumn("first_id", F.col("first_id").cast("string")).mapInArrow(
            lambda it: _suspects(it, min_chars), "key binary, line string, copies long, first_id string"
        ), "suspected_lines"
    )
    first_id = F.min(F.col("first_id").cast(docs.schema["id"].dataType)).alias("first_id")
    repeated = suspected.groupBy("line").agg(F.sum("copies").alias("n_docs"), first_id).where(F.col("n_docs") >= min_docs)
    return texts, suspected.select("key", "line"), repeated


def line_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, keep_first: bool = False,
) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept for every row of ``docs``; ``kept`` is the other lines joined by \\n.

    Repeated lines (see :func:`repeated_lines`) go from every document; with ``keep_first`` the smallest id
    that has one keeps its first occurrence (all rows of that id and text do). A null or empty text is one
    empty line and loses nothing, as do blank lines: their key has no characters. Repeated rows count one
    document each. Only the two named columns are read. No rows give no rows.
    """
    texts, suspected, repeated = repeated_lines(docs, id_column, text_column, min_chars, min_docs)
    by_text = kept_lines(texts, suspected, repeated, keep_first)
    rows = docs.select(F.col(id_column).alias("doc_id"), text_key(text_column).alias("key"))
    if keep_first:
        firsts = by_text.where("for_first").drop("for_first")
        others = by_text.where("NOT for_first").drop("for_first", "first_id")
        rows = rows.join(firsts.select("key", "first_id"), "key", "left")
        is_first = F.col("doc_id").eqNullSafe(F.col("first_id"))
        return rows.where(is_first).drop("first_id").join(firsts.drop("first_id"), "key").unionByName(
            rows.where(~is_first).drop("first_id").join(others, "key")
        ).drop("key")
    return rows.join(by_text.drop("for_first", "first_id"), "key").drop("key")


def kept_lines(texts: DataFrame, suspected: DataFrame, repeated: DataFrame, keep_first: bool = False) -> DataFrame:
    """key, first_id, for_first, n_lines, n_dropped, kept of every distinct text."""
    drops = suspected.join(repeated, "line").groupBy("key").agg(
        F.collect_list(F.struct("line", F.col("first_id").cast("string").alias("first"))).alias("drops")
    )
    id_type = texts.schema["first_id"].dataType.simpleString()
    named = texts.join(drops, "key", "left").withColumn("first_id", F.col("first_id").cast("string"))
    return named.mapInArrow(
        lambda it: _kept(it, keep_first),
        "key binary, first_id string, for_first boolean, n_lines long, n_dropped long, kept string",
    ).withColumn("first_id", F.col("first_id").cast(id_type))


def _key(line: bytes, min_chars: int) -> bytes | None:
    key = line.strip().lower()
    return key if key and (min_chars <= 1 or len(key.decode()) >= min_chars) else None


def _distinct(text: bytes, min_chars: int) -> set[bytes]:
    return {k for k in (_key(line, min_chars) for line in text.split(b"\n")) if k is not None}


def _hash(key: bytes) -> int:
    return xxhash.xxh3_64_intdigest(key)


def _hashes(batches: Iterator[pa.RecordBatch], min_chars: int, shards: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, data, bounds in slices(batch):
            raw, bounds = data.tobytes(), bounds.tolist()
            found = [_hash(k) for a, b in zip(bounds, bounds[1:]) for k in _distinct(raw[a:b], min_chars)]
            hashes, count = np.unique(np.array(found, np.uint64), return_counts=True)
            hashes = np.repeat(hashes, np.minimum(count, 2))
            shard = (hashes >> np.uint64(40)) % np.uint64(shards)
            order = np.argsort(shard, kind="stable")
            names, at = np.unique(shard[order], return_index=True)
            packed = [h.tobytes() for h in np.split(hashes[order], at[1:])][: len(names)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names.astype(np.int32)), pa.array(packed, pa.binary())], ["shard", "hashes"]
            )


def _seen_twice(run: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrays = [np.frombuffer(h, np.uint64) for batch in run for h in batch.column("hashes").to_pylist()]
    total = sum(map(len, arrays))
    once, twice = Bloom(total), Bloom(total)
    for hashes in arrays:
        hashes, count = np.unique(hashes, return_counts=True)
        twice.add(hashes[(count > 1) | once.has(hashes)])
        once.add(hashes)
    suspected = [np.unique(h[twice.has(h)]) for h in arrays]
    suspected = np.unique(np.concatenate(suspected))
    yield pa.RecordBatch.from_arrays([pa.array(suspected.view(np.int64))], ["hash"])


def _lines(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, hashes = [], []
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
            found = {_hash(k) for k in _distinct(text.encode(), min_chars)}
            keys += [key] * len(found)
            hashes += found
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(np.array(hashes, np.uint64).view(np.int64))], ["key", "hash"]
        )


def _suspects(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        batch = batch.filter(pc.is_valid(batch.column("hashes")))
        columns = (batch.column(n).to_pylist() for n in ("key", "text", "copies", "first_id", "hashes"))
        for key, text, copies, first, hashes in zip(*columns):
            wanted = {h & (2**64 - 1) for h in hashes}
            out += [(key, k.decode(), copies, first) for k in _distinct(text.encode(), min_chars) if _hash(k) in wanted]
        columns = list(zip(*out)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.string(), pa.int64(), pa.string()))],
            ["key", "line", "copies", "first_id"],
        )


def _kept(batches: Iterator[pa.RecordBatch], keep_first: bool) -> Iterator[pa.RecordBatch]:
    names = ["key", "first_id", "for_first", "n_lines", "n_dropped", "kept"]
    types = [pa.binary(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        out = []
        for key, text, first_id, drops in zip(*(batch.column(n).to_pylist() for n in ("key", "text", "first_id", "drops"))):
            lines = text.encode().split(b"\n")
            gone = {d["line"].encode() for d in drops or ()}
            own = {d["line"].encode() for d in drops or () if d["first"] == first_id}
            for for_first in (False, True) if keep_first else (False,):
                spare, kept = set(own) if for_first else set(), []
                for line in lines:
                    name = line.strip().lower() if gone else b""
                    if name not in gone:
                        kept.append(line)
                    elif name in spare:
                        spare.discard(name)
                        kept.append(line)
                out.append((key, first_id, for_first, len(lines), len(lines) - len(kept), b"\n".join(kept).decode()))
        columns = list(zip(*out)) or [()] * 6
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
