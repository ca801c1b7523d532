"""Substring dedup by fixed-block anchors: word sequences that occur more than once are found and cut out.

A run of ``window`` words always holds one whole aligned block of ``(window + 1) // 2`` words. So

1. the non-overlapping blocks of every text are indexed by hash;
2. every rolling window of a block's length is probed against that index; a hit at any place but the block
   itself is an anchor (a wrong one, from a hash of few bits, costs only work);
3. around every anchor the runs of ``window`` words that hold it are compared in full length, by 128 bits of
   hash (96 of them sent), which extends the anchors to maximal exact repeats;
4. all words under a repeated run go.

At scale: equal texts are combined before anything else and only the distinct ones are read on. Blocks and
probes travel as packed arrays (about five bytes for a word of text), one row per (slice of texts, bucket);
repeats inside a slice are settled there, so a passage that a third of all documents share sends a bucket at
most one entry per slice. A bucket task holds only the index of its bucket and streams the probes. Nothing is
paired: a bucket answers which places are repeated, not with whom. The number of buckets is
``spark.sql.shuffle.partitions``. Whole texts are shuffled once; all steps read that one exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import runs, tasks, text_key
from .words import Words, slices

WINDOW = 35

_INDEX, _PROBE, _DIRECTORY, _PLACES = 0, 1, 2, 3
_SENT = "bucket int, kind int, chunk binary, hashes binary, places binary"
_ANSWERS = "kind int, chunk binary, hashes binary, places binary"
_REMOVALS = "key binary, n_words long, n_removed long, spans array<struct<first:long,last:long>>, kept string"


def repeated_passages(docs: DataFrame, text_column: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per distinct text: key (see :func:`text_key`), n_words, n_removed, spans, kept.

    ``spans`` are the maximal runs of removed words (first and last, from 0), ``kept`` the other words joined
    by one space. A word goes if a run of ``window`` words over it also starts anywhere else, in the same
    text too; a text that occurs in several rows is repeated as a whole. A null text counts as empty and has
    no words; a text of fewer than ``window`` words loses none. No rows give no rows. Only the named column
    is read.
    """
    if window < 2:
        raise ValueError("a window has two words at least")
    anchor = (window + 1) // 2
    spark = docs.sparkSession
    texts = docs.select(text_key(text_column).alias("key"), F.coalesce(text_column, F.lit("")).alias("text"))
    texts = texts.groupBy("key").agg(F.first("text").alias("text"), F.count("key").alias("copies"))

    buckets = tasks(spark)
    # every step takes all columns and all rows, so that all read the same exchange
    probes = texts.mapInArrow(lambda it: _probes(it, anchor, buckets), _SENT)
    found = _dealt(probes, buckets).mapInArrow(_probed, _ANSWERS)
    anchors = _by_text(found, buckets)

    whole = texts.join(anchors, "key", "left").mapInArrow(lambda it: _candidates(it, anchor, window, buckets), _SENT)
    found = _dealt(whole, buckets).mapInArrow(_confirmed, _ANSWERS)
    repeats = _by_text(found, buckets)

    return texts.join(repeats, "key", "left").mapInArrow(lambda it: _removals(it, window), _REMOVALS)


def substring_dedup(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW
) -> DataFrame:
    """doc_id, n_words, n_removed, spans, kept for every row of ``docs``; see :func:`repeated_passages`."""
    return for_every_row(docs, repeated_passages(docs, text_column, window), id_column, text_column)


def for_every_row(docs: DataFrame, by_text: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """The id of every row of ``docs`` with what ``by_text`` has for its text."""
    rows = docs.select(F.col(id_column).alias("doc_id"), text_key(text_column).alias("key"))
    return rows.join(by_text, "key").drop("key")


def _dealt(sent: DataFrame, buckets: int) -> DataFrame:
    return sent.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")


def _by_text(answers: DataFrame, buckets: int) -> DataFrame:
    """Places within slices turned into places within texts."""
    together = answers.repartition(buckets, "chunk").sortWithinPartitions("chunk", "kind")
    return together.mapInArrow(_read_places, "key binary, places binary")


def pack(numbers: np.ndarray) -> bytes:
    """Ascending numbers below 2**32 as steps, byte by byte: the upper bytes are mostly zero and compress."""
    return np.diff(numbers, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(packed, np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


def _rows(rows: list[tuple], names: tuple[str, ...] = ("bucket", "kind", "chunk", "hashes", "places")) -> pa.RecordBatch:
    types = {"bucket": pa.int32(), "kind": pa.int32()}
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, types.get(n, pa.binary())) for n, c in zip(names, columns)], list(names)
    )


def _chunk_rows(keys: pa.Array, words: Words, local: np.ndarray, buckets: int) -> tuple[bytes, list[tuple]]:
    """The name of a slice, its directory (keys and first words of its texts), and the places settled in it."""
    chunk = keys[0].as_py()
    bucket = int.from_bytes(chunk[:4], "little") % buckets
    listed = b"".join(keys.to_pylist())
    rows = [(bucket, _DIRECTORY, chunk, listed, pack(words.first))]
    if len(local):
        rows.append((bucket, _PLACES, chunk, b"", pack(local)))
    return chunk, rows


def _to_buckets(chunk: bytes, kind: int, hashes: np.ndarray, places: np.ndarray, buckets: int, extra=None) -> list[tuple]:
    """One row per bucket; ``places`` ascend. Of each hash the lower half is sent, or all of it with ``extra``."""
    bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = []
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        at = order[cuts[b] : cuts[b + 1]]
        sent = hashes[at].astype("<u4").tobytes() if extra is None else (
            hashes[at].astype("<u8").tobytes() + extra[at].astype("<u4").tobytes()
        )
        rows.append((b, kind, chunk, sent, pack(places[at])))
    return rows


def _probes(batches: Iterator[pa.RecordBatch], anchor: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Index entries of aligned blocks and probes of all other windows, but for what a slice settles itself."""
    for batch in batches:
        for part, data, bounds in slices(batch):
            words = Words(data, bounds)
            first = words.windows(anchor)
            hashes = words.window_hash(first, anchor)
            aligned = (first - words.first[words.row[first]]) % anchor == 0
            blocks, at, count = np.unique(hashes[aligned], return_index=True, return_counts=True)
            known = np.zeros(len(first), bool)
            if len(blocks):
                place = np.minimum(np.searchsorted(blocks, hashes), len(blocks) - 1)
                known = (blocks[place] == hashes) & (~aligned | (count[place] > 1))
            chunk, rows = _chunk_rows(part.column("key"), words, first[known], buckets)
            index = np.sort(np.flatnonzero(aligned)[at])
            probe = np.flatnonzero(~aligned & ~known)
            rows += _to_buckets(chunk, _INDEX, hashes[index], first[index], buckets)
            rows += _to_buckets(chunk, _PROBE, hashes[probe], first[probe], buckets)
            yield _rows(rows)


def _probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which probes meet a block of the index, and which blocks meet each other. Probes are streamed."""
    bucket, held, blocks, shared = None, [], None, None
    names = ("kind", "chunk", "hashes", "places")

    def indexed():
        if not held:
            return np.zeros(0, np.uint32), []
        entries = [np.frombuffer(h, "<u4") for _, h, _ in held]
        every, count = np.unique(np.concatenate(entries), return_counts=True)
        twice = every[count > 1]
        found = []
        for (chunk, _, places), own in zip(held, entries):
            hit = np.isin(own, twice)
            if hit.any():
                found.append((_PLACES, chunk, b"", pack(unpack(places)[hit])))
        return every, found

    for batch in batches:
        out = []
        rows = zip(*(batch.column(n).to_pylist() for n in ("bucket", "kind", "chunk", "hashes", "places")))
        for b, kind, chunk, hashes, places in rows:
            if b != bucket:
                if blocks is None:
                    out += indexed()[1]
                bucket, held, blocks = b, [], None
            if kind == _INDEX:
                held.append((chunk, hashes, places))
                continue
            if blocks is None:
                blocks, shared = indexed()
                out += shared
                held = []
            if kind == _PROBE:
                own = np.frombuffer(hashes, "<u4")
                hit = np.zeros(len(own), bool)
                if len(blocks):
                    hit = blocks[np.minimum(np.searchsorted(blocks, own), len(blocks) - 1)] == own
                if hit.any():
                    out.append((_PLACES, chunk, b"", pack(unpack(places)[hit])))
            else:
                out.append((kind, chunk, hashes, places))
        if out:
            yield _rows(out, names)
    if blocks is None and held:
        yield _rows(indexed()[1], names)


def _read_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, places within its text) of the texts of every slice that have any."""

    def decode(run: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, first, places = b"", None, []
        for batch in run:
            for kind, hashes, packed in zip(*(batch.column(n).to_pylist() for n in ("kind", "hashes", "places"))):
                if kind == _DIRECTORY:
                    keys, first = hashes, unpack(packed)
                else:
                    places.append(unpack(packed))
        if places:
            places = np.unique(np.concatenate(places))
            row = np.searchsorted(first, places, "right") - 1
            rows = []
            for r in np.unique(row).tolist():
                rows.append((keys[16 * r : 16 * r + 16], pack(places[row == r] - first[r])))
            yield _rows(rows, ("key", "places"))

    yield from runs(batches, "chunk", decode)


def _candidates(batches: Iterator[pa.RecordBatch], anchor: int, window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """All runs of ``window`` words that hold an anchor, by their whole hash, each once per slice."""
    for batch in batches:
        for part, data, bounds in slices(batch.filter(pc.is_valid(batch.column("places")))):
            words = Words(data, bounds)
            hits = np.zeros(len(words) + 1, np.int64)
            for r, places in enumerate(part.column("places").to_pylist()):
                hits[words.first[r] + unpack(places) + 1] = 1
            hits = np.cumsum(hits)
            first = words.windows(window)
            first = first[hits[first + window - anchor + 1] > hits[first]]
            one, two = words.window_hash(first, window), words.window_hash(first, window, other=True)
            order = np.lexsort((two, one))
            new = np.ones(len(order), bool)
            new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
            group = np.cumsum(new) - 1
            several = np.bincount(group, minlength=1)[group] > 1
            chunk, rows = _chunk_rows(part.column("key"), words, np.sort(first[order[several]]), buckets)
            sent = np.sort(order[new])
            rows += _to_buckets(chunk, _INDEX, one[sent], first[sent], buckets, extra=two[sent])
            yield _rows(rows)


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which runs of words were sent by several slices."""

    def compare(run: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], []
        for batch in run:
            for kind, chunk, hashes, places in zip(
                *(batch.column(n).to_pylist() for n in ("kind", "chunk", "hashes", "places"))
            ):
                if kind == _INDEX:
                    held.append((chunk, hashes, places))
                else:
                    out.append((kind, chunk, hashes, places))
        if held:
            sizes = [len(h) // 12 for _, h, _ in held]
            one = np.concatenate([np.frombuffer(h, "<u8", n) for (_, h, _), n in zip(held, sizes)])
            two = np.concatenate([np.frombuffer(h, "<u4", n, 8 * n) for (_, h, _), n in zip(held, sizes)])
            order = np.lexsort((two, one))
            same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
            repeated = np.zeros(len(order), bool)
            repeated[order[1:][same]] = repeated[order[:-1][same]] = True
            for (chunk, _, places), hit in zip(held, np.split(repeated, np.cumsum(sizes)[:-1])):
                if hit.any():
                    out.append((_PLACES, chunk, b"", pack(unpack(places)[hit])))
        if out:
            yield _rows(out, ("kind", "chunk", "hashes", "places"))

    yield from runs(batches, "bucket", compare)


def _removals(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {"key": [], "n_words": [], "n_removed": [], "spans": [], "kept": []}
        columns = (batch.column(n).to_pylist() for n in ("key", "text", "copies", "places"))
        for key, text, copies, places in zip(*columns):
            words = text.encode().split()
            gone = np.zeros(len(words) + 1, np.int32)
            if len(words) >= window:
                starts = np.arange(len(words) - window + 1) if copies > 1 else None if places is None else unpack(places)
                if starts is not None:
                    gone[starts] = 1
                    gone[starts + window] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            out["key"].append(key)
            out["n_words"].append(len(words))
            out["n_removed"].append(int(gone.sum()))
            out["spans"].append([{"first": a, "last": b - 1} for a, b in edges.reshape(-1, 2).tolist()])
            if len(edges):
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            out["kept"].append(b" ".join(words).decode())
        spans = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["key"], pa.binary()), pa.array(out["n_words"], pa.int64()),
             pa.array(out["n_removed"], pa.int64()), pa.array(out["spans"], spans), pa.array(out["kept"], pa.string())],
            list(out),
        )
