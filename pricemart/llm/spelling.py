"""Spelling variants by Bloom-guided neighbourhoods.

Two words are near if one edit, an inserted, deleted or replaced code point, makes one into the other. The vocabulary's
words are put into blocked Bloom filters, one shard for each length: a word sets its bits in one 64-bit block
of its length's shard. Every word then generates the hashes of its edits, the shorter words by deletion and the
words of its own length by replacement with a later letter (the other half of each pair comes from the other
word), and probes the shard of the edit's length. Only positives are shuffled, to an exact join with the
vocabulary and a comparison of the words themselves, which removes false positives.

At scale: words are counted in every task before they are shuffled. No edit is ever a string or a row unless its
probe was positive. The filters are broadcast ``FILTER_BYTES`` at a time, whatever the vocabulary's size: where they
are larger together, every pass takes one range of blocks and only the edits that fall in it. The chains of forms
are followed by doubling, a logarithmic number of joins.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved
from .words import mix

RUNS = "[A-Za-zÀ-ÿ]+"
LEAST_LENGTH = 6
LEAST_COUNT = 5
LEAST_RATIO = 5

#: Bits of the filters for each word, and bytes of filters that are broadcast at once.
BITS_A_WORD = 24
FILTER_BYTES = 8_000_000
#: Words of this length and longer ones share a shard.
LAST_SHARD = 64
#: Counted words a task holds, and letters whose edits it looks up at once.
HELD_WORDS = 200_000
_LETTERS_AT_ONCE = 1 << 16

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_STEP = int(mix(np.array([41], np.uint64))[0]) | 5
_BACK = np.uint64(pow(_STEP, -1, 2**64))


def words(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", spoil_every: int = 0,
    least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, held_words: int = HELD_WORDS,
) -> DataFrame:
    """(word, n) of the words of all texts that have ``least_length`` code points and occur ``least_count`` times.

    A word is a run of letters up to U+00FF with A-Z lower-cased. With ``spoil_every`` words are misspelt first: where it
    divides h, the crc32 of ``<id>:<word>`` (a null id counts as empty), the word loses its code point h % length.
    Null and empty texts have no words; repeated rows count as often as they come. No rows give no rows.
    """
    rows = docs.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text_column).alias("text"))
    rows = rows.where("text IS NOT NULL")
    counts = rows.mapInArrow(lambda it: _counted(it, spoil_every, least_length, held_words), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _counted(batches: Iterator[pa.RecordBatch], spoil_every: int, least_length: int, most: int) -> Iterator[pa.RecordBatch]:
    runs, held = re.compile(RUNS), Counter()

    def flushed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
        )
        held.clear()
        return out

    for batch in batches:
        for row in range(batch.num_rows):
            text = batch.column("text")[row].as_py().encode().translate(_LOWER).decode()
            found = Counter(runs.findall(text))
            if spoil_every:
                found = _spoilt(found, batch.column("id")[row].as_py(), spoil_every)
            for word, n in found.items():
                if len(word) >= least_length:
                    held[word] += n
            if len(held) > most:
                yield flushed()
    if held:
        yield flushed()


def _spoilt(found: Counter, id: str, every: int) -> Counter:
    start, out = zlib.crc32(f"{id}:".encode()), Counter()
    for word, n in found.items():
        h = zlib.crc32(word.encode(), start)
        at = h % len(word)
        out[word if h % every else word[:at] + word[at + 1 :]] += n
    return out


def spelling_groups(vocabulary: DataFrame, least_ratio: int = LEAST_RATIO, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per row of ``vocabulary`` (word, n), of distinct words: word, form, root, n, n_near, form_n.

    ``n_near`` is the number of near words. The form of a word is its near word of largest n, the smallest in
    code-point order of equals, if that n is ``least_ratio`` times the word's n or more (above 1, so that chains
    end); else form and form_n are null. ``root`` is the end of the chain of forms, the word itself if it
    has none. No rows give no rows.
    """
    listed = saved(vocabulary.select(F.monotonically_increasing_id().alias("id"), "word", "n"))
    keyed = saved(listed.mapInArrow(_keyed, "id long, key long, length int"))
    near = _near(listed, keyed, filter_bytes)
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near_word"), F.col("near_id"))).alias("best")
    near = saved(near.groupBy("id").agg(F.count("near_id").alias("n_near"), best))
    whole = listed.join(near, "id", "left").withColumn("has", -F.col("best.m") >= least_ratio * F.col("n"))
    whole = saved(whole.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(F.col("has"), -F.col("best.m")).alias("form_n"),
        *(F.when(F.col("has"), F.col(f"best.near_{c}")).alias(a) for c, a in (("word", "form"), ("id", "form_id"))),
    ))
    roots = _roots(whole.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("root_id"), F.col("form").alias("root")))
    return whole.join(roots.drop("root_id"), "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(state: DataFrame) -> DataFrame:
    """(id, root_id, root): every step doubles how far a chain is followed."""
    state = saved(state)
    while True:
        further = state.select(F.col("id").alias("root_id"), F.col("root_id").alias("next_id"), F.col("root").alias("next"))
        moved = saved(state.join(further, "root_id", "left"))
        state = moved.select("id", F.coalesce("next_id", "root_id").alias("root_id"), F.coalesce("next", "root").alias("root"))
        if moved.where("next_id IS NOT NULL").isEmpty():
            return state


class Letters:
    """The letters of some words: code, place, word and running hash sums, all words one after another."""

    def __init__(self, found: list[str]):
        self.length = np.array([len(w) for w in found], np.int64)
        self.code = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32)
        self.first = np.concatenate([[0], np.cumsum(self.length)])
        self.word = np.repeat(np.arange(len(found)), self.length)
        self.place = np.arange(len(self.code)) - self.first[self.word]
        longest = int(self.length.max(initial=0))
        steps = np.full(longest + 1, _STEP, np.uint64)
        steps[0] = 1
        self.power = np.cumprod(steps)
        self.term = _letter(self.code) * self.power[self.place]
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.term)])
        self.sum = self.sums[self.first[1:]] - self.sums[self.first[:-1]]

    def keys(self) -> np.ndarray:
        return _key(self.sum, self.length)


def _letter(code: np.ndarray) -> np.ndarray:
    return mix(code.astype(np.uint64) + np.uint64(1))


def _key(total: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The hash of a word from the sum of its letters' terms and its length."""
    return mix(total + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        letters = Letters(batch.column("word").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(letters.keys().view(np.int64)), pa.array(letters.length.astype(np.int32))],
            ["id", "key", "length"],
        )


class Shards:
    """Where a key's block is, and which bits of it are the key's: shards by length, one after another."""

    def __init__(self, counts: dict[int, int]):
        blocks = np.zeros(LAST_SHARD + 1, np.uint64)
        for shard, n in counts.items():
            blocks[shard] = -(-n * BITS_A_WORD // 64)
        self.blocks, self.total = blocks, int(blocks.sum())
        self.offset = np.concatenate([np.zeros(1, np.uint64), np.cumsum(blocks)[:-1]])

    def block(self, key: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The block of each key; -1 where no word has its length."""
        shard = np.minimum(length, LAST_SHARD)
        at = self.offset[shard] + ((key >> np.uint64(32)) * self.blocks[shard] >> np.uint64(32))
        return np.where(self.blocks[shard] > 0, at.astype(np.int64), -1)

    @staticmethod
    def bits(key: np.ndarray) -> np.ndarray:
        out = np.zeros(len(key), np.uint64)
        for k in range(5):
            out |= np.uint64(1) << (key >> np.uint64(6 * k) & np.uint64(63))
        return out


def _near(listed: DataFrame, keyed: DataFrame, filter_bytes: int) -> DataFrame:
    """(id, near_id, near_word, near_n): every word with each of its near words."""
    spark = listed.sparkSession
    shard = F.least("length", F.lit(LAST_SHARD)).alias("shard")
    counts = {r["shard"]: r["n"] for r in keyed.groupBy(shard).agg(F.count("key").alias("n")).collect()}
    letters = listed.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    alphabet = sorted(ord(r["c"]) for r in letters.collect())  # the letters of RUNS at most
    shards, positives = Shards(counts), None
    for lo in range(0, shards.total, filter_bytes // 8):
        held = _filter(spark, keyed, shards, lo, min(shards.total, lo + filter_bytes // 8))
        found = listed.select("id", "word").mapInArrow(
            lambda it, lo=lo, held=held: _positives(it, shards, alphabet, lo, held.value), "id long, key long"
        )
        positives = found if positives is None else positives.unionByName(found)
    if positives is None:
        positives = keyed.select("id", "key")
    full = keyed.select("id", "key").join(listed, "id")
    met = positives.join(full.select("key", *(F.col(c).alias(f"near_{c}") for c in ("id", "word", "n"))), "key")
    met = met.drop("key").join(listed, "id").where("levenshtein(word, near_word, 1) = 1")
    met = saved(met.select("id", "word", "n", "near_id", "near_word", "near_n").distinct())
    back = met.select(
        F.col("near_id").alias("id"), F.col("id").alias("near_id"), F.col("word").alias("near_word"), F.col("n").alias("near_n")
    )
    return met.select(back.columns).unionByName(back)


def _filter(spark: SparkSession, keyed: DataFrame, shards: Shards, lo: int, hi: int):
    """The blocks from ``lo`` to ``hi`` as a broadcast array: at most ``filter_bytes``."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy().view(np.uint64)
            block = shards.block(key, batch.column("length").to_numpy())
            here = (block >= lo) & (block < hi)
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[here] - lo), pa.array(shards.bits(key[here]).view(np.int64))], ["block", "bits"]
            )

    set_ = keyed.mapInArrow(bits, "block long, bits long").groupBy("block").agg(F.bit_or("bits").alias("bits")).toArrow()
    held = np.zeros(hi - lo, np.uint64)
    held[set_.column("block").to_numpy()] = set_.column("bits").to_numpy().view(np.uint64)
    return spark.sparkContext.broadcast(held)


def _positives(
    batches: Iterator[pa.RecordBatch], shards: Shards, alphabet: list[int], lo: int, held: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """The ids of words with the keys of their edits that may be words."""
    terms = _letter(np.array(alphabet))
    rank = np.zeros(max(alphabet) + 1, np.int64)
    rank[alphabet] = np.arange(len(alphabet))

    def probed(total: np.ndarray, length: np.ndarray, ids: np.ndarray) -> pa.RecordBatch | None:
        key = _key(total, length)
        block = shards.block(key, length)
        here = np.flatnonzero((block >= lo) & (block < lo + len(held)))
        bits = shards.bits(key[here])
        here = here[held[block[here] - lo] & bits == bits]
        if len(here):
            return pa.RecordBatch.from_arrays([pa.array(ids[here]), pa.array(key[here].view(np.int64))], ["id", "key"])

    for batch in batches:
        letters, ids = Letters(batch.column("word").to_pylist()), batch.column("id").to_numpy()
        for a in range(0, len(letters.code), _LETTERS_AT_ONCE):
            at = np.arange(a, min(len(letters.code), a + _LETTERS_AT_ONCE))
            word, place = letters.word[at], letters.place[at]
            first, end = letters.first[word], letters.first[word + 1]
            before = letters.sums[at] - letters.sums[first]
            after = letters.sums[end] - letters.sums[at + 1]
            # of equal letters side by side only the first is deleted
            same = (place > 0) & (letters.code[at] == letters.code[np.maximum(at - 1, 0)])
            shorter = (before + after * _BACK)[~same]
            found = [probed(shorter, letters.length[word][~same] - 1, ids[word[~same]])]
            own = rank[letters.code[at]]
            for n in range(1, len(alphabet)):
                lower = own < n
                total = (before + after)[lower] + terms[n] * letters.power[place[lower]]
                found.append(probed(total, letters.length[word][lower], ids[word[lower]]))
            yield from (f for f in found if f is not None)
