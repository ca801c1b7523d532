"""A quality classifier: random-indexing word vectors pooled per document, and a small calibrated network.

Every word has a sparse random index vector. In a bounded sample of labelled texts the index vectors of the
words around a word add up to its word vector. A document is the mean of the vectors of its words; a network of
two layers turns it into a score, whose temperature is fitted on labelled texts that the network was not
trained on. Words are runs of letters, of digits or of other signs, in lower case, told apart by their case;
those outside the vocabulary share one vector per kind, case and length. A word that stood just before is the
word "again" of its kind and case.

At scale: learning takes at most ``SAMPLE_DOCS`` labelled texts, chosen by a hash, first in salted groups of each
label and then among what these leave, and ``SAMPLE_CHARS`` of each; the driver fits the model on these. Scoring works row by row on whole texts without
any shuffle; what is sent to the tasks is the model, of a size fixed by ``VOCABULARY`` and ``DIMENSIONS``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, tasks
from .words import mix, segment_hashes, slices

SAMPLE_DOCS, SAMPLE_CHARS = 4000, 4000
VOCABULARY, DIMENSIONS, NONZERO, REACH = 8192, 64, 4, 2
HIDDEN, EPOCHS, RATE, DECAY = 32, 300, 0.01, 1e-3

#: Bytes of text that are scored at a time.
SCORE_BYTES = 125_000

#: Documents of the sample that are turned into words and vectors at a time.
_FIT_DOCS = 128
#: Pairs of neighbouring words whose vectors are added up at a time.
_FIT_PAIRS = 65_536

_SPACE, _LETTER, _DIGIT, _SIGN = 0, 1, 2, 3
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[48:58] = _DIGIT
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _LETTER
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def tokens(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, name, backoff name) of all words of some texts, as hashes."""
    kind = _KIND[data]
    new = np.ones(len(data), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[bounds[:-1][bounds[:-1] < len(data)]] = True
    edges = np.append(np.flatnonzero(new), len(data))
    start, end = edges[:-1], edges[1:]
    word = kind[start] != _SPACE
    start, end = start[word], end[word]
    capital = np.concatenate([[0], np.cumsum(_UPPER[data])])
    capitals, size = capital[end] - capital[start], end - start
    case = np.where(capitals == 0, 0, np.where(capitals == 1, 1, np.where(2 * capitals >= size, 2, 3)))
    shape = kind[start].astype(np.uint64) * np.uint64(4) + case.astype(np.uint64)
    name = mix(segment_hashes(_LOWER[data], start, end) ^ mix(shape + np.uint64(1)))
    length = np.minimum(np.log2(size.clip(1)).astype(np.uint64), np.uint64(7))
    backoff = mix((shape * np.uint64(8) + length) ^ np.uint64(0xABCDEF))
    row = np.searchsorted(bounds, start, "right") - 1
    again = np.zeros(len(name), bool)
    for step in range(1, REACH + 1):
        again[step:] |= (name[step:] == name[:-step]) & (row[step:] == row[:-step])
    name[again] = mix(shape[again] ^ np.uint64(0x123456789))
    return row, name, backoff


def index_vectors(names: np.ndarray) -> np.ndarray:
    """The sparse random vector of every name: NONZERO entries of 1 or -1."""
    out = np.zeros((len(names), DIMENSIONS), np.float32)
    for k in range(NONZERO):
        h = mix(names + np.uint64(k * 7919 + 1))
        sign = np.where(h & np.uint64(1), 1, -1).astype(np.float32)
        np.add.at(out, (np.arange(len(names)), ((h >> np.uint64(8)) % np.uint64(DIMENSIONS)).astype(np.int64)), sign)
    return out


@dataclass(frozen=True)
class Model:
    """``names`` of the vocabulary, sorted, and their ``vectors``; the layers; the temperature."""

    names: np.ndarray
    vectors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    layers: tuple[np.ndarray, ...]
    temperature: float

    def pooled(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        row, name, backoff = tokens(data, bounds)
        return pool(len(bounds) - 1, row, self.vectors[places(self.names, name, backoff)])

    def score(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-logits(self.layers, (pooled - self.centre) / self.spread) / self.temperature))


def places(names: np.ndarray, name: np.ndarray, backoff: np.ndarray) -> np.ndarray:
    """Where each word, or else its backoff, stands in the sorted ``names``; one behind the end if neither does."""

    def find(wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
        return at, names[at] == wanted

    at, known = find(name)
    other, shared = find(backoff)
    return np.where(known, at, np.where(shared, other, len(names)))


def pool(rows: int, row: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The mean vector of every row; zero for a row without words. ``row`` ascends."""
    out = np.zeros((rows, DIMENSIONS), np.float32)
    if len(row):
        first = np.flatnonzero(np.diff(row, prepend=-1))
        sums = np.add.reduceat(vectors, first, axis=0)
        out[row[first]] = sums / np.diff(np.append(first, len(row)))[:, None]
    return out


def logits(layers: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = layers
    # unlike @, this adds up a row alike in every batch
    return np.einsum("ij,j->i", np.tanh(np.einsum("ij,jk->ik", x, w1) + b1), w2) + b2[0]


def labelled_sample(
    docs: DataFrame, labels: DataFrame, may_learn: Column, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "quality", sample_docs: int = SAMPLE_DOCS, sample_chars: int = SAMPLE_CHARS,
) -> list[tuple[str, int]]:
    """(text, label) of at most ``sample_docs`` rows of ``docs`` where ``may_learn``, at most half of each label.

    The smallest by a hash of the id are taken, ``sample_chars`` characters from the middle of each. Ids of
    several labels count with the smaller; labels other than 0 and 1 and null ids teach nothing.
    """
    labels = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("label")).where("label IN (0, 1)")
    labels = labels.groupBy("id").agg(F.min("label").alias("label"))
    rows = numbered(docs, "quality_rows", may=may_learn).select(
        "row", F.col("whole")[id_column].alias("id"), F.coalesce(F.col("whole")[text_column], F.lit("")).alias("text"), "may"
    )
    most, salts = sample_docs // 2, math.ceil(math.sqrt(tasks(docs.sparkSession)))
    chosen = rows.where("may").select("row", "id").join(labels, "id")
    chosen = chosen.withColumn("salt", F.pmod(F.xxhash64("id", "row"), F.lit(salts)))
    for group in (["label", "salt"], ["label"]):
        order = Window.partitionBy(*group).orderBy(F.xxhash64("id"), "id", "row")
        chosen = chosen.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)
    chosen = chosen.select("row", "label", "place")
    middle = F.expr(f"substring(text, greatest(1, (char_length(text) - {sample_chars}) div 2), {sample_chars})")
    # at most sample_docs rows: a fixed size
    texts = rows.join(F.broadcast(chosen), "row").select("label", "place", middle.alias("text"))
    return [(r["text"], r["label"]) for r in sorted(texts.collect(), key=lambda r: (r["label"], r["place"]))]


def fit(sample: list[tuple[str, int]], seed: int = 7) -> Model:
    """The model of a sample; without one, or with one label only, its score is the share of label 1, or 0.5."""
    rng = np.random.default_rng(seed)
    label = np.array([y for _, y in sample], np.float64)
    row, name, backoff = _sample_tokens([t for t, _ in sample])

    frequent, count = np.unique(name, return_counts=True)
    frequent = frequent[np.lexsort((frequent, -count))][:VOCABULARY]
    names = np.unique(np.concatenate([frequent, np.unique(backoff), np.zeros(1, np.uint64)]))
    at = places(names, name, backoff)
    vectors = _word_vectors(names, row, at)
    cuts = np.searchsorted(row, np.arange(0, len(sample) + _FIT_DOCS, _FIT_DOCS))
    parts = [pool(len(sample), row[a:b], vectors[at[a:b]]) for a, b in zip(cuts, cuts[1:])]
    pooled = np.sum(parts, axis=0) if parts else np.zeros((0, DIMENSIONS), np.float32)
    centre, spread = pooled.mean(axis=0, dtype=np.float64) if len(sample) else np.zeros(DIMENSIONS), np.ones(DIMENSIONS)
    layers = _first_layers(rng, label)
    if len(set(label.tolist())) < 2:
        return Model(names, vectors, centre, spread, layers, 1.0)
    spread = np.maximum(pooled.std(axis=0, dtype=np.float64), 1e-6)
    x = (pooled - centre) / spread
    order = rng.permutation(len(sample))
    aside, train = order[: len(order) // 5], order[len(order) // 5 :]
    layers = _trained(layers, x[train], label[train])
    return Model(names, vectors, centre, spread, layers, _temperature(logits(layers, x[aside]), label[aside]))


def _sample_tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts, read a few texts at a time."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    for lo in range(0, len(texts), _FIT_DOCS):
        raw = [t.encode() for t in texts[lo : lo + _FIT_DOCS]]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        row, name, backoff = tokens(np.frombuffer(b"".join(raw), np.uint8), bounds)
        found.append((row + lo, name, backoff))
    return tuple(np.concatenate(parts) for parts in zip(*found))


def _word_vectors(names: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Its own index vector and the mean of those around it, for every name; the last is for unknown words."""
    index = index_vectors(names)
    around = np.zeros_like(index)
    seen = np.zeros(len(names))
    for step in range(1, REACH + 1):
        same = row[step:] == row[:-step]
        left, right = at[:-step][same], at[step:][same]
        for word, context in ((left, right), (right, left)):
            pairs, count = np.unique(word * len(names) + context, return_counts=True)
            for lo in range(0, len(pairs), _FIT_PAIRS):
                part, times = pairs[lo : lo + _FIT_PAIRS], count[lo : lo + _FIT_PAIRS, None].astype(np.float32)
                np.add.at(around, part // len(names), index[part % len(names)] * times)
            np.add.at(seen, pairs // len(names), count)
    vectors = index + around / np.maximum(seen, 1)[:, None].astype(np.float32)
    return np.concatenate([vectors, np.zeros((1, DIMENSIONS), np.float32)])


def _first_layers(rng: np.random.Generator, label: np.ndarray) -> tuple[np.ndarray, ...]:
    share = min(max(float(label.mean()), 0.01), 0.99) if len(label) else 0.5
    w1 = rng.normal(0, DIMENSIONS**-0.5, (DIMENSIONS, HIDDEN))
    return w1, np.zeros(HIDDEN), np.zeros(HIDDEN), np.array([np.log(share / (1 - share))])


def _trained(layers: tuple[np.ndarray, ...], x: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, ...]:
    """Full-batch Adam on the cross entropy, both labels with the same total weight."""
    weight = np.where(label == 1, 0.5 / max(label.mean(), 1e-9), 0.5 / max(1 - label.mean(), 1e-9)) / len(label)
    layers = [a.copy() for a in layers]
    first, second = [np.zeros_like(a) for a in layers], [np.zeros_like(a) for a in layers]
    for step in range(1, EPOCHS + 1):
        w1, b1, w2, b2 = layers
        hidden = np.tanh(x @ w1 + b1)
        wrong = (1 / (1 + np.exp(-(hidden @ w2 + b2[0]))) - label) * weight
        back = wrong[:, None] * w2 * (1 - hidden**2)
        slopes = [x.T @ back + DECAY * w1, back.sum(axis=0), hidden.T @ wrong + DECAY * w2, np.array([wrong.sum()])]
        for a, m, v, g in zip(layers, first, second, slopes):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            a -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return tuple(layers)


def _temperature(raw: np.ndarray, label: np.ndarray) -> float:
    """The temperature with the least cross entropy on labels that were set aside."""
    if not len(raw):
        return 1.0
    sign = np.where(label == 1, 1.0, -1.0)
    return float(min(np.geomspace(0.25, 8, 61), key=lambda t: np.logaddexp(0, -sign * raw / t).mean()))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, score of every row of ``docs``: how likely label 1 is, from 0 to 1.

    Texts without words, also null ones, get the score of a document of no words. Repeated rows are scored
    alike. Only the two named columns are read. No rows give no rows.
    """
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(lambda it: _scored(it, model), f"doc_id {id_type}, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.5, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` with a score of ``least`` or more, with all their columns."""
    @F.arrow_udf("double")
    def scores(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in texts:
            batch = pa.RecordBatch.from_arrays([part], ["text"])
            found = [model.score(model.pooled(data, bounds)) for _, data, bounds in slices(batch, size=SCORE_BYTES)]
            yield pa.array(np.concatenate([np.zeros(0), *found]))

    # only the texts go to Python and only the scores come back
    whole = docs.select(F.struct("*").alias("whole"))
    scored = whole.select("whole", scores(F.col("whole")[text_column].cast("string")).alias("score"))
    return scored.where(F.col("score") >= least).select("whole.*")


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, bounds in slices(batch, size=SCORE_BYTES):
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(model.score(model.pooled(data, bounds)))], ["doc_id", "score"]
            )
