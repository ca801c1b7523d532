"""Language identification by cross-parsing against suffix automata of labelled text.

A bounded sample of labelled text per language becomes a suffix automaton, which knows every substring of its
sample. A text is parsed against each: the longest match from the current place is one phrase, the next phrase
begins behind it. The number of phrases times log2 of the sample's length, over the length of the text, is its
cross-parsing entropy; the language with the least wins.

At scale: learning takes ``SAMPLE_DOCS`` texts per language, chosen by hash and limited map-side, with
``SAMPLE_BYTES`` of each; only these reach the driver. Predicting works row by row on whole texts without any
shuffle; tasks get the samples (a fixed size per language) and build the automata themselves. Texts are parsed
in segments of ``SEGMENT`` bytes, all segments of a slice of documents and all languages in step.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .words import slices

SAMPLE_DOCS, SAMPLE_BYTES = 64, 512
SEGMENT = 512
UNKNOWN = "und"

#: How sharply the entropies of the languages turn into a score.
_SHARPNESS = 4.0
_GAP = 32
_LETTER = r"\p{L}"

_CLASS = np.full(256, _GAP, np.uint8)
_CLASS[128:] = np.arange(128, 256)
_CLASS[65:91] = np.arange(97, 123)
_CLASS[97:123] = np.arange(97, 123)


def letters(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with A-Z and Latin-1 capitals in lower case and one gap for every run of other ASCII bytes."""
    plain = _CLASS[data]
    if len(plain) > 1:
        capital = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)
        plain[1:][capital] += 0x20
    keep = plain != _GAP
    keep[1:] |= plain[:-1] != _GAP
    keep[bounds[:-1][bounds[:-1] < len(data)]] = True
    places = np.concatenate([[0], np.cumsum(keep)])
    return plain[keep], places[bounds]


class SuffixAutomaton:
    """All substrings of a text. ``to[s]`` maps a byte to the next state; state 0 is the empty string."""

    def __init__(self, text: bytes):
        self.to, link, length = [{}], [-1], [0]
        last = 0
        for byte in text:
            new = self._add({}, length[last] + 1, 0, link, length)
            at = last
            while at >= 0 and byte not in self.to[at]:
                self.to[at][byte] = new
                at = link[at]
            if at >= 0:
                other = self.to[at][byte]
                if length[other] == length[at] + 1:
                    link[new] = other
                else:
                    copy = self._add(dict(self.to[other]), length[at] + 1, link[other], link, length)
                    while at >= 0 and self.to[at].get(byte) == other:
                        self.to[at][byte] = copy
                        at = link[at]
                    link[other] = link[new] = copy
            last = new

    def _add(self, to: dict, size: int, parent: int, link: list, length: list) -> int:
        self.to.append(to)
        link.append(parent)
        length.append(size)
        return len(self.to) - 1


class Parser:
    """Cross-parsing of many texts against the samples of all languages, in step."""

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        known = sorted({b for s in samples.values() for b in s})
        #: bytes that no sample has share the last column, which leads nowhere
        self._column = np.full(256, len(known), np.int64)
        self._column[known] = np.arange(len(known))
        width, tables, self._root, first = len(known) + 1, [], [], 0
        for language in self.languages:
            automaton = SuffixAutomaton(samples[language])
            table = np.full((len(automaton.to), width), -1, np.int32)
            for state, to in enumerate(automaton.to):
                for byte, target in to.items():
                    table[state, self._column[byte]] = first + target
            tables.append(table)
            self._root.append(first)
            first += len(table)
        self._table, self._width = np.concatenate(tables).ravel(), width
        self._root = np.array(self._root, np.int32)[:, None]
        self._bits = np.log2(np.array([max(2, len(samples[name])) for name in self.languages]))

    def entropies(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Bits per byte of every text (rows) in every language (columns)."""
        sizes = np.diff(bounds)
        parts = -(-sizes // SEGMENT)
        row = np.repeat(np.arange(len(sizes)), parts)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = bounds[row] + nth * SEGMENT
        size = np.minimum(SEGMENT, bounds[row + 1] - start)
        order = np.argsort(-size, kind="stable")
        start, size, row = start[order], size[order], row[order]
        columns = self._column[data]
        state = np.repeat(self._root, len(row), axis=1)
        phrases = np.zeros(state.shape, np.int32)
        for step in range(int(size.max(initial=0))):
            n = int(np.searchsorted(-size, -step, "left"))
            column = columns[start[:n] + step]
            here = state[:, :n]
            after = self._table[here.astype(np.int64) * self._width + column]
            ended = after < 0
            again = self._table[self._root * self._width + column]
            # a byte that no match can begin with is a phrase of its own
            phrases[:, :n] += ended
            phrases[:, :n] += ended & (again < 0) & (here != self._root)
            state[:, :n] = np.where(ended, np.where(again < 0, self._root, again), after)
        phrases += state != self._root
        per_text = np.stack([np.bincount(row, p, len(sizes)) for p in phrases], axis=1)
        return per_text * self._bits / np.maximum(sizes, 1)[:, None]


@lru_cache(maxsize=2)
def _parser(samples: tuple[tuple[str, bytes], ...]) -> Parser:
    return Parser(dict(samples))


def learn(
    docs: DataFrame, may_learn: Column, text_column: str = "text", language_column: str = "lang",
    sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES,
) -> dict[str, bytes]:
    """A sample of text for every language of the rows where ``may_learn``.

    ``sample_docs`` distinct texts per language, the smallest by a hash of the text, ``sample_bytes`` characters
    from the middle of each; those with a letter in the middle come first. Rows without language or text and texts
    without a letter teach nothing, and copies count once. What the driver gets is bounded by these.
    """
    middle = F.expr(f"substring(text, greatest(1, (char_length(text) - {sample_bytes}) div 2), {sample_bytes})")
    rows = docs.select(
        F.col(language_column).alias("lang"), F.col(text_column).alias("text"), may_learn.alias("may")
    ).where("may AND lang IS NOT NULL AND text IS NOT NULL").where(F.col("text").rlike(_LETTER))
    rows = rows.select("lang", F.xxhash64("text").alias("order"), middle.alias("middle"))
    order = Window.partitionBy("lang").orderBy("bare", "order")
    chosen = rows.select("lang", (~F.col("middle").rlike(_LETTER)).alias("bare"), "order").distinct()
    chosen = chosen.withColumn("place", F.row_number().over(order)).where(F.col("place") <= sample_docs)
    # a language has sample_docs rows at most, so this side is as small as the list of languages
    texts = rows.join(F.broadcast(chosen.select("lang", "order", "place")), ["lang", "order"])
    texts = texts.groupBy("lang", "place").agg(F.min("middle").alias("text"))
    samples: dict[str, list[bytes]] = {}
    for row in texts.orderBy("lang", "place").collect():
        raw = np.frombuffer(row["text"].encode(), np.uint8)
        samples.setdefault(row["lang"], []).append(letters(raw, np.array([0, len(raw)]))[0].tobytes())
    return {name: b" ".join(parts) for name, parts in samples.items() if any(parts)}


def predict(docs: DataFrame, samples: dict[str, bytes], id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (0 to 1) for every row of ``docs``.

    A text without any letter, an empty or null one, and every text when nothing was learned, is ``und`` with
    score 0. Equal entropies go to the first language by name. Repeated rows are predicted alike. Only the two
    named columns are read. No rows give no rows.
    """
    fixed = tuple(sorted(samples.items()))
    docs = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(lambda it: _predicted(it, fixed), f"doc_id {id_type}, lang_pred string, score double")


def _predicted(batches: Iterator[pa.RecordBatch], samples: tuple) -> Iterator[pa.RecordBatch]:
    parser = _parser(samples) if samples else None
    for batch in batches:
        for part, data, bounds in slices(batch):
            names, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
            if parser:
                plain, cuts = letters(data, bounds)
                bits = parser.entropies(plain, cuts)
                best = bits.argmin(axis=1)
                share = 1 / np.exp(_SHARPNESS * (bits.min(axis=1, keepdims=True) - bits)).sum(axis=1)
                ascii_letters = np.concatenate([[0], np.cumsum((plain >= 97) & (plain <= 122))])[cuts]
                sure = np.diff(ascii_letters) > 0
                for i in range(part.num_rows):
                    if sure[i] or any(map(str.isalpha, data[bounds[i] : bounds[i + 1]].tobytes().decode())):
                        names[i], scores[i] = parser.languages[best[i]], share[i]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"]
            )
