"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The vocabulary comes from a model file, its scores as they stand there. Spaces become the marker U+2581 and
one marker is put before the text. The best path is the one of highest total score; where no piece covers a
character it goes by its UTF-8 bytes, as does a U+2581 of the text itself, so decoding gives back every text
exactly. As pieces hold the marker only at their start, the path is found word by word, for all new words of a
group of texts in step, and a task keeps the paths of about ``REMEMBERED`` words.

At scale: encoding and decoding work row by row, without any shuffle; what is sent to the tasks is the
vocabulary.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .words import slices

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
REMEMBERED = 200_000
GROUP_CHARS = 1_000_000
#: Longer words, in bytes, are found one by one.
LONG_WORD = 64
_AT_ONCE = 8192
#: Rows of ids that are decoded into one batch.
ROWS_AT_ONCE = 256

_MARK = "▁"
_UNKNOWN_BELOW_LEAST = 10.0


class DoubleArray:
    """A trie in two arrays: from state s, byte c leads to t = base[s] + c + 1 if check[t] is s."""

    def __init__(self, keys: list[bytes], values: list[int]):
        order = sorted(range(len(keys)), key=keys.__getitem__)
        keys, values = [keys[i] for i in order], [values[i] for i in order]
        self.base, self.check, self.value = [0], [0], [-1]
        self._free, self._dense = 258, 0  # lower cells cannot be reached by every code
        todo = [(0, 0, len(keys), 0)]
        while todo:
            state, lo, hi, depth = todo.pop()
            if lo < hi and len(keys[lo]) == depth:
                self.value[state] = values[lo]
                lo += 1
            children = []
            while lo < hi:
                byte, start = keys[lo][depth], lo
                while lo < hi and keys[lo][depth] == byte:
                    lo += 1
                children.append((byte, start, lo))
            if children:
                base = self.base[state] = self._place([c[0] + 1 for c in children])
                for byte, a, b in children:
                    self.check[base + byte + 1] = state
                    todo.append((base + byte + 1, a, b, depth + 1))
        self._grow(max(self.base) + 258)

    def _grow(self, size: int) -> None:
        more = size - len(self.check)
        if more > 0:
            self.base += [0] * more
            self.check += [-1] * more
            self.value += [-1] * more

    def _place(self, codes: list[int]) -> int:
        """A place from which all codes lead to free cells: single codes fill the gaps, others go further on."""
        while self._free < len(self.check) and self.check[self._free] != -1:
            self._free += 1
        first = base = max(0, self._free - codes[0], self._dense if len(codes) > 1 else 0)
        while True:
            self._grow(base + codes[-1] + 1)
            if all(self.check[base + c] == -1 for c in codes):
                if base - first > 64:
                    self._dense = base
                return base
            base += 1


class Vocabulary:
    """The pieces of a model file. ``bytes_of`` has what each id stands for, markers as spaces."""

    def __init__(self, model_file: str = MODEL_FILE):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        ids = range(model.get_piece_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.byte_ids = [i for i in ids if model.is_byte(i)]
        if len(self.byte_ids) != 256:
            raise ValueError("the vocabulary has no byte pieces to fall back on")
        plain = [i for i in ids if i not in special and not model.is_byte(i)]
        pieces = {i: model.id_to_piece(i) for i in plain}
        self.scores = [model.get_score(i) for i in ids]
        self.unknown = min(self.scores[i] for i in plain) - _UNKNOWN_BELOW_LEAST
        self.bytes_of = [b""] * len(ids)
        for i, piece in pieces.items():
            self.bytes_of[i] = piece.replace(_MARK, " ").encode()
        for byte, i in enumerate(self.byte_ids):
            self.bytes_of[i] = bytes([byte])
        self.trie = DoubleArray([p.encode() for p in pieces.values()], plain)
        apart = "".join(c for c in "\n\t" if not any(c in p for p in pieces.values()))
        by_word = all(_MARK not in p.lstrip(_MARK) for p in pieces.values())
        #: what the best path never crosses
        self.words = f"[{apart}]+|{_MARK}*[^{_MARK}{apart}]+|{_MARK}+" if apart and by_word else (
            f"{_MARK}*[^{_MARK}]+|{_MARK}+" if by_word else "(?s).+"
        )

    @cached_property
    def encoder(self) -> Encoder:
        return Encoder(self)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "encoder"}

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encoder.packed([text])[0], "<i4").tolist()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids)).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


class Encoder(dict):
    """The ids of words, packed as 32-bit numbers; new ones are found, all are forgotten when there are too many."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self._vocabulary, self._words = vocabulary, re.compile(vocabulary.words)
        trie = vocabulary.trie
        self._base, self._check, self._value = (np.array(x, np.int32) for x in (trie.base, trie.check, trie.value))
        self._scores = np.array(vocabulary.scores)
        self._own_mark = np.array([vocabulary.byte_ids[b] for b in _MARK.encode()], "<i4").tobytes()

    def packed(self, texts: list[str | None]) -> list[bytes | None]:
        """The packed ids of every text; the words of about GROUP_CHARS characters of text are found together."""
        out, lo = [], 0
        while lo < len(texts):
            hi, chars = lo, 0
            while hi < len(texts) and (hi == lo or chars < GROUP_CHARS):
                chars, hi = chars + len(texts[hi] or ""), hi + 1
            split = [None if t is None else self._split(t) for t in texts[lo:hi]]
            self._find(split)
            out += [None if words is None else b"".join(map(self.__getitem__, words)) for words in split]
            lo = hi
        return out

    def _split(self, text: str) -> list[str | None]:
        """The words of a text; None stands for a marker that the text itself has."""
        if not text:
            return []
        first, *others = text.split(_MARK)
        words = self._words.findall((_MARK + first).replace(" ", _MARK))
        for part in others:
            words.append(None)
            words += self._words.findall(part.replace(" ", _MARK))
        return words

    def _find(self, split: list[list[str | None] | None]) -> None:
        if len(self) > REMEMBERED:
            self.clear()
        self[None] = self._own_mark
        new = {w for words in split if words for w in words} - self.keys()
        raw = sorted(((w.encode(), w) for w in new), key=lambda x: len(x[0]))
        short = [x for x in raw if len(x[0]) <= LONG_WORD]
        rest = raw[len(short) :]
        for lo in range(0, len(short), _AT_ONCE):
            part = short[lo : lo + _AT_ONCE]
            ids, left = self._best_paths([w for w, _ in part])
            self.update((word, found) for (_, word), found in zip(part, ids) if found is not None)
            rest += [part[i] for i in left]
        for encoded, word in rest:
            self[word] = np.array(self._best_path(encoded), "<i4").tobytes()

    def _best_paths(self, words: list[bytes]) -> tuple[list[bytes | None], list[int]]:
        """As :meth:`_best_path` for many words in step, and the places of those with an uncovered character."""
        count, size = len(words), np.array([len(w) for w in words])
        width = int(size[-1])
        text = np.frombuffer(b"".join(w.ljust(width, b"\xff") for w in words), np.uint8).reshape(count, width)
        best = np.full((count, width + 1), -np.inf)
        best[:, 0] = 0
        start, piece = np.zeros((count, width + 1), np.int16), np.full((count, width + 1), -1, np.int32)
        covered = np.ones(count, bool)
        lead = text & 0xC0 != 0x80
        chars = np.where(text < 0xC0, 1, np.where(text < 0xE0, 2, np.where(text < 0xF0, 3, 4)))
        for at in range(width):
            row = np.flatnonzero(lead[:, at] & (size > at) & covered)
            state, single = np.zeros(len(row), np.int32), np.zeros(count, bool)
            begun = row
            for to in range(at, width):
                after = self._base[state] + text[row, to] + 1
                alive = (self._check[after] == state) & (size[row] > to)
                row, state = row[alive], after[alive]
                if not len(row):
                    break
                found = self._value[state]
                has = found >= 0
                at_row, at_piece = row[has], found[has]
                total = best[at_row, at] + self._scores[at_piece]
                better = total > best[at_row, to + 1]
                at_row = at_row[better]
                best[at_row, to + 1], piece[at_row, to + 1], start[at_row, to + 1] = total[better], at_piece[better], at
                whole = row[has]
                single[whole[chars[whole, at] == to + 1 - at]] = True
            covered[begun[~single[begun]]] = False
        tokens, place = np.full((count, width), -1, np.int32), size.copy()
        column = width
        while place.any():
            column -= 1
            moving = np.flatnonzero(place)
            tokens[moving, column] = piece[moving, place[moving]]
            place[moving] = start[moving, place[moving]]
        first = width - (tokens >= 0).sum(axis=1)
        packed = tokens.astype("<i4").tobytes()
        ids = [packed[4 * (i * width + f) : 4 * (i + 1) * width] if c else None
               for i, (f, c) in enumerate(zip(first.tolist(), covered.tolist()))]
        return ids, np.flatnonzero(~covered).tolist()

    def _best_path(self, word: bytes) -> list[int]:
        vocabulary, trie = self._vocabulary, self._vocabulary.trie
        base, check, value, scores = trie.base, trie.check, trie.value, vocabulary.scores
        end = len(word)
        best: list[float | None] = [None] * (end + 1)
        best[0] = 0.0
        start, piece = [0] * (end + 1), [-1] * (end + 1)
        at = 0
        while at < end:
            lead = word[at]
            width = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            so_far, state, to, single = best[at], 0, at, False
            while to < end:
                after = base[state] + word[to] + 1
                if check[after] != state:
                    break
                state, to = after, to + 1
                found = value[state]
                if found >= 0:
                    total = so_far + scores[found]
                    if best[to] is None or total > best[to]:
                        best[to], start[to], piece[to] = total, at, found
                    single |= to - at == width
            if not single:
                to = at + width
                total = so_far + vocabulary.unknown
                if best[to] is None or total > best[to]:
                    best[to], start[to], piece[to] = total, at, -1
            at += width
        path, to = [], end
        while to:
            at = start[to]
            path.append([piece[to]] if piece[to] >= 0 else [vocabulary.byte_ids[b] for b in word[at:to]])
            to = at
        return [i for ids in reversed(path) for i in ids]


def encode(docs: DataFrame, vocabulary: Vocabulary, text_column: str = "text", ids_column: str = "ids") -> DataFrame:
    """``docs`` with the ids of its texts in ``ids_column``, which replaces a column of that name.

    A null text has null ids, an empty one none. All other columns and rows stay as they are.
    """
    docs = docs.select(*(f"`{c}`" for c in docs.columns if c != ids_column))
    schema = T.StructType([*docs.schema, T.StructField(ids_column, T.ArrayType(T.IntegerType(), False))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder
        for batch in (part for whole in batches for part, _, _ in slices(whole, text_column)):
            packed = encoder.packed(batch.column(text_column).to_pylist())
            sizes = np.array([0 if p is None else len(p) // 4 for p in packed], np.int64)
            flat = pa.array(np.frombuffer(b"".join(p for p in packed if p), "<i4"))
            offsets = pa.array(
                np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32),
                mask=np.array([*(p is None for p in packed), False]),
            )
            ids = pa.ListArray.from_arrays(offsets, flat)
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], [*batch.schema.names, ids_column])

    return docs.mapInArrow(work, schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary, ids_column: str = "ids", text_column: str = "decoded") -> DataFrame:
    """``encoded`` with the texts of its ids in ``text_column``, which replaces a column of that name.

    Null ids give a null text. Ids of control pieces stand for nothing.
    """
    encoded = encoded.select(*(f"`{c}`" for c in encoded.columns if c != text_column))
    schema = T.StructType([*encoded.schema, T.StructField(text_column, T.StringType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(lo, ROWS_AT_ONCE) for whole in batches for lo in range(0, whole.num_rows, ROWS_AT_ONCE)):
            ids = batch.column(ids_column)
            flat, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()[: len(ids) + 1].tolist()
            known = ids.is_valid().to_pylist()
            # one row's ids at a time are Python numbers
            texts = [vocabulary.decode(flat[a:b].tolist()) if k else None for a, b, k in zip(offsets, offsets[1:], known)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, text_column]
            )

    return encoded.mapInArrow(work, schema)
