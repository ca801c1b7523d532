"""BPE encoding and decoding by a tokenization automaton.

The automaton reads tokens. It accepts a sequence of tokens exactly if byte-pair merging gives that sequence, and is
built from one state, in which any bytes may follow each other, by one gadget per merge, in order of rank. The
gadget of u + v takes away what the merge makes impossible, a v right after a u, and adds the arc of uv beside:

* the state after u is split off from other tokens' state, if they share it, and loses its arc v;
* every state with an arc u gets an arc uv, which leads to where v has led.

What follows a token depends on the token alone, so the state an arc leads to is a property of its token. Which
arcs a state has lost is kept as intervals. Tokens are numbered so that the later tokens that start with a lost
one, whose arcs are therefore never added, stand right before it: every gadget takes away one interval.

A text is split into words first. Every prefix of a word has exactly one accepted sequence of tokens, so each place
in the bytes of a word is reached by exactly one arc, from the one state of an earlier place: words are encoded from
left to right by table look-ups alone (a double-array trie for the bytes of an arc, the intervals, the states),
without ranks or queues, all new words of a group of texts in step. Decoding emits the labels of the arcs.

At scale: both work row by row, without any shuffle; what is sent to the tasks are the tables of the vocabulary.
"""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .pieces import DoubleArray
from .words import slices

VOCABULARY_FILE = "/opt/tokenizers/byte_bpe_50k.json"
REMEMBERED = 200_000
GROUP_CHARS = 1_000_000
#: Longer words, in bytes, are found one by one.
LONG_WORD = 64
_AT_ONCE = 8192
#: Rows of ids that are decoded into one batch.
ROWS_AT_ONCE = 256

# Characters up to here, and general punctuation, have had the same classes in all versions of
# Unicode that tables in use go by. Texts with others are split by the vocabulary's own library.
_SETTLED = (range(0x530), range(0x2000, 0x2070))
_SPACES = r"\t-\r \x85\xa0 -     "


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in the vocabulary file: itself if it is visible, else one above 255."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(hidden)}


class Automaton:
    """States and arcs of the merges (left, right, made), ids of tokens in order of rank.

    ``target`` has the state after each token, ``place`` its number in the order of the intervals; the intervals of
    tokens that a state has no arc of are ``lost_from``, ``lost_to``, as state * width + place, in order.
    """

    def __init__(self, base: list[int], merges: list[tuple[int, int, int]]):
        known, size = set(base), max([*base, *(m[2] for m in merges)], default=-1) + 1
        children: dict[int, list[int]] = {}
        for left, right, made in merges:
            if left not in known or right not in known or made in known:
                raise ValueError("a merge joins two tokens that are there already into a new one")
            known.add(made)
            children.setdefault(left, []).append(made)
        self.width = size
        self.place, begin = self._numbered(base, children, size)

        target, users, lost = [-1] * size, [len(base) + 1], [[]]  # the start uses the first state too
        for token in base:
            target[token] = 0
        started = dict.fromkeys(children, 0)  # how many tokens that start with this one are made
        self.dead = set()
        for left, right, made in merges:
            started[left] += 1
            gone = self.dead.intersection((left, right))
            if gone or any(a <= self.place[right] <= b for a, b in lost[target[left]]):
                self.dead.add(made)  # an earlier merge always comes before this one: no arc
                continue
            state, after = target[left], target[right]  # with left == right, where it led before the split
            if users[state] > 1 or left == right:
                users[state] -= 1
                lost.append(list(lost[state]))
                users.append(1)
                state = target[left] = len(lost) - 1
            # the token that is being made is one of the later ones if left == right
            later = children.get(right, ())[started.get(right, 0) - (left == right):]
            lost[state].append((begin[later[0]] if later else self.place[right], self.place[right]))
            target[made] = after
            users[after] += 1
        self.target = np.array(target, np.int32)
        from_, to = [], []
        for state, intervals in enumerate(lost):
            end = -1
            for a, b in sorted(intervals, key=lambda x: (x[0], -x[1])):
                if b > end:  # intervals are nested or apart
                    from_.append(state * size + a)
                    to.append(state * size + b)
                    end = b
        self.states, self.lost_from, self.lost_to = len(lost), np.array(from_, np.int64), np.array(to, np.int64)

    @staticmethod
    def _numbered(base: list[int], children: dict[int, list[int]], size: int) -> tuple[list[int], list[int]]:
        """Place and first place of every token with all that start with it, made first before made later."""
        place, begin, n = [-1] * size, [-1] * size, 0
        todo = [(token, False) for token in reversed(base)]
        while todo:
            token, left = todo.pop()
            if left:
                place[token] = n
                n += 1
            else:
                begin[token] = n
                todo.append((token, True))
                todo += [(child, False) for child in reversed(children.get(token, ()))]
        return place, begin

    @cached_property
    def _alive(self) -> np.ndarray:
        out = np.ones(self.width, bool)
        out[list(self.dead)] = False
        return out

    @cached_property
    def _places(self) -> np.ndarray:
        return np.array(self.place, np.int64)

    def has(self, states: np.ndarray, tokens: np.ndarray) -> np.ndarray:
        """Whether the states have arcs of the tokens."""
        alive = self._alive[tokens]
        if not len(self.lost_from):
            return alive
        keys = states.astype(np.int64) * self.width + self._places[tokens]
        at = np.searchsorted(self.lost_from, keys, "right") - 1
        return alive & ((at < 0) | (keys > self.lost_to[at]))

    @cached_property
    def _lists(self) -> tuple[list[int], list[int]]:
        return self.lost_from.tolist(), self.lost_to.tolist()

    def has_one(self, state: int, token: int) -> bool:
        from_, to = self._lists
        key = state * self.width + self.place[token]
        at = bisect_right(from_, key) - 1
        return token not in self.dead and (at < 0 or key > to[at])


class Vocabulary:
    """Tokens, merges and special tokens of a vocabulary file of byte-level BPE."""

    def __init__(self, vocabulary_file: str = VOCABULARY_FILE):
        with open(vocabulary_file, encoding="utf-8") as f:
            described = json.load(f)
        model, split = described["model"], described["pre_tokenizer"] or {}
        plain = not any(model.get(x) for x in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if model["type"] != "BPE" or not plain or described["normalizer"] or split.get("type") != "ByteLevel" or (
            split.get("add_prefix_space") or not split.get("use_regex", True)
        ):
            raise ValueError("only byte-level BPE without normaliser, prefix and suffix is supported")
        if any(x["single_word"] or x["lstrip"] or x["rstrip"] for x in described["added_tokens"]):
            raise ValueError("special tokens that take in what is around them are not supported")
        letters, ids = byte_letters(), model["vocab"]
        special = {x["content"]: x["id"] for x in described["added_tokens"]}
        labels = {i: bytes(map(letters.__getitem__, token)) for token, i in ids.items() if token not in special}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merges = [(ids[a], ids[b], ids[a + b]) for a, b in merges]
        base = [i for i, label in labels.items() if len(label) == 1]
        if len(base) != 256:
            raise ValueError("the vocabulary has no token for some byte")
        self.file, self.special = vocabulary_file, special
        self.automaton = Automaton(base, merges)
        reached = [*base, *(m[2] for m in merges)]
        self.trie = DoubleArray([labels[i] for i in reached], reached)
        #: what each id stands for
        self.labels = labels | {i: token.encode() for token, i in special.items()}

    @cached_property
    def encoder(self) -> Encoder:
        return Encoder(self)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "encoder"}

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encoder.packed([text])[0], "<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The labels of the ids; ids that name nothing stand for nothing, broken UTF-8 for U+FFFD."""
        try:
            return b"".join(map(self.labels.__getitem__, ids)).decode(errors="replace")
        except KeyError:
            return b"".join(self.labels.get(i, b"") for i in ids).decode(errors="replace")


def _settled_words() -> re.Pattern:
    """What a text of settled characters is split into; the classes are built from their categories."""
    def members(kind: str) -> str:
        return "".join(f"\\U{c:08x}" for r in _SETTLED for c in r if unicodedata.category(chr(c))[0] == kind)

    letter, digit = members("L"), members("N")
    return re.compile(
        rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{digit}]+| ?[^{_SPACES}{letter}{digit}]+"
        rf"|[{_SPACES}]+(?![^{_SPACES}])|[{_SPACES}]+"
    )


class Encoder(dict):
    """The ids of words, packed as 32-bit numbers; new ones are found, all are forgotten when there are too many."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self._vocabulary, self._automaton = vocabulary, vocabulary.automaton
        trie = vocabulary.trie
        self._base, self._check, self._value = (np.array(x, np.int32) for x in (trie.base, trie.check, trie.value))
        self._words = _settled_words()
        self._unsettled = re.compile(f"[^{''.join(f'{chr(r[0])}-{chr(r[-1])}' for r in _SETTLED)}]")
        special = sorted(vocabulary.special, key=len, reverse=True)
        self._special = re.compile(f"({'|'.join(map(re.escape, special))})") if special else None
        self._marks = {token: np.array([i], "<u4").tobytes() for token, i in vocabulary.special.items()}

    @cached_property
    def _library_split(self):
        from tokenizers import pre_tokenizers

        return pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str

    def packed(self, texts: list[str | None]) -> list[bytes | None]:
        """The packed ids of every text; the words of about GROUP_CHARS characters of text are found together."""
        out, lo = [], 0
        while lo < len(texts):
            hi, chars = lo, 0
            while hi < len(texts) and (hi == lo or chars < GROUP_CHARS):
                chars, hi = chars + len(texts[hi] or ""), hi + 1
            split = [None if t is None else self.split(t) for t in texts[lo:hi]]
            self._find(split)
            out += [None if words is None else b"".join(map(self.__getitem__, words)) for words in split]
            lo = hi
        return out

    def split(self, text: str) -> list:
        """The words of a text; a special token is a tuple of itself."""
        if self._special is None or not self._special.search(text):
            return self._split(text)
        words = []
        for n, part in enumerate(self._special.split(text)):
            words += [(part,)] if n % 2 else self._split(part)
        return words

    def _split(self, text: str) -> list[str]:
        if text.isascii() or not self._unsettled.search(text):
            return self._words.findall(text)
        return [text[a:b] for _, (a, b) in self._library_split(text)]

    def _find(self, split: list[list | None]) -> None:
        if len(self) > REMEMBERED:
            self.clear()
        new = set().union(*filter(None, split)) - self.keys()
        marks = [w for w in new if isinstance(w, tuple)]
        self.update((w, self._marks[w[0]]) for w in marks)
        raw = sorted(((w.encode(), w) for w in new.difference(marks)), key=lambda x: len(x[0]))
        short = [x for x in raw if len(x[0]) <= LONG_WORD]
        for lo in range(0, len(short), _AT_ONCE):
            part = short[lo : lo + _AT_ONCE]
            self.update((word, ids) for (_, word), ids in zip(part, self._paths([w for w, _ in part])))
        for encoded, word in raw[len(short) :]:
            self[word] = np.array(self._path(encoded), "<u4").tobytes()

    def _paths(self, words: list[bytes]) -> list[bytes]:
        """The packed tokens of words in order of length, all in step."""
        count, size = len(words), np.array([len(w) for w in words])
        width = int(size[-1])
        text = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(count, width)
        state = np.zeros((count, width + 1), np.int32)
        start, token = np.zeros((count, width + 1), np.int16), np.full((count, width + 1), -1, np.int32)
        for at in range(width):
            row = np.arange(np.searchsorted(size, at, "right"), count)
            node = np.zeros(len(row), np.int32)
            for to in range(at, width):
                after = self._base[node] + text[row, to] + 1
                alive = (self._check[after] == node) & (size[row] > to)
                row, node = row[alive], after[alive]
                if not len(row):
                    break
                found = self._value[node]
                whole = np.flatnonzero(found >= 0)
                whole = whole[self._automaton.has(state[row[whole], at], found[whole])]
                at_row, arc = row[whole], found[whole]
                token[at_row, to + 1], start[at_row, to + 1] = arc, at
                state[at_row, to + 1] = self._automaton.target[arc]
        tokens, place, column = np.full((count, width), -1, np.int32), size.copy(), width
        while place.any():
            column -= 1
            moving = np.flatnonzero(place)
            tokens[moving, column] = token[moving, place[moving]]
            place[moving] = start[moving, place[moving]]
        first = (width - (tokens >= 0).sum(axis=1)).tolist()
        packed = tokens.astype("<u4").tobytes()
        return [packed[4 * (i * width + f) : 4 * (i + 1) * width] for i, f in enumerate(first)]

    def _path(self, word: bytes) -> list[int]:
        """As :meth:`_paths` for one word of any length."""
        trie, automaton, end = self._vocabulary.trie, self._automaton, len(word)
        base, check, value = trie.base, trie.check, trie.value
        start, token = [0] * (end + 1), [-1] * (end + 1)
        for at in range(end):
            state = int(automaton.target[token[at]]) if at else 0
            node, to = 0, at
            while to < end:
                after = base[node] + word[to] + 1
                if check[after] != node:
                    break
                node, to = after, to + 1
                if value[node] >= 0 and automaton.has_one(state, value[node]):
                    token[to], start[to] = value[node], at
        path = []
        while end:
            path.append(token[end])
            end = start[end]
        return path[::-1]


def encode(
    docs: DataFrame, vocabulary: Vocabulary, text_column: str = "text", ids_column: str = "ids",
    packed: bool = False, keep_text: bool = True,
) -> DataFrame:
    """``docs`` with the ids of its texts in ``ids_column``, which replaces a column of that name.

    The ids are an array of int, or, ``packed``, binary: little-endian unsigned 32-bit numbers one after another. A
    null text has null ids, an empty one none. Strings of special tokens are those tokens. All other columns and
    rows stay as they are, the text itself if ``keep_text``. No rows give no rows.
    """
    docs = docs.select(*(f"`{c}`" for c in docs.columns if c != ids_column))
    kept = [f for f in docs.schema if keep_text or f.name != text_column]
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType(), False)
    schema = T.StructType([*kept, T.StructField(ids_column, kind)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = vocabulary.encoder
        for batch in (part for whole in batches for part, _, _ in slices(whole, text_column)):
            ids = encoder.packed(batch.column(text_column).to_pylist())
            ids = pa.array(ids, pa.binary()) if packed else _lists(ids)
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, ids], schema.names)

    return docs.mapInArrow(work, schema)


def _lists(packed: list[bytes | None]) -> pa.Array:
    sizes = np.array([0 if p is None else len(p) // 4 for p in packed], np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    offsets = pa.array(offsets, mask=np.array([*(p is None for p in packed), False]))
    return pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(p for p in packed if p), "<i4")))


def decode(
    encoded: DataFrame, vocabulary: Vocabulary, ids_column: str = "ids", text_column: str = "decoded"
) -> DataFrame:
    """``encoded`` with the texts of its ids in ``text_column``, which replaces a column of that name.

    Ids are given in either form of :func:`encode`; null ids give a null text, ids that name nothing stand for nothing.
    """
    encoded = encoded.select(*(f"`{c}`" for c in encoded.columns if c != text_column))
    schema = T.StructType([*encoded.schema, T.StructField(text_column, T.StringType())])

    def numbers(ids) -> list[int]:
        return np.frombuffer(ids, "<u4").tolist() if isinstance(ids, bytes) else ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(lo, ROWS_AT_ONCE) for whole in batches for lo in range(0, whole.num_rows, ROWS_AT_ONCE)):
            # one row's ids at a time are Python numbers
            texts = [None if x is None else vocabulary.decode(numbers(x)) for x in (v.as_py() for v in batch.column(ids_column))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.names)

    return encoded.mapInArrow(work, schema)
