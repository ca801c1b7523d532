"""Many words looked for in one reading of a text: an Aho-Corasick automaton as one table.

The words make a trie. Where no child fits, the longest suffix of what was read that is in the trie takes over; these
failure steps are worked into the table, so every character is one look-up. A state knows the first of the words,
in their given order, that end there. Texts are cut into lanes that overlap by the longest word less one character, and
all lanes go through the table in step.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

#: Cells of the table of one automaton: states times letters.
TABLE_CELLS = 8_000_000
LANE = 256
LANES_AT_ONCE = 4096


def parts(words: Sequence[str], cells: int = TABLE_CELLS) -> list[list[int]]:
    """The places of the words in groups whose automata have ``cells`` cells at most, by first characters.

    A single word with a larger table has a group of its own.
    """
    out: list[list[int]] = []
    letters: set[str] = set()
    size = 1
    for n in sorted(range(len(words)), key=words.__getitem__):
        more, longer = letters.union(words[n]), size + len(words[n])
        if not out or longer * (len(more) + 1) > cells:
            out.append([])
            more, longer = set(words[n]), 1 + len(words[n])
        out[-1].append(n)
        letters, size = more, longer
    return out


class Automaton:
    """``words``, none empty, in the order in which the first is preferred; of equal words the first counts."""

    def __init__(self, words: Sequence[str]):
        letters = sorted({c for w in words for c in w})
        self.codes = np.array([ord(c) for c in letters], np.uint32)
        self.longest = max(map(len, words), default=1)
        code = {c: n + 1 for n, c in enumerate(letters)}  # 0 is any other character
        children: list[dict[int, int]] = [{}]
        first = [len(words)]
        for n, word in enumerate(words):
            state = 0
            for c in word:
                after = children[state].get(code[c])
                if after is None:
                    after = children[state][code[c]] = len(children)
                    children.append({})
                    first.append(len(words))
                state = after
            first[state] = min(first[state], n)
        self.next = np.zeros((len(children), len(letters) + 1), np.int32)
        fail, level = [0] * len(children), [0]
        while level:
            below = []
            for state in level:
                # the row of the failure state is complete, as it is nearer to the root
                row = self.next[fail[state]].copy() if state else self.next[0].copy()
                for c, child in children[state].items():
                    fail[child] = int(row[c]) if state else 0
                    row[c] = child
                    below.append(child)
                self.next[state] = row
                first[state] = min(first[state], first[fail[state]])
            level = below
        self.first, self.none = np.array(first, np.int64), len(words)

    def first_words(self, texts: Sequence[str | None]) -> np.ndarray:
        """The place of the first word that occurs in each text; the number of words where none does."""
        best = np.full(len(texts), self.none, np.int64)
        whole = [t or "" for t in texts]
        code = np.frombuffer("".join(whole).encode("utf-32-le", "surrogatepass"), np.uint32)
        at = np.minimum(np.searchsorted(self.codes, code), max(0, len(self.codes) - 1))
        known = self.codes[at] == code if len(self.codes) else np.zeros(len(code), bool)
        code = np.where(known, at + 1, 0)
        end = np.cumsum([len(t) for t in whole]).astype(np.int64)
        step = max(LANE, self.longest)
        lanes = [(a, min(a + step + self.longest - 1, int(e)), n)
                 for n, (e, t) in enumerate(zip(end, whole)) for a in range(int(e) - len(t), int(e), step)]
        for lo in range(0, len(lanes), LANES_AT_ONCE):
            self._read(code, np.array(lanes[lo : lo + LANES_AT_ONCE], np.int64), best)
        return best

    def _read(self, code: np.ndarray, lanes: np.ndarray, best: np.ndarray) -> None:
        lanes = lanes[np.argsort(lanes[:, 0] - lanes[:, 1], kind="stable")]  # longest first
        start, length, text = lanes[:, 0], lanes[:, 1] - lanes[:, 0], lanes[:, 2]
        state, found = np.zeros(len(lanes), np.int64), np.full(len(lanes), self.none, np.int64)
        for n in range(int(length[0])):
            live = int(np.searchsorted(-length, -n, "left"))
            state[:live] = self.next[state[:live], code[start[:live] + n]]
            found[:live] = np.minimum(found[:live], self.first[state[:live]])
        np.minimum.at(best, text, found)
