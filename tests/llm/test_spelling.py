"""Spelling groups against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from pricemart.llm.spelling import spelling_groups, words


def brute_words(rows, every=0, length=6, count=5):
    out = Counter()
    for id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if id is None else id}:{word}".encode())
            if every and h % every == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            out[word] += 1
    return {w: n for w, n in out.items() if len(w) >= length and n >= count}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_groups(counts, ratio=5):
    out, form = {}, {}
    for word in counts:
        others = [w for w in counts if near(word, w)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best and counts[best] >= ratio * counts[word] else None
        out[word] = len(others)
    for word, n_near in out.items():
        root = word
        while form[root]:
            root = form[root]
        out[word] = (form[word], root, counts[word], n_near, counts.get(form[word]))
    return out


def found(frame):
    rows = frame.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@pytest.mark.parametrize("every", [0, 3])
def test_words_against_brute_force(documents, every):
    rows = [(n, "Kitten KITTEN kittenÉ sitting, sitting_mitten Āsitten " * (n % 3 + 1)) for n in range(12)]
    rows += [(None, "kitten sitting"), (5, None), (6, ""), (5, rows[5][1]), (20, "short of it"), (21, "naïve×naïve " * 9)]
    docs = documents(*({"doc_id": i, "text": t} for i, t in rows), extra=("word", "n", "id"))
    got = {r["word"]: r["n"] for r in words(docs, spoil_every=every, held_words=3).collect()}
    assert got == brute_words(rows, every)


@pytest.mark.parametrize("filter_bytes", [8, 400, 8_000_000])
def test_groups_against_brute_force(spark, filter_bytes):
    rng = random.Random(filter_bytes)
    counts = {}
    for _ in range(150):
        word = "".join(rng.choice("abcé") for _ in range(rng.randrange(1, 7)))
        counts[word] = rng.choice([5, 6, 30, 30, 151, 760, 4000])
    counts |= {"x" * 70: 5, "x" * 71: 25, "x" * 69 + "y": 30, "ÿ" * 64: 5, "ÿ" * 65: 200, "alone": 7}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    assert found(spelling_groups(frame, filter_bytes=filter_bytes)) == brute_groups(counts)


def test_chains_are_followed_to_the_end(spark):
    letters = "abcdefgh"
    counts = {"word" + letters[:n]: 5 ** (n + 1) for n in range(1, 9)}
    got = found(spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert {r[1] for r in got.values()} == {"word" + letters} and got == brute_groups(counts)


def test_a_word_with_all_its_edits(spark):
    """A third of all words point to one."""
    counts = {"centre": 10**6} | {"centre"[:i] + c + "centre"[i + 1 :]: 5 for i in range(6) for c in "qwyuiopasdfghjklzxvbm"}
    counts |= {f"other{n:03d}".translate(str.maketrans("0123456789", "abcdefghij")): 9 for n in range(200)}
    assert found(spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long"))) == brute_groups(counts)


def test_very_long_words_and_nothing(documents, spark):
    long = "ab" * 30_000
    docs = documents(*[long + " " + long[:-1]] * 6)
    got = found(spelling_groups(words(docs)))
    assert got == {long: (None, long, 6, 1, None), long[:-1]: (None, long[:-1], 6, 1, None)}
    assert spelling_groups(words(documents(None, ""))).count() == 0
    assert words(docs.where("false")).count() == 0
