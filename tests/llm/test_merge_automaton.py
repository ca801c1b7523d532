"""BPE by automaton against the library, against plain merging, and as a round trip."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from pricemart.llm import merge_automaton
from pricemart.llm.merge_automaton import Automaton, Vocabulary, decode, encode

ODD = [None, "", " ", "   \n\t\n  ", "a", "<|endoftext|>", "x <|endoftext|> y<|endoftext|>", "don't I'LL we've", "a" * 700,
       "=" * 300 + " " * 300, "ħéß’ñ œuvre", "中文字 日本", "𝒳 😀😀 ‍", "　 x", "\x00\x1c\x85\xa0 z", "1²½٣ 4"]


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(merge_automaton.VOCABULARY_FILE)


def merged(tokens, merges):
    """The tokens after every merge in order of rank, each from left to right."""
    for left, right, made in merges:
        out = []
        for token in tokens:
            if out and (out[-1], token) == (left, right):
                out[-1] = made
                token = None
            if token is not None:
                out.append(token)
        # a token made by this rule is no operand of it, so one sweep is enough
        tokens = out
    return tokens


def spelled(token, parts):
    return spelled(parts[token][0], parts) + spelled(parts[token][1], parts) if token in parts else [token]


@pytest.mark.parametrize("seed", range(12))
def test_random_merges_against_plain_merging(seed):
    """All sequences of tokens: those the automaton accepts are those that merging their letters gives back."""
    rng = random.Random(seed)
    merges, known = [], [0, 1, 2]
    while len(merges) < 14:
        pair = (rng.choice(known), rng.choice(known))
        if pair not in [m[:2] for m in merges]:
            merges.append((*pair, len(known)))
            known.append(len(known))
    automaton, parts = Automaton([0, 1, 2], merges), {m: (a, b) for a, b, m in merges}
    for _ in range(600):
        tokens = [rng.choice(known) for _ in range(rng.randrange(1, 5))]
        letters = [x for t in tokens for x in spelled(t, parts)]
        state, accepted = 0, True
        for token in tokens:
            accepted &= automaton.has_one(state, token)
            assert bool(automaton.has(np.array([state]), np.array([token]))[0]) == automaton.has_one(state, token)
            state = int(automaton.target[token])
        assert accepted == (merged(letters, merges) == tokens)


def test_a_merge_of_unknown_tokens_is_an_error():
    for merges in ([(0, 2, 3)], [(0, 1, 2), (1, 0, 2)]):
        with pytest.raises(ValueError):
            Automaton([0, 1], merges)


def test_encoding_equals_the_library(vocabulary, library, spark, tables):
    rng = random.Random(3)
    texts = [t for t in ODD if t is not None]
    for alphabet in ("ab", "a ", "etaoin shr", "0123456789 .,-=_*#", "éèàüñçß aeno", " \n\t\r\x0b", "l'strevmd ", "中文 a"):
        texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    texts += ["".join(chr(rng.randrange(32, 0x52F)) for _ in range(50)) for _ in range(60)]
    texts += [r["text"] or "" for r in spark.read.parquet(f"{tables}/documents.parquet").select("text").collect()]
    packed = vocabulary.encoder.packed(texts)
    for text, ids, expected in zip(texts, packed, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == expected.ids, text[:50]
        assert vocabulary.decode(expected.ids) == library.decode(expected.ids, skip_special_tokens=False)


def test_characters_are_split_as_by_the_library(vocabulary):
    split = pre_tokenizers.ByteLevel(add_prefix_space=False).pre_tokenize_str
    everything = [c for r in merge_automaton._SETTLED for c in r]
    for c in map(chr, everything):
        text = f"a{c}1{c}!{c}{c}a {c} "
        assert vocabulary.encoder._words.findall(text) == [text[a:b] for _, (a, b) in split(text)], hex(ord(c))


def test_words_in_step_equal_single_ones(vocabulary):
    words = sorted((w.encode() for w in (" the", "internationalisation", "ààà", "zzzzzz", "\n\n\n", " 2024", "q" * 60)), key=len)
    step = vocabulary.encoder._paths(words)
    assert [np.frombuffer(x, "<u4").tolist() for x in step] == [vocabulary.encoder._path(w) for w in words]


def test_forgotten_words_are_found_again(vocabulary, monkeypatch):
    monkeypatch.setattr(merge_automaton, "REMEMBERED", 2)
    monkeypatch.setattr(merge_automaton, "GROUP_CHARS", 5)
    text = "one two three one two three <|endoftext|> one"
    assert vocabulary.decode(vocabulary.encode(text)) == text


@pytest.mark.parametrize("packed", [False, True])
def test_round_trip(documents, vocabulary, packed):
    docs = documents(*ODD, "a b", "a b", extra=("ids", "decoded"))
    both = decode(encode(docs, vocabulary, packed=packed), vocabulary)
    assert sorted(both.columns) == sorted(docs.columns)
    rows = both.collect()
    assert len(rows) == len(ODD) + 2
    assert all(r["decoded"] == r["text"] and (r["ids"] is None) == (r["text"] is None) for r in rows)
    assert [len(r["ids"]) for r in rows if r["text"] == ""] == [0]


def test_text_can_be_left_out_and_nothing_gives_nothing(documents, vocabulary):
    docs = documents("a b c", "d")
    lean = encode(docs, vocabulary, packed=True, keep_text=False)
    assert lean.columns == ["doc_id", "lang", "source", "n_chars", "ids"]
    assert sorted(r["decoded"] for r in decode(lean, vocabulary).collect()) == ["a b c", "d"]
    assert encode(docs.where("false"), vocabulary).count() == 0


def test_very_long_text_and_ids_that_name_nothing(documents, vocabulary):
    text = "lorem ipsum é " * 200_000 + "x" * 20_000
    row = decode(encode(documents(text), vocabulary), vocabulary).where(F.col("decoded") == F.col("text"))
    assert row.count() == 1
    assert vocabulary.decode([64, 10**6, 65]) == vocabulary.decode([64, 65])
    assert vocabulary.decode([vocabulary.encode("é")[0] if len(vocabulary.encode("é")) > 1 else 160]) == "�"
