"""Mixing, search, chats, classifiers and pieces against brute force, round trips and held-out accuracy."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricemart.llm import chat_format, language_id, pieces, quality, source_mix, topk_search

ODD = [None, "", "   \n\t", "a", "é ü"]


# mixing ------------------------------------------------------------------------------------------------------


def brute_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, rest = {}, set(names), float(sum(sizes.values()))
    while free:
        unit = rest / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * unit > most * sizes[s]}
        if not full:
            return {**target, **{s: weight[s] * unit for s in free}}
        for s in full:
            target[s] = float(most * sizes[s])
            rest -= target[s]
        free -= full
    return target


def test_mixture(documents):
    rng = random.Random(4)
    rows = []
    for source, n in (("src1", 60), ("Src2", 3), ("a", 20), (None, 9), ("é", 5), ("empty", 2)):
        for _ in range(n):
            words = 0 if source == "empty" else rng.randrange(40)
            rows.append({"doc_id": len(rows), "text": " ".join(["w"] * words) or rng.choice([None, "", " "]), "source": source})
    rows += [dict(rows[0]), {"doc_id": None, "text": "x y", "source": "a"}]
    got = source_mix.mixture(documents(*rows, extra=("row", "size", "target", "place", "words", "order"))).collect()
    sizes = {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + len((r["text"] or "").split())
    want = brute_targets(sizes)
    source_of = {r["doc_id"]: r["source"] for r in rows}
    taken = {}
    for r in got:
        source = source_of[r["doc_id"]]
        assert r["source_size"] == sizes[source] and math.isclose(r["target"], want[source], abs_tol=1e-9)
        assert r["taken"] <= 3 * r["size"] and r["taken"] == sum(d["words"] for d in r["draws"])
        assert all(0 <= d["time"] <= 1 for d in r["draws"])
        taken[source] = taken.get(source, 0) + r["taken"]
    assert len(got) == len(rows) and taken == {s: round(t) for s, t in want.items()}


@pytest.mark.parametrize("schedule", source_mix.SCHEDULES)
def test_time_inverts_the_integral_of_the_schedule(spark, schedule):
    times, weights = zip(*schedule)
    grid = np.linspace(0, 1, 20_001)
    density = np.interp(grid, times, weights)
    demand = np.concatenate([[0], np.cumsum((density[1:] + density[:-1]) / 2)])
    shares = [0.0, 0.1, 0.25, 0.5, 0.77, 0.999]
    frame = spark.createDataFrame([(s,) for s in shares], "demand double")
    got = [r[0] for r in frame.select(F.expr(source_mix.time_of("demand", schedule))).collect()]
    assert np.allclose(got, np.interp(shares, demand / demand[-1], grid), atol=1e-4)


def test_training_order_and_whole_documents(documents):
    docs = documents(*({"doc_id": i, "text": "w " * (i % 7 + 1), "source": f"s{i % 3}"} for i in range(90)))
    mixed = source_mix.mixed(docs)
    assert mixed.columns == docs.columns
    again = sorted(r["doc_id"] for r in mixed.collect())
    assert again == sorted(r["doc_id"] for r in source_mix.mixed(docs).collect())
    words = {}
    for i in again:
        words[i % 3] = words.get(i % 3, 0) + i % 7 + 1
    want = brute_targets({f"s{k}": sum(i % 7 + 1 for i in range(k, 90, 3)) for k in range(3)})
    assert all(abs(words[k] - want[f"s{k}"]) <= 7 for k in range(3))
    times = source_mix.training_order(source_mix.mixture(docs).select("row", F.expr("get(draws, 0).time").alias("time")))
    parts = times.select("time", F.spark_partition_id().alias("p")).where("time IS NOT NULL").collect()
    assert [r["time"] for r in sorted(parts, key=lambda r: (r["p"], r["time"]))] == sorted(r["time"] for r in parts)
    assert source_mix.mixed(docs.where("false")).count() == 0


def test_half_of_the_rows_have_one_id(documents, monkeypatch):
    """Rows of one id fill many buckets; the running sums are those of one window over the source."""
    rows = [{"doc_id": 7 if n % 2 else n, "text": "w " * (1 + n % 5), "source": f"s{n % 3 % 2}"} for n in range(400)]
    rows += [{"doc_id": None, "text": "a b", "source": "s0"}] * 90
    docs = documents(*rows)
    plain = [(r["doc_id"], r["size"], r["target"], r["taken"], r["draws"]) for r in source_mix.mixture(docs).collect()]
    monkeypatch.setattr(source_mix, "ROWS_PER_BUCKET", 4)
    monkeypatch.setattr(source_mix, "ROW_PART_BITS", 3)
    cut = source_mix.mixture(docs).collect()
    assert sorted(map(str, plain)) == sorted(str((r["doc_id"], r["size"], r["target"], r["taken"], r["draws"])) for r in cut)
    # as many words are taken as the targets say
    targets = {r["source_size"]: r["target"] for r in cut}
    assert abs(sum(r["taken"] for r in cut) - sum(targets.values())) < len(targets)


def test_draws_of_files_that_are_packed_anew(many_files, repacked):
    draws = source_mix.mixture(many_files).selectExpr("doc_id", "size(filter(draws, d -> 2 * d.words >= size)) AS n")
    expected = {r["doc_id"]: r["n"] for r in draws.where("n > 0").collect()}
    repacked(source_mix)
    assert Counter(r["doc_id"] for r in source_mix.mixed(many_files).collect()) == expected


# search ------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("shard_rows,block", [(65_536, 4096), (64, 16)])
def test_top_k_against_brute_force(spark, tmp_path, monkeypatch, shard_rows, block):
    monkeypatch.setattr(topk_search, "_BLOCK_ROWS", block)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 8).tolist()) for i in range(300)]
    rows += [(300 + i, rows[100][1]) for i in range(20)]
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (404, []), (405, [0.5, 0.5]),
             (None, rows[5][1]), (100, rows[100][1]), (406, [2e5, -1.0]), (500, [200000.0, 1.0, 3e5]), (407, [-1e6, 0.1, 7e5, 0.3])]
    path = str(tmp_path / "vectors")
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "2 AS row", "3 AS parts").write.parquet(path)
    got = topk_search.top_k(spark.read.parquet(path), F.col("vec_id") % 100 == 0, shard_rows=shard_rows).collect()

    valid = [(v, [math.floor(1024 * x) for x in e]) for v, e in rows
             if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    want = []
    for n, (q, a) in enumerate(valid):
        if q is not None and q % 100 == 0:
            # vectors are compared as if the shorter ended in zeros
            scores = [(-sum(x * y for x, y in zip(a, b)), v is None, v or 0) for m, (v, b) in enumerate(valid) if m != n]
            want += [(q, r + 1, None if s[1] else s[2], -s[0]) for r, s in enumerate(sorted(scores)[:10])]
    key = lambda r: (r[0], r[1], str(r[2]), r[3])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_top_k_of_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk_search.top_k(few, F.col("vec_id") == 0).collect()] == [(0, 1, 1, 1024 * 2048)]
    assert topk_search.top_k(few.where("false"), F.lit(True)).count() == 0


def test_scores_that_fit_no_long(spark):
    rows = [(0, [1e12, 1.0]), (1, [1e12, 2.0]), (2, [-1e12, 3.0]), (3, [1.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        topk_search.top_k(frame, F.col("vec_id") == 0, k=3).collect()
    # beyond the k best they do no harm: -2 ** 100 and less is last
    frame = frame.where("vec_id <> 1")
    assert [r["vec_id"] for r in topk_search.top_k(frame, F.col("vec_id") == 0, k=1).collect()] == [3]


def test_max_score_skips_terms():
    rng = np.random.default_rng(1)
    columns, query = rng.integers(-300, 300, (64, 500)), rng.integers(-300, 300, 64)
    exact = query @ columns
    for threshold in (None, int(np.sort(exact)[-5]), int(exact.max()) + 1):
        place, score = topk_search._max_score(columns, columns.min(axis=1), columns.max(axis=1), query, threshold)
        want = np.arange(500) if threshold is None else np.flatnonzero(exact >= threshold)
        assert sorted(place) == want.tolist() and (score == exact[place]).all()


# chats -------------------------------------------------------------------------------------------------------


def test_chats_are_read_back(spark):
    tricky = ["", None, "</s>[INST] ok [/INST]", "\\", "\\0\\1\\2", "<sys>", "a\nb", "[<\\<[", "é  ", " x "]
    rng = random.Random(8)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", None, "", "<turn>", "a[b]</turn>c"]), rng.choice(tricky))
            for c in range(30) for t in range(rng.randrange(1, 7))]
    rows += [(99, 0, "system", "s"), (99, 1, "user", "u"), (99, 2, "assistant", "A"), (99, 3, "user", "v"), (99, 4, "assistant", "B"),
             (98, 5, "user", "x"), (98, 5, "user", "x"), (97, 1, "assistant", "y"), (97, None, "user", "last"), (None, 0, "user", "n")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS turns", "2 AS segments")
    chats = chat_format.format_chats(frame)
    got = {r["conv_id"]: r for r in chats.select(
        "*", chat_format.read_turns(F.col("formatted")).alias("turns"), chat_format.read_loss(F.col("segments")).alias("loss")).collect()}
    by_chat = {}
    for c, t, role, text in rows:
        by_chat.setdefault(c, []).append((t is None, t or 0, role or "", text or ""))
    assert set(got) == set(by_chat)
    for c, turns in by_chat.items():
        want = [(role, text) for _, _, role, text in sorted(turns)]
        assert [(t["role"], t["text"]) for t in got[c]["turns"]] == want and got[c]["n_turns"] == len(want)
        assert got[c]["loss"] == "".join(text for role, text in want if role == "assistant")
        assert got[c]["formatted"] == "".join(s["text"] for s in got[c]["segments"])
    assert got[99]["valid"] and got[99]["formatted"] == (
        "<s><sys>s</sys>\n[INST] u [/INST]\n<out>A</s>\n[INST] v [/INST]\n<out>B</s>\n")
    assert (got[98]["valid"], got[98]["first_bad_turn"]) == (False, 1) and got[97]["first_bad_turn"] == 0
    assert chat_format.format_chats(frame.where("false")).count() == 0


def test_very_long_chat_text(spark):
    frame = spark.createDataFrame([(1, 0, "user", "[x " * 200_000)], "conv_id long, turn long, role string, text string")
    turn = chat_format.format_chats(frame).select(chat_format.read_turns(F.col("formatted")).alias("t")).first()["t"][0]
    assert turn["text"] == "[x " * 200_000


def test_templates_need_marks_of_their_own():
    with pytest.raises(ValueError):
        chat_format.Template(roles={"user": chat_format.Turn("USER ", "\n", False, ())})


# quality -----------------------------------------------------------------------------------------------------


def test_quality_on_held_out_documents(spark, tables):
    docs, labels = (spark.read.parquet(f"{tables}/{t}.parquet") for t in ("documents", "labels"))
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    model = quality.fit(quality.labelled_sample(docs, labels, fold != 1))
    scored = quality.score(docs, model).join(labels, "doc_id").where(fold == 1).collect()
    good = [r["score"] for r in scored if r["quality"] == 1]
    bad = [r["score"] for r in scored if r["quality"] == 0]
    assert good and bad and np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r["score"] >= 0.5 for r in scored if r["quality"] == 1]) > 0.97


def test_quality_of_odd_texts(documents, spark):
    docs = documents(*ODD, "THE!! BAD!! WORDS!!", "x" * 300_000, extra=("score", "scored_row", "whole"))
    sample = [("the good words are here.", 1), ("THE!! BAD!! WORDS!!", 0)] * 20
    model = quality.fit(sample)
    scores = {r["doc_id"]: r["score"] for r in quality.score(docs, model).collect()}
    assert len(scores) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    assert scores[0] == scores[1] == scores[2] and scores[len(ODD)] < 0.5
    kept = quality.accepted(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in scores.items() if s >= 0.5}
    assert quality.score(docs.where("false"), model).count() == 0
    for few in ([], [("one", 1)]):
        assert all(0 <= r["score"] <= 1 for r in quality.score(docs, quality.fit(few)).collect())


def test_a_pooled_document_is_the_mean_of_its_words():
    model = quality.fit([("the cat sat", 1), ("A DOG!!", 0)] * 3)
    text = "the DOG sat on unknown!!".encode()
    row, name, backoff = quality.tokens(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    vectors = model.vectors[quality.places(model.names, name, backoff)]
    assert len(row) == 6 and np.allclose(model.pooled(np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0], vectors.mean(axis=0))


# language ----------------------------------------------------------------------------------------------------


def test_languages_on_held_out_documents(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    samples = language_id.learn(docs, fold != 0)
    assert max(map(len, samples.values())) <= language_id.SAMPLE_DOCS * (4 * language_id.SAMPLE_BYTES + 1)
    found = language_id.predict(docs, samples).join(docs, "doc_id").where(fold == 0).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in found]) > 0.97


def test_cross_parsing_against_brute_force():
    rng = random.Random(2)
    samples = {k: "".join(rng.choice(k + " ") for _ in range(400)).encode() for k in ("abcd", "cdef")}
    parser = language_id.Parser(samples)
    texts = ["".join(rng.choice("abcdefz ") for _ in range(n)) for n in (1, 30, 511, 512, 513, 1500)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for text, bits in zip(texts, parser.entropies(data, bounds)):
        for language, got in zip(parser.languages, bits):
            phrases, sample = 0, samples[language].decode()
            for lo in range(0, len(text), language_id.SEGMENT):
                part, at = text[lo : lo + language_id.SEGMENT], 0
                while at < len(part):
                    size = 1
                    while at + size < len(part) and part[at : at + size + 1] in sample:
                        size += 1
                    phrases, at = phrases + 1, at + size
            assert math.isclose(got, phrases * math.log2(len(sample)) / len(text))


def test_suffix_automaton_knows_every_substring():
    text = b"abracadabra alakazam"
    automaton = language_id.SuffixAutomaton(text)

    def knows(part):
        state = 0
        for byte in part:
            state = automaton.to[state].get(byte)
            if state is None:
                return False
        return True

    assert all(knows(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1))
    assert not knows(b"abc") and not knows(b"zz")


def test_copies_and_texts_without_letters_take_one_place_or_none(documents):
    texts = [" ".join(chr(97 + n) * (2 + k) for k in range(5)) for n in range(10)]
    rows = [{"text": t, "lang": "xx"} for t in texts for _ in range(language_id.SAMPLE_DOCS)]
    rows += [{"text": f"{n} - {n}!", "lang": "xx"} for n in range(200)]
    sample = language_id.learn(documents(*rows, {"text": "12 34", "lang": "yy"}), F.lit(True))
    assert list(sample) == ["xx"] and len(sample["xx"]) == sum(map(len, texts)) + 9
    assert all(t.encode() in sample["xx"] for t in texts)


def test_languages_of_odd_texts(documents):
    docs = documents(*ODD, "123 !! 45", "漢字", "der die das " * 30_000, extra=("score", "lang_pred", "row"))
    samples = {"de": b"der die das und ist nicht", "en": b"the and of to is that a"}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.predict(docs, samples).collect()}
    assert [got[i][0] for i in (0, 1, 2, 5)] == ["und"] * 4 and got[7][0] == "de"
    assert got[3][0] == "en" and got[6][0] in ("de", "en") and all(0 <= s <= 1 for _, s in got.values())
    assert {r["lang_pred"] for r in language_id.predict(docs, {}).collect()} == {"und"}
    assert language_id.learn(docs, F.lit(True)) == {} and language_id.predict(docs.where("false"), samples).count() == 0


# pieces ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary()


def test_best_paths_equal_those_of_the_library(vocabulary, spark, tables):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(pieces.MODEL_FILE, "rb") as file:
        model.ParseFromString(file.read())
    model.trainer_spec.model_type = 1  # the same pieces and scores, read as a unigram model
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    words = {w for r in spark.read.parquet(f"{tables}/documents.parquet").select("text").limit(40).collect() for w in r["text"].split()}
    for word in sorted(words)[:1500] + ["über漢字🎉", "naïve"]:
        assert vocabulary.encode(word) == library.nbest_encode_as_ids(word, 2)[0], word


def test_the_best_path_has_the_highest_score(vocabulary):
    pieces_of = {vocabulary.bytes_of[i]: vocabulary.scores[i] for i in range(259, len(vocabulary.bytes_of))}

    def best(word):
        table = [0.0] + [None] * len(word)
        for to in range(1, len(word) + 1):
            table[to] = max((table[at] + pieces_of[word[at:to]] for at in range(to) if table[at] is not None and word[at:to] in pieces_of), default=None)
        return table[-1]

    for word in ("hello", "tionring", "unbelievable", "xqzt", "a,b.c"):
        assert math.isclose(sum(vocabulary.scores[i] for i in vocabulary.encode(word)), best(b" " + word.encode()))


def test_round_trip(documents, vocabulary):
    texts = [*ODD, "  two  spaces ", "▁", " ▁▁a\n\t漢字🎉 \x00", "x" * 100_000, "a\r\nb", "the The THE"]
    docs = documents(*texts, extra=("ids", "decoded"))
    encoded = pieces.encode(docs, vocabulary)
    assert encoded.columns == [*docs.columns[:5], "decoded", "ids"]
    got = {r["doc_id"]: r for r in pieces.decode(encoded, vocabulary).collect()}
    assert [got[i]["decoded"] for i in range(len(texts))] == texts
    assert got[0]["ids"] is None and got[1]["ids"] == []
    assert pieces.encode(docs.where("false"), vocabulary).count() == 0


def test_forgotten_words_are_found_again(vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    monkeypatch.setattr(pieces, "GROUP_CHARS", 10)
    fresh = pieces.Encoder(vocabulary)
    texts = ["one two three", "four five one", None, "two three", "", "\u2581x"] * 3
    assert fresh.packed(texts) == [None if t is None else vocabulary.encoder.packed([t])[0] for t in texts]
    assert len(fresh) <= 3 + 4


def test_paths_in_step_equal_single_ones(vocabulary):
    rng = random.Random(6)
    words = {"".join(rng.choice("abcdeéüß漢🎉.,!▁ \x00") for _ in range(rng.randrange(1, 30))) for _ in range(800)}
    encoder = pieces.Encoder(vocabulary)
    encoder._find([[w.replace(" ", "x") for w in words]])
    for word in words:
        word = word.replace(" ", "x")
        assert np.frombuffer(encoder[word], "<i4").tolist() == encoder._best_path(word.encode())


def test_double_array_holds_its_keys_only():
    rng = random.Random(1)
    keys = sorted({bytes(rng.randrange(256) for _ in range(rng.randrange(1, 6))) for _ in range(3000)})
    trie = pieces.DoubleArray(keys, list(range(len(keys))))

    def find(key):
        state = 0
        for byte in key:
            after = trie.base[state] + byte + 1
            if trie.check[after] != state:
                return -1
            state = after
        return trie.value[state]

    assert [find(k) for k in keys] == list(range(len(keys)))
    missing = [k + b"\x01" for k in keys[:500] if k + b"\x01" not in set(keys)]
    assert all(find(k) == -1 for k in missing)
