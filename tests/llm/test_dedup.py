"""Exact, line, near and substring dedup against brute force, and their odd inputs."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pricemart.llm import common, exact_dedup, near_dedup
from pricemart.llm.common import components, numbered, one_batch
from pricemart.llm.exact_dedup import exact_groups, keep_first
from pricemart.llm.line_dedup import Bloom, line_dedup, repeated_lines
from pricemart.llm.near_dedup import keep_one_of_each, near_groups
from brute import brute_near
from pricemart.llm.substring_dedup import pack, repeated_passages, substring_dedup, unpack

CLASHING = ("row", "key", "kept", "name", "pos", "label", "text_sha256", "node", "whole", "copies")
ODD = [None, "", "   \n\t", "a", "a", "é ü", "a b c d e f"]


def words_of(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(words, places):
    return [f"new{i}" if i in places else w for i, w in enumerate(words)]


# exact -------------------------------------------------------------------------------------------------------


def test_exact_groups_of_many_blocks(documents):
    rng = random.Random(5)
    base = ["".join(rng.choice("abc é") for _ in range(n)) for n in (1, 15, 16, 17, 64, 65, 300)]
    texts = base + [" ".join(t) for t in base] + [t[:-1] + "z" for t in base if len(t) > 1] + ODD
    got = {r["doc_id"]: r for r in exact_groups(documents(*texts, extra=CLASHING), block_chars=16).collect()}
    plain = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for t in texts]
    assert len(got) == len(texts)
    for i, p in enumerate(plain):
        same = [j for j, q in enumerate(plain) if q == p]
        keep = min(same, key=lambda j: (-len(texts[j] or ""), j))
        row = got[i]
        assert (row["keep_id"], row["group_size"], row["kept"]) == (keep, len(same), keep == i)
        assert row["text_sha256"] == hashlib.sha256(p.encode()).hexdigest()


def test_exact_groups_of_repeated_rows_and_null_ids(documents):
    docs = documents({"doc_id": 4, "text": "x"}, {"doc_id": 4, "text": "x"}, {"doc_id": None, "text": "x"}, {"doc_id": 3, "text": "y"})
    rows = exact_groups(docs).collect()
    assert sorted((str(r["doc_id"]), r["keep_id"], r["kept"]) for r in rows if r["group_size"] == 3) == [
        ("4", 4, False), ("4", 4, True), ("None", 4, False)]
    assert keep_first(docs).columns == docs.columns and keep_first(docs).count() == 2


def test_exact_copies_go_without_moving_texts_of_kept_rows(documents):
    """Kept rows are picked by marks: no shuffle takes whole rows."""
    kept = keep_first(documents("a b", "ab", "a  b", "c", None, ""))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in next(x for x in plan.split("\n") if "LeftSemi" in x)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4]


def test_named_blocks_are_computed_once(documents, monkeypatch):
    """A checkpoint would join texts with their names twice: to count rows and to write them."""
    calls = []
    save, store = exact_dedup.saved, common.stored
    monkeypatch.setattr(exact_dedup, "saved", lambda df: calls.append(("saved", "sha" in df.columns)) or save(df))
    monkeypatch.setattr(exact_dedup, "stored", lambda df, name: calls.append(("stored", "sha" in df.columns)) or store(df, name),
                        raising=False)
    exact_groups(documents("a" * 70, "b"), block_chars=16)
    assert calls == [("stored", True)] + [("saved", False)] * 3


def test_normalised_texts_are_as_a_regular_expression_has_them(spark, documents):
    """Every kind of white space, bytes that are no UTF-8, and texts of just one block and of more."""
    raw = [b"a b", b"\x20\x09\x0a\x0b\x0c\x0d", "é\u00a0\u2003\x1c\x85 z".encode(), b"\xff \xe4\xb8 \xf0\x9f\x98\x80\xed\xa0\x80 \xc0\x80", b""]
    texts = spark.createDataFrame([(n, bytearray(b)) for n, b in enumerate(raw)], "n long, raw binary").selectExpr(
        "n", "CAST(raw AS STRING) AS text")
    plain = texts.select("n", exact_dedup.normalised("text").alias("plain"), F.regexp_replace("text", r"[\x20\x09-\x0D]", "").alias("want"))
    assert [r["n"] for r in plain.select("n", (F.hex("plain") == F.hex("want")).alias("same")).collect() if not r["same"]] == []
    rows = {r["doc_id"]: r for r in exact_groups(documents("ab" * 8, "a b" * 8, "ab" * 8 + "c"), block_chars=16).collect()}
    assert [(rows[n]["n_blocks"], rows[n]["keep_id"]) for n in range(3)] == [(1, 1), (1, 1), (2, 2)]


def test_exact_groups_of_nothing(documents):
    assert exact_groups(documents("a").where("false")).count() == 0


# lines -------------------------------------------------------------------------------------------------------


def brute_lines(texts, min_docs):
    key = lambda line: line.encode().strip().lower()
    split = [(t or "").split("\n") for t in texts]
    counts = {}
    for lines in split:
        for k in {key(x) for x in lines if key(x)}:
            counts[k] = counts.get(k, 0) + 1
    gone = {k for k, n in counts.items() if n >= min_docs}
    return [(len(x), sum(key(y) in gone for y in x), "\n".join(y for y in x if key(y) not in gone)) for x in split]


def test_lines_against_brute_force(documents):
    rng = random.Random(3)
    pool = [f"line {i}" for i in range(30)] + ["  Common  Line\t", "common  line", "É", "é", "", "\r"]
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(12))) for _ in range(60)] + ODD
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept"])
           for r in line_dedup(documents(*texts, extra=("line", "hash", "first_id", *CLASHING)), min_docs=4).collect()}
    assert [got[i] for i in range(len(texts))] == brute_lines(texts, 4)


def test_first_occurrence_is_kept_on_demand(documents):
    docs = documents("same\nown 0\nsame", "own 1\nSAME ", "same")
    got = {r["doc_id"]: r["kept"] for r in line_dedup(docs, min_docs=3, keep_first=True).collect()}
    assert got == {0: "same\nown 0", 1: "own 1", 2: ""}


def test_equal_texts_count_as_documents_each(documents):
    got = line_dedup(documents(*["one line"] * 10, "one line\nmore"), min_docs=11).collect()
    assert sorted(r["kept"] for r in got) == [""] * 10 + ["more"]
    assert repeated_lines(documents("a\na\na"), min_docs=2)[2].count() == 0


def test_lines_of_nothing(documents):
    assert line_dedup(documents("a").where("false")).count() == 0


def test_bloom_filter_has_no_false_negatives():
    hashes = np.random.default_rng(1).integers(0, 2**63, 5000).astype(np.uint64)
    bloom = Bloom(5000)
    bloom.add(hashes[:2500])
    assert bloom.has(hashes[:2500]).all() and bloom.has(hashes[2500:]).mean() < 0.01


# near --------------------------------------------------------------------------------------------------------


def near_texts():
    base = words_of(200, 1)
    rng = random.Random(2)
    family = [" ".join(edited(base, set(rng.sample(range(200), k)))) for k in range(0, 16) for _ in range(6)]
    chain, link = [], words_of(100, 9)
    for i in range(12):
        link = edited(link, {i * 7, i * 7 + 1})
        chain.append(" ".join(link))
    alone = [" ".join(words_of(80, 100 + i)) for i in range(20)]
    return family + chain + alone + [family[0].upper(), family[3]] + ODD + ["", "A", "a b", "A  B"]


@pytest.mark.parametrize("size,percent,block", [(3, 85, 512), (5, 80, 512), (3, 85, 16)])
def test_near_groups_against_brute_force(documents, monkeypatch, size, percent, block):
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    texts = near_texts()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in near_groups(documents(*texts, extra=CLASHING), shingle_words=size, percent=percent).collect()}
    assert [got[i] for i in range(len(texts))] == brute_near(texts, size, percent)


def test_near_groups_of_repeated_rows_and_null_ids(documents):
    docs = documents({"doc_id": 7, "text": "a b c"}, {"doc_id": 7, "text": "a b c"}, {"doc_id": None, "text": "A b c"},
                     {"doc_id": None, "text": None}, {"doc_id": 2, "text": None})
    rows = near_groups(docs).orderBy("row").collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in rows) == [
        ("2", "2", True), ("7", "7", False), ("7", "7", True), ("None", "7", False), ("None", "None", True)]
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == 3


def test_near_groups_leaves_texts_where_they_are(documents, monkeypatch):
    """Texts are picked by marks, however many: no shuffle takes the texts of all rows."""
    seen, store, save = [], near_dedup.stored, near_dedup.saved

    def shuffled(df):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        join = next(x for x in plan.split("\n") if "LeftSemi" in x)
        seen.append("rightHint=(strategy=broadcast)" in join)

    monkeypatch.setattr(near_dedup, "stored", lambda df, name: shuffled(df) or store(df, name))
    docs = documents("a b c d e f", "A b c d e f", "x y z u v w", "a b c d e f g h i j", "a b c d e f g h i j k", None)
    kept = keep_one_of_each(docs)
    shuffled(kept)
    assert seen == [True, True]
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3, 5]


def test_the_pipeline_sends_texts_in_small_batches(documents, spark, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "BATCH_BYTES", 20_000, raising=False)
    docs = documents(*(f"{n} " + "x" * 1000 for n in range(200)))
    sizes = docs.select("text").mapInArrow(lambda it: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in it), "n long")
    try:
        corpus_pipeline.encode(spark, docs, "")
        largest = sizes.agg(F.max("n")).first()[0]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    assert 10_000 < largest < 40_000


@pytest.mark.parametrize("most", [0, 2, 2_000_000])
def test_rows_among_numbers(spark, monkeypatch, most):
    monkeypatch.setattr(common, "MARKS", most)
    numbers = [0, 1, 63, 64, 65, 127, 128, 5 << 33, (5 << 33) + 63, (7 << 40) + 1, -1, -64, -65]
    rows = [(n + d, f"t{n + d}") for n in numbers for d in (-1, 0, 1)]
    some = spark.createDataFrame([(n,) for n in numbers * 2], "n long").repartition(3)
    got = common.among(spark.createDataFrame(rows, "n long, text string"), "n", some).collect()
    assert sorted(map(tuple, got)) == sorted(r for r in rows if r[0] in numbers)


def test_near_groups_of_nothing(documents):
    assert near_groups(documents("a").where("false")).count() == 0


# substrings --------------------------------------------------------------------------------------------------


def brute_substrings(texts, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    seen = {}
    for w in split:
        for i in range(len(w) - window + 1):
            run = tuple(w[i : i + window])
            seen[run] = seen.get(run, 0) + 1
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("window", [2, 5, 8, 35])
def test_substrings_against_brute_force(documents, window):
    rng = random.Random(window)
    passages = [words_of(n, n) for n in (window - 1, window, window + 1, 3 * window)]
    texts = []
    for i in range(40):
        parts = words_of(rng.randrange(60), 1000 + i, 100_000)
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(parts) + 1)
            parts[at:at] = rng.choice(passages)
        texts.append(rng.choice([" ", "\n", " \t"]).join(parts))
    texts += ["the " * 100, texts[0], " ".join(texts[1].split()), *ODD]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"])
           for r in substring_dedup(documents(*texts, extra=CLASHING), window=window).collect()}
    assert [got[i] for i in range(len(texts))] == brute_substrings(texts, window)


def test_spans_are_maximal(documents):
    shared = words_of(50, 4)
    docs = documents(" ".join(["x0", *shared, "y0"]), " ".join(["x1", "z1", *shared, "y1"]))
    spans = {r["n_words"]: [(s["first"], s["last"]) for s in r["spans"]] for r in repeated_passages(docs).collect()}
    assert spans == {52: [(1, 50)], 53: [(2, 51)]}


def test_substrings_of_nothing(documents):
    assert substring_dedup(documents("a").where("false")).count() == 0
    with pytest.raises(ValueError):
        repeated_passages(documents("a"), window=1)


def test_packed_numbers_come_back():
    numbers = np.unique(np.random.default_rng(0).integers(0, 2**32 - 1, 1000))
    assert unpack(pack(numbers)).tolist() == numbers.tolist() and len(unpack(pack(numbers[:0]))) == 0


# very long texts ---------------------------------------------------------------------------------------------


def test_very_long_texts(documents):
    long = words_of(40_000, 1, 10**6)
    texts = [" ".join(long), "  ".join(long), "\n".join(edited(long, {5, 20_000})), "short", "x" * 500_000, "x" * 500_000 + "y"]
    docs = documents(*texts)
    exact = {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in exact_groups(docs).collect()}
    assert exact == {0: (1, 2), 1: (1, 2), 2: (2, 1), 3: (3, 1), 4: (4, 1), 5: (5, 1)}
    near = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_groups(docs).collect()}
    assert [near[i] for i in range(6)] == brute_near(texts, 5, 80)
    cut = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in substring_dedup(docs).collect()}
    assert [cut[i] for i in range(6)] == brute_substrings(texts, 35)
    lines = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept"]) for r in line_dedup(docs, min_docs=2).collect()}
    assert [lines[i] for i in range(6)] == brute_lines(texts, 2)


# numbers of rows ---------------------------------------------------------------------------------------------


def test_numbers_of_files_start_no_python_workers(many_files, documents):
    """A list of the driver's passes Python workers of its own kind, which then stay beside those of the operators."""
    for docs in (many_files, documents("a").where("false")):
        rows = numbered(docs, "rows")
        assert "ExistingRDD" not in rows._jdf.queryExecution().executedPlan().toString()
        assert rows.select("row").distinct().count() == docs.count()


def test_exact_copies_of_files_that_are_packed_anew(many_files, repacked):
    repacked(exact_dedup)
    assert sorted(r["doc_id"] for r in keep_first(many_files).collect()) == [n for n in range(60) if n % 3 < 2]


def test_near_groups_of_files_that_are_packed_anew(many_files, repacked):
    repacked(near_dedup)
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in near_groups(many_files).collect()}
    assert got == {n: (n - (n % 3 == 2), n % 3 < 2) for n in range(60)}


def test_near_copies_of_files_that_are_packed_anew(many_files, repacked):
    repacked(near_dedup)
    assert sorted(r["doc_id"] for r in keep_one_of_each(many_files).collect()) == [n for n in range(60) if n % 3 < 2]


# what holds at any size --------------------------------------------------------------------------------------


def test_components_of_numbers_of_late_partitions(spark):
    """Row numbers of partition twenty thousand and more, whose plain sum no long can hold."""
    base = 20_000 << 33
    chain = spark.range(2000).selectExpr(f"{base} + id AS a", f"{base} + id + 1 AS b").where(f"(a - {base}) % 100 < 99")
    hub = spark.range(150_000).selectExpr(f"{2 * base} + id AS a", f"{2 * base} AS b")
    rows = components(chain.unionByName(hub).repartition(4))
    got = rows.groupBy("label").count().collect()
    assert sorted(r["count"] for r in got) == [100] * 20 + [150_000]
    assert all(r["label"] in (2 * base, base + (r["label"] - base) // 100 * 100) for r in got)

def test_components_in_few_and_small_plans(spark, monkeypatch):
    rng = random.Random(11)
    graphs = {
        "none": [], "loops": [(4, 4)], "stars": [(1, n) for n in range(2, 40)] + [(n, 50) for n in range(51, 60)],
        "repeated": [(1, 2), (2, 1), (1, 2)], "path": [(n, n + 1) for n in range(30)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(220)],
    }
    leaves, save = [], common.saved

    def counted(df):
        leaves.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return save(df)

    monkeypatch.setattr(common, "saved", counted)
    for name, pairs in graphs.items():
        least = {n: n for pair in pairs for n in pair if pair[0] != pair[1]}
        for _ in range(len(pairs)):
            for a, b in pairs:
                if a != b:
                    least[a] = least[b] = min(least[a], least[b])
        leaves.clear()
        rows = components(spark.createDataFrame(pairs, "a long, b long").repartition(3)).collect()
        assert len(rows) == len(least) and {r["node"]: r["label"] for r in rows} == least, name
        # what are stars takes no round, and a round reads the edges six times
        assert len(leaves) == 1 if name in ("none", "loops", "stars", "repeated") else len(leaves) > 1, name
        assert max(leaves[1:], default=0) <= 6



def test_batches_that_become_one():
    batches = [pa.RecordBatch.from_pydict({"n": [k], "text": ["ab" * k], "list": [[k, k]], "sketch": [b"x"]}) for k in range(3)]
    one = one_batch(batches)
    assert one.num_rows == 3 and one.column("text").to_pylist() == ["", "ab", "abab"]
    assert pa.types.is_large_string(one.column("text").type) and one.column("list").to_pylist() == [[0, 0], [1, 1], [2, 2]]


def test_near_groups_of_large_texts_in_small_blocks(documents, monkeypatch):
    """Blocks end where their shingles are too many, so two large texts never meet with others in one."""
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 150)
    base = words_of(120, 9)
    texts = [" ".join(edited(base, {k})) for k in range(0, 120, 5)] + [" ".join(words_of(120, 50 + k)) for k in range(6)]
    docs = documents(*texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_groups(docs).collect()}
    assert [got[i] for i in range(len(texts))] == brute_near(texts, 5, 80)


def test_rows_of_files_keep_their_numbers(many_files, spark):
    rows = numbered(many_files, "numbered")
    first = {r["doc_id"]: r["row"] for r in rows.select("row", "whole.doc_id").collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        again = {r["doc_id"]: r["row"] for r in numbered(many_files, "numbered").select("row", "whole.doc_id").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert first == again and len(set(first.values())) == 60
    # a frame that is no scan of files is written with its numbers
    made = numbered(many_files.unionByName(many_files), "numbered", twice=F.col("doc_id") * 2)
    assert made.columns == ["row", "whole", "twice"] and made.select("row").distinct().count() == 120
