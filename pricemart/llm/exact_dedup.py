"""Exact deduplication by deterministic block naming, with DataFrame functions only.

Normalised texts are cut into blocks of ``block_chars`` characters. The distinct blocks are sorted and each
gets an integer name; then, level by level, adjacent names are paired, the distinct pairs are sorted and named
again, until every document has one name. Names are given to whole contents, never to hashes, so two
documents of the same number of blocks have the same name exactly if their texts are equal.

At scale: distinct blocks are combined map-side, so a block that a third of all documents share reaches the
naming tasks once per map task; joining names back is a plain equi-join that adaptive execution splits. Whole
texts are shuffled twice (once to be named, once to look their names up), and the rows that stay are picked without
another shuffle of texts; upper levels move a few numbers per block, and every level is written out, as a name must
never be computed twice. Most texts are one block: they are normalised as bytes and pass no regular expression, which
makes several copies of a text in the executor's heap.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import among, numbered, row_number, saved, stored, tidy

BLOCK_CHARS = 4096
SPACES = r"[\x20\x09-\x0D]"


def normalised(text: str) -> Column:
    """The text without spaces, tabs and line ends; null counts as empty."""
    plain = whole = F.coalesce(F.col(text), F.lit(""))
    for space in " \t\n\x0b\x0c\r":
        plain = F.replace(plain, F.lit(space), F.lit(""))
    # bytes that are no UTF-8 become what Java's strings make of them
    return F.when(F.is_valid_utf8(whole), plain).otherwise(F.regexp_replace(whole, SPACES, ""))


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, keep_id, group_size, kept, text_sha256, n_blocks.

    Of equal texts the row with the most characters before normalising stays, then the smallest id (null
    ids last), then the first row, so that repeated rows leave exactly one. A null text equals the empty
    text. ``row`` numbers the rows of ``docs`` for this call alone. Only the two named columns are read, so
    other columns may have any name. No rows give no rows.
    """
    return _groups(docs.select(
        row_number().alias("row"), F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")
    ), block_chars)


def _groups(docs: DataFrame, block_chars: int) -> DataFrame:
    """As :func:`exact_groups`, of rows (row, doc_id, text); the numbers are read by one scan only."""
    longest = docs.agg(F.max(F.char_length("text"))).first()[0] or 0
    first = stored(_named_blocks(docs, block_chars), "exact_blocks")
    names = first.select("row", "pos", "name")
    for _ in range(math.ceil(math.log2(max(1, math.ceil(longest / block_chars))))):
        names = saved(_named_pairs(names))
        tidy(docs.sparkSession)
    named = first.where("pos = 0").drop("name", "pos").join(names.select("row", "name"), "row")

    best = F.min(F.struct((-F.col("n_chars")).alias("n"), F.col("doc_id").isNull().alias("z"), "doc_id", "row"))
    groups = named.groupBy("n_blocks", "name").agg(F.count("row").alias("group_size"), best.alias("best"))
    return named.join(groups, ["n_blocks", "name"]).select(
        "row",
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
        "n_blocks",
    )


def keep_first(docs: DataFrame, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, with all their columns."""
    rows = numbered(docs, "exact_rows")
    whole = F.col("whole")
    texts = rows.select("row", whole[id_column].alias("doc_id"), whole[text_column].alias("text"))
    return among(rows, "row", _groups(texts, BLOCK_CHARS).where("kept")).select("whole.*")


def _named_blocks(docs: DataFrame, block_chars: int) -> DataFrame:
    """The blocks of all documents with their names; what belongs to a document stands in its first block."""
    plain = docs.select("row", "doc_id", F.char_length(F.coalesce("text", F.lit(""))).alias("n_chars"),
                        normalised("text").alias("plain"))
    cut = F.regexp_extract_all("plain", F.lit(f"(?s).{{1,{block_chars}}}"), F.lit(0))
    blocks = plain.select(
        "row", "doc_id", "n_chars", F.unhex(F.sha2("plain", 256)).alias("sha"),
        F.when((F.char_length("plain") <= block_chars) & F.is_valid_utf8("plain"), F.array("plain"))
        .otherwise(cut).alias("blocks"),
    ).select("row", "doc_id", "n_chars", "sha", F.size("blocks").alias("n_blocks"),
             F.posexplode("blocks").alias("pos", "block"))
    start = F.col("pos") == 0
    blocks = blocks.select("row", "pos", "n_blocks", "block",
                           *(F.when(start, F.col(c)).alias(c) for c in ("doc_id", "n_chars", "sha")))
    return blocks.join(_names(blocks.select("block").distinct(), "block"), "block").drop("block")


def _named_pairs(names: DataFrame) -> DataFrame:
    """One name for every two adjacent names of a row; a last one without partner is paired with -1."""
    even = F.col("pos") % 2 == 0
    pairs = names.groupBy("row", F.shiftright("pos", 1).alias("at")).agg(
        F.max(F.when(even, F.col("name"))).alias("left"),
        F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(-1)).alias("right"),
    )
    named = pairs.join(_names(pairs.select("left", "right").distinct(), "left", "right"), ["left", "right"])
    return named.select("row", F.col("at").alias("pos"), "name")


def _names(distinct: DataFrame, *content: str) -> DataFrame:
    """Sort the distinct contents of every partition and number them: one integer for each."""
    return distinct.sortWithinPartitions(*content).withColumn("name", F.monotonically_increasing_id())
