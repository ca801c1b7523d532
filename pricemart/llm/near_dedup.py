"""Near-duplicate classes by fast similarity sketching, banding and exact verification.

1. Every text becomes its set of word shingles, a sketch of it, and a digest that names the set. Equal sets
   are one node from here on, however many rows share them.
2. Bands of sketch coordinates meet in buckets. A bucket gives only the edges from its smallest node (its
   centre) to the others, never all pairs. The components of these edges are families: any two similar nodes
   share a bucket (but with the probability of :func:`sketches.band_width`) and so a family.
3. Centres are compared with their members on the full sets; what links to a centre is one class already.
4. In families that are still more than one class, nodes of different classes are compared, block by block of
   ``BLOCK`` nodes, so no task ever holds more than two blocks. Blocks that are one class are not compared with
   each other. A task keeps a pair that its sketches allow, compares the full sets, and reports a link only if
   it joins two classes: at most one per node, so nothing grows with the square of a group.
5. Classes are the components of all links.

A link of two different sets is lost only if the sketches miss it, with probability below 1e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import among, components, numbered, one_batch, runs, saved, stored, tasks, tidy
from .sketches import BINS, band_width, least_agreement, set_digests, shingle_sets, sketch, sketch_bytes
from .words import Words, slices

#: Nodes that are compared in one piece, and shingles that they have together (but for one node with more).
BLOCK = 512
BLOCK_SHINGLES = 1_000_000
#: Bytes of text whose shingles are made at once; workers keep tables as long as that.
SLICE_BYTES = 1_000_000


def near_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle_words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_shingles, component_id, kept.

    Two texts are linked if 100 * shared shingles >= ``percent`` * all their shingles. ``component_id`` is the
    smallest id of the class (null only if all its ids are); the row with it stays, of repeated rows the first.
    Words are lower-cased in A-Z; a text of fewer than ``shingle_words`` words is one shingle. Null, empty and
    blank texts have no shingles, are linked with nothing and stay. ``row`` numbers the rows of ``docs``.
    Only the two named columns are read. No rows give no rows.
    """
    rows, whole = numbered(docs, "near_rows"), F.col("whole")
    rows = rows.select("row", whole[id_column].alias("doc_id"), whole[text_column].alias("text"))
    return _groups(rows, shingle_words, percent)


def _groups(docs: DataFrame, shingle_words: int, percent: int) -> DataFrame:
    """As :func:`near_groups`, of rows (row, doc_id, text) whose numbers every scan gives again."""
    sketched = saved(docs.select("row", "text").mapInArrow(
        lambda it: _sketches(it, shingle_words), "row long, n_shingles long, digest binary, sketch binary"
    ))
    same_set = sketched.where("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("node"))
    # in as many parts as there are tasks: every node becomes a row a band
    dealt = sketched.withColumnRenamed("row", "node").repartition(tasks(docs.sparkSession), "node")
    nodes = saved(same_set.join(dealt, "node").select("node", "n_shingles", "sketch"))

    stars = saved(_stars(nodes, band_width(percent / 100)))
    families = components(stars.select(F.col("node").alias("a"), F.col("centre").alias("b")))
    families = saved(families.join(nodes.select("node", _share()), "node"))
    texts = among(docs.select(F.col("row").alias("node"), "text"), "node", families)
    texts = stored(texts.join(among(nodes.select("node", "sketch"), "node", families), "node"), "near_texts")
    tidy(docs.sparkSession)

    measure = (shingle_words, percent, least_agreement(percent / 100))
    links = saved(_compared(_star_units(stars), texts, measure))
    tidy(docs.sparkSession)
    classes = saved(components(links))
    labelled = families.select("node", "share", F.col("label").alias("family")).join(classes, "node", "left")
    labelled = saved(labelled.select("node", "share", "family", F.coalesce("label", "node").alias("label")))
    tidy(docs.sparkSession)
    links = links.unionByName(_compared(_family_units(labelled), texts, measure))

    labels = components(links)
    tidy(docs.sparkSession)
    rows = docs.select("row", "doc_id").join(sketched.drop("sketch"), "row").join(same_set, "digest", "left")
    rows = rows.join(labels, "node", "left").select(
        "row", "doc_id", "n_shingles", F.coalesce("label", "node", -1 - F.col("row")).alias("label")
    )
    least = F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "row")).alias("least")
    return rows.join(rows.groupBy("label").agg(least), "label").select(
        "row", "doc_id", "n_shingles", F.col("least.doc_id").alias("component_id"),
        (F.col("row") == F.col("least.row")).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame, shingle_words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that :func:`near_groups` keeps, with all their columns."""
    rows = numbered(docs, "near_rows")
    kept = _groups(rows.select("row", "whole.doc_id", "whole.text"), shingle_words, percent).where("kept")
    return among(rows, "row", kept).select("whole.*")


def _sketches(batches: Iterator[pa.RecordBatch], shingle_words: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, bounds in slices(batch, size=SLICE_BYTES):
            sets, first = shingle_sets(Words(data, bounds, lower=True), shingle_words)
            short = sketch_bytes(sketch(sets, first))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(np.diff(first), pa.int64()), pa.array(set_digests(sets, first), pa.binary()),
                 pa.array([s.tobytes() for s in short], pa.binary())],
                ["row", "n_shingles", "digest", "sketch"],
            )


def _share() -> Column:
    """The part of a block that a node takes."""
    return F.greatest(F.lit(1 / BLOCK), F.col("n_shingles") / BLOCK_SHINGLES).alias("share")


def _stars(nodes: DataFrame, width: int) -> DataFrame:
    """Distinct (node, centre, share): the smallest node of every bucket with each other node in it."""
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BINS // width - 1)),
        lambda band: F.xxhash64(band, F.substring(F.col("sketch"), band * width + 1, F.lit(width))),
    )
    bands = nodes.select("node", _share(), F.explode(keys).alias("band"))
    buckets = bands.groupBy("band").agg(F.min("node").alias("centre"), F.count("node").alias("n")).where("n > 1")
    return bands.join(buckets, "band").where("node <> centre").select("node", "centre", "share").distinct()


def _star_units(stars: DataFrame) -> DataFrame:
    """(unit, node, side, label): every centre against its members, in blocks."""
    sizes = stars.groupBy("centre").agg(F.ceil(F.sum("share")).alias("parts"))
    members = stars.join(sizes, "centre").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    unit = F.xxhash64("centre", "part").alias("unit")
    centres = members.select(unit, F.col("centre").alias("node"), F.lit(0).alias("side")).distinct()
    units = centres.unionByName(members.select(unit, "node", F.lit(1).alias("side")))
    return units.withColumn("label", F.col("node"))


def _family_units(labelled: DataFrame) -> DataFrame:
    """(unit, node, side, label): every two blocks of a family that can still join classes.

    A class of half a block or more has blocks of its own; smaller ones are put together.
    """
    by_class = labelled.groupBy("family", "label").agg(F.sum("share").alias("blocks"))
    own = F.col("blocks") >= 0.5
    mixed = by_class.where(~own).groupBy("family").agg(F.ceil(F.sum("blocks")).alias("mixed_parts"))
    open_families = by_class.groupBy("family").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    by_class = by_class.join(open_families.where("lo <> hi").select("family"), "family")
    by_class = by_class.join(mixed, "family", "left").select(
        "family", "label", F.when(own, F.col("label")).otherwise(-1).alias("owner"),
        F.when(own, F.ceil("blocks")).otherwise(F.col("mixed_parts")).alias("parts"),
    )
    part = F.when(F.col("owner") >= 0, F.xxhash64("node")).otherwise(F.xxhash64("label"))
    members = saved(labelled.join(by_class, ["family", "label"]).select(
        "family", "label", "node", "owner", F.pmod(part, F.col("parts")).alias("part")
    ))
    blocks = members.select("family", F.struct("owner", "part").alias("block")).distinct()
    left, right = blocks.withColumnRenamed("block", "x"), blocks.withColumnRenamed("block", "y")
    pairs = left.join(right, "family").where(
        "x <= y AND NOT (x.owner = y.owner AND x.owner >= 0)"
    ).withColumn("unit", F.xxhash64("family", "x", "y"))
    both = F.when(F.col("x") == F.col("y"), F.array("x")).otherwise(F.array("x", "y"))
    sides = pairs.select("family", "unit", F.posexplode(both).alias("side", "block"))
    members = members.select("family", F.struct("owner", "part").alias("block"), "node", "label")
    return sides.join(members, ["family", "block"]).select("unit", "node", "side", "label")


def _compared(units: DataFrame, texts: DataFrame, measure: tuple[int, int, int]) -> DataFrame:
    """(a, b): links between nodes of the two sides of a unit, or within its one side, that join two labels."""
    full = units.join(texts, "node").repartition(tasks(units.sparkSession), "unit").sortWithinPartitions("unit", "side")
    return full.mapInArrow(lambda it: runs(it, "unit", lambda run: _links(run, *measure)), "a long, b long")


def _links(run: list[pa.RecordBatch], shingle_words: int, percent: int, agreement: int) -> Iterator[pa.RecordBatch]:
    part = one_batch(run)
    node, side, label = (part.column(c).to_numpy() for c in ("node", "side", "label"))
    label = label.copy()
    coordinates = np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
    within = side[0] == side[-1]
    left = np.arange(len(node)) if within else np.flatnonzero(side == 0)
    right = left if within else np.flatnonzero(side == 1)
    likely = np.zeros((len(left), len(right)), np.uint16)
    for k in range(BINS):
        likely += coordinates[left, k][:, None] == coordinates[right, k][None, :]
    likely = likely >= agreement
    if within:
        likely = np.triu(likely, 1)
    likely &= label[left][:, None] != label[right][None, :]
    if not likely.any():
        return

    sets, sizes = [], []
    for _, data, bounds in slices(part, size=SLICE_BYTES):
        found, first = shingle_sets(Words(data, bounds, lower=True), shingle_words)
        sets.append(found)
        sizes.append(np.diff(first))
    sizes = np.concatenate(sizes)
    names, ids = np.unique(np.concatenate(sets), return_inverse=True)
    first = np.concatenate([[0], np.cumsum(sizes)])
    marked = np.zeros(len(names), bool)
    a, b = [], []
    for i in np.flatnonzero(likely.any(axis=1)).tolist():
        x = left[i]
        others = right[likely[i]]
        others = others[label[others] != label[x]]
        if not len(others):
            continue
        own = ids[first[x] : first[x + 1]]
        marked[own] = True
        shared = np.array([np.count_nonzero(marked[ids[first[y] : first[y + 1]]]) for y in others.tolist()])
        marked[own] = False
        linked = 100 * shared >= percent * (sizes[x] + sizes[others] - shared)
        for y in others[linked].tolist():
            if label[y] != label[x]:
                label[label == label[y]] = label[x]
                a.append(node[x])
                b.append(node[y])
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
