"""What the operators share: reading tables, naming rows and texts, cutting lineage, components of links."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, shared_dir


#: Names of files that are broadcast together at most, in characters.
FILE_NAMES_BYTES = 64_000_000
#: Edges that fill a task.
ROWS_A_TASK = 100_000
#: Marks of rows that are broadcast together at most; each stands for up to 64 rows.
MARKS = 2_000_000
#: Rows of a file are numbered below two to this.
ROW_BITS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame) -> DataFrame:
    """The same rows, written to the shared folder: later steps read them and never compute them again."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, for a table that a later step reads."""
    return scratch_path(spark, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """As :func:`saved`, as a compressed table: for rows that hold texts."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def text_key(text: str = "text") -> Column:
    """16 bytes that name a text; null counts as the empty text."""
    return F.unhex(F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary")))


def row_number() -> Column:
    """A different number for every row, for one scan: another scan of the same files may give other numbers.

    They go by partition, and how files are packed into partitions follows the cores that are alive at planning.
    Save the numbered rows, and read all that is joined by number from what was saved.
    """
    return F.monotonically_increasing_id()


def numbered(df: DataFrame, name: str, **more: Column) -> DataFrame:
    """(row, whole, more): the rows of ``df`` as structs, each with a number that every later scan gives it again.

    Rows of Parquet files are numbered by file and place in the file, which do not hang on how files are packed into
    partitions: nothing is written. Rows of any other frame are written once with their numbers.
    """
    file, index = f"_file_{uuid.uuid4().hex}", f"_index_{uuid.uuid4().hex}"
    names, added = [f"`{c}`" for c in df.columns], [c.alias(a) for a, c in more.items()]
    try:
        place = df.metadataColumn("_metadata")
        placed = df.select(*names, place["file_path"].alias(file), place["row_index"].alias(index), *added)
    except AnalysisException:
        return stored(df.select(row_number().alias("row"), F.struct("*").alias("whole"), *added), name)
    # a row per file, as the driver's list of the files has
    files = sorted(r[0] for r in placed.select(file).distinct().collect())
    # an Arrow table goes to the JVM as it is; a list would start more Python workers, which stay with their memory
    numbers = df.sparkSession.createDataFrame(pa.table({"number": pa.array(range(len(files)), pa.int64()), file: pa.array(files, pa.string())}))
    if sum(map(len, files)) <= FILE_NAMES_BYTES:
        numbers = F.broadcast(numbers)
    row = F.shiftleft("number", ROW_BITS) + F.col(index)
    return placed.join(numbers, file).select(row.alias("row"), F.struct(*names).alias("whole"), *more)


def among(df: DataFrame, column: str, some: DataFrame) -> DataFrame:
    """The rows of ``df`` whose number in ``column`` is one of those in ``some``: they stay where they are, texts and all.

    Numbers of :func:`numbered` rows lie close together, so a bit each says which are meant, 64 in a mark. The marks
    go to all tasks; only where they are more than ``MARKS`` the rows meet their numbers in a shuffle.
    """
    number = F.col(column)
    word, bit = F.shiftright(number, 6), F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(63).cast("int"))
    marks = saved(some.select(word.alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits")))
    if marks.count() > MARKS:
        return df.join(some.select(column), column, "left_semi")
    return df.join(F.broadcast(marks), (word == F.col("_word")) & (bit.bitwiseAND(F.col("_bits")) != 0), "left_semi")


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def runs(
    batches: Iterator[pa.RecordBatch], column: str, work: Callable[[list[pa.RecordBatch]], Iterator[pa.RecordBatch]]
) -> Iterator[pa.RecordBatch]:
    """Apply ``work`` to every run of rows that are equal in ``column``; the input is sorted by it."""
    held, current = [], None
    for batch in batches:
        keys = batch.column(column)
        lo = 0
        while lo < batch.num_rows:
            key = keys[lo].as_py()
            hi = _run_end(keys, lo, key)
            if held and key != current:
                yield from work(held)
                held = []
            current = key
            held.append(batch.slice(lo, hi - lo))
            lo = hi
    if held:
        yield from work(held)


def one_batch(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """All rows of the batches as one; texts and lists may take more than two gigabytes together."""
    large = {pa.string(): pa.large_string(), pa.binary(): pa.large_binary()}
    table = pa.Table.from_batches(batches)
    kinds = [pa.large_list(f.type.value_type) if pa.types.is_list(f.type) else large.get(f.type, f.type) for f in table.schema]
    table = table.cast(pa.schema([f.with_type(k) for f, k in zip(table.schema, kinds)]))
    columns = [c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in table.columns]
    return pa.RecordBatch.from_arrays(columns, schema=table.schema)


def _run_end(keys: pa.Array, lo: int, key) -> int:
    """The end of the run of ``key`` that starts at ``lo``, by doubling and then halving steps."""
    step, hi, n = 1, lo + 1, len(keys)
    while hi < n and keys[hi].as_py() == key:
        lo, hi, step = hi, min(n, hi + 2 * step), 2 * step
    hi = min(hi, n)
    while hi - lo > 1:
        middle = (lo + hi) // 2
        lo, hi = (middle, hi) if keys[middle].as_py() == key else (lo, middle)
    return lo + 1


def tidy(spark: SparkSession) -> None:
    """Have shuffles and checkpoints of frames that are gone deleted now: Spark does it when the driver collects garbage."""
    spark.sparkContext._jvm.System.gc()


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of ``links`` (a long, b long); the label is the smallest node it reaches.

    Alternates two kinds of steps until all edges are stars around their labels: every node points its larger
    neighbours to its smallest neighbour, then its smaller ones. Minima are combined map-side and joined back, so a
    node with any number of neighbours is never gathered in one place; the number of rounds is logarithmic. Edges are
    kept in as many partitions as they fill. Each round's plan reads the edges as few times as it can: the driver's
    memory goes by the plans.
    """
    spark = links.sparkSession
    edges = saved(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    count, stars = _state(edges)
    while not stars:
        filled = max(1, min(tasks(spark), -(-count // ROWS_A_TASK)))
        edges = edges.coalesce(filled)
        up = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))
        least = edges.unionByName(up).groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = up.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct().coalesce(filled)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # the row of the smallest neighbour points the node itself to it
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                              F.col("m").alias("v"))
        edges = saved(small.distinct().coalesce(filled))
        count, stars = _state(edges)
        del up, least, large, small
        tidy(spark)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )


def _state(edges: DataFrame) -> tuple[int, bool]:
    """How many distinct edges (u, v), u > v, there are, and whether every node is a centre or has one edge only, to a centre."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("under")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("under"))
    )
    nodes = ends.groupBy("node").agg(F.sum("under").alias("under"), F.count("under").alias("n"))
    count, stars = nodes.agg(F.sum("under"), F.min(F.expr("under = 0 OR n = 1"))).first()
    return count or 0, stars is not False
