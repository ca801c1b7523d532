"""Mixing sources to target weights along a time-varying curriculum.

Every source has a share of all words to be drawn and a schedule, a piecewise linear weight over training time
from 0 to 1. Its integral up to a time is the source's cumulative demand there; the documents of a source,
in a fixed shuffled order and repeated as often as the target needs, fill that demand one after another, and
the inverse of the integral gives the time at which each is drawn. Sorted by that time, by range, the draws
are the training order.

At scale: no text is moved, only sizes. The running sum over a source, which may hold a third of all rows, is
taken in two steps: sums of hash buckets of about ``ROWS_PER_BUCKET`` rows, running sums over these, then
running sums inside each bucket; an id with more rows than that has several buckets. Windows over sources have a row per source.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import numbered, row_number, saved, tasks
from .words import WORD

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
ROWS_PER_BUCKET = 20_000
#: Rows of one id that fill a bucket are cut where their numbers differ above these bits.
ROW_PART_BITS = 14

#: Weight over training time by place in WEIGHTS: heavy sources first, light ones towards the end.
SCHEDULES = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.25), (0.75, 1.0), (1.0, 2.5)),
)

Schedule = Sequence[tuple[float, float]]


def segments(schedule: Schedule) -> list[tuple[float, float, float, float]]:
    """(time, weight, slope, demand before) of every piece, scaled so that the whole demand is 1."""
    if schedule[0][0] != 0 or schedule[-1][0] != 1 or any(w < 0 for _, w in schedule):
        raise ValueError("a schedule runs from 0 to 1 with weights of 0 or more")
    pairs = list(zip(schedule, schedule[1:]))
    area = sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in pairs)
    out, before = [], 0.0
    for (t0, w0), (t1, w1) in pairs:
        out.append((t0, w0 / area, (w1 - w0) / area / (t1 - t0), before))
        before += (t1 - t0) * (w0 + w1) / 2 / area
    return out


def time_of(demand: str, schedule: Schedule) -> str:
    """SQL for the time at which the cumulative demand of a source reaches ``demand``, from 0 to 1."""
    cases = []
    for t, w, slope, before in reversed(segments(schedule)):
        rest = f"({demand} - {before!r}D)"
        cases.append(
            f"WHEN {demand} >= {before!r}D THEN {t!r}D + CASE WHEN {rest} <= 0D THEN 0D ELSE "
            f"2D * {rest} / ({w!r}D + sqrt(greatest(0D, {w * w!r}D + {2 * slope!r}D * {rest}))) END"
        )
    return f"CASE {' '.join(cases)} ELSE 0D END"


def mixture(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    weights: Sequence[float] = WEIGHTS, schedules: Sequence[Schedule] = SCHEDULES, most: int = MOST_REPEATS,
) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, size, source_size, target, taken, draws.

    A size is a number of words. Sources in order of their names (null last) have ``weights`` in turn and
    share as many words as all documents have; no target exceeds ``most`` times its source, what is above goes
    to the others by weight. ``taken`` is how many words of the document are drawn: whole repetitions, and the
    words of one more where the target ends, so the sum over a source is its target to the next word.
    ``draws`` lists (words, time) of each. Documents without words and sources without words take no part
    (target 0). Documents are taken in order of a hash of their id; repeated rows are documents of their own.
    Only the named columns are read; ``row`` numbers the rows of ``docs`` for this call alone. No rows give no rows.
    """
    return _mixture(docs.select(
        row_number().alias("row"), F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"),
        F.col(text_column).alias("text"),
    ), weights, schedules, most)


def _mixture(rows: DataFrame, weights: Sequence[float], schedules: Sequence[Schedule], most: int) -> DataFrame:
    """As :func:`mixture`, of rows (row, doc_id, source, text); the numbers are read by one scan only."""
    sized = saved(rows.select(
        "row", "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    ).withColumn("order", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))))

    digits = max(1, math.ceil(math.log(max(2, sized.count() / ROWS_PER_BUCKET), 16)))
    targets = saved(source_targets(sized, weights, most))
    placed = sized.join(targets, sized["source"].eqNullSafe(targets["name"])).drop("source", "name")
    placed = _in_buckets(placed, digits)
    sums = placed.groupBy("place", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("place", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("place", "bucket").orderBy("order", "doc_id", "row")
    running = placed.withColumn("inside", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    running = running.join(sums, ["place", "bucket"]).withColumn("start", F.expr("before + inside - size"))

    whole = F.expr("CASE WHEN source_size = 0 THEN 0 ELSE words div source_size END")
    running = running.withColumn("whole", whole)
    running = running.withColumn("part", F.expr("greatest(0, least(size, words - whole * source_size - start))"))
    draws = F.expr("""
        filter(transform(sequence(0, whole), n -> named_struct(
            'words', if(n < whole, size, part),
            'demand', if(words = 0, 0D, (n * source_size + start) / cast(words AS double)))), d -> d.words > 0)
    """)
    timed = F.expr(f"transform(draws, d -> named_struct('words', d.words, 'time', {_time('d.demand', len(weights), schedules)}))")
    return running.withColumn("draws", draws).select(
        "row", "doc_id", "size", "source_size", "target", F.expr("whole * size + part").alias("taken"),
        timed.alias("draws"),
    )


def _in_buckets(placed: DataFrame, digits: int) -> DataFrame:
    """``placed`` with ``bucket``, in whose order the buckets of a source follow each other.

    A bucket is a prefix of the hash. Where one id has so many rows that it fills a bucket, its rows are buckets of
    their own, by row, between those of smaller and those of larger hashes.
    """
    placed = placed.withColumn("prefix", F.substring("order", 1, digits))
    crowded = placed.groupBy("place", "prefix").agg(F.count("row").alias("n")).where(F.col("n") > 4 * ROWS_PER_BUCKET)
    # both have fewer rows than all rows divided by ROWS_PER_BUCKET
    hot = placed.join(F.broadcast(crowded.drop("n")), ["place", "prefix"], "left_semi").groupBy("place", "prefix", "order")
    hot = hot.agg(F.count("row").alias("n")).where(F.col("n") > ROWS_PER_BUCKET)
    hot = hot.groupBy("place", "prefix").agg(F.sort_array(F.collect_list("order")).alias("hot"))
    placed = placed.join(F.broadcast(hot), ["place", "prefix"], "left")
    below = F.when(F.col("hot").isNull(), 0).otherwise(F.size(F.filter("hot", lambda h: h < F.col("order"))))
    own = F.coalesce(F.array_contains("hot", F.col("order")), F.lit(False))
    part = F.when(own, F.shiftright("row", ROW_PART_BITS)).otherwise(F.lit(0).cast("long"))
    bucket = F.struct("prefix", below.alias("below"), own.alias("own"), part.alias("part"))
    return placed.withColumn("bucket", bucket).drop("prefix", "hot")


def _time(demand: str, weights: int, schedules: Sequence[Schedule]) -> str:
    cases = (f"WHEN {k} THEN {time_of(demand, schedules[k % len(schedules)])}" for k in range(weights))
    return f"CASE (place - 1) % {weights} {' '.join(cases)} END"


def source_targets(sized: DataFrame, weights: Sequence[float], most: int) -> DataFrame:
    """name, place, source_size, target and target in whole words of every source.

    With sources in order of cap / weight, those that reach their cap are a leading run; the first that stays
    below shows how many words a unit of weight gets.
    """
    sources = sized.groupBy(F.col("source").alias("name")).agg(F.sum("size").alias("source_size"))
    names = Window.orderBy(F.col("name").asc_nulls_last())
    sources = sources.withColumn("place", F.row_number().over(names))
    sources = sources.withColumn("weight", F.expr(f"array({', '.join(f'{float(w)!r}D' for w in weights)})[(place - 1) % {len(weights)}]"))
    sources = sources.withColumn("cap", F.lit(most) * F.col("source_size")).withColumn("level", F.col("cap") / F.col("weight"))
    everything = Window.partitionBy()
    lower = Window.orderBy("level", "place").rowsBetween(Window.unboundedPreceding, -1)
    sources = sources.withColumn("rest", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(lower), F.lit(0)))
    sources = sources.withColumn(
        "share", F.col("rest") / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(lower), F.lit(0.0)))
    )
    free = F.when(F.col("level") > F.col("share"), F.struct("level", "place", "share"))
    sources = sources.withColumn("unit", F.min(free).over(everything)["share"])
    target = F.when(F.col("unit").isNull(), F.col("cap").cast("double")).otherwise(
        F.least(F.col("weight") * F.col("unit"), F.col("cap").cast("double"))
    )
    return sources.select("name", "place", "source_size", target.alias("target"), F.round(target).cast("long").alias("words"))


def training_order(draws: DataFrame, time: str = "time") -> DataFrame:
    """Rows in training order: ranges of time over the partitions, sorted inside each."""
    return draws.repartitionByRange(tasks(draws.sparkSession), time, "row").sortWithinPartitions(time, "row")


def mixed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """``docs`` as the mixture draws them, with all their columns, in training order.

    A document comes once for every draw, whole: the part of one where a target ends comes if it is half of
    the document or more.
    """
    rows, whole = numbered(docs, "mix_rows"), F.col("whole")
    draws = _mixture(rows.select(
        "row", whole[id_column].alias("doc_id"), whole[source_column].alias("source"), whole[text_column].alias("text"),
    ), WEIGHTS, SCHEDULES, MOST_REPEATS)
    draws = draws.select("row", F.explode(F.expr("filter(draws, d -> 2 * d.words >= size)")).alias("draw"))
    draws = draws.select(F.col("row").alias("drawn_row"), F.col("draw.time").alias("time"))
    return training_order(rows.join(draws, F.col("row") == F.col("drawn_row"))).select("whole.*")
