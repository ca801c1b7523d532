"""From questions to answers: what to ask, what to ask again, the facts, the report and the log row.

Every question begins with the list of instruments and the list of sources. What was asked before is given as runs;
a request is made (again) if the question wants it and no run of its kind succeeded. All facts come from one metrics
report and one comparison of the series that are asked for.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemart.operators.metrics import compare_pairs, metrics_report
from pricemart.operators.prices import SERIES, default_range, scan_range
from pricemart.operators.questions import (
    comparison_sheets,
    fact_sheets,
    first_symbol,
    grounded_reports,
    instrument_listing,
    intents,
    question_log_rows,
    source_listing,
    symbol_dictionary,
)
from pricemart.session import shared_dir

# fixed values: what each kind of request is called, by what a question wants
REQUESTS = {
    "wants_analytics": "get_analytics",
    "wants_trend": "get_trend",
    "wants_forecast": "get_forecast",
    "wants_risk": "get_risk_signal",
    "wants_compare": "compare_assets",
}
LISTS = ("list_instruments", "list_sources")

#: Entries of a list that reach a report: more than fit into the snippet that is shown of it.
_SHOWN = 7
#: Requests that are made after earlier runs count from here.
_AFTER = 1_000_000


def _first_entries(documents: DataFrame, key: str, *order: str) -> Column:
    """The first entries of a listing, as one value: (rank, key, raw) of each."""
    rank = F.struct(*order, key, "raw")
    first = documents.select(rank.alias("rank"), F.col(key).alias("key"), "raw").orderBy("rank").limit(_SHOWN)
    return first.agg(F.sort_array(F.collect_list(F.struct("rank", "key", "raw")))).scalar()


def retry_plan(
    asked: DataFrame, earlier: DataFrame, key: Sequence[str], instruments: Column | int
) -> DataFrame:
    """(key, requests): what is still to be asked, in order, of questions with the flags of :func:`intents`.

    ``earlier`` has the runs so far (key, name, error). A kind of request with a run without error is not made again; one
    that failed or had too little data is. Two instruments are compared only if there are two.
    """
    keys = list(key)
    good = earlier.where(F.col("error").isNull()).groupBy(*keys).agg(F.collect_set("name").alias("_good"))
    wanted = F.array_compact(F.array(*(
        F.when(F.col(flag) & ~F.coalesce(F.array_contains("_good", name), F.lit(False)) & _possible(name, instruments), F.lit(name))
        for flag, name in REQUESTS.items()
    )))
    return asked.join(good, keys, "left").select(*keys, wanted.alias("requests"))


def _possible(name: str, instruments: Column | int) -> Column:
    return F.lit(True) if name != "compare_assets" else (F.lit(instruments) if isinstance(instruments, int) else instruments) >= 2


def answer_questions(
    questions: DataFrame, listing: DataFrame, sources: DataFrame, prices: DataFrame, key: Sequence[str],
    earlier: DataFrame | None = None, start_date: date | None = None, end_date: date | None = None,
) -> DataFrame:
    """One log row per question (key, user_prompt): tools_invoked and llm_response, the grounded report.

    ``key`` names a question. ``listing`` (instrument_id, symbol, name, instrument_class, region, position) is the
    list of instruments in its order, ``sources`` that of sources. A question is about the instrument whose symbol it
    holds, else about the first one, of the first source by id, and compares it with the second one. ``earlier`` has
    runs made before (key, seq, name, raw, error).
    """
    keys = list(key)
    listed = _first_entries(instrument_listing(listing, "position"), "instrument_id", "position")
    named = _first_entries(source_listing(sources), "source_id")
    total = listing.agg(F.count(F.lit(1))).scalar()

    asked = first_symbol(questions, symbol_dictionary(listing), [*keys, "user_prompt"])
    asked = intents(asked).withColumns({
        "instrument_id": F.coalesce("instrument_id", F.get(listed, 0)["key"]), "source_id": F.get(named, 0)["key"],
        "other_id": F.get(listed, 1)["key"], "_total": total,
    })
    if earlier is None:
        earlier = questions.select(*keys, F.lit(0).alias("seq"), *(F.lit("").alias(c) for c in ("name", "raw", "error"))).where("false")
    plan = retry_plan(asked, earlier, keys, F.col("_total"))
    steps = asked.join(plan, keys).select(
        *keys, *SERIES, "other_id", F.posexplode("requests").alias("_at", "name")
    ).withColumn("seq", F.col("_at") + _AFTER)

    runs = [
        asked.select(*keys, F.lit(n - len(LISTS)).alias("seq"), F.lit(name).alias("name"), _list_text(entries).alias("raw"),
                     F.lit(None).cast("string").alias("error"), count.alias("items"))
        for n, (name, entries, count) in enumerate(zip(LISTS, (listed, named), (F.col("_total"), F.lit(None).cast("long"))))
    ]
    runs.append(earlier.select(*keys, "seq", "name", "raw", "error", F.lit(None).cast("long").alias("items")))
    runs += [_facts(steps, prices, keys, start_date, end_date), _comparisons(steps, prices, keys, start_date, end_date)]
    every = runs[0]
    for more in runs[1:]:
        every = every.unionByName(more)
    # read four times below, so that the facts are computed once
    shared_dir(questions.sparkSession)
    every = every.checkpoint()
    tools = every.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("seq", "name"))).alias("_tools"))
    reports = grounded_reports(every, keys).withColumnRenamed("report", "llm_response")
    rows = asked.select(*keys, "user_prompt").join(tools, keys).join(reports, keys)
    return question_log_rows(rows.select(*keys, "user_prompt", F.col("_tools.name").alias("tools"), "llm_response"))


def _list_text(entries: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(entries["raw"], ","), F.lit("]"))


def _facts(steps: DataFrame, prices: DataFrame, keys: list[str], start: date | None, end: date | None) -> DataFrame:
    asked = steps.where(F.col("name") != "compare_assets")
    series = asked.select(*SERIES).distinct()
    report = metrics_report(prices.join(series, list(SERIES), "left_semi"), start, end, requested=series)
    sheets = fact_sheets(report).select(*SERIES, "name", "raw", "error")
    found = asked.join(sheets, [*SERIES, "name"])
    return found.select(*keys, "seq", "name", "raw", "error", F.lit(None).cast("long").alias("items"))


def _comparisons(steps: DataFrame, prices: DataFrame, keys: list[str], start: date | None, end: date | None) -> DataFrame:
    asked = steps.where(F.col("name") == "compare_assets").select(
        *keys, "seq", "name", "source_id", F.col("instrument_id").alias("instrument_a_id"), F.col("other_id").alias("instrument_b_id")
    )
    pair = ["source_id", "instrument_a_id", "instrument_b_id"]
    compared = compare_pairs(scan_range(prices, *default_range(start, end)), asked.select(*pair).distinct())
    found = asked.join(comparison_sheets(compared), pair)
    return found.select(
        *keys, "seq", "name", "raw", F.lit(None).cast("string").alias("error"), F.lit(None).cast("long").alias("items")
    )
