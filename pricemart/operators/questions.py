"""Questions about prices: symbols they name, what they ask for, fact sheets and report text.

A run is one recorded fact request: (key columns, seq, name, raw, error), where ``raw`` is its JSON
result and ``error`` is null when it succeeded.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.functions.automaton import TABLE_CELLS, Automaton, parts
from pricemart.functions.series import newest, newest_n
from pricemart.functions.text import number_text, or_none, snippet
from pricemart.operators.prices import SERIES

# fixed values: words by which a question asks for something, compared in lower case
INTENTS: dict[str, tuple[str, ...]] = {
    "needs_source": ("analytics", "average", "trend", "forecast", "risk", "time series", "compare"),
    "wants_analytics": ("average close", "avg close", "mean close", "analytics"),
    "wants_trend": ("trend", "explain a change", "summarize"),
    "wants_forecast": ("forecast", "next day", "predict"),
    "wants_risk": ("risk", "drawdown", "volatility"),
    "wants_compare": ("compare",),
}

# fixed values: what a result without data is called
NO_TREND = "Insufficient data (no valid price records in date range)"
NO_ANALYTICS = "Insufficient data (no records in date range)"
NO_FORECAST = "Insufficient data for forecast"
NO_RISK = "Insufficient data for risk calculation"
NO_SERIES = "No time series data found"

NOTHING_WORKED = "I could not produce a grounded answer because all tool calls failed."
NOTHING_USABLE = "Tool calls completed, but no usable payload was returned."
SOME_FAILED = "Some tool calls failed and were ignored for the final summary."
EVIDENCE_TITLE = "Grounding evidence:"
EVIDENCE_RUNS = 4

#: Characters of the largest dictionary whose automata are built on the driver and sent to the tasks.
DICTIONARY_CHARS = 4_000_000
#: The numbers of leading characters by which symbols of a larger one are looked up.
STEMS = (1, 2, 4)

# fixed values: report sentence per kind of result, with the fields it shows
REPORT_SENTENCES: dict[str, tuple[str, tuple[str, ...]]] = {
    "get_analytics": ("Analytics summary: ", ("count", "min_close", "max_close", "avg_close", "total_volume")),
    "get_trend": ("Trend summary: ", ("direction", "change", "change_pct")),
    "get_forecast": ("Forecast summary: ", ("method", "predicted_next_close")),
    "get_risk_signal": ("Risk summary: ", ("signal", "volatility_pct", "max_drawdown_pct")),
    "compare_assets": (
        "Comparison summary: ",
        ("instrument_a_count", "instrument_b_count", "instrument_a_avg_close", "instrument_b_avg_close", "avg_close_diff"),
    ),
}
REPORT_ORDER = ("list_instruments", *REPORT_SENTENCES, "get_time_series")


def symbol_dictionary(listing: DataFrame) -> DataFrame:
    """Upper-case symbol -> id from a listing with ``position``.

    A symbol keeps the place of its first entry and the id of its last; empty ones are left out.
    """
    return (
        listing.withColumn("symbol", F.upper("symbol"))
        .where(F.col("symbol") != "")
        .groupBy("symbol")
        .agg(F.max_by("instrument_id", "position").alias("instrument_id"), F.min("position").alias("position"))
    )


def first_symbol(
    questions: DataFrame, dictionary: DataFrame, key: Sequence[str], text: str = "user_prompt",
    cells: int = TABLE_CELLS, driver_chars: int = DICTIONARY_CHARS,
) -> DataFrame:
    """The first dictionary symbol that occurs anywhere in each question, null if none does.

    Every text is read once by an automaton of all symbols, so cost grows with the text, whatever the number of
    symbols and however alike they are, and no text is shuffled. Symbols with more than ``cells`` cells of a table
    together are dealt by first characters to several automata. What is sent to the tasks is checked first: a
    dictionary of more than ``driver_chars`` characters is joined with what stands at each place of the texts. A
    question keeps its row whatever its key is.
    """
    words = dictionary.where("symbol <> ''").select("symbol", "instrument_id", "position")
    chars, longest = words.agg(F.coalesce(F.sum(F.length("symbol")), F.lit(0)), F.max(F.length("symbol"))).first()
    if chars > driver_chars:
        return _joined_symbols(questions, words, key, text, longest)
    words = words.orderBy("position", "symbol").select("symbol", "instrument_id").toArrow()
    found = T.StructType([
        T.StructField("place", T.LongType()), T.StructField("symbol", T.StringType()),
        T.StructField("instrument_id", dictionary.schema["instrument_id"].dataType),
    ])
    groups = parts(words.column("symbol").to_pylist(), cells)
    hits = [_lookup(words.take(places), places, found)(F.upper(text)) for places in groups]
    # the struct with the smallest place, null where no automaton found anything
    first = F.least(*hits) if len(hits) > 1 else hits[0] if hits else F.lit(None).cast(found)
    return questions.withColumn("_hit", first).select(*key, "_hit.symbol", "_hit.instrument_id")


def _joined_symbols(questions: DataFrame, words: DataFrame, key: Sequence[str], text: str, longest: int) -> DataFrame:
    """As :func:`first_symbol` by joins: of each place as many characters as the longest symbol has are looked at."""
    named = F.unhex(F.md5(F.upper(text).cast("binary")))
    asked = questions.select(named.alias("asked"), F.upper(text).alias("upper")).where("upper <> ''").dropDuplicates(["asked"])
    stem = F.coalesce(*(F.when(F.length("symbol") >= n, F.substring("symbol", 1, n)) for n in sorted(STEMS, reverse=True)))
    spans = F.transform(F.sequence(F.lit(1), F.length("upper")), lambda at: F.substring(F.col("upper"), at, F.lit(longest)))
    spans = asked.select("asked", F.explode(F.array_distinct(spans)).alias("span"))
    stems = F.array_distinct(F.array(*(F.substring("span", 1, n) for n in STEMS)))
    met = spans.select("asked", "span", F.explode(stems).alias("stem")).join(words.withColumn("stem", stem), "stem")
    first = F.min(F.struct("position", "symbol", "instrument_id")).alias("first")
    found = met.where(F.col("span").startswith(F.col("symbol"))).groupBy("asked").agg(first)
    return questions.withColumn("asked", named).join(found, "asked", "left").select(*key, "first.symbol", "first.instrument_id")


def _lookup(words: pa.Table, places: list[int], found: T.StructType):
    """A function from texts to the first of some of the dictionary's words, with their places in all of it."""
    order = np.argsort(places, kind="stable")
    words, place = words.take(order).combine_chunks(), np.array(places, np.int64)[order]
    automaton = Automaton(words.column("symbol").to_pylist())
    columns = [pa.array(np.append(place, 0)), *(pa.concat_arrays([*c.chunks, pa.nulls(1, c.type)]) for c in words.columns)]

    @F.arrow_udf(found)
    def lookup(texts: pa.Array) -> pa.Array:
        at = automaton.first_words(texts.to_pylist())
        return pa.StructArray.from_arrays(
            [c.take(pa.array(at)) for c in columns], names=found.names, mask=pa.array(at == automaton.none)
        )

    return lookup


def intents(questions: DataFrame, text: str = "user_prompt") -> DataFrame:
    """One flag per kind of request, set when a question holds one of its words."""
    lower = F.lower(text)

    def any_of(words: tuple[str, ...]) -> Column:
        return F.coalesce(lower.rlike("|".join(words)), F.lit(False))

    return questions.withColumns({name: any_of(words) for name, words in INTENTS.items()})


def _insufficient() -> dict[str, Column]:
    no_trend = F.coalesce("start_close", "end_close", "change").isNull() & F.col("change_pct").isNull()
    return {
        "analytics": F.when((F.col("count") == 0) | F.col("avg_close").isNull(), NO_ANALYTICS),
        "trend": F.when(no_trend, NO_TREND),
        "forecast": F.when(F.col("predicted_next_close").isNull(), NO_FORECAST),
        "risk_signal": F.when(F.col("signal").isin("unknown", "insufficient_data"), NO_RISK),
        "time_series": F.when(F.col("count") == 0, NO_SERIES),
    }


def insufficient_flags(report: DataFrame) -> DataFrame:
    """Per series and metric of a metrics report the reason why it says nothing, null if it does."""
    return report.select(*SERIES, *(reason.alias(name) for name, reason in _insufficient().items()))


def _json(fields: dict[str, Column]) -> Column:
    return F.to_json(F.struct(*(c.alias(n) for n, c in fields.items())), {"ignoreNullFields": "false"})


def fact_sheets(report: DataFrame) -> DataFrame:
    """A metrics report as one run per series and metric; decimals are rendered as text."""

    def text(name: str) -> Column:
        return number_text(F.col(name), report.schema[name].dataType)

    sheets = [
        ("get_analytics", "analytics", _json({
            "count": F.col("count"), "min_close": text("min_close"), "max_close": text("max_close"),
            "avg_close": text("avg_close"), "total_volume": F.col("total_volume"),
        })),
        ("get_trend", "trend", _json({
            "direction": F.col("direction"), "start_close": text("start_close"), "end_close": text("end_close"),
            "change": text("change"), "change_pct": text("change_pct"),
        })),
        ("get_forecast", "forecast", _json({
            "method": F.col("method"), "predicted_next_close": text("predicted_next_close"),
        })),
        ("get_risk_signal", "risk_signal", _json({
            "signal": F.col("signal"), "volatility_pct": text("volatility_pct"),
            "max_drawdown_pct": text("max_drawdown_pct"), "summary": F.col("summary"),
        })),
    ]
    missing = _insufficient()
    runs = F.array(*(
        F.struct(
            F.lit(i).alias("seq"), F.lit(name).alias("name"), payload.alias("raw"), missing[metric].alias("error")
        )
        for i, (name, metric, payload) in enumerate(sheets)
    ))
    return report.select(*SERIES, F.inline(runs))


def comparison_sheets(compared: DataFrame) -> DataFrame:
    """Compared pairs as JSON documents."""
    ids = ("source_id", "instrument_a_id", "instrument_b_id")

    def shown(name: str) -> Column:
        return F.col(name) if name.endswith("_count") else number_text(F.col(name), compared.schema[name].dataType)

    _, fields = REPORT_SENTENCES["compare_assets"]
    return compared.select(*ids, _json({name: shown(name) for name in fields}).alias("raw"))


def instrument_listing(current: DataFrame, *kept: str) -> DataFrame:
    """One JSON document per live instrument, with the columns that are ``kept``."""
    return current.select("instrument_id", *kept, _json({
        "instrument_id": F.col("instrument_id").cast("string"), "symbol": F.col("symbol"), "name": F.col("name"),
        "class": F.col("instrument_class"), "region": F.col("region"),
    }).alias("raw"))


def instrument_details(current: DataFrame) -> DataFrame:
    """One JSON document per live instrument, with its currency."""
    return current.select("instrument_id", _json({
        "instrument_id": F.col("instrument_id").cast("string"), "symbol": F.col("symbol"), "name": F.col("name"),
        "class": F.col("instrument_class"), "region": F.col("region"), "currency": F.col("currency"),
    }).alias("raw"))


def source_listing(sources: DataFrame) -> DataFrame:
    """One JSON document per data source."""
    return sources.select("source_id", _json({
        "source_id": F.col("source_id").cast("string"), "name": F.col("source_name"), "type": F.col("source_type"),
    }).alias("raw"))


def _report_line(name: Column, raw: Column, items: Column) -> Column:
    """The sentence of one successful result; null for results a report does not show.

    ``items`` is how long a list is of which ``raw`` has only the start, else null.
    """
    line = F.lit(None).cast("string")
    for kind, (title, fields) in REPORT_SENTENCES.items():
        shown = F.concat_ws(", ", *(
            F.concat(F.lit(f"{field}="), or_none(F.get_json_object(raw, f"$.{field}"))) for field in fields
        ))
        is_object = F.substring(F.trim(raw), 1, 1) == "{"
        line = F.when((name == kind) & is_object, F.concat(F.lit(title), shown, F.lit("."))).otherwise(line)
    listed = F.from_json(raw, "array<struct<symbol:string,instrument_id:string>>")
    samples = F.transform(F.slice(listed, 1, 5), lambda i: F.concat(
        F.coalesce(i["symbol"], F.lit("?")), F.lit(" ("), F.coalesce(i["instrument_id"], F.lit("?")), F.lit(")")
    ))
    found = F.concat(
        F.lit("Found "), F.coalesce(items, F.size(listed)).cast("string"), F.lit(" instruments in the warehouse."),
        F.when(F.size(listed) > 0, F.concat(
            F.lit("\nSample instruments: "), F.array_join(samples, ", "), F.lit(".")
        )).otherwise(""),
    )
    is_array = F.substring(F.trim(raw), 1, 1) == "["
    fetched = F.concat(
        F.lit("Fetched "), F.json_array_length(raw).cast("string"), F.lit(" time-series rows.")
    )
    line = F.when((name == "list_instruments") & is_array, found).otherwise(line)
    return F.when((name == "get_time_series") & is_array, fetched).otherwise(line)


def grounded_reports(runs: DataFrame, key: Sequence[str]) -> DataFrame:
    """Report text per key: a sentence for the last successful result of each kind, then the evidence.

    Runs may have ``items``, the length of a list whose ``raw`` is cut off after its first entries. However many runs a key has, at most one per kind and the last few are brought together.
    """
    keys = list(key)
    good = runs.where(F.col("error").isNull())
    items = F.col("items") if "items" in runs.columns else F.lit(None).cast("long")
    last = newest(good, [*keys, "name"], F.col("seq").desc())
    place = F.array_position(F.array(*(F.lit(n) for n in REPORT_ORDER)), F.col("name"))
    lines = last.select(*keys, place.alias("_place"), _report_line(F.col("name"), F.col("raw"), items).alias("_line"))
    body = lines.where(F.col("_line").isNotNull()).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("_place", "_line"))).alias("_lines")
    ).select(*keys, F.col("_lines._line").alias("_lines"))
    shown = F.concat(F.lit("- "), F.col("name"), F.lit(": "), snippet(F.col("raw")))
    evidence = newest_n(good, keys, EVIDENCE_RUNS, F.col("seq").desc()).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("seq", shown.alias("_shown")))).alias("_evidence")
    ).select(*keys, F.col("_evidence._shown").alias("_evidence"))
    totals = runs.groupBy(*keys).agg(F.count_if(F.col("error").isNotNull()).alias("_failed"))
    answer = F.concat(
        F.coalesce("_lines", F.array(F.lit(NOTHING_USABLE))),
        F.when(F.col("_failed") > 0, F.array(F.lit(SOME_FAILED))).otherwise(F.array().cast("array<string>")),
        F.array(F.lit(""), F.lit(EVIDENCE_TITLE)),
        F.col("_evidence"),
    )
    return totals.join(body, keys, "left").join(evidence, keys, "left").select(
        *keys, F.when(F.col("_evidence").isNull(), NOTHING_WORKED).otherwise(F.array_join(answer, "\n")).alias("report")
    )


def question_log_rows(answers: DataFrame) -> DataFrame:
    """Log rows: the names of the runs joined by ", ", null if there was none."""
    tools = F.when(F.size("tools") > 0, F.array_join("tools", ", "))
    return answers.select(
        *(c for c in answers.columns if c != "tools"), tools.alias("tools_invoked")
    )


def tool_usage(log: DataFrame) -> DataFrame:
    """How often each kind of result was requested."""
    return log.select(F.explode(F.split("tools_invoked", ", ")).alias("tool")).groupBy("tool").agg(
        F.count(F.lit(1)).alias("uses")
    )
