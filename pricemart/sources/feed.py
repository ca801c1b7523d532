"""Landed vendor feed pages.

A page is one JSON document ``{datatable: {columns: [{name}], data: [[...]]}, meta: {next_cursor_id}}``.
Numbers are read as text, so that their digits are kept as sent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.schemas import FEED_PAGE

#: The column with the text of a page that cannot be used.
BROKEN = "broken"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages landed under a folder, one document per line; ``page`` names the file and cursor."""
    return with_page_name(spark.read.schema(with_broken()).option("columnNameOfCorruptRecord", BROKEN).json(path))


def with_broken() -> T.StructType:
    """The schema of pages with the text of those that cannot be parsed."""
    return T.StructType([*FEED_PAGE.fields, T.StructField(BROKEN, T.StringType())])


def with_page_name(pages: DataFrame) -> DataFrame:
    """``page`` names the file and cursor; ``landed`` orders pages by file and part of the file."""
    cursor = F.coalesce(F.col("meta.next_cursor_id"), F.lit(""))
    path, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    return pages.withColumns({
        "page": F.concat(path, F.lit("#"), cursor), "landed": F.struct(path.alias("file"), start.alias("start")),
    })


def parse_pages(documents: DataFrame, text: str) -> DataFrame:
    """Pages given as JSON text in column ``text``."""
    page = F.from_json(text, FEED_PAGE)
    table = F.col("_page.datatable")
    return documents.withColumn("_page", page).select(
        *(c for c in documents.columns if c != text),
        table.alias("datatable"), F.col("_page.meta").alias("meta"), F.when(table.isNull(), F.col(text)).alias(BROKEN),
    )


def page_failures(pages: DataFrame) -> DataFrame:
    """(source_id, instrument_id, error) for every source with pages that hold no table, broken ones included.

    Such a page names no instrument. The pages are counted map-side; their texts stay in ``broken``.
    """
    lost = pages.where(F.col("datatable").isNull()).groupBy("source_id").agg(F.count(F.lit(1)).alias("_n"))
    error = F.concat(F.col("_n").cast("string"), F.lit(" pages could not be read"))
    return lost.select("source_id", F.lit(None).cast("string").alias("instrument_id"), error.alias("error"))


def page_records(pages: DataFrame) -> DataFrame:
    """One name-to-text map per data row, with the row's ``position`` in its page.

    Names and values pair up to the shorter of the two; a repeated name keeps its last value.
    """
    if "landed" in pages.columns:
        # within a part of a file, lines are numbered as they come
        pages = pages.withColumn("landed", F.struct("landed.*", F.monotonically_increasing_id().alias("line")))
    kept = [c for c in pages.columns if c not in ("datatable", "meta", BROKEN)]
    # names are made ready once per page, not with each of its rows
    names = F.transform("datatable.columns", lambda c: F.coalesce(c["name"], F.lit("")))
    tables = pages.select(*kept, names.alias("_names"), F.col("datatable.data").alias("_data"))
    # outer, as Spark would otherwise look for empty tables first, by parsing every page once more
    rows = tables.select(*kept, "_names", F.posexplode_outer("_data").alias("position", "_values")).where("position IS NOT NULL")
    return rows.select(*kept, "position", _zip(F.col("_names"), F.col("_values")).alias("record"))


def _zip(names: Column, values: Column) -> Column:
    names = F.coalesce(names, F.array().cast("array<string>"))
    pairs = F.least(F.size(names), F.size(values))
    cut = F.map_from_arrays(F.slice(names, F.lit(1), pairs), F.slice(values, F.lit(1), pairs))
    return F.when(F.size(names) == F.size(values), F.map_from_arrays(names, values)).otherwise(cut)
