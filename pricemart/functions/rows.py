"""Columns that are computed once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once_per_row(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with more columns, which no later filter or projection computes a second time.

    Where the columns are plain expressions without lambdas, all of it is generated code.
    """
    made = F.inline(F.array(F.struct(*(c.alias(name) for name, c in columns.items()))))
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c not in columns), made)
