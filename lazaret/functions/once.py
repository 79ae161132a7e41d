"""Evaluate a costly expression once per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """``withColumns`` for new columns that later filters must not evaluate again.

    A filter on a column is moved below the projection that computes it, with a copy of the
    expression for each mention, so a parsed message or a hash would be computed many times per row.
    A generator is a line the optimizer does not move filters across when they use its output; here
    it is one that gives exactly one row, and it stays inside the same generated code.
    """
    row = F.struct(*(c.alias(name) for name, c in columns.items()))
    return df.select("*", F.inline(F.array(row)))
