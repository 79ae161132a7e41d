"""Union by column name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(dfs: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All rows of all inputs, columns matched by name; duplicates stay and types widen.

    A column missing on one side is an error unless ``allow_missing`` fills it with NULL. Catalyst
    flattens the chain into one union.
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)
