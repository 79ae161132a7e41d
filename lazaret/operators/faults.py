"""Repeatable fault injection: which rows to damage, how, and in which field.

The plan is a function of a row's key, so it is the same on every run, in every partitioning and
in any engine that has MD5.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.functions.codec import encode
from lazaret.functions.once import with_columns_once

# What is written on the wire in place of a value that is not a number.
INVALID_TEXT = "invalid_value"

FAILURE_RATE = 0.01


def digest(key: Sequence[str], seed: int) -> Column:
    parts = [F.lit(str(seed)), *(F.col(k).cast("string") for k in key)]
    return F.md5(F.concat_ws(":", *parts))


def rate_limit(rate: float) -> str:
    """Eight hex digits; a digest whose first eight sort below them is damaged."""
    return "g" if rate >= 1 else f"{math.ceil(rate * 2**32):08x}"


def field_limits(fields: Sequence[str]) -> list[str]:
    """Eight hex digits per field: the upper ends of equal slices of their range, the last one open."""
    return [f"{-(-i * 2**32 // len(fields)):08x}" for i in range(1, len(fields))] + ["g"]


def plan(
    df: DataFrame,
    key: Sequence[str],
    fields: Sequence[str],
    rate: float = FAILURE_RATE,
    seed: int = 42,
) -> DataFrame:
    """Add ``fault``, and for a row to damage ``kind`` (missing_field, invalid_value) and ``field``."""
    d = F.col("_digest")
    slot = F.substring(d, 10, 8)
    name = F
    for field, limit in zip(fields, field_limits(fields)):
        name = name.when(slot < limit, F.lit(field))
    kind = F.when(F.substring(d, 9, 1) < "8", "missing_field").otherwise("invalid_value")
    fault = F.substring(d, 1, 8) < rate_limit(rate)
    return with_columns_once(
        df.withColumn("_digest", digest(key, seed)),
        {"fault": fault, "kind": F.when(fault, kind), "field": F.when(fault, name)},
    ).drop("_digest")


def inject(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Carry out the plan on ``fields``.

    A missing field becomes NULL, which ``to_json`` leaves out. An invalid number gets a negative
    sign, any other value becomes the text ``invalid_value``. A typed column cannot hold that text in
    place of an absent number; ``wire_record`` can.
    """
    columns = {}
    for name in fields:
        here, value = F.col("field") == name, F.col(name)
        invalid = -F.abs(value) if _is_number(df, name) else F.lit(INVALID_TEXT)
        columns[name] = (
            F.when(here & (F.col("kind") == "missing_field"), F.lit(None))
            .when(here & (F.col("kind") == "invalid_value"), invalid)
            .otherwise(value)
        )
    return df.withColumns(columns)


def wire_record(df: DataFrame, schema: T.StructType, fields: Sequence[str]) -> Column:
    """The JSON of an injected row: numbers stay numbers, and where the plan wanted an invalid number
    but there was none, the field is the text ``invalid_value``."""
    texts = {}
    for name in fields:
        if _is_number(df, name):
            wanted = (F.col("kind") == "invalid_value") & (F.col("field") == name)
            texts[name] = F.when(wanted & F.col(name).isNull(), F.lit(INVALID_TEXT))
    return encode(df, schema, instead=texts)


def _is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.NumericType)
