"""Automatic and manual correction of quarantined rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.functions.cleaning import INTEGERS, Policy, clean_number, number_text
from lazaret.functions.once import with_columns_once
from lazaret.sources import storage


def with_repairs(
    df: DataFrame, policies: Sequence[Policy], prefix: str = "_fixed_"
) -> DataFrame:
    """Add the repaired form of each column that has a policy, under ``prefix``.

    A policy that cleans starts from the typed value where there is one, else from the text as it came in, where the rows carry
    it, as for ``$12.50`` the typed column is NULL. Integers and decimals are read from the text of the number itself, so they
    stay exact whatever their size; other numbers are read in the precision of the way of cleaning. All texts of one way go through
    one array function, so the generated code does not grow with the number of columns.
    """
    texts = df.schema["text"].dataType.fieldNames() if _has_text(df) else []
    converted = {p.column: p.convert(F.col(p.column)) for p in policies if not p.clean}
    groups: dict[tuple[str, bool], list[Policy]] = {}
    for p in policies:
        if p.clean:
            decimal = isinstance(df.schema[p.column].dataType, T.DecimalType)
            groups.setdefault((p.clean, p.clean == "exponent" and (decimal or p.to in INTEGERS)), []).append(p)
    arrays = {}
    for (way, exact), own in groups.items():
        written = [F.col(p.column).cast("string") for p in own]
        if way == "strip":  # every value goes through its text as it came in
            dirty = [F.coalesce(F.col("text")[p.column], w) if p.column in texts else w for p, w in zip(own, written)]
        else:
            dirty = [F.coalesce(w, F.col("text")[p.column]) if p.column in texts else w for p, w in zip(own, written)]
        name = f"_{way}_{'exact' if exact else 'number'}"
        arrays[name] = F.transform(F.array(*dirty), _cleaner(way, exact))
        for i, p in enumerate(own):
            found = F.col(name)[i]
            if exact and p.to is None:
                found = found.try_cast(df.schema[p.column].dataType)
            converted[p.column] = p.convert(found)
    cleaned = with_columns_once(df, arrays) if arrays else df
    return cleaned.withColumns(
        {
            prefix + p.column: p.finish(converted[p.column]).try_cast(df.schema[p.column].dataType)
            for p in policies
        }
    ).drop(*arrays)


def _cleaner(way: str, exact: bool):
    return lambda text: number_text(text, way) if exact else clean_number(text, way)


def _has_text(df: DataFrame) -> bool:
    return "text" in df.columns and isinstance(df.schema["text"].dataType, T.StructType)


def repair(df: DataFrame, policies: Sequence[Policy]) -> DataFrame:
    """Apply all policies."""
    fixed = {p.column for p in policies}
    return with_repairs(df, policies).select(
        *(F.col(f"_fixed_{c}").alias(c) if c in fixed else F.col(c) for c in df.columns)
    )


def overlay(
    df: DataFrame,
    fixes: DataFrame,
    columns: Sequence[str],
    key: str = "message_id",
    newest: Sequence[Column] | None = None,
) -> DataFrame:
    """Manual correction: replace ``columns`` by the values a fix gives for the row's key.

    A NULL in a fix leaves the value alone. Several fixes of one key are reduced to one before the
    join, the first by ``newest`` (all columns, descending, unless given); the ranking runs before
    the shuffle too, so a key with very many fixes does not gather in one task. The join strategy is
    left to the adaptive planner, which broadcasts by measured size and splits skewed keys.
    Adds ``corrected``: whether a fix was found.
    """
    order = newest or [F.col(c).desc_nulls_last() for c in columns]
    one_fix = (
        fixes.filter(F.col(key).isNotNull())
        .withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy(*order)))
        .filter("_rank = 1")
        .select(key, F.struct(*columns).alias("_fix"))
    )
    joined = df.join(one_fix, key, "left")
    replaced = {c: F.coalesce(F.col("_fix")[c], F.col(c)) for c in columns}
    return joined.withColumns(replaced | {"corrected": F.col("_fix").isNotNull()}).drop("_fix")


def overlay_as_of(
    df: DataFrame,
    fixes: DataFrame,
    columns: Sequence[str],
    key: str = "message_id",
    at: str = "timestamp",
    valid_from: str = "valid_from",
) -> DataFrame:
    """Manual correction by versioned fixes: replace ``columns`` by the values of the last fix of the row's key that was valid
    at the row's time.

    A NULL in a fix leaves the value alone; of fixes of one key and time the greatest by ``columns`` counts. Rows without a key or a time
    stay as they are. Adds ``corrected``. Rows and fixes are put in order together by ranges of key and time, so a key with very many rows or
    versions is spread over tasks; only the last fix of a key in each range is handed on to the ranges behind it.
    """
    spark = df.sparkSession
    fix = F.struct(*(F.col(c).cast(df.schema[c].dataType).alias(c) for c in columns))
    rows = df.select(F.col(key).alias("_key"), F.col(at).cast("timestamp").alias("_at"), F.lit(None).cast(_struct_of(df, columns)).alias("_fix"), F.struct(*df.columns).alias("_row"))
    known = fixes.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull())
    known = known.groupBy(F.col(key).alias("_key"), F.col(valid_from).cast("timestamp").alias("_at")).agg(F.max(fix).alias("_fix"))
    both = known.withColumn("_row", F.lit(None).cast(rows.schema["_row"].dataType)).select(*rows.columns).union(rows)
    # A fix comes before the rows of its time.
    order = ["_key", "_at", F.col("_row").isNotNull()]
    path = storage.work_folder(spark, "as-of")
    placed = both.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*order, "_salt").withColumn("_part", F.spark_partition_id())
    placed.drop("_salt").write.parquet(path)
    placed = spark.read.schema(T.StructType([*both.schema.fields, T.StructField("_part", T.IntegerType())])).parquet(path)
    earlier = W.partitionBy("_key").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    held = placed.groupBy("_key", "_part").agg(F.max(F.when(F.col("_fix").isNotNull(), F.struct("_at", "_fix"))).alias("_last"))
    handed = held.select(F.col("_key").alias("_k"), F.col("_part").alias("_p"), F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    here = W.partitionBy("_part", "_key").orderBy("_at", F.col("_row").isNotNull()).rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = placed.withColumn("_now", F.last("_fix", ignorenulls=True).over(here)).filter("_row IS NOT NULL")
    joined = seen.join(handed, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_part") == F.col("_p")), "left")
    found = F.when(F.col("_key").isNotNull() & F.col("_at").isNotNull(), F.coalesce("_now", F.col("_before._fix")))
    out = joined.select(F.col("_row"), found.alias("_fix"))
    value = {c: F.coalesce(F.col("_fix")[c], F.col("_row")[c]) for c in columns}
    return out.select(*(value.get(c, F.col("_row")[c]).alias(c) for c in df.columns), F.col("_fix").isNotNull().alias("corrected"))


def _struct_of(df: DataFrame, columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, df.schema[c].dataType) for c in columns])
