"""A table clustered by ranges of its lookup columns and a time, with a zone map: a lookup opens only files that can hold its rows.

Rows are cut into files by ranges of (columns, time), so a file holds neighbours, and a column value with very many rows spans many files, each
with its own span of time. The zone map has a row per file: the first and the last (columns, time) in it. A lookup compares the bounds it is
given with these and reads the files that are left, where Parquet's own statistics go on. A clustered copy is written whole under a new name and
appears by one rename; NULLs sort first and can be looked up.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.sources import storage


def cluster(df: DataFrame, path: str, columns: Sequence[str], time: str, files: int | None = None) -> bool:
    """Write a clustered copy of a table; False if there is one. ``files``: by default as many as adaptive execution makes of its size."""
    order = [*columns, time]

    def write(hidden: str) -> None:
        ranged = df.repartitionByRange(*order) if files is None else df.repartitionByRange(files, *order)
        ranged.withColumn("_part", F.spark_partition_id()).sortWithinPartitions(*order).write.partitionBy("_part").parquet(f"{hidden}/rows")
        rows = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType())])).parquet(f"{hidden}/rows")
        place = F.struct(*order)
        zones = rows.groupBy("_part").agg(F.min(place).alias("low"), F.max(place).alias("high"), F.count(F.lit(1)).alias("rows"))
        zones.write.parquet(f"{hidden}/zones")

    return storage.write_whole(df.sparkSession, path, write)


def lookup(
    spark: SparkSession, path: str, schema: T.StructType, values: Mapping[str, object], time: str, since: datetime | str | None = None, until: datetime | str | None = None
) -> DataFrame:
    """The rows with these values whose time lies from ``since`` up to before ``until``; ``values`` are of the clustered columns, in their order.

    A bound may be a text, which the session's time zone reads. Without bounds rows of any time count, those without one too. The driver gets a number per file that may hold such rows.
    """
    since, until = (None if b is None else F.lit(b).cast(schema[time].dataType) for b in (since, until))
    parts = [r["_part"] for r in _zones(spark, path, schema, values, time).filter(_overlaps(values, time, since, until)).select("_part").collect()]
    same = [F.col(c).eqNullSafe(F.lit(v)) for c, v in values.items()]
    same += [] if since is None else [F.col(time) >= since]
    same += [] if until is None else [F.col(time) < until]
    if not parts:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*(f"{path}/rows/_part={p}" for p in parts))
    for condition in same:
        rows = rows.filter(condition)
    return rows


def _zones(spark: SparkSession, path: str, schema: T.StructType, values: Mapping[str, object], time: str) -> DataFrame:
    place = T.StructType([schema[c] for c in (*values, time)])
    kind = T.StructType([T.StructField("_part", T.IntegerType()), T.StructField("low", place), T.StructField("high", place)])
    return spark.read.schema(kind).parquet(f"{path}/zones")


def _overlaps(values: Mapping[str, object], time: str, since: Column | None, until: Column | None) -> Column:
    """Whether a zone can hold such rows, column by column: bounds of a column only count while those before it are equal."""

    def beyond(side: str, sign: int) -> Column:
        # The side's place lies beyond the values looked for, in the order of the columns; NULL comes first.
        out, equal = F.lit(False), F.lit(True)
        for c, v in values.items():
            own, value = F.col(side)[c], F.lit(v)
            if v is None:
                further = own.isNotNull() if sign > 0 else F.lit(False)
            else:
                further = F.coalesce(own > value, F.lit(False)) if sign > 0 else F.coalesce(own < value, own.isNull())
            out, equal = out | (equal & further), equal & own.eqNullSafe(value)
        at = F.col(side)[time]
        if sign > 0 and until is not None:
            out = out | (equal & F.coalesce(at >= until, F.lit(False)))
        if sign < 0 and since is not None:
            out = out | (equal & F.coalesce(at < since, at.isNull()))
        return out

    return ~beyond("low", 1) & ~beyond("high", -1)
