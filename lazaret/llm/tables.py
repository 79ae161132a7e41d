"""Written intermediate tables, and running totals that need no window over a hot group."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.sources.storage import work_folder


def cut(df: DataFrame, label: str) -> DataFrame:
    """The frame as a written table in the shared folder: lineage ends here, a lost executor costs nothing before it."""
    path = work_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sampled_ids(ids: DataFrame, id_col: str, rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest hash of their id (ties by id), all if there are fewer.

    A cut of the hashes that leaves about twice as many comes first, so that tasks hand on a bounded number.
    """
    total = ids.count()
    key = F.xxhash64(id_col)
    if total > 4 * rows:
        ids = ids.filter(key < int(-(2**63) + 2**64 * 2 * rows / total))
    return ids.orderBy(key, id_col).limit(rows)


def numbered(df: DataFrame, key: str, amount: str | None, label: str) -> DataFrame:
    """Adds ``part`` and ``before``: the sum of ``amount`` (None: the count) over the rows of the same
    key that come earlier in the frame as it is partitioned and sorted.

    Each task keeps its own totals, and the totals of earlier partitions are added from a small table
    with a row per partition and key, so that a hot key is spread over all tasks. A null key is a key.
    """
    fields = df.schema.fields
    schema = T.StructType([*fields, T.StructField("part", T.IntegerType()), T.StructField("before", T.LongType())])

    def count(batches):
        part, totals = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            keys = batch.column(key).to_pylist()
            add = [1] * len(keys) if amount is None else batch.column(amount).to_pylist()
            before = np.empty(len(keys), np.int64)
            for i, (k, n) in enumerate(zip(keys, add, strict=True)):
                before[i] = totals[k]
                totals[k] += n
            columns = [*batch.columns, pa.array(np.full(len(keys), part, np.int32)), pa.array(before)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "part", "before"])

    local = cut(df.mapInArrow(count, schema), label)
    n = F.lit(1) if amount is None else F.col(amount)
    sums = local.groupBy("part", F.col(key).alias("_key")).agg(F.sum(n).alias("_sum"))
    earlier = Window.partitionBy("_key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(F.col("part").alias("_part"), "_key", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    base = cut(base.filter("_base > 0"), f"{label}-base")
    joined = local.join(base, (F.col("part") == F.col("_part")) & F.col(key).eqNullSafe(F.col("_key")), "left")
    return joined.withColumn("before", F.col("before") + F.coalesce("_base", F.lit(0))).drop("_part", "_key", "_base")
