"""Thresholds of the quality forests come from all labelled rows."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lazaret.llm import quality


def test_bad_rows_beyond_any_sample_count(spark):
    # Four bad rows among the 20,000 smallest hashes of ids, too few for a threshold, and 20 behind them.
    n = F.row_number().over(Window.orderBy(F.xxhash64("doc_id"), "doc_id"))
    rows = spark.range(22_000).withColumnRenamed("id", "doc_id").withColumn("n", n)
    bad = (F.col("n") <= 4) | (F.col("n") > 21_980)
    word = F.concat(F.when(bad, "word###").otherwise("wordabc"), F.lit(" "))
    words = F.transform(F.sequence(F.lit(1), F.lit(30)), lambda i: F.concat(word, (F.col("doc_id") * 31 + i).cast("string")))
    rows = rows.select("doc_id", (~bad).cast("int").alias("quality"), F.concat_ws(" ", words).alias("text")).cache()
    model = quality.fit(rows.select("doc_id", "text"), rows.select("doc_id", "quality"))
    judged = quality.judge(rows, model).join(rows.select("doc_id", "quality"), "doc_id")
    assert {(r["quality"], r["kept"]): r["count"] for r in judged.groupBy("quality", "kept").count().collect()} == {(1, True): 21_976, (0, False): 24}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_threshold_is_that_of_all_rows(spark, seed):
    rng = np.random.default_rng(seed)
    good, bad = np.round(rng.normal(9, 1, 3000), 2), np.round(rng.normal(6, 1.2, 300), 2)
    rows = [(True, float(x), False) for x in good] + [(False, float(x), i % 3 > 0) for i, x in enumerate(bad)]
    frame = spark.createDataFrame(rows, "_good boolean, p0 double, left boolean").repartition(5)
    g, b = np.sort(good), np.sort([x for i, x in enumerate(bad) if i % 3 > 0])
    best = None
    for below, at in zip(tries := np.unique(np.concatenate([g, b])), tries[1:]):
        lost, found = (g < at).sum(), (b < at).sum()
        if found >= 5 and lost <= 0.01 * len(g) and found / len(b) >= 20 * lost / len(g):
            best = max(best or (-1, 0), (found / len(b) - lost / len(g), -at, (at + below) / 2))
    assert quality._threshold(frame, "p0", F.col("left"), 0.01) == best[2]
    assert quality._threshold(frame, "p0", F.lit(False), 0.01) is None
