"""An index of identities that were stored: which of a batch's ids are there, without reading all ids again.

Ids lie in runs. A run is sorted by a 64-bit hash of the id and cut into files by ranges of it; for each file the run has the least and greatest
hash and a Bloom filter (about 24 bits an id, so one fresh id in some 50,000 passes it). A batch's hashes go to the tasks that hold the filters, at most
``sent`` of them, 8 bytes each; a file is opened only if a hash in its range passes its filter, and the ids in it decide. A larger batch is joined with
all files instead. Every batch adds a run; ``fanout`` runs of one level are merged into one of the next, so there are few.

The index follows its table: ``catch_up`` (or ``follow``, for a commit log) adds what the table has and the index lacks, so a writer that broke off between the two loses
nothing, and an index that is not there yet is built. What it holds is in one small manifest file, of which the newest version counts. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lazaret.sources import storage

_PROBES, _BITS = 10, 24
FILTER = "part int, n long, low long, high long, bits binary"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _places(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The filter's bits of each hash, a row per probe; ``bits`` is a power of two."""
    h = hashes.astype(np.int64).view(np.uint64)
    step = (h * _ODD >> np.uint64(7)) | np.uint64(1)
    return np.array([(h + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(_PROBES)], np.int64)


def bloom(hashes: np.ndarray) -> bytes:
    bits = 1 << max(10, int(len(hashes) * _BITS - 1).bit_length())
    held = np.zeros(bits, np.uint8)
    for places in _places(hashes, bits):
        held[places] = 1
    return np.packbits(held).tobytes()


def passing(hashes: np.ndarray, filter_: bytes) -> np.ndarray:
    """Which hashes may be among those of a filter."""
    held = np.frombuffer(filter_, np.uint8)
    ok = np.ones(len(hashes), bool)
    for places in _places(hashes, len(held) * 8):
        ok &= (held[places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1).astype(bool)
    return ok


def _filtered(rows: pd.DataFrame) -> pd.DataFrame:
    h = rows["h"].to_numpy(np.int64)
    return pd.DataFrame([(int(rows["part"].iloc[0]), len(h), int(h.min()), int(h.max()), bloom(h))], columns=["part", "n", "low", "high", "bits"])


@dataclass(frozen=True)
class IdentityIndex:
    """``parts``: files of a run; by default as many as adaptive execution makes of its size."""

    path: str
    parts: int | None = None
    fanout: int = 8
    sent: int = 1_000_000

    def manifest(self, spark: SparkSession) -> dict:
        """Runs, what the index covers, and the version; empty before the first run."""
        found = sorted(n for n in storage.names(spark, f"{self.path}/manifest") if n.endswith(".json"))
        if not found:
            return {"version": -1, "runs": [], "covered": [], "place": -1, "garbage": []}
        return json.loads(storage.get_text(spark, f"{self.path}/manifest/{found[-1]}"))

    def _publish(self, spark: SparkSession, manifest: dict) -> None:
        for path in manifest.pop("old_garbage", []):
            storage.remove(spark, path)
        manifest["version"] += 1
        storage.put_text(spark, f"{self.path}/manifest/{manifest['version']:020d}.json", json.dumps(manifest))
        for name in storage.names(spark, f"{self.path}/manifest"):
            if name.endswith(".json") and int(name[:20]) < manifest["version"] - 1:
                storage.remove(spark, f"{self.path}/manifest/{name}")

    def catch_up(self, spark: SparkSession, batches: Sequence[str], rows: Callable[[list[str]], DataFrame]) -> None:
        """Add those batches of a table that are not covered; ``rows`` gives theirs, as a frame with a column ``id``."""
        manifest = self.manifest(spark)
        covered = set(manifest["covered"])
        missing = [n for n in batches if n not in covered]
        if missing:
            manifest["covered"] += missing
            self._add(spark, manifest, rows(missing))

    def follow(self, spark: SparkSession, place: int, rows: Callable[[int], DataFrame]) -> None:
        """Add what a log has up to a place; ``rows`` gives what lies beyond the place covered."""
        manifest = self.manifest(spark)
        if place > manifest["place"]:
            ids = rows(manifest["place"])
            manifest["place"] = place
            self._add(spark, manifest, ids)

    def _add(self, spark: SparkSession, manifest: dict, ids: DataFrame) -> None:
        manifest["old_garbage"], manifest["garbage"] = manifest["garbage"], []
        run = self._run(ids, 0)
        if run is not None:
            manifest["runs"].append(run)
        level = 0
        while len(due := [r for r in manifest["runs"] if r["level"] == level]) >= self.fanout:
            merged = self._run(self._ids(spark, [f for r in due for f in r["files"]]).select("id"), level + 1)
            manifest["runs"] = [r for r in manifest["runs"] if r not in due] + [merged]
            manifest["garbage"] += [r["path"] for r in due]
            level += 1
        self._publish(spark, manifest)

    def _run(self, ids: DataFrame, level: int) -> dict | None:
        """Write a run of different ids; None if there are none."""
        spark, path = ids.sparkSession, f"{self.path}/runs/{uuid.uuid4().hex}"
        own = ids.select("id").filter("id IS NOT NULL").withColumn("h", F.xxhash64("id"))
        # Cut by ranges of the hash, small ones put together by their measured size; equal ids are in one range.
        ranged = own.repartitionByRange("h") if self.parts is None else own.repartitionByRange(self.parts, "h")
        distinct = ranged.dropDuplicates(["id", "h"]).withColumn("part", F.spark_partition_id())
        distinct.write.partitionBy("part").parquet(f"{path}/ids")
        hashes = spark.read.schema("id string, h long, part int").parquet(f"{path}/ids").select("part", "h")
        hashes.groupBy("part").applyInPandas(_filtered, FILTER).write.parquet(f"{path}/filters")
        files = spark.read.schema(FILTER).parquet(f"{path}/filters").select("part", "n").collect()
        if not files:
            storage.remove(spark, path)
            return None
        return {"path": path, "level": level, "rows": sum(r["n"] for r in files), "files": [f"{path}/ids/part={r['part']}" for r in files]}

    def _ids(self, spark: SparkSession, files: list[str]) -> DataFrame:
        return spark.read.schema("id string, h long").parquet(*files)

    def candidates(self, ids: DataFrame) -> list[str]:
        """The files that may hold one of these ids."""
        spark = ids.sparkSession
        runs = self.manifest(spark)["runs"]
        if not runs:
            return []
        hashed = ids.select(F.xxhash64("id").alias("h"))
        if hashed.count() > self.sent:
            return [f for r in runs for f in r["files"]]
        own = np.sort(hashed.toPandas()["h"].to_numpy(np.int64))
        sent = spark.sparkContext.broadcast(own)

        def test(batches):
            mine = sent.value
            for batch in batches:
                hit = []
                for low, high, bits in zip(batch.column("low").to_pylist(), batch.column("high").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                    a, b = np.searchsorted(mine, low), np.searchsorted(mine, high, side="right")
                    hit.append(bool(b > a and passing(mine[a:b], bits).any()))
                kept = batch.filter(pa.array(hit, pa.bool_()))
                yield pa.RecordBatch.from_arrays([kept.column("run"), kept.column("part")], names=["run", "part"])

        run = F.regexp_extract(F.col("_metadata.file_path"), "/runs/([0-9a-f]+)/", 1).alias("run")
        filters = spark.read.schema(FILTER).parquet(*(f"{r['path']}/filters" for r in runs))
        found = filters.select("low", "high", "bits", "part", run).mapInArrow(test, "run string, part int").collect()
        return sorted(f"{self.path}/runs/{r['run']}/ids/part={r['part']}" for r in found)

    def known(self, ids: DataFrame) -> DataFrame | None:
        """The ids of a frame with a column ``id`` that are stored, each once; None if there are none."""
        spark = ids.sparkSession
        files = self.candidates(ids)
        if not files:
            return None
        found = self._ids(spark, files).join(ids.select("id"), "id", "left_semi").select("id").distinct()
        return None if found.isEmpty() else found
