"""A commit log over folders of Parquet files: what is in the log is there, whole, and nobody lists data folders.

A batch is written to a folder of its own below ``data``, its files are then named in one small file below ``commits``, numbered
by place. That file makes the batch appear, all routes at once, without renaming a folder, so stores that cannot do that serve too.
A reader lists ``commits`` alone and opens the files of the places it wants. A commit also tells how far its writer has read other logs,
so output and position are one step, and a writer that broke off goes on from its last commit; files it left behind are in no commit.

``compact`` folds neighbouring commits into larger files, whose rows keep their places: who stands in the middle of a folded range
reads the rest of it by place. The new state is one file, and the commits it covers are deleted, so ``commits`` stays short. Data files that
are no longer named stay until ``vacuum``. A log has one writer at a time; a second one that takes the same place gets an error.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.sources import storage

PLACE = "_place"


@dataclass(frozen=True)
class File:
    route: str
    path: str
    size: int


@dataclass(frozen=True)
class Commit:
    """A batch, or a range of places folded into one; the files of a folded one have a column of places."""

    first: int
    last: int
    files: tuple[File, ...]
    rows: Mapping[str, int]
    batches: tuple[str, ...]
    consumed: Mapping[str, int] = field(default_factory=dict)

    @property
    def folded(self) -> bool:
        return self.last > self.first

    @property
    def size(self) -> int:
        return sum(f.size for f in self.files)


@dataclass(frozen=True)
class State:
    """The commits of a log in order."""

    commits: tuple[Commit, ...] = ()

    @property
    def last(self) -> int:
        return self.commits[-1].last if self.commits else -1

    @property
    def consumed(self) -> dict[str, int]:
        return dict(self.commits[-1].consumed) if self.commits else {}

    def after(self, place: int, most: int | None = None) -> list[Commit]:
        return [c for c in self.commits if c.last > place][:most]

    def has(self, batch: str) -> bool:
        return any(batch in c.batches for c in self.commits)


@dataclass(frozen=True)
class CommitLog:
    path: str

    @property
    def folder(self) -> str:
        return f"{self.path}/commits"

    def state(self, spark: SparkSession) -> State:
        """The log as it is now, from one listing and the files of the commits since the last folding."""
        for _ in range(5):
            names = sorted(n for n in storage.names(spark, self.folder) if n.endswith(".json"))
            whole = [n for n in names if n.endswith(".all.json")]
            read = whole[-1:] + [n for n in names if not n.endswith(".all.json") and (not whole or n[:20] > whole[-1][:20])]
            try:
                return State(tuple(c for n in read for c in _commits(storage.get_text(spark, f"{self.folder}/{n}"))))
            except FileNotFoundError:  # folded in between
                continue
        raise OSError(f"{self.folder} changes faster than it is read")

    def append(
        self,
        rows: DataFrame,
        routes: Sequence[str],
        batch: str | None = None,
        consumed: Mapping[str, int] | None = None,
    ) -> dict[str, int] | None:
        """Write rows by their ``route`` and commit them; the rows per route, None for a batch name that is there."""
        spark = rows.sparkSession
        state = self.state(spark)
        if batch is not None and state.has(batch):
            return None
        folder, counts = self.write(rows, routes)
        self.commit(spark, state, folder, counts, () if batch is None else batch, consumed)
        return counts

    def write(self, rows: DataFrame, routes: Sequence[str]) -> tuple[str, dict[str, int]]:
        """Write rows to a new data folder that no commit names yet; the folder and the rows per route."""
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        seen = Observation()
        counted = rows.observe(seen, *(F.count_if(F.col("route") == r).alias(r) for r in routes))
        counted.filter(F.col("route").isNotNull()).write.partitionBy("route").parquet(folder)
        return folder, {r: seen.get[r] for r in routes}

    def commit(
        self, spark: SparkSession, state: State, folder: str, rows: Mapping[str, int], batch: str | tuple[str, ...] = (), consumed: Mapping[str, int] | None = None
    ) -> Commit:
        """Make a written folder the next place of the log, under one or more batch names or none."""
        place = state.last + 1
        named = (batch,) if isinstance(batch, str) else tuple(batch)
        made = Commit(place, place, self._files(spark, folder), dict(rows), named, state.consumed | dict(consumed or {}))
        storage.put_text(spark, f"{self.folder}/{place:020d}.json", _text([made]))
        return made

    def _files(self, spark: SparkSession, folder: str) -> tuple[File, ...]:
        found = []
        for path, size in storage.files_below(spark, folder):
            parts = [p for p in path.split("/") if p.startswith("route=")]
            if parts and path.endswith(".parquet"):
                found.append(File(parts[-1][len("route=") :], path, size))
        return tuple(sorted(found, key=lambda f: f.path))

    def read(self, spark: SparkSession, schema: T.StructType, route: str, commits: Iterable[Commit], after: int = -1) -> DataFrame:
        """The rows of a route in these commits beyond a place, with the places as a column named ``_place`` last."""
        plain: dict[int, list[str]] = {}
        folded: list[str] = []
        for c in commits:
            own = [f.path for f in c.files if f.route == route]
            if c.folded:
                folded += own
            elif own:
                plain[c.last] = own
        placed = T.StructType([*schema.fields, T.StructField(PLACE, T.LongType())])
        parts = []
        if folded:
            parts.append(spark.read.schema(placed).parquet(*folded).filter(F.col(PLACE) > after))
        if plain:
            # A commit's files lie in one folder, which tells its place.
            places = {paths[0].split("/data/")[1].split("/")[0]: place for place, paths in plain.items()}
            folder = F.regexp_extract(F.col("_metadata.file_path"), "/data/([0-9a-f]+)/", 1)
            place = F.element_at(F.create_map(*(F.lit(x) for pair in places.items() for x in pair)), folder) if len(places) > 1 else F.lit(next(iter(places.values())))
            rows = spark.read.schema(schema).parquet(*(p for paths in plain.values() for p in paths))
            parts.append(rows.select(*schema.fieldNames(), place.cast("long").alias(PLACE)))
        if not parts:
            return spark.createDataFrame([], placed)
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def compact(self, spark: SparkSession, schemas: Mapping[str, T.StructType], file_bytes: int = 128 << 20, commit_bytes: int = 8 << 30) -> int:
        """Fold neighbouring commits of less than ``commit_bytes`` in all into one, in files of about ``file_bytes``; how many went.

        ``schemas`` gives the columns of each route. Rows are not shuffled: tasks read whole files and write one.
        """
        state = self.state(spark)
        groups: list[list[Commit]] = []
        for c in state.commits:
            if groups and sum(x.size for x in groups[-1]) + c.size <= commit_bytes:
                groups[-1].append(c)
            else:
                groups.append([c])
        if all(len(g) == 1 for g in groups):
            return 0
        commits = [g[0] if len(g) == 1 else self._folded(spark, g, schemas, file_bytes) for g in groups]
        storage.put_text(spark, f"{self.folder}/{state.last:020d}.all.json", _text(commits))
        covered = f"{state.last:020d}"
        for name in storage.names(spark, self.folder):
            if name[:20] <= covered and name != f"{covered}.all.json":
                storage.remove(spark, f"{self.folder}/{name}")
        return len(state.commits) - len(commits)

    def _folded(self, spark: SparkSession, group: list[Commit], schemas: Mapping[str, T.StructType], file_bytes: int) -> Commit:
        folder = f"{self.path}/data/{uuid.uuid4().hex}"
        for route, schema in schemas.items():
            size = sum(f.size for c in group for f in c.files if f.route == route)
            if size:
                rows = self.read(spark, schema, route, group)
                rows.coalesce(-(-size // file_bytes)).write.parquet(f"{folder}/route={route}")
        rows = {r: sum(c.rows.get(r, 0) for c in group) for r in {r for c in group for r in c.rows}}
        batches = tuple(b for c in group for b in c.batches)
        return Commit(group[0].first, group[-1].last, self._files(spark, folder), rows, batches, group[-1].consumed)

    def vacuum(self, spark: SparkSession) -> int:
        """Delete data folders that no commit names; only for a time when nobody writes or reads an older state."""
        kept = {f.path.split("/data/")[1].split("/")[0] for c in self.state(spark).commits for f in c.files}
        gone = [n for n in storage.names(spark, f"{self.path}/data") if n not in kept]
        for name in gone:
            storage.remove(spark, f"{self.path}/data/{name}")
        return len(gone)


def _text(commits: Iterable[Commit]) -> str:
    return "\n".join(json.dumps(asdict(c)) for c in commits)


def _commits(text: str) -> list[Commit]:
    out = []
    for line in text.splitlines():
        c = json.loads(line)
        out.append(Commit(c["first"], c["last"], tuple(File(**f) for f in c["files"]), c["rows"], tuple(c["batches"]), c["consumed"]))
    return out
