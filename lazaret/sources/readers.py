"""Batch scans and the landing of raw files."""

from __future__ import annotations

import csv
import hashlib
import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import quote, unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.sources import storage
from lazaret.sources.commits import PLACE, CommitLog

# The file formats that are found and landed.
FORMATS = ("csv", "parquet")

#: How CSV is read unless the caller says otherwise.
RFC_4180 = {"header": True, "quote": '"', "escape": '"', "multiLine": True}


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    limit: int | None = None,
    sampling: float | None = None,
    options: Mapping[str, str | bool] | None = None,
) -> DataFrame:
    """CSV with a header row, quoted as RFC 4180 has it: a quote inside quotes is doubled, and quoted line ends belong to the value.

    ``options`` of Spark's reader come before these. A file with quoted line ends cannot be cut into splits, so for large files
    that are known to have none, ``{"multiLine": False}`` lets many tasks read one file.

    Without a schema the types are inferred, which reads the data once more (``sampling`` of it).
    With one, its fields are found by name, whatever their order in the header, which alone is read ahead; those the
    header lacks are not in the frame, and further columns of the file are left out. Several paths read together
    have one header; another one is an error. ``limit`` keeps so many rows, in no particular order (``head``).
    """
    given = RFC_4180 | dict(options or {})
    reader = spark.read.options(**given)
    paths = path if isinstance(path, str) else list(path)
    if schema is not None:
        declared = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
        header = reader.csv(paths).columns
        known = {f.name.lower(): f for f in declared.fields}
        own = [known.get(name.lower(), T.StructField(name, T.StringType())) for name in header]
        typed = spark.read.options(**given).schema(T.StructType(own)).option("enforceSchema", False)
        present = {name.lower() for name in header}
        df = typed.csv(paths).select(*(f"`{n}`" for n in declared.fieldNames() if n.lower() in present))
    else:
        reader = reader.option("inferSchema", True)
        if sampling is not None:
            reader = reader.option("samplingRatio", sampling)
        df = reader.csv(paths)
    return df if limit is None else head(df, limit)


def head(df: DataFrame, n: int) -> DataFrame:
    """``n`` rows of a scan of files, all if there are fewer, without bringing them into one task.

    Each task counts at most ``n`` of its rows; the driver turns these numbers, one per task, into a quota for each, and the tasks then
    hand on as many. Tasks stop reading at their quota. The frame has to cut into the same tasks both times, as scans do.
    """
    from pyspark import TaskContext

    def count(batches):
        held = 0
        for batch in batches:
            held = min(held + batch.num_rows, n)
            if held == n:
                break
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([held], pa.int64())], names=["part", "held"])

    quotas, left = {}, n
    for r in sorted(df.select(F.lit(1).alias("one")).mapInArrow(count, "part int, held long").collect()):
        quotas[r["part"]] = min(r["held"], left)
        left -= quotas[r["part"]]

    def take(batches):
        quota = quotas.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            if not quota:
                break
            yield batch.slice(0, quota)
            quota -= min(quota, batch.num_rows)

    return df.mapInArrow(take, df.schema)


def read_many(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType | str | None = None,
    options: Mapping[str, str | bool] | None = None,
) -> list[DataFrame]:
    """One frame per path, each with the columns and types of its own header."""
    return [read_csv(spark, path, schema, options=options) for path in paths]


def headers(spark: SparkSession, paths: Sequence[str], sep: str = ",") -> dict[tuple[str, ...], list[str]]:
    """Files by their header row, from one job over all of them; the driver gets a line per file.

    A header is the first line of a file, so names may be quoted but hold no line ends. Empty files are left out.
    """
    lines = spark.read.text(list(paths)).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    placed = lines.filter("start = 0").withColumn("place", F.monotonically_increasing_id())
    first = placed.groupBy("file").agg(F.min_by("value", "place").alias("line"))
    out: dict[tuple[str, ...], list[str]] = {}
    for r in sorted(first.collect()):
        out.setdefault(tuple(next(csv.reader([r["line"].removeprefix("\ufeff")], delimiter=sep), [])), []).append(unquote(r["file"]))
    return out


# Numbers by what they can hold, and times likewise; two that share no list are read as text.
_WIDER = (("integer", "long", "double"), ("date", "timestamp"))


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both."""
    if a == b:
        return a
    names = {a.typeName(), b.typeName()}
    if "void" in names:
        return b if a.typeName() == "void" else a
    for order in _WIDER:
        if names <= set(order):
            return max((a, b), key=lambda t: order.index(t.typeName()))
    return T.StringType()


def read_grouped(
    spark: SparkSession, paths: Sequence[str], schema: T.StructType | str | None = None, options: Mapping[str, str | bool] | None = None
) -> list[DataFrame]:
    """One frame per different header among any number of files, with types that fit all files.

    Files of one header are read, and their types inferred, together; then a column has the widest of its types in any of the frames, so
    the number of jobs goes with the headers and not with the files.
    """
    groups = headers(spark, paths, str((options or {}).get("sep", ",")))
    if schema is not None:
        return [read_csv(spark, files, schema, options=options) for files in groups.values()]
    found = [read_csv(spark, files, options=options) for files in groups.values()]
    types: dict[str, T.DataType] = {}
    for f in (f for df in found for f in df.schema.fields):
        types[f.name] = wider(types.get(f.name, f.dataType), f.dataType)
    declared = [T.StructType([T.StructField(f.name, types[f.name]) for f in df.schema.fields]) for df in found]
    return [
        df if [f.dataType for f in df.schema.fields] == [f.dataType for f in own.fields] else read_csv(spark, files, own, options=options)
        for df, files, own in zip(found, groups.values(), declared, strict=True)
    ]


def read_table(
    spark: SparkSession,
    path: str | None = None,
    url: str | None = None,
    table: str | None = None,
    properties: Mapping[str, str] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """All columns of a stored table: Parquet files by path, or a database table by JDBC address.

    ``predicates`` split a JDBC read into one partition each; without them one task reads it all.
    """
    if path is not None:
        return spark.read.parquet(path)
    if predicates is not None:
        return spark.read.jdbc(
            url, table, predicates=list(predicates), properties=dict(properties or {})
        )
    return spark.read.jdbc(url, table, properties=dict(properties or {}))


def discover(spark: SparkSession, root: str, formats: Sequence[str] = FORMATS) -> DataFrame:
    """Files below ``root`` with one of the suffixes: ``path``, ``modificationTime``, ``length``.

    Only the listing is used; the content column is pruned, so no file is opened.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.{" + ",".join(formats) + "}")
        .load(root)
        .select("path", "modificationTime", "length")
    )


def any_files(spark: SparkSession, root: str, formats: Sequence[str] = FORMATS) -> bool:
    return not discover(spark, root, formats).isEmpty()


# The schemes raw files are landed on, with the names Arrow has for them.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}


def _located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a full path and the path in it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme not in SCHEMES:
        raise ValueError(f"raw files are landed on {', '.join(SCHEMES)}, not on {scheme}: read and write them with Spark")
    return fs.FileSystem.from_uri(quote(f"{SCHEMES[scheme]}:{rest}", safe=":/@"))


def _copy_file(source: str, target: str, known: str | None = None) -> tuple[int, str]:
    """Copy the bytes of a file; it appears under its name when it is whole. Returns their number and SHA-256.

    With the digest ``known`` of what is there, a file with the same bytes leaves it alone.
    """
    here, path = _located(source)
    there, name = _located(target)
    folder = name.rsplit("/", 1)[0]
    there.create_dir(folder, recursive=True)
    part = f"{folder}/_{uuid.uuid4().hex}"
    digest = hashlib.sha256()
    with here.open_input_stream(path) as data:
        if known is not None:
            while block := data.read(1 << 20):
                digest.update(block)
            if digest.hexdigest() == known:
                return there.get_file_info(name).size, known
    digest = hashlib.sha256()
    with here.open_input_stream(path) as data, there.open_output_stream(part) as copy:
        while block := data.read(1 << 20):
            digest.update(block)
            copy.write(block)
    if there.get_file_info(name).type != fs.FileType.NotFound:
        there.delete_file(name)
    there.move(part, name)
    return there.get_file_info(name).size, digest.hexdigest()


def land_raw(
    spark: SparkSession, root: str, target: str, formats: Sequence[str] = FORMATS
) -> DataFrame:
    """Copy each file found below ``root`` to the same place below ``target/raw``, byte for byte.

    Returns ``path``, ``landed`` and ``length`` of the files, written to ``target/_landed`` as the record of the
    run. The tasks copy, each file as a stream of blocks, so neither contents nor names pass through the driver.
    A task that is repeated copies its files again; a file that is there already is replaced. Storage is reached through
    ``pyarrow.fs`` on the schemes in ``SCHEMES``, with the credentials of the environment, not those of Spark; another scheme is an error
    before anything is copied.
    """
    base, raw = storage.full_path(spark, root), storage.full_path(spark, f"{target}/raw")
    record = f"{target}/_landed/{uuid.uuid4().hex}"
    for place in (base, raw):
        if place.partition(":")[0] not in SCHEMES:
            _located(place)

    def copy(batches):
        for batch in batches:
            sources = batch.column("path").to_pylist()
            landed = [f"{raw}/{source[len(base) :].lstrip('/')}" for source in sources]
            sizes = [_copy_file(a, b)[0] for a, b in zip(sources, landed, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(landed), pa.array(sizes, pa.int64())],
                names=["path", "landed", "length"],
            )

    schema = "path string, landed string, length long"
    discover(spark, root, formats).select("path").mapInArrow(copy, schema).write.parquet(record)
    return spark.read.schema(schema).parquet(record)


LANDED = T.StructType([T.StructField(n, k()) for n, k in {
    "path": T.StringType, "modified": T.TimestampType, "length": T.LongType, "digest": T.StringType, "copied": T.BooleanType}.items()])


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """What was landed below ``target`` and how each file was when it was last looked at."""
    log = CommitLog(f"{target}/_manifest")
    rows = log.read(spark, LANDED, "landed", log.state(spark).commits)
    latest = rows.groupBy("path").agg(F.max_by(F.struct("modified", "length", "digest"), PLACE).alias("r"))
    return latest.select("path", "r.*")


def land_changed(spark: SparkSession, root: str, target: str, formats: Sequence[str] = FORMATS) -> DataFrame:
    """Land the files below ``root`` as ``land_raw`` does, but only those that changed since the last time; returns those that were looked at,
    with ``copied``.

    A file with the time and length of the manifest is not opened. One with another time is read, and copied if its digest is another. The
    manifest is a commit log, so a run that broke off is simply done again; files that are gone at the root stay landed.
    """
    base, raw = storage.full_path(spark, root), storage.full_path(spark, f"{target}/raw")
    for place in (base, raw):
        if place.partition(":")[0] not in SCHEMES:
            _located(place)
    known = manifest(spark, target).select("path", F.col("modified").alias("_modified"), F.col("length").alias("_length"), F.col("digest").alias("_digest"))
    listed = discover(spark, root, formats).select("path", F.col("modificationTime").alias("modified"), "length").join(known, "path", "left")
    same = F.col("modified").eqNullSafe(F.col("_modified")) & F.col("length").eqNullSafe(F.col("_length"))
    due = listed.filter(~same).select("path", "modified", "_digest")

    def copy(batches):
        for batch in batches:
            done = []
            for path, digest in zip(batch.column("path").to_pylist(), batch.column("_digest").to_pylist(), strict=True):
                size, found = _copy_file(path, f"{raw}/{path[len(base) :].lstrip('/')}", digest)
                done.append((size, found, found != digest))
            sizes, digests, copied = zip(*done, strict=True) if done else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), batch.column("modified"), pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), pa.array(copied, pa.bool_())],
                names=LANDED.names,
            )

    log = CommitLog(f"{target}/_manifest")
    state = log.state(spark)
    folder, counts = log.write(due.mapInArrow(copy, LANDED).withColumn("route", F.lit("landed")), ["landed"])
    if not counts["landed"]:
        return spark.createDataFrame([], LANDED)
    made = log.commit(spark, state, folder, counts)
    return log.read(spark, LANDED, "landed", [made]).drop(PLACE)
