"""Tables the engine appends to, and plain dataset writes."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.contracts import Contract, conform, enforce, missing_required, violations
from lazaret.functions.identity import stamp
from lazaret.sources import storage
from lazaret.sources.identities import IdentityIndex
from lazaret.sources.readers import read_table


@dataclass(frozen=True)
class Table:
    """A table under a contract: a folder of Parquet files, or a database table behind JDBC.

    ``partition_by`` lays the files out by columns that are looked up, such as topic and status. A folder keeps an index of
    its identities (``identities``) beside the batches.
    """

    contract: Contract
    path: str | None = None
    url: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)
    partition_by: Sequence[str] = ()


def write_dataset(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, replacing what is there."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def scan(spark: SparkSession, table: Table) -> DataFrame:
    """The contract's columns of the whole table; no rows before the first append."""
    schema = table.contract.schema
    if table.url is not None:
        return read_table(
            spark,
            url=table.url,
            table=table.contract.name,
            properties=table.properties,
            predicates=_identity_ranges(table),
        ).select(*schema.fieldNames())
    if not storage.has_match(spark, f"{table.path}/batch=*"):
        return spark.createDataFrame([], schema)
    return (
        spark.read.schema(schema)
        .option("basePath", table.path)
        .parquet(f"{table.path}/batch=*")
        .select(*schema.fieldNames())
    )


def append_table(
    df: DataFrame, table: Table, batch_id: int | str | None = None
) -> dict[str, int] | None:
    """Append a batch, once; returns the rows ``offered`` and ``rejected``, None for a repeated batch.

    A folder's identities are looked up in its index, which opens the files that may hold one of the batch's.

    Rows are projected to the contract. One that lacks a required value is rejected: it goes to the
    rejects (``rejects``) with the reason. Rows whose identity is stored already, by whatever batch,
    are left out, so a table needs one writer at a time. Without a number the batch gets a new name;
    a number has to name the same rows for ever.

    A folder gets one subfolder per batch, which appears whole. A database gets its rows in one
    transaction per task, and a batch that broke off half way is completed by its repetition; its
    rejects are then written again.
    """
    batch = uuid.uuid4().hex if batch_id is None else batch_id
    spark, contract = df.sparkSession, table.contract
    path = f"{table.path}/batch={batch}"
    if table.url is None and storage.exists(spark, path):
        return None
    seen = Observation()
    rows = conform(df, contract)
    counted = rows.observe(
        seen,
        F.count(F.lit(1)).alias("offered"),
        F.count_if(missing_required(contract).isNotNull()).alias("rejected"),
    )
    if table.url is not None:
        create_table(spark, table)
        fresh = enforce(counted, contract, scan(spark, table))
        _write_database(fresh, table, contract.name)
    else:
        staged = storage.hidden_beside(path)
        unique = enforce(counted, contract)
        unique.write.partitionBy(*table.partition_by).parquet(staged)
        staged = _without_stored(spark, table, staged)
    counts = seen.get
    if counts.get("rejected"):
        _append_rejects(rows, table, batch)
    if table.url is None:
        storage.reveal(spark, staged, path)
    return counts


def identity_index(table: Table) -> IdentityIndex:
    return IdentityIndex(f"{table.path}/_identities")


def _without_stored(spark: SparkSession, table: Table, staged: str) -> str:
    """The folder of a batch less the identities stored before; ``staged`` itself if there are none.

    The index first takes up the batches that it lacks, as a rule the one before this.
    """
    key, columns = table.contract.unique, table.contract.schema.fieldNames()
    schema = table.contract.schema

    def ids(batches: list[str]) -> DataFrame:
        return spark.read.schema(schema).parquet(*(f"{table.path}/{n}" for n in batches)).select(F.col(key).alias("id"))

    index = identity_index(table)
    stored = sorted(n for n in storage.names(spark, table.path) if n.startswith("batch="))
    index.catch_up(spark, stored, ids)
    batch = spark.read.schema(schema).parquet(staged).select(*columns)
    again = index.known(batch.select(F.col(key).alias("id")))
    if again is None:
        return staged
    rest = storage.hidden_beside(f"{table.path}/batch")
    fresh = batch.join(again, F.col(key) == F.col("id"), "left_anti").select(*columns)
    fresh.write.partitionBy(*table.partition_by).parquet(rest)
    return rest


def _append_rejects(rows: DataFrame, table: Table, batch: int | str) -> None:
    refused = violations(rows, table.contract)
    if table.url is not None:
        _write_database(refused, table, f"{table.contract.name}_rejects")
        return
    storage.write_whole(
        rows.sparkSession,
        f"{table.path}/rejects/batch={batch}",
        lambda path: refused.write.parquet(path),
    )


def rejects(spark: SparkSession, table: Table) -> DataFrame:
    """The rows the contract refused: its columns and ``violation``, the required ones that lacked a value."""
    schema = T.StructType(
        [*table.contract.schema.fields, T.StructField("violation", T.StringType())]
    )
    if table.url is not None:
        name, properties = f"{table.contract.name}_rejects", table.properties
        return read_table(spark, url=table.url, table=name, properties=properties)
    if not storage.exists(spark, f"{table.path}/rejects"):
        return spark.createDataFrame([], schema)
    found = spark.read.schema(schema).option("basePath", f"{table.path}/rejects")
    return found.parquet(f"{table.path}/rejects/batch=*").select(*schema.fieldNames())


def _write_database(df: DataFrame, table: Table, name: str) -> None:
    df.write.jdbc(table.url, name, mode="append", properties=dict(table.properties))


def create_table(spark: SparkSession, table: Table) -> None:
    """Create the database table of a contract unless it exists.

    Texts that identify a row get a bounded type, since some databases cannot compare their large
    text type.
    """
    names = table.contract.schema.fieldNames()
    bounded = {"message_id": "VARCHAR(64)", "topic": "VARCHAR(255)", "status": "VARCHAR(50)"}
    types = ", ".join(f"`{c}` {t}" for c, t in bounded.items() if c in names)
    spark.createDataFrame([], table.contract.schema).write.option(
        "createTableColumnTypes", types
    ).jdbc(table.url, table.contract.name, mode="ignore", properties=dict(table.properties))


def _identity_ranges(table: Table) -> list[str]:
    """Predicates that cut a database table by the first character of its identities, which are hex digests.

    Each range is read by a task of its own. Any text falls into one of them.
    """
    mark = "`" if table.url.startswith(("jdbc:mysql", "jdbc:mariadb")) else '"'
    key = f"{mark}{table.contract.unique}{mark}"
    bounds = "123456789abcdef"
    between = [f"{key} >= '{a}' AND {key} < '{b}'" for a, b in zip(bounds, bounds[1:])]
    return [f"{key} < '1' OR {key} IS NULL", *between, f"{key} >= 'f'"]


# Fixed value: rows of a CSV file. Texts may hold line ends, so a file is read by one task, however large the table is.
ROWS_PER_FILE = 50_000


def snapshot(df: DataFrame, root: str, name: str | None = None) -> str:
    """CSV with a header under ``root/NAME``, by default named after the current time; blanks around values stay, and so do
    the microseconds of times. Files have ``ROWS_PER_FILE`` rows at most."""
    if name is None:
        name = df.sparkSession.range(1).select(stamp()).first()[0]
    path = f"{root}/{name}"
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer = df.write.option("header", True).option("escape", '"').option("maxRecordsPerFile", ROWS_PER_FILE).options(**kept)
    writer.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path)
    return path
