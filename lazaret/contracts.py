"""Schemas of messages and tables, and their constraints."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_of(**types: str) -> T.StructType:
    """A schema from names and simple type names; unlike DDL text it needs no session."""
    schema = T.StructType()
    for name, kind in types.items():
        schema = schema.add(name, kind)
    return schema


ENVELOPE = schema_of(
    key="string",
    value="string",
    topic="string",
    partition="integer",
    offset="long",
    timestamp="timestamp",
)

# The fields of a trip message, in order, with their types.
TRIP = schema_of(
    VendorID="integer",
    tpep_pickup_datetime="string",
    tpep_dropoff_datetime="string",
    passenger_count="integer",
    trip_distance="float",
    pickup_longitude="float",
    pickup_latitude="float",
    RateCodeID="integer",
    store_and_fwd_flag="string",
    dropoff_longitude="float",
    dropoff_latitude="float",
    payment_type="integer",
    fare_amount="float",
    extra="float",
    mta_tax="float",
    tip_amount="float",
    tolls_amount="float",
    improvement_surcharge="float",
    total_amount="float",
)


@dataclass(frozen=True)
class Contract:
    """A table's columns in order, which of them must be set, which identifies a row, and defaults."""

    name: str
    schema: T.StructType
    required: tuple[str, ...] = ()
    unique: str = "message_id"
    defaults: Mapping[str, Callable[[], Column]] = field(default_factory=dict)

    def with_fields(self, fields: T.StructType) -> Contract:
        """The same contract with a message's own fields after its columns."""
        clash = set(self.schema.fieldNames()) & set(fields.fieldNames())
        if clash:
            raise ValueError(f"{self.name} has columns of its own named {sorted(clash)}")
        extra = [T.StructField(f.name, f.dataType) for f in fields.fields]
        schema = T.StructType([*self.schema.fields, *extra])
        return Contract(self.name, schema, self.required, self.unique, self.defaults)


# Table names, columns, required columns and defaults.
DLQ = Contract(
    "dlq_messages",
    schema_of(
        message_id="string",
        topic="string",
        partition="integer",
        msg_offset="long",
        timestamp="timestamp",
        payload="string",
        error="string",
        retry_count="integer",
        status="string",
        created_at="timestamp",
        updated_at="timestamp",
    ),
    ("message_id", "topic", "partition", "msg_offset", "timestamp", "payload"),
    defaults={
        "retry_count": lambda: F.lit(0),
        "status": lambda: F.lit("PENDING"),
        "created_at": F.current_timestamp,
        "updated_at": F.current_timestamp,
    },
)
PROCESSED = Contract(
    "processed_messages",
    schema_of(
        message_id="string",
        topic="string",
        partition="integer",
        msg_offset="long",
        processed_at="timestamp",
    ),
    ("message_id", "topic", "partition", "msg_offset"),
    defaults={"processed_at": F.current_timestamp},
)
FAILED = Contract(
    "failed_messages",
    schema_of(
        message_id="string",
        topic="string",
        partition="integer",
        msg_offset="long",
        error="string",
        retry_count="integer",
        failed_at="timestamp",
        failed_rules="string",
        payload="string",
    ),
    ("message_id", "topic", "partition", "msg_offset", "error", "retry_count"),
    defaults={"failed_at": F.current_timestamp},
)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """Project to the contract: its columns in its order and types, helper columns dropped.

    A column with a default is filled where it is absent or NULL; another absent column is NULL.
    """
    columns = []
    for f in contract.schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name in contract.defaults:
            c = F.coalesce(c, contract.defaults[f.name]())
        columns.append(c.cast(f.dataType).alias(f.name))
    return df.select(*columns)


def missing_required(contract: Contract) -> Column:
    """Names of required columns that are NULL, comma-separated; NULL for a row that has them all."""
    absent = [F.when(F.col(c).isNull(), F.lit(c)) for c in contract.required]
    return F.nullif(F.concat_ws(",", *absent), F.lit(""))


def violations(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows the contract refuses for a missing value, with ``violation``; the rest of ``enforce``."""
    return df.withColumn("violation", missing_required(contract)).filter("violation IS NOT NULL")


def first_of_each(df: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first by ``order``.

    The rank limit is applied before the shuffle as well, so each task sends at most one row per
    key and a key with very many copies does not gather in one task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(key).orderBy(*order)))
    return ranked.filter("_rank = 1").drop("_rank")


def enforce(
    df: DataFrame,
    contract: Contract,
    existing: DataFrame | None = None,
    order: Sequence[Column | str] = (),
) -> DataFrame:
    """Rows that may be appended: required columns set, one row per identity, none already stored.

    Of several copies the first by ``order`` stays, else by topic, partition and offset.
    """
    complete = df.filter(missing_required(contract).isNull())
    columns = [c for c in ("timestamp", "topic", "partition", "msg_offset") if c in df.columns]
    unique = first_of_each(complete, contract.unique, order or columns or [contract.unique])
    if existing is None:
        return unique
    return unique.join(existing.select(contract.unique), contract.unique, "left_anti").select(
        *unique.columns
    )
