"""Rules, policies and fault fields for the message kinds the engine is used with."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

from lazaret import contracts
from lazaret.contracts import schema_of
from lazaret.functions.cleaning import Policy
from lazaret.functions.rules import Rule, at_least, between, not_null, one_of


@dataclass(frozen=True)
class Preset:
    """What is known about one kind of record."""

    schema: T.StructType
    rules: Sequence[Rule]
    policies: Sequence[Policy]
    key: Sequence[str]
    fault_fields: Sequence[str]


# The default checks, repairs and fault fields of a trip message.
TRIP = Preset(
    schema=contracts.TRIP,
    rules=(
        not_null("VendorID"),
        not_null("tpep_pickup_datetime"),
        not_null("tpep_dropoff_datetime"),
        between("passenger_count", 0, 9),
        at_least("fare_amount", 0),
        at_least("total_amount", 0),
        one_of("RateCodeID", [1, 2, 3, 4, 5, 6]),
        one_of("store_and_fwd_flag", ["Y", "N"]),
    ),
    policies=(
        Policy("VendorID", clean="exponent", to="int", default=1),
        Policy("passenger_count", clean="exponent", to="int", default=1),
        Policy("RateCodeID", clean="exponent", to="int", default=1),
        Policy("payment_type", clean="exponent", to="int", default=1),
        Policy("trip_distance", clean="exponent", to="float"),
        Policy("pickup_longitude", clean="exponent", to="float"),
        Policy("pickup_latitude", clean="exponent", to="float"),
        Policy("dropoff_longitude", clean="exponent", to="float"),
        Policy("dropoff_latitude", clean="exponent", to="float"),
        Policy("fare_amount", clean="exponent", to="float", absolute=True),
        Policy("extra", clean="exponent", to="float"),
        Policy("mta_tax", clean="exponent", to="float"),
        Policy("tip_amount", clean="exponent", to="float"),
        Policy("tolls_amount", clean="exponent", to="float"),
        Policy("improvement_surcharge", clean="exponent", to="float"),
        Policy("total_amount", clean="exponent", to="float"),
    ),
    key=("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime"),
    fault_fields=(
        "VendorID",
        "passenger_count",
        "trip_distance",
        "fare_amount",
        "total_amount",
        "payment_type",
    ),
)


def with_cleaning(policies: Sequence[Policy], clean: str) -> tuple[Policy, ...]:
    """The same policies with another way of cleaning text, for instance ``strip``."""
    return tuple(
        Policy(p.column, clean if p.clean else None, p.to, p.default, p.absolute) for p in policies
    )


LINEITEM = Preset(
    schema=schema_of(
        l_orderkey="long",
        l_partkey="long",
        l_suppkey="long",
        l_linenumber="integer",
        l_quantity="double",
        l_extendedprice="double",
        l_discount="double",
        l_tax="double",
        l_returnflag="string",
        l_linestatus="string",
        l_shipdate="string",
    ),
    rules=(
        not_null("l_suppkey"),
        not_null("l_shipdate"),
        between("l_quantity", 1, 50),
        at_least("l_extendedprice", 0),
        at_least("l_discount", 0),
        one_of("l_linenumber", [1, 2, 3, 4, 5, 6]),
        one_of("l_linestatus", ["F", "O"]),
    ),
    policies=(
        Policy("l_suppkey", default=1),
        Policy("l_linenumber", default=1),
        Policy("l_extendedprice", absolute=True),
    ),
    key=("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
    fault_fields=(
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
    ),
)

EVENTS = Preset(
    schema=schema_of(
        event_id="long",
        ts="string",
        user_id="long",
        event_type="string",
        value="double",
        props="string",
    ),
    rules=(
        not_null("event_id"),
        not_null("ts"),
        not_null("user_id"),
        one_of("event_type", ["click", "error", "purchase", "signup", "view"]),
        at_least("value", 0),
    ),
    policies=(
        Policy("user_id", clean="exponent", to="bigint", default=1),
        Policy("value", clean="exponent", to="double", absolute=True),
    ),
    key=("event_id",),
    fault_fields=("user_id", "event_type", "value", "props"),
)

CUSTOMER = Preset(
    schema=schema_of(
        c_custkey="long",
        c_name="string",
        c_nationkey="integer",
        c_acctbal="double",
        c_mktsegment="string",
    ),
    rules=(at_least("c_acctbal", 0),),
    policies=(Policy("c_acctbal", absolute=True),),
    key=("c_custkey",),
    fault_fields=("c_acctbal",),
)
