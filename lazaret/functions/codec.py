"""JSON messages to rows and back.

A wire record is one JSON object: the fields of a contract, the retry count, and what else the engine
keeps about a message under one key of its own, so that a record's other fields are never taken for it. Messages are
read straight into the contract's types, where a field that does not fit is NULL. ``typed`` mode
leaves it at that, and the text of such a field is gone. ``text`` mode reads a message with an unfit
field once more as text, so that the text is still there to be repaired.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lazaret.functions.identity import message_id
from lazaret.functions.once import with_columns_once

ENVELOPE_COLUMNS = ("key", "value", "topic", "partition", "offset", "timestamp")

# The count travels next to the contract's fields, the history under a key of its own.
COUNT = T.StructField("retry_count", T.IntegerType())
HISTORY_KEY = "_lazaret"
HISTORY = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("message_id", "failed_rules", "raw")]
)

# Names of the columns that ``decode`` adds, and of the history's key.
RESERVED = {COUNT.name, *HISTORY.fieldNames(), HISTORY_KEY, "message", "malformed", "text"}

_CORRUPT = "_corrupt"

# Only strict JSON is a message: a bare NaN or single quotes make a record malformed.
_STRICT = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _CORRUPT,
    "allowNonNumericNumbers": "false",
    "allowSingleQuotes": "false",
}


def decode(df: DataFrame, schema: T.StructType, mode: str = "text") -> DataFrame:
    """Parse ``value`` and flatten it.

    The result has the envelope's columns as the struct ``message``, the contract's typed fields,
    and ``retry_count``, ``message_id``, ``failed_rules``, ``raw`` and ``malformed``; ``text`` mode
    adds ``text``, the fields as text where one of them did not fit, else NULL. A message that is not
    one JSON object and nothing else is malformed and keeps its text in ``raw``, also on later visits.
    """
    clash = set(schema.fieldNames()) & RESERVED
    if clash:
        raise ValueError(f"a contract cannot use the names {sorted(clash)}")
    value = F.col("value").cast("string")
    envelope = [c for c in ENVELOPE_COLUMNS if c in df.columns]
    whole = F.struct(*(value.alias(c) if c == "value" else F.col(c) for c in envelope))
    parsed = with_columns_once(
        df, {"message": whole, "_data": _parse(value, schema, "typed")}
    ).drop(*envelope)

    data, message = F.col("_data"), F.col("message")
    # set for broken JSON, and also where a field does not fit its type
    unfit = data.isNull() | data[_CORRUPT].isNotNull()
    place = ("topic", "partition", "offset")
    first_seen = (
        message_id(*(message[c] for c in place))
        if set(place) <= set(envelope)
        else F.lit(None).cast("string")
    )
    if mode == "typed":
        unreadable = unfit & F.try_parse_json(message["value"]).isNull()
        columns = {name: data[name] for name in [*schema.fieldNames(), COUNT.name]}
    elif mode == "text":
        # only these few messages are read once more, as text
        again = F.when(unfit, _parse(message["value"], schema, "text"))
        parsed = with_columns_once(parsed, {"text": again})
        text = F.col("text")
        unreadable = data.isNull() | text[_CORRUPT].isNotNull()
        columns = {
            f.name: F.coalesce(data[f.name], text[f.name].try_cast(f.dataType))
            for f in [*schema.fields, COUNT]
        }
    else:
        raise ValueError(f"mode must be 'text' or 'typed', not {mode!r}")
    parsed = with_columns_once(parsed, {"_unreadable": unreadable | _has_more(message["value"], mode)})
    unreadable = F.col("_unreadable")
    history = data[HISTORY_KEY]
    columns |= {
        "message_id": F.coalesce(history["message_id"], first_seen),
        "failed_rules": history["failed_rules"],
        # an absent value is kept as an empty text, so that it stays malformed on later visits
        "raw": F.coalesce(history["raw"], F.when(unreadable, F.coalesce(message["value"], F.lit("")))),
        "malformed": unreadable | history["raw"].isNotNull(),
    }
    return parsed.withColumns(columns).drop("_data", "_unreadable")


# Possessive, so that it neither tries again nor takes a stack as deep as the text is long.
_FLAT = r'[^"{}]++|"(?:[^"\\]++|\\.)*+"'
_ONE_OBJECT = rf"(?s)\A\s*+\{{(?:{_FLAT}|\{{(?:{_FLAT})*+\}})*+\}}\s*+\z"


def _has_more(value: Column, mode: str) -> Column:
    """Whether anything follows the first JSON value, which the parser would not look at; in ``text`` mode
    also whether that value is no object. Typed reading sees an empty record there.

    A text whose braces outside strings close at its end, with objects inside the first but none inside those, has nothing more;
    records of the engine are of that kind, with their history and with texts of any kind. Others are parsed once more as the
    first element of an array, behind which the array's second element has to come.
    """
    # Most records are told by the place of their first closing brace: it is the last character, or closes the history before it.
    first, end = F.instr(value, "}"), F.length(value)
    inner = (first == end - 1) & value.endswith("}}") & value.contains(f'"{HISTORY_KEY}":{{')
    plain = value.startswith("{") & ((first == end) | inner)
    simple = plain | value.rlike(_ONE_OBJECT)
    array = F.from_json(F.concat(F.lit("["), value, F.lit(f',"{HISTORY_KEY}"]')), "array<string>", _STRICT)
    single = F.coalesce(F.array_position(array, HISTORY_KEY) == 2, F.lit(False))
    if mode == "text":
        single &= value.rlike(r"^\s*\{")
    return F.when(value.isNull() | simple, False).otherwise(~single)


def _parse(value: Column, schema: T.StructType, mode: str) -> Column:
    """The JSON text as a struct of the contract's fields, the bookkeeping and the corrupt text."""
    fields = [
        T.StructField(f.name, T.StringType() if mode == "text" else f.dataType)
        for f in [*schema.fields, COUNT]
    ]
    own = [T.StructField(HISTORY_KEY, HISTORY), T.StructField(_CORRUPT, T.StringType())]
    wire = T.StructType([*fields, *own])
    return F.from_json(value, wire, _STRICT)


def encode(
    df: DataFrame, schema: T.StructType, instead: Mapping[str, Column] | None = None
) -> Column:
    """The wire record of each row: the fields in contract order, then the count and history the rows have.

    NULL fields are left out. When the rows carry ``text`` (see ``decode``), fields are written as
    text, one whose typed value is NULL as the text that came in, so nothing is lost on the way.
    ``instead`` gives texts for some fields, each written where it is not NULL; the field is NULL there.
    """
    fields = {name: F.col(name) for name in schema.fieldNames()}
    if "text" in df.columns:
        fields = {n: F.coalesce(c.cast("string"), F.col("text")[n]) for n, c in fields.items()}
    instead = instead or {}
    if COUNT.name in df.columns:
        fields[COUNT.name] = F.col(COUNT.name)
    history = [F.col(name) for name in HISTORY.fieldNames() if name in df.columns]
    if history:
        fields[HISTORY_KEY] = F.struct(*history)
    written = []
    for name, c in fields.items():
        written.append(c.alias(name))
        if name in instead:
            # of the two fields of this name one is NULL, and so left out
            written.append(instead[name].alias(name))
    return F.to_json(F.struct(*written))
