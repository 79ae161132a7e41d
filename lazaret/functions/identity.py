"""Message identity and time stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: layout of the time stamp in snapshot names.
STAMP = "yyyyMMdd_HHmmss"


def message_id(
    topic: Column | str = "topic", partition: Column | str = "partition", offset: Column | str = "offset"
) -> Column:
    """Identity of a message from the place it first arrived at; the same on every replay."""
    place = [F.col(c) if isinstance(c, str) else c for c in (topic, partition, offset)]
    return F.sha2(F.concat_ws("|", *(c.cast("string") for c in place)), 256)


def random_id() -> Column:
    """A fresh random identity per evaluation. A replay gets another one, so it cannot deduplicate."""
    return F.expr("uuid()")


def stamp(c: Column | None = None) -> Column:
    """Compact time text for names, such as 20240131_235959; of now unless a column is given."""
    return F.date_format(F.current_timestamp() if c is None else c, STAMP)


def iso_text(c: Column | None = None) -> Column:
    """ISO-8601 text with microseconds; of now unless a column is given."""
    return F.date_format(
        F.current_timestamp() if c is None else c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    )


def epoch_millis(c: Column | None = None) -> Column:
    return F.unix_millis(F.current_timestamp() if c is None else c.cast("timestamp"))
