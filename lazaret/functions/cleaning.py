"""Number repair as column expressions, and the policies that combine them.

Everything uses ``try_cast``: under ANSI mode a plain cast of dirty text stops the job.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what "strip" removes before a text is read as a number.
NOT_NUMERIC = "[^0-9.-]"

#: What "exponent" takes out first, thousands commas and currency signs, and what is a number then.
_GROUPING = r"(?<=[0-9]),(?=[0-9])|\p{Sc}"
_NUMBER = r"([-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)"

# The type a cleaned text is read as. "strip" reads single precision.
READ_AS = {
    "exponent": "double",
    "strip": "float",
}


INTEGERS = ("tinyint", "smallint", "int", "bigint")


def clean_number(c: Column, clean: str = "exponent") -> Column:
    """Text or number to number; NULL when there is none to read.

    ``exponent`` reads the one number in the text, with sign and exponent, in double precision; a text with
    several numbers, such as a date, has none. ``strip`` keeps digits, points and minus signs only, so ``1.0E7``
    turns into 1.07; it exists for comparison.
    """
    return number_text(c, clean).try_cast(READ_AS[clean])


def number_text(c: Column, clean: str = "exponent") -> Column:
    """The text of the number in a text, which can still be read exactly; NULL when there is none."""
    text = c.cast("string")
    if clean == "strip":
        return F.regexp_replace(text, NOT_NUMERIC, "")
    numbers = F.regexp_extract_all(F.regexp_replace(text, _GROUPING, ""), F.lit(_NUMBER), F.lit(1))
    return F.when(F.size(numbers) == 1, F.get(numbers, 0))


def to_int(c: Column, target: str = "int") -> Column:
    """Truncate to an integer type, exactly where the value is an integer; NULL when out of range or not a number."""
    return F.coalesce(c.try_cast(target), c.try_cast("double").try_cast(target))


def default(c: Column, value: Any) -> Column:
    return F.coalesce(c, F.lit(value))


def abs_value(c: Column) -> Column:
    return F.abs(c)


@dataclass(frozen=True)
class Policy:
    """How one column is repaired: clean the text, convert, fill NULL, drop the sign, in this order.

    Repairing a repaired value changes nothing, unless the policy strips; the loop's closed form in
    ``plans.loop`` relies on that.
    """

    column: str
    clean: str | None = None
    to: str | None = None
    default: Any = None
    absolute: bool = False

    @property
    def idempotent(self) -> bool:
        """Stripping takes a number's exponent away, so 1.0E7 becomes 1.07."""
        return self.clean != "strip"

    def convert(self, c: Column) -> Column:
        """A value in the policy's type."""
        if self.to in INTEGERS:
            return to_int(c, self.to)
        return c if self.to is None else c.try_cast(self.to)

    def finish(self, c: Column) -> Column:
        """The steps after the conversion."""
        if self.default is not None:
            c = default(c, self.default)
        if self.absolute:
            c = abs_value(c)
        return c
