"""Validation rules as data.

A rule names one condition on one column. Rules are joined into a verdict column; nothing here
touches a DataFrame, so the same rules judge a typed table, a decoded message or a repaired copy
of either (``at`` says which column stands behind a name).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

At = Callable[[str], Column]

#: Rules per mask, as many as a long has room for with one bit to spare.
MASK_RULES = 62


@dataclass(frozen=True)
class Rule:
    """One named condition; ``test`` turns the column under judgement into a boolean column."""

    column: str
    kind: str
    test: Callable[[Column], Column]

    @property
    def name(self) -> str:
        return f"{self.column}:{self.kind}"

    def condition(self, at: At = F.col) -> Column:
        return self.test(at(self.column))


def not_null(column: str) -> Rule:
    return Rule(column, "not_null", lambda c: c.isNotNull())


def between(column: str, low, high) -> Rule:
    """Closed range."""
    return Rule(column, "between", lambda c: c.between(low, high))


def at_least(column: str, bound) -> Rule:
    return Rule(column, "at_least", lambda c: c >= bound)


def one_of(column: str, values: Sequence) -> Rule:
    return Rule(column, "one_of", lambda c: c.isin(*values))


def not_nan(column: str) -> Rule:
    """Optional: Spark orders NaN above every number, so a lower bound alone lets it pass."""
    return Rule(column, "not_nan", lambda c: ~F.isnan(c))


def conjunction(rules: Sequence[Rule], at: At = F.col) -> Column:
    """All rules joined by a plain AND: TRUE, FALSE or NULL. This form is pushed to a Parquet scan."""
    return reduce(lambda left, right: left & right, (rule.condition(at) for rule in rules))


def verdict(rules: Sequence[Rule], null_verdict: str = "quarantine", at: At = F.col) -> Column:
    """The verdict column.

    ``quarantine`` counts an unknown outcome as invalid, so each row is either valid or invalid.
    ``drop`` keeps the three-valued outcome; a row judged NULL then belongs to neither side.
    """
    if null_verdict == "quarantine":
        return F.coalesce(conjunction(rules, at), F.lit(False))
    if null_verdict == "drop":
        return conjunction(rules, at)
    raise ValueError(f"null_verdict must be 'quarantine' or 'drop', not {null_verdict!r}")


def place(number: int) -> tuple[int, int]:
    """In which mask a rule stands, and its bit there."""
    mask, bit = divmod(number, MASK_RULES)
    return mask, 1 << bit


def failures(rules: Sequence[Rule], at: At = F.col) -> list[Column]:
    """The broken rules as bit masks of ``MASK_RULES`` rules each, rule 0 in the lowest bit; all 0 for a valid row.

    The numbers say both whether a row is valid and why not, so each rule is evaluated once and the
    generated code stays short enough for the JVM to compile it.
    """
    masks: list[Column] = []
    for number, rule in enumerate(rules):
        mask, bit = place(number)
        own = F.when(rule.condition(at), 0).otherwise(bit)
        if mask == len(masks):
            masks.append(own)
        else:
            masks[mask] = masks[mask] + own
    return masks


def none_broken(masks: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, (mask == 0 for mask in masks))


def names(masks: Sequence[Column], rules: Sequence[Rule], more: Sequence[str] = ()) -> Column:
    """The names in the masks as one comma-separated string; NULL for none. ``more`` names higher bits."""
    found = []
    for number, label in enumerate([*(rule.name for rule in rules), *more]):
        mask, bit = place(number)
        if mask < len(masks):
            found.append(F.when(masks[mask].bitwiseAND(bit) != 0, label))
    return F.when(~none_broken(masks), F.concat_ws(",", *found))


def reasons(rules: Sequence[Rule], at: At = F.col) -> Column:
    """Names of the rules a row breaks, in rule order; empty for a valid row."""
    broken = [F.when(~F.coalesce(r.condition(at), F.lit(False)), r.name) for r in rules]
    return F.array_compact(F.array(*broken))
