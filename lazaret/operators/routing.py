"""Where each row goes: the valid/invalid split, the retry split and the fan-out to sinks."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lazaret.functions.rules import At, Rule, conjunction, failures, names, none_broken, place, verdict
from lazaret.functions.once import with_columns_once
from lazaret.sources import storage

# Fixed value: the error stored with a row whose retries are used up.
RETRIES_EXCEEDED = "Max retries exceeded"

MAX_RETRIES = 3


# Fixed value: the reason given for a message that is no JSON object.
DECODE = "decode"


def broken(df: DataFrame, rules: Sequence[Rule], at: At = F.col) -> list[Column]:
    """Masks of the broken rules (``functions.rules.failures``); a malformed message has a bit of its
    own after the rules, and no other."""
    masks = failures(rules, at)
    if "malformed" not in df.columns:
        return masks
    last, bit = place(len(rules))
    masks += [F.lit(0)] * (last + 1 - len(masks))
    malformed = F.col("malformed")
    return [F.when(malformed, bit if k == last else 0).otherwise(m) for k, m in enumerate(masks)]


def columns_of(masks: Sequence[Column], name: str) -> dict[str, Column]:
    """Masks as the columns ``name0``, ``name1`` and so on."""
    return {f"{name}{k}": mask for k, mask in enumerate(masks)}


def broken_names(masks: Sequence[Column], rules: Sequence[Rule]) -> Column:
    return names(masks, rules, [DECODE])


def is_valid(df: DataFrame, rules: Sequence[Rule], null_verdict: str = "quarantine") -> Column:
    """Verdict of a row; a malformed message (see ``functions.codec``) is never valid."""
    valid = verdict(rules, null_verdict)
    return ~F.col("malformed") & valid if "malformed" in df.columns else valid


def judge(df: DataFrame, rules: Sequence[Rule], null_verdict: str = "quarantine") -> DataFrame:
    """Add ``is_valid``."""
    return df.withColumn("is_valid", is_valid(df, rules, null_verdict))


def split(
    df: DataFrame, rules: Sequence[Rule], null_verdict: str = "quarantine"
) -> tuple[DataFrame, DataFrame]:
    """Valid rows and invalid rows.

    For a table. The valid side filters by the plain AND of the rules, which reaches the Parquet
    scan. Under ``null_verdict="drop"`` a row judged NULL is on neither side. Each side evaluates
    the rows again, so where decoding is costly or both sides are written use ``fan_out``.
    """
    plain = conjunction(rules)
    if "malformed" in df.columns:
        plain = ~F.col("malformed") & plain
    return df.filter(plain), df.filter(~is_valid(df, rules, null_verdict))


def triage(df: DataFrame, rules: Sequence[Rule], null_verdict: str = "quarantine") -> DataFrame:
    """Add ``route`` (``processed`` or ``dlq``) and, for the latter, ``failed_rules``.

    Under ``null_verdict="drop"`` rows judged NULL have no route.
    """
    marks = columns_of(broken(df, rules), "_broken")
    judged = with_columns_once(df, marks)
    masks = [F.col(c) for c in marks]
    valid = none_broken(masks)
    unknown = F.lit(False)
    if null_verdict == "drop":
        unknown = is_valid(df, rules, "drop").isNull()
    earlier = F.col("failed_rules") if "failed_rules" in df.columns else F.lit(None)
    return judged.withColumns(
        {
            "route": F.when(valid, "processed").when(~unknown, "dlq"),
            # a valid row keeps the reasons of its last failed visit, if any
            "failed_rules": F.when(valid, earlier.cast("string")).otherwise(
                broken_names(masks, rules)
            ),
        }
    ).drop(*marks)


def next_count(null_count: str = "zero") -> Column:
    """The retry count after this visit; a missing count starts at 0, or stays NULL with ``drop``."""
    if null_count == "zero":
        return F.coalesce(F.col("retry_count"), F.lit(0)) + 1
    if null_count == "drop":
        return F.col("retry_count") + 1
    raise ValueError(f"null_count must be 'zero' or 'drop', not {null_count!r}")


def retry_route(count: Column, max_retries: int = MAX_RETRIES) -> Column:
    return F.when(count < max_retries, "retry").when(count >= max_retries, "failed")


def retry_split(
    df: DataFrame, max_retries: int = MAX_RETRIES, null_count: str = "zero"
) -> DataFrame:
    """Count this visit and add ``route`` (``retry`` or ``failed``) and the final ``error``.

    With ``null_count="drop"`` a row without a count has no route.
    """
    counted = df.withColumn("retry_count", next_count(null_count))
    return counted.withColumn("route", retry_route(F.col("retry_count"), max_retries)).withColumn(
        "error", F.when(F.col("route") == "failed", F.lit(RETRIES_EXCEEDED)).cast("string")
    )


def route_counts(routes: Sequence[str]) -> list[Column]:
    """Rows per route, as metrics for an ``Observation``."""
    return [F.count_if(F.col("route") == route).alias(route) for route in routes]


def fan_out(
    df: DataFrame, root: str, batch_id: int | str, routes: Sequence[str]
) -> dict[str, int] | None:
    """Write all routes of one batch in one pass, to ``root/batch=N/route=R``.

    One job without a shuffle or a cache, and all routes appear together by one rename. A batch
    that is there already is left as it is, so a replay changes nothing; None says so. The number
    therefore has to name the same rows for ever. Otherwise returns the rows per route. Rows
    without a route are not written.
    """
    seen = Observation()
    routed = df.observe(seen, *route_counts(routes)).filter(F.col("route").isNotNull())
    written = storage.write_whole(
        df.sparkSession,
        f"{root}/batch={batch_id}",
        lambda path: routed.write.partitionBy("route").parquet(path),
    )
    return seen.get if written else None


def fan_out_to(
    df: DataFrame, branches: Mapping[str, Callable[[DataFrame], None]]
) -> dict[str, int]:
    """Write each route with its own writer, for sinks of different kinds.

    The batch is cached so that it is decoded once; counting the routes fills the cache, and a
    route without rows is then skipped.
    """
    routed = df.persist()
    try:
        counts = {r["route"]: r["count"] for r in routed.groupBy("route").count().collect()}
        for route, write in branches.items():
            if counts.get(route):
                write(routed.filter(F.col("route") == route).drop("route"))
        return {route: counts.get(route, 0) for route in branches}
    finally:
        routed.unpersist()
