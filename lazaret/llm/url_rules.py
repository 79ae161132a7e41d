"""URL rules: curated ones first, then association rules mined from labelled URLs.

Host: behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z folded; path: from there up to ``?``, ``#`` or the end.
A URL that is null or has no ``://`` has an empty host and path. A curated rule fits its host and all subdomains when
the path starts with the rule's; the longest rule wins.

URLs without a curated rule are judged by mined ones. FP-growth finds combinations of URL tokens that are frequent among labelled
URLs; a combination is a rule when its rows are bad with the given confidence and number, and no smaller combination
does as well. Rules are held in an inverted index from token to rules: a URL fits a rule when all the rule's tokens find it.
No fitting rule means allow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lazaret.llm.tables import cut

#: (host, path, verdict) of the curated rules.
CURATED = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
_BAD = "label=bad"


def host_of(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def curated(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = CURATED) -> Column:
    """A struct (rule, verdict) of the longest rule that fits, or null."""
    out = F.lit(None)
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def tokens(url: Column) -> Column:
    """The different tokens of a URL: scheme, host suffixes, the host's names, path segments with their depth, ending and query names."""
    text = F.coalesce(url, F.lit(""))
    host, path = host_of(url), path_of(url)
    labels = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(labels, i, F.size(labels)), "."))
    )
    # A name inside the host, at whatever place and under whatever domain.
    suffixes = F.concat(suffixes, F.transform(F.filter(labels, lambda x: x != ""), lambda x: F.concat(F.lit("name="), x)))
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    parts = F.transform(segments, lambda s, i: F.concat(F.lit("dir"), i.cast("string"), F.lit("="), F.regexp_replace(s, "[0-9]+", "0")))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda q: q != ""), lambda q: F.concat(F.lit("query="), F.substring_index(q, "=", 1)))
    scheme = F.array(F.concat(F.lit("scheme="), F.regexp_extract(text, r"(?s)^(.*?)://", 1)))
    shape = F.filter(F.array(F.when(text.contains("#"), F.lit("has fragment")), F.when(path.endswith("/"), F.lit("ends in slash"))), lambda x: x.isNotNull())
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_distinct(F.concat(scheme, F.when(host == "", F.array().cast("array<string>")).otherwise(suffixes), parts, names, shape))
    )


def mine(
    labelled: DataFrame,
    url_col: str = "url",
    bad_col: str = "bad",
    min_rows: int = 10,
    min_share: float = 0.002,
    min_confidence: float = 0.8,
) -> DataFrame:
    """(rule_id, items, confidence, n_rows): rules from URLs with a label (null labels are left out).

    A rule fits ``min_rows`` labelled rows and ``min_share`` of them at least; it has any number of tokens. Tokens that stand in the same
    labelled rows, such as all those of a URL that is repeated, are one item for FP-growth and come into a rule together, as sets
    of them would be as many as there are combinations and say the same.
    """
    marked = labelled.filter(F.col(bad_col).isNotNull()).select(
        F.concat(tokens(F.col(url_col)), F.when(F.col(bad_col), F.array(F.lit(_BAD))).otherwise(F.array().cast("array<string>"))).alias("items")
    )
    marked = cut(marked.filter(F.size("items") > 0).withColumn("row", F.monotonically_increasing_id()), "url-tokens")
    n = marked.count()
    empty = "rule_id long, items array<string>, confidence double, n_rows long"
    if n == 0:
        return labelled.sparkSession.createDataFrame([], empty)
    # Support is counted over rows that are bad too: a rule of that confidence has so many at least.
    support = max(min_rows, min_share * n) * min_confidence / n
    if support > 1:
        return labelled.sparkSession.createDataFrame([], empty)
    bad = marked.filter(F.array_contains("items", _BAD))
    # Combinations are mined among bad rows only; how often each stands in all rows is counted after.
    n_bad = bad.count()
    if n_bad * 1.0 < support * n:
        return labelled.sparkSession.createDataFrame([], empty)
    single = marked.select("row", F.explode("items").alias("token")).filter(F.col("token") != _BAD)
    alike = single.groupBy("token").agg(F.bit_xor(F.xxhash64("row")).alias("where"), F.count("*").alias("n")).filter(F.col("n") >= support * n)
    alike = alike.groupBy("where", "n").agg(F.min("token").alias("item"), F.sort_array(F.collect_list("token")).alias("members"))
    alike = cut(alike.select("item", "members"), "url-items")
    held = single.join(alike.select("item"), F.col("token") == F.col("item")).join(bad.select("row"), "row").groupBy("row").agg(F.collect_set("item").alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, support * n / n_bad), minConfidence=min_confidence).fit(cut(held.select("items"), "url-bad"))
    sets = model.freqItemsets.withColumn("set", F.monotonically_increasing_id())
    sets = cut(sets, "url-frequent")
    whole = sets.select("set", "freq", F.explode("items").alias("item")).join(alike, "item").groupBy("set", "freq")
    sets = whole.agg(F.array_sort(F.flatten(F.collect_list("members"))).alias("items")).select("items", F.col("freq").alias("bad_rows"))
    sets = cut(sets.withColumn("rule_id", F.xxhash64(F.array_join("items", "\n"))), "url-sets")
    counts = matches(marked, "row", "items", sets).groupBy("rule_id").agg(F.count("*").alias("n_rows"))
    rules = sets.join(counts, "rule_id").withColumn("confidence", F.col("bad_rows") / F.col("n_rows"))
    rules = rules.filter((F.col("confidence") >= min_confidence) & (F.col("n_rows") >= max(min_rows, min_share * n)))
    rules = cut(rules.select("rule_id", "items", "confidence", "n_rows"), "url-rules")
    # A rule goes when a part of it is a rule of the same confidence or more.
    part = rules.select(F.col("rule_id").alias("part_id"), F.col("items").alias("part"), F.col("confidence").alias("c"))
    within = matches(rules.select(F.col("rule_id").alias("whole"), "items"), "whole", "items", rules)
    spare = (
        within.filter("whole != rule_id")
        .join(part.select("part_id", "c"), F.col("rule_id") == F.col("part_id"))
        .join(rules.select(F.col("rule_id").alias("whole"), "confidence"), "whole")
        .filter("c >= confidence")
        .select(F.col("whole").alias("rule_id"))
        .distinct()
    )
    return cut(rules.join(spare, "rule_id", "left_anti"), "url-rules")


def matches(rows: DataFrame, key: str, items_col: str, rules: DataFrame) -> DataFrame:
    """(key, rule_id) where a row has all tokens of a rule, through the index of tokens to rules.

    A rule is looked up by one of its tokens, the rarest among the rules, and checked as a whole.
    """
    index = rules.select("rule_id", "items", F.explode("items").alias("token"))
    common = index.groupBy("token").agg(F.count("*").alias("in_rules"))
    index = index.join(common, "token").groupBy("rule_id").agg(
        F.min(F.struct("in_rules", "token")).alias("m"), F.first("items").alias("needs")
    ).select(F.col("m.token").alias("token"), "rule_id", "needs")
    own = rows.select(F.col(key), F.col(items_col).alias("_own"), F.explode(items_col).alias("token"))
    # Neither side is bounded, and written tables are much larger in memory than on disk: no broadcast.
    return own.join(index.hint("merge"), "token").filter(F.size(F.array_except("needs", "_own")) == 0).select(key, "rule_id")


def judge(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    curated_rules: Sequence[tuple[str, str, str]] = CURATED,
) -> DataFrame:
    """(id, host, path, rule, verdict, mined_rule, confidence) for each row; repeated rows and null ids are judged each on their own."""
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"), url.alias("url"))
    rows = rows.withColumn("own", curated(F.col("host"), F.col("path"), curated_rules))
    # Each combination of tokens is looked up once; many URLs share it.
    rows = rows.withColumn("tokens", F.when(F.col("own").isNull(), F.array_sort(tokens(F.col("url")))))
    # Rows that need no look get keys of their own, which spreads them.
    rows = rows.withColumn("key", F.coalesce(F.xxhash64(F.array_join("tokens", "\n")), F.lit(0)))
    rows = rows.withColumn("key", F.when(F.col("tokens").isNull(), F.xxhash64(F.lit("own"), "id", "url")).otherwise(F.col("key")))
    found = (
        matches(rows.filter("tokens is not null").select("key", "tokens").dropDuplicates(["key"]), "key", "tokens", rules)
        .join(rules.select("rule_id", "items", "confidence"), "rule_id")
        .groupBy("key")
        .agg(F.max(F.struct("confidence", "items")).alias("best"))
    )
    out = rows.join(found, "key", "left")
    return out.select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce(F.col("own.verdict"), F.when(F.col("best").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.array_join("best.items", " & ").alias("mined_rule"),
        F.col("best.confidence").alias("confidence"),
    )
