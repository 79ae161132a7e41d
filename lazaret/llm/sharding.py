"""K-d tree sharding: equal bytes per shard, rows that belong together kept together.

Rows with equal texts are one group and stay together. Groups are points: their dimensions are metadata columns, their weight is
the bytes of their rows. A node is split along its widest dimension (its extent over that of all points) at the
weighted median, or where the bytes stand in the ratio of the shards on both sides, until a node has the target bytes.

The median is found by histograms: groups are summed into bins per node, the bin that holds the median is cut into
bins again until it holds one value or under a thousandth of a shard; equal values are then cut by the hash of their text in the
same way. Each round is one aggregation over the groups, all nodes at once; the driver sees bins of open nodes only.

Large groups are dealt first, the largest to the shard with the least bytes: those over ``LARGE`` of a shard, so at most 1 / ``LARGE`` a shard.
The tree deals the others by the room that is left. A group that outweighs a shard has one for itself, and the others are
even; a shard is empty only if there are fewer groups than shards.

Null texts are one group; null dimensions count as 0. Repeated rows and ids are rows of their own. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lazaret.llm.tables import cut, numbered

BINS = 512
TOLERANCE = 0.001
LARGE = 0.05


@dataclass
class _Node:
    """A node of the tree that waits for its split, and what is known of it."""

    number: int
    #: The shards under the node, from the left, and the bytes each has room for.
    under: list[int]
    room: list[float]
    weight: int = 0
    groups: int = 0
    #: The dimension split now and the interval that holds the median; weight before that interval.
    on: str = ""
    low: float = 0.0
    high: float = 0.0
    before: int = 0
    groups_before: int = 0
    #: Set when ``on`` is the hash within one value of the dimension.
    tied_on: str = ""
    tied_at: float = 0.0

    @property
    def goal(self) -> int:
        """Bytes of the left half of the shards."""
        return int(self.weight * sum(self.room[: self.shards // 2]) / sum(self.room))

    @property
    def shards(self) -> int:
        return len(self.under)

    def halves(self) -> tuple[_Node, _Node]:
        k = self.shards // 2
        return _Node(2 * self.number, self.under[:k], self.room[:k]), _Node(2 * self.number + 1, self.under[k:], self.room[k:])


def _is(node: _Node) -> Column:
    return F.col("node") == node.number


def _choose(nodes: list[_Node], value, otherwise) -> Column:
    """An expression with a value per node; there are as many nodes as shards at most."""
    out = None
    for n in nodes:
        out = F.when(_is(n), value(n)) if out is None else out.when(_is(n), value(n))
    return out.otherwise(otherwise)


def _split_points(points: DataFrame, nodes: list[_Node], tolerance: float) -> dict[int, tuple[Column, int, int]]:
    """For each node which points go to the right side, and the weight and groups of the left side."""
    done: dict[int, tuple[Column, int, int]] = {}
    open_nodes = list(nodes)
    while open_nodes:
        at = _choose(open_nodes, lambda n: F.col(n.on), F.lit(None))
        low = _choose(open_nodes, lambda n: F.lit(n.low), F.lit(None))
        width = _choose(open_nodes, lambda n: F.lit((n.high - n.low) / BINS), F.lit(None))
        tied = _choose(open_nodes, lambda n: F.col(n.tied_on) == n.tied_at if n.tied_on else F.lit(True), F.lit(False))
        high = _choose(open_nodes, lambda n: F.lit(n.high), F.lit(None))
        inside = points.withColumn("_at", at).filter(tied & (F.col("_at") >= low) & (F.col("_at") <= high))
        bins = F.when(width > 0, F.least(F.floor((F.col("_at") - low) / width), F.lit(BINS - 1))).otherwise(0)
        sums = (
            inside.groupBy("node", bins.alias("bin"))
            .agg(F.sum("weight").alias("w"), F.count("*").alias("n"), F.min("_at").alias("lo"), F.max("_at").alias("hi"))
            .orderBy("node", "bin")
            .collect()
        )
        still = []
        for n in open_nodes:
            seen, groups = n.before, n.groups_before
            for r in (r for r in sums if r["node"] == n.number):
                if seen + r["w"] > n.goal:
                    break
                seen, groups = seen + r["w"], groups + r["n"]
            # The bin r holds the goal: its points may go to either side.
            fine = r["w"] <= tolerance * n.weight / n.shards
            if fine or (r["lo"] == r["hi"] and n.on == "_hash"):
                left_if_before, left_if_after = seen, seen + r["w"]
                after = abs(left_if_after - n.goal) < abs(left_if_before - n.goal)
                side = F.col(n.on) > r["hi"] if after else F.col(n.on) >= r["lo"]
                if n.tied_on:
                    side = (F.col(n.tied_on) > n.tied_at) | ((F.col(n.tied_on) == n.tied_at) & side)
                done[n.number] = (side, left_if_after, groups + r["n"]) if after else (side, left_if_before, groups)
            elif r["lo"] == r["hi"]:  # one value: its points are told apart by their hash
                n.tied_on, n.tied_at, n.on = n.on, r["lo"], "_hash"
                n.low, n.high, n.before, n.groups_before = -1.0, 1.0, seen, groups
                still.append(n)
            else:
                n.low, n.high, n.before, n.groups_before = r["lo"], r["hi"], seen, groups
                still.append(n)
        open_nodes = still
    return done


def _large(points: DataFrame, shards: int, total: int) -> tuple[list[tuple[bytes, int]], list[float]]:
    """(group, shard) of the groups over LARGE of a shard, and the bytes that each shard has room for besides."""
    rest, left = total, shards
    for r in points.orderBy(F.col("weight").desc(), "group").limit(shards).select("weight").collect():
        if r["weight"] * left <= rest:
            break
        rest, left = rest - r["weight"], left - 1
    # Those over a whole shard are out of ``rest``; with nothing left, each group has a shard.
    least = LARGE * rest / left if left and rest else 0
    large = points.filter(F.col("weight") > least).select("group", "weight").orderBy(F.col("weight").desc(), "group").collect()
    heap, dealt = [(0, s) for s in range(shards)], []
    for r in large:
        weight, s = heap[0]
        heapq.heapreplace(heap, (weight + r["weight"], s))
        dealt.append((bytes(r["group"]), s))
    # The level to which the others fill the shards.
    held, others = sorted(heap), total - sum(r["weight"] for r in large)
    below = level = 0.0
    for k, (weight, _) in enumerate(held, 1):
        below += weight
        level = (others + below) / k
        if k == shards or level <= held[k][0]:
            break
    room = [0.0] * shards
    for weight, s in held:
        room[s] = max(level - weight, 0.0)
    return dealt, room


def shard_groups(points: DataFrame, dimensions: list[str], shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """Adds ``shard`` to points (group, weight, _hash and the dimensions); shards are numbered from the left of the tree."""
    total = points.agg(F.sum("weight")).first()[0]
    if not total:
        return points.withColumn("shard", F.lit(0))
    dealt, room = _large(points, shards, total)
    under, room = [s for s in range(shards) if room[s] > 0], [r for r in room if r > 0]
    if not dealt:
        return _tree(points, dimensions, under, room, tolerance)
    table = cut(points.sparkSession.createDataFrame(dealt, "group binary, shard int"), "large")
    own = points.join(table, "group")
    return own.unionByName(_tree(points.join(table, "group", "left_anti"), dimensions, under, room, tolerance))


def _tree(points: DataFrame, dimensions: list[str], under: list[int], room: list[float], tolerance: float) -> DataFrame:
    extents = [F.min(d).alias(f"{d}_lo") for d in dimensions] + [F.max(d).alias(f"{d}_hi") for d in dimensions]
    sized = [F.sum("weight").alias("w"), F.count("*").alias("n")]
    root = points.agg(*sized, *extents).first()
    if not root["n"]:
        return points.withColumn("shard", F.lit(0)).select(*points.columns, "shard")
    columns = points.columns
    spread = {d: (root[f"{d}_hi"] - root[f"{d}_lo"]) or 1.0 for d in dimensions}
    points = points.withColumn("node", F.lit(1))
    level, leaves = {1: _Node(1, under, room)}, []
    while level:
        facts = points.filter(F.col("node").isin(list(level))).groupBy("node").agg(*sized, *extents).collect()
        splits, rows = [], {r["node"]: r for r in facts}
        for number, n in level.items():
            r = rows.get(number)
            if r is None:
                continue
            n.weight, n.groups = r["w"], r["n"]
            if n.shards == 1 or n.groups == 1:
                leaves.append(n)
                continue
            n.on = max(dimensions, key=lambda d: (r[f"{d}_hi"] - r[f"{d}_lo"]) / spread[d])
            n.low, n.high = r[f"{n.on}_lo"], r[f"{n.on}_hi"]
            splits.append(n)
        level = {}
        if splits:
            found = _split_points(points, splits, tolerance)
            right = _choose(splits, lambda n: found[n.number][0], F.lit(False))
            moving = F.col("node").isin([n.number for n in splits])
            points = points.withColumn("node", F.when(moving, 2 * F.col("node") + right.cast("int")).otherwise(F.col("node")))
            points = cut(points, "tree")
            for n in splits:
                level |= {half.number: half for half in n.halves()}
    # A group alone in a node of several shards goes where most room is.
    own = {n.number: n.under[n.room.index(max(n.room))] for n in leaves}
    return points.select(*columns, _choose(leaves, lambda n: F.lit(own[n.number]), F.lit(None)).cast("int").alias("shard"))


def shard(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    dimensions: dict[str, Column] | None = None,
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard) for each row; slots of a shard run from 0 without gaps."""
    text = F.col(text_col)
    dims = dimensions or {
        "first_id": F.min(F.col("id").cast("double")),
        "bytes": F.min(F.col("size").cast("double")),
        "origin": F.min(F.col("origin")),
    }
    origin = F.xxhash64("source") / F.lit(2.0**63) if "source" in docs.columns else F.lit(0.0)
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("bytes_"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(F.coalesce(text, F.lit("")))).alias("group"),
        origin.alias("origin"),
    ).withColumn("size", F.col("bytes_") + 1)
    rows = cut(rows.drop("bytes_"), "sizes")
    points = rows.groupBy("group").agg(F.sum("size").alias("weight"), *(F.coalesce(c, F.lit(0.0)).alias(f"d_{n}") for n, c in dims.items()))
    points = cut(points.withColumn("_hash", F.xxhash64("group") / F.lit(2.0**63)), "groups")
    placed = cut(shard_groups(points, [f"d_{n}" for n in dims], shards).select("group", "shard"), "shards")
    dealt = numbered(rows.join(placed, "group").select("id", "size", "text_crc32", "shard"), "shard", None, "slots")
    return dealt.select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("before").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
