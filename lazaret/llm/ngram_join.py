"""Similarity join of texts by the Jaccard coefficient of their word shingles, exact, with classes of near duplicates.

A text's set holds its distinct shingles of ``size`` words (runs without ASCII white space, A-Z folded);
fewer words make one shingle of them all, no word the empty set, which links with nothing. Two texts link
when 100 * |A and B| >= percent * |A or B|. Null texts count as empty; repeated rows and repeated ids
are rows of their own; a null id is a row whose class has the smallest id that is not null, if any.

How links are found, over whole sets relations rather than pairs:

* Equal sets are one class from the start; one row of each stands for all.
* Only shingles in two rows or more can be shared. The rest never leave the first stage.
* Shingles have one order over all rows, rarest first. Texts that link share one among their first
  n - ceil(percent * n) + 1, the prefix; a list per shingle holds the rows and positions.
* Answers come from a similar set's answers: the most central row of a list is compared with all others, and rows
  that link with it share its class, so that pairs among them need no look at all.
* What is left of a list are blocks of one class and size with their first position. A pair of blocks
  is skipped when sizes or positions rule a link out; only the others are opened to pairs.

Links are only left out where both rows already have the same class, so classes are those of all links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lazaret.llm.components import components
from lazaret.llm.tables import cut, partitions
from lazaret.llm.text import mix, slices, window_hashes, words_of

#: Shingles that a task holds before it hands them on.
CHUNK = 1_500_000
#: Rows of a chunk at most.
ROWS = 65_536
#: Buckets of shingles that a task works through, one after the other.
FINE = 4


def shingle_sets(words, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each distinct shingle of each row, sorted by hash."""
    at, hashes = window_hashes(words, size)
    rows = words.row[at]
    counts = np.diff(words.first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    extra = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        has = counts[short] > k
        extra[has] = mix(extra[has] + words.hash[words.first[short[has]] + k] + np.uint64(k + 1))
    rows, hashes = np.concatenate([rows, short]), np.concatenate([hashes, mix(extra)])
    order = np.argsort(hashes)
    rows, hashes = rows[order], hashes[order]
    again = np.zeros(len(hashes), bool)
    again[1:] = hashes[1:] == hashes[:-1]
    if again.any():  # the order inside runs of one hash is by row, to see repeats in a row
        runs = again.copy()
        runs[:-1] |= again[1:]
        part = np.flatnonzero(runs)
        part_rows = rows[part][np.lexsort((rows[part], hashes[part]))]
        rows[part] = part_rows
        keep = np.ones(len(hashes), bool)
        keep[1:] = ~(again[1:] & (rows[1:] == rows[:-1]))
        rows, hashes = rows[keep], hashes[keep]
    return rows, hashes


def _planes(values: np.ndarray) -> bytes:
    """Numbers byte by byte, high bytes together: sorted ones then compress well."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _unplanes(data: bytes, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def _shingle_blocks(docs: DataFrame, id_col: str, text_col: str, size: int, buckets: int) -> DataFrame:
    """Blocks of shingles by range of hash, and a row for each text (bucket null) with a number, size and set digest."""

    def blocks(batches):
        part, chunk, first = TaskContext.get().partitionId(), 0, 0
        held: list[tuple[np.ndarray, np.ndarray]] = []
        held_n = 0

        def flush():
            rows, hashes = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(hashes)
            rows, hashes = rows[order], hashes[order]
            # bucket = high part of hash * buckets
            bounds = np.searchsorted(hashes, np.array([-(-(b << 64) // buckets) for b in range(1, buckets)], np.uint64))
            for b, (r, h) in enumerate(zip(np.split(rows, bounds), np.split(hashes, bounds), strict=True)):
                if len(h):
                    yield b, first_ref, _planes(h), _planes(r.astype(np.uint16))

        def rows_to_batch(found):
            found = list(found)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([x[0] for x in found], pa.int32()),
                    pa.array([x[1] for x in found], pa.int64()),
                    pa.array([x[2] for x in found], pa.binary()),
                    pa.array([x[3] for x in found], pa.binary()),
                    pa.nulls(len(found), pa.int64()),
                    pa.nulls(len(found), pa.int32()),
                    pa.nulls(len(found), pa.int64()),
                    pa.nulls(len(found), pa.int64()),
                ],
                names=names,
            )

        first_ref = (part << 40) + (chunk << 16)
        for batch in batches:
            # A chunk's rows are numbered in two bytes, rows without words too.
            for piece, texts in (x for a in range(0, len(batch), ROWS) for x in slices(batch.slice(a, ROWS), text_col)):
                n = len(texts)
                if first + n > ROWS or held_n > CHUNK:
                    if held:
                        yield rows_to_batch(flush())
                    held.clear()
                    chunk, first, held_n = chunk + 1, 0, 0
                    first_ref = (part << 40) + (chunk << 16)
                rows, hashes = shingle_sets(words_of(texts), n, size)
                counts = np.bincount(rows, minlength=n)
                order = np.argsort(rows, kind="stable")
                edges = np.concatenate([[0], np.cumsum(counts)])
                digests = []
                for mixed in (mix(hashes * np.uint64(0xD6E8FEB86659FD93)), mix(hashes + np.uint64(0x2545F4914F6CDD1D))):
                    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed[order])])
                    digests.append((sums[edges[1:]] - sums[edges[:-1]]).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.nulls(n, pa.int32()),
                        pa.array(first_ref + first + np.arange(n, dtype=np.int64)),
                        pa.nulls(n, pa.binary()),
                        pa.nulls(n, pa.binary()),
                        piece.column(id_col).cast(pa.int64()),
                        pa.array(counts.astype(np.int32)),
                        *(pa.array(x) for x in digests),
                    ],
                    names=names,
                )
                if len(rows):
                    held.append((rows + first, hashes))
                first, held_n = first + n, held_n + len(rows)
        if held:
            yield rows_to_batch(flush())

    names = ["bucket", "ref", "shingles", "rows", "id", "n", "digest_a", "digest_b"]
    schema = "bucket int, ref long, shingles binary, rows binary, id long, n int, digest_a long, digest_b long"
    return docs.select(id_col, text_col).mapInArrow(blocks, schema)


def _dealt(blocks: DataFrame, tasks: int) -> DataFrame:
    """Blocks of ``FINE`` neighbouring buckets to each task and texts by their number, sorted by bucket: a task holds one bucket at a time.

    Buckets are counted off, not hashed, as hashes put several times the mean into one task.
    """
    task = F.coalesce(F.floor(F.col("bucket") / F.lit(FINE)), F.pmod(F.xxhash64("ref"), F.lit(tasks)))
    return blocks.repartitionById(tasks, task.cast("int")).sortWithinPartitions("bucket")


def _shared(blocks: DataFrame, tasks: int) -> DataFrame:
    """Shingles of two rows or more with the number of their rows; rows for texts pass through."""
    schema = "ref long, shingle long, df int, id long, n int, digest_a long, digest_b long"
    names = ["ref", "shingle", "df", "id", "n", "digest_a", "digest_b"]

    def shared(batches):
        bucket, hashes, refs = None, [], []

        def found():
            if not hashes:
                return
            h, r = np.concatenate(hashes), np.concatenate(refs)
            order = np.argsort(h)
            h, r = h[order], r[order]
            start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
            df = np.diff(np.append(start, len(h)))
            df = np.repeat(df, df)
            keep = np.flatnonzero(df > 1)
            for a in range(0, len(keep), 200_000):
                k = keep[a : a + 200_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r[k]), pa.array(h[k].view(np.int64)), pa.array(df[k].astype(np.int32))]
                    + [pa.nulls(len(k), t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())],
                    names=names,
                )

        for batch in batches:
            of = batch.column("bucket").to_numpy(zero_copy_only=False)
            texts = np.isnan(of) if of.dtype.kind == "f" else np.zeros(len(of), bool)
            if texts.any():
                x = batch.filter(pa.array(texts))
                yield pa.RecordBatch.from_arrays(
                    [x.column("ref"), pa.nulls(len(x), pa.int64()), pa.nulls(len(x), pa.int32())]
                    + [x.column(c) for c in names[3:]],
                    names=names,
                )
            for i in np.flatnonzero(~texts):
                if of[i] != bucket:
                    yield from found()
                    bucket, hashes, refs = of[i], [], []
                hashes.append(_unplanes(batch.column("shingles")[i].as_py(), np.uint64))
                refs.append(_unplanes(batch.column("rows")[i].as_py(), np.uint16) + np.int64(batch.column("ref")[i].as_py()))
        yield from found()

    return _dealt(blocks, tasks).mapInArrow(shared, schema)


def _may_link(n1: Column, i1: Column, n2: Column, i2: Column, percent: int) -> Column:
    """Whether sizes, and positions in the order of a shared shingle, leave room for a link."""
    small, large = F.least(n1, n2), F.greatest(n1, n2)
    need = F.ceil(percent * (n1 + n2) / F.lit(100 + percent) - F.lit(1e-9))
    return (100 * small >= percent * large) & (1 + F.least(n1 - i1 - 1, n2 - i2 - 1) >= need)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) that link, from the shared shingles of both."""
    one = sets.select(F.col("ref").alias("a"), F.col("n").alias("n1"), F.col("shingles").alias("s1"))
    two = sets.select(F.col("ref").alias("b"), F.col("n").alias("n2"), F.col("shingles").alias("s2"))
    both = F.size(F.array_intersect("s1", "s2"))
    return (
        pairs.join(one, "a")
        .join(two, "b")
        .select("a", "b", "n1", "n2", both.alias("common"))
        .filter(100 * F.col("common") >= percent * (F.col("n1") + F.col("n2") - F.col("common")))
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """(ref, id, n_shingles, class_ref, component_id, links_seen) for each row of ``docs``.

    ``ref`` numbers rows, ``class_ref`` is the row that stands for the class and ``component_id`` the smallest id in it.
    ``links_seen`` counts the links that were looked at and hold; classes need no others.
    """
    if size < 2 or not 50 <= percent <= 100:
        raise ValueError("shingles have two words or more, and percent is 50 to 100")
    spark = docs.sparkSession
    tasks = partitions(spark)
    found = cut(_shared(_shingle_blocks(docs, id_col, text_col, size, FINE * tasks), tasks), "shingles")
    texts = found.filter("shingle is null").select("ref", "id", "n", "digest_a", "digest_b")

    # Equal sets: one row of each goes on.
    equal = (
        texts.filter("n > 0").groupBy("n", "digest_a", "digest_b").agg(F.min("ref").alias("first"), F.count("*").alias("copies"))
    )
    repeated = equal.filter("copies > 1")
    copies = cut(
        texts.join(repeated, ["n", "digest_a", "digest_b"]).filter("ref > first").select("ref", "first"), "copies"
    )

    # Shared shingles of each row that can link at all, rarest first.
    n, prefix = F.col("n"), F.col("n") - F.ceil(percent * F.col("n") / F.lit(100) - F.lit(1e-9)) + 1
    sets = (
        found.filter("shingle is not null")
        .groupBy("ref")
        .agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("items"))
        .join(texts.select("ref", "n"), "ref")
        .join(copies, "ref", "left_anti")
        .withColumn("lone", n - F.size("items"))
        .withColumn("ahead", (prefix - F.col("lone")).cast("int"))
        .filter("ahead > 0")
        .select("ref", "n", "lone", "ahead", F.col("items.shingle").alias("shingles"))
    )
    sets = cut(sets, "sets")
    entries = sets.select(
        "ref", "n", "lone", F.posexplode(F.slice("shingles", 1, F.least("ahead", F.size("shingles")))).alias("k", "shingle")
    ).select("shingle", "ref", "n", (F.col("k") + F.col("lone")).cast("int").alias("i"), (F.col("lone") / F.col("n")).alias("edge"))

    # One row of each list is compared with the others.
    heads = entries.groupBy("shingle").agg(F.min(F.struct("edge", "ref", "n", "i")).alias("h"), F.count("*").alias("m")).filter("m > 1")
    entries = cut(entries.join(heads, "shingle").select("shingle", "ref", "n", "i", "h"), "lists")
    near_head = entries.filter(F.col("ref") != F.col("h.ref")).filter(
        _may_link(F.col("n"), F.col("i"), F.col("h.n"), F.col("h.i"), percent)
    )
    pairs = near_head.select(F.least("ref", "h.ref").alias("a"), F.greatest("ref", "h.ref").alias("b")).distinct()
    links = cut(_verified(pairs, sets, percent), "links")
    classes = cut(components(links), "classes")

    # Blocks of one class and size; pairs of blocks of different classes that may link are opened.
    member = entries.drop("h").join(classes.withColumnRenamed("node", "ref"), "ref", "left").withColumn("root", F.coalesce("root", "ref"))
    member = cut(member, "members")
    blocks = member.groupBy("shingle", "root", "n").agg(F.min("i").alias("i"))
    split = blocks.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo < hi").select("shingle")
    blocks = blocks.join(split, "shingle")
    other = blocks.select("shingle", *(F.col(c).alias(f"{c}2") for c in ("root", "n", "i")))
    open_blocks = blocks.join(other, "shingle").filter(
        (F.col("root") < F.col("root2")) & _may_link(F.col("n"), F.col("i"), F.col("n2"), F.col("i2"), percent)
    ).select("shingle", "root", "n", "root2", "n2")
    one = member.select("shingle", "root", "n", F.col("ref").alias("a"), "i")
    two = member.select("shingle", F.col("root").alias("root2"), F.col("n").alias("n2"), F.col("ref").alias("b"), F.col("i").alias("i2"))
    rest = (
        open_blocks.join(one, ["shingle", "root", "n"])
        .join(two, ["shingle", "root2", "n2"])
        .filter(_may_link(F.col("n"), F.col("i"), F.col("n2"), F.col("i2"), percent))
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    more = cut(_verified(rest, sets, percent), "links")
    if more.isEmpty():
        every = classes
        all_links = links
    else:
        all_links = links.union(more)
        every = cut(components(classes.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more)), "classes")

    # Classes of all rows, copies included, and their smallest id.
    ends = all_links.select(F.explode(F.array("a", "b")).alias("ref")).groupBy("ref").agg(F.count("*").alias("links_seen"))
    stand = texts.join(copies, "ref", "left").withColumn("rep", F.coalesce("first", "ref")).drop("first")
    stand = stand.join(every.withColumnRenamed("node", "rep"), "rep", "left").withColumn("class_ref", F.coalesce("root", "rep"))
    stand = cut(stand.join(ends, "ref", "left").select("ref", "id", F.col("n").cast("long").alias("n_shingles"), "class_ref", F.coalesce("links_seen", F.lit(0)).alias("links_seen")), "rows")
    least = stand.groupBy("class_ref").agg(F.min("id").alias("component_id"), F.count("*").alias("rows")).filter("rows > 1")
    return stand.join(least.drop("rows"), "class_ref", "left").select(
        "ref", "id", "n_shingles", "class_ref", F.coalesce("component_id", "id").alias("component_id"), "links_seen"
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without the near duplicates: of each class the one with the smallest id stays.

    Rows are told apart by a number of their own, so rows that share an id, or have none, are judged by their texts alone; a
    null id stays only where a class has no other, and of rows with the same id in a class the first stays. Rows without a
    word resemble nothing and stay.
    """
    # The number travels under a name that no column has, so all columns stay as they are.
    taken = {c.lower() for c in docs.columns}
    number = next(n for n in (f"_row{'_' * i}" for i in range(len(taken) + 1)) if n not in taken)
    rows = cut(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    slim = rows.select(F.col(number).alias("_row"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    found = near_duplicates(slim, "_row", "_text", size, percent)
    # Rows that are not the first of their class, and those first ones.
    later = cut(found.filter("id != component_id").select(F.col("id").alias("_row"), F.col("component_id").alias("_class")), "later")
    first = later.select("_class").distinct().select(F.col("_class").alias("_row"), "_class")
    members = cut(later.unionByName(first).join(slim.select("_row", "_id"), "_row"), "members")
    best = members.groupBy("_class").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")).alias("b"))
    gone = cut(members.join(best.select(F.col("b._row").alias("_row")), "_row", "left_anti").select(F.col("_row").alias(number)), "gone")
    return rows.join(gone, number, "left_anti").select(*docs.columns)
