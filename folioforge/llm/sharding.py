"""Sharding: the minimax contiguous partition of ordered atomic groups by bytes.

Groups of equal texts are never cut.  They stand in the order of their smallest
id (then their digest), and consecutive runs of groups fill the shards so that
the largest shard is as small as it can be: a binary search over the capacity,
each step checked greedily from the left.

The groups' sizes are never collected.  The check works on a bounded summary:
the order is divided into blocks, and only the blocks where a cut may fall are
divided again, until each holds one group.  For a capacity, filling whole blocks
only gives a sure yes, and filling blocks as if they could be cut anywhere gives
a sure no; the refinement ends when both agree on the smallest capacity.

Nulls and edges: a null text counts as empty (size 1, crc32 0) and belongs to
the group of empty texts; a null id comes first; rows with equal ids are rows of
their own.  Shards that no group needs stay empty; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch, plain_string, running, small

#: Blocks in a summary that the driver holds.
BLOCKS = 2_000


def _fill(ends: list[int], capacity: int, shards: int, whole: bool) -> tuple[bool, list[float]]:
    """Greedy filling by a capacity over block ends (prefix sums); returns whether it fits, and the cuts."""
    at, cuts = 0, []
    for _ in range(shards):
        if whole:
            k = bisect_right(ends, at + capacity) - 1
            to = ends[k] if k >= 0 else 0
        else:
            to = at + capacity
        if to <= at:
            return False, cuts
        at = to
        cuts.append(at)
        if at >= ends[-1]:
            return True, cuts
    return False, cuts


def _smallest(ends: list[int], shards: int, whole: bool, floor: int) -> int:
    lo, hi = max(floor, -(-ends[-1] // shards)), ends[-1]
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if _fill(ends, mid, shards, whole)[0] else (mid + 1, hi)
    return lo


def cut_points(groups: DataFrame, shards: int, scratch: Scratch, blocks: int = BLOCKS) -> list[tuple]:
    """The first (key, digest) of each shard but the first, from rows (key, digest, bytes)."""
    total, largest, n = groups.agg(F.sum("bytes"), F.max("bytes"), F.count("*")).first()
    if not n:
        return []
    order = F.struct("key", "digest")
    # blocks: [first (key, digest), or None below all), bytes, groups]
    pieces = [(None, total, n)]
    while True:
        ends, acc = [], 0
        for _, size, _ in pieces:
            acc += size
            ends.append(acc)
        sure = _smallest(ends, shards, True, largest)
        maybe = _smallest(ends, shards, False, largest)
        if all(p[2] == 1 for p in pieces):
            cuts = _fill(ends, sure, shards, True)[1]
            return [pieces[bisect_right(ends, c)][0] for c in cuts if c < total]
        # the j-th cut lies between that of whole blocks at the lowest capacity and that of cut blocks at the highest
        split = set()
        low = high = 0
        for _ in range(shards):
            k = bisect_right(ends, low + maybe) - 1
            low = max(low, ends[k] if k >= 0 else 0)
            high = min(total, high + sure)
            first, last = bisect_right(ends, low), min(len(ends) - 1, bisect_right(ends, high))
            split |= {i for i in range(first, last + 1) if pieces[i][2] > 1}
            if low >= total:
                break
        if not split:
            cuts = _fill(ends, sure, shards, True)[1]
            return [pieces[bisect_right(ends, c)][0] for c in cuts if c < total]
        pieces = _divide(groups, order, pieces, sorted(split), blocks)


def _divide(groups: DataFrame, order, pieces: list[tuple], split: list[int], blocks: int) -> list[tuple]:
    """The pieces with those at the indices ``split`` divided at about equal numbers of groups."""
    spark = groups.sparkSession
    kind = dict(groups.dtypes)["key"]
    bounds = [(i, *(p[0] or (None, None)), *((pieces[i + 1][0] if i + 1 < len(pieces) else None) or (None, None)), p[0] is None, i + 1 >= len(pieces)) for i, p in ((i, pieces[i]) for i in split)]
    table = spark.createDataFrame(bounds, f"piece int, k0 {kind}, d0 string, k1 {kind}, d1 string, lowest boolean, highest boolean")
    inside = groups.join(
        F.broadcast(table),  # at most as many rows as the summary has blocks
        (F.col("lowest") | (order >= F.struct(F.col("k0").alias("key"), F.col("d0").alias("digest")))) & (F.col("highest") | (order < F.struct(F.col("k1").alias("key"), F.col("d1").alias("digest")))),
    ).select("piece", "key", "digest", "bytes")
    each = max(2, blocks // len(split))
    marks = inside.groupBy("piece").agg(F.percentile_approx("key", [i / each for i in range(1, each)], 50 * each).alias("marks"), F.min("key").alias("least"))
    # a block ends where the key passes a mark, and after the least key, so that a piece that stays whole has one key
    passed = F.size(F.filter("marks", lambda m: m <= F.col("key"))) + F.coalesce((F.col("key") > F.col("least")).cast("int"), F.lit(0))
    part = (
        inside.join(F.broadcast(marks), "piece")
        .withColumn("part", passed)
        .groupBy("piece", "part")
        .agg(F.min(order).alias("first"), F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
        .orderBy("piece", "first")
        .collect()  # at most ``blocks`` rows and one for each piece
    )
    done: dict[int, list[tuple]] = {}
    for r in part:
        done.setdefault(r["piece"], []).append(((r["first"]["key"], r["first"]["digest"]), r["bytes"], r["n"]))
    equal = [i for i, new in done.items() if len(new) == 1 and new[0][2] > 1]
    if equal:  # pieces of one key (ids that repeat, or null): divided by the digest, each again at about equal numbers
        alike = inside.where(F.col("piece").isin(equal)).withColumn("number", F.conv(F.substring("digest", 1, 13), 16, 10).cast("double"))
        ends = alike.groupBy("piece").agg(F.percentile_approx("number", [i / each for i in range(1, each)], 50 * each).alias("marks"), F.min("digest").alias("d0"), F.max("digest").alias("d1"))
        by_digest = (
            alike.join(F.broadcast(ends), "piece")  # as many rows as pieces
            # the last digest is a block of its own, so that every round makes blocks smaller
            .withColumn("part", F.when(F.col("digest") == F.col("d1"), each).otherwise(F.size(F.filter("marks", lambda m: m <= F.col("number")))))
            .groupBy("piece", "part")
            .agg(F.min(order).alias("first"), F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
            .orderBy("piece", "first")
            .collect()  # at most ``blocks`` rows and one for each piece
        )
        done.update({i: [] for i in equal})
        for r in by_digest:
            done[r["piece"]].append(((r["first"]["key"], r["first"]["digest"]), r["bytes"], r["n"]))
    return [q for i, p in enumerate(pieces) for q in done.get(i, [p])]


def shard(docs: DataFrame, shards: int, scratch: Scratch, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, size, text_crc32, digest, shard, slot): one for each row; texts stay where they are.

    slot counts from 0 within a shard in the order of the ids; ranges of rows are numbered side by side.
    """
    text = plain_string(text_col)
    raw = F.encode(text, "UTF-8")
    rows = scratch.cut(
        docs.select(F.col(id_col).alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"), F.sha2(raw, 256).alias("digest")), "rows"
    )
    groups = scratch.cut(rows.groupBy("digest").agg(F.min("id").alias("key"), F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    cuts = cut_points(groups, shards, scratch)
    number = F.lit(0)
    for key, digest in cuts:  # one for each shard
        number = number + F.when(F.struct("key", "digest") >= F.struct(F.lit(key).cast(dict(groups.dtypes)["key"]).alias("key"), F.lit(digest).alias("digest")), 1).otherwise(0)
    placed = groups.select("digest", number.alias("shard"), "n")
    alone = F.col("n") == 1
    copies = small(placed.where(~alone).select("digest", F.col("shard").alias("of_group")))
    with_shard = (
        rows.join(copies, "digest", "left")
        .withColumn("key", F.col("id"))
        .withColumn("shard", F.coalesce("of_group", number))
        .select("id", "size", "text_crc32", "digest", "shard")
    )
    places = running(with_shard.select("id", "size", "text_crc32", "digest", "shard"), [F.col("shard"), F.col("id").asc_nulls_first(), F.col("digest")], {"at": F.lit(1)}, scratch)
    firsts = places.groupBy("shard").agg(F.min("at").alias("first"))
    return places.join(F.broadcast(firsts), "shard").select("id", "size", "text_crc32", "digest", "shard", (F.col("at") - F.col("first")).alias("slot"))  # a row for each shard
