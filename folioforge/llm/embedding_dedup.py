"""Embedding near-duplicates by NN-descent, with an audit of recall.

Vectors are compared within their label only.  Equal vectors stand for one
another from the beginning.  The neighbour graph starts from bounded blocks of
vectors that are next to each other in the order of a random hyperplane code,
for a few codes.  Each round then joins neighbours of neighbours: what meets at
a vector (its neighbours and those that have it as neighbour) is compared pair
by pair, and every list keeps its best; pairs that have met before do not meet
again.  A list is saturated while its last entry still reaches the threshold: it
then takes every entry at the threshold, its length is doubled, up to
``longest``, and joins use its whole length.  Rounds end when hardly any list
changes.

Pairs at the threshold are kept.  A node with ``k`` links or more may have others
that its list or the joins left out, so these nodes are searched again without
lists: they are put into cells (blocks of a group's nodes, with a centre and a
radius), every cell meets every cell of the label that the triangle inequality
of angles does not rule out, and links between different groups join the groups.
If the audit stays under the recall in the end, cells of all nodes are searched
in the same way, which is exact.  Groups are then completed: each packed block of
a group's vectors meets each block from itself on, and only counts leave the
task, so that long lists are not needed for exact link counts.

Nulls and edges: ids are integers, labels of any type; null labels, null vectors, zero vectors and vectors with null
or non-finite components link with nothing and are components of their own;
vectors of other lengths are other labels; repeated rows count as vectors of
their own (they link with one another); a null id never becomes a component's id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Scratch, components, small

BLOCK = 256


def _unit(column: pa.Array) -> np.ndarray:
    """Unit vectors in double precision from a list column of equal lengths."""
    values = column.values.to_numpy(zero_copy_only=False)[column.offsets[0].as_py() : column.offsets[-1].as_py()].astype(np.float64)
    x = values.reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _runs(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the runs of equal rows."""
    n = len(columns[0])
    change = np.ones(n, bool)
    if n:
        change[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    at = np.flatnonzero(change)
    return list(zip(at.tolist(), [*at[1:].tolist(), n]))


def _in_blocks(keys: tuple[str, ...], most: int, each: Callable[[pa.Table], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task that cuts sorted rows into blocks of up to ``most`` rows with equal keys and gives each block to ``each``."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            held = yield from done(table.combine_chunks(), False)
        if held is not None:
            yield from done(held, True)

    def done(table: pa.Table, last: bool):
        rest = len(table)
        for a, b in _runs(*(table[c].to_numpy() for c in keys)):
            for at in range(a, b, most):
                to = min(b, at + most)
                if not last and b == len(table) and to - at < most:
                    rest = at
                    break
                yield from each(table.slice(at, to - at).combine_chunks())
        return table.slice(rest) if rest < len(table) else None

    return blocks


def _best(ids: np.ndarray, sims: np.ndarray, k: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(src, dst, sim) of each row's k best others in a block; at the threshold, of up to 4 k."""
    np.fill_diagonal(sims, -2)
    order = np.argsort(-sims, axis=1)[:, : min(4 * k, len(ids) - 1)]
    s = np.take_along_axis(sims, order, 1)
    keep = (np.arange(order.shape[1]) < k) | (s >= threshold)
    row, at = np.nonzero(keep)
    return ids[row], ids[order[row, at]], s[row, at]


_EDGE = "src long, dst long, sim double"


def first_graph(nodes: DataFrame, k: int, codes: int, threshold: float, seed: int) -> DataFrame:
    """Edges (src, dst, sim) from blocks of neighbours in the order of random hyperplane codes."""

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, lengths = np.zeros((codes, len(batch)), np.int64), batch.column("dim").to_numpy()
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                planes = np.random.default_rng([seed, int(dim)]).normal(size=(int(dim), 32 * codes))
                bits = _unit(batch.column("vec").take(pa.array(at))) @ planes > 0
                for c in range(codes):
                    code[c, at] = bits[:, 32 * c : 32 * c + 32] @ (1 << np.arange(31, -1, -1, dtype=np.int64))
            for c in range(codes):
                yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in ("node", "label", "dim", "vec")), pa.array(np.full(len(batch), c, np.int32)), pa.array(code[c])], names=["node", "label", "dim", "vec", "tree", "code"])

    def best(part: pa.Table) -> Iterator[pa.RecordBatch]:
        if len(part) > 1:
            x = _unit(part["vec"].combine_chunks())
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in _best(part["node"].to_numpy(), x @ x.T, k, threshold)], names=["src", "dst", "sim"])

    rows = nodes.mapInArrow(coded, "node long, label long, dim int, vec array<double>, tree int, code long")
    return rows.repartitionByRange("tree", "label", "dim", "code", "node").sortWithinPartitions("tree", "label", "dim", "code", "node").mapInArrow(_in_blocks(("tree", "label", "dim"), BLOCK, best), _EDGE)


def _lists(edges: DataFrame, k: int, threshold: float, longest: int) -> DataFrame:
    """The best of each list, without repeats: k entries, or as many as ``longest`` at the threshold; fresh: not in the list before."""
    ranked = edges.groupBy("src", "dst").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh")).withColumn("rank", F.row_number().over(Window.partitionBy("src").orderBy(F.desc("sim"), "dst")))
    return ranked.where((F.col("rank") <= k) | ((F.col("sim") >= threshold) & (F.col("rank") <= longest))).select("src", "dst", "sim", "fresh")


def _round(lists: DataFrame, nodes: DataFrame, k: int, threshold: float, bound: int, kind: str) -> DataFrame:
    """Edges that join neighbours of neighbours and may improve a list.

    At a node meet its list and the ``bound`` best that have it in theirs.  A list
    that is not full takes all; a full one takes what is better than its last
    entry, and what reaches the threshold.  Vectors travel as ``kind``, float if they were that before.
    """
    last = lists.groupBy("src").agg(F.when(F.count("*") < k, F.lit(-2.0)).otherwise(F.least(F.min("sim"), F.lit(threshold - 1e-12))).alias("floor"))
    back = lists.select(F.col("dst").alias("pivot"), F.col("src").alias("node"), "sim", "fresh")
    back = back.withColumn("rank", F.row_number().over(Window.partitionBy("pivot").orderBy(F.desc("sim"), "node"))).where(F.col("rank") <= bound).select("pivot", "node", "fresh")
    forth = lists.select(F.col("src").alias("pivot"), F.col("dst").alias("node"), "fresh")
    both = forth.union(back).groupBy("pivot", "node").agg(F.max("fresh").alias("fresh"))
    meet = both.join(nodes.select("node", F.col("vec").cast(f"array<{kind}>").alias("vec")), "node").join(last.withColumnRenamed("src", "node"), "node", "left")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])]).combine_chunks()
            held = yield from done(table, False)
        if held is not None:
            yield from done(held, True)

    def done(table: pa.Table, last: bool):
        runs = _runs(table["pivot"].to_numpy())
        if not last:
            held, runs = table.slice(runs[-1][0]), runs[:-1]
        nodes_, floors, fresh = table["node"].to_numpy(), table["floor"].fill_null(-2).to_numpy(), table["fresh"].to_numpy().astype(bool)
        vec = table["vec"].combine_chunks()
        found: list[list[np.ndarray]] = [[], [], []]
        for a, b in runs:
            new = fresh[a:b]
            if b - a < 2 or not new.any():
                continue
            x = _unit(vec.slice(a, b - a))
            sims = x @ x.T
            i, j = np.nonzero((sims > floors[a:b, None]) & ~np.eye(b - a, dtype=bool) & (new[:, None] | new[None, :]))
            for out, values in zip(found, (nodes_[a:b][i], nodes_[a:b][j], sims[i, j])):
                out.append(values)
        if found[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in found], names=["src", "dst", "sim"])
        return None if last else held

    return meet.repartition("pivot").sortWithinPartitions("pivot").select("pivot", "node", "floor", "fresh", "vec").mapInArrow(each, _EDGE)


def cells(members: DataFrame, by_group: bool, most: int = BLOCK, seed: int = 0) -> DataFrame:
    """Rows (cell, label, dim, center, radius, nodes, groups, vecs) from rows (node, label, dim, group, vec).

    A cell holds up to ``most`` nodes that are next to each other in the order of a hyperplane code, of one group if ``by_group``.
    radius is the largest angle to the center.
    """

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, lengths = np.zeros(len(batch), np.int64), batch.column("dim").to_numpy()
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                bits = _unit(batch.column("vec").take(pa.array(at))) @ np.random.default_rng([seed, int(dim)]).normal(size=(int(dim), 32)) > 0
                code[at] = bits @ (1 << np.arange(31, -1, -1, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(code)], names=[*batch.schema.names, "code"])

    def cell(part: pa.Table) -> Iterator[pa.RecordBatch]:
        x = _unit(part["vec"].combine_chunks())
        center = x.mean(0)
        size = np.sqrt(center @ center)
        center = center / size if size > 1e-6 else x[0]
        radius = float(np.arccos(np.clip(x @ center, -1, 1)).max())
        one = lambda v, kind: pa.array([v], kind)
        yield pa.RecordBatch.from_arrays(
            [one(part["label"][0].as_py(), pa.int64()), one(part["dim"][0].as_py(), pa.int32()), one(center, pa.list_(pa.float64())), one(radius, pa.float64()), one(part["node"].to_numpy(), pa.list_(pa.int64())), one(part["group"].to_numpy(), pa.list_(pa.int64())), one(x.ravel(), pa.list_(pa.float64()))],
            names=["label", "dim", "center", "radius", "nodes", "groups", "vecs"],
        )

    keys = ("label", "dim", "group") if by_group else ("label", "dim")
    order = [*keys, "code", "node"]
    rows = members.select("node", "label", "dim", "group", "vec").mapInArrow(coded, "node long, label long, dim int, group long, vec array<double>, code long").repartitionByRange(*order).sortWithinPartitions(*order)
    out = rows.mapInArrow(_in_blocks(keys, most, cell), "label long, dim int, center array<double>, radius double, nodes array<long>, groups array<long>, vecs array<double>")
    return out.withColumn("cell", F.monotonically_increasing_id())


def between(found: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Edges (a, b) that join groups: for each two groups in two cells, one link at the threshold if there is any.  Exact."""
    found = scratch.cut(found, "cells")
    reach = float(np.arccos(threshold)) + 1e-5
    heads = found.select("cell", "label", "dim", "center", "radius", F.array_min("groups").alias("low"), F.array_max("groups").alias("high"))
    rows = heads.join(heads.groupBy("label", "dim").agg(F.ceil(F.count("*") / 1024).cast("int").alias("blocks")), ["label", "dim"]).withColumn("block", F.pmod(F.xxhash64("cell"), F.col("blocks")).cast("int"))
    names = ["label", "dim", "i", "j", "side", "cell", "center", "radius", "low", "high"]
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    here = rows.withColumn("i", F.col("block")).withColumn("j", others).withColumn("side", F.lit(0)).where("i <= j").select(*names)
    there = rows.withColumn("j", F.col("block")).withColumn("i", others).withColumn("side", F.lit(1)).where("i <= j").select(*names)

    def near(keys: tuple, table: pa.Table) -> pa.Table:
        side, x = table["side"].to_numpy(), _unit(table["center"].combine_chunks())
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        cell, radius, low, high = (table[c].to_numpy() for c in ("cell", "radius", "low", "high"))
        same = (low[a] == high[a])[:, None] & (low[b] == high[b])[None, :] & (low[a][:, None] == low[b][None, :])
        ok = (np.arccos(np.clip(x[a] @ x[b].T, -1, 1)) <= reach + radius[a][:, None] + radius[b][None, :]) & ~same
        if keys[2].as_py() == keys[3].as_py():
            ok &= cell[a][:, None] <= cell[b][None, :]
        i, j = np.nonzero(ok)
        return pa.table({"p": cell[a][i], "q": cell[b][j]})

    pairs = here.unionByName(there).groupBy("label", "dim", "i", "j").applyInArrow(near, "p long, q long")
    side = lambda key, s: found.select(F.col("cell").alias(key), F.col("nodes").alias(f"n{s}"), F.col("groups").alias(f"g{s}"), F.col("vecs").alias(f"v{s}"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], []]
            for r in range(len(batch)):
                n, g, v = ([batch.column(f"{c}{s}")[r].values.to_numpy() for s in "ab"] for c in "ngv")
                x, y = (v[s].reshape(len(n[s]), -1) for s in (0, 1))
                i, j = np.nonzero((x @ y.T >= threshold) & (g[0][:, None] != g[1][None, :]))
                if len(i):
                    one = np.unique(np.stack([g[0][i], g[1][j]]), axis=1, return_index=True)[1]
                    out[0].append(n[0][i[one]])
                    out[1].append(n[1][j[one]])
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out], names=["a", "b"])

    both = pairs.join(side("p", "a"), "p").join(side("q", "b"), "q").select("na", "nb", "ga", "gb", "va", "vb")
    return both.mapInArrow(compare, "a long, b long")


def complete(members: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """Link counts (node, links) within groups, from rows (node, group, dim, mult, vec): every packed block meets every block from itself on."""
    sized = members.groupBy("group").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = members.join(small(sized), "group").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    order = ["group", "block", "blocks"]

    def pack(part: pa.Table) -> Iterator[pa.RecordBatch]:
        one = lambda v, kind: pa.array([v], kind)
        x = _unit(part["vec"].combine_chunks())
        yield pa.RecordBatch.from_arrays(
            [*(one(part[c][0].as_py(), kind) for c, kind in zip(order, (pa.int64(), pa.int32(), pa.int32()))), one(part["node"].to_numpy(), pa.list_(pa.int64())), one(part["mult"].to_numpy(), pa.list_(pa.int64())), one(x.ravel(), pa.list_(pa.float64()))], names=[*order, "nodes", "mults", "vecs"]
        )

    sorted_ = rows.select(*order, "node", "mult", "vec").repartition("group", "block").sortWithinPartitions("group", "block", "node")
    # a block of more rows than are packed at once becomes several rows of the same number
    packed = scratch.cut(sorted_.mapInArrow(_in_blocks(("group", "block"), 2 * BLOCK, pack), "group long, block int, blocks int, nodes array<long>, mults array<long>, vecs array<double>").withColumn("part", F.monotonically_increasing_id()), "packed")
    side = lambda s: packed.select("group", *[F.col(c).alias(f"{c}_{s}") for c in ("block", "part", "nodes", "mults", "vecs")])
    here = packed.select("group", F.explode(F.sequence("block", F.col("blocks") - 1)).alias("block_b"), *[F.col(c).alias(f"{c}_a") for c in ("block", "part", "nodes", "mults", "vecs")])
    met = here.join(side("b"), ["group", "block_b"]).where("block_a < block_b or part_a <= part_b")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, counts = [], []
            for r in range(len(batch)):
                (n, m, v), (o, w, u) = ([batch.column(f"{c}_{s}")[r].values.to_numpy() for c in ("nodes", "mults", "vecs")] for s in "ab")
                links = (v.reshape(len(n), -1) @ u.reshape(len(o), -1).T >= threshold) & (n[:, None] != o[None, :])
                nodes.append(n)
                counts.append(links @ w)
                if batch.column("part_a")[r].as_py() != batch.column("part_b")[r].as_py():
                    nodes.append(o)
                    counts.append(m @ links)
            if nodes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(counts).astype(np.int64))], names=["node", "links"])

    found = met.select("part_a", "part_b", *[f"{c}_{s}" for s in "ab" for c in ("nodes", "mults", "vecs")]).mapInArrow(each, "node long, links long")
    return found.groupBy("node").agg(F.sum("links").alias("links"))


def audit(nodes: DataFrame, linked: DataFrame, threshold: float, every: int = 100) -> DataFrame:
    """One row (pairs, found): links of a fixed set of queries by brute force, in blocks, and how many of them were found.

    The queries are the nodes whose id is divisible by ``every``; a label's rows
    and its queries are cut into blocks, and each block of rows meets each block of
    queries: a task holds two blocks, however many vectors a label has.
    """
    query = F.pmod(F.col("rep"), F.lit(every)) == 0
    spans = nodes.groupBy("label", "dim").agg(F.ceil(F.count("*") / 4096).cast("int").alias("blocks"), F.ceil(F.count_if(query) / 2048).cast("int").alias("asked"))
    rows = nodes.join(spans, ["label", "dim"])
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    queries = rows.where(query).withColumn("ask", own("asked")).select("label", "dim", "ask", all_of("blocks").alias("block"), F.lit(0).alias("side"), "node", "mult", "vec")
    data = rows.where("asked > 0").withColumn("block", own("blocks")).select("label", "dim", all_of("asked").alias("ask"), "block", F.lit(1).alias("side"), "node", "mult", "vec")

    def each(keys: tuple, table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        a, b = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        node, mult = table["node"].to_numpy(), table["mult"].to_numpy()
        if not len(a) or not len(b):
            return pa.table({"node": pa.array([], pa.int64()), "pairs": pa.array([], pa.int64())})
        x = _unit(table["vec"].combine_chunks())
        links = (x[a] @ x[b].T >= threshold) & (node[a][:, None] != node[b][None, :])
        return pa.table({"node": node[a], "pairs": links @ mult[b]})

    truth = queries.unionByName(data).groupBy("label", "dim", "ask", "block").applyInArrow(each, "node long, pairs long").groupBy("node").agg(F.sum("pairs").alias("pairs"))
    return truth.join(linked, "node", "left").agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"), F.coalesce(F.sum(F.least("pairs", F.coalesce("links", F.lit(0)))), F.lit(0)).alias("found"))


def _label(vectors: DataFrame, column: str) -> Column:
    """A label as a number: integers as they are, any other type by a 64-bit hash of its text; null stays null."""
    if dict(vectors.dtypes)[column] in ("tinyint", "smallint", "int", "bigint", "boolean"):
        return F.col(column).cast("long")
    return F.when(F.col(column).isNotNull(), F.xxhash64(F.col(column).cast("string")))


def near_duplicates(vectors: DataFrame, scratch: Scratch, *, threshold: float = 0.93, k: int = 8, longest: int = 64, codes: int = 6, rounds: int = 3, settled: float = 0.002, seed: int = 11, recall: float | None = None, report: dict | None = None, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row for each vector: (id, n_links, component_id, kept).

    With ``recall`` the audit runs as well, and codes are added (twice as many,
    up to twice) while the share of links found is below it; then all nodes are
    compared through cells and audited again, and a recall that is still below is
    an error.  ``report`` takes what was measured: pairs (links of the audited
    vectors), found, attempts, and longest_list of the last graph.
    """
    report = {} if report is None else report
    kind = "float" if dict(vectors.dtypes)[vector_col] == "array<float>" else "double"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), _label(vectors, label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vec"))
    good = rows.where(usable(F.col("vec")) & F.col("label").isNotNull()).withColumn("vec", F.transform("vec", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)))
    # 128 bits name a vector within its label, so that no later join moves or compares vectors
    good = good.withColumns({"h1": F.xxhash64("label", "vec"), "h2": F.xxhash64(F.lit("second"), "vec", "label")})
    nodes = good.groupBy("label", "h1", "h2").agg(F.min("id").alias("rep"), F.count("*").alias("mult"), F.first("vec").alias("vec")).withColumn("node", F.monotonically_increasing_id()).withColumn("dim", F.size("vec"))
    nodes = scratch.cut(nodes.select("node", "label", "h1", "h2", "dim", "rep", "mult", "vec"), "nodes")

    def grouped(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Components, and the link counts within them."""
        comps = components(edges, scratch)
        members = scratch.cut(nodes.join(comps, "node").select("node", F.col("component").alias("group"), "dim", "mult", "vec"), "members")
        return comps, scratch.cut(complete(members, threshold, scratch), "links")

    def audited(linked: DataFrame) -> bool:
        seen = audit(nodes, linked, threshold).first()
        report.update(pairs=seen["pairs"], found=seen["found"])
        return seen["found"] >= recall * seen["pairs"]

    for attempt in range(3):
        lists = scratch.cut(_lists(first_graph(nodes, k, codes << attempt, threshold, seed + attempt).withColumn("fresh", F.lit(1)), k, threshold, 2 * k), "lists")
        n, bound = lists.count(), 2 * k
        for _ in range(rounds):
            new = _round(lists, nodes, k, threshold, bound, kind)
            bound = min(longest, 2 * bound)
            better = scratch.cut(_lists(lists.withColumn("fresh", F.lit(0)).union(new.withColumn("fresh", F.lit(1))), k, threshold, bound), "lists")
            changed = better.where("fresh = 1").count()
            scratch.drop(lists)
            lists = better
            if changed <= settled * max(1, n):
                break
        report.update(attempts=attempt + 1, longest_list=lists.groupBy("src").count().agg(F.max("count")).first()[0] or 0)
        edges = lists.where(F.col("sim") >= threshold).select(F.col("src").alias("a"), F.col("dst").alias("b"))
        comps = components(edges, scratch)
        # lists and joins take k links of a node for certain: nodes with as many are searched without lists
        dense = edges.union(edges.select("b", "a")).distinct().groupBy("a").count().where(F.col("count") >= k).select(F.col("a").alias("node"))
        sought = nodes.join(comps, "node").join(dense, "node").withColumnRenamed("component", "group")
        joined = scratch.cut(edges.union(between(cells(sought, True, seed=seed), threshold, scratch)), "joined")
        comps, linked = grouped(joined)
        if recall is None or audited(linked):
            break
        if attempt == 2:
            everyone = nodes.join(comps, "node", "left").withColumn("group", F.coalesce("component", "node"))
            comps, linked = grouped(joined.union(between(cells(everyone, False, seed=seed), threshold, scratch)))
            if not audited(linked):
                raise ValueError(f"recall {report['found']} of {report['pairs']} links is below {recall}")
    named = nodes.select("node", "h1", "h2", "label", "rep", "mult").join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    full = scratch.cut(named.join(least, "component").join(linked, "node", "left").select("label", "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "component_id"), "full")
    apart = rows.where(~(F.coalesce(usable(F.col("vec")), F.lit(False)) & F.col("label").isNotNull())).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    answered = good.select("id", "label", "h1", "h2").join(small(full), ["label", "h1", "h2"]).select("id", F.col("n_links").cast("long"), "component_id")
    return answered.union(apart).withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
