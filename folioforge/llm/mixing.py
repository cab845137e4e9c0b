"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source gets a target number of words from its weight, at most ``repeats``
times its own size; what a capped source leaves is shared by weight among the
others until none is above (the water level is found in closed form).  A source
is laid out in a fixed random order of its documents, whole passes first and
then the beginning of one more pass, so that exactly its quota is taken and a
document is cut only where the quota ends.

The passes are divided into blocks: hash ranges of a source's documents.  A tree
splits every source's quota of blocks among the output shards: at each node the
blocks of all sources draw tickets, and the lower half of the shards gets the
counts of the smallest tickets, which is a draw from the multivariate
hypergeometric distribution of the sources' counts, exactly.  The leaves' counts
of a source then cut its blocks, in an order that is permuted anew for each
source, so that the shards' blocks are disjoint and together are all blocks.
Rows are then shuffled within a shard by a hash.

Everything is DataFrame expressions.  Running totals are taken over ranges and
within a range, never over all sources, all blocks or a whole source in one task;
texts are shuffled once, where rows of the mix are asked for.  "Random" is MD5 of
a seed and the id: reruns agree.

Nulls and edges: a null text has size 0 and nothing is taken from it; null is a
source of its own and sorts last; sources without words have target 0; rows with
equal ids are ordered by size and by a hash of their text, rows without id by that
of their text alone; rows that are equal in all of these are counted together, and
where a quota ends among them they are numbered, so that as many are taken whole as
fit and one in part; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, Scratch, running, small

#: Hash ranges that each source's documents fall into: running totals go over these, then within one.
RANGES = 4096


def _key(seed: str, *columns: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]))


def _own_key(seed: str, id_: Column, text: Column) -> Column:
    """A row's place in its source's order: a hash of its id, or of its text where it has none."""
    name = F.coalesce(id_.cast("string"), F.concat(F.lit("null:"), F.md5(text)), F.lit("null"))
    return F.md5(F.concat_ws(":", F.lit(seed), name))


def _range(key: Column) -> Column:
    return F.conv(F.substring(key, 1, 3), 16, 10).cast("int")


def targets(sizes: DataFrame, scratch: Scratch, weights: tuple[float, ...], share: float, repeats: float) -> DataFrame:
    """Rows (source, source_size, rank, weight, target) from rows (source, source_size); rank is the code-point order."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    cap = F.col("source_size") * F.lit(float(repeats))
    ranked = running(sizes, [F.col("source").asc_nulls_last()], {"rank": F.lit(1)}, scratch).withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
    # in the order of cap / weight: if the first sources are capped, the level is what is left over the weights that are left
    levelled = running(ranked.withColumn("cap", cap), [F.col("cap") / F.col("weight"), F.col("rank")], {"caps_before": F.col("cap"), "weights_before": F.col("weight")}, scratch)
    levelled = scratch.cut(levelled, "levelled")
    total = levelled.agg(F.sum("source_size").alias("sizes"), F.sum("weight").alias("weights")).first()
    level = (F.lit(total["sizes"]) * F.lit(float(share)) - F.col("caps_before")) / (F.lit(total["weights"]) - F.col("weights_before"))
    # the level that holds is the first one that does not lift its own source above its cap
    with_level = levelled.withColumn("level", level).where(F.col("level") * F.col("weight") <= F.col("cap"))
    water = with_level.agg(F.min(F.struct((F.col("cap") / F.col("weight")).alias("o"), "rank", "level")).alias("w")).select("w.level").first()["level"]
    return levelled.select("source", "source_size", "rank", "weight", F.least("cap", F.coalesce(F.lit(water).cast("double") * F.col("weight"), "cap")).alias("target"))


def split_tree(blocks: DataFrame, shards: int, seed: str, scratch: Scratch) -> DataFrame:
    """Rows (source_rank, pass, range, shard): each block to one of ``shards``, by splitting quotas down a tree.

    blocks: rows (source_rank, pass, range).  A node's threshold is found among
    4,096 ranges of tickets first and then within one range.
    """
    names = ["source_rank", "pass", "range"]
    out = blocks.select(*names).withColumns({"lo": F.lit(0), "hi": F.lit(shards)})
    for level in range(max(0, (shards - 1).bit_length())):
        ticket = _key(f"{seed}:{level}", *names)
        drawn = scratch.cut(out.withColumn("ticket", ticket).withColumn("digit", _range(F.col("ticket"))), "tickets")
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        node = Window.partitionBy("lo", "hi")
        counts = drawn.groupBy("lo", "hi", "digit").agg(F.count("*").alias("n"))
        counts = counts.withColumn("through", F.sum("n").over(node.orderBy("digit").rowsBetween(Window.unboundedPreceding, 0)))
        counts = counts.withColumn("want", F.round(F.sum("n").over(node) * (mid - F.col("lo")) / (F.col("hi") - F.col("lo"))))
        edge = counts.where("through >= want and through - n < want").select("lo", "hi", F.col("digit").alias("edge"), (F.col("want") - F.col("through") + F.col("n")).alias("more"))
        at = F.row_number().over(Window.partitionBy("lo", "hi", "digit").orderBy("ticket", *names))
        low = (F.col("digit") < F.col("edge")) | ((F.col("digit") == F.col("edge")) & (at <= F.col("more")))
        split = drawn.join(F.broadcast(edge), ["lo", "hi"], "left").withColumns({"low": F.coalesce(low, F.lit(False)), "mid": mid})  # a row for each node at most
        leaf = F.col("hi") - F.col("lo") <= 1
        out = split.select(*names, F.when(leaf | F.col("low"), F.col("lo")).otherwise(F.col("mid")).alias("lo"), F.when(leaf | ~F.col("low"), F.col("hi")).otherwise(F.col("mid")).alias("hi"))
    # what the leaves have of a source is its quota there; the source's blocks are dealt in a permuted order
    leaves = scratch.cut(out, "leaves")
    quotas = leaves.groupBy("source_rank", "lo").agg(F.count("*").alias("n"))
    through = F.sum("n").over(Window.partitionBy("source_rank").orderBy("lo").rowsBetween(Window.unboundedPreceding, 0))
    ends = quotas.withColumn("end", through).groupBy("source_rank").agg(F.sort_array(F.collect_list(F.struct("end", "lo"))).alias("ends"))  # at most ``shards`` entries
    permuted = leaves.withColumn("at", F.row_number().over(Window.partitionBy("source_rank").orderBy(_key(f"{seed}:permuted", *names), *names)))
    return permuted.join(ends, "source_rank").select(*names, F.filter("ends", lambda e: e["end"] >= F.col("at"))[0]["lo"].alias("shard"))


def plan(docs: DataFrame, scratch: Scratch, *, weights: tuple[float, ...], share: float, repeats: float, seed: str, id_col: str, text_col: str, source_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows (id, source, size, key, range), sources with their quota and where it ends)."""
    rows = scratch.cut(
        docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"), F.xxhash64(text_col).alias("hash"), _own_key(seed, F.col(id_col), F.col(text_col)).alias("key"))
        .withColumn("range", _range(F.col("key"))),
        "sizes",
    )
    by_range = scratch.cut(rows.groupBy("source", "range").agg(F.sum("size").alias("words")), "ranges")
    sources = targets(scratch.cut(by_range.groupBy("source").agg(F.sum("words").alias("source_size")), "totals"), scratch, weights, share, repeats)
    quota = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(quota / F.col("source_size"))).otherwise(0).cast("long")
    sources = scratch.cut(sources.withColumn("passes", passes).withColumn("extra", quota - F.col("passes") * F.col("source_size")), "sources")
    # the range in which the last, partial pass ends, and then the document
    so_far = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    ends = by_range.withColumn("through", F.sum("words").over(so_far)).withColumnRenamed("source", "_s").join(small(sources.select("source", "extra")), F.col("_s").eqNullSafe(F.col("source")))
    ends = scratch.cut(ends.where("extra > through - words and extra <= through and words > 0").select("source", F.col("range").alias("end_range"), (F.col("extra") - F.col("through") + F.col("words")).alias("left")), "ends")
    inside = rows.withColumnRenamed("source", "_s").join(small(ends), F.col("_s").eqNullSafe(F.col("source")) & (F.col("range") == F.col("end_range"))).drop("_s")
    # rows that nothing tells apart are one step
    steps = inside.where("size > 0").groupBy("source", "left", "key", "size", "hash").agg(F.count("*").alias("copies")).withColumn("words", F.col("copies") * F.col("size"))
    within = Window.partitionBy("source").orderBy("key", "size", "hash").rowsBetween(Window.unboundedPreceding, 0)
    last = steps.withColumn("through", F.sum("words").over(within)).where("left > through - words and left <= through")
    last = last.select("source", F.struct("key", "size", "hash", "copies", (F.col("left") - F.col("through") + F.col("words")).alias("words")).alias("end"))
    full = sources.withColumnRenamed("source", "_s").join(last, F.col("_s").eqNullSafe(F.col("source")), "left").drop("source").withColumnRenamed("_s", "source")
    return rows, scratch.cut(full, "quotas")


def extra_words(key: Column, size: Column, hash_: Column, number: Column) -> Column:
    """Words that the partial pass takes from a row, next to its source's ``end``; number: of the row among those equal to the end."""
    end = F.col("end")
    at = F.struct(key.alias("key"), size.alias("size"), hash_.alias("hash"))
    limit = F.struct(end["key"].alias("key"), end["size"].alias("size"), end["hash"].alias("hash"))
    here = F.greatest(F.lit(0), F.least(end["words"] - (number - 1) * size, size))
    return F.when(end.isNull(), F.lit(0)).when(at < limit, size).when(at == limit, here).otherwise(0).cast("long")


def numbered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """``rows`` (with their source's ``end``) with a number for those that the end has more than one of: 1, 2 ... within their source; else 1.

    They are numbered within the partitions that they were written in, behind those of the partitions before.
    """
    same = F.coalesce((F.col("end")["copies"] > 1) & (F.col("key") == F.col("end")["key"]) & (F.col("size") == F.col("end")["size"]) & (F.col("hash") == F.col("end")["hash"]), F.lit(False))
    equal = scratch.cut(rows.where(same).withColumn("_piece", F.spark_partition_id()), "equal")
    before = Window.partitionBy("rank").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = equal.groupBy("rank", "_piece").agg(F.count("*").alias("n")).select("rank", "_piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    own = equal.join(small(starts), ["rank", "_piece"]).withColumn("number", F.col("_start") + F.row_number().over(Window.partitionBy("rank", "_piece").orderBy(F.lit(1))))
    return rows.where(~same).withColumn("number", F.lit(1).cast("long")).unionByName(own.select(*rows.columns, F.col("number").cast("long")))


def draw(rows: DataFrame, sources: DataFrame, scratch: Scratch, repeats: float, shards: int, seed: str) -> DataFrame:
    """``rows`` (source, size, hash, key, range and any others) with what ``plan`` says of their source, and with draws (see ``mix``)."""
    top = int(repeats) + 1
    of_source = sources.withColumnRenamed("source", "_s")
    taken = rows.join(small(of_source), F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    several = sources.where("end.copies > 1").limit(1).count()
    taken = numbered(taken, scratch) if several else taken.withColumn("number", F.lit(1).cast("long"))
    taken = taken.withColumn("more", extra_words(F.col("key"), F.col("size"), F.col("hash"), F.col("number"))).withColumn("block", F.floor(F.col("range") / 64).cast("int"))
    # blocks of 64 ranges: at most 64 for each source and pass
    spans = sources.select(F.col("rank").alias("source_rank"), F.col("passes"), F.col("end"), F.explode(F.sequence(F.lit(0), F.lit(top - 1))).alias("pass")).where("pass < passes or (pass = passes and end is not null)")
    lists = spans.select("source_rank", "pass", F.explode(F.sequence(F.lit(0), F.when(F.col("pass") < F.col("passes"), F.lit(RANGES // 64 - 1)).otherwise(F.floor(_range(F.col("end")["key"]) / 64).cast("int")))).alias("range"))
    dealt = split_tree(lists, shards, seed, scratch).groupBy(F.col("source_rank").alias("rank"), F.col("range").alias("block")).agg(F.map_from_entries(F.collect_list(F.struct("pass", "shard"))).alias("shard_of"))
    dealt = scratch.cut(dealt, "dealt")
    joined = taken.join(small(dealt), ["rank", "block"], "left")
    words = lambda p: F.when(p < F.col("passes"), F.col("size")).when(p == F.col("passes"), F.col("more")).otherwise(F.lit(0)).cast("long")
    draws = F.transform(F.sequence(F.lit(0), F.lit(top - 1)), lambda p: F.struct(p.alias("pass"), words(p).alias("words"), F.col("shard_of")[p].alias("shard"), F.xxhash64(F.lit(seed), p, F.col("key")).alias("place")))
    return joined.withColumn("draws", F.filter(draws, lambda d: (d["words"] > 0) & d["shard"].isNotNull()))


def mix(docs: DataFrame, scratch: Scratch, *, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, repeats: float = 2.0, shards: int = 16, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each document: (id, source, size, source_size, target, taken, draws).

    Null ids and texts: see above.  draws: array of (pass, words, shard, place): each pass that takes words of
    the document, the shard its block went to, and its place there (a hash; the
    shard's rows are read in its order).
    """
    rows, sources = plan(docs, scratch, weights=weights, share=share, repeats=repeats, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col)
    # what is taken is what the tree has dealt
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda n, d: n + d["words"])
    return draw(rows, sources, scratch, repeats, shards, seed).select("id", "source", "size", "source_size", "target", taken.alias("taken"), "draws")


def rows_of_mix(docs: DataFrame, scratch: Scratch, *, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, repeats: float = 2.0, shards: int = 16, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", length_col: str | None = "n_chars") -> DataFrame:
    """The mix as rows with the columns of ``docs``: one row for each draw, by shard and by place within it.

    A row that the quota cuts has its first words, joined by single spaces, and
    its new length in ``length_col`` if ``docs`` has that column.  Shards are
    ranges of the partitions: a partition may end within a shard, so that no
    task grows with a shard.
    """
    names = docs.columns
    _, sources = plan(docs, scratch, weights=weights, share=share, repeats=repeats, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")).withColumn("_id", F.col("_row")[id_col])
    size = F.coalesce(F.regexp_count(F.col("_row")[text_col], F.lit(WORD)), F.lit(0)).cast("long")
    rows = own.select("_row", F.col("_row")[source_col].cast("string").alias("source"), size.alias("size"), F.xxhash64(F.col("_row")[text_col]).alias("hash"), _own_key(seed, F.col("_id"), F.col("_row")[text_col]).alias("key")).withColumn("range", _range(F.col("key")))
    rows = draw(rows, sources, scratch, repeats, shards, seed).select("_row", F.col("size").alias("_size"), F.explode("draws").alias("_draw"))
    rows = rows.select("_row", "_size", F.col("_draw")["words"].alias("_take"), F.col("_draw")["shard"].alias("_shard"), F.col("_draw")["place"].alias("_place"))
    rows = rows.repartitionByRange("_shard", "_place").sortWithinPartitions("_shard", "_place")
    words = F.filter(F.split(F.col("_row")[text_col], r"[\x20\x09-\x0D]+"), lambda w: w != "")
    text = F.when(F.col("_take") < F.col("_size"), F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("_take"), F.lit(1)).cast("int")), " ")).otherwise(F.col("_row")[text_col])
    out = rows.withColumn("_text", text)
    columns = {text_col: F.col("_text")}
    if length_col in names:
        columns[length_col] = F.when(F.col("_take") < F.col("_size"), F.length("_text")).otherwise(F.col("_row")[length_col])
    return out.select(*[columns.get(c, F.col("_row")[c]).cast(t).alias(c) for c, t in docs.dtypes])
