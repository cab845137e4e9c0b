"""Chunkers: DataFrame in, one row for each chunk out.

All of them cut inside the row that holds the text (higher-order functions or Arrow
tasks, no shuffle); chunks are exploded as small structs, so that the tokens of a text are
not copied for each chunk.  A null or blank text has no chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..functions.text import clean, clean_tokens, sentences, tokens


def _joined(t: Column, start: Column, n) -> Column:
    return F.array_join(F.slice(t, start + 1, n), " ")


def _explode(df: DataFrame, chunks: Column, keep: list[str]) -> DataFrame:
    return df.select(*keep, F.posexplode(chunks).alias("chunk_index", "c")).select(*keep, "chunk_index", "c.*")


def _before(sizes: Column, block: int = 256) -> Column:
    """For each size the sum of those before it: over blocks and then within each, so that a long list is not copied at each step."""
    zero = F.lit(0).cast("long")

    def starts(of: Column, first: Column) -> Column:
        grown = lambda a, n: F.struct((a["at"] + n).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all"))
        return F.aggregate(of, F.struct(first.alias("at"), F.array().cast("array<bigint>").alias("all")), grown, lambda a: a["all"])

    last = F.floor((F.size(sizes) - 1) / block).cast("int")
    blocks = F.when(F.size(sizes) > 0, F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(sizes, b * block + 1, block))).otherwise(F.array().cast("array<array<bigint>>"))
    sums = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda a, n: a + n))
    return F.flatten(F.zip_with(blocks, starts(sums, zero), starts))


def _windows(df: DataFrame, starts: Column, size: int, step: int, text_col: str, keep: list[str]) -> DataFrame:
    """One row for each window of ``size`` tokens (array column _t) at ``starts``; characters are counted in the tokens joined by single spaces.

    Lengths are summed over runs of ``step`` tokens once for each text.
    """
    t, n = F.col("_t"), F.size("_t")
    runs = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1, F.lit(step)), lambda r: F.length(_joined(t, r, step)).cast("long") + 1)).otherwise(F.array().cast("array<bigint>"))
    df = df.select(*keep, "_t", starts.alias("_s"), runs.alias("_r")).select(*keep, "_t", "_s", _before(F.col("_r")).alias("_p"))

    def one(start: Column) -> Column:
        text, whole, more = _joined(t, start, size), F.floor(start / step).cast("int"), start % step
        before = F.get(F.col("_p"), whole) + F.when(more > 0, F.length(_joined(t, whole * step, more)) + 1).otherwise(0)
        return F.struct(text.alias("text"), before.cast("int").alias("start_char"), start.cast("int").alias("first_token"), F.least(start + size, n).cast("int").alias("end_token"))

    out = _explode(df, F.transform("_s", one), keep)
    return out.select(*keep, "chunk_index", "text", "start_char", (F.col("start_char") + F.length("text")).alias("end_char"), "first_token", "end_token")


def token_offsets(df: DataFrame, *, text_col: str = "text", keep: list[str] | None = None, block: int = 256) -> DataFrame:
    """Where every token begins among the tokens joined by single spaces.

    A task goes through each text once, ``block`` texts at a time; what it gives
    out at a time is bounded by tokens too, but for a longer text.
    """
    keep = keep or ["doc_id"]
    schema = StructType([*df.select(*keep).schema, StructField("pos", IntegerType()), StructField("start_char", LongType())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, texts = batch.columns[:-1], batch.columns[-1]

            def made() -> pa.RecordBatch:
                counts = np.array([len(s) for s in starts])
                at = pa.array(np.repeat(np.array(rows), counts))
                pos = np.concatenate([np.arange(n, dtype=np.int32) for n in counts])
                return pa.RecordBatch.from_arrays([*(c.take(at) for c in own), pa.array(pos), pa.array(np.concatenate(starts))], names=schema.names)

            for a in range(0, len(batch), block):
                rows, starts, held = [], [], 0
                for i, text in enumerate(texts.slice(a, block).to_pylist(), a):
                    # what str.split takes for white space is WS
                    sizes = np.fromiter(map(len, (text or "").split()), np.int64)
                    if len(sizes):
                        rows.append(i)
                        starts.append(np.cumsum(sizes + 1) - sizes - 1)
                        held += len(sizes)
                    if held > 500_000:
                        yield made()
                        rows, starts, held = [], [], 0
                if rows:
                    yield made()

    return df.select(*keep, F.make_valid_utf8(F.col(text_col)).alias("_text")).mapInArrow(each, schema)


def token_windows(df: DataFrame, *, size: int = 1000, overlap: int = 200, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Windows of ``size`` tokens with an overlap; the first window that reaches the end is the last."""
    if not 0 <= overlap < size:
        raise ValueError("overlap has to be at least 0 and smaller than size")
    keep, step = keep or ["doc_id"], size - overlap
    df = df.withColumn("_t", tokens(F.col(text_col)))
    n = F.size("_t")
    count = F.when(n == 0, 0).when(n <= size, 1).otherwise(F.ceil((n - size) / step) + 1)
    starts = F.when(count > 0, F.transform(F.sequence(F.lit(0), count.cast("int") - 1), lambda i: i * step)).otherwise(F.array().cast("array<int>"))
    return _windows(df, starts, size, step, text_col, keep)


def stepped_windows(df: DataFrame, *, size: int = 1000, overlap: int = 200, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Windows at every multiple of the step, so that the last ones may lie within their predecessor."""
    keep, step = keep or ["doc_id"], size - max(0, overlap)
    if step <= 0:
        raise ValueError("overlap has to be smaller than size")
    df = df.withColumn("_t", tokens(F.col(text_col)))
    n = F.size("_t")
    starts = F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return _windows(df, starts, size, step, text_col, keep)


def sliding_windows(df: DataFrame, *, window: int = 512, step: int = 256, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Full windows only, and then one remainder that begins where the last full window ends."""
    if not 0 < step <= window:
        raise ValueError("step has to be at least 1 and at most window")
    keep = keep or ["doc_id"]
    df = df.withColumn("_t", tokens(F.col(text_col)))
    n = F.size("_t")
    full = F.floor((n - window) / step).cast("int")
    starts = (
        F.when(n == 0, F.array().cast("array<int>"))
        .when(n <= window, F.array(F.lit(0)))
        .otherwise(F.concat(F.transform(F.sequence(F.lit(0), full), lambda i: i * step), F.when(full * step + window < n, F.array(full * step + window)).otherwise(F.array().cast("array<int>"))))
    )
    return _windows(df, starts, window, step, text_col, keep).withColumn("remainder", (F.col("first_token") > 0) & (F.col("end_token") - F.col("first_token") < window))


def sentence_packs(df: DataFrame, *, most: int = 1500, respect_sentences: bool = True, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Cleaned text as one chunk, or greedily packed sentences where it has more than ``most`` tokens.

    A sentence longer than ``most`` is a chunk of its own; without
    ``respect_sentences`` the tokens are cut into runs of ``most``.
    """
    keep = keep or ["doc_id"]
    df = df.select(*keep, clean(F.coalesce(F.col(text_col), F.lit(""))).alias("_c"))
    if respect_sentences:
        df = df.withColumn("_n", F.size(tokens(F.col("_c"))))
        # the fold goes over numbers of tokens and keeps where chunks begin; texts are joined once
        df = df.withColumn("_s", F.when(F.col("_n") > most, sentences(F.col("_c"))).otherwise(F.array().cast("array<string>")))
        df = df.withColumn("_k", F.transform("_s", lambda s, i: F.struct(i.alias("i"), F.size(tokens(s)).alias("n"))))
        start = F.struct(F.array().cast("array<int>").alias("at"), F.lit(0).alias("n"))

        def add(acc: Column, s: Column) -> Column:
            new = (s["i"] == 0) | (acc["n"] + s["n"] > most)
            return F.struct(F.when(new, F.concat(acc["at"], F.array(s["i"]))).otherwise(acc["at"]).alias("at"), F.when(new, s["n"]).otherwise(acc["n"] + s["n"]).alias("n"))

        df = df.withColumn("_a", F.aggregate("_k", start, add, lambda acc: acc["at"]))
        long = F.transform("_a", lambda a, i: F.array_join(F.slice("_s", a + 1, F.coalesce(F.get(F.col("_a"), i + 1), F.size("_s")) - a), " "))
    else:
        # the tokens are a column: as an expression inside the lambda the whole text would be split again for each chunk
        df = df.withColumn("_t", clean_tokens(F.col("_c"))).select(*keep, "_c", "_t", F.size("_t").alias("_n"))
        long = F.transform(F.sequence(F.lit(0), F.greatest(F.col("_n") - 1, F.lit(0)), F.lit(most)), lambda s: _joined(F.col("_t"), s, most))
    texts = F.when(F.col("_n") == 0, F.array().cast("array<string>")).when(F.col("_n") <= most, F.array("_c")).otherwise(long)
    out = df.select(*keep, F.posexplode(texts).alias("chunk_index", "text"))
    return out.withColumn("token_count", F.size(tokens(F.col("text"))))


def character_windows(df: DataFrame, *, size: int = 131_072, overlap: int = 4_000, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Windows of characters, for texts longer than a model's context."""
    keep, step = keep or ["doc_id"], size - overlap
    n = F.length(F.coalesce(F.col(text_col), F.lit("")))
    count = F.when(n == 0, 0).when(n <= size, 1).otherwise(F.ceil((n - size) / step) + 1)
    starts = F.when(count > 0, F.transform(F.sequence(F.lit(0), count.cast("int") - 1), lambda i: i * step)).otherwise(F.array().cast("array<int>"))
    chunks = F.transform(starts, lambda s: F.struct(s.alias("start_char"), F.substring(F.col(text_col), s + 1, F.lit(size)).alias("text")))
    return _explode(df, chunks, keep).withColumn("end_char", F.col("start_char") + F.length("text"))


def context_windows(df: DataFrame, *, size: int = 4_000, overlap: int = 800, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Windows of characters, each with the text from one window before it to one behind it as its context."""
    out = character_windows(df.withColumn("_whole", F.col(text_col)), size=size, overlap=overlap, text_col=text_col, keep=[*(keep or ["doc_id"]), "_whole"])
    first = F.greatest(F.lit(0), F.col("start_char") - size)
    return out.withColumn("context", F.substring(F.col("_whole"), first + 1, F.col("end_char") + size - first)).drop("_whole")


def snapped_windows(df: DataFrame, *, size: int = 4_000, overlap: int = 800, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Windows of characters that end behind the first full stop and space of their last 100 characters, if there is one.

    Where a window begins depends on where the one before it ended, so a task
    goes through each text once.
    """
    if size <= overlap + 98:
        raise ValueError("size has to be more than the overlap and the 98 characters that a window may lose")
    keep = keep or ["doc_id"]
    kinds = dict(df.dtypes)

    def spans(text: str) -> Iterator[tuple[int, int]]:
        start = 0
        while start < len(text):
            end = min(start + size, len(text))
            if end < len(text) and (stop := text.find(". ", max(start, end - 100), end)) >= 0:
                end = stop + 2
            yield start, end
            if end >= len(text):
                return
            start = end - overlap

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, found, held = [], [], 0
            texts = batch.column(text_col)

            def made() -> pa.RecordBatch:
                own = pa.RecordBatch.from_arrays([batch.column(c) for c in keep], names=keep).take(pa.array(row, pa.int64()))
                columns = [pa.array(c, k) for c, k in zip(zip(*found), (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string()))]
                return pa.RecordBatch.from_arrays([*own.columns, *columns], names=[*keep, "chunk_index", "total_chunks", "start_char", "end_char", "text"])

            for i in range(len(batch)):
                text = texts[i].as_py() or ""
                cuts = list(spans(text))
                for n, (a, b) in enumerate(cuts):
                    row.append(i)
                    found.append((n, len(cuts), a, b, text[a:b]))
                    held += b - a
                    if held > 4_000_000:
                        yield made()
                        row, found, held = [], [], 0
            if row:
                yield made()

    out = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "chunk_index int, total_chunks int, start_char int, end_char int, text string"])
    return df.select(*keep, F.col(text_col)).mapInArrow(each, out)


def pooled_windows(tokens_: DataFrame, *, size: int, overlap: int, by: str = "doc_id") -> DataFrame:
    """Late chunks over token vectors: rows (by, pos, start, end, special, vec) to one mean vector, of length 1, for each window.

    Special tokens at the ends of a window do not count, and a window of special
    tokens only is no chunk.  Each token is sent to the windows it is in; sums
    are taken per window and dimension with partial aggregation.
    """
    if not 0 <= overlap < size:
        raise ValueError("overlap has to be at least 0 and smaller than size")
    step = size - overlap
    count = tokens_.groupBy(by).agg((F.max("pos") + 1).alias("n"))
    at = tokens_.join(count, by)
    last = F.when(F.col("n") <= size, 0).otherwise(F.ceil((F.col("n") - size) / step)).cast("int")
    first = F.greatest(F.lit(0), F.ceil((F.col("pos") - size + 1) / step).cast("int"))
    upto = F.least(last, F.floor(F.col("pos") / step).cast("int"))
    inside = at.where(first <= upto).withColumn("w", F.explode(F.sequence(first, upto)))
    plain = F.col("special") == 0
    spans = inside.groupBy(by, "w").agg(F.min(F.when(plain, F.col("pos"))).alias("first_token"), F.max(F.when(plain, F.col("pos"))).alias("last_token"), F.min(F.when(plain, F.struct("pos", "start"))).alias("s"), F.max(F.when(plain, F.struct("pos", "end"))).alias("e")).where("first_token is not null")
    used = inside.join(spans, [by, "w"]).where("pos between first_token and last_token")
    means = used.select(by, "w", F.posexplode("vec").alias("d", "x")).groupBy(by, "w", "d").agg(F.avg(F.col("x").cast("double")).alias("m"))
    vectors = means.groupBy(by, "w").agg(F.transform(F.array_sort(F.collect_list(F.struct("d", "m"))), lambda x: x["m"]).alias("v"))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    from pyspark.sql import Window

    order = Window.partitionBy(by).orderBy("w")
    return (
        vectors.withColumn("embedding", F.when(norm > 0, F.transform("v", lambda x: x / norm)).otherwise(F.col("v")))
        .join(spans, [by, "w"])
        .select(by, (F.row_number().over(order) - 1).alias("chunk_index"), F.count("*").over(Window.partitionBy(by)).alias("total_chunks"), "first_token", (F.col("last_token") + 1).alias("end_token"), F.col("s.start").alias("start_char"), F.col("e.end").alias("end_char"), "embedding")
    )


#: Chunkers by name.
STRATEGIES = {"token": token_windows, "semantic": sentence_packs, "sliding": sliding_windows, "sliding_window": sliding_windows}


def chunk(df: DataFrame, strategy: str, **options) -> DataFrame:
    try:
        return STRATEGIES[strategy.lower()](df, **options)
    except KeyError:
        raise ValueError(f"unknown chunking strategy: {strategy}") from None
