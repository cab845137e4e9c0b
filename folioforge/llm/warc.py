"""WARC: resolve revisits by payload digest and write deduplicated archives with fresh headers.

An archive is a folder of gzip files written by Spark's text writer, one record
a row, with CRLF CRLF as the end of a record; record lengths are in bytes, so
that payloads may hold any text.  Archives are read as binary files and parsed
record by record in the tasks.

Only headers (digest, id, length) are shuffled to find the first response of
each payload; a row then learns from a join by id and digest what it revisits.
While the measured list of revisits is within the bound for a broadcast, payloads
stay where they are; beyond it Spark shuffles them once.  Records are written by
classes of size with as many records to a file as keep it under ``FILE_BYTES``,
so that a reading task never holds more than that.  A file is one gzip member: it
is read from its beginning, and nothing can seek to a record in it.

A record is named by its id, its payload's digest and an ordinal, which is 0 unless
rows have both in common; a revisit names the record with ordinal 0.

Nulls and edges: a null payload counts as empty; payloads under ``least`` bytes
are always responses; a null id is a record of its own that nothing can revisit
or be told apart by, and stays a response.  Rows with equal ids and payloads are
one response and its revisits only if their ids differ, so they stay responses;
rows with equal ids and other payloads are resolved each by its own payload.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import small

END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FIELDS = "page_id string, url string, record_type string, payload_digest string, refers_to string, content_length long, payload binary"


#: Uncompressed bytes of payload in a file at most (a single larger payload has a file of its own).
FILE_BYTES = 256 << 20
#: Upper bounds of the classes of payload size.
CLASSES = tuple((16 << 10) * 4**k for k in range(8))


def headers(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Rows (id, url, payload, payload_bytes, payload_digest); the digest is the SHA-256 in lower-case hex."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    return pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha2(F.encode("payload", "UTF-8"), 256)}
    )


def resolve(records: DataFrame, *, least: int = 100) -> DataFrame:
    """Rows (id, payload_digest, refers_to) of the records that revisit another: those with the payload of a smaller id."""
    heads = records.where((F.col("payload_bytes") >= least) & F.col("id").isNotNull()).select("id", "payload_digest")
    firsts = heads.groupBy("payload_digest").agg(F.min("id").alias("refers_to"), F.count("*").alias("n")).where("n > 1").drop("n")
    return heads.join(firsts, "payload_digest").where("id <> refers_to").select("id", "payload_digest", "refers_to").distinct()


def _uuid(id_: Column, digest: Column, ordinal: Column) -> Column:
    h = F.md5(F.concat_ws(":", F.lit("record"), F.coalesce(id_.cast("string"), F.lit("")), digest, ordinal.cast("string")))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _ordinals(records: DataFrame, heads: DataFrame) -> DataFrame:
    """``records`` with an ordinal that tells rows of one id and payload apart; it is 0 for one of them.

    Rows without an id are never named by others, so theirs is any number of their
    own.  Only rows that share both are shuffled, usually none.
    """
    heads = heads.where(F.col("id").isNotNull()).groupBy("id", "payload_digest").agg(F.count("*").alias("n")).where("n > 1")
    number = F.when(F.col("id").isNull(), F.monotonically_increasing_id() + 1).otherwise(0).cast("long")
    if not heads.limit(1).count():
        return records.withColumn("ordinal", number)
    shared = small(heads.select(F.col("id").alias("_sid"), F.col("payload_digest").alias("_sdigest")))
    same = (F.col("id") == F.col("_sid")) & (F.col("payload_digest") == F.col("_sdigest"))
    alone = records.join(shared, same, "left_anti").withColumn("ordinal", number)
    place = F.row_number().over(Window.partitionBy("id", "payload_digest").orderBy("url"))
    return alone.unionByName(records.join(shared, same, "left_semi").withColumn("ordinal", (place - 1).cast("long")))


def write(records: DataFrame, revisits: DataFrame, path: str, *, heads: DataFrame | None = None, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write the archive; revisits get a record without content that names the original.

    heads: id, payload_digest and payload_bytes of the records, if they are written
    down already.  The date is a parameter: a rerun writes the same bytes, but for the order of rows that Spark reads in another order.
    """
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    clean = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), "[\\r\\n]", " ")
    revisit = F.col("refers_to").isNotNull()
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _uuid(F.col("id"), F.col("payload_digest"), F.col("ordinal"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", clean(F.col("url"))),
        F.coalesce(line("X-Page-ID", F.col("id").cast("string")), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.when(revisit, F.concat(line("WARC-Profile", F.lit(_PROFILE)), line("WARC-Refers-To", _uuid(F.col("refers_to"), F.col("payload_digest"), F.lit(0))), line("X-Refers-To-Page-ID", F.col("refers_to").cast("string")))).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
        F.lit("\r\n"),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    heads = records if heads is None else heads
    records = _ordinals(records, heads)
    named = small(revisits.withColumnsRenamed({"id": "_rid", "payload_digest": "_digest"}))
    size = F.col("payload_bytes")
    of = F.coalesce(*[F.when(size <= bound, k) for k, bound in enumerate(CLASSES)], F.lit(len(CLASSES)))
    most = {r["of"]: r["most"] for r in heads.select(of.alias("of"), size.alias("n")).groupBy("of").agg(F.max("n").alias("most")).collect()}  # a row for each class
    for k in sorted(most) or [0]:
        joined = records.where(of == k).join(named, (F.col("id") == F.col("_rid")) & (F.col("payload_digest") == F.col("_digest")), "left")
        per_file = max(1, FILE_BYTES // max(1, CLASSES[k] if k < len(CLASSES) else most[k]))
        joined.select(F.concat(head, body)).write.mode("append").option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path)


def _records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, payload) of each record of a stream of decompressed bytes."""
    buffer, at = bytearray(), 0

    def more() -> bool:
        nonlocal at
        del buffer[:at]
        at = 0
        for chunk in chunks:
            buffer.extend(chunk)
            return True
        return False

    while True:
        while (end := buffer.find(b"\r\n\r\n", at)) < 0:
            if not more():
                if bytes(buffer[at:]).strip():
                    raise ValueError("an archive ends within a record's headers")
                return
        lines = bytes(buffer[at:end]).decode("utf-8").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        head = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
        size = int(head["Content-Length"])
        at = end + 4
        while len(buffer) - at < size + 4:
            if not more():
                raise ValueError("an archive ends within a record")
        payload = bytes(buffer[at : at + size])
        if buffer[at + size : at + size + 4] != b"\r\n\r\n":
            raise ValueError("a record is not as long as its headers say")
        at += size + 4
        yield head, payload


def _unzip(content: bytes) -> Iterator[bytes]:
    """Decompressed pieces of a gzip file of one or more members."""
    data = memoryview(content)
    while len(data):
        d = zlib.decompressobj(31)
        for a in range(0, len(data), 1 << 18):
            out = d.decompress(data[a : a + (1 << 18)])
            if out:
                yield out
            if d.eof:
                break
        data = data[a + (1 << 18) - len(d.unused_data) :] if d.unused_data else data[a + (1 << 18) :]


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of an archive: its headers and its payload."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    names = [f.split()[0] for f in _FIELDS.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (*(pa.string(),) * 5, pa.int64(), pa.binary())
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for head, payload in _records(_unzip(content.as_py())):
                    rows.append((head.get("X-Page-ID"), head["WARC-Target-URI"], head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha256:"), head.get("X-Refers-To-Page-ID"), len(payload), payload))
                    size += len(payload)
                    if size > 4_000_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return files.mapInArrow(each, _FIELDS)


def deduplicate(pages: DataFrame, path: str, *, least: int = 100, **columns) -> DataFrame:
    """Write ``pages`` as a deduplicated archive at ``path`` and return the records read back from it.

    A revisit's length is that of the response it refers to; a response's length
    and digest are taken from the payload that was read.
    """
    records = headers(pages, **columns)
    folder = f"{path.rstrip('/')}-headers"  # read three times, and a hundredth of the payloads
    records.select("id", "payload_digest", "payload_bytes").write.mode("overwrite").parquet(folder)
    heads = pages.sparkSession.read.parquet(folder)
    write(records, resolve(heads, least=least), path, heads=heads)
    back = read(pages.sparkSession, path).withColumn("of_payload", F.sha2(F.col("payload"), 256))
    back = back.select("page_id", "url", "record_type", "payload_digest", "refers_to", "content_length", F.when(F.col("record_type") == "response", F.col("of_payload")).otherwise(F.col("payload_digest")).alias("found_digest"))
    cited = back.where("refers_to is not null").select("found_digest").distinct()
    lengths = back.where("record_type = 'response'").join(cited, "found_digest").groupBy("found_digest").agg(F.max("content_length").alias("original_length"))
    lengths = lengths.withColumnRenamed("found_digest", "_digest")
    back = back.join(lengths, F.col("refers_to").isNotNull() & (F.col("found_digest") == F.col("_digest")), "left")
    return back.select("page_id", "url", F.coalesce("original_length", "content_length").alias("payload_bytes"), F.col("found_digest").alias("payload_digest"), "record_type", "refers_to")
