"""Sources: JSON lines, texts by file, feeds of XML entries, LaTeX archives."""

from __future__ import annotations

import gzip
import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.corpus import latest_per_key, metadata_rows


def metadata(spark: SparkSession, path: str) -> DataFrame:
    """Metadata rows from files of JSON lines; malformed lines are dropped."""
    return metadata_rows(spark.read.text(path))


def metadata_cache(spark: SparkSession, path: str) -> DataFrame:
    """One row for each id: the last line of the last file wins.

    A line's place is where its piece of the file begins, and then its number
    within the task that read the piece.
    """
    place = {"file": F.col("_metadata.file_path"), "block": F.col("_metadata.file_block_start"), "line": F.monotonically_increasing_id()}
    lines = spark.read.text(path).select("value", *[c.alias(n) for n, c in place.items()])
    rows = lines.select(*place, "value", F.get_json_object("value", "$.id").alias("id")).where("id is not null")
    return metadata_rows(latest_per_key(rows, ["id"], [F.desc(n) for n in place]))


def texts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (id, text): each .txt file of a folder; the id is the file's name."""
    files = spark.read.option("wholetext", True).option("pathGlobFilter", "*.txt").text(folder)
    return files.select(F.regexp_extract(F.col("_metadata.file_name"), r"(.*)\.txt$", 1).alias("id"), F.col("value").alias("text"))


def feed_entries(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """Rows of the entries in Atom feeds: id, version dropped, title and summary in single spaces, authors, times."""
    schema = "struct<entry:array<struct<id:string,title:string,summary:string,published:string,updated:string,author:array<struct<name:string>>>>>"
    parsed = payloads.select(F.explode(F.from_xml(F.col(column), schema)["entry"]).alias("e"))
    one = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    name = F.element_at(F.split(F.col("e.id"), "/abs/"), -1)
    return parsed.select(
        F.regexp_replace(name, r"v\d+$", "").alias("arxiv_id"), one(F.col("e.title")).alias("title"), one(F.col("e.summary")).alias("abstract"), F.transform("e.author", lambda a: a["name"]).alias("authors"), F.to_timestamp("e.published").alias("published"), F.to_timestamp("e.updated").alias("updated")
    )


def requested(ids: DataFrame, entries: DataFrame) -> DataFrame:
    """Every requested id, in a left join with the entries that were found (a version in the request does not matter)."""
    base = ids.withColumn("_base", F.regexp_replace("arxiv_id", r"v\d+$", ""))
    return base.join(entries.withColumnRenamed("arxiv_id", "_base"), "_base", "left").drop("_base")


def _unpack(content: bytes) -> tuple[str | None, str | None, str | None]:
    """(main source, bibliography, error) of a gzip file that holds a tar archive or one source."""
    try:
        data = gzip.decompress(content)
        if data[257:262] != b"ustar":
            return data.decode("utf-8", "replace"), None, None
        with tarfile.open(fileobj=io.BytesIO(data)) as tar:
            files = {m.name: tar.extractfile(m).read().decode("utf-8", "replace") for m in tar.getmembers() if m.isfile() and m.name.endswith((".tex", ".bbl"))}
        tex = [v for k, v in sorted(files.items()) if k.endswith(".tex")]
        return (max(tex, key=len) if tex else None), "\n".join(v for k, v in sorted(files.items()) if k.endswith(".bbl")) or None, None if tex else "no source in the archive"
    except Exception as e:  # one bad file is a row with its error
        return None, None, f"{type(e).__name__}: {e}"


def latex_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Rows (path, source, bibliography, error) from .gz files; the largest .tex of an archive is its source."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "content")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                yield pa.RecordBatch.from_pylist([dict(zip(("path", "source", "bibliography", "error"), (path.as_py(), *_unpack(content.as_py()))))], schema=pa.schema([(n, pa.string()) for n in ("path", "source", "bibliography", "error")]))

    return files.mapInArrow(each, "path string, source string, bibliography string, error string")


def checked_files(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """Rows (path, length, problem): empty files, and .pdf files without the header, have a problem.

    Files are listed with their lengths; only the contents of .pdf files are read.
    Spark's reader passes over empty files, so these come from the listing.
    """
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/{glob}")
    listed = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(root) or []
    empty = spark.createDataFrame([(s.getPath().toString(), 0, "empty") for s in listed if s.isFile() and not s.getLen()], "path string, length long, problem string")
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", "length")
    pdfs = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)
    heads = pdfs.select("path", (F.substring("content", 1, 4) == F.lit(b"%PDF")).alias("_good"))
    return files.where("length > 0").join(heads, "path", "left").select("path", "length", F.when(~F.col("_good"), "no PDF header").alias("problem")).union(empty)


def kind_of(path: Column) -> Column:
    """Which extractor a file goes to, by its suffix."""
    ext = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    return F.when(ext.isin(".pdf"), "pdf").when(ext.isin(".gz", ".tex"), "latex").when(ext.isin(".txt", ".md"), "text").when(ext.isin(".py", ".js", ".ts", ".java", ".go", ".rs", ".c", ".cpp"), "code").otherwise("unknown")
