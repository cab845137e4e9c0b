"""A store of keyed tables on plain Parquet, with an atomic commit of several tables at once.

A commit writes what it changes, and nothing else, as new parts of its tables and
then one small manifest with the number that follows the one it has read.  Readers
resolve tables through the newest manifest, so they see all of a commit or nothing
of it; of the parts of a table the newest row of each key counts.  Where another
commit has taken the number, the manifest is read again and the parts are added to
that: no commit undoes another.  After ``COMPACT`` parts a table is rewritten.
"""

from __future__ import annotations

import functools
import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.corpus import latest_per_key

#: Statements that a read-only session refuses.
WRITES = ("INSERT", "UPDATE", "DELETE", "MERGE", "DROP", "CREATE", "ALTER", "TRUNCATE", "REPLACE", "UPSERT", "REMOVE")
#: Parts of a table from which on a commit rewrites it.
COMPACT = 16
#: How often a commit tries to publish its manifest.
ATTEMPTS = 20


class Conflict(RuntimeError):
    """Another commit came first."""


class Store:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._path = self._hadoop.Path
        self._fs = self._path(self.folder).getFileSystem(self._conf)
        self._fs.mkdirs(self._path(f"{self.folder}/manifests"))
        self._fresh: list[str] = []  # parts of the commit that is under way

    def _read(self) -> tuple[int, dict]:
        """The number of the newest manifest (-1 if there is none) and its tables."""
        names = sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.folder}/manifests")) if s.getPath().getName().endswith(".json"))
        if not names:
            return -1, {}
        text = "\n".join(r.value for r in self.spark.read.text(f"{self.folder}/manifests/{names[-1]}").collect())
        return int(names[-1].split(".")[0]), json.loads(text)

    def manifest(self) -> dict:
        """Table names, with the keys and parts of each."""
        return self._read()[1]

    def _publish(self, number: int, manifest: dict) -> bool:
        """Write the manifest that follows ``number``; False if another commit has done so."""
        temporary = self._path(f"{self.folder}/manifests/.{uuid.uuid4().hex}")
        out = self._fs.create(temporary)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        target = self._fs.makeQualified(self._path(f"{self.folder}/manifests/{number + 1:012d}.json"))
        plain = self.spark.sparkContext._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 0)
        try:  # a rename that does not overwrite
            self._hadoop.FileContext.getFileContext(target.toUri(), self._conf).rename(self._fs.makeQualified(temporary), target, plain)
            return True
        except Exception:
            self._fs.delete(temporary, False)
            if self._fs.exists(target):
                return False
            raise

    def _change(self, change, expected: int | None = None) -> dict:
        """Apply ``change`` to the newest manifest and publish it; with ``expected`` only if that is still the newest."""
        for _ in range(ATTEMPTS):
            number, now = self._read()
            if expected is not None and number != expected:
                break
            changed = change(now)
            if self._publish(number, changed):
                return changed
        raise Conflict("another commit came first")

    def _table(self, entry: dict | None) -> DataFrame | None:
        if entry is None:
            return None
        held: list[tuple[DataFrame, str]] = []
        for path, kind, *columns in entry["parts"]:
            part = self.spark.read.parquet(path)
            if kind == "without":  # takes the rows before it that belong to one of its parents
                held = [(self._newest(held, entry["keys"]).join(part, columns[0], "left_anti"), "rows")] if held else []
            else:
                held.append((part, kind))
        return self._newest(held, entry["keys"]) if held else None

    @staticmethod
    def _newest(parts: list[tuple[DataFrame, str]], keys: list[str]) -> DataFrame:
        """Of each key the row of the newest part, unless it is gone there."""
        if len(parts) == 1 and parts[0][1] == "rows":
            return parts[0][0]
        marked = [df.withColumns({"_part": F.lit(i), "_gone": F.lit(kind == "gone")}) for i, (df, kind) in enumerate(parts)]
        every = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
        return latest_per_key(every, keys, [F.desc("_part")]).where("not _gone").drop("_part", "_gone")

    def table(self, name: str) -> DataFrame | None:
        return self._table(self.manifest().get(name))

    def _written(self, name: str, rows: DataFrame) -> str:
        path = f"{self.folder}/tables/{name}/{uuid.uuid4().hex}"
        self._fresh.append(path)
        rows.write.parquet(path)
        return path

    def commit(self, changes: dict[str, tuple], *, counted: bool = True, expected: int | None = None, replacing: dict[str, DataFrame] | None = None) -> dict[str, int]:
        """Upsert several tables at once: name -> (rows, key columns[, order columns]); returns the rows of each table if ``counted``.

        A row takes the place of the stored one with its key (null equals null).  Of
        several new rows with one key the last in the order columns stays (without
        them: in the order of all columns).

        replacing: name -> frame of parent columns; the stored rows of that table with
        one of these parents go in the same commit, before the new ones are there.
        A commit that fails leaves nothing: what it has written is deleted.
        """
        try:
            return self._commit(changes, counted, expected, replacing or {})
        except BaseException:
            for path in self._fresh:
                self._fs.delete(self._path(path), True)
            raise
        finally:
            self._fresh = []

    def _commit(self, changes: dict[str, tuple], counted: bool, expected: int | None, replacing: dict[str, DataFrame]) -> dict[str, int]:
        self._fresh = []
        without = {name: (self._written(name, parents.distinct()), list(parents.columns)) for name, parents in replacing.items()}
        new = {}
        for name, (rows, keys, *order) in changes.items():
            by = order[0] if order else [c for c in rows.columns if c not in keys]
            rows = latest_per_key(rows, keys, [F.desc_nulls_last(c) for c in by] or [F.lit(1)])
            new[name] = (self._written(name, rows), list(keys))

        def change(now: dict) -> dict:
            out = dict(now)
            for name, (path, keys) in new.items():
                entry = out.get(name, {"keys": keys, "parts": []})
                if entry["keys"] != keys:
                    raise ValueError(f"the keys of {name} are {entry['keys']}")
                gone = [[without[name][0], "without", without[name][1]]] if name in without and entry["parts"] else []
                out[name] = {"keys": keys, "parts": [*entry["parts"], *gone, [path, "rows"]]}
            for name in set(without) - set(new):
                if name in out:
                    out[name] = {**out[name], "parts": [*out[name]["parts"], [without[name][0], "without", without[name][1]]]}
            return out

        now = self._change(change, expected)
        self._fresh = []  # named by a manifest: theirs to keep
        for name in new:
            if len(now[name]["parts"]) >= COMPACT:
                self.compact(name)
        return {name: self._table(now[name]).count() for name in new} if counted else {}

    def append(self, name: str, rows: DataFrame, keys: list[str]) -> int:
        """Add rows; a key that is stored already, or given twice, is an error and nothing is written."""
        number, now = self._read()
        old = self._table(now.get(name))
        twice = rows.groupBy(*keys).count().where("count > 1").limit(1).count()
        stored = 0 if old is None else rows.join(old.select(*keys), keys, "left_semi").limit(1).count()
        if twice or stored:
            raise ValueError(f"duplicate key in {name}")
        return self.commit({name: (rows, keys)}, expected=number)[name]

    def delete(self, name: str, keys: DataFrame) -> None:
        """Take out the rows with the given keys (a frame of the key columns); keys that are not stored change nothing."""
        entry = self.manifest()[name]
        path = self._written(name, keys.select(*entry["keys"]).distinct())
        self._change(lambda now: {**now, name: {**now[name], "parts": [*now[name]["parts"], [path, "gone"]]}})

    def retrieve(self, table: str, /, **key) -> DataFrame:
        """The row with the key, or no row."""
        return self._named(table).where(functools.reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in key.items()]))

    def exists(self, table: str, /, **key) -> bool:
        return table in self.manifest() and self.retrieve(table, **key).limit(1).count() > 0

    def keys(self, name: str, prefix: str = "") -> DataFrame:
        """The keys of a table whose first key column begins with ``prefix``."""
        entry = self.manifest()[name]
        return self._table(entry).select(*entry["keys"]).where(self._begins(entry, prefix))

    def clear(self, name: str, prefix: str = "") -> int:
        """Take out the rows whose first key column begins with ``prefix``; returns how many there were."""
        keys = self.keys(name, prefix)
        n = keys.count()
        if n:
            self.delete(name, keys)
        return n

    @staticmethod
    def _begins(entry: dict, prefix: str) -> Column:
        return F.col(entry["keys"][0]).cast("string").startswith(prefix) if prefix else F.lit(True)

    def _named(self, name: str) -> DataFrame:
        found = self.table(name)
        if found is None:
            raise KeyError(name)
        return found

    def compact(self, name: str) -> None:
        """Rewrite a table as one part; parts that other commits add meanwhile stay behind it."""
        entry = self.manifest()[name]
        path = self._written(name, self._table(entry))

        def change(now: dict) -> dict:
            parts = now[name]["parts"]
            if parts[: len(entry["parts"])] != entry["parts"]:  # compacted or dropped by another: nothing to do
                return now
            return {**now, name: {**entry, "parts": [[path, "rows"], *parts[len(entry["parts"]) :]]}}

        self._change(change)

    def drop(self, name: str) -> bool:
        found = name in self.manifest()
        if found:
            self._change(lambda now: {k: v for k, v in now.items() if k != name})
        return found

    def vacuum(self, keep: int = 2, seconds: float = 3600.0) -> int:
        """Delete parts that none of the last ``keep`` manifests names and that are older than ``seconds``, and manifests before those; returns how many parts went.

        Commits that are under way have parts that no manifest names yet: ``seconds`` is
        longer than any of them takes, and than a reader of an older manifest reads.
        """
        folder = self._path(f"{self.folder}/manifests")
        files = sorted((s.getPath() for s in self._fs.listStatus(folder) if s.getPath().getName().endswith(".json")), key=lambda p: p.getName())
        named = set()
        for path in files[-keep:]:
            text = "\n".join(r.value for r in self.spark.read.text(path.toString()).collect())
            named |= {part[0].rsplit("/", 1)[-1] for entry in json.loads(text).values() for part in entry["parts"]}
        before, gone = time.time() * 1000 - seconds * 1000, 0
        tables = self._path(f"{self.folder}/tables")
        for table in self._fs.listStatus(tables) if self._fs.exists(tables) else []:
            for part in self._fs.listStatus(table.getPath()):
                if part.getPath().getName() not in named and part.getModificationTime() < before:
                    self._fs.delete(part.getPath(), True)
                    gone += 1
        for path in files[:-keep]:
            self._fs.delete(path, False)
        return gone

    def counts(self, names: list[str]) -> dict[str, int]:
        now = self.manifest()
        return {n: (0 if (t := self._table(now.get(n))) is None else t.count()) for n in names}


def chunk_tables(papers: DataFrame, chunks: DataFrame, *, paper_key: str = "_key") -> dict[str, tuple]:
    """What a write of papers with their chunks commits: papers, chunks and embeddings by key.

    chunks: rows (paper_key, chunk_index, text, embedding); a paper without an id,
    and chunks of no paper, are left out; chunks and embeddings share their key.
    """
    known = papers.where(F.col(paper_key).isNotNull())
    own = chunks.join(known.select(paper_key).distinct(), paper_key, "left_semi").withColumn("chunk_key", F.concat_ws("_chunk_", F.col(paper_key), F.col("chunk_index").cast("string")))
    vectors = own.where("embedding is not null").select("chunk_key", F.col(paper_key), "embedding", F.size("embedding").alias("dim"))
    return {"papers": (known, [paper_key]), "chunks": (own.drop("embedding"), ["chunk_key"]), "embeddings": (vectors, ["chunk_key"])}


def write_papers(store: Store, papers: DataFrame, chunks: DataFrame, structures: DataFrame | None = None, *, paper_key: str = "_key") -> dict[str, int]:
    """Papers with their chunks, embeddings and structures in one commit: what was stored of these papers before goes, so a paper that shrank keeps no old chunk.

    structures: rows (paper_key, kind, position, content), such as equations, tables and images.
    """
    changes = chunk_tables(papers, chunks, paper_key=paper_key)
    parents = changes["papers"][0].select(paper_key).distinct()
    if structures is not None:
        own = structures.join(parents, paper_key, "left_semi")
        changes["structures"] = (own, [paper_key, "kind", "position"])
    return store.commit(changes, replacing={name: parents for name in ("chunks", "embeddings", "structures") if name in changes or name in store.manifest()})


def read_only(spark: SparkSession, statement: str) -> DataFrame:
    """Run a statement that does not write; others are refused."""
    words = set("".join(ch if ch.isalpha() else " " for ch in statement.upper()).split())
    if words & set(WRITES):
        raise PermissionError("only statements that read are allowed")
    return spark.sql(statement)
