"""Jobs in two phases over a staging table: every document has a row there that says how far it came.

Phase one extracts, phase two writes what was extracted.  Both work in groups of
keys, and each group is one commit of a ``Store``: where a job was killed, the
next run does only what is missing.  Documents that fail keep their row with the
error; they are left out until ``retry`` asks for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import Store, chunk_tables

#: What a row of the staging table may say.
STAGED, STORED, FAILED = "staged", "stored", "failed"


class TwoPhase:
    """extract: frame of documents -> rows (key, content columns ..., error), a null error for what went well.

    process: staged rows -> (papers, chunks), as ``chunk_tables`` takes them; a
    document without a paper there has failed in the second phase.
    """

    def __init__(self, store: Store, extract: Callable[[DataFrame], DataFrame], process: Callable[[DataFrame], tuple[DataFrame, DataFrame]], *, key: str = "_key", table: str = "staging", groups: int = 8):
        self.store, self.extract, self.process, self.key, self.table, self.groups = store, extract, process, key, table, groups

    def _group(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.groups))

    def rows(self, *statuses: str) -> DataFrame | None:
        """Rows of the staging table with one of the statuses (without: all)."""
        found = self.store.table(self.table)
        return found if found is None or not statuses else found.where(F.col("status").isin(*statuses))

    def first(self, documents: DataFrame, *, retry: bool = False) -> None:
        """Extract the documents that have no row yet, and with ``retry`` those that failed; null keys are left out."""
        known = self.rows(STAGED, STORED) if retry else self.rows()
        todo = documents.where(F.col(self.key).isNotNull())
        todo = todo if known is None else todo.join(known.select(self.key), self.key, "left_anti")
        for g in range(self.groups):
            part = todo.where(self._group() == g)
            if part.limit(1).count():
                out = self.extract(part).withColumn("status", F.when(F.col("error").isNull(), STAGED).otherwise(FAILED))
                self.store.commit({self.table: (out, [self.key], ["status"])}, counted=False)

    def second(self) -> None:
        """Write what is staged; the rows of the staging table change in the same commit as the tables that they speak of."""
        for g in range(self.groups):
            staged = self.rows(STAGED)
            part = staged.where(self._group() == g) if staged is not None else None
            if part is None or not part.limit(1).count():
                continue
            papers, chunks = self.process(part)
            changes = chunk_tables(papers, chunks, paper_key=self.key)
            written = changes["papers"][0].select(self.key).distinct().withColumn("_written", F.lit(True))
            status = part.join(written, self.key, "left").withColumn("status", F.when(F.col("_written"), STORED).otherwise(FAILED)).withColumn("error", F.when(~F.coalesce("_written", F.lit(False)), F.lit("nothing was made of it"))).drop("_written")
            parents = written.select(self.key)
            self.store.commit({**changes, self.table: (status, [self.key], ["status"])}, counted=False, replacing={"chunks": parents, "embeddings": parents})

    def run(self, documents: DataFrame, *, retry: bool = False) -> dict[str, int]:
        """Both phases; returns how many documents have each status."""
        self.first(documents, retry=retry)
        self.second()
        found = self.rows()
        return {} if found is None else {r.status: r["count"] for r in found.groupBy("status").count().collect()}


def overridden(base: DataFrame, override: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``base`` with the columns of ``override`` (one row for each key) where these hold something: a text that is not blank, a list that is not empty."""
    other = override.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    kinds = dict(override.dtypes)

    def holds(c: str) -> Column:
        new = F.col(f"_new_{c}")
        if kinds[c].startswith(("array", "map")):
            return F.size(new) > 0
        return F.trim(new) != "" if kinds[c] == "string" else new.isNotNull()

    return base.join(other, key, "left").select(*[(F.when(holds(c), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)) for c in base.columns])
