"""Where queries register, with the SQL that gives the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query by its function's name; without SQL its rows are tested another way."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


#: In SQL for both engines PLAIN(x) is x with everything but ASCII letters as one space.
_PLAIN = re.compile(r"PLAIN\((\w+)\)")


def duck(sql: str) -> str:
    """The SQL as DuckDB reads it."""
    return _PLAIN.sub(r"regexp_replace(coalesce(\1, ''), '[^A-Za-z]+', ' ', 'g')", sql)


def derived(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Rows that SQL makes of the tables, in Spark as in DuckDB."""
    names = sorted(set(re.findall(r"\b(?:FROM|JOIN) (documents|events|pages|conversations)\b", sql)))
    text = re.sub(r"\b(FROM|JOIN) (documents|events|pages|conversations)\b", r"\1 _own_\2", _PLAIN.sub(r"regexp_replace(coalesce(\1, ''), '[^A-Za-z]+', ' ')", sql))
    for name in names:
        table(spark, sf_dir, name).createOrReplaceTempView(f"_own_{name}")
    try:
        return spark.sql(text)
    finally:
        for name in names:
            spark.catalog.dropTempView(f"_own_{name}")
