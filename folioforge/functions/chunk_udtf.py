"""Chunkers as table functions for SQL, with tokenizers of one's own.

``register(spark)`` makes ``token_chunks(text => ..., size => ..., overlap => ...,
tokenizer => 'words')`` known to SQL; it is called for each row by LATERAL.  A
tokenizer is a function from a text to its tokens, and what joins them again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

#: How a text is taken apart, and what joins tokens again; ``words`` splits at white space as ``functions.text`` does.
Tokenizer = tuple[Callable[[str], list[str]], str]
TOKENIZERS: dict[str, Tokenizer] = {"words": (str.split, " "), "characters": (list, ""), "lines": (lambda t: [x for x in t.splitlines() if x.strip()], "\n"), "units": (lambda t: re.findall(r"\w+|[^\w\s]", t), " ")}
SCHEMA = StructType([StructField(n, StringType() if n == "text" else IntegerType()) for n in ("chunk_index", "text", "start_char", "end_char", "first_token", "end_token")])


def windows(tokens: list[str], joined_by: str, size: int, overlap: int) -> Iterator[tuple[int, str, int, int, int, int]]:
    """Windows of ``size`` tokens; the first one that reaches the end is the last. Characters are counted in the tokens joined together."""
    at = index = begin = 0
    step = size - overlap
    while begin < len(tokens):
        text = joined_by.join(tokens[begin : begin + size])
        yield index, text, at, at + len(text), begin, min(begin + size, len(tokens))
        if begin + size >= len(tokens):
            return
        at += sum(len(t) + len(joined_by) for t in tokens[begin : begin + step])
        begin, index = begin + step, index + 1


def make(tokenizers: dict[str, Tokenizer]) -> type:
    """The class of a table function that knows these tokenizers (they travel with it to the tasks)."""

    class TokenChunks:
        @staticmethod
        def analyze(text: AnalyzeArgument, size: AnalyzeArgument | None = None, overlap: AnalyzeArgument | None = None, tokenizer: AnalyzeArgument | None = None) -> AnalyzeResult:
            n = 1000 if size is None else size.value
            m = 200 if overlap is None else overlap.value
            if text.dataType.typeName() not in ("string", "void"):
                raise ValueError("text has to be a string")
            if n is None or m is None or not 0 <= m < n:
                raise ValueError("overlap has to be at least 0 and smaller than size, both constants")
            if tokenizer is not None and tokenizer.value not in tokenizers:
                raise ValueError(f"tokenizer is one of {', '.join(sorted(tokenizers))}")
            return AnalyzeResult(schema=SCHEMA)

        def eval(self, text: str | None, size: int = 1000, overlap: int = 200, tokenizer: str = "words"):
            if text is not None:
                split, joined_by = tokenizers[tokenizer]
                yield from windows(split(text), joined_by, size, overlap)

    return TokenChunks


def register(spark: SparkSession, name: str = "token_chunks", tokenizers: dict[str, Tokenizer] | None = None) -> None:
    """Make the table function known to the session's SQL; ``tokenizers`` are added to those that are there."""
    spark.udtf.register(name, udtf(make({**TOKENIZERS, **(tokenizers or {})}), returnType=None))
