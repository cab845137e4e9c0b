"""Positional zip of two frames: the n-th row of one beside the n-th row of the other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .lineage import totals_before


def ordinals(df: DataFrame, order: list[Column], name: str = "ordinal") -> DataFrame:
    """``df`` with the number of each row in ``order``, from 0: rows are counted by ranges of the order, so no task sees more than a range."""
    return totals_before(df, [], order, {name: F.lit(1)})


def zip_positional(left: DataFrame, left_order: list[Column], right: DataFrame, right_order: list[Column]) -> DataFrame:
    """Rows of ``left`` with the rows of ``right`` at the same place, as long as both have one; column names have to differ.

    The orders have to be total: of equal rows any may come first.
    """
    a, b = ordinals(left, left_order, "_place"), ordinals(right, right_order, "_place")
    return a.join(b, "_place").drop("_place")
