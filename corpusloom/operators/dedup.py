"""Exact duplicates of texts: first one wins, globally, in windows, or against what was saved before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col
from .ordinals import with_ordinal


def digest(text: Column | str) -> Column:
    return F.sha2(F.coalesce(col(text), F.lit("\0null")), 256)


def first_of_each(df: DataFrame, text: str, order: list[str], within: list[str] | None = None) -> DataFrame:
    """The row with the least order of each text (of each group of within).

    One aggregate with partial results on the map side and no window, so a text that a third of all rows
    repeat is reduced before the shuffle. Null texts are one text. Equal orders keep any one of the equal rows.
    """
    groups = [F.col(c) for c in within or []]
    least = F.min_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(*groups, digest(text).alias("_digest")).agg(least.alias("_row")).select("_row.*")


def first_in_windows(df: DataFrame, text: str, order: list[str], size: int) -> DataFrame:
    """As first_of_each, but only within windows of size rows in the given order."""
    numbered = with_ordinal(df, order, "_n").withColumn("_window", F.floor((F.col("_n") - 1) / size))
    return first_of_each(numbered, text, ["_n"], ["_window"]).drop("_n", "_window")


def not_saved(df: DataFrame, saved: DataFrame, text: str) -> DataFrame:
    """Rows whose text isn't among the saved texts; joined by digest, so texts aren't shuffled twice."""
    known = saved.select(digest(text).alias("_digest")).distinct()
    return df.withColumn("_digest", digest(text)).join(known, "_digest", "left_anti").select(*df.columns)
