"""Texts into overlapping chunks of a largest size, ending after a separator where the second half has one."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col, normal_form, text_udf
from .wikitext import clean

# Separators by priority; the first that occurs in the second half decides, at its last place.
SEPARATORS = ("\n\n", "\n", "。", "、")


def chunk_end(text: str, start: int, size: int) -> int:
    stop = start + size
    if stop >= len(text):
        return len(text)
    places = ((text.rfind(s, start + size // 2, stop), s) for s in SEPARATORS)
    return next((at + len(s) for at, s in places if at >= 0), stop)


def chunks(text: str, size: int, overlap: int) -> list[str]:
    """A text within the size is one chunk as it is; others are cut and stripped, blank chunks left out."""
    if not 0 <= overlap < size:
        raise ValueError("overlap must be at least 0 and less than the size")
    if len(text) <= size:
        return [text]
    out, start = [], 0
    while True:
        end = chunk_end(text, start, size)
        if piece := text[start:end].strip():
            out.append(piece)
        if end == len(text):
            return out
        start = max(end - overlap, start + 1)


def chunk_texts(c: Column | str, size: int, overlap: int) -> Column:
    """array<string> of the chunks; null for null."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(lambda t: chunks(t, size, overlap), na_action="ignore")

    return run(col(c))


def body_chunks(c: Column | str, title: Column | str, least: int, size: int, overlap: int) -> Column:
    """array<string> of the chunks of normalised texts, each with its title before it; empty for null, blank and shorter texts.

    The body is normalised where it is cut: once, in the same pass over the batch.
    """

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(bodies: pd.Series, titles: pd.Series) -> pd.Series:
        out = []
        for body, name in zip(bodies, titles, strict=True):
            text = normal_form(body) if body is not None else ""
            name = name.strip() if name is not None else ""
            out.append(chunks(f"{name}\n\n{text}" if name else text, size, overlap) if text and len(text) >= least else [])
        return pd.Series(out)

    return run(col(c), col(title))


def register(spark) -> None:
    """Functions for SQL: chunk_text(text, size, overlap) as a table function with rows (chunk_index, chunk), and the scalars normal_text, clean_wiki and tag_content."""
    spark.udf.register("normal_text", text_udf(normal_form))
    spark.udf.register("clean_wiki", text_udf(clean))
    spark.sql("create or replace temporary function tag_content(t string, tag string) returns string return coalesce(trim(both from substring_index(substring_index(t, concat('<', tag, '>'), -1), concat('</', tag, '>'), 1)), '')")

    @F.udtf(returnType="chunk_index: int, chunk: string")
    class ChunkText:
        def eval(self, text: str, size: int, overlap: int):
            if text is not None:
                yield from enumerate(chunks(text, size, overlap))

    spark.udtf.register("chunk_text", ChunkText)
