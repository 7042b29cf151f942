"""Problem 4: items over a size limit, cut into pieces at natural boundaries with a given overlap.

A hierarchy of separators is applied recursively: a text is split before section headings, what is still
too long after blank lines, then after line breaks, sentences, clauses or words, and last between
characters (grapheme clusters). The parts are packed greedily to the limit. Every piece after the
first begins with exactly the given number of code points of the piece before, so the text is the first
piece followed by the rest of each further one.

Only items over the limit leave the JVM; the limits are a small table that is counted before it is sent.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, arrow_map, row_key, table

# The separators, from the widest to the narrowest; a match ends where a part may end.
SEPARATORS = (
    r"\n(?=#{1,6}\s|=+[^=\n]+=+[^\S\n]*(?:\n|$))|\f",  # before a heading
    r"\n[^\S\n]*\n\s*",  # after blank lines
    r"[\n\r\x0b\x85\u2028\u2029]+",  # after a line
    r"[。．！？!?｡]+[」』）)】〉》”’\"']*[^\S\n]*|\.[)\"'”’]*(?=\s)[^\S\n]*",  # after a sentence
    r"[、，,;；:：]\s*|\s+",  # after a clause or a word
    r"\X",  # after a character
)


@functools.cache
def _separator(level: int) -> regex.Pattern:
    return regex.compile(SEPARATORS[level])


def _part_ends(text: str, start: int, end: int, room: int, level: int, out: list[int]) -> None:
    """Ends of parts of text[start:end], each of at most room code points."""
    if end - start <= room:
        out.append(end)
        return
    if level == len(SEPARATORS):  # one character longer than the room
        out.extend(range(start + room, end, room))
        out.append(end)
        return
    last = start
    for m in _separator(level).finditer(text, start, end):
        if m.end() > last:
            _part_ends(text, last, m.end(), room, level + 1, out)
            last = m.end()
    if last < end:
        _part_ends(text, last, end, room, level + 1, out)


def piece_spans(text: str, limit: int, overlap: int) -> list[tuple[int, int]]:
    """Start and end of the pieces of a text. An overlap must be smaller than the limit."""
    if not 0 <= overlap < limit:
        raise ValueError(f"overlap {overlap} must be at least 0 and less than the limit {limit}")
    if len(text) <= limit:
        return [(0, len(text))]
    ends: list[int] = []
    _part_ends(text, 0, len(text), limit - overlap, 0, ends)
    out, start, last = [], 0, 0
    for end in ends:
        if end - start > limit:
            out.append((start, last))
            start = last - overlap
        last = end
    out.append((start, last))
    return out


def split_oversized(df: DataFrame, key: str, text: str, limits: DataFrame, by: str) -> DataFrame:
    """(by, key, piece_no, n_pieces, start, piece) of the rows of df whose text is longer than their limit.

    limits has (by, max_chars, overlap_chars), one row for each value of by; a null or missing limit is
    none, a null overlap is 0, an overlap not below the limit is an error. Null texts have no piece; a text
    of blanks is cut like any other. Rows that are not over their limit are not in the result. Repeated keys
    give their pieces once for each row.
    """
    small = limits.select(F.col(by).alias("_by"), F.col("max_chars").alias("_max"), F.coalesce("overlap_chars", F.lit(0)).alias("_overlap"))
    small = F.broadcast(small) if limits.count() <= BROADCAST_ROWS else small
    rows = df.select(F.col(by).alias("_by"), F.col(key).alias("_key"), F.col(text).alias("_text")).join(small, "_by")
    long = rows.where(F.length("_text") > F.col("_max"))

    def kernel(batch: pa.RecordBatch) -> dict:
        row, no, starts, counts, out = [], [], [], [], []
        for i, (t, limit, overlap) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("_text", "_max", "_overlap")), strict=True)):
            spans = piece_spans(t, limit, overlap)
            row += [i] * len(spans)
            no += range(1, len(spans) + 1)
            counts += [len(spans)] * len(spans)
            starts += [a for a, _ in spans]
            out += [t[a:b] for a, b in spans]
        at = pa.array(np.array(row, np.int64))
        return {by: batch.column("_by").take(at), key: batch.column("_key").take(at), "piece_no": no, "n_pieces": counts, "start": starts, "piece": out}

    types = dict(df.dtypes)
    return arrow_map(long, "_text", f"`{by}` {types[by]}, `{key}` {types[key]}, piece_no int, n_pieces int, start int, piece string", kernel)


def p4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = table(spark, sf_dir, "cpt_chunk").select(F.lit("cpt_chunk").alias("tbl"), row_key("row_id").alias("row_key"), "text")
    paragraphs = table(spark, sf_dir, "dummy").select(F.lit("dummy").alias("tbl"), F.col("id").alias("row_key"), F.col("context").alias("text"))
    return split_oversized(chunks.union(paragraphs), "row_key", "text", table(spark, sf_dir, "field_limit"), "tbl")


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_pieces(spark, sf_dir).where("piece_no = 1").select("tbl", "row_key").distinct()


_ROWS = """
    select 'cpt_chunk' as tbl, lpad(cast(row_id as varchar), 10, '0') as row_key, text from cpt_chunk
    union all select 'dummy', id, context from dummy
"""
P4_FOUND_SQL = f"""
    select distinct r.tbl, r.row_key from ({_ROWS}) r join field_limit l on r.tbl = l.tbl where length(r.text) > l.max_chars
"""
