"""Session, table and batch helpers of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.tables import shared_dir, written  # noqa: F401

#: Code points that a kernel handles at once; a single longer text is handled alone.
BATCH_CHARS = 1_000_000
#: Rows of 16 bytes that a broadcast hash side may have; larger sides are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def blank(c: Column) -> Column:
    """Null, empty or nothing but (Unicode) white space."""
    return c.isNull() | ~c.rlike(r"(?U)[^\s\x1c-\x1f]")


def row_key(c: str) -> Column:
    return F.lpad(F.col(c).cast("string"), 10, "0")


def chunk_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tbl, key, text): the chunks and the source paragraphs, without null and blank texts."""
    chunks = table(spark, sf_dir, "cpt_chunk").select(F.lit("cpt_chunk").alias("tbl"), row_key("row_id").alias("key"), "text")
    paragraphs = table(spark, sf_dir, "dummy").select(F.lit("dummy").alias("tbl"), F.col("id").alias("key"), F.col("context").alias("text"))
    return chunks.union(paragraphs).where(~blank(F.col("text")))


def semi(df: DataFrame, keys: DataFrame, on: list[str], rows: int | None = None) -> DataFrame:
    """Left semi join; keys is broadcast only if it was counted and is small."""
    rows = keys.count() if rows is None else rows
    return df.join(F.broadcast(keys) if rows <= BROADCAST_ROWS else keys, on, "left_semi")


def slices(batch: pa.RecordBatch, column: str | None, chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about so many code points of text, or one row; without a column, the batch."""
    if column is None:
        yield batch
        return
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + 3 * chars, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def arrow_map(df: DataFrame, column: str | None, schema: str, kernel: Callable[[pa.RecordBatch], dict | None], chars: int = BATCH_CHARS) -> DataFrame:
    """mapInArrow over bounded pieces; kernel returns the columns of the result by name, or None for no rows."""
    target = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    names = target.fieldNames()

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(target)
        for batch in batches:
            for piece in slices(batch, column, chars):
                out = kernel(piece)
                if out is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(out[n], f.type) if not isinstance(out[n], pa.Array | pa.ChunkedArray) else out[n].cast(f.type) for n, f in zip(names, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, target)


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one array of code points, and the offsets (one more than texts)."""
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), np.concatenate([[0], np.cumsum(lens)])


# Odd multipliers of the 64-bit mixing steps.
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= _M1
    h ^= h >> np.uint64(29)
    h *= _M2
    h ^= h >> np.uint64(32)
    return h


def agreeing(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, room: np.ndarray, step: int, block: int = 64) -> np.ndarray:
    """How many code points agree from places x of a and y of b on, forwards (step 1) or backwards (-1), room at most."""
    out, at, done = np.zeros(len(x), np.int64), np.flatnonzero(room > 0), 0
    steps = step * np.arange(block)
    while len(at):
        p, q = (np.clip((z[at] + step * done)[:, None] + steps, 0, len(c) - 1) for z, c in ((x, a), (y, b)))
        differ = a[p] != b[q]
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), block)
        out[at] = np.minimum(done + first, room[at])
        done += block
        at = at[(first == block) & (room[at] > done)]
    return out
