"""Entries to chunk candidates, resume filters and completion."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.chunker import body_chunks
from ..functions.text import fallback_id, strip

#: Rows of a key side that may be broadcast; beyond it the anti-join is shuffled.
BROADCAST_KEYS = 2_000_000


def small(keys: DataFrame) -> DataFrame:
    """Broadcast hint for a key list that was counted and is small."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def with_entry_id(entries: DataFrame, id_key: str = "id", title: str = "title", target: str = "content") -> DataFrame:
    """entry_id: the id, or for null and blank ids a digest of source, title and text, the same in every run."""
    own = F.col(id_key).cast("string")
    return entries.withColumn("entry_id", F.when(F.length(strip(own)) > 0, own).otherwise(fallback_id("source_file", title, target)))


def candidates(entries: DataFrame, target: str = "content", title: str = "title", include_title: bool = True, min_chars: int = 128, max_chars: int = 4096, overlap_chars: int = 256) -> DataFrame:
    """One row per chunk with chunk_index and chunk; the other columns stay.

    Null targets and bodies shorter than min_chars (after normalising, before the title) have none.
    """
    kept = [c for c in entries.columns if c != target]
    name = F.col(title) if include_title else F.lit(None).cast("string")
    return entries.select(*kept, F.posexplode(body_chunks(target, name, min_chars, max_chars, overlap_chars)).alias("chunk_index", "chunk"))


def pending_entries(entries: DataFrame, processed: DataFrame, key: str = "entry_id") -> DataFrame:
    """Entries whose id is not among the processed keys; null ids stay."""
    return entries.join(small(processed.select(F.col("cache_key").alias(key))), key, "left_anti").select(*entries.columns)


def pending_chunks(chunks: DataFrame, processed: DataFrame, entry_id: str = "id", chunk_index: str = "chunk_index") -> DataFrame:
    """Chunks of which neither (id, index) nor, as older key lists have it, the id alone is processed: two equality anti-joins."""
    keys = small(processed.select("cache_key").distinct())
    ident = F.col(entry_id).cast("string")
    both = F.when(ident.isNotNull() & F.col(chunk_index).isNotNull(), F.concat_ws("\t", ident, F.col(chunk_index).cast("string")))
    rows = chunks.withColumns({"_id": ident, "_both": both})
    for key in ("_id", "_both"):
        rows = rows.join(keys.withColumnRenamed("cache_key", key), key, "left_anti")
    return rows.select(*chunks.columns)


def candidates_per_entry(chunks: DataFrame, key: str = "entry_id") -> DataFrame:
    return chunks.groupBy(key).agg(F.count("*").alias("n_candidates"))


def completed_entries(outcomes: DataFrame, key: str = "entry_id", candidates: str = "n_candidates", saved: Column | None = None, failed: Column | None = None, failures_block: bool = True) -> DataFrame:
    """Entries all of whose candidates are processed, of which one was saved and (with failures_block) none failed.

    outcomes has a row per processed candidate with the entry's number of candidates.
    """
    saved = F.col("saved") if saved is None else saved
    failed = F.col("failed") if failed is None else failed
    done = outcomes.groupBy(key).agg(F.count("*").alias("n_processed"), F.max(candidates).alias("n_candidates"), F.bool_or(saved).alias("any_saved"), F.bool_or(failed).alias("any_failed"))
    ok = (F.col("n_processed") >= F.col("n_candidates")) & F.col("any_saved")
    return done.where(ok & ~F.col("any_failed") if failures_block else ok).select(key)
