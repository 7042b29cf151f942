"""Chunk data for continued pre-training: candidates, optional rewriting, deduplication, split, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import cache_key, strip
from ..operators import chat, dedup, entries, ordinals
from ..operators.tables import removed
from ..settings import CptSettings
from ..sources import files, sinks

_OUTCOME = "generated string, bullet_points string, failed_step string, error string, fell_back boolean"


def rewrite_chain(settings: CptSettings):
    """Text to bullet points and back to text; with the original instead of a failure if the settings say so."""
    prompts, falls_back = dict(settings.prompts), settings.falls_back
    to_points, to_text = prompts.get("to_bullet_points_prompt"), prompts.get("bullet_points_to_text_prompt")
    least = settings.min_chars

    def failure(step: str, error: str) -> dict:
        return {"generated": None, "bullet_points": None, "failed_step": step, "error": error, "fell_back": False}

    def attempt(client: chat.ChatClient, text: str) -> dict:
        if not to_points or not to_text:
            return failure("to_bullet_points", "both rewrite prompts must be set")
        points = client.complete(to_points.format(text=text), "to_bullet_points")
        if not points:
            return failure("to_bullet_points", "Bullet point generation returned blank text.")
        new = client.complete(to_text.format(text=points), "bullet_points_to_text")
        if not new:
            return failure("bullet_points_to_text", "Text reconstruction returned blank text.")
        new = new.strip()
        if new == chat.SENTINEL or (len(new) < least and not falls_back):
            return failure("to_bullet_points", "Generated text was empty or too short.")
        return {"generated": new, "bullet_points": points.strip(), "failed_step": None, "error": None, "fell_back": False}

    def chain(client: chat.ChatClient, row: dict) -> dict:
        out = attempt(client, row["chunk"])
        if out["error"] is not None and falls_back:
            return {"generated": row["chunk"], "bullet_points": "", "failed_step": None, "error": None, "fell_back": True}
        return out

    return chain


def outcomes(candidates: DataFrame, settings: CptSettings, client: chat.ChatClient | None, saved_at: str | None = None, counters: chat.RunCounters | None = None) -> DataFrame:
    """Candidates with their outcome. Without mitigation no model is called and the plan has no Python step for it.

    With saved_at the results are appended to a table there in batches, and those it has are not asked for again.
    """
    if not settings.copyright_mitigation:
        none = F.lit(None).cast("string")
        return candidates.withColumns({"generated": F.col("chunk"), "bullet_points": F.lit(""), "failed_step": none, "error": none, "fell_back": F.lit(False)})
    if client is None:
        raise ValueError("copyright_mitigation needs a chat client")
    if saved_at is None:
        return chat.run_chain(candidates, client, rewrite_chain(settings), _OUTCOME, settings.max_in_flight, counters)
    return chat.run_saved(candidates, client, rewrite_chain(settings), _OUTCOME, saved_at, ["entry_id", "chunk_index", "chunk"], settings.max_in_flight, settings.batch_rows, counters)


def saved_chunks(outcome: DataFrame, settings: CptSettings, model: str = "") -> DataFrame:
    """Rows of outcomes to save: blank, marked and too short texts of no failure are left out."""
    mitigated = F.lit(settings.copyright_mitigation) & ~F.col("fell_back")
    rows = outcome.where(F.col("error").isNull() & (F.length("generated") >= settings.min_chars) & (strip("generated") != chat.SENTINEL) & (strip("generated") != ""))
    columns = [
        strip("generated").alias(settings.text_key), F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), F.coalesce(strip("title"), F.lit("")).alias("title"),
        F.coalesce("source_file", F.lit("")).alias("source_file"), F.col("chunk_index"), mitigated.alias("copyright_mitigation"), F.when(mitigated, F.lit(model)).alias("cpt_generator"),
    ]
    if settings.keep_intermediate:
        columns += [F.col("bullet_points"), F.col("chunk").alias("original_text")]
    return rows.select(*columns, "entry_id")


def failures(outcome: DataFrame, model: str = "") -> DataFrame:
    return outcome.where("error is not null").select(
        F.coalesce(F.col("id").cast("string"), F.lit("")).alias("id"), "entry_id", "chunk_index", F.coalesce("source_file", F.lit("")).alias("source_file"), F.lit(True).alias("failed"), "failed_step", "error", F.col("chunk").alias("original_text"), F.lit(model).alias("cpt_generator")
    )


def deduplicated(chunks: DataFrame, settings: CptSettings, saved: DataFrame | None = None) -> DataFrame:
    order = ["entry_id", "chunk_index"]
    if not settings.deduplicate:
        return chunks
    if settings.dedup_window:
        return dedup.first_in_windows(chunks, settings.text_key, order, settings.dedup_window)
    fresh = dedup.first_of_each(chunks, settings.text_key, order)
    return fresh if saved is None else dedup.not_saved(fresh, saved, settings.text_key)


def statistics(entries_: DataFrame, split: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """(entries, chunks, train_chunks, validation_chunks, failed_chunks), one row."""
    n = split.agg(F.count("*").alias("chunks"), F.count_if(F.col("split") == "train").alias("train_chunks"), F.count_if(F.col("split") == "validation").alias("validation_chunks"))
    counts = (entries_.count(), failed.count() if failed is not None else 0)
    return n.select(F.lit(counts[0]).cast("long").alias("entries"), "*", F.lit(counts[1]).cast("long").alias("failed_chunks"))


def batch_status(outcome: DataFrame, done: DataFrame, batch: str = "batch") -> DataFrame:
    """Per batch: input records, output chunks, failed chunks, and the entries completed with it."""
    ids = done.select("entry_id", F.lit(True).alias("_done"))
    rows = outcome.join(ids, "entry_id", "left")
    return rows.groupBy(batch).agg(
        F.count("*").alias("input_records"), F.count_if(F.col("error").isNull()).alias("output_chunks"), F.count_if(F.col("error").isNotNull()).alias("failed_chunks"),
        F.array_sort(F.collect_set(F.when(F.col("_done"), F.col("entry_id")))).alias("cached_ids"),
    )


def build(spark: SparkSession, source: str, settings: CptSettings, client: chat.ChatClient | None = None) -> dict:
    """One run over a source path into settings.output_path; a rerun takes up only what isn't completed.

    Folders: all.jsonl (appended), all.failures.jsonl, batch_status.jsonl (appended, a row per batch of candidates),
    train.jsonl and validation.jsonl (rewritten), processed_ids.txt, stats.json. Model results are kept in .work as they
    come, before they are split into saved rows and failures; the folder is deleted at the end of a run.
    """
    out = settings.output_path.rstrip("/")
    found = entries.with_entry_id(files.entries(spark, source, settings.target_key, settings.id_key, settings.title_key), "id", "title", settings.target_key)
    done = files.read_keys(spark, f"{out}/processed_ids.txt")
    pending = entries.pending_entries(found, done)
    candidates = entries.candidates(pending, settings.target_key, "title", settings.include_title, settings.min_chars, settings.max_chars, settings.overlap_chars)
    candidates = candidates.select("entry_id", "id", "title", "source_file", "chunk_index", "chunk")
    work, counters = f"{out}/.work", chat.RunCounters(spark)
    outcome = outcomes(candidates, settings, client, f"{work}/calls", counters)
    outcome.write.mode("overwrite").parquet(f"{work}/outcome")
    outcome = spark.read.parquet(f"{work}/outcome")
    model = client.model if client else ""
    saved = spark.read.json(f"{out}/all.jsonl", schema=f"`{settings.text_key}` string") if sinks.exists(spark, f"{out}/all.jsonl") else None
    fresh = deduplicated(saved_chunks(outcome, settings, model), settings, saved)
    per_entry = entries.candidates_per_entry(outcome)
    state = outcome.join(per_entry, "entry_id").join(fresh.select("entry_id", "chunk_index", F.lit(True).alias("_saved")), ["entry_id", "chunk_index"], "left")
    completed = entries.completed_entries(state, saved=F.coalesce("_saved", F.lit(False)), failed=F.col("error").isNotNull())
    completed.write.mode("overwrite").parquet(f"{work}/done")
    completed = spark.read.parquet(f"{work}/done")
    sinks.append_json(fresh.drop("entry_id"), f"{out}/all.jsonl")
    sinks.append_json(failures(outcome, model), f"{out}/all.failures.jsonl")
    numbered = ordinals.with_ordinal(outcome.select("entry_id", "chunk_index", "error"), ["entry_id", "chunk_index"])
    sinks.append_json(batch_status(ordinals.batches(numbered, settings.batch_rows), completed), f"{out}/batch_status.jsonl")
    sinks.append_keys(completed.select(cache_key("entry_id").alias("value")), f"{out}/processed_ids.txt")
    columns = f"`{settings.text_key}` string, id string, title string, source_file string, chunk_index int, copyright_mitigation boolean, cpt_generator string, bullet_points string, original_text string"
    everything = spark.read.json(f"{out}/all.jsonl", schema=columns)
    split = ordinals.train_validation(everything, ["id", "chunk_index", settings.text_key], settings.train_ratio, settings.seed, settings.shuffle)
    for part in ("train", "validation"):
        sinks.overwrite_json(split.where(F.col("split") == part).orderBy("ordinal").drop("ordinal", "split"), f"{out}/{part}.jsonl")
    failed = spark.read.json(f"{out}/all.failures.jsonl", schema="error string")
    stats = sinks.write_stats(spark, statistics(found, split, failed), f"{out}/stats.json", {"calls": counters.as_dict()} if settings.copyright_mitigation else {})
    removed(spark, work)
    return stats
