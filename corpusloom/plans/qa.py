"""Questions and answers from texts: five model steps per row, failures apart, a row's key kept with it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import cache_key, chat_messages, random_token
from ..operators import chat, entries, ordinals
from ..operators.tables import removed
from ..settings import QaSettings
from ..sources import files, sinks

_OUTPUTS = ("question", "answer", "thinking", "eval")
_RESULT = "question string, answer string, thinking string, eval string, failed_step int, error string"


def tagged(text: str, tag: str) -> str:
    """What stands after the last opening and before the next closing tag; either may be missing."""
    after = text.rpartition(f"<{tag}>")[2]
    return after.partition(f"</{tag}>")[0].strip()


def tagged_only(text: str, tag: str) -> str:
    return tagged(text, tag) if f"<{tag}>" in text or f"</{tag}>" in text else ""


def untagged(text: str, tag: str) -> str:
    """Without the first block of the tag."""
    before, opened, rest = text.partition(f"<{tag}>")
    return (before + rest.partition(f"</{tag}>")[2]).strip() if opened else text.strip()


class _Failed(Exception):
    pass


def _question(call: Callable[..., str], row: dict, out: dict) -> None:
    out["question"] = tagged(call("question_prompt", text=row["text"], random_token=row["random_token"]), "question")
    if not out["question"]:
        raise _Failed("Step 1 returned empty question.")


def _answer(call: Callable[..., str], row: dict, out: dict) -> None:
    out["answer"] = tagged(call("answer_prompt", text=row["text"], question=out["question"]), "answer")
    if not out["answer"]:
        raise _Failed("Step 2 returned empty answer.")


def _thinking(call: Callable[..., str], row: dict, out: dict) -> None:
    raw = call("thinking_prompt", text=row["text"], question=out["question"], answer=out["answer"])
    out["thinking"] = tagged(raw, "think") or raw.strip()
    if not out["thinking"]:
        raise _Failed("Step 3 returned empty thinking.")


def _refined(call: Callable[..., str], row: dict, out: dict) -> None:
    raw = call("refine_answer_prompt", text=row["text"], question=out["question"], think=out["thinking"], answer=out["answer"])
    answer = tagged_only(raw, "answer") or untagged(raw, "think")
    if not answer:
        raise _Failed("Step 4 returned empty refined answer.")
    out["answer"] = answer
    out["thinking"] = tagged_only(raw, "think") or out["thinking"]


def _evaluated(call: Callable[..., str], row: dict, out: dict) -> None:
    raw = call("eval_prompt", think=out["thinking"], answer=out["answer"])
    out["eval"] = tagged(raw, "eval") or raw.strip()


#: Step, its template, what it does; the first two need their template, the others are left out without it.
STEPS = ((1, "question_prompt", _question), (2, "answer_prompt", _answer), (3, "thinking_prompt", _thinking), (4, "refine_answer_prompt", _refined), (5, "eval_prompt", _evaluated))


def qa_chain(settings: QaSettings):
    prompts = dict(settings.prompts)

    def chain(client: chat.ChatClient, row: dict) -> dict:
        out: dict = {"thinking": "", "eval": ""}
        for step, name, work in STEPS:
            template = prompts.get(name)
            if not template and step > 2:
                continue
            try:
                if not template:
                    raise _Failed(f"{name} must be set in prompts.")
                work(lambda _name, template=template, step=step, **values: client.complete(template.format(**values), step), row, out)
            except _Failed as e:
                reached = {k: v for k, v in out.items() if v}
                return {**dict.fromkeys(_OUTPUTS), **reached, "failed_step": step, "error": str(e)}
        return {**dict.fromkeys(_OUTPUTS, ""), **out, "failed_step": None, "error": None}

    return chain


def items(texts: DataFrame, order: list[str], text: str = "text", start_index: int = 1, seed: int = 0) -> DataFrame:
    """Rows with item_id (from 0, in the given order), text and random_token; start_index counts what remains to be done.

    Null and empty texts have no item.
    """
    rows = ordinals.with_ordinal(texts.where(F.length(text) > 0), order, "_n").where(F.col("_n") >= start_index)
    rows = rows.withColumn("item_id", (F.col("_n") - start_index).cast("int")).drop("_n")
    return rows.withColumn("random_token", random_token(text, "item_id", seed))


def outcomes(rows: DataFrame, settings: QaSettings, client: chat.ChatClient, max_in_flight: int = 4) -> DataFrame:
    """Rows (item_id, text, random_token, ...) with question, answer, thinking, eval, failed_step and error."""
    return chat.run_chain(rows, client, qa_chain(settings), _RESULT, max_in_flight)


def results(outcome: DataFrame, model: str) -> DataFrame:
    """Rows to save, in the order of their items."""
    made = outcome.where("error is null").select(
        "item_id", "question", "thinking", "answer", "eval", F.lit(model).alias("qa_generator"), chat_messages("question", "thinking", "answer").alias("messages"), *_carried(outcome)
    )
    return made.where(save_guard()).orderBy("item_id")


def failures(outcome: DataFrame, model: str) -> DataFrame:
    """Failed rows with the outputs they had reached."""
    reached = F.map_filter(F.create_map(*[x for k in _OUTPUTS for x in (F.lit(k), F.col(k))]), lambda _, v: v.isNotNull() & (v != ""))
    return outcome.where("error is not null").select("item_id", F.lit(True).alias("failed"), "failed_step", "error", reached.alias("previous_outputs"), F.lit(model).alias("qa_generator"), *_carried(outcome))


def _carried(df: DataFrame) -> list[str]:
    return [c for c in ("source_files", "id", "chunk_index") if c in df.columns]


def save_guard(strict: bool = False) -> Column:
    """Whether a row is complete: question, answer, generator and messages; with strict all fields."""
    needed = ["question", "answer", "qa_generator", *(["thinking", "eval"] if strict else [])]
    ok = F.size("messages") > 0
    for c in needed:
        ok = ok & (F.length(c) > 0)
    return F.coalesce(ok, F.lit(False))


def generate(spark: SparkSession, source: str, target: str, settings: QaSettings, client: chat.ChatClient, start_index: int = 1, max_in_flight: int = 4) -> dict[str, int]:
    """Saved rows, failures beside them, and keys of what was saved; a rerun takes up the rest. Returns the run's counters.

    Everything is kept apart by group: the folder of a text, the stem of a JSON file. A record without id gets one from its
    source and a digest of its text, the same in every run. Results of calls are kept in .work as they come, so a
    killed run repeats no more than a batch of them.
    """
    out = settings.output_path.rstrip("/")
    texts, records = files.discover_by_kind(source, spark)
    if not texts and not records:
        raise FileNotFoundError(f"no source files in {source}")
    rows = files.entries(spark, source, target).withColumn("chunk_index", F.lit(None).cast("int"))
    if records:
        rows = rows.withColumn("chunk_index", F.try_variant_get(F.try_parse_json("record"), "$.chunk_index", "int"))
    stem = F.regexp_replace(F.element_at(F.split("source_file", "/"), -1), r"\.[^.]*$", "")
    rows = rows.withColumn("source_stem", stem).withColumn("group", F.coalesce("book", "source_stem"))
    rows = rows.withColumn("id", F.coalesce("id", F.concat_ws(":", "source_stem", F.substring(F.sha2(F.coalesce("record", target), 256), 1, 16))))
    rows = entries.pending_chunks(rows, files.read_keys(spark, f"{out}/processed_keys.txt"))
    rows = rows.select("id", "chunk_index", "group", "source_stem", F.array("source_file").alias("source_files"), F.col(target).alias("text"), "ordinal")
    work, counters = f"{out}/.work", chat.RunCounters(spark)
    numbered = items(rows, ["source_stem", "ordinal", "id"], "text", start_index, settings.seed)
    outcome = chat.run_saved(numbered, client, qa_chain(settings), _RESULT, f"{work}/calls", ["source_stem", "id", "chunk_index", "text"], max_in_flight, settings.batch_rows, counters)
    outcome.write.mode("overwrite").parquet(f"{work}/outcome")
    outcome = spark.read.parquet(f"{work}/outcome")
    groups = outcome.select("item_id", "group")
    saved = results(outcome, client.model).join(groups, "item_id")
    sinks.append_json(saved, f"{out}/rows.jsonl", by="group")
    sinks.append_json(failures(outcome, client.model).join(groups, "item_id"), f"{out}/failures.jsonl", by="group")
    keyed = outcome.where("error is null") if settings.cache_unsaved else saved
    sinks.append_keys(keyed.select(cache_key("id", "chunk_index").alias("value"), "group"), f"{out}/processed_keys.txt", by="group")
    removed(spark, work)
    return counters.as_dict()
