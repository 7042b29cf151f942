"""One or more text columns rewritten by a model, in place."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import chat
from ..sources import sinks


def rewritten(df: DataFrame, targets: str | list[str], template: str, client: chat.ChatClient, max_in_flight: int = 4, sentinel_to_null: bool = False) -> DataFrame:
    """df with the target columns (a list, or names between commas) rewritten and the model's name as generator.

    Null texts stay null. A reply that stands for 'not to be rewritten' is kept unless it is to become null.
    """
    names = [x.strip() for x in targets.split(",")] if isinstance(targets, str) else list(targets)
    if not template or not names:
        raise ValueError("a template and at least one target column are needed")
    if missing := [n for n in names if n not in df.columns]:
        raise KeyError(f"no such columns: {missing}")

    def chain(c: chat.ChatClient, row: dict) -> dict:
        return {f"_new_{n}": None if row[n] is None else c.complete(template.format(text=row[n]), n) for n in names}

    made = chat.run_chain(df, client, chain, T.StructType([T.StructField(f"_new_{n}", T.StringType()) for n in names]), max_in_flight)
    for n in names:
        new = F.col(f"_new_{n}")
        made = made.withColumn(n, F.when(F.trim(new) == chat.SENTINEL, None).otherwise(new) if sentinel_to_null else new)
    return made.drop(*[f"_new_{n}" for n in names]).withColumn("generator", F.lit(client.model))


def append_result(df: DataFrame, source: str, output_path: str) -> str:
    """Appends rewritten rows to dialect_<stem of the source>.jsonl below output_path and returns that path."""
    stem = source.rstrip("/").rpartition("/")[2].partition(".")[0]
    path = f"{output_path.rstrip('/')}/dialect_{stem}.jsonl"
    sinks.append_json(df, path)
    return path


def keys_consistent(df: DataFrame, targets: list[str], source: str) -> DataFrame:
    """Rows in which a target is null though its source is not; empty if every rewrite came back."""
    lost = F.lit(False)
    for n in targets:
        lost = lost | (F.col(source).isNotNull() & F.col(n).isNull())
    return df.where(lost)
