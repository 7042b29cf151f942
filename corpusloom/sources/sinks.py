"""Sinks: append and overwrite JSON Lines folders, key lists, statistics, upload staging.

A sink is a folder of part files. Data is written before its keys, and a rerun skips what the keys name, so a
job that was lost in between repeats at most the rows of its last batch, which deduplication removes.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import exists, file_system  # noqa: F401


def append_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """Appends rows; null fields are left out. by splits the folder by a column (book, source_stem)."""
    writer = df.write.mode("append")
    (writer.partitionBy(by) if by else writer).json(path)


def overwrite_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_keys(keys: DataFrame, path: str, by: str | None = None) -> None:
    """Appends the distinct non-null keys of the first column; call it after the data is committed. by splits the folder by the other column."""
    name = keys.columns[0]
    writer = keys.where(F.col(name).isNotNull()).distinct().write.mode("append")
    (writer.partitionBy(by) if by else writer).text(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One file with this text, on whatever file system the path names."""
    system, target = file_system(spark, path)
    stream = system.create(target, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()


def write_stats(spark: SparkSession, stats: DataFrame, path: str, more: dict | None = None) -> dict:
    """Writes the one row of an aggregate, and more, as a JSON file and returns it."""
    row = stats.first().asDict() | (more or {})
    write_text(spark, path, json.dumps(row, ensure_ascii=False, indent=2))
    return row


def json_files(spark: SparkSession, folder: str) -> list[str]:
    """Names of the .json files right below a folder."""
    system, target = file_system(spark, folder)
    if not system.exists(target):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(target) if s.isFile() and s.getPath().getName().endswith(".json"))


def stage_upload(spark: SparkSession, source: str, staging: str, splits: bool = False, publish: Callable[[str], None] | None = None, dry_run: bool = True) -> DataFrame:
    """Filters and projects the data sets of a folder into a staging folder and counts their records.

    all is required; train and validation are taken with splits where they exist; .json files beside them are checked to be
    JSON and go along as they are. Unless it is a dry run publish gets the staging folder; without one the run fails
    before anything is staged.
    """
    from ..operators.upload import upload_rows
    from .files import read_json_lines_strict

    if not dry_run and publish is None:
        raise FileNotFoundError("nothing is there that could publish the staged files")
    names = ["all.jsonl", *(["train.jsonl", "validation.jsonl"] if splits else [])]
    counts = []
    for name in names:
        if not exists(spark, f"{source}/{name}"):
            if name == "all.jsonl":
                raise FileNotFoundError(f"{source}/{name}")
            continue
        rows = upload_rows(read_json_lines_strict(spark, f"{source}/{name}"))
        rows.write.mode("overwrite").text(f"{staging}/{name}")
        counts.append((name, spark.read.text(f"{staging}/{name}").count()))
    for name in json_files(spark, source):
        text = spark.read.text(f"{source}/{name}", wholetext=True).first()["value"]
        json.loads(text)
        write_text(spark, f"{staging}/{name}", text)
        counts.append((name, 1))
    if not dry_run:
        publish(staging)
    return spark.createDataFrame(counts, "file string, n_records long")


def hub_publisher(repo_id: str, token: str, private: bool = False, message: str = "") -> Callable[[str], None] | None:
    """Pushes a local staging folder to a data set hub, where the optional client library is installed; else null."""
    try:
        from huggingface_hub import HfApi
    except ImportError:
        return None

    def publish(staging: str) -> None:
        api = HfApi(token=token)
        api.create_repo(repo_id, repo_type="dataset", private=private, exist_ok=True)
        api.upload_folder(repo_id=repo_id, repo_type="dataset", folder_path=staging.removeprefix("file://"), commit_message=message)

    return publish
