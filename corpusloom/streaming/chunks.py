"""The chunk build as a stream: new source files become chunks, each text once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import strip
from ..operators import dedup, entries
from ..plans import cpt
from ..settings import CptSettings
from ..sources import sinks


def stream_chunks(spark: SparkSession, source: str, checkpoint: str, settings: CptSettings, watermark: str | None = None) -> StreamingQuery:
    """Reads JSON Lines files that appear in a folder and appends their new chunks to output_path/all.jsonl.

    The checkpoint takes the place of a key list: files that were read are not read again. Texts are deduplicated by
    digest: with a watermark within that time of the file's appearance (bounded state), else for good. Rows that have
    no chunk go nowhere; malformed lines go to output_path/rejected.jsonl, each different one once.
    """
    out = settings.output_path.rstrip("/")
    schema = f"`{settings.id_key}` string, `{settings.title_key}` string, `{settings.target_key}` string, source_file string, _bad string"
    lines = spark.readStream.text(source).where(F.length(strip("value")) > 0)
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": "_bad"})
    raw = lines.select(parsed.alias("r"), "_metadata")
    path = F.col("_metadata.file_path")
    rows = raw.select(
        F.col("r")[settings.id_key].alias("id"), F.col("r")[settings.title_key].alias("title"), F.col("r")[settings.target_key].alias("content"), F.coalesce("r.source_file", path).alias("source_file"), "r._bad", F.col("_metadata.file_modification_time").alias("seen"),
    )

    def chunks(frame: DataFrame) -> DataFrame:
        found = entries.candidates(entries.with_entry_id(frame), "content", "title", settings.include_title, settings.min_chars, settings.max_chars, settings.overlap_chars)
        return cpt.outcomes(found, settings, None)

    made = chunks(rows.where("_bad is null")).withColumn("rejected", F.lit(None).cast("string"))
    made = made.unionByName(rows.where("_bad is not null").select("seen", F.col("_bad").alias("rejected")), allowMissingColumns=True)
    made = made.withColumn("_digest", dedup.digest(F.coalesce("generated", "rejected")))
    once = made.withWatermark("seen", watermark).dropDuplicatesWithinWatermark(["_digest"]) if watermark else made.dropDuplicates(["_digest"])

    def save(batch: DataFrame, _: int) -> None:
        # every file of a batch is computed once
        batch.persist()
        sinks.append_json(cpt.saved_chunks(batch.where("rejected is null"), settings).drop("entry_id"), f"{out}/all.jsonl")
        rejected = batch.where("rejected is not null").select("rejected")
        if not rejected.isEmpty():
            rejected.write.mode("append").text(f"{out}/rejected.jsonl")
        batch.unpersist()

    return once.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
