"""Problem 8: sources combined to target shares, by weighted fair queueing.

The documents of a source stand in a seeded random order, the whole source as often as it may repeat.
A copy's virtual finish time is the source's tokens up to its end divided by the source's target share;
the combined set is all copies in the order of finish time up to the total budget. At any moment
sources that have not run out have been served in proportion to their shares.

The running sums are taken in two steps (totals of hash ranges of a source, then within each range), so
a source with a third of all rows is no single task. The time at which the budget is reached follows
from the totals per source, so only copies that are taken are made. A source is short if its last copy's finish time
comes before the time at which its share of the budget would be served.
"""

from __future__ import annotations

import base64
import functools
import hashlib
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, table, written

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pre-tokenising pattern that belongs to the vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Documents of a hash range, about.
RANGE_ROWS = 100_000


@functools.lru_cache(maxsize=2)
def _encoding(digest: str, vocabulary: bytes):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding(digest, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, doc_id: str, source: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, source, n_tokens); a null text has no tokens. The vocabulary is read by the driver and sent along."""
    vocabulary = Path(tokenizer).read_bytes()
    digest = hashlib.sha256(vocabulary).hexdigest()

    def kernel(batch: pa.RecordBatch) -> dict:
        encode = _encoding(digest, vocabulary).encode_ordinary
        counts = np.array([len(encode(t)) if t else 0 for t in batch.column("text").to_pylist()], np.int64)
        return {"doc_id": batch.column("doc_id"), "source": batch.column("source"), "n_tokens": counts}

    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    return arrow_map(rows, "text", f"doc_id {dict(rows.dtypes)['doc_id']}, source string, n_tokens long", kernel)


def finish_line(plan: list[tuple[float, float]], budget: float) -> float:
    """The virtual time at which sources of (share, tokens with all repeats) have been served budget tokens, or all."""
    served, weight, now = 0.0, sum(w for w, _ in plan), 0.0
    for w, most in sorted(plan, key=lambda x: x[1] / x[0]):
        out = most / w
        if served + (out - now) * weight >= budget:
            return now + (budget - served) / weight
        served, now, weight = served + (out - now) * weight, out, weight - w
    return now


def source_shares(sizes: DataFrame, plan: DataFrame) -> tuple[DataFrame, int]:
    """(source, target_share, max_repeats, n_docs, n_tokens, n_ranges) of each planned source, and the total size.

    The total counts every document once, also those of no source or one outside the plan. A source without
    documents has 0. Plan rows of one source are added up; without a positive share a source is not planned; without
    a number of repeats it is taken once.
    """
    per_source = written(sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")), "per_source")
    total = per_source.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("t")).first()["t"]
    wanted = plan.where("source is not null and target_share > 0").groupBy("source")
    wanted = wanted.agg(F.sum("target_share").alias("target_share"), F.max(F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0))).alias("max_repeats"))
    joined = wanted.join(per_source, "source", "left")
    return joined.select(
        "source", "target_share", "max_repeats", F.coalesce("n_docs", F.lit(0)).alias("n_docs"), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
        F.greatest(F.lit(1), F.ceil(F.col("n_docs") / RANGE_ROWS)).cast("int").alias("n_ranges"),
    ), total


def queued(sizes: DataFrame, shares: DataFrame, line: float, seed: int = 0) -> DataFrame:
    """Each planned document (doc_id, source, n_tokens) with the numbers of its copies that finish up to the line (repeats), and the place of its last copy's end in the source's queue (last, in tokens)."""
    docs = sizes.join(F.broadcast(shares.select("source", "target_share", "max_repeats", F.col("n_tokens").alias("size"), "n_ranges")), "source")
    docs = docs.withColumn("h", F.xxhash64(F.lit(seed), "doc_id")).withColumn("range", F.floor((F.col("h") / 2.0**64 + 0.5) * F.col("n_ranges")).cast("int"))
    ranges = docs.groupBy("source", "range").agg(F.sum("n_tokens").alias("t"))
    offsets = ranges.select("source", "range", F.expr("sum(t) over (partition by source order by range) - t").alias("offset"))
    within = docs.withColumn("upto", F.expr("sum(n_tokens) over (partition by source, range order by h, doc_id rows unbounded preceding)"))
    placed = within.join(offsets, ["source", "range"]).withColumn("upto", F.col("upto") + F.col("offset"))
    ends = F.filter(F.sequence(F.lit(1), F.greatest("max_repeats", F.lit(1))), lambda k: (k <= F.col("max_repeats")) & (_finish(k) <= line * (1 + 1e-12)))
    return placed.withColumns({"repeats": ends, "last": F.greatest(F.col("max_repeats") - 1, F.lit(0)) * F.col("size") + F.when(F.col("max_repeats") > 0, F.col("upto")).otherwise(0)})


def _finish(copy):
    """Virtual finish time of a document's copy with this number."""
    return ((copy - 1) * F.col("size") + F.col("upto")) / F.col("target_share")


def combined(sizes: DataFrame, plan: DataFrame, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """The combined set (doc_id, source, repeat, n_tokens, finish), in the order of finish, and the shares reached.

    sizes is (doc_id, source, n_tokens). The budget is the total size of sizes. Ties in finish are ordered by
    source, document and repeat. Documents of no planned source are not taken. An empty corpus or plan gives an empty set.
    """
    shares, budget = source_shares(sizes, plan)
    shares = written(shares, "shares")
    known = [(r["target_share"], r["n_tokens"] * r["max_repeats"]) for r in shares.collect() if r["n_tokens"] * r["max_repeats"] > 0]  # a row per planned source
    queue = queued(sizes, shares, finish_line(known, budget) if known else 0.0, seed)
    taken = queue.withColumn("repeat", F.explode("repeats")).select("doc_id", "source", "repeat", "n_tokens", _finish(F.col("repeat")).alias("finish"))
    copies = F.size("repeats")
    got = queue.groupBy("source").agg(F.sum(copies).alias("n_taken"), F.sum(copies * F.col("n_tokens")).alias("tokens_taken"), F.max(F.coalesce(F.array_max("repeats"), F.lit(0))).alias("repeats"), F.max("last").alias("last"))
    report = shares.join(got, "source", "left").withColumn("tokens_taken", F.coalesce("tokens_taken", F.lit(0)))
    all_taken = F.sum("tokens_taken").over(_everything())
    report = report.select(
        "source", "target_share", "max_repeats", "n_docs", "n_tokens", F.coalesce("n_taken", F.lit(0)).alias("n_taken"), "tokens_taken", F.coalesce("repeats", F.lit(0)).alias("repeats"),
        F.when(all_taken > 0, F.col("tokens_taken") / all_taken).otherwise(0.0).alias("share"), (F.coalesce("last", F.lit(0)) < F.col("target_share") * budget).alias("short"),
    )
    return taken.orderBy("finish", "source", "doc_id", "repeat"), report


def _everything():
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))  # one row per planned source


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return written(token_counts(table(spark, sf_dir, "documents"), "doc_id", "source", "text"), "sizes")


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combined(_sizes(spark, sf_dir), table(spark, sf_dir, "mix_plan"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combined(_sizes(spark, sf_dir), table(spark, sf_dir, "mix_plan"))[1]


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p8_shares(spark, sf_dir).where("short").select("source")
