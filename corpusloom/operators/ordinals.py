"""Global row numbers, shuffles, splits and batches without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written


def with_ordinal(df: DataFrame, order: list[str | Column], name: str = "ordinal") -> DataFrame:
    """Row numbers from 1 in a total order, nulls first; ties are numbered in any way.

    Rows are range-partitioned by the whole order and sorted within partitions, so neither a frequent first key nor the
    number of rows makes one task large. The sorted rows are a table in the shared folder, whose places in their
    partitions are then raised by the sizes of the partitions before.
    """
    rows = df.select(F.struct(*df.columns).alias("_row"), *[(F.col(c) if isinstance(c, str) else c).alias(f"_o{i}") for i, c in enumerate(order)])
    keys = [f"_o{i}" for i in range(len(order))]
    ranged = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = written(ranged.select("_row", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")), "ordered")
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))  # one row per partition
    offsets = sizes.select("_part", F.expr("sum(_size) over (order by _part) - _size").alias("_before"))
    return placed.join(F.broadcast(offsets), "_part").select("_row.*", (F.col("_before") + F.col("_place") + 1).alias(name))


def shuffle_key(*columns: str, seed: int = 42) -> Column:
    """A pseudo-random key of a row, the same in every engine: md5 of its columns and the seed."""
    parts = [x for c in columns for x in (F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(":"))]
    return F.md5(F.concat(*parts, F.lit(str(seed))))


def shuffled(df: DataFrame, by: list[str], seed: int = 42, name: str = "ordinal") -> DataFrame:
    """Rows in seeded random order, numbered from 1, by ranges whose number grows with the rows."""
    return with_ordinal(df, [shuffle_key(*by, seed=seed), *by], name)


def split_size(n: int, ratio: float) -> int:
    """Training rows of n: the rounded-down share, leaving one for validation where there are two rows or more."""
    k = int(n * ratio)
    return n - 1 if n > 1 and k == n else k


def train_validation(df: DataFrame, by: list[str], ratio: float = 0.98, seed: int = 42, shuffle: bool = True) -> DataFrame:
    """df with its ordinal and split: the first split_size rows in seeded (or given) order are train, the rest validation."""
    rows = shuffled(df, by, seed) if shuffle else with_ordinal(df, list(by))
    # the rows are a written table, so their number is read from its footers
    return rows.withColumn("split", F.when(F.col("ordinal") <= split_size(rows.count(), ratio), "train").otherwise("validation"))


def batches(df: DataFrame, size: int, ordinal: str = "ordinal", start: int = 1, drop_last: bool = False) -> DataFrame:
    """Rows from place start on with their batch (from 0) and its first and last place; drop_last leaves out an incomplete last batch."""
    rows = df.where(F.col(ordinal) >= start).withColumn("batch", F.floor((F.col(ordinal) - start) / size).cast("long"))
    last = df.agg(F.coalesce(F.max(ordinal), F.lit(0)).alias("n")).first()["n"]
    stop = F.least(F.col("batch") * size + start + size - 1, F.lit(last))
    rows = rows.withColumn("batch_start", F.col("batch") * size + start).withColumn("batch_end", stop)
    return rows.where(F.col("batch_end") - F.col("batch_start") + 1 == size) if drop_last else rows


def lead_pairs(df: DataFrame, text: str, order: str, group: list[str]) -> DataFrame:
    """Each text with the next one of its group after an empty line, and the places of both; the last one with nothing.

    Rows are range-partitioned by group and order, so a frequent group is spread over many tasks. The next row of a
    partition's last one is the first row of the next partition that has any: one row per partition, carried over.
    """
    keys = [*group, order]
    rows = df.select(*keys, F.col(text).alias("_text")).repartitionByRange(*keys)
    rows = written(rows.sortWithinPartitions(*keys).withColumn("_part", F.spark_partition_id()), "ranges")
    w = Window.partitionBy("_part").orderBy(*keys)
    following = F.lead(F.struct(*group, F.lit(True).alias("_is"), "_text")).over(w).alias("_next")
    inner = rows.select("*", following)
    heads = rows.groupBy("_part").agg(F.min_by(F.struct(*group, F.lit(True).alias("_is"), "_text"), F.struct(*keys)).alias("_head"))  # a row per partition
    heads = heads.select((F.lag("_part").over(Window.orderBy("_part"))).alias("_part"), "_head").where("_part is not null")
    joined = inner.join(F.broadcast(heads), "_part", "left").withColumn("_next", F.coalesce("_next", "_head"))
    same = F.col("_next._is").isNotNull()
    for c in group:
        same = same & F.col(f"_next.{c}").eqNullSafe(F.col(c))
    pair = F.concat(F.coalesce("_text", F.lit("")), F.lit("\n\n"), F.when(same, F.coalesce("_next._text", F.lit(""))).otherwise(""))
    return joined.select(*keys, pair.alias("pair"), F.array(F.col(order), F.col(order) + 1).alias("sources"))
