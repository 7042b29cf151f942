"""Rows for publication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip

# Fields that are not published.
PRIVATE_FIELDS = ("source_file", "copyright_mitigation")


def is_mitigated(c: Column | str = "copyright_mitigation") -> Column:
    """true as a boolean or as text; null is not."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.lower(strip(c.cast("string"))) == "true", F.lit(False))


def upload_columns(df: DataFrame) -> DataFrame:
    """Typed form: the mitigated rows without the private columns."""
    return df.where(is_mitigated()).drop(*PRIVATE_FIELDS)


def upload_rows(records: DataFrame) -> DataFrame:
    """Schema-free form: (record) without the private fields of mitigated records, every other key kept."""
    flag = F.try_variant_get("value", "$.copyright_mitigation", "string")
    fields = F.from_json("record", "map<string, variant>")
    kept = F.map_filter(fields, lambda k, _: ~k.isin(*PRIVATE_FIELDS))
    return records.where(is_mitigated(flag)).select(F.to_json(kept).alias("record"))


def counts(df: DataFrame, by: str = "source_file") -> DataFrame:
    return df.groupBy(by).agg(F.count("*").alias("n_records"))


def without_private(df: DataFrame) -> DataFrame:
    """Columns whose name starts with an underscore are internal."""
    return df.select(*[f"`{c}`" for c in df.columns if not c.startswith("_")])
