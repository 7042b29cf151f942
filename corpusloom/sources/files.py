"""Sources: JSON Lines, JSON documents, texts, key lists, images and PDF pages."""

from __future__ import annotations

import zlib
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import png
from ..functions.text import strip
from ..operators.tables import exists, file_system

# Suffixes of source files.
JSON_SUFFIXES, TEXT_SUFFIXES = (".json", ".jsonl"), (".txt", ".md")


def _listed(spark: SparkSession, path: str) -> list[str] | None:
    """The files at or below a path of any file system; null where there is none. Metadata only; on the driver."""
    system, target = file_system(spark, path)
    if not system.exists(target):
        return None
    if system.getFileStatus(target).isFile():
        return [path]
    found, files = [], system.listFiles(target, True)
    while files.hasNext():
        found.append(str(files.next().getPath().toString()))
    return sorted(found)


def discover(path: str | Path, spark: SparkSession | None = None) -> list[str]:
    """A file, or the source files below a folder in the order of their paths. Paths with a scheme need the session."""
    if "://" in str(path):
        listed = _listed(spark or SparkSession.active(), str(path))
        if listed is None:
            raise FileNotFoundError(f"no such source: {path}")
        return listed if listed == [str(path)] else [p for p in listed if p.lower().endswith(JSON_SUFFIXES + TEXT_SUFFIXES)]
    root = Path(path)
    if root.is_file():
        return [str(root)]
    if not root.is_dir():
        raise FileNotFoundError(f"no such source: {root}")
    return sorted(str(p) for p in root.rglob("*") if p.is_file() and p.suffix.lower() in JSON_SUFFIXES + TEXT_SUFFIXES)


def discover_by_kind(path: str | Path, spark: SparkSession | None = None) -> tuple[list[str], list[str]]:
    """Text files and JSON files; both empty where the path doesn't exist or has another suffix."""
    try:
        found = discover(path, spark)
    except FileNotFoundError:
        return [], []
    return tuple([p for p in found if Path(p).suffix.lower() in kinds] for kinds in (TEXT_SUFFIXES, JSON_SUFFIXES))


def _path() -> Column:
    return F.regexp_replace(F.col("_metadata.file_path"), "^file:(//)?", "")


def _stem() -> Column:
    return F.regexp_replace(F.col("_metadata.file_name"), r"(?<=.)\.[^.]*$", "")


def _record_columns(raw: DataFrame) -> DataFrame:
    """(record, source_file, ordinal) -> records: the JSON text, its parsed form, where it came from and its place."""
    return raw.select("record", F.try_parse_json("record").alias("value"), "source_file", "ordinal")


def read_json_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(record, value, source_file, ordinal) of JSON Lines: blank lines, malformed ones and those that aren't objects are left out.

    value is a VARIANT, so every key of a heterogeneous record is kept. ordinal grows with the place in a file.
    """
    lines = spark.read.text(paths).select(strip("value").alias("record"), _path().alias("source_file"), F.monotonically_increasing_id().alias("ordinal"))
    return _record_columns(lines.where("record <> ''")).where(_is_object())


def _is_object() -> Column:
    return F.col("value").isNotNull() & F.schema_of_variant("value").startswith("OBJECT")


def read_json_lines_strict(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """As read_json_lines, but a line that is neither blank nor an object ends the query with an error."""
    lines = spark.read.text(paths).select(strip("value").alias("record"), _path().alias("source_file"), F.monotonically_increasing_id().alias("ordinal"))
    records = _record_columns(lines.where("record <> ''"))
    error = F.raise_error(F.concat(F.lit("not a JSON object in "), "source_file", F.lit(": "), F.substring("record", 1, 80)))
    return records.withColumn("record", F.when(_is_object(), F.col("record")).otherwise(error))


def read_json_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The same columns of whole JSON documents: a list gives its objects, an object is one record, anything else none."""
    docs = spark.read.text(paths, wholetext=True).select(F.try_parse_json("value").alias("doc"), _path().alias("source_file"))
    kind = F.schema_of_variant("doc")
    items = docs.where("doc is not null").select(
        "source_file", F.posexplode(F.when(kind.startswith("ARRAY"), F.try_variant_get("doc", "$", "array<variant>")).when(kind.startswith("OBJECT"), F.array("doc"))).alias("ordinal", "value")
    )
    return items.where(_is_object()).select(F.to_json("value").alias("record"), "value", "source_file", F.col("ordinal").cast("long").alias("ordinal"))


def read_texts(spark: SparkSession, paths: str | list[str], target: str = "content") -> DataFrame:
    """(id, title, <target>, source_file, book) with one row per text file: id and title are the stem, book the parent folder. Blank files have no row."""
    rows = spark.read.text(paths, wholetext=True)
    rows = rows.select(_stem().alias("id"), _stem().alias("title"), F.col("value").alias(target), _path().alias("source_file"), F.element_at(F.split(_path(), "/"), -2).alias("book"))
    return rows.where(F.length(strip(target)) > 0)


def field(name: str, kind: str = "string") -> Column:
    """A field of value; null where it is absent, null or (for strings) no string."""
    found = F.try_variant_get("value", f"$['{name}']", kind)
    if kind != "string":
        return found
    return F.when(F.schema_of_variant(F.try_variant_get("value", f"$['{name}']", "variant")) == "STRING", found)


def entries(spark: SparkSession, path: str, target: str = "content", id_key: str = "id", title_key: str = "title") -> DataFrame:
    """(id, title, <target>, source_file, ordinal, record, book) of all source files below a path, one union over the formats.

    book is the folder of a text, null for records.

    Only the target must be a string; ids of another type are cast. A record's own source_file wins over the path.
    """
    found, parts = discover(path, spark), []
    by = {s: [p for p in found if p.lower().endswith(s)] for s in JSON_SUFFIXES + TEXT_SUFFIXES}
    for reader, paths in ((read_json_lines, by[".jsonl"]), (read_json_documents, by[".json"])):
        if paths:
            ident = F.try_variant_get("value", f"$['{id_key}']", "string")
            parts.append(reader(spark, paths).select(ident.alias("id"), field(title_key).alias("title"), field(target).alias(target), F.coalesce(field("source_file"), "source_file").alias("source_file"), "ordinal", "record", F.lit(None).cast("string").alias("book")))
    if texts := by[".txt"] + by[".md"]:
        parts.append(read_texts(spark, texts, target).withColumns({"ordinal": F.lit(0).cast("long"), "record": F.lit(None).cast("string")}))
    if not parts:
        return spark.createDataFrame([], f"id string, title string, `{target}` string, source_file string, ordinal long, record string, book string")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_any(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, record or text) by suffix: JSON and JSON Lines as records, everything else (csv and tsv too) as raw text."""
    low = path.lower()
    if low.endswith(".jsonl"):
        return read_json_lines(spark, path).select("source_file", "record")
    if low.endswith(".json"):
        return read_json_documents(spark, path).select("source_file", "record")
    return spark.read.text(path, wholetext=True).select(_path().alias("source_file"), F.col("value").alias("record"))


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    """(cache_key): the distinct non-blank lines of a key list, stripped at the ends only. A missing list is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], "cache_key string")
    return spark.read.text(path).select(strip("value").alias("cache_key")).where("cache_key <> ''").distinct()


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(source_file, image): image files in base64."""
    return spark.read.format("binaryFile").load(path).select(_path().alias("source_file"), F.base64("content").alias("image"))


def crop_box(box: tuple[float, float, float, float], width: int, height: int, margin: float = 0.1) -> tuple[int, int, int, int]:
    """Pixels of a box given in thousandths, widened by the margin and kept within the image."""
    left, top, right, bottom = box
    low, high = 1 - margin, 1 + margin
    return max(0, int(left * low * width / 1000)), max(0, int(top * low * height / 1000)), min(width, int(right * high * width / 1000)), min(height, int(bottom * high * height / 1000))


def crop_images(images: DataFrame, box: str = "box", content: str = "content", margin: float = 0.1) -> DataFrame:
    """images with column image: the part of each PNG image (binary) within its box, as PNG in base64.

    A box is an array of left, top, right and bottom in thousandths of the image. Null where image or box is null, holds no pixel
    or cannot be read.
    """

    @F.pandas_udf("binary")
    def crop(contents: pd.Series, boxes: pd.Series) -> pd.Series:
        def one(data, where):
            if data is None or where is None:
                return None
            try:
                pixels, _ = png.read(data)
                return png.cropped(data, crop_box(tuple(where), pixels.shape[1], pixels.shape[0], margin))
            except (ValueError, KeyError, TypeError, zlib.error):
                return None

        return pd.Series([one(d, w) for d, w in zip(contents, boxes, strict=True)])

    return images.withColumn("image", F.base64(crop(F.col(content), F.col(box))))


def pdf_pages(spark: SparkSession, path: str, dpi: int = 200) -> DataFrame:
    """(source_file, page, png) of PDF files, where an optional PDF library is installed."""
    try:
        import fitz  # noqa: F401
    except ImportError as e:
        raise RuntimeError("reading PDF pages needs the optional library PyMuPDF") from e

    def render(batches):
        import fitz
        import pandas as pd

        for pdf in batches:
            for name, content in zip(pdf["source_file"], pdf["content"], strict=True):
                with fitz.open(stream=content, filetype="pdf") as doc:
                    pages = [(name, i + 1, page.get_pixmap(matrix=fitz.Matrix(dpi / 72, dpi / 72)).tobytes("png")) for i, page in enumerate(doc)]
                yield pd.DataFrame(pages, columns=["source_file", "page", "png"])

    return spark.read.format("binaryFile").load(path).select(_path().alias("source_file"), "content").mapInPandas(render, "source_file string, page int, png binary")
