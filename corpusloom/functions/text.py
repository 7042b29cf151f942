"""Text functions as Spark columns. Lengths and offsets are code points; white space is Unicode white space."""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the code points that a Unicode-aware strip removes; valid in Java regex and in RE2.
WHITE = r"\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without leading and trailing white space."""
    return F.regexp_replace(col(c), f"^[{WHITE}]+|[{WHITE}]+$", "")


def normalized(c: Column | str) -> Column:
    """Line ends unified, runs of blanks and tabs one blank, at most one empty line, stripped."""
    lines = F.regexp_replace(col(c), "\r\n?", "\n")
    return strip(F.regexp_replace(F.regexp_replace(lines, "[ \t]+", " "), "\n{3,}", "\n\n"))


def normal_form(text: str) -> str:
    """The same as normalized, of one text, for kernels that work on batches anyway."""
    text = re.sub("[ \t]+", " ", re.sub("\r\n?", "\n", text))
    return re.sub("\n{3,}", "\n\n", text).strip()


def with_title(title: Column | str, body: Column | str) -> Column:
    """Title, empty line, body; the body alone where the title is null or blank."""
    name = strip(title)
    return F.when(F.length(name) > 0, F.concat(name, F.lit("\n\n"), col(body))).otherwise(col(body))


def occurrences(c: Column | str, word: str) -> Column:
    """Non-overlapping occurrences of a word."""
    return F.regexp_count(col(c), F.lit(re.escape(word)))


def optional_bool(c: Column | str) -> Column:
    """true, 1, yes, on -> true; false, 0, no, off -> false; null -> null; other text by whether it is empty."""
    low = F.lower(strip(col(c).cast("string")))
    return F.when(low.isin("true", "1", "yes", "on"), True).when(low.isin("false", "0", "no", "off"), False).when(low.isNotNull(), F.length(col(c).cast("string")) > 0)


def tag_content(c: Column | str, tag: str) -> Column:
    """What stands after the last opening and before the next closing tag; either may be missing. Null gives ''."""
    inside = F.substring_index(F.substring_index(col(c), f"<{tag}>", -1), f"</{tag}>", 1)
    return F.coalesce(strip(inside), F.lit(""))


def tag_content_if_present(c: Column | str, tag: str) -> Column:
    c = col(c)
    return F.when(c.contains(f"<{tag}>") | c.contains(f"</{tag}>"), tag_content(c, tag)).otherwise("")


def without_tag_block(c: Column | str, tag: str) -> Column:
    """Text without its first block of the tag; an unclosed block reaches to the end."""
    c = col(c)
    before = F.substring_index(c, f"<{tag}>", 1)
    rest = F.substring(c, F.length(before) + F.lit(len(tag) + 3), F.length(c))
    end = F.instr(rest, f"</{tag}>")
    after = F.when(end > 0, F.substring(rest, end + F.lit(len(tag) + 3), F.length(rest))).otherwise("")
    return strip(F.when(c.contains(f"<{tag}>"), F.concat(before, after)).otherwise(c))


def rendered(template: str, values: Mapping[str, Column | str]) -> Column:
    """A template with {name} slots as one concat, so values are never scanned for slots. {{ and }} are braces; unused values are ignored."""
    parts = []
    for literal, name, spec, conversion in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            if spec or conversion or name not in values:
                raise KeyError(f"no value for the slot {name!r}")
            parts.append(F.coalesce(col(values[name]).cast("string"), F.lit("")))
    return F.concat(*parts) if parts else F.lit("")


def random_token(c: Column | str, key: Column | str, seed: int = 0, size: int = 10) -> Column:
    """Up to size characters of the text, drawn without repetition of a place; the same for the same key and seed.

    The draw is a partial shuffle of the places: the k-th of them comes from a digest of key, k and seed among those that
    are left, so the work does not grow with the text.
    """
    text = col(c)
    n = F.length(text)

    def draw(chosen: Column, k: Column) -> Column:
        digest = F.md5(F.concat_ws(":", col(key).cast("string"), k.cast("string"), F.lit(str(seed))))
        rest = n - F.size(chosen)
        rank = F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") % F.greatest(rest, F.lit(1))
        # the rank-th place that is not taken: go through the taken ones in order and step over those before it
        place = F.aggregate(F.array_sort(chosen), rank.cast("int"), lambda p, taken: F.when(taken <= p, p + 1).otherwise(p))
        return F.when(rest > 0, F.concat(chosen, F.array(place))).otherwise(chosen)

    places = F.aggregate(F.sequence(F.lit(1), F.lit(size)), F.array().cast("array<int>"), draw)
    token = F.array_join(F.transform(places, lambda p: F.substring(text, p + 1, F.lit(1))), "")
    return F.when(n > 0, token).otherwise("")


def chat_messages(question: Column | str, thinking: Column | str, answer: Column | str) -> Column:
    reply = F.concat(F.lit("<think>"), F.coalesce(col(thinking), F.lit("")), F.lit("</think>\n\n"), F.coalesce(col(answer), F.lit("")))
    pair = (("user", F.coalesce(col(question), F.lit(""))), ("assistant", reply))
    return F.array(*[F.struct(F.lit(role).alias("role"), text.alias("content")) for role, text in pair])


def cache_key(entry_id: Column | str, chunk_index: Column | str | None = None) -> Column:
    """id, or id and chunk index joined by a tab; a null index gives the id alone."""
    key = col(entry_id).cast("string")
    return key if chunk_index is None else F.when(key.isNotNull(), F.concat_ws("\t", key, col(chunk_index).cast("string")))


def fallback_id(source: Column | str, title: Column | str, text: Column | str) -> Column:
    """A stable id for an entry without one."""
    return F.concat_ws(":", F.coalesce(col(source), F.lit("")), F.coalesce(col(title), F.lit("")), F.sha2(F.coalesce(col(text), F.lit("")), 256))


def text_udf(kernel: Callable[[str], str]):
    """A pure function of one text as an Arrow-batched UDF; null stays null."""

    @F.pandas_udf(T.StringType())
    def run(batch: pd.Series) -> pd.Series:
        return batch.map(kernel, na_action="ignore")

    return run
