"""Problem 7: evaluation texts in the corpus, by suffix arrays of the corpus shards.

Each task builds the suffix array of its own documents and binary-searches every suffix of the test items in
it, so the corpus is read once and never shuffled. Suffixes that cannot hold a match (one of the short strings at the
ends of their first LEAST_RUN code points is in no item) are left out before sorting, which loses no match. Suffixes
stand in the order of these first code points, and within equal ones of the code point before them: an item's suffix
then finds the suffixes that agree with it for the least length, and passes over those whose match would also go on to the left.
What remains is one place per maximal match, even in a text of one repeated character, and is extended
to the right to its longest verbatim match. Compared are letters and digits of the one form.

The items go to all tasks as a bounded block; more items than a block holds take one pass for each block.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BATCH_CHARS, agreeing, arrow_map, blank, code_points, mixed, table
from .textform import canonical

#: Letters and digits of the least run that counts, by language of the item.
LEAST_RUN, LEAST_RUN_BY_LANG = 40, {"en": 80}
#: Code points of items that are sent to the tasks at once.
BLOCK_CHARS = 8_000_000
#: Code points of the strings that tell whether a suffix can match, and bits of the table of those that items have.
_GRAM, _TABLE_BITS = 8, 24
#: Matches that are extended at once.
_EXTEND = 50_000


@functools.cache
def _kept() -> np.ndarray:
    return np.array([chr(c).isalnum() for c in range(0x110000)])


def letters_and_digits(texts: list[str], bare: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the letters and digits of all forms, and the number of the text of each; bare texts are made of them already."""
    codes, ends = code_points(texts if bare else [canonical(x) for x in texts])
    keep = _kept()[codes]
    return codes[keep], np.repeat(np.arange(len(texts)), np.diff(ends))[keep]


def _slots(codes: np.ndarray) -> np.ndarray:
    """For each place the slot of the string of _GRAM code points from there on."""
    n, wide = max(0, len(codes) - _GRAM + 1), codes.astype(np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(_GRAM):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += wide[i : i + n]
    return (mixed(out) >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


class Texts:
    """Letters and digits of several texts, the place after the end of each place's text, and the code point before each place (0 where a text begins)."""

    def __init__(self, texts: list[str], bare: bool = False):
        self.codes, self.owner = letters_and_digits(texts, bare)
        count = np.bincount(self.owner, minlength=len(texts))
        self.stop = np.repeat(np.cumsum(count), count)
        self.before = np.r_[np.zeros(min(1, len(self.codes)), np.uint32), self.codes[:-1]]
        self.before[np.flatnonzero(np.r_[True, self.owner[1:] != self.owner[:-1]][: len(self.owner)])] = 0

    def heads(self, at: np.ndarray, run: int, before: np.ndarray) -> np.ndarray:
        """The first run code points of the suffixes at these places, with the code point before them last, as strings in their order."""
        window = np.empty((len(at), run + 1), ">u4")
        window[:, :run] = self.codes[at[:, None] + np.arange(run)]
        window[:, run] = before
        return window.view(f"S{4 * (run + 1)}").ravel()


class Items(Texts):
    """The test items, with the suffixes that are long enough to hold a match."""

    def __init__(self, texts: list[str], least: np.ndarray):
        super().__init__(texts)
        self.least, self.run = least, int(least.min())
        self.longest = int(np.bincount(self.owner, minlength=1).max()) if len(self.owner) else 0
        self.places = np.flatnonzero(self.stop - np.arange(len(self.codes)) >= least[self.owner])
        seen = np.zeros(1 << _TABLE_BITS, bool)
        seen[_slots(self.codes)] = True
        self.packed = np.packbits(seen)

    def __getstate__(self) -> dict:
        # what a task can make itself is not sent
        return {k: v for k, v in self.__dict__.items() if k not in ("seen", "searched")}

    @functools.cached_property
    def seen(self) -> np.ndarray:
        """Whether an item may have a string of this slot."""
        return np.unpackbits(self.packed).view(bool)

    @functools.cached_property
    def searched(self) -> tuple[np.ndarray, ...]:
        """Every suffix of an item, as it stands before, at and after the suffixes with its own code point in front."""
        return tuple(self.heads(self.places, self.run, x) for x in (0, self.before[self.places], 0xFFFFFFFF))


class Suffixes(Texts):
    """The suffix array of several documents, to the depth of the least match."""

    def __init__(self, texts: list[str], items: Items, bare: bool = False):
        super().__init__(texts, bare)
        run = items.run
        at = np.flatnonzero(self.stop - np.arange(len(self.codes)) >= run)
        can = items.seen[_slots(self.codes)]
        at = at[can[at]]
        at = at[can[at + run - _GRAM]]
        keys = self.heads(at, run, self.before[at])
        order = np.argsort(keys, kind="stable")
        self.places, self.keys = at[order], keys[order]


def matches(docs: Suffixes, items: Items) -> np.ndarray:
    """Rows (text of docs, text of items, length): the longest match of each pair that has one of the least length."""
    lowest, own, highest = items.searched
    low, own_low, own_high, high = (np.searchsorted(docs.keys, k, side=s) for k, s in ((lowest, "left"), (own, "left"), (own, "right"), (highest, "right")))
    # where both texts begin, or the code points before differ, a match is maximal to the left
    starts = items.before[items.places] == 0
    own_low, own_high = np.where(starts, low, own_low), np.where(starts, low, own_high)
    found = [np.zeros((0, 3), np.int64)]
    for a, b in ((low, own_low), (own_high, high)):
        count = b - a
        ends, start = np.cumsum(count), 0
        while start < len(count):
            base = ends[start - 1] if start else 0
            # one suffix of an item can have more places than are extended at once
            stop = max(start + 1, int(np.searchsorted(ends, base + _EXTEND, side="right")))
            n = count[start:stop]
            which = np.repeat(np.arange(start, stop), n)
            place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + a[which]
            for i in range(0, len(which), _EXTEND):
                x, y = docs.places[place[i : i + _EXTEND]], items.places[which[i : i + _EXTEND]]
                size = agreeing(docs.codes, items.codes, x, y, np.minimum(docs.stop[x] - x, items.stop[y] - y), 1)
                item = items.owner[y]
                ok = size >= items.least[item]
                found.append(_longest(np.stack([docs.owner[x[ok]], item[ok], size[ok]], axis=1)))
            start = stop
    return _longest(np.concatenate(found))


def _longest(rows: np.ndarray) -> np.ndarray:
    rows = rows[np.lexsort((-rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[first]


def parts(text: str, longest: int) -> list[str]:
    """The letters and digits of a text of extreme length in parts that overlap by more than the longest item, so that every match is whole in one of them."""
    codes, _ = letters_and_digits([text])
    bare = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return [bare[i : i + BATCH_CHARS + longest + 1] for i in range(0, len(bare), BATCH_CHARS)]


def found_in(texts: list[str], items: Items) -> np.ndarray:
    """Rows (text, item, length) as matches gives them, with texts of extreme length taken in parts."""
    long = {i for i, t in enumerate(texts) if len(t) > 2 * BATCH_CHARS}
    usual = np.array([i for i in range(len(texts)) if i not in long], np.int64)
    out = [matches(Suffixes([texts[i] for i in usual], items), items)]
    out[0][:, 0] = usual[out[0][:, 0]]
    for i in sorted(long):
        for part in parts(texts[i], items.longest):
            out.append(matches(Suffixes([part], items, bare=True), items))
            out[-1][:, 0] = i
    return _longest(np.concatenate(out))


def _least(lang: str | None) -> int:
    return LEAST_RUN_BY_LANG.get(lang or "", LEAST_RUN)


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_chars): documents with a run of an item (item_id, lang, text), and the longest run's length.

    Null, blank and short texts have no run; documents and items without an id are left out. Equal documents are all reported, a repeated id once. Any
    other columns are ignored; an empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    items = items.where(~blank(F.col("text")) & F.col("item_id").isNotNull()).select("item_id", "lang", "text")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // BLOCK_CHARS))
    schema = "doc_id long, item_id long, n_chars long"
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where(~blank(F.col("text")) & F.col("doc_id").isNotNull())
    out = None
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        if not rows:
            continue
        items_of_block = Items([r["text"] for r in rows], np.array([_least(r["lang"]) for r in rows]))
        ids = np.array([r["item_id"] for r in rows], np.int64)

        def kernel(batch: pa.RecordBatch, index=items_of_block, ids=ids) -> dict | None:
            rows = found_in(batch.column("text").to_pylist(), index)
            if not len(rows):
                return None
            return {"doc_id": np.asarray(batch.column("doc_id"))[rows[:, 0]], "item_id": ids[rows[:, 1]], "n_chars": rows[:, 2]}

        part = arrow_map(source, "text", schema, kernel)
        out = part if out is None else out.union(part)
    if out is None:
        return spark.createDataFrame([], schema)
    return out.groupBy("doc_id", "item_id").agg(F.max("n_chars").alias("n_chars"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item")).select("doc_id", "item_id")


def p7_leaked_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that leaked: in how many documents, and the longest run."""
    found = leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_item"))
    return found.groupBy("item_id").agg(F.count("*").alias("n_docs"), F.max("n_chars").alias("longest"))


def p7_clean_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus without the affected documents."""
    docs = table(spark, sf_dir, "documents")
    return docs.join(leaks(docs, table(spark, sf_dir, "eval_item")).select("doc_id").distinct(), "doc_id", "left_anti")
