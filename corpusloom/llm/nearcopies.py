"""Problem 2: records that share most of their content, by Golay-code fuzzy hashing.

A text's distinct 5-character strings stand in one order for all texts (by hash, frequent strings later); the
first ANCHORS of them are its anchors, so two texts that agree to 0.6 nearly always have several in common, wherever
their edits are. Beside each anchor stands a segment of SEGMENT characters, on the side that the anchor's hash
names. The segment's fingerprint is a 23-bit word with one bit per class of characters: the parity of their
number. A replaced character flips two bits at most, an inserted or a lost one (with the one that it pushes out of the segment)
two as well. Each word is decoded to the indices of the Golay codewords near it, and words at a distance of two
or less share one, so a segment with one edit still gives an equal key. At the threshold a text has about one edit in 20
characters, so by the pigeonhole principle the segments of the shared anchors have one edit or less on average, and some have
no more than that. Short texts are paired by the anchor alone: as many of their first strings are anchors as any text that
agrees to 0.6 must share one of. Pairs with an equal key are filtered by sizes and by a sketch, and then verified by the exact measure.

Exact copies are one class before anything is joined, so a text that a third of all rows repeat is one row. An
anchor that very many texts have is split over a grid of cells. Nothing is capped.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, chunk_texts, code_points, mixed, semi, written
from .golaycode import near_codewords
from .textform import canonical

GRAM, THRESHOLD = 5, 0.6
#: Anchors of a text, characters of a segment, and strings up to which a text is paired by its anchors alone.
ANCHORS, SEGMENT, SHORT = 10, 20, 24
#: A string is frequent if so many texts have it among their first COUNTED ones; it then stands later in the order by that factor.
FREQUENT, COUNTED = 50, 32
#: Frequent strings at most, by raising FREQUENT with the number of texts: what is sent to all tasks is 12 bytes each.
MOST_FREQUENT = 1 << 22
#: Bits of a sketch, and those that may differ: at the threshold a fifth of them does, and this is 4.5 deviations more.
SKETCH, DIFFER = 256, 80
#: Texts of an anchor that one cell takes, about; rows of a shard, about; pairs looked at in one go.
HOT_ROWS, SHARD_ROWS, PAIRS_AT_ONCE = 20_000, 400_000, 2_000_000
_strip = re.compile(r"\s+").sub


def class_id(tbl: str, form: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{tbl}\t{form}".encode("utf-8", "surrogatepass")) - (1 << 63)


def classes(df: DataFrame) -> DataFrame:
    """(tbl, key, cls, salt, flat) of (tbl, key, text): the class of equal forms, and of at least one of a class the form without white space; only equal salts meet."""

    def kernel(batch: pa.RecordBatch) -> dict:
        tbl, forms = batch.column("tbl").to_pylist(), [canonical(x) for x in batch.column("text").to_pylist()]
        cls = np.array([class_id(a, b) for a, b in zip(tbl, forms, strict=True)], np.int64)
        flat: list[str | None] = [None] * len(forms)
        for i in np.unique(cls, return_index=True)[1]:
            flat[i] = _strip("", forms[i])
        return {"tbl": batch.column("tbl"), "key": batch.column("key"), "cls": cls, "salt": np.array([class_id(t, "") for t in tbl], np.int64), "flat": pa.array(flat, pa.string())}

    return arrow_map(df.select("tbl", "key", "text"), "text", "tbl string, key string, cls long, salt long, flat string", kernel)


@functools.cache
def _bit_of() -> np.ndarray:
    """The bit of a 23-bit word that each code point toggles."""
    return np.left_shift(np.int32(1), (mixed(np.arange(0x110000, dtype=np.uint64)) % np.uint64(23)).astype(np.int32))


# Odd multipliers of the places of a string.
_PLACES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)
#: Bits of a string's hash; the rest of a number holds the text, of which a batch has fewer.
_BITS = 48


class Strings:
    """The distinct strings of several texts by text and hash: hash, text, a place of each (the first, if asked for); and each text's number of them."""

    def __init__(self, flat: list[str], salt: np.ndarray, places: bool = True, first: bool = False):
        self.codes, self.ends = code_points(flat)
        n, fit = len(flat), max(0, len(self.codes) - GRAM + 1)
        wide = self.codes.astype(np.uint64)
        hashes = np.zeros(fit, np.uint64)
        for i, m in enumerate(_PLACES):
            hashes += wide[i : i + fit] * np.uint64(m)
        owner = np.repeat(np.arange(n, dtype=np.uint64), np.diff(self.ends))
        at = np.flatnonzero(owner[:fit] == owner[GRAM - 1 :][:fit])
        # only equal salts share strings
        owner = owner[at]
        key = (mixed(hashes[at] ^ (salt[0] if n and (salt == salt[0]).all() else salt[owner.astype(np.int64)])) >> np.uint64(64 - _BITS)) | (owner << np.uint64(_BITS))
        if places:
            order = np.argsort(key)
            key = key[order]
        else:
            key = np.sort(key)
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        key = key[new]
        self.at = at[order[new]] if places else None
        if first and len(key):
            self.at = np.minimum.reduceat(at[order], np.flatnonzero(new))
        self.hash, self.owner = key & np.uint64((1 << _BITS) - 1), (key >> np.uint64(_BITS)).astype(np.int64)
        self.size = np.bincount(self.owner, minlength=n)
        self.nth = np.arange(len(self.hash)) - (np.cumsum(self.size) - self.size)[self.owner]

    def anchors(self, frequent: np.ndarray, factor: np.ndarray) -> np.ndarray:
        """Numbers of the strings that are anchors."""
        use = np.zeros(len(self.hash), bool)
        # texts that are short, or may agree with a short one: one more than the strings that need not be shared
        most = np.where(self.size <= SHORT * 5 // 3, self.size - -(-3 * self.size // 5) + 1, ANCHORS)
        # no string stands earlier than its hash says, so the first ones by hash mostly have all anchors among them
        todo = np.ones(len(self.size), bool)
        for ahead in (COUNTED, 4 * COUNTED, len(self.hash) + 1):
            near = np.flatnonzero(todo[self.owner] & (self.nth < ahead))
            order = self.hash[near].astype(np.float64)
            last = np.zeros(len(self.size))
            np.maximum.at(last, self.owner[near], order)
            last[self.size <= ahead] = np.inf
            if len(frequent):
                found = np.minimum(np.searchsorted(frequent, self.hash[near]), len(frequent) - 1)
                order *= np.where(frequent[found] == self.hash[near], factor[found], 1.0)
            ranked = np.lexsort((order, self.owner[near]))
            near, order = near[ranked], order[ranked]
            owner = self.owner[near]
            count = np.bincount(owner, minlength=len(self.size))
            nth = np.arange(len(near)) - (np.cumsum(count) - count)[owner]
            # complete if the last anchor stands before all strings that were not looked at
            anchor = nth < most[owner]
            short_of = np.bincount(owner, weights=anchor & (order > last[owner]), minlength=len(self.size)) > 0
            use[near[anchor & ~short_of[owner]]] = True
            todo &= short_of
            if not todo.any():
                break
        return np.flatnonzero(use)

    def words(self, of: np.ndarray) -> np.ndarray:
        """The 23-bit words of the segments beside the strings with these numbers."""
        parity = np.r_[np.int32(0), np.bitwise_xor.accumulate(_bit_of()[self.codes])]
        at, text = self.at[of], self.owner[of]
        right = (self.hash[of] & np.uint64(1)).astype(bool)
        start = np.where(right, at + GRAM, np.maximum(at - SEGMENT, self.ends[text]))
        stop = np.where(right, np.minimum(at + GRAM + SEGMENT, self.ends[text + 1]), at)
        return parity[stop] ^ parity[start]

    def sketches(self) -> np.ndarray:
        """SKETCH bits a text, as words of 64: a bit of the least hash in each of as many ranges of hashes."""
        place = (self.hash >> np.uint64(_BITS - SKETCH.bit_length() + 1)).astype(np.int64)
        first = np.ones(len(place), bool)
        first[1:] = (place[1:] != place[:-1]) | (self.owner[1:] != self.owner[:-1])
        bits = np.zeros((len(self.size), SKETCH), bool)
        bits[self.owner[first], place[first]] = mixed(self.hash[first]) & np.uint64(1)
        return np.packbits(bits, axis=1).view(np.uint64)


def _strings(batch: pa.RecordBatch, places: bool = True) -> Strings:
    return Strings(batch.column("flat").to_pylist(), np.asarray(batch.column("salt")).view(np.uint64), places)


def frequent_strings(texts: DataFrame, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of frequent strings, ascending, and how much later each stands; MOST_FREQUENT at most."""

    def kernel(batch: pa.RecordBatch) -> dict:
        s = _strings(batch, places=False)
        found, n = np.unique(s.hash[s.nth < COUNTED], return_counts=True)
        return {"gram": found.view(np.int64), "n": n}

    least = max(FREQUENT, -(-COUNTED * n_texts // MOST_FREQUENT))
    counts = arrow_map(texts, "flat", "gram long, n long", kernel).groupBy("gram").agg(F.sum("n").cast("int").alias("n")).where(F.col("n") >= least)
    rows = counts.toArrow()
    gram, n = np.asarray(rows.column("gram").combine_chunks()).view(np.uint64), np.asarray(rows.column("n").combine_chunks())
    order = np.argsort(gram)
    return gram[order], (n[order] / least).astype(np.float32)


def keyed(texts: DataFrame, n_texts: int) -> DataFrame:
    """(shard, anchor, side, word, cls, size, sketch): a row for each anchor of a text; of an anchor that very many texts have, a row in each cell of its block."""
    least = max(FREQUENT, -(-COUNTED * n_texts // MOST_FREQUENT))
    frequent = texts.sparkSession.sparkContext.broadcast(frequent_strings(texts, n_texts))
    shards = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), n_texts * ANCHORS // SHARD_ROWS)

    def kernel(batch: pa.RecordBatch) -> dict | None:
        s, (gram, factor) = _strings(batch), frequent.value
        of = s.anchors(gram, factor)
        if not len(of):
            return None
        anchor, cls = s.hash[of], np.asarray(batch.column("cls"))[s.owner[of]]
        blocks = np.ones(len(of), np.int64)
        if len(gram):
            found = np.minimum(np.searchsorted(gram, anchor), len(gram) - 1)
            blocks = np.where(gram[found] == anchor, np.ceil(factor[found].astype(np.float64) * least / HOT_ROWS), 1).astype(np.int64)
        # a block meets itself and every other one in a cell
        row = np.repeat(np.arange(len(of)), blocks)
        own = (mixed(cls.view(np.uint64)) % blocks.astype(np.uint64)).astype(np.int64)[row]
        other = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        cell = np.minimum(own, other) * blocks[row] + np.maximum(own, other)
        key = mixed(anchor)[row]
        key = np.where(blocks[row] > 1, mixed(key ^ mixed(cell.astype(np.uint64))), key)
        at = s.owner[of][row]
        packed = s.sketches()[at]
        sketch = pa.FixedSizeBinaryArray.from_buffers(pa.binary(SKETCH // 8), len(at), [None, pa.py_buffer(np.ascontiguousarray(packed).tobytes())])
        return {
            "shard": ((key >> np.uint64(20)) % np.uint64(shards)).astype(np.int32), "anchor": key.view(np.int64), "side": np.sign(other - own).astype(np.int8),
            "word": s.words(of)[row], "cls": cls[row], "size": s.size[at].astype(np.int32), "sketch": sketch.cast(pa.binary()),
        }

    return arrow_map(texts.select("cls", "salt", "flat"), "flat", "shard int, anchor long, side byte, word int, cls long, size int, sketch binary", kernel)


def _pairs_of(key: np.ndarray, row: np.ndarray, leads: np.ndarray | None, alike) -> np.ndarray:
    """Pairs of rows (as 2 x n) with an equal key that are alike; with leads, only those whose first one leads. Keys are in order."""
    end = np.searchsorted(key, key, side="right")
    width = end - np.arange(1, len(key) + 1)
    if leads is not None:
        width = np.where(leads, width, 0)
    ends, start, found = np.cumsum(width), 0, [np.zeros((2, 0), np.int64)]
    while start < len(key):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + PAIRS_AT_ONCE, side="right")))
        w = width[start:stop]
        i = np.repeat(np.arange(start, stop), w)
        j = np.arange(len(i)) - np.repeat(np.cumsum(w) - w, w) + i + 1
        a, b = row[i], row[j]
        ok = alike(a, b)
        found.append(np.unique(np.sort(np.stack([a[ok], b[ok]]), axis=0), axis=1))
        start = stop
    return np.unique(np.concatenate(found, axis=1), axis=1)


def pairs_of_shard(part: pa.Table) -> pa.Table:
    """(cls_a, cls_b), cls_a < cls_b, of the rows that share a key."""
    anchor = np.asarray(part.column("anchor").combine_chunks())
    order = np.argsort(anchor, kind="stable")
    anchor = anchor[order]
    several = np.zeros(len(anchor), bool)
    equal = anchor[1:] == anchor[:-1]
    several[1:] |= equal
    several[:-1] |= equal
    order, anchor = order[several], anchor[several]
    columns = part.select(["side", "word", "cls", "size", "sketch"]).take(pa.array(order)).combine_chunks()
    side, word, cls, size = (columns.column(c).to_numpy() for c in ("side", "word", "cls", "size"))
    sketch = np.frombuffer(b"".join(columns.column("sketch").to_pylist()), np.uint64).reshape(-1, SKETCH // 64)
    # a group counts from 0, so that group and codeword index fit a number
    group = np.cumsum(np.r_[False, anchor[1:] != anchor[:-1]])

    def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        x, y = size[a].astype(np.int64), size[b].astype(np.int64)
        ok = (np.minimum(x, y) * 5 >= np.maximum(x, y) * 3) & (cls[a] != cls[b]) & ((side[a] == 0) | (side[a] != side[b]))
        at = np.flatnonzero(ok)
        ok[at] = np.bitwise_count(sketch[a[at]] ^ sketch[b[at]]).sum(axis=1, dtype=np.int64) <= DIFFER
        return ok

    index, count = near_codewords(word)
    count = count.astype(np.int64)
    row = np.repeat(np.arange(len(word)), count)
    key = (group[row] << 12) | index[row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)]
    by_key = np.argsort(key, kind="stable")
    found = [_pairs_of(key[by_key], row[by_key], None, alike)]
    short = size <= SHORT
    if short.any():
        by_group = np.lexsort((~short, group))
        found.append(_pairs_of(group[by_group], by_group, short[by_group], alike))
    a, b = np.concatenate(found, axis=1)
    pairs = np.unique(np.stack([np.minimum(cls[a], cls[b]), np.maximum(cls[a], cls[b])]), axis=1)
    return pa.table({"cls_a": pairs[0], "cls_b": pairs[1]})


def candidates(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cls_a, cls_b) of the classes that share a key and may reach the threshold, cls_a < cls_b; and (cls, flat), a row of each class at least."""
    full = members.where("flat is not null")
    # one row stands for its class
    chosen = written(full.groupBy("cls").agg(F.min(F.struct("tbl", "key")).alias("r")).select("cls", "r.tbl", "r.key"), "chosen")
    n = chosen.count()
    texts = semi(full, chosen, ["cls", "tbl", "key"], n).select("cls", "salt", "flat")
    found = keyed(texts, n).groupBy("shard").applyInArrow(pairs_of_shard, "cls_a long, cls_b long")
    return found.distinct(), texts.select("cls", "flat")


def similarity(a: str, b: str) -> float:
    """Shared distinct 5-character strings of two texts without white space, divided by all of both."""
    x, y = ({t[i : i + GRAM] for i in range(len(t) - GRAM + 1)} for t in (a, b))
    return len(x & y) / len(x | y) if x or y else 0.0


def similar(a: list[str], b: list[str], threshold: float) -> np.ndarray:
    """The similarity of each pair; 0 where hashes of the strings show that the threshold is not reached."""
    n = len(a)
    s = [Strings(x, np.zeros(n, np.uint64), places=False) for x in (a, b)]
    both = np.concatenate([(x.owner.astype(np.uint64) << np.uint64(_BITS)) | x.hash for x in s])
    both.sort()
    twice = both[1:][both[1:] == both[:-1]] >> np.uint64(_BITS)
    shared = np.bincount(twice.astype(np.int64), minlength=n)
    out = shared / np.maximum(1, s[0].size + s[1].size - shared)
    # equal hashes of different strings can only raise a similarity, or lower it by a string or two
    for i in np.flatnonzero(out >= threshold - 0.02):
        out[i] = similarity(a[i], b[i])
    return np.where(out >= threshold, out, 0)


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(cls_a, cls_b, similarity) of the pairs that reach the threshold; of the (cls, flat) only those in pairs are moved."""
    involved = written(pairs.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).distinct(), "involved")
    texts = semi(texts, involved, ["cls"]).dropDuplicates(["cls"])
    joined = pairs.join(texts.withColumnsRenamed({"cls": "cls_a", "flat": "flat_a"}), "cls_a").join(texts.withColumnsRenamed({"cls": "cls_b", "flat": "flat_b"}), "cls_b")

    def kernel(batch: pa.RecordBatch) -> dict:
        found = similar(batch.column("flat_a").to_pylist(), batch.column("flat_b").to_pylist(), threshold)
        keep = pa.array(found > 0)
        return {"cls_a": batch.column("cls_a").filter(keep), "cls_b": batch.column("cls_b").filter(keep), "similarity": pa.array(found).filter(keep)}

    return arrow_map(joined.select("cls_a", "cls_b", "flat_a", "flat_b"), "flat_a", "cls_a long, cls_b long, similarity double", kernel)


def near_copies(df: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Members (tbl, key, cls) and links (cls_a, cls_b, similarity) of rows (tbl, key, text).

    Rows of a class have the same form and table; a link joins two classes of one table whose forms
    differ and whose similarity reaches the threshold, which is THRESHOLD at least. Null and blank texts must be left out before; a key
    may repeat with equal or other texts; rows without a table or key are left out; a form with fewer than five characters has no link. Repeated rows, ties and very long texts pass; an
    empty frame gives empty results. Both results are tables in the shared folder.
    """
    df = df.select("tbl", "key", "text").where("tbl is not null and key is not null")
    members = written(classes(df), "members")
    pairs, texts = candidates(members)
    return members.select("tbl", "key", "cls"), written(verified(written(pairs, "pairs"), texts, threshold), "links")


def groups(members: DataFrame, links: DataFrame) -> DataFrame:
    """(tbl, key, cls, group_id, n_links): connected groups by the smallest class id, and each class's number of links.

    Labels are lowered along links and then through the label's own label, so a chain of n classes
    takes about log n rounds; each round is a table in the shared folder.
    """
    both = links.select("cls_a", "cls_b").union(links.select("cls_b", "cls_a")).toDF("cls", "other")
    both = written(both, "edges")
    label = written(both.groupBy("cls").agg(F.least("cls", F.min("other")).alias("label")), "labels")
    while True:
        around = both.join(label.withColumnsRenamed({"cls": "other"}), "other").groupBy("cls").agg(F.min("label").alias("near"))
        up = label.toDF("label", "top")
        new = label.join(around, "cls").join(up, "label", "left").select("cls", F.least("label", "near", "top").alias("new"), "label")
        new = written(new, "labels")
        if new.where("new <> label").isEmpty():
            break
        label = new.select("cls", F.col("new").alias("label"))
    degree = both.groupBy("cls").agg(F.count("*").alias("n_links"))
    out = members.join(label.select("cls", "label"), "cls", "left").join(degree, "cls", "left")
    return out.select("tbl", "key", "cls", F.coalesce("label", "cls").alias("group_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def p2_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(*near_copies(chunk_texts(spark, sf_dir)))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, links = near_copies(chunk_texts(spark, sf_dir))
    a, b = (members.select(F.col("tbl").alias(f"tbl_{x}"), F.col("key").alias(f"k{x}"), F.col("cls").alias(f"cls_{x}")) for x in "ab")
    rows = links.join(a, "cls_a").join(b, "cls_b")
    return rows.select(F.col("tbl_a").alias("tbl"), F.least("ka", "kb").alias("key_a"), F.greatest("ka", "kb").alias("key_b"))
