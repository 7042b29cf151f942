"""Problem 3: records of held-out splits that recur, exactly or nearly, in the training split.

The held-out texts, one of each class of equal forms, make up full-text index shards: FM-indexes with the
Burrows-Wheeler transform in a wavelet matrix (a bit for each of the bits of a symbol) and sampled locations. The
training texts are streamed through them: backward search gives the number of places of every 5-character
string of a text; strings in increasing order of that number are located until so many are that a held-out text
which meets the measure must hold HITS of them, and by its size mostly many more, however its edits fall. The places
of the pairs that do are extended to maximal matches, whose spans are merged and counted, and each pair is verified by the exact measure.

Only shards that may hold a partner of a training text see that text. The strings of all texts stand in one order, those that
are rare among the held-out texts first; two texts that meet the measure share FIRST strings near the beginning of both orders, and how
near follows from their sizes. A file of the first strings of all held-out texts goes to every machine, where
the tasks map it; the training texts are read once beside it, and of each text that shares FIRST such strings with a
held-out one a copy is kept for the shard of that one. So the work at the shards grows with the texts found, not with texts
times shards. Shards are bounded, and one at a time is sent to all tasks.
"""

from __future__ import annotations

import functools
import pickle
import re
from collections.abc import Callable, Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.tables import new_path, removed
from .common import BATCH_CHARS, agreeing, arrow_map, blank, code_points, mixed, row_key, semi, table, written
from .nearcopies import GRAM, THRESHOLD, Strings, class_id, similar
from .textform import canonical

#: The threshold as a fraction, and the strings among the located ones that a pair must share at least, whatever the sizes.
NUMER, DENOM, HITS = 3, 5, 2
#: Code points of a match that is counted; code points of a shard; distance of sampled locations; hits looked at in one go.
RUN, SHARD_CHARS, SAMPLE, HITS_AT_ONCE = 30, 8_000_000, 4, 4_000_000
#: Code points of training text that are streamed at once; what was found of their strings is kept for the next ones.
STREAM_CHARS = 500_000
#: Strings near the beginning of both orders that a pair must share, or all that it shares; postings looked at in one go.
FIRST, POSTINGS_AT_ONCE = 8, 1_000_000
#: Bits of the slots that one row of a table of counts has; at most, bits of slots of counts and of postings.
_PIECE_BITS, _COUNT_BITS, _SLOT_BITS = 22, 28, 25
#: Bits of the table that tells which strings a shard may have.
_TABLE_BITS = 24
_strip = re.compile(r"\s+").sub


def suffix_order(rank: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling from as many symbols as fit a number; only suffixes that are still equal are sorted again."""
    n, size = len(rank), int(rank.max(initial=0)) + 2
    width = max(1, int(62 / np.log2(size)))
    key = np.zeros(n, np.int64)
    for i in range(width):
        key *= size
        if i < n:
            key[: n - i] += rank[i:]
            key[: n - i] += 1
    order = np.argsort(key)
    key, slots = key[order], np.arange(n)
    of = np.empty(n, np.int64)
    while True:
        # the rank of a suffix is the first slot of those that are equal to it so far
        first = np.ones(len(slots), bool)
        first[1:] = key[1:] != key[:-1]
        start = slots[np.flatnonzero(first)]
        run = np.cumsum(first) - 1
        of[order[slots]] = start[run] if len(slots) else 0
        open_ = np.bincount(run)[run] > 1 if len(slots) else first
        slots = slots[open_]
        if not len(slots):
            return order
        at = order[slots]
        after = np.where(at + width < n, of[np.minimum(at + width, n - 1)] + 1, 0)
        key = of[at] * (n + 1) + after
        sub = np.argsort(key)
        order[slots], key = at[sub], key[sub]
        width *= 2


class Bits:
    """A bit vector with the number of ones before each place."""

    def __init__(self, bits: np.ndarray):
        n = len(bits) // 64 + 1
        padded = np.zeros(n * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words), dtype=np.int64)[:-1]].astype(np.uint32)

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1


class FullTextIndex:
    """FM-index of texts; each is followed by an end, and no match goes beyond it."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        codes, self.starts = code_points([x + "\0" for x in texts])
        n = self.n = len(codes)
        ends = np.zeros(n, bool)
        ends[self.starts[1:] - 1] = True
        present = np.zeros(0x110000, bool)
        present[codes[~ends]] = True
        self.symbols = np.flatnonzero(present).astype(np.int32)
        # ends come first and differ, so no comparison leaves a text; in the transform they are one symbol
        number = np.where(ends, 0, self._number[codes])
        del codes
        order = suffix_order(np.where(ends, np.cumsum(ends, dtype=np.int32) - 1, number + np.int32(len(texts) - 1)))
        transform = number[order - 1].astype(np.uint32)
        del number
        #: the first suffix of each symbol
        self.first = np.r_[0, np.cumsum(np.bincount(transform, minlength=len(self.symbols) + 1))]
        self.n_bits = max(1, int(len(self.symbols)).bit_length())
        self.levels, self.zeros = [], []
        rest = transform
        for shift in range(self.n_bits - 1, -1, -1):
            bit = (rest >> np.uint32(shift)) & np.uint32(1) == 1
            self.levels.append(Bits(bit))
            self.zeros.append(int(n - bit.sum()))
            rest = np.concatenate([rest[~bit], rest[bit]])
        #: where each symbol's run begins on the last level
        self.bottom = np.searchsorted(_turned(rest, self.n_bits), _turned(np.arange(len(self.symbols) + 1, dtype=np.uint32), self.n_bits))
        starts = np.zeros(n + 1, bool)
        starts[self.starts] = True
        known = (order % SAMPLE == 0) | starts[order]
        self.known, self.places = Bits(known), order[known].astype(np.int32)
        del order, rest, transform, known
        seen, sizes, piece = np.zeros(1 << _TABLE_BITS, bool), [np.zeros(0, np.int64)], 0
        while piece < len(texts):
            stop = max(piece + 1, min(piece + 10_000, int(np.searchsorted(self.starts, self.starts[piece] + BATCH_CHARS))))
            strings = Strings(texts[piece:stop], np.zeros(stop - piece, np.uint64), places=False)
            sizes.append(strings.size)
            seen[self._slot(strings.hash)] = True
            piece = stop
        self.sizes, self.seen = np.concatenate(sizes), np.packbits(seen, bitorder="little")

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_number", "text_of", "codes", "found")}

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64((1 << _TABLE_BITS) - 1)).astype(np.int64)

    def may_have(self, hashes: np.ndarray) -> np.ndarray:
        """Whether the shard may have the strings with these hashes; never false where it has."""
        slot = self._slot(hashes)
        return (self.seen[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1

    @functools.cached_property
    def _number(self) -> np.ndarray:
        out = np.full(0x110000, -1, np.int32)
        out[self.symbols] = np.arange(1, len(self.symbols) + 1)
        return out

    def _rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the interval that begins at these places begins after the symbol is put in front."""
        base = self.first[symbol] - self.bottom[symbol]
        for bits, zeros, shift in zip(self.levels, self.zeros, range(self.n_bits - 1, -1, -1), strict=True):
            ones = bits.ones(at)
            at = np.where(symbol >> shift & 1, zeros + ones, at - ones)
        return base + at

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals (low, high) of patterns of one length (code points, N x length), by backward search of all of them in step."""
        symbol = self._number[patterns]
        low, high = np.zeros(len(patterns), np.int64), np.zeros(len(patterns), np.int64)
        live = np.flatnonzero((symbol >= 0).all(axis=1))
        last = symbol[live, -1]
        low[live], high[live] = self.first[last], self.first[last + 1]
        for column in symbol.T[-2::-1]:
            low[live], high[live] = self._rank(column[live], low[live]), self._rank(column[live], high[live])
            live = live[low[live] < high[live]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of suffixes, by walking back to a sampled one."""
        rows, out, steps, todo = rows.copy(), np.zeros(len(rows), np.int64), 0, np.arange(len(rows))
        while len(todo):
            known = self.known[rows[todo]]
            done = todo[known]
            out[done] = self.places[self.known.ones(rows[done])] + steps
            todo = todo[~known]
            at, symbol = rows[todo], np.zeros(len(todo), np.int64)
            for bits, zeros in zip(self.levels, self.zeros, strict=True):
                bit, ones = bits[at], bits.ones(at)
                at = np.where(bit, zeros + ones, at - ones)
                symbol = symbol << 1 | bit
            rows[todo] = self.first[symbol] - self.bottom[symbol] + at
            steps += 1
        return out

    @functools.cached_property
    def found(self) -> Found:
        return Found(self)

    @functools.cached_property
    def text_of(self) -> np.ndarray:
        """The number of the text at each place."""
        return np.repeat(np.arange(len(self.texts), dtype=np.int32), np.diff(self.starts))

    @functools.cached_property
    def codes(self) -> np.ndarray:
        return code_points([x + "\0" for x in self.texts])[0]


def _turned(values: np.ndarray, n_bits: int) -> np.ndarray:
    """Values with their bits in reverse: the order of the last level of a wavelet matrix."""
    out = np.zeros_like(values)
    for i in range(n_bits):
        out |= ((values >> np.uint32(i)) & np.uint32(1)) << np.uint32(n_bits - 1 - i)
    return out


def classed(df: DataFrame) -> DataFrame:
    """(key, train, cls, flat) of (key, train, text): the class of equal forms; of equal texts at least one has its form without white space."""

    def kernel(batch: pa.RecordBatch) -> dict:
        forms = [canonical(x) for x in batch.column("text").to_pylist()]
        cls = np.array([class_id("cpt_chunk", x) for x in forms], np.int64)
        # copies in a batch carry no text of their own: the first stands for them
        _, first = np.unique(mixed(cls.view(np.uint64)) + np.asarray(batch.column("train")).astype(np.uint64), return_index=True)
        flat: list[str | None] = [None] * len(forms)
        for i in first:
            flat[i] = _strip("", forms[i])
        return {"key": batch.column("key"), "train": batch.column("train"), "cls": cls, "flat": pa.array(flat, pa.string())}

    return arrow_map(df.select("key", "train", "text"), "text", "key string, train boolean, cls long, flat string", kernel)


class Found:
    """What a task has found of strings in a shard so far: a string of several texts is searched and located once. No larger than the shard."""

    def __init__(self, index: FullTextIndex):
        self.index = index
        self.hash = np.zeros(0, np.uint64)
        #: by string: its number of places, its first suffix, and where its postings begin (-1: not located) and how many there are
        self.count, self.low, self.begin, self.n = (np.zeros(0, np.int64) for _ in range(4))
        #: of a string's places in a held-out text the first one stands for all
        self.text, self.place = np.zeros(0, np.int32), np.zeros(0, np.int32)

    def slots(self, s: Strings, of: np.ndarray) -> np.ndarray:
        """The slots of the strings with these numbers, after those that are new have been searched."""
        order = np.argsort(s.hash[of])
        hashes = s.hash[of][order]
        new = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)])
        at = np.searchsorted(self.hash, hashes[new])
        fresh = np.ones(len(new), bool)
        fresh[at < len(self.hash)] = self.hash[at[at < len(self.hash)]] != hashes[new[at < len(self.hash)]]
        if fresh.any():
            sample = of[order[new[fresh]]]
            low, high = self.index.search(s.codes[s.at[sample][:, None] + np.arange(GRAM)])
            where = at[fresh]
            self.hash = np.insert(self.hash, where, s.hash[sample])
            self.low, self.count = np.insert(self.low, where, low), np.insert(self.count, where, high - low)
            self.begin, self.n = np.insert(self.begin, where, -1), np.insert(self.n, where, 0)
        out = np.empty(len(of), np.int64)
        out[order] = np.repeat(np.searchsorted(self.hash, hashes[new]), np.diff(np.r_[new, len(hashes)]))
        return out

    def locate(self, slots: np.ndarray) -> None:
        """Makes sure that the strings of these slots have their postings."""
        slots = np.unique(slots[self.begin[slots] < 0])
        width = self.count[slots]
        which = np.repeat(np.arange(len(slots)), width)
        at = self.index.locate(self.low[slots][which] + np.arange(len(which)) - np.repeat(np.cumsum(width) - width, width))
        at += which * self.index.n
        at.sort()
        which, at = at // self.index.n, at % self.index.n
        text = self.index.text_of[at]
        new = np.ones(len(at), bool)
        new[1:] = (text[1:] != text[:-1]) | (which[1:] != which[:-1])
        n = np.bincount(which[new], minlength=len(slots))
        self.n[slots], self.begin[slots] = n, len(self.text) + np.cumsum(n) - n
        self.text, self.place = np.r_[self.text, text[new]], np.r_[self.place, at[new].astype(np.int32)]


def _looked_at(size: np.ndarray) -> np.ndarray:
    """How many of a text's strings are located, those with no place included: all but as many as leave HITS of the shared ones."""
    shared = -(-NUMER * size // DENOM)
    return size - shared + np.minimum(HITS, shared)


def _hits(s: Strings, index: FullTextIndex):
    """Blocks (text, held-out text, place in the texts, place in the index) of located strings, a row for each string and held-out text; all rows of a text are in one block."""
    maybe, found = np.flatnonzero(index.may_have(s.hash)), index.found
    slot, count = np.full(len(s.hash), -1), np.zeros(len(s.hash), np.int64)
    slot[maybe] = found.slots(s, maybe)
    count[maybe] = found.count[slot[maybe]]
    # the strings with the fewest places first: so many of a text's strings that HITS of them are shared if the measure is met
    rare = np.argsort((s.owner << 32) | count)
    shared = -(-NUMER * s.size // DENOM)
    first = rare[s.nth < _looked_at(s.size)[s.owner]]
    first = first[count[first] > 0]
    enough = np.bincount(s.owner[first], minlength=len(s.size)) >= np.minimum(HITS, np.maximum(shared, 1))
    first = np.sort(first[enough[s.owner[first]]])
    if not len(first):
        return
    found.locate(slot[first])
    begin, n = found.begin[slot[first]], found.n[slot[first]]
    per_text = np.cumsum(np.bincount(s.owner[first], weights=n, minlength=len(s.size)))
    text = 0
    while text < len(s.size):
        done = per_text[text - 1] if text else 0
        stop = max(text + 1, int(np.searchsorted(per_text, done + HITS_AT_ONCE, side="right")))
        a, b = np.searchsorted(s.owner[first], [text, stop])
        m = n[a:b]
        i = np.repeat(np.arange(a, b), m)
        hit = np.arange(len(i)) - np.repeat(np.cumsum(m) - m, m) + begin[i]
        held = found.text[hit].astype(np.int64)
        owner = s.owner[first[i]]
        x, y = s.size[owner], index.sizes[held]
        ok = np.minimum(x, y) * DENOM >= np.maximum(x, y) * NUMER
        yield owner[ok], held[ok], s.at[first[i[ok]]], found.place[hit[ok]].astype(np.int64)
        text = stop


def _spans(s: Strings, index: FullTextIndex, pair: np.ndarray, at: np.ndarray, place: np.ndarray, text: np.ndarray, held: np.ndarray, n_pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per pair the merged spans of maximal matches of RUN code points or more around the hits, and the code points in them."""
    # hits side by side in one match: the first of them stands for all
    diagonal = at - place
    order = np.lexsort((at, diagonal, pair))
    pair, at, place, text, held, diagonal = (x[order] for x in (pair, at, place, text, held, diagonal))
    first = np.ones(len(at), bool)
    first[1:] = (pair[1:] != pair[:-1]) | (diagonal[1:] != diagonal[:-1]) | (at[1:] - at[:-1] > GRAM)
    pair, at, place, text, held = (x[first] for x in (pair, at, place, text, held))
    a, b = at - s.ends[text], place - index.starts[held]
    left = agreeing(s.codes, index.codes, at - 1, place - 1, np.minimum(a, b), -1)
    right = agreeing(s.codes, index.codes, at, place, np.minimum(s.ends[text + 1] - at, index.starts[held + 1] - 1 - place), 1)
    long = left + right >= RUN
    spans = np.unique(np.stack([pair[long], (at - left)[long], (at + right)[long]], axis=1), axis=0)
    pair, low, high = spans.T
    # spans of a pair in order: one that begins after all before it have ended opens a new one
    base = pair * (len(s.codes) + 1)
    reach = np.r_[0, np.maximum.accumulate(base + high)[:-1]] - base
    counts = np.bincount(pair[low > reach] if len(pair) else pair, minlength=n_pairs)
    if len(pair):
        opening = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        counts += np.bincount(pair[opening[low[opening] <= np.maximum(reach[opening], 0)]], minlength=n_pairs)
    return counts, np.bincount(pair, weights=np.maximum(0, high - np.maximum(reach, low)), minlength=n_pairs).astype(np.int64)


def streamed(flat: list[str], index: FullTextIndex) -> dict[str, np.ndarray]:
    """text, held (numbers), similarity, n_matches and matched of the pairs that meet the measure."""
    # a string's place doesn't depend on the texts beside it
    s = Strings(flat, np.zeros(len(flat), np.uint64), first=True)
    out = {c: [np.zeros(0, t)] for c, t in (("text", np.int64), ("held", np.int64), ("similarity", np.float64), ("n_matches", np.int64), ("matched", np.int64))}
    for text, held, at, place in _hits(s, index):
        pair = text * len(index.texts) + held
        order = np.argsort(pair)
        pair = pair[order]
        begin = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]][: len(pair)])
        n = np.diff(np.r_[begin, len(pair)])
        # strings shared in all, less those that were not looked at
        x, y = s.size[text[order[begin]]], index.sizes[held[order[begin]]]
        enough = n >= -(-NUMER * (x + y) // (NUMER + DENOM)) - (x - _looked_at(x))
        begin, n = begin[enough], n[enough]
        hit = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        text, held, at, place = (x[order[hit]] for x in (text, held, at, place))
        begin = np.cumsum(n) - n
        found = similar([flat[i] for i in text[begin]], [index.texts[i] for i in held[begin]], THRESHOLD)
        keep = found > 0
        begin, n = begin[keep], n[keep]
        hit = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        counts, matched = _spans(s, index, np.repeat(np.arange(len(n)), n), at[hit], place[hit], text[hit], held[hit], len(n))
        for c, x in (("text", text[begin]), ("held", held[begin]), ("similarity", found[keep]), ("n_matches", counts), ("matched", matched)):
            out[c].append(x)
    return {c: np.concatenate(x) for c, x in out.items()}


def _limit(size: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """The largest size of a text with which a text of this size may share its nth string as one of the first FIRST, if the two meet the measure."""
    # of the strings shared, NUMER / (NUMER + DENOM) of both sizes at least, all but FIRST - 1 stand at this one or after it
    return np.minimum((NUMER + DENOM) * (size - nth + FIRST - 1) // NUMER - size, DENOM * size // NUMER)


@functools.lru_cache(maxsize=8)
def _mapped(name: str, kind: str) -> np.ndarray:
    """A file that all machines have, mapped and not read."""
    return np.memmap(name if "/" in name else SparkFiles.get(name), np.dtype(kind), "r")


def _sent(spark: SparkSession, name: str, write: Callable[[BinaryIO], None]) -> str:
    """The path of a file in the shared folder; where that is no path of a mounted file system, the name of a file that is sent to every machine. It is deleted when the application ends."""
    path = new_path(spark, name)
    mounted = re.fullmatch(r"(?:file:(?://)?)?(/.*)", path)
    local = mounted[1] if mounted else f"{SparkFiles.getRootDirectory()}/{path.rsplit('/', 1)[1]}"
    with open(local, "wb") as f:
        write(f)
    if mounted:
        return local
    spark.sparkContext.addFile(local)
    return local.rsplit("/", 1)[1]


def _pieces(df: DataFrame, name: str) -> Iterator:
    """The rows of a frame with one row per part, in order of the parts and one at a time; they are written before, and deleted afterwards."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    for (part,) in sorted(tuple(r) for r in table.select("part").collect()):
        yield table.where(F.col("part") == part).first()
    removed(spark, path)


def _by_part(part: np.ndarray, **columns: np.ndarray) -> dict:
    """Rows of bytes, one for each part of columns that are sorted by it."""
    cut = np.flatnonzero(np.r_[True, part[1:] != part[:-1]][: len(part)])
    ends = np.append(cut, len(part))[1:]
    return {"part": part[cut].astype(np.int32)} | {k: [x[a:b].tobytes() for a, b in zip(cut, ends, strict=True)] for k, x in columns.items()}


class FirstStrings:
    """The order of all strings, and the first strings of the held-out texts by slot of their hashes: mapped files.

    A posting has the number of a text (32 bits), its size and the largest size of a partner (16 bits each; more is
    no limit). Texts or strings that fall together can only add partners.
    """

    def __init__(self, chars: int):
        self.count_bits = min(_COUNT_BITS, max(16, (chars // 2).bit_length()))
        self.slot_bits = min(_SLOT_BITS, max(16, (chars // 4).bit_length()))
        self.part_bits = min(self.slot_bits, (chars // 4_000_000).bit_length())
        self.counts = self.starts = self.postings = self.kind = ""

    def ranked(self, s: Strings) -> tuple[np.ndarray, np.ndarray]:
        """The strings by text in the common order, and for each how often it is found: 0 if no held-out text has it."""
        often = _mapped(self.counts, "u1")[(s.hash & np.uint64((1 << self.count_bits) - 1)).astype(np.int64)]
        # strings of a text stand by hash; that decides between equal ones
        order = np.argsort(s.owner << 8 | often, kind="stable")
        return order, often[order]

    def slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes & np.uint64((1 << self.slot_bits) - 1)).astype(np.int64)

    def build(self, held: DataFrame) -> FirstStrings:
        """Counts of the strings of the held-out (cls, flat), then the postings in the order that they give."""
        spark = held.sparkSession
        count_bits, piece_bits, part_shift = self.count_bits, min(_PIECE_BITS, self.count_bits), self.slot_bits - self.part_bits

        def counted(batch: pa.RecordBatch) -> dict:
            s = Strings(batch.column("flat").to_pylist(), np.zeros(batch.num_rows, np.uint64), places=False)
            slot, n = np.unique((s.hash & np.uint64((1 << count_bits) - 1)).astype(np.int64), return_counts=True)
            return _by_part(slot >> piece_bits, slots=slot.astype(np.uint32), n=n.astype(np.uint32))

        def codes(part: pa.Table) -> pa.Table:
            total = np.zeros(1 << piece_bits, np.int64)
            for slots, n in zip(part.column("slots").to_pylist(), part.column("n").to_pylist(), strict=True):
                total[np.frombuffer(slots, np.uint32) & np.uint32((1 << piece_bits) - 1)] += np.frombuffer(n, np.uint32)
            code = np.where(total > 0, np.minimum(255, 1 + 8 * np.log2(np.maximum(total, 1))), 0).astype(np.uint8)
            return pa.table({"part": part.column("part")[:1], "codes": pa.array([code.tobytes()])})

        pieces = arrow_map(held, "flat", "part int, slots binary, n binary", counted).groupBy("part").applyInArrow(codes, "part int, codes binary")

        def write_counts(f: BinaryIO) -> None:
            f.truncate(1 << count_bits)
            for row in _pieces(pieces, "codes"):
                f.seek(row["part"] << piece_bits)
                f.write(row["codes"])

        self.counts = _sent(spark, "counts", write_counts)

        def posted(batch: pa.RecordBatch, index=self) -> dict:
            s = Strings(batch.column("flat").to_pylist(), np.zeros(batch.num_rows, np.uint64), places=False)
            order, _ = index.ranked(s)
            size = s.size[s.owner]
            limit = _limit(size, s.nth)
            use = np.flatnonzero(DENOM * limit >= NUMER * size)
            slot = index.slot(s.hash[order[use]])
            by_slot = np.argsort(slot)
            use, slot = use[by_slot], slot[by_slot]
            text = np.asarray(batch.column("cls")).view(np.uint64)[s.owner[use]] & np.uint64(0xFFFFFFFF)
            packed = text | np.minimum(size[use], 0xFFFF).astype(np.uint64) << np.uint64(32) | np.minimum(limit[use], 0xFFFF).astype(np.uint64) << np.uint64(48)
            return _by_part(slot >> part_shift, slots=slot.astype(np.uint32), postings=packed)

        def joined(part: pa.Table) -> pa.Table:
            slot, posting = (np.frombuffer(b"".join(part.column(c).to_pylist()), t) for c, t in (("slots", np.uint32), ("postings", np.uint64)))
            slot = slot & np.uint32((1 << part_shift) - 1)
            n = np.bincount(slot, minlength=1 << part_shift).astype(np.uint32)
            return pa.table({"part": part.column("part")[:1], "n": pa.array([n.tobytes()]), "postings": pa.array([posting[np.argsort(slot, kind="stable")].tobytes()])})

        lists = arrow_map(held, "flat", "part int, slots binary, postings binary", posted).groupBy("part").applyInArrow(joined, "part int, n binary, postings binary")
        n = np.zeros(1 << self.slot_bits, np.uint32)

        def write_postings(f: BinaryIO) -> None:
            for row in _pieces(lists, "lists"):
                n[row["part"] << part_shift : (row["part"] + 1) << part_shift] = np.frombuffer(row["n"], np.uint32)
                f.write(row["postings"])
            f.write(bytes(8))  # an empty file can't be mapped

        self.postings = _sent(spark, "postings", write_postings)
        starts = np.r_[0, np.cumsum(n, dtype=np.int64)]
        self.kind = "u4" if starts[-1] < 1 << 32 else "i8"
        self.starts = _sent(spark, "starts", lambda f: starts.astype(self.kind).tofile(f))
        return self

    def partners(self, s: Strings) -> tuple[np.ndarray, np.ndarray]:
        """(text, number of a held-out text) of all pairs that may meet the measure."""
        order, often = self.ranked(s)
        size = s.size[s.owner]
        limit = _limit(size, s.nth)
        use = np.flatnonzero((often > 0) & (DENOM * limit >= NUMER * size))
        slot, starts, postings = self.slot(s.hash[order[use]]), _mapped(self.starts, self.kind), _mapped(self.postings, "u8")
        begin = starts[slot].astype(np.int64)
        n = starts[slot + 1] - begin
        use, begin, n = use[n > 0], begin[n > 0], n[n > 0]
        owner, most, least = s.owner[use], limit[use].astype(np.int32), np.minimum(size[use], 0xFFFF).astype(np.int32)
        total, a, keys = np.cumsum(n), 0, [np.zeros(0, np.int64)]
        while a < len(use):
            b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + POSTINGS_AT_ONCE, side="right")))
            m = n[a:b]
            found = postings[np.arange(m.sum()) + np.repeat(begin[a:b] - (np.cumsum(m) - m), m)]
            ok = np.flatnonzero(((found >> np.uint64(32)).astype(np.int32) & 0xFFFF <= np.repeat(most[a:b], m)) & ((found >> np.uint64(48)).astype(np.int32) >= np.repeat(least[a:b], m)))
            keys.append(np.repeat(owner[a:b], m)[ok] << 32 | (found[ok] & np.uint64(0xFFFFFFFF)).astype(np.int64))
            a = b
        key, shared = np.unique(np.concatenate(keys), return_counts=True)
        text = key >> 32
        enough = shared >= np.minimum(FIRST, -(-NUMER * s.size // DENOM))[text]
        return text[enough], key[enough] & 0xFFFFFFFF


def routed(train: DataFrame, first: FirstStrings, shards: int) -> DataFrame:
    """(shard, cls, flat) of the training (cls, flat): a row for each shard that may hold a partner of the text."""

    def kernel(batch: pa.RecordBatch) -> dict:
        flat = batch.column("flat").to_pylist()
        s = Strings(flat, np.zeros(len(flat), np.uint64), places=False)
        text, held = first.partners(s)
        # texts without strings can only be equal
        short = np.flatnonzero(s.size == 0)
        own = np.asarray(batch.column("cls")).view(np.uint64)[short] & np.uint64(0xFFFFFFFF)
        pairs = np.unique(np.r_[text, short] * shards + np.r_[held, own.astype(np.int64)] % shards)
        at = pa.array(pairs // shards)
        return {"shard": (pairs % shards).astype(np.int32), "cls": batch.column("cls").take(at), "flat": batch.column("flat").take(at)}

    return arrow_map(train, "flat", "shard int, cls long, flat string", kernel, STREAM_CHARS)


def shards_of(chars: int) -> int:
    return max(1, -(-chars // SHARD_CHARS))


def index_shards(held: DataFrame, shards: int) -> DataFrame:
    """(shard, classes, index) of the held-out (cls, flat): the packed index of each shard, and the classes of its texts."""

    def build(part: pa.Table) -> pa.Table:
        cls, at = np.unique(part.column("cls").to_numpy(), return_index=True)
        flat = part.column("flat").take(pa.array(at)).to_pylist()
        return pa.table({"shard": part.column("shard")[:1], "classes": pa.array([cls.tobytes()]), "index": pa.array([zstandard.compress(pickle.dumps(FullTextIndex(flat)))])})

    return held.withColumn("shard", F.pmod(F.col("cls").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(build, "shard int, classes binary, index binary")


def overlaps(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Members (key, train, cls) and links (cls_a, cls_b, similarity, n_matches, matched) of rows (key, train, text).

    A link joins the class of a training text (cls_a) and that of a held-out text (cls_b) that is equal or meets the
    measure. n_matches and matched count the merged maximal matches of RUN or more in the training text around its rarer
    strings, and the code points in them; a near copy need not have any. Equal texts too short for a string
    of five are linked as one match. Null and blank texts are left out by the caller; rows without a key are left out; a null train is no
    training row; repeated rows and long texts pass; an empty side gives no links.
    """
    df = df.select("key", F.coalesce("train", F.lit(False)).alias("train"), "text").where("key is not null")
    rows = written(classed(df), "classed")
    full = rows.where("flat is not null")
    # one row stands for its class on the held-out side
    chosen = written(full.where("not train").groupBy("cls").agg(F.min("key").alias("key")), "chosen")
    held = written(semi(full.where("not train"), chosen, ["cls", "key"]).select("cls", "flat"), "held")
    chars = held.agg(F.coalesce(F.sum(F.length("flat") + 1), F.lit(0)).alias("n")).first()["n"]
    n_shards = shards_of(chars)
    shards = written(index_shards(held, n_shards), "shards")
    train = routed(full.where("train").select("cls", "flat"), FirstStrings(chars).build(held), n_shards)
    # rows of a shard are side by side, so that the others can be skipped
    train = written(train if n_shards == 1 else train.repartition("shard", F.pmod("cls", F.lit(8))).sortWithinPartitions("shard"), "routed")
    schema = "cls_a long, cls_b long, similarity double, n_matches long, matched long"
    spark, links = df.sparkSession, []
    for (number,) in sorted(tuple(r) for r in shards.select("shard").collect()):
        row = shards.where(F.col("shard") == number).first()
        index = spark.sparkContext.broadcast((np.frombuffer(row["classes"], np.int64), row["index"]))

        def kernel(batch: pa.RecordBatch, index=index) -> dict | None:
            classes, packed = index.value
            shard = _unpacked(packed)
            cls, flat = np.asarray(batch.column("cls")), batch.column("flat").to_pylist()
            found = streamed(flat, shard)
            size = np.array([len(x) for x in flat])
            short = np.flatnonzero((size < GRAM) & np.isin(cls, classes))
            return {
                "cls_a": np.r_[cls[found["text"]], cls[short]], "cls_b": np.r_[classes[found["held"]], cls[short]], "similarity": np.r_[found["similarity"], np.ones(len(short))],
                "n_matches": np.r_[found["n_matches"], np.ones(len(short), np.int64)], "matched": np.r_[found["matched"], size[short]],
            }

        part = written(arrow_map(train.where(F.col("shard") == number).select("cls", "flat"), "flat", schema, kernel, STREAM_CHARS), "links")
        index.unpersist()
        links.append(part)
    found = functools.reduce(DataFrame.union, links) if links else spark.createDataFrame([], schema)
    return rows.select("key", "train", "cls"), found.dropDuplicates(["cls_a", "cls_b"])


@functools.lru_cache(maxsize=1)
def _unpacked(packed: bytes) -> FullTextIndex:
    return pickle.loads(zstandard.decompress(packed))


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "cpt_chunk").where(~blank(F.col("text")))
    return t.select(row_key("row_id").alias("key"), F.coalesce(F.col("split") == "train", F.lit(False)).alias("train"), "text")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    members, links = overlaps(_chunks(spark, sf_dir))
    a = members.where("train").select(F.col("key").cast("long").alias("a"), F.col("cls").alias("cls_a"))
    b = members.where("not train").select(F.col("key").cast("long").alias("b"), F.col("cls").alias("cls_b"))
    rows = links.select("cls_a", "cls_b").join(a, "cls_a").join(b, "cls_b")
    return rows.select(F.least("a", "b").alias("row_a"), F.greatest("a", "b").alias("row_b"))


def p3_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per split and source_file of held-out chunks: chunks, and those with an equal or a near copy in training."""
    members, links = overlaps(_chunks(spark, sf_dir))
    best = links.groupBy(F.col("cls_b").alias("cls")).agg(F.max("similarity").alias("best"), F.count("*").alias("n"))
    held = members.where("not train").join(best, "cls", "left").select(F.col("key").cast("long").alias("row_id"), "best", "n")
    rows = table(spark, sf_dir, "cpt_chunk").where("not (split <=> 'train')").select("row_id", "split", "source_file").join(held, "row_id", "left")
    return rows.groupBy("split", "source_file").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("best") == 1).alias("n_equal"), F.count_if(F.col("best") < 1).alias("n_near"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_training_texts")
    )
