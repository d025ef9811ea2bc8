"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets, and its components.

A document's set holds its distinct 5-word shingles (a shorter text is one shingle; a text with no
word has none and links with nothing).  Two documents link when their sets' Jaccard similarity is
0.8 or more.  Equal sets form a class that takes part once.

* Light sets, of a size up to a boundary, enumerate their subsets of every size that a partner
  could share.  Sets that meet in a subset of c shingles share c at least, so no further check is
  needed, and the smallest set of such a list reaches all that any of its members reaches there.
* Heavy sets, and the light ones large enough to be their partners, enter the inverted lists of
  their rarest shingles: with all but ceil(0.8 n) + 1 of n shingles in a common order, similar
  sets meet in a list.  The order is by a count over all documents, so common passages come last.

The boundary is where enumerating starts to cost more than scanning, by the sizes found and the
lengths of the lists that sets of these sizes would enter.

A list never emits its pairs.  It is worked off in rounds:

* The member whose lists have most members in all is the list's pivot, and all others are compared
  with it: of near copies, that is the one with the fewest words of its own.
  Links found are contracted to components, and lists inside one component are done.
* A list of ``SHORT`` members or fewer, or of ``WIDE`` or fewer that still spans components, is worked
  off at once: its members of different components are held against each other, by place, size and
  parity, and what may be similar is compared.
* In a longer list that still spans components, let D(x) be the shingles that are in just one of x
  and the pivot.  If x isn't similar to the pivot and D(x), D(y) are disjoint, x and y aren't
  similar either: they differ in even more shingles.  So the members enter new lists, of the rarest
  shingles of D(x) for this pivot, again as many as a partner could leave out, and those lists are
  worked off like the first.  Copies of one text that differ in words of their own don't meet again.

So no link between different components is missed, every round takes about as many comparisons as
there are list entries, and a group of near copies costs about one comparison a member.  Lists and
pivots with very many members are split into parts.

Pairs that meet are compared by place and size, and by parity, before their sets are: each set keeps
the parity of the number of its hashes in each of some buckets, and where two sets' parities differ,
so do the sets.  Pairs with too many differences are out for certain.

A shingle is a 64-bit hash; a class is named by the first row that has its set, sets being told
apart by 128 bits (of sets with one shingle, which are as many as short texts, the words themselves
are hashed again).  Null texts are empty, repeated rows and copies get the same component, an empty
table gives an empty result, and only doc_id and text are read.  A text's length has no bound but
the memory that its own set takes, twice.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _text as t
from ._graph import components, joined
from ._session import cut, share, table, tidy

SHINGLE = 5
#: Similarity 0.8 as a ratio.  Sets of a and b shingles link when they differ in (a + b) / 9 at most.
NUM, DEN = 4, 5
#: Counters of the shingle sketch (4 bytes each: its size doesn't depend on the input).
SKETCH_BITS, SKETCH_CHUNKS = 20, 16
#: Largest size for which enumerating is considered.
LIGHT_MOST = 24
#: Members of a list, or of a pivot, from which it is split.
PART = 4096
#: Members up to which a list is compared wholly at once, and after its members have met the pivot.
#: Holding one entry against half of 512 others costs about what its differences would as list rows.
SHORT, WIDE = 16, 512
#: Bits of the filter that tells which documents' sets are needed: 16 for each of them, within these.
FILTER_BITS = 1 << 16, 1 << 28
#: Parity bits of a set: a power of two, at least twice its size within these bounds.
PARITY_BITS = 256, 1 << 16
_FOLDED = [f"f{k}" for k in range(PARITY_BITS[0] // 64)]


def sets(block: t.Block) -> tuple[list[np.ndarray], t.Words]:
    """The sorted distinct shingle hashes of each document of a block, and the words."""
    words = t.words(block)
    hashes = t.span_hash(block.data, words.start, words.end, lower=True)
    grams = t.mix(t.ngrams(hashes, SHINGLE))
    out = []
    for first, stop in zip(words.at[:-1].tolist(), words.at[1:].tolist(), strict=True):
        if stop - first >= SHINGLE:
            own = np.sort(grams[first : stop - SHINGLE + 1])
            fresh = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=fresh[1:])
            out.append(own[fresh])
        elif stop > first:
            out.append(t.mix(t.ngrams(hashes[first:stop], stop - first) + t.U64(stop - first)))
        else:
            out.append(np.zeros(0, t.U64))
    return out, words


def _names(found: list[np.ndarray], words: t.Words, block: t.Block) -> np.ndarray:
    """Two 64-bit numbers for each document, equal for equal sets."""
    out = np.zeros((len(found), 2), t.U64)
    flat = np.concatenate(found) if found else np.zeros(0, t.U64)
    size = np.array([len(x) for x in found], np.int64)
    ends = np.cumsum(size)
    with np.errstate(over="ignore"):
        for k, salt in enumerate((0xA5A5A5A5A5A5A5A5, 0x3C6EF372FE94F82B)):
            total = np.concatenate([np.zeros(1, t.U64), np.cumsum(t.mix(flat ^ t.U64(salt)), dtype=t.U64)])
            out[:, k] = t.mix(total[ends] - total[ends - size] + size.astype(t.U64))
    for i in np.flatnonzero(size == 1).tolist():
        a, b = words.at[i], min(words.at[i + 1], words.at[i] + SHINGLE)
        low = t.lower(block.data[words.start[a] : words.end[b - 1]]).tobytes().split()
        out[i, 1] = int.from_bytes(hashlib.blake2b(b" ".join(low), digest_size=8).digest(), "little")
    return out


def parity(own: np.ndarray) -> np.ndarray:
    """Bit i tells whether an odd number of the hashes have i as their last bits."""
    bits = PARITY_BITS[0]
    while bits < min(2 * len(own), PARITY_BITS[1]):
        bits *= 2
    return np.packbits(np.bincount((own & t.U64(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little")


def _differ(a: bytes, b: bytes) -> int:
    """Shingles that are in one of two sets only, at least."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


@t.released
def _may_link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = np.array(batch.column("n_a"), np.int64) + np.array(batch.column("n_b"), np.int64)
        far = [_differ(x.as_buffer(), y.as_buffer()) for x, y in zip(batch.column("parity_a"), batch.column("parity_b"), strict=True)]
        keep = 9 * np.array(far, np.int64) <= sizes
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in ("a", "b", "salt")], ["a", "b", "salt"]).filter(pa.array(keep, pa.bool_()))


_SIGNED = "doc_id long, row long, c1 long, c2 long, n long, f0 long, f1 long, f2 long, f3 long, parity binary, small binary, chunk int, counts binary"


@t.released
def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each document, then the task's part of the sketch."""
    names = [x.split()[0] for x in _SIGNED.split(", ")]
    kinds = [{"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[x.split()[1]] for x in _SIGNED.split(", ")]
    count = np.zeros(1 << SKETCH_BITS, np.int64)
    row = TaskContext.get().partitionId() << 33
    for batch in batches:
        for block in t.blocks(batch.column("text")):
            found, words = sets(block)
            hashes = np.concatenate(found)
            count += np.bincount((hashes >> t.U64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(count))
            n = len(found)
            odd = [parity(x) for x in found]
            folded = np.array([np.bitwise_xor.reduce(x.reshape(-1, PARITY_BITS[0] // 8)) for x in odd]).view(np.int64)
            small = [x.tobytes() if 0 < len(x) <= 2 * LIGHT_MOST else None for x in found]
            own = [batch.column("doc_id").slice(block.first, n), np.arange(row, row + n), *_names(found, words, block).view(np.int64).T, [len(x) for x in found], *folded.T, [x.tobytes() for x in odd], small]
            columns = [x if isinstance(x, pa.Array) else pa.array(np.ascontiguousarray(x) if isinstance(x, np.ndarray) else x, kind) for x, kind in zip(own, kinds, strict=False)]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names)
            row += n
    parts = count.astype("<u4").reshape(SKETCH_CHUNKS, -1)
    n = len(parts)
    last = {"chunk": pa.array(range(n), pa.int32()), "counts": pa.array([zlib.compress(x.tobytes(), 1) for x in parts], pa.binary())}
    yield pa.RecordBatch.from_arrays([last.get(name, pa.nulls(n, kind)) for name, kind in zip(names, kinds, strict=True)], names)


def _sum_counts(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(x), "<u4").astype(np.int64) for x in rows["counts"])
    return pd.DataFrame({"chunk": [key[0]], "counts": [zlib.compress(np.minimum(total, 2**32 - 1).astype("<u4").tobytes(), 1)]})


def _sketch(signed: DataFrame) -> np.ndarray:
    """Documents by shingle counter, summed over all tasks in two steps."""
    schema = "chunk int, counts binary"
    parts = signed.filter("chunk is not null").select("chunk", "counts", (F.spark_partition_id() % 64).alias("lane"))
    parts = parts.groupBy("chunk", "lane").applyInPandas(_sum_counts, schema).groupBy("chunk").applyInPandas(_sum_counts, schema)
    return np.concatenate([np.frombuffer(zlib.decompress(x["counts"]), "<u4") for x in sorted(parts.collect(), key=lambda x: x["chunk"])] or [np.zeros(1 << SKETCH_BITS, "<u4")])


def _needed(n: int) -> int:
    """Least overlap of a set of n with any partner."""
    return -(-NUM * n // DEN)


def _often(count: np.ndarray, own: np.ndarray) -> np.ndarray:
    return count[(own >> t.U64(64 - SKETCH_BITS)).astype(np.int64)].astype(np.int64)


def _lengths(sketch):
    """For each small set its size and the total length of the lists that it would enter."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = sketch.value
        chance = int(count.mean())  # what a counter holds of other shingles
        for batch in batches:
            size, length = [], []
            for x in batch.column("small"):
                own = np.frombuffer(x.as_buffer(), t.U64)
                size.append(len(own))
                length.append(int(np.sort(np.maximum(_often(count, own) - chance, 1))[: len(own) - _needed(len(own)) + 1].sum()))
            yield pa.RecordBatch.from_arrays([pa.array(size, pa.int64()), pa.array(length, pa.int64())], ["n", "length"])

    return t.released(rows)


def boundary(lengths: dict[int, tuple[int, int]]) -> int:
    """The size up to which sets are light, from the number of sets of each small size and the
    total length of the lists that they would enter: a subset costs a row, a list entry one and
    a look at the list's members."""
    subsets = lambda n: sum(comb(n, r) for r in range(n - _needed(n) + 1))

    def cost(x: int) -> int:
        return sum((k * subsets(n) if n <= x else 0) + (k * (n - _needed(n) + 1) + long if DEN * n >= NUM * (x + 1) else 0) for n, (k, long) in lengths.items())

    return min(range(LIGHT_MOST + 1), key=lambda x: (cost(x), x))


def _subset_keys(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all subsets that a partner may share, and their sizes."""
    n = len(own)
    with np.errstate(over="ignore"):
        values = t.mix(own)
        total = values.sum(dtype=t.U64)
        keys, sizes = [], []
        for left_out in range(n - _needed(n) + 1):
            gone = np.array(list(combinations(range(n), left_out)), np.int64).reshape(comb(n, left_out), left_out)
            keys.append(t.mix(total - values[gone].sum(axis=1, dtype=t.U64) + t.U64((n - left_out) * 0x9E3779B97F4A7C15 % 2**64)))
            sizes.append(np.full(len(gone), n - left_out))
    return np.concatenate(keys), np.concatenate(sizes)


def _list_rows(sketch, light: int):
    """Rows (key, part, c1, c2, n, pos, sub): sub is a subset's size, or 0 in an inverted list."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = sketch.value
        common = PART + 4 * int(count.mean())
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for block in t.blocks(batch.column("text")):
                out = []
                found, words = sets(block)
                for own, me in zip(found, _names(found, words, block).view(np.int64).tolist(), strict=True):
                    n, me = len(own), tuple(me)
                    if not n or me in seen:
                        continue
                    if len(seen) >= 100_000:  # copies that come again are harmless
                        seen.clear()
                    seen.add(me)
                    if n <= light:
                        keys, sub = _subset_keys(own)
                        out.append((keys, np.full(len(keys), -1), *me, n, np.zeros(len(keys), np.int64), sub))
                    if DEN * n >= NUM * (light + 1):
                        often = _often(count, own)
                        first = np.lexsort((own, often))[: n - _needed(n) + 1]
                        parts = -(-often[first] // PART)
                        part = np.where(often[first] > common, me[0] % np.maximum(parts, 1), -1)
                        out.append((own[first], part, *me, n, np.arange(len(first)), np.zeros(len(first), np.int64)))
                if out:
                    long = [len(x[0]) for x in out]
                    flat = [np.concatenate([x[0] for x in out]).view(np.int64), np.concatenate([x[1] for x in out]), *(np.repeat(np.array([x[k] for x in out], np.int64), long) for k in (2, 3, 4)), np.concatenate([x[5] for x in out]), np.concatenate([x[6] for x in out])]
                    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(flat, kinds, strict=True)], ["key", "part", "c1", "c2", "n", "pos", "sub"])

    return t.released(rows)


def _own_sets(bits):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = bits.value
        for batch in batches:
            ids = np.array(batch.column("slot"), np.int64) & (8 * len(wanted) - 1)
            batch = batch.filter(pa.array((wanted[ids >> 3] >> (ids & 7)) & 1 == 1))
            for block in t.blocks(batch.column("text")):
                found, words = sets(block)
                c1, c2 = np.ascontiguousarray(_names(found, words, block).view(np.int64).T)
                yield pa.RecordBatch.from_arrays([pa.array(c1), pa.array(c2), pa.array([x.tobytes() for x in found], pa.binary())], ["c1", "c2", "own"])

    return t.released(rows)


def _only_in_one(x: pa.Scalar, y: pa.Scalar) -> tuple[np.ndarray, int, int]:
    """The hashes that are in one of two sets only, and the sets' sizes."""
    a, b = np.frombuffer(x.as_buffer(), t.U64), np.frombuffer(y.as_buffer(), t.U64)
    both = np.sort(np.concatenate([a, b]), kind="stable")
    same = np.zeros(len(both) + 1, bool)
    same[1:-1] = both[1:] == both[:-1]
    return both[~(same[1:] | same[:-1])], len(a), len(b)


@t.released
def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("own_a"), batch.column("own_b"), strict=True):
            far, a, b = _only_in_one(x, y)
            keep.append(9 * len(far) <= a + b)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def partner_shares(d: int, n: int, pivot_n: int) -> int:
    """How many of the d shingles in which a set of n differs from its pivot a partner has to
    share that isn't in the same component by way of the pivot."""
    if 9 * d <= n + pivot_n:  # similar to the pivot, so the partner isn't
        return max(1, -(-(pivot_n - n + 9 * d + 1) // 18))
    # a partner with s differences has pivot_n + s shingles at most, and shares s at most
    s = max(1, -(-(9 * d - n - pivot_n) // 10))
    return max(1, -(-(9 * d + 8 * s - n - pivot_n) // 18))


def _differences(sketch):
    """Rows (key, part, class, n, d, pos): the rarest shingles in which a differs from pivot b."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = sketch.value
        for batch in batches:
            out = []
            lists = zip(batch.column("own_a"), batch.column("own_b"), batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("salt").to_pylist(), strict=True)
            for x, y, a, b, salt in lists:
                far, n, pivot_n = _only_in_one(x, y)
                first = np.lexsort((far, _often(count, far)))[: max(0, len(far) - partner_shares(len(far), n, pivot_n) + 1)]
                key = t.mix(far[first] ^ t.mix(np.array([b], np.int64).view(t.U64)))
                out.append((key, salt, a, n, len(far), np.arange(len(first))))
            long = [len(x[0]) for x in out]
            if sum(long):
                flat = [np.concatenate([x[0] for x in out]).view(np.int64), *(np.repeat(np.array([x[k] for x in out], np.int64), long) for k in (1, 2, 3, 4)), np.concatenate([x[5] for x in out])]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(flat, kinds, strict=True)], ["key", "part", "class", "n", "d", "pos"])

    return t.released(rows)


_ENTRY = ["class", "n", "d", "pos", "root", *_FOLDED]


def _may_link_at(a: Column, b: Column, first: bool) -> Column:
    """Whether list entries a and b (structs) may be of similar sets in different components, and,
    with ``first``, that share no shingle before their places."""
    both = a["n"] + b["n"]
    far = sum((F.bit_count(a[f].bitwiseXOR(b[f])) for f in _FOLDED), F.lit(0))
    may = (a["root"] != b["root"]) & (DEN * F.least(a["n"], b["n"]) >= NUM * F.greatest(a["n"], b["n"])) & (9 * far <= both)
    return may & (18 * F.least(a["d"] - a["pos"], b["d"] - b["pos"]) >= 9 * (a["d"] + b["d"]) - both) if first else may


class _Join:
    def __init__(self, docs: DataFrame):
        self.spark = docs.sparkSession
        self.docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
        signed = cut(self.docs.mapInArrow(_signatures, _SIGNED))
        self.sketch = share(self.spark, _sketch(signed))
        rows = signed.filter("chunk is null")
        self.signed = rows.select("doc_id", "c1", "c2", "n")
        self.parity = rows.select(F.col("row").alias("class"), "n", "parity")
        own = [F.max(f).alias(f) for f in _FOLDED]  # equal in all rows of a class
        self.classes = cut(rows.filter("n > 0").groupBy("c1", "c2").agg(F.min("row").alias("class"), F.min("doc_id").alias("first_id"), *own))
        small = rows.filter("small is not null").select("small").mapInArrow(_lengths(self.sketch), "n long, length long")
        small = small.groupBy("n").agg(F.count("*").alias("k"), F.sum("length").alias("length")).collect()  # a row for each small size
        self.light = boundary({x["n"]: (x["k"], x["length"]) for x in small})

    def lists(self) -> DataFrame:
        """The entries of all lists that have two members or more, or are split."""
        rows = self.docs.mapInArrow(_list_rows(self.sketch, self.light), "key long, part int, c1 long, c2 long, n int, pos int, sub int")
        own = Window.partitionBy("key", "part", "sub")
        ends = {f"{f}_{c}": getattr(F, f)(c).over(own) for f, c in (("min", "c1"), ("max", "c1"), ("min", "c2"), ("max", "c2"), ("min", "n"))}
        rows = rows.withColumns(ends | {"many": F.count("*").over(own)}).filter("min_c1 <> max_c1 or min_c2 <> max_c2 or part >= 0")
        # from its place on, an entry must have room for what it has to share with the smallest partner
        rows = rows.filter("sub > 0 or part >= 0 or 9 * (n - pos) >= 4 * (n + min_n)").drop(*ends).dropDuplicates(["key", "part", "sub", "c1", "c2"])
        named = rows.join(self.classes.select("c1", "c2", "class", *_FOLDED).hint("merge"), ["c1", "c2"])
        return cut(named.withColumns({"d": F.col("n"), "deg": F.sum("many").over(Window.partitionBy("c1", "c2"))}).drop("c1", "c2", "many"))

    def own_sets(self, pairs: DataFrame) -> DataFrame:
        """class and own (its hashes) of the classes of some pairs; one document of each is hashed anew."""
        wanted = pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct()
        wanted = cut(self.classes.select("c1", "c2", "class", "first_id").join(wanted, "class"))
        bits = FILTER_BITS[0]
        while bits < min(16 * wanted.count(), FILTER_BITS[1]):
            bits *= 2
        slot = F.xxhash64("first_id").bitwiseAND(F.lit(bits - 1))
        used = wanted.groupBy(F.shiftright(slot, 5).cast("int").alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, cast(xxhash64(first_id) & 31 as int))")).alias("bits"))
        # the cells of the filter, FILTER_BITS / 32 at most
        cells = used.toArrow()
        filled = np.zeros(bits // 32, "<u4")
        filled[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
        filled = share(self.spark, filled.view(np.uint8))
        rows = self.docs.select("text", F.xxhash64("doc_id").alias("slot")).mapInArrow(_own_sets(filled), "c1 long, c2 long, own binary")
        return cut(rows.join(wanted.hint("merge"), ["c1", "c2"]).dropDuplicates(["c1", "c2"]).select("class", "own"))

    def with_sets(self, pairs: DataFrame, own: DataFrame, name: str = "own") -> DataFrame:
        """Pairs (a, b, salt) with both classes' rows of ``own``; b's are sent to each salt of b."""
        a = own.select(*(F.col(c).alias("a" if c == "class" else f"{c}_a") for c in own.columns))
        b = own.select(*(F.col(c).alias("b" if c == "class" else f"{c}_b") for c in own.columns))
        far = pairs.select("b", "salt").distinct().join(b.hint("merge"), "b")
        return pairs.join(a.hint("merge"), "a").join(far.hint("merge"), ["b", "salt"])  # alike at every size

    def near(self, pairs: DataFrame) -> DataFrame:
        """The pairs of classes (a, b, salt) whose parities let them be similar."""
        return cut(self.with_sets(pairs, self.parity).mapInArrow(_may_link, "a long, b long, salt int"))

    def links(self, pairs: DataFrame) -> DataFrame:
        """Which of the pairs of classes (a, b, salt) are similar."""
        return cut(self.with_sets(pairs, self.own_sets(pairs)).select("a", "b", "own_a", "own_b").mapInArrow(_linked, "a long, b long"))

    def opened(self, lists: DataFrame, roots: DataFrame) -> DataFrame:
        """The lists that span components, with the pivot of each and its number of members (m)."""
        lists = lists.select("key", "part", "class", "n", "d", "pos", "deg", *_FOLDED)
        rooted = joined(lists, roots, "class", few=roots.count()).withColumn("root", F.coalesce("root", "class"))
        top = F.max(F.struct("deg", F.xxhash64("class").alias("tie"), *_ENTRY))
        found = {"low": F.min("root"), "high": F.max("root"), "least": F.min(9 * F.col("d") - F.col("n")), "m": F.count("*"), "pivot": top}
        own = Window.partitionBy("key", "part")
        plain = rooted.filter("part < 0").withColumns({name: f.over(own) for name, f in found.items()})
        # of a split list first each part by itself, then, of these few rows, all parts of a key
        key = Window.partitionBy("key")
        parts = rooted.filter("part >= 0").groupBy("key", "part").agg(*(f.alias(name) for name, f in found.items()))
        parts = parts.withColumns({"low": F.min("low").over(key), "high": F.max("high").over(key), "least": F.min("least").over(key), "m": F.sum("m").over(key), "pivot": F.max("pivot").over(key)})
        rows = plain.unionByName(rooted.filter("part >= 0").join(parts, ["key", "part"])).filter("low <> high")
        # from its place on, an entry must have room for what it has to share with some partner
        return cut(rows.filter("18 * (d - pos) >= 9 * d - n + least").drop("least", "low", "high"))

    def meetings(self, lists: DataFrame, short_most: int) -> DataFrame:
        """Pairs (a, b, salt) to compare: in short lists all, in others each member and the pivot."""
        entry = F.struct(*_ENTRY)
        short = lists.filter(f"m <= {short_most}").groupBy("key").agg(F.collect_list(entry).alias("own")).select(F.explode("own").alias("x"), "own")
        short = short.select("x", F.explode(F.filter("own", lambda y: (F.col("x.class") < y["class"]) & _may_link_at(F.col("x"), y, True))).alias("y"))
        short = short.select(F.col("x.class").alias("a"), F.col("y.class").alias("b"), F.lit(1).alias("m"))
        long = lists.filter(f"m > {short_most}").filter(_may_link_at(entry, F.col("pivot"), False)).select(F.col("class").alias("a"), F.col("pivot.class").alias("b"), "m")
        return cut(self.salted(short.union(long)))

    def salted(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs (a, b); those of one b have as many salts as it has parts of members."""
        salt = F.when(F.max("m") <= PART, -1).otherwise(F.pmod(F.xxhash64("a"), F.ceil(F.max("m") / PART))).cast("int")
        return pairs.groupBy("a", "b").agg(salt.alias("salt"))

    def roots(self) -> DataFrame:
        """class and root, the least class it is linked with by way of others."""
        lists = self.lists()
        met = lists.filter("sub > 0")
        least = met.groupBy("key", "sub").agg(F.min(F.struct("n", "class")).alias("least"))
        sure = joined(met, least, "key", "sub").filter("class <> least.class and 9 * sub >= 4 * (n + least.n)")
        roots, _ = components(sure.select(F.col("class").alias("a"), F.col("least.class").alias("b")))
        lists = self.opened(lists.filter("sub = 0").drop("sub"), roots)
        while not lists.isEmpty():
            roots = self.met(lists, SHORT, roots)
            lists = self.opened(lists.filter(f"m > {SHORT}"), roots)
            roots = self.met(lists.filter(f"m <= {WIDE}"), WIDE, roots)
            pairs = self.spanning(lists.filter(f"m > {WIDE}"), roots)
            if pairs.isEmpty():
                break
            lists = self.opened(self.next_lists(pairs), roots)
        return roots

    def met(self, lists: DataFrame, most: int, roots: DataFrame) -> DataFrame:
        """The roots after what the lists let meet has been compared."""
        near = self.near(self.meetings(lists, most))
        if near.isEmpty():
            return roots
        links = self.links(near)
        return roots if links.isEmpty() else self.contracted(roots, links)

    def contracted(self, roots: DataFrame, links: DataFrame) -> DataFrame:
        """The roots after some more links: only pairs of different roots are looked at."""
        ends, n = links, roots.count()
        for c in "ab":
            ends = joined(ends, roots.select(F.col("class").alias(c), F.col("root").alias("own_root")), c, few=n).withColumn(c, F.coalesce("own_root", c)).drop("own_root")
        step, n = components(ends)
        fresh = step.join(roots, step["class"] == roots["class"], "left_anti").select("class", F.col("class").alias("root"))
        moved = joined(roots.union(fresh), step.select(F.col("class").alias("root"), F.col("root").alias("now")), "root", few=2 * n)
        return cut(moved.select("class", F.coalesce("now", "root").alias("root")))

    def spanning(self, lists: DataFrame, roots: DataFrame) -> DataFrame:
        """Pairs (a, b, salt) of the members and pivots of lists that still span components."""
        rooted = joined(lists.select("key", "part", "class", F.col("pivot.class").alias("pivot"), "m"), roots, "class", few=roots.count()).withColumn("root", F.coalesce("root", "class"))
        key = Window.partitionBy("key")
        ends = rooted.groupBy("key", "part").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        ends = ends.withColumns({"low": F.min("low").over(key), "high": F.max("high").over(key)}).filter("low <> high").select("key", "part")
        pairs = rooted.join(ends, ["key", "part"]).filter("class <> pivot").select(F.col("class").alias("a"), F.col("pivot").alias("b"), "m")
        return cut(self.salted(pairs))

    def next_lists(self, pairs: DataFrame) -> DataFrame:
        """New lists of those members, by their differences from the pivot."""
        rows = self.with_sets(pairs, self.own_sets(pairs)).select("a", "b", "salt", "own_a", "own_b").mapInArrow(_differences(self.sketch), "key long, part int, class long, n int, d int, pos int")
        rows = cut(rows)
        many = rows.groupBy("key", "part").count().select("key", "part", F.sum("count").over(Window.partitionBy("key")).alias("many")).filter("many > 1")
        rows = rows.join(many, ["key", "part"]).join(self.classes.select("class", *_FOLDED), "class")
        return cut(rows.withColumn("deg", F.sum("many").over(Window.partitionBy("class"))).drop("many"))

    def result(self) -> DataFrame:
        named = joined(self.classes.select("c1", "c2", "class", "first_id"), self.roots(), "class").withColumn("root", F.coalesce("root", "class"))
        lowest = named.groupBy("root").agg(F.min("first_id").alias("low_id"))
        named = cut(joined(named, lowest, "root").select("c1", "c2", "low_id"))
        out = joined(self.signed, named, "c1", "c2")
        return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce(F.when(F.col("n") > 0, F.col("low_id")), F.col("doc_id")).alias("component_id"))


@tidy
def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text)."""
    return _Join(docs).result()


def one_of_each(docs: DataFrame) -> DataFrame:
    """The first row of each component of ``docs``, and all rows whose texts have no word.

    Rows without an id come after those with one.  Where ids repeat, rows are told apart by a
    64-bit hash of id and text; of rows that are equal in both, one stays.
    """
    if not repeats(docs.select("doc_id")):
        kept = near_duplicates(docs).filter("doc_id <=> component_id").select(F.col("doc_id").alias("kept_id"))
        return docs.join(kept.hint("merge"), docs["doc_id"].cast("long").eqNullSafe(kept["kept_id"]), "left_semi")  # alike at every size
    key = "row_key"
    while any(c.lower() == key for c in docs.columns):
        key = "_" + key
    row_key = F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id"), F.col("text").isNull(), F.col("text"))
    rows = docs.withColumn(key, row_key)
    found = near_duplicates(rows.select(F.col(key).alias("doc_id"), "text")).distinct().withColumnRenamed("doc_id", key)
    ids = found.join(rows.select(key, "doc_id").distinct(), key)
    first = F.min_by(key, F.struct(F.col("doc_id").isNull(), "doc_id", key))
    kept = cut(ids.groupBy("component_id").agg(first.alias(key), F.max("n_shingles").alias("kept_n")).drop("component_id"))
    worded, wordless = (kept.filter(f).select(key) for f in ("kept_n > 0", "kept_n = 0"))
    one = rows.join(worded.hint("merge"), key, "left_semi").dropDuplicates([key])
    return one.unionByName(rows.join(wordless.hint("merge"), key, "left_semi")).select(*(F.col(f"`{c}`") for c in docs.columns))


def repeats(ids: DataFrame) -> bool:
    """Whether a value of the only column occurs in several rows."""
    return not ids.groupBy(*ids.columns).count().filter("count > 1").isEmpty()


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
