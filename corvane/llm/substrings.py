"""Substring dedup: removes every word that lies in a passage found anywhere else.

A window is ``WINDOW`` consecutive words of one text.  A window whose words also start anywhere else,
in another text or in the same one, is repeated, and all words that repeated windows cover go.

* The minimiser of a window is the least, in one order of hashes, of its runs of ``RUN`` words.
  Equal windows have equal minimisers, and of a text's consecutive windows many share one: such a
  super-k-mer travels as one string of words to the bucket of its minimiser, so that a word is
  sent about three times and not ``WINDOW`` times.
* In its bucket the windows of all super-k-mers are sorted by a hash, and equal neighbours are
  compared byte by byte.  What repeats is sent back as spans of words to the text it came from.

Common passages would fill the buckets of their minimisers with whatever stands around them.  So
runs of words that are frequent in the whole table (counted first; ``HEAVY`` at most are kept, 8 bytes
each, whatever the input) come last in the order: a window that holds any rarer run goes to that
run's bucket, and windows of frequent runs only are those wholly inside a common passage.  Of equal
super-k-mers a task sends one, and marks its own as repeated at once, so a passage that is in every
text reaches its bucket once from each task.  The number of buckets follows the words counted, so a bucket keeps its
size when the input grows; a bucket is worked off by itself, whatever the number of partitions.

Words are ``[^\\x20\\x09-\\x0D]+``, compared byte by byte.  Null and empty texts have no words, and
texts of fewer than ``WINDOW`` words keep them all.  Rows that are equal in doc_id and text get equal
results, and as they repeat each other, lose all words if they have a window.  A text's length has no bound but
the memory that it takes some ten times.  An empty table gives an empty result.  Only doc_id and text are
read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as t
from ._session import cut, share, shuffle_width, table, tidy

WINDOW, RUN = 35, 5
#: Bytes of text that a task packs together, and that a bucket is to hold.
CHUNK, BUCKET = 8 << 20, 4 << 20
#: Runs counted together; how often one must be in them, and in all, to be frequent; most that are kept.
COUNTED, OFTEN, COMMON, HEAVY = 1 << 22, 8, 64, 1 << 20
_REF = np.dtype([("key", "<i8"), ("check", "<u4"), ("start", "<u4")])
#: The start in a reference of a super-k-mer whose repetition is known.
_KNOWN = np.uint32(0xFFFFFFFF)


def joined_words(block: t.Block, space: np.ndarray, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of a block (all, or those to keep) with one space after each: bytes, starts, ends."""
    words = t.words(block, space)
    length = words.end - words.start
    if keep is None:
        inside = np.flatnonzero(~space)
    else:
        inside, length = np.flatnonzero(~space & _covered_bytes(words, keep, len(space))), length[keep]
    number = np.repeat(np.arange(len(length)), length)
    out = np.full(int(length.sum()) + len(length), 0x20, np.uint8)
    out[np.arange(len(inside)) + number] = block.data[inside]
    end = np.cumsum(length + 1) - 1
    return out, end - length, end


def _covered_bytes(words: t.Words, keep: np.ndarray, n: int) -> np.ndarray:
    step = np.zeros(n + 1, np.int8)
    step[words.start[keep]] += 1
    np.subtract.at(step, words.end[keep], 1)
    return np.cumsum(step[:-1], dtype=np.int8) > 0


def run_hashes(hashes: np.ndarray) -> np.ndarray:
    """63-bit hashes of the runs of words from each place on."""
    return t.mix(t.ngrams(hashes, RUN)) >> t.U64(1)


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n hashes from each place on, made from those of halves."""
    if n == 1:
        return hashes
    half = n // 2
    part = window_hashes(hashes, half)
    size = max(0, len(hashes) - n + 1)
    with np.errstate(over="ignore"):
        out = part[:size] * t.U64(pow(int(t._STEP), half, 1 << 64)) + part[half : half + size]
        if n % 2:
            out = out * t._STEP + hashes[n - 1 : n - 1 + size]
    return out


def least_of(values: np.ndarray, n: int) -> np.ndarray:
    """The least of the n values from each place on."""
    if len(values) < n:
        return values[:0]
    width, low = 1, values
    while 2 * width <= n:
        low = np.minimum(low[: len(low) - width], low[width:])
        width *= 2
    size = len(values) - n + 1
    return np.minimum(low[:size], low[n - width : n - width + size])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs that are frequent in a part of a task, and, as run -1, the bytes of words."""
    held, total = [np.zeros(0, t.U64)], 0

    def frequent() -> pa.RecordBatch:
        own, n = np.unique(np.concatenate(held), return_counts=True)
        del held[1:]
        return pa.RecordBatch.from_arrays([pa.array(own[n >= OFTEN].view(np.int64)), pa.array(n[n >= OFTEN])], ["run", "n"])

    for batch in batches:
        for block in t.blocks(batch.column("text")):
            words = t.words(block)
            runs = run_hashes(t.span_hash(block.data, words.start, words.end))
            held.append(runs[t.whole(words.at, RUN, len(runs))])
            total += int((words.end - words.start).sum()) + len(words.start)
            if sum(map(len, held)) >= COUNTED:
                yield frequent()
    yield frequent()
    yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int64()), pa.array([total], pa.int64())], ["run", "n"])


def _super_kmers(block: t.Block, heavy: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Of each super-k-mer of a block: its row, its first word in the row, its number of words, its
    minimiser and its words as one string."""
    space = t.spaces(block)
    words = t.words(block, space)
    runs = run_hashes(t.span_hash(block.data, words.start, words.end))
    if len(heavy):
        place = np.minimum(np.searchsorted(heavy, runs), len(heavy) - 1)
        runs = runs | ((heavy[place] == runs).astype(t.U64) << t.U64(63))
    low = least_of(runs, WINDOW - RUN + 1)
    at = np.flatnonzero(t.whole(words.at, WINDOW, len(low)))
    low = low[at]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1] + 1) | (low[1:] != low[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(at)) - 1
    a, b = at[first], at[last] + WINDOW if len(at) else at
    data, start, end = joined_words(block, space)
    data = data.tobytes()
    texts = [data[x:y] for x, y in zip(start[a].tolist(), end[b - 1].tolist(), strict=True)]
    row = words.doc[a]
    return row, a - words.at[row], b - a, low[first], texts


_PACKED = "bucket long, size int, lines binary, refs binary"
_MARKS = "key long, check long, first int, stop int"


#: Of each bucket's part of a chunk; a higher level costs more time than it saves in bytes.
_PACKER = pa.Codec("zstd", compression_level=3)


class _Chunk:
    """Super-k-mers of some texts of a task: equal ones once, and what is known to be repeated."""

    def __init__(self, buckets: int):
        self.buckets, self.bytes = buckets, 0
        self.found: dict[bytes, int] = {}
        self.low: list[int] = []
        self.refs: list[tuple[int, int, int, int]] = []
        self.known: list[bool] = []
        self.marks: list[tuple[int, int, int, int]] = []

    def add(self, block: t.Block, keys: np.ndarray, checks: np.ndarray, heavy: np.ndarray) -> None:
        row, start, n, low, texts = _super_kmers(block, heavy)
        refs = zip(keys[row].tolist(), checks[row].tolist(), start.tolist(), (start + n).tolist(), strict=True)
        for text, value, ref in zip(texts, low.tolist(), refs, strict=True):
            at = self.found.setdefault(text, len(self.low))
            if at == len(self.low):
                self.low.append(value)
                self.refs.append(ref)
                self.known.append(False)
            else:
                if not self.known[at]:
                    self.known[at] = True
                    self.marks.append(self.refs[at])
                self.marks.append(ref)
        self.bytes += len(block.data)

    def rows(self) -> pa.RecordBatch:
        """A row for each bucket; rows without lines bring marks, to any bucket."""
        low = np.array(self.low, t.U64)
        bucket = (t.mix(low) % t.U64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1])) if len(order) else np.zeros(0, np.int64)
        refs = np.zeros(len(low), _REF)
        if len(low):
            key, check, start, _ = zip(*self.refs, strict=True)
            refs["key"], refs["check"], refs["start"] = key, check, np.where(self.known, _KNOWN, start)
        texts = list(self.found)
        out: list[tuple[int, int, bytes | None, bytes]] = []
        for some in np.split(order, cuts[1:]) if len(order) else []:
            lines = b"\n".join([texts[i] for i in some.tolist()])
            out.append((int(bucket[some[0]]), len(lines), _PACKER.compress(lines, asbytes=True), refs[some].tobytes()))
        marks = _merged(np.array(self.marks, np.int64).reshape(-1, 4))
        for first in range(0, len(marks), 1 << 14):
            out.append((int(bucket[0]) + first, 0, None, marks[first : first + (1 << 14)].tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()), pa.array([x[2] for x in out], pa.binary()), pa.array([x[3] for x in out], pa.binary())], [x.split()[0] for x in _PACKED.split(", ")])


def _merged(marks: np.ndarray) -> np.ndarray:
    """Marks (key, check, first, stop) with those of one text that touch or overlap made one."""
    if not len(marks):
        return marks
    marks = marks[np.lexsort(marks.T[::-1])]
    out = [marks[0].tolist()]
    for mark in marks[1:].tolist():
        last = out[-1]
        if mark[:2] == last[:2] and mark[2] <= last[3]:
            last[3] = max(last[3], mark[3])
        else:
            out.append(mark)
    return np.array(out, np.int64)


def _pack(heavy, buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(buckets)
        for batch in batches:
            keys, checks = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "check"))
            for block in t.blocks(batch.column("text")):
                own = slice(block.first, block.first + block.rows)
                chunk.add(block, keys[own], checks[own], heavy.value)
                if chunk.bytes >= CHUNK:
                    yield chunk.rows()
                    chunk = _Chunk(buckets)
        yield chunk.rows()

    return t.released(rows)


def repeated_windows(data: np.ndarray, words: t.Words, at: np.ndarray) -> np.ndarray:
    """Which of the windows from words ``at`` on equal another one, in lines of words with one space
    between them.  Windows are sorted by a hash; those with equal hashes are compared byte by byte."""
    hashes = window_hashes(t.span_hash(data, words.start, words.end), WINDOW)
    own = t.mix(hashes[at])
    order = np.argsort(own, kind="stable")
    equal = own[order][1:] == own[order][:-1]
    pair = np.flatnonzero(equal)
    start, size = words.start[at[order]], words.end[at[order] + WINDOW - 1] - words.start[at[order]]
    same = t.equal_spans(data, start[pair], size[pair], data, start[pair + 1], size[pair + 1])
    if not same.all():  # different windows with one hash: all that share it are told apart by their bytes
        hits = np.zeros(len(order), np.int64)
        runs = np.split(np.arange(len(order)), np.flatnonzero(~equal) + 1)
        odd = {int(x) for x in pair[~same]}
        for run in runs:
            if len(run) > 1 and not odd.isdisjoint(run.tolist()):
                texts = [data[start[i] : start[i] + size[i]].tobytes() for i in run.tolist()]
                counts = {x: texts.count(x) for x in set(texts)}
                hits[run] = [counts[x] > 1 for x in texts]
            else:
                hits[run] = len(run) > 1
        out = np.zeros(len(order), bool)
        out[order] = hits > 0
        return out
    return t._runs(order, equal)[0]


def _bucket_marks(lines: list[bytes], refs: np.ndarray) -> np.ndarray:
    """The marks (key, check, first, stop) of a bucket's lines."""
    data = np.frombuffer(b"\n".join(lines), np.uint8)
    at = np.concatenate([[0], np.flatnonzero(data == 10) + 1, [len(data)]])
    words = t.words(t.Block(0, len(at) - 1, data, at))
    places = np.flatnonzero(t.whole(words.at, WINDOW, max(0, len(words.start) - WINDOW + 1)))
    hit = places[repeated_windows(data, words, places)]
    hit = hit[refs["start"][words.doc[hit]] != _KNOWN]
    if not len(hit):
        return np.zeros((0, 4), np.int64)
    line = words.doc[hit]
    fresh = np.append(True, (hit[1:] != hit[:-1] + 1) | (line[1:] != line[:-1]))
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(hit)) - 1
    own = refs[line[first]]
    base = own["start"].astype(np.int64) - words.at[line[first]]
    return np.column_stack([own["key"], own["check"].astype(np.int64), base + hit[first], base + hit[last] + WINDOW])


@t.released
def _sorted_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The marks of the buckets of a partition, one bucket after another."""
    names = [x.split()[0] for x in _MARKS.split(", ")]
    kinds = pa.int64(), pa.int64(), pa.int32(), pa.int32()

    def batch_of(marks: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(np.ascontiguousarray(marks.T), kinds, strict=True)], names)

    bucket, lines, refs = None, [], []
    for batch in batches:
        for now, size, some, own in zip(*(batch.column(c) for c in ("bucket", "size", "lines", "refs")), strict=True):
            if not some.is_valid:
                yield batch_of(np.frombuffer(own.as_buffer(), np.int64).reshape(-1, 4))
                continue
            if now.as_py() != bucket and lines:
                yield batch_of(_bucket_marks(lines, np.concatenate(refs)))
                lines, refs = [], []
            bucket = now.as_py()
            lines.append(pa.decompress(some.as_buffer(), size.as_py(), "zstd", asbytes=True))
            refs.append(np.frombuffer(own.as_buffer(), _REF))
    if lines:
        yield batch_of(_bucket_marks(lines, np.concatenate(refs)))


_CLEAN = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string"


def _kept(with_text: bool):
    names = [x.split()[0] for x in _CLEAN.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in t.blocks(batch.column("text")):
                space = t.spaces(block)
                words = t.words(block, space)
                spans = batch.column("spans").slice(block.first, block.rows)
                flat = spans.flatten()
                row = np.repeat(np.arange(block.rows), pc.list_value_length(spans).fill_null(0).to_numpy(zero_copy_only=False))
                depth = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(depth, words.at[row] + flat.field("first").to_numpy(zero_copy_only=False), 1)
                np.add.at(depth, words.at[row] + flat.field("stop").to_numpy(zero_copy_only=False), -1)
                keep = np.cumsum(depth[:-1]) == 0
                data, start, end = joined_words(block, space, keep)
                data, n = data.tobytes(), t.per_row(keep, words.at)
                upto = np.concatenate([[0], np.cumsum(n)])
                bounds = [(start[a], end[b - 1]) if b > a else (0, 0) for a, b in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
                texts = [data[a:b] for a, b in bounds]
                all_n = np.diff(words.at)
                digests = [hashlib.sha256(x).hexdigest() for x in texts]
                own = pa.array([x.decode() for x in texts] if with_text else [None] * len(texts), pa.string())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(block.first, block.rows), pa.array(all_n), pa.array(all_n - n), pa.array(digests), own], names)

    return t.released(rows)


@tidy
def without_repeats(docs: DataFrame, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, with ``with_text``, kept_text of every row of
    ``docs``: what is left of its text, words joined by one space."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.withColumns({"key": F.xxhash64(F.col("doc_id").isNull(), "doc_id", "text"), "check": F.crc32(F.col("text").cast("binary"))})
    counts = cut(rows.select("text").mapInArrow(t.released(_counted), "run long, n long").groupBy("run").agg(F.sum("n").alias("n")).filter(f"run = -1 or n >= {COMMON}"))
    frequent = counts.filter("run <> -1").orderBy(F.desc("n"), "run").limit(HEAVY).select("run").toArrow().column("run")  # HEAVY at most
    heavy = share(spark, np.sort(frequent.to_numpy().view(t.U64)))
    size = sum(x["n"] for x in counts.filter("run = -1").collect())
    buckets = max(1, -(-3 * size // BUCKET))
    width = min(buckets, max(shuffle_width(spark), buckets // 64))
    packed = rows.select("text", "key", "check").mapInArrow(_pack(heavy, buckets), _PACKED)
    marks = packed.repartition(width, "bucket").sortWithinPartitions("bucket").mapInArrow(_sorted_buckets, _MARKS)
    spans = marks.groupBy("key", "check").agg(F.collect_list(F.struct("first", "stop")).alias("spans"))  # of one text
    found = rows.join(spans.hint("shuffle_hash"), ["key", "check"], "left")
    out = found.select("doc_id", "text", "spans").mapInArrow(_kept(with_text), _CLEAN)
    return out if with_text else out.drop("kept_text")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), with_text=False)
