"""Words and hashes of Arrow string columns, computed on whole byte buffers.

A word is ``[^\\x20\\x09-\\x0D]+``.  Every function takes a block: the UTF-8 bytes of some
documents laid end to end and the offsets at which each starts.  No work is done per word in
Python, but for spans of more than ``LONG`` bytes.

A span's hash runs over its bytes eight at a time, each step a bijection that isn't linear, so no
pattern of bytes makes two spans collide whatever their content.  Where equality decides a
result, spans with equal hashes are also compared byte by byte (``distinct``, ``equal_spans``).
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BLOCK_BYTES = 1 << 18
#: Bytes from which a span is hashed and compared on its own.
LONG = 512
_SEED = U64(0x5EED_C0DE_2718_2818)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def released(rows: Callable) -> Callable:
    """Lets a function over batches give back the memory that it has freed when a task ends: workers
    are used again, and what they only hold in reserve would add up beside the executor's heap."""

    @wraps(rows)
    def run(batches):
        try:
            yield from rows(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return run


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits depend on all input bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


@dataclass
class Block:
    first: int  # row of the batch at which the block starts
    rows: int
    data: np.ndarray  # uint8
    at: np.ndarray  # int64, rows + 1 offsets into data


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """Consecutive rows of a string column in blocks of about ``most`` bytes; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type)
    _, offsets, values = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(values, np.uint8) if values is not None and values.size else np.zeros(0, np.uint8)
    start = 0
    while start < n:
        stop = max(start + 1, int(np.searchsorted(at, at[start] + most, "right")) - 1)
        stop = min(stop, n)
        yield Block(start, stop - start, data[at[start] : at[stop]], at[start : stop + 1] - at[start])
        start = stop


@dataclass
class Words:
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray  # rows + 1 offsets into start
    doc: np.ndarray  # row of each word


def spaces(block: Block) -> np.ndarray:
    return _SPACE[block.data]


def words(block: Block, space: np.ndarray | None = None) -> Words:
    inside = ~(spaces(block) if space is None else space)
    n = len(inside)
    opened, closed = inside.copy(), inside.copy()
    if n:
        opened[1:] &= ~inside[:-1]
        closed[:-1] &= ~inside[1:]
        firsts = block.at[:-1][np.diff(block.at) > 0]
        opened[firsts] = inside[firsts]
        lasts = block.at[1:][np.diff(block.at) > 0] - 1
        closed[lasts] = inside[lasts]
    start, end = np.flatnonzero(opened), np.flatnonzero(closed) + 1
    at = np.searchsorted(start, block.at)
    return Words(start, end, at, np.repeat(np.arange(block.rows), np.diff(at)))


def lower(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z as a-z."""
    return _LOWER[data]


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number; beyond the end they are 0."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))


_KEEP = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each span of bytes, A-Z being taken as a-z with ``lower``."""
    if lower:
        data = _LOWER[data]
    eights, size = _eights(data), end - start
    out = mix(size.astype(U64) ^ _SEED)
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8).digest(), "little")
    at = np.flatnonzero((size > 0) & (size <= LONG))
    first, left, own = start[at], size[at], out[at]
    while len(at):
        own = mix(own ^ (eights[first] & _KEEP[np.minimum(left, 8)]))
        more = left > 8
        out[at[~more]] = own[~more]
        at, first, left, own = at[more], first[more] + 8, left[more] - 8, own[more]
    return out


def equal_spans(a: np.ndarray, first_a: np.ndarray, size_a: np.ndarray, b: np.ndarray, first_b: np.ndarray, size_b: np.ndarray, padded: bool = False) -> np.ndarray:
    """Whether each span of bytes a equals the one of bytes b, byte by byte; with ``padded``, b's
    spans end 8 bytes before its end at least."""
    out = size_a == size_b
    for i in np.flatnonzero(out & (size_a > LONG)).tolist():
        out[i] = np.array_equal(a[first_a[i] : first_a[i] + size_a[i]], b[first_b[i] : first_b[i] + size_b[i]])
    at = np.flatnonzero(out & (size_a > 0) & (size_a <= LONG))
    left, x, y = size_a[at], first_a[at], first_b[at]
    a, b = _eights(a), np.ndarray(len(b) - 7, "<u8", b, strides=(1,)) if padded else _eights(b)
    while len(at):
        same = ((a[x] ^ b[y]) & _KEEP[np.minimum(left, 8)]) == 0
        out[at[~same]] = False
        more = same & (left > 8)
        at, left, x, y = at[more], left[more] - 8, x[more] + 8, y[more] + 8
    return out


def distinct(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For each span a number that it shares with equal spans only, and a span of each number.

    Spans are told apart by hash and then byte by byte, so a collision can't join two of them.
    """
    if lower:
        data = _LOWER[data]
    _, sample, number = np.unique(span_hash(data, start, end), return_index=True, return_inverse=True)
    size = end - start
    odd = np.flatnonzero(~equal_spans(data, start, size, data, start[sample[number]], size[sample[number]]))
    known: dict[bytes, int] = {}
    for i in odd.tolist():
        number[i] = known.setdefault(data[start[i] : end[i]].tobytes(), len(sample) + len(known))
    firsts = np.full(len(sample) + len(known), -1)
    firsts[number[::-1]] = np.arange(len(number))[::-1]
    return number, firsts


_STEP = U64(0xD6E8FEB86659FD93)


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n hashes from each position on; the last n - 1 positions have no value."""
    out = hashes[: max(0, len(hashes) - n + 1)].copy()
    with np.errstate(over="ignore"):
        for k in range(1, n):
            out *= _STEP
            out += hashes[k : k + len(out)]
    return out


def whole(at: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of the first ``length`` positions have n positions of one document from there on."""
    last = np.repeat(at[1:], np.diff(at))[:length]
    return np.arange(length) + n <= last


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether it occurs twice or more, and whether it occurred before."""
    order = np.argsort(keys, kind="stable")
    return _runs(order, keys[order][1:] == keys[order][:-1])


def _runs(order: np.ndarray, equal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = equal
    twice, later = np.empty(len(order), bool), np.empty(len(order), bool)
    twice[order], later[order] = same[:-1] | same[1:], same[:-1]
    return twice, later


def repeated_grams(keys: np.ndarray, at: np.ndarray, numbers: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``repeated`` for the n numbers from each of ``at`` on, whose hashes are ``keys``.  Where two
    hashes are equal, so must be the owners and all n numbers; else these are put in order."""
    order = np.argsort(keys, kind="stable")
    equal = keys[order][1:] == keys[order][:-1]
    pairs = np.flatnonzero(equal)
    a, b = at[order[pairs]], at[order[pairs + 1]]
    if (owner[a] == owner[b]).all() and all((numbers[a + k] == numbers[b + k]).all() for k in range(n)):
        return _runs(order, equal)
    columns = [owner[at], *(numbers[at + k] for k in range(n))]
    order = np.lexsort(columns)
    equal = np.ones(max(0, len(order) - 1), bool)
    for own in columns:
        equal &= own[order][1:] == own[order][:-1]
    return _runs(order, equal)


def per_row(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of the values of each row."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]
