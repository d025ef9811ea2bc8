"""Packing documents into sequences by bin completion.

Every document is its token ids and a closing id.  Only documents longer than a sequence are cut,
into full pieces after a first one that takes the rest.  Pieces of one length are alike, so the
search runs on the number of pieces of each length, which has as many entries as a sequence has
tokens however large the corpus is.

``complete`` is branch and bound by bin completion: around the largest piece left, it enumerates
the fillings that no other filling dominates, least waste first, applies one to as many sequences
as the pieces allow, and goes on; a branch ends when its waste rules out fewer sequences than the
incumbent has.  The first incumbent is the best-fit solution.  Piece number i of a length then
goes where the solution places it; numbers come from prefix sums over hash buckets.

A very long text is encoded whole and cut into as many pieces as it needs.  A null or empty text is the closing id alone.  Repeated rows are packed as rows of their own (rows
equal in doc_id and ids may swap).  An empty table gives an empty result.  Only doc_id and text
are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import _text as t
from ._session import cut, share, table, tidy
from ._tokens import default_path, encoder

CAPACITY = 2048
CLOSING = 0
#: Nodes of the search, fillings tried at each, and steps to find them.
NODES, FILLINGS, STEPS = 5_000, 4, 2_000

Pattern = tuple[int, tuple[tuple[int, int], ...]]  # sequences, ((length, pieces), ...)


def _swappable(sizes: list[int], have: list[int], filling: list[int], room: int) -> bool:
    """Whether a spare piece could take the place of none, one, two or all pieces of the filling."""

    def spare(gone: int) -> bool:
        i = bisect_right(sizes, gone + room) - 1
        while i >= 0 and sizes[i] > gone:
            if have[sizes[i]] > filling.count(sizes[i]):
                return True
            i -= 1
        return False

    return spare(0) or any(map(spare, filling)) or spare(sum(filling)) or any(spare(x + y) for i, x in enumerate(filling) for y in filling[:i])


def fillings(counts: np.ndarray, room: int) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``room`` with pieces, least waste and then fewest pieces first.

    One piece that closes a sequence exactly dominates several that do.
    """
    sizes, have = np.flatnonzero(counts[: room + 1] > 0).tolist(), counts[: room + 1].tolist()
    found: dict[tuple[int, ...], int] = {}
    steps, exact = STEPS, 0
    chosen: list[int] = []

    def fill(room: int, most: int) -> None:
        nonlocal steps, exact
        steps -= 1
        if 0 < room <= most and have[room] > chosen.count(room):
            found[(*chosen, room)] = 0
            exact += 1
            most = room - 1
            if not chosen:
                return
        elif not room:
            found[tuple(chosen)] = 0
            return
        i, ended = bisect_right(sizes, min(room, most)) - 1, True
        while i >= 0 and steps > 0 and exact < FILLINGS:
            x = sizes[i]
            if have[x] > chosen.count(x):
                ended = False
                chosen.append(x)
                fill(room - x, x)
                chosen.pop()
            i -= 1
        if ended and i < 0 and tuple(chosen) not in found and not _swappable(sizes, have, chosen, room):
            found[tuple(chosen)] = room

    fill(room, room)
    if not found:  # the steps ran out: fill greedily
        i, left = len(sizes) - 1, room
        while i >= 0:
            x = sizes[i]
            take = min(left // x, have[x])
            chosen += [x] * take
            left -= take * x
            i = min(i, bisect_right(sizes, left)) - 1
        found[tuple(chosen)] = left
    return sorted(found, key=lambda x: (found[x], len(x), [-y for y in x]))[:FILLINGS]


def _apply(counts: np.ndarray, items: tuple[int, ...]) -> int:
    sizes, used = np.unique(items, return_counts=True)
    times = int((counts[sizes] // used).min())
    counts[sizes] -= used * times
    return times


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Largest pieces first, each sequence filled with the largest that fits."""
    counts, out = counts.copy(), []
    while counts.any():
        room, items = capacity, []
        rest = counts.copy()
        while room and (fit := np.flatnonzero(rest[: room + 1] > 0)).size:
            items.append(int(fit[-1]))
            rest[fit[-1]] -= 1
            room -= int(fit[-1])
        out.append((_apply(counts, tuple(items)), tuple(items)))
    return out


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any solution needs: by volume, and by pieces over half with what can't join them."""
    sizes = np.arange(len(counts))
    volume = int((counts * sizes).sum())
    best = -(-volume // capacity)
    over = int(counts[capacity // 2 + 1 :].sum())
    for k in np.flatnonzero(counts[: capacity // 2 + 1] > 0).tolist():
        alone = int(counts[capacity - k + 1 :].sum())
        paired = counts[capacity // 2 + 1 : capacity - k + 1]
        free = int(paired.sum()) * capacity - int((paired * sizes[capacity // 2 + 1 : capacity - k + 1]).sum())
        small = int((counts[k : capacity // 2 + 1] * sizes[k : capacity // 2 + 1]).sum())
        best = max(best, alone + int(paired.sum()) + max(0, -(-(small - free) // capacity)))
    return max(best, over)


def complete(counts: np.ndarray, capacity: int = CAPACITY, nodes: int = NODES) -> list[Pattern]:
    """Fewest sequences found for counts[length] pieces of each length (index 0 is unused)."""
    counts = np.asarray(counts, np.int64)
    best = best_fit(counts, capacity)
    fewest, least = sum(m for m, _ in best), lower_bound(counts, capacity)
    volume = int((counts * np.arange(len(counts))).sum())
    trail: list[dict] = []  # patterns so far, each with the pieces left and the fillings still to try
    waste = 0
    while fewest > least and nodes > 0:
        if not trail or trail[-1]["ready"]:
            left = trail[-1]["left"] if trail else counts
            if not left.any():
                if (total := sum(x["times"] for x in trail)) < fewest:
                    fewest, best = total, [(x["times"], x["items"]) for x in trail]
                trail[-1]["ready"] = False
            else:
                largest = int(np.flatnonzero(left > 0)[-1])
                rest = left.copy()
                rest[largest] -= 1
                ways = [(largest, *x) for x in fillings(rest, capacity - largest)]
                trail.append({"before": left, "ways": ways, "ready": False, "waste": 0})
        while trail and not trail[-1]["ready"]:
            top = trail[-1]
            waste -= top["waste"]
            top["waste"] = 0
            if not top["ways"]:
                trail.pop()
                if trail:
                    trail[-1]["ready"] = False
                continue
            items = top["ways"].pop(0)
            left = top["before"].copy()
            times = _apply(left, items)
            nodes -= 1
            top |= {"left": left, "items": items, "times": times, "waste": times * (capacity - sum(items))}
            waste += top["waste"]
            if waste <= (fewest - 1) * capacity - volume:
                top["ready"] = True
            if nodes <= 0:
                break
        if not trail:
            break
    return [(m, tuple(zip(*(x.tolist() for x in np.unique(items, return_counts=True)), strict=True))) for m, items in best]


def _pieces(path: str, capacity: int, closing: int):
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path)
        end = np.array([closing], "<u4")
        for batch in batches:
            for block in t.blocks(batch.column("text"), 1 << 20):
                of, piece, start, length, crc = [], [], [], [], []
                for i, own in enumerate(tokens.encode(block)):
                    ids = np.concatenate([own.astype("<u4"), end])
                    n = -(-len(ids) // capacity)
                    at = 0
                    for k in range(n):
                        stop = len(ids) - capacity * (n - 1 - k)
                        of.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(stop - at)
                        crc.append(zlib.crc32(ids[at:stop]))
                        at = stop
                ids = batch.column("doc_id").slice(block.first, block.rows).take(pa.array(of, pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))], names)

    return t.released(rows)


def _places(solution: list[Pattern]) -> dict[str, np.ndarray]:
    """For each length, in order of piece numbers: where runs of pieces go."""
    rows, used, sequence = [], {}, 0
    for times, pattern in solution:
        offset = 0
        for length, pieces in reversed(pattern):
            first = used.get(length, 0)
            rows.append((length, first, pieces, sequence, offset))
            used[length] = first + times * pieces
            offset += length * pieces
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "pieces", "sequence", "offset"), table.T, strict=True))


def _placed(places):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = places.value
        sizes, first = np.unique(p["length"], return_index=True)
        starts = {x: slice(a, b) for x, a, b in zip(sizes.tolist(), first.tolist(), [*first[1:].tolist(), len(p["length"])], strict=True)}
        for batch in batches:
            length, number = np.array(batch.column("length"), np.int64), np.array(batch.column("number"), np.int64)
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length).tolist():
                own, runs = length == x, starts[x]
                k = runs.start + np.searchsorted(p["first"][runs], number[own], "right") - 1
                nth = number[own] - p["first"][k]
                sequence[own] = p["sequence"][k] + nth // p["pieces"][k]
                offset[own] = p["offset"][k] + nth % p["pieces"][k] * x
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return t.released(rows)


@tidy
def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, closing: int = CLOSING) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    spark = docs.sparkSession
    text = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    pieces = cut(text.mapInArrow(_pieces(tokenizer or default_path(), capacity, closing), "doc_id long, piece int, start long, length long, ids_crc32 long"))
    counts = np.zeros(capacity + 1, np.int64)
    for x in pieces.groupBy("length").count().collect():  # one row for each length
        counts[x["length"]] = x["count"]
    places = share(spark, _places(complete(counts, capacity)))
    hashed = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(1024)))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = hashed.groupBy("length", "bucket").count().withColumn("number_0", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = hashed.withColumn("nth", F.row_number().over(inside)).join(totals, ["length", "bucket"])
    numbered = numbered.withColumn("number", F.col("number_0") + F.col("nth") - 1).drop("nth", "number_0", "bucket")
    return numbered.mapInArrow(_placed(places), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
