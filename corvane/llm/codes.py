"""Codes of vectors by parts, found by partial-distance search in integers.

Every component x becomes floor(256 x).  A vector is cut into 16 equal parts, and each part is
named by the entry of its codebook that is nearest (squared Euclidean distance, the lower index of
equally near ones).  Codebooks start as the parts of the 64 smallest ids and are fitted in rounds:
all parts are named, then every entry becomes the floor of the mean of its parts.

Search: an entry that is nearest in the dimension of the largest codebook variance is measured
whole, which gives the best distance so far.  Then dimensions are taken in descending variance, and
an entry whose sum over the dimensions so far strictly exceeds the best is dropped; what is left at
the end has been measured whole.  Entries are taken in blocks, so the best falls from block to
block.  All is done on arrays of (vector, entry) pairs, and all sums are integers, so results don't
depend on how the table is split.

A task adds up its parts by entry, and only these sums are shuffled: 64 (d + 16) numbers a task for
vectors of d components, whatever their number.  What comes to the driver are the codebooks and
their sums, which are as small.

Rows whose vector is null or empty or holds null or non-finite components are dropped, as are those with a
component of 2**17 or more in size, whose squares a long couldn't add up, and those whose length isn't
that of the row with the smallest id.  Where 16 doesn't divide the length, zeros are added at the end.
Repeated rows are rows of their own; the smallest ids are found in the order of id (null last) and
vector.  A null label is a label.  An empty table gives an empty result.  Only vec_id,
embedding and label are read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as t
from ._graph import joined
from ._session import cut, share, table, tidy

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Size from which a component's squares no longer add up in a long.
MOST = 1 << 17
#: Entries of a block, and vectors looked at together.
ENTRY_BLOCK, ROWS = 16, 2048


def usable() -> Column:
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < MOST))
    return F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.coalesce(sound, F.lit(False))


def integers(column: pa.Array, width: int) -> np.ndarray:
    """floor(256 x) of all components, a row for each vector, with zeros up to ``width``."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    rows = np.floor(flat * SCALE).astype(np.int64).reshape(len(column), -1)
    return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x (n x d) the nearest of the entries (k x d) and its squared distance."""
    n = len(x)
    dims = np.argsort(-np.var(book.astype(np.float64), axis=0), kind="stable")
    x, book = x[:, dims], book[:, dims]
    code = np.abs(x[:, :1] - book[:, 0][None, :]).argmin(axis=1)
    best = ((x - book[code]) ** 2).sum(axis=1)
    for first in range(0, len(book), ENTRY_BLOCK):
        block = book[first : first + ENTRY_BLOCK]
        so_far = (x[:, :1] - block[:, 0][None, :]) ** 2
        row, entry = np.nonzero(so_far <= best[:, None])
        so_far = so_far[row, entry]
        for d in range(1, x.shape[1]):
            so_far = so_far + (x[row, d] - block[entry, d]) ** 2
            left = so_far <= best[row]
            row, entry, so_far = row[left], entry[left], so_far[left]
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, row, so_far)
        lowest = np.full(n, len(book))
        hit = so_far == least[row]
        np.minimum.at(lowest, row[hit], first + entry[hit])
        better = (least < best) | ((least == best) & (lowest < code))
        best, code = np.where(better, least, best), np.where(better, lowest, code)
    return code, best


def named(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code of every part of every vector (n x parts) and the vectors' errors."""
    parts, _, d = books.shape
    codes, errors = np.zeros((len(vectors), parts), np.int64), np.zeros(len(vectors), np.int64)
    for p in range(parts):
        codes[:, p], far = nearest(vectors[:, p * d : (p + 1) * d], books[p])
        errors += far
    return codes, errors


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for first in range(0, batch.num_rows, ROWS):
            some = batch.slice(first, ROWS)
            yield some, integers(some.column("embedding"), width)


def _sums(shared):
    """A row for each entry and component that has parts: slot, their number and their sum."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        parts, k, d = books.shape
        count, total = np.zeros(parts * k, np.int64), np.zeros((parts * k, d), np.int64)
        for _, vectors in _slices(batches, parts * d):
            codes, _ = named(vectors, books)
            slot = codes + np.arange(parts) * k
            count += np.bincount(slot.ravel(), minlength=parts * k)
            order = np.argsort(slot.ravel(), kind="stable")
            own, first = np.unique(slot.ravel()[order], return_index=True)
            total[own] += np.add.reduceat(vectors.reshape(-1, d)[order], first)
        used = np.flatnonzero(count)
        slot = (used[:, None] * d + np.arange(d)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(np.repeat(count[used], d)), pa.array(total[used].ravel())], ["slot", "n", "total"])

    return t.released(rows)


def _coded(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = shared.value
        for some, vectors in _slices(batches, books.shape[0] * books.shape[2]):
            codes, errors = named(vectors, books)
            text = codes.astype(np.uint8).tobytes().hex()
            step = 2 * books.shape[0]
            yield pa.RecordBatch.from_arrays([some.column("vec_id"), some.column("label"), pa.array([text[i : i + step] for i in range(0, len(text), step)], pa.string()), pa.array(errors)], ["vec_id", "label", "code", "error"])

    return t.released(rows)


def first_books(vectors: DataFrame, entries: int = ENTRIES) -> np.ndarray:
    """The parts of the vectors of the smallest ids, by part, entry and position."""
    rows = vectors.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).select("embedding").toArrow().column("embedding").combine_chunks()
    width = -(-len(rows[0]) // PARTS) * PARTS
    return integers(rows, width).reshape(len(rows), PARTS, -1).swapaxes(0, 1).copy()


def next_books(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round over all vectors."""
    shared = share(vectors.sparkSession, books)
    sums = vectors.select("embedding").mapInArrow(_sums(shared), "slot long, n long, total long")
    got = sums.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toArrow()  # as many rows as the codebooks have numbers
    out = books.reshape(-1).copy()
    slot = got.column("slot").to_numpy()
    out[slot] = got.column("total").to_numpy() // got.column("n").to_numpy()
    return out.reshape(books.shape)


CODED = "vec_id long, label long, code string, error long"


@tidy
def compressed(vectors: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, label_error and codebooks_sha256 of the usable rows of ``vectors``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.col("label").cast("long").alias("label")).filter(usable())
    length = rows.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(1).select(F.size("embedding")).collect()
    if not length:
        return spark.createDataFrame([], CODED + ", label_error long, codebooks_sha256 string")
    rows = rows.filter(F.size("embedding") == length[0][0])
    books = first_books(rows)
    for _ in range(rounds):
        books = next_books(rows, books)
    shared = share(spark, books)
    coded = cut(rows.mapInArrow(_coded(shared), CODED))
    keyed = coded.select("*", F.col("label").isNull().alias("unlabelled"), F.coalesce("label", F.lit(0)).alias("own"))
    sums = keyed.groupBy("unlabelled", "own").agg(F.sum("error").alias("label_error"))
    found = joined(keyed, sums, "unlabelled", "own")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return found.select("vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compressed(table(spark, sf_dir, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
