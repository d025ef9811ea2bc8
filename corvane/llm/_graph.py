"""Connected components of a distributed edge list, and joins of tables with hot keys."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._session import cut

#: Rows of one key from which it is joined apart, and the most such keys: the largest ones, as many
#: as can be sent to every task whatever the input; all others take the usual way.
HOT, MOST = 2_000, 10_000
#: Edges (16 bytes each) that one task may take, and rows of a table that may be sent to every task.
FEW = 500_000


def joined(rows: DataFrame, values: DataFrame, *keys: str, few: int | None = None) -> DataFrame:
    """``rows`` left-joined with ``values``, which has a row for a key at most.  The rows of hot
    keys stay where they are and the values of those keys go to them; if there are ``few`` values
    in all, they all go to the rows."""
    if few is not None and few <= FEW:
        return rows.join(F.broadcast(values), list(keys), "left")
    hot = rows.groupBy(*keys).count().filter(F.col("count") > HOT).orderBy(F.desc("count")).limit(MOST).drop("count").collect()  # MOST rows at most
    if not hot:
        return rows.join(values, list(keys), "left")
    few = F.broadcast(rows.sparkSession.createDataFrame(hot, rows.select(*keys).schema))
    own = F.broadcast(values.join(few, list(keys), "left_semi"))
    columns = [*rows.columns, *(c for c in values.columns if c not in keys)]
    apart = rows.join(few, list(keys), "left_semi").join(own, list(keys), "left").select(*columns)
    return rows.join(few, list(keys), "left_anti").join(values, list(keys), "left").select(*columns).union(apart)


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of some edges and the least node that each reaches."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = ends.reshape(2, -1)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        now = label.copy()
        for end in (a, b, label[a], label[b]):
            np.minimum.at(now, end, low)
        now = now[now]
        if (now == label).all():
            return nodes, nodes[label]
        label = now


def _edges(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b")]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the edges of a batch, one from each node to the least that it reaches by them."""
    for batch in batches:
        nodes, root = _roots(*_edges(batch))
        own = nodes != root
        yield pa.RecordBatch.from_arrays([pa.array(nodes[own]), pa.array(root[own])], ["a", "b"])


def _at_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [_edges(batch) for batch in batches]
    if parts:
        nodes, root = _roots(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(root)], ["class", "root"])


def components(edges: DataFrame) -> tuple[DataFrame, int]:
    """class, root: each node of ``edges`` (a, b longs) and the smallest node it can reach; and how
    many edges were left of them, which the nodes are twice as many as at most.

    Edges are first reduced batch by batch to one for each node.  If ``FEW`` are left at most, one
    task takes them all.  Else every round hangs larger neighbours, then smaller ones, on the
    smallest node around; the number of rounds grows with the logarithm of the longest path.
    Minima are combined before they are shuffled, so one node may have any number of edges.
    """
    now = cut(edges.filter("a <> b").select("a", "b").mapInArrow(_forest, "a long, b long").distinct())
    n = now.count()
    if n <= FEW:
        return cut(now.coalesce(1).mapInArrow(_at_once, "class long, root long")), n
    seen = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = joined(both, low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        now = cut(small.filter("a <> b").distinct())
        mark = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("a").alias("class"), F.col("b").alias("root")).union(now.select(F.col("b"), F.col("b")).distinct()), n
