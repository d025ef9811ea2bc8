"""Approximate nearest neighbours by inner product: a hierarchical k-means tree, searched best bin
first.

Inner product becomes distance by one more component, which brings every vector to the largest
length.  The tree is fitted on ``SAMPLE`` vectors at most, chosen by a hash of their id, and every
vector is then put into the leaf it descends to.  A query takes nodes from a priority queue by
the distance of their centres and so visits leaves in order of promise.

How many leaves it visits is calibrated: ``CALIBRATION`` queries are compared with all vectors,
and visits are widened until the leaves visited hold ``RECALL`` of the true neighbours.

Leaves in a row are put together to blocks of vectors, and a leaf beyond a block's size is split.  A
query travels once to each block it visits a leaf of, with the leaves it visits as bits, so neither it nor
a task's memory grows with the number of leaves; blocks of vectors and of queries hold ``BLOCK_BYTES`` of
components at most.  Inside, leaf by leaf, vectors and the queries that visit them are compared by matrix
product; each block sends on the k best of each query that reach the query's floor, which is its k-th best
score among the sample's vectors in the leaves it visits: what lies below can't be among the k
best it finds.  Scores are sums of products in double precision in
one fixed order, so equal vectors tie, and ties go to the smaller id.

Vectors that are null, zero, of another length than most or hold null or non-finite components
take no part; nor do rows without an id.  Repeated ids are candidates of their own, except to
queries of that id, which are asked once.  With k candidates or fewer all are returned.  An empty
table gives an empty result.  Only vec_id and embedding are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._session import cut, share, shuffle_width, table, tidy

K = 20
#: Vectors the tree is fitted on, children of a node, vectors a leaf is meant to hold, most leaves.
SAMPLE, BRANCH, LEAF, LEAVES = 16_384, 16, 200, 4096
#: Queries compared with all vectors to calibrate visits, and the recall visits are widened to.
CALIBRATION, RECALL = 64, 0.97
#: Bytes of the vectors, and of the queries, of one block at most; vectors that are worth a block of their own.
BLOCK_BYTES, LEAST_BLOCK = 1 << 24, 512
#: Queries that are walked or compared together, products held at once, and components.
CHUNK, PRODUCTS, COMPONENTS = 256, 1 << 19, 1 << 22
ROUNDS, SEED = 8, 5


@dataclass
class Tree:
    """Nodes by number; node 0 is the root.  A leaf has no children but a leaf number."""

    centres: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)
    leaves: int = 0

    def arrays(self) -> None:
        self.of = [np.array([self.centres[c] for c in own]) if own else None for own in self.children]

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.zeros(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
                continue
            near = _nearest(x[rows], self.of[node])
            todo += [(c, rows[near == i]) for i, c in enumerate(self.children[node]) if (near == i).any()]
        return out

    def visits(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in the order in which a query takes them from the queue."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            while self.children[node]:  # descend to the nearest child, queue the others
                far = ((self.of[node] - q) ** 2).sum(axis=1)
                best = int(far.argmin())
                for i, c in enumerate(self.children[node]):
                    if i != best:
                        heapq.heappush(queue, (float(far[i]), c))
                node = self.children[node][best]
            yield self.leaf[node]


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)


def fit(x: np.ndarray, leaf: float, seed: int = SEED) -> Tree:
    """k-means within k-means, until a node holds ``leaf`` vectors of the sample or fewer."""
    rng, tree = np.random.default_rng(seed), Tree()

    def grow(rows: np.ndarray, centre: np.ndarray) -> int:
        node = len(tree.centres)
        tree.centres.append(centre)
        tree.children.append([])
        tree.leaf.append(-1)
        own = x[rows]
        k = int(min(BRANCH, np.ceil(len(rows) / max(leaf, 1))))
        if k > 1 and len(distinct := np.unique(own, axis=0)) > 1:
            k = min(k, len(distinct))
            centres = distinct[rng.choice(len(distinct), k, replace=False)]
            for _ in range(ROUNDS):
                near = _nearest(own, centres)
                centres = np.array([own[near == i].mean(axis=0) if (near == i).any() else centres[i] for i in range(k)])
            near = _nearest(own, centres)
            parts = [(rows[near == i], centres[i]) for i in range(k) if (near == i).any()]
            if len(parts) > 1:
                tree.children[node] = [grow(*p) for p in parts]
        if not tree.children[node]:
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
        return node

    grow(np.arange(len(x)), x.mean(axis=0) if len(x) else np.zeros(x.shape[1]))
    tree.arrays()
    return tree


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)


def _floors(q: np.ndarray, own: np.ndarray, visited: np.ndarray, x: np.ndarray, ids: np.ndarray, leaf: np.ndarray, k: int) -> np.ndarray:
    """A score that the k best of each query reach: the k-th best of a sample's vectors in the
    leaves it visits, less rounding."""
    if len(x) <= k:
        return np.full(len(q), -np.inf)
    scores = q @ x.T
    scores[(own[:, None] == ids[None]) | ~visited[:, leaf]] = -np.inf
    kth = np.partition(scores, len(x) - k, axis=1)[:, len(x) - k]
    return np.where(np.isfinite(kth), kth - 1e-9 * (1 + np.abs(kth)), -np.inf)


def _best(ids: np.ndarray, x: np.ndarray, own: np.ndarray, q: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries, vectors and scores of the k best of x for each query that reach its floor; scores
    are summed in a fixed order."""
    row, column = np.nonzero((q @ x.T >= floor[:, None]) & (own[:, None] != ids[None]))
    step = max(1, COMPONENTS // x.shape[1])
    exact = np.concatenate([(q[row[i : i + step]] * x[column[i : i + step]]).sum(axis=1) for i in range(0, len(row), step)] or [np.zeros(0)])
    return _kept(own[row], ids[column], exact, k)


def _kept(own: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best of each query, ties to the smaller id."""
    order = np.lexsort((ids, -scores, own))
    own, ids, scores = own[order], ids[order], scores[order]
    nth = np.arange(len(own)) - np.searchsorted(own, own)
    return own[nth < k], ids[nth < k], scores[nth < k]


def _compared(ids: np.ndarray, x: np.ndarray, leaf: np.ndarray, own: np.ndarray, q: np.ndarray, floor: np.ndarray, visited: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Queries, vectors and scores of the k best of a block's vectors in the leaves that each query visits (bits)."""
    order = np.argsort(leaf, kind="stable")
    numbers, starts = np.unique(leaf[order], return_index=True)
    parts = list(zip(numbers, np.split(order, starts[1:]), strict=True))
    found = []
    for at in range(0, len(own), CHUNK):
        seen, near = np.unpackbits(visited[at : at + CHUNK], axis=1), []
        for number, rows in parts:
            asking = at + np.flatnonzero(seen[:, number])
            step = max(1, PRODUCTS // len(rows))
            near += [_best(ids[rows], x[rows], own[a], q[a], floor[a], k) for a in (asking[i : i + step] for i in range(0, len(asking), step))]
        if near:
            found.append(_kept(*map(np.concatenate, zip(*near, strict=True)), k))
    return tuple(map(np.concatenate, zip(*found, strict=True))) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _blocks(held: dict[int, int], size: int) -> list[tuple[int, int, int]]:
    """leaf, its first block and how many it has: leaves in a row share a block of ``size`` vectors, a
    larger one is split."""
    out, block, load = [], 0, 0
    for number in sorted(held):
        if load and load + held[number] > size:
            block, load = block + 1, 0
        pieces = -(-held[number] // size)
        out.append((number, block, pieces))
        block, load = (block + pieces, 0) if pieces > 1 else (block, load + held[number])
    return out


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """vec_id and embedding (doubles) of the rows that take part, and their length."""
    e = F.col("embedding").cast("array<double>")
    fine = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(e, lambda v: v != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("embedding")).filter(F.col("vec_id").isNotNull() & fine)
    sizes = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = sizes[0]["d"] if sizes else 1
    return rows.filter(F.size("embedding") == d), d


@tidy
def search(vectors: DataFrame, queries: DataFrame, k: int = K, leaf: int = LEAF, recall: float = RECALL, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """query_id, rank, vec_id and score: the k best vectors found for each of ``queries``
    (vec_id, embedding)."""
    spark = vectors.sparkSession
    rows, d = usable(vectors)
    length = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v))
    n, top = rows.agg(F.count("*"), F.max(length)).first()
    top = top or 0.0
    pick = lambda seed, m: rows.orderBy(F.xxhash64("vec_id", F.lit(seed)), "vec_id").limit(m).collect()
    picked = pick(SEED, SAMPLE)
    sample, sample_ids = np.array([x["embedding"] for x in picked], np.float64).reshape(-1, d), np.array([x["vec_id"] for x in picked], np.int64)

    def lifted(x: np.ndarray) -> np.ndarray:
        return np.column_stack([x, np.sqrt(np.maximum(top * top - (x * x).sum(axis=1), 0))])

    wanted = max(1, min(LEAVES, n // leaf))
    tree = fit(lifted(sample), len(sample) / wanted)
    shared = share(spark, tree)
    known = share(spark, (sample, sample_ids, tree.place(lifted(sample))))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("embedding"), pa.array(shared.value.place(lifted(_matrix(b.column("embedding"), d))))], ["vec_id", "embedding", "leaf"])

    placed = cut(rows.mapInArrow(put, "vec_id long, embedding array<double>, leaf long"))
    held = {x["leaf"]: x["count"] for x in placed.groupBy("leaf").count().collect()}  # LEAVES rows at most
    visits = _calibrated(placed, [(x["vec_id"], np.array(x["embedding"])) for x in pick(SEED + 1, CALIBRATION)], shared.value, held, d, k, recall) if n > k + 1 else shared.value.leaves

    most = max(1, block_bytes // (8 * d))
    layout = _blocks(held, min(most, max(LEAST_BLOCK, -(-n // (2 * shuffle_width(spark))))))
    ends = np.array(sorted((first + i, number) for number, first, pieces in layout for i in range(pieces)), np.int64).reshape(-1, 2)  # block, leaf
    blocks, starts = np.unique(ends[:, 0], return_index=True)

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(a, CHUNK) for whole in batches for a in range(0, whole.num_rows, CHUNK)):
            asking, own = _matrix(b.column("embedding"), d), np.array(b.column("vec_id"), np.int64)
            visited = np.full((len(own), shared.value.leaves), visits >= shared.value.leaves)
            for i, q in enumerate(asking if visits < shared.value.leaves else []):
                seen = 0
                for nth, number in enumerate(shared.value.visits(np.append(q, 0.0))):
                    if nth >= visits and seen > k:
                        break
                    seen += held.get(number, 0)
                    visited[i, number] = True
            reached = np.logical_or.reduceat(visited[:, ends[:, 1]], starts, axis=1) if len(blocks) else np.zeros((len(own), 0), bool)
            to = pa.ListArray.from_arrays(pa.array(np.append(0, reached.sum(axis=1).cumsum()), pa.int32()), pa.array(blocks[np.nonzero(reached)[1]], pa.int64()))
            bits = pa.array([x.tobytes() for x in np.packbits(visited, axis=1)], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("embedding"), pa.array(_floors(asking, own, visited, *known.value, k)), bits, to], ["query_id", "query", "floor", "visited", "blocks"])

    ask, _ = usable(queries) if queries is not vectors else (rows, d)
    # by number, so that the walks through the tree aren't put together in a few tasks
    ask = ask.filter(F.size("embedding") == d).dropDuplicates(["vec_id"]).repartition(shuffle_width(spark), "vec_id")
    ask = cut(ask.mapInArrow(asked, "query_id long, query array<double>, floor double, visited binary, blocks array<long>"))
    loads = ask.select(F.explode("blocks").alias("block")).groupBy("block").agg(F.ceil(F.count("*") / most).alias("parts"))
    loads = F.broadcast(loads)  # a row for each block
    places = F.broadcast(spark.createDataFrame(layout, "leaf long, first long, pieces long"))  # LEAVES rows at most
    left = placed.join(places, "leaf").select((F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("pieces"))).alias("block"), "leaf", "vec_id", "embedding")
    left = left.join(loads, "block").select("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "leaf", "vec_id", "embedding")
    right = ask.select("query_id", "query", "floor", "visited", F.explode("blocks").alias("block")).join(loads, "block")
    right = right.select("block", F.pmod(F.xxhash64("query_id"), F.col("parts")).alias("part"), "query_id", "query", "floor", "visited")

    def compared(key, a: pa.Table, b: pa.Table) -> pa.Table:
        bits = np.frombuffer(b"".join(b.column("visited").to_pylist()), np.uint8).reshape(b.num_rows, -(-shared.value.leaves // 8))
        of = lambda t, name: t.column(name).to_numpy()
        found = _compared(of(a, "vec_id"), _matrix(a.column("embedding"), d), of(a, "leaf"), of(b, "query_id"), _matrix(b.column("query"), d), of(b, "floor"), bits, k)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), found, strict=True)))

    keys = ["block", "part"]
    pairs = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compared, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return pairs.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _calibrated(placed: DataFrame, queries: list[tuple[int, np.ndarray]], tree: Tree, held: dict[int, int], d: int, k: int, recall: float) -> int:
    """Leaves to visit so that these queries find ``recall`` of their true neighbours."""

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, x, leaf = np.array(b.column("vec_id")), _matrix(b.column("embedding"), d), np.array(b.column("leaf"))
            for own, q in queries:
                rough = np.where(ids != own, x @ q, -np.inf)
                best = np.lexsort((ids, -rough))[:k]
                yield pa.RecordBatch.from_arrays([pa.array([own] * len(best), pa.int64()), pa.array(rough[best]), pa.array(ids[best], pa.int64()), pa.array(leaf[best], pa.int64())], ["query_id", "score", "vec_id", "leaf"])

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    true = placed.mapInArrow(exact, "query_id long, score double, vec_id long, leaf long").withColumn("rank", rank).filter(F.col("rank") <= k).collect()  # k rows a query
    nth = {(own, number): i for own, q in queries for i, number in enumerate(tree.visits(np.append(q, 0.0)))}
    when = np.sort([nth[x["query_id"], x["leaf"]] for x in true])
    return int(when[min(len(when) - 1, int(np.ceil(recall * len(when))) - 1)]) + 1


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter("vec_id % 20 = 0"))
