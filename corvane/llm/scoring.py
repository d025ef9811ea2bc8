"""LM scoring by masked pseudo-likelihood: a bidirectional window network, trained in numpy.

Words fall into ``BUCKETS`` by hash.  From the ``SIDE`` words on either side of a place (the place
itself being masked), the network gives a distribution over word classes; a word's probability is
its class's times its share of that class's words.  Classes cut the buckets, in order of their
counts over all documents, into parts of equal mass.

Every task trains the network on all its documents (each word is predicted once), from the same
first parameters, and the tasks' parameters are averaged by the words they trained on: one round of
parameter mixing.  A document's score is the
sum over all its words of the logarithm of the probability from both sides.

A very long text is trained on and scored whole, some thousand words at a time.  Null and empty texts have no words, score 0 and no mean.  Repeated rows score the same.  An empty
table gives an empty result.  Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as t
from ._session import cut, share, table, tidy

BUCKETS, CLASSES, SIDE, WIDTH = 4096, 64, 2, 24
BATCH, RATE, SEED = 2048, 0.1, 3
#: Bytes of parameters in one row, and lanes of the first step of averaging.
CHUNK, LANES = 1 << 17, 32
_OFFSETS = [k for k in range(-SIDE, SIDE + 1) if k]


def _bucketed(block: t.Block) -> tuple[t.Words, np.ndarray]:
    words = t.words(block)
    hashes = t.span_hash(block.data, words.start, words.end, lower=True)
    return words, (hashes >> t.U64(52)).astype(np.int64) % BUCKETS


def _context(words: t.Words, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The buckets around each place; BUCKETS stands for places beyond the text."""
    out = np.full((len(_OFFSETS), len(at)), BUCKETS, np.int64)
    low, high = words.at[words.doc[at]], words.at[words.doc[at] + 1]
    for row, k in zip(out, _OFFSETS, strict=True):
        ok = (at + k >= low) & (at + k < high)
        row[ok] = ids[at[ok] + k]
    return out


class Network:
    """tanh of summed context vectors, then a softmax over classes."""

    def __init__(self, values: np.ndarray | None = None):
        shapes = [(len(_OFFSETS), BUCKETS + 1, WIDTH), (WIDTH,), (WIDTH, CLASSES), (CLASSES,)]
        sizes = [int(np.prod(s)) for s in shapes]
        if values is None:
            values = np.random.default_rng(SEED).normal(0, 0.1, sum(sizes)).astype(np.float32)
        self.values = values
        ends = np.cumsum([0, *sizes])
        self.embed, self.shift, self.out, self.bias = (values[a:b].reshape(s) for a, b, s in zip(ends[:-1], ends[1:], shapes, strict=True))

    def hidden(self, context: np.ndarray) -> np.ndarray:
        total = np.repeat(self.shift[None], context.shape[1], 0)
        for e, row in zip(self.embed, context, strict=True):
            total += e[row]
        return np.tanh(total)

    def log_probabilities(self, hidden: np.ndarray) -> np.ndarray:
        z = hidden @ self.out + self.bias
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


class Trainer:
    """AdaGrad on batches of places."""

    def __init__(self):
        self.net, self.places = Network(np.array(Network().values)), 0
        self.seen = Network(np.full_like(self.net.values, 1e-4))

    def _step(self, name: str, g: np.ndarray) -> None:
        seen, value = getattr(self.seen, name), getattr(self.net, name)
        seen += g * g
        value -= RATE * g / np.sqrt(seen)

    def learn(self, context: np.ndarray, goal: np.ndarray) -> None:
        net, n = self.net, len(goal)
        h = net.hidden(context)
        d = np.exp(net.log_probabilities(h))
        d[np.arange(n), goal] -= 1
        d /= n
        back = (d @ net.out.T) * (1 - h * h)
        self._step("out", h.T @ d)
        self._step("bias", d.sum(axis=0))
        self._step("shift", back.sum(axis=0))
        for k, row in enumerate(context):
            order = np.argsort(row, kind="stable")
            used, first = np.unique(row[order], return_index=True)
            g = np.add.reduceat(back[order], first, axis=0)
            seen = self.seen.embed[k][used] + g * g
            self.seen.embed[k][used] = seen
            net.embed[k][used] -= RATE * g / np.sqrt(seen)
        self.places += n


@t.released
def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for block in t.blocks(batch.column("text")):
            total += np.bincount(_bucketed(block)[1], minlength=BUCKETS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(total)], ["bucket", "n"])


def classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The class of each bucket, and the logarithm of the bucket's share of its class."""
    order = np.argsort(-counts, kind="stable")
    mass = counts[order] + 1.0  # every bucket has some chance
    middle = np.cumsum(mass) - mass / 2
    of = np.empty(BUCKETS, np.int64)
    of[order] = np.minimum((middle / mass.sum() * CLASSES).astype(np.int64), CLASSES - 1)
    whole = np.bincount(of, weights=counts + 1.0, minlength=CLASSES)
    return of, np.log((counts + 1.0) / whole[of])


def _trained(of: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, kept, held = Trainer(), [], 0
        for batch in batches:
            for block in t.blocks(batch.column("text")):
                words, ids = _bucketed(block)
                if not len(ids):
                    continue
                kept.append((_context(words, ids, np.arange(len(ids))), of[ids]))
                held += len(ids)
                if held >= BATCH:
                    context, goal = np.concatenate([c for c, _ in kept], axis=1), np.concatenate([g for _, g in kept])
                    whole = len(goal) // BATCH * BATCH
                    for a in range(0, whole, BATCH):
                        trainer.learn(context[:, a : a + BATCH], goal[a : a + BATCH])
                    kept, held = [(context[:, whole:], goal[whole:])], len(goal) - whole
        if held:
            trainer.learn(np.concatenate([c for c, _ in kept], axis=1), np.concatenate([g for _, g in kept]))
        if trainer.places:
            raw = (trainer.net.values.astype(np.float64) * trainer.places).astype(np.float32).tobytes()
            parts = [raw[a : a + CHUNK] for a in range(0, len(raw), CHUNK)]
            n, task = len(parts), TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array([task] * n, pa.int32()), pa.array([trainer.places] * n, pa.int64()), pa.array(parts, pa.binary())], ["chunk", "task", "places", "part"])

    return t.released(rows)


def _summed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("task")  # the same order every time
    total = np.zeros(len(rows["part"].iloc[0]) // 4)
    for x in rows["part"]:
        total += np.frombuffer(x, np.float32)
    return pd.DataFrame({"chunk": [key[0]], "task": [rows["task"].min()], "places": [rows["places"].sum()], "part": [total.astype(np.float32).tobytes()]})


def train(docs: DataFrame) -> tuple[Network, np.ndarray, np.ndarray]:
    """The network, the class of each bucket and the log share of each bucket in its class."""
    counts = np.zeros(BUCKETS, np.int64)
    for x in docs.select("text").mapInArrow(_counts, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows
        counts[x["bucket"]] = x["n"]
    of, share = classes(counts)
    schema = "chunk int, task int, places long, part binary"
    parts = cut(docs.select("text").mapInArrow(_trained(of), schema))
    parts = parts.groupBy("chunk", (F.col("task") % LANES).alias("lane")).applyInPandas(_summed, schema)
    parts = sorted(parts.groupBy("chunk").applyInPandas(_summed, schema).collect(), key=lambda x: x["chunk"])  # the parameters once
    if not parts:
        return Network(), of, share
    total = np.concatenate([np.frombuffer(x["part"], np.float32) for x in parts]).astype(np.float64)
    return Network((total / parts[0]["places"]).astype(np.float32)), of, share


def log_likelihood(block: t.Block, net: Network, of: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of each document of a block and the sum of their log probabilities."""
    words, ids = _bucketed(block)
    scores = np.zeros(len(ids))
    for a in range(0, len(ids), 1 << 15):
        at = np.arange(a, min(a + (1 << 15), len(ids)))
        own = ids[at]
        scores[at] = net.log_probabilities(net.hidden(_context(words, ids, at)))[np.arange(len(at)), of[own]] + share[own]
    # of no words at all, bincount gives integers
    return np.diff(words.at), np.bincount(words.doc, weights=scores, minlength=block.rows).astype(np.float64)


@tidy
def score(docs: DataFrame, model: tuple[Network, np.ndarray, np.ndarray] | None = None) -> DataFrame:
    """doc_id, n_words, log_likelihood and its mean over the words of each of ``docs``."""
    model = model or train(docs)
    shared = share(docs.sparkSession, (model[0].values, model[1], model[2]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, of, share = shared.value
        net = Network(values)
        for batch in batches:
            for block in t.blocks(batch.column("text")):
                n, total = log_likelihood(block, net, of, share)
                mean = pa.array(total / np.maximum(n, 1), mask=n == 0)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(block.first, block.rows), pa.array(n), pa.array(total), mean], ["doc_id", "n_words", "log_likelihood", "mean_log_likelihood"])

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(t.released(rows), "doc_id long, n_words long, log_likelihood double, mean_log_likelihood double")


def op5_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
