"""Training-order materialisation: every sequence gets a global slot by a keyed permutation.

Texts become token ids, each closed by an end id; a task lays its documents end to end and cuts
them into sequences of equal length, the last one filled up with end ids.  Sequences are numbered
by task and place (per-task counts, summed up), and a Feistel network keyed by a seed maps a
number to a slot: it permutes the next power of four, and walks on along its cycle until the slot
is one of the sequences'.  So the order needs no shuffled list and any slot can be computed alone.

Range partitions of slots, as many whole shards in one as in any other or one less, then hold fixed-stride shards: sequence s lies at
``(s % shard) * stride`` of shard ``s // shard``, so readers go through shards in order and resume
anywhere by arithmetic.  Shard files are written under a temporary name and renamed, so a task that
runs again replaces its own files.

A very long text goes on from sequence to sequence.  Null and empty texts are the end id alone.  Ids beyond two bytes are refused.  Repeated rows are documents of their own.  An empty
table gives no sequence.  Only doc_id and text are read.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as t
from ._session import folder, lazily, shuffle_width, table
from ._tokens import default_path, encoder

LENGTH, SHARD, END = 2048, 1024, 50256
KEY, ROUNDS = 0xC0FFEE, 4
TYPE = "<u2"


def feistel(x: np.ndarray, n: int, key: int = KEY, back: bool = False) -> np.ndarray:
    """The slot of each number below n, or with ``back`` the number of each slot."""
    half = t.U64(max(1, -(-max(n - 1, 1).bit_length() // 2)))
    mask = (t.U64(1) << half) - t.U64(1)
    keys = [t.mix(np.array([key * 1_000_003 + r], t.U64)) for r in range(ROUNDS)]
    out = np.array(x, t.U64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> half, out[todo] & mask
        for k in reversed(keys) if back else keys:
            if back:
                left, right = right ^ (t.mix(left ^ k) & mask), left
            else:
                left, right = right, left ^ (t.mix(right ^ k) & mask)
        out[todo] = (left << half) | right
        todo = todo[out[todo] >= t.U64(n)]
    return out.astype(np.int64)


def _sequences(path: str, length: int, end: int):
    """Rows (task, nth, doc_ids, n_tokens, ids_crc32, packed): a task's sequences in order."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        tokens, pack = encoder(path), zstandard.ZstdCompressor(level=3).compress
        most = np.iinfo(TYPE).max
        if end > most:
            raise ValueError(f"the closing id {end} is over {most}")
        task = TaskContext.get().partitionId()
        rest, owners, nth = np.zeros(0, TYPE), [], 0  # owners: (id, where its tokens start)
        close = np.array([end], TYPE)

        def cut(ids: np.ndarray, owners: list, last: bool):
            nonlocal nth
            out, at = [], 0
            starts = np.array([s for _, s in owners], np.int64)
            while len(ids) - at >= length or (last and at < len(ids)):
                own = ids[at : at + length]
                a, b = np.searchsorted(starts, at, "right") - 1, np.searchsorted(starts, at + len(own), "left")
                full = own if len(own) == length else np.concatenate([own, np.full(length - len(own), end, TYPE)])
                out.append((task, nth, [i for i, _ in owners[a:b]], len(own), zlib.crc32(full.astype("<u4")), pack(full.tobytes())))
                nth += 1
                at += length
            kept = owners[max(0, int(np.searchsorted(starts, at, "right")) - 1) :] if at < len(ids) else []
            return out, ids[at:], [(i, s - at) for i, s in kept]

        def batch_of(out: list) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["task", "nth", "doc_ids", "n_tokens", "ids_crc32", "packed"])

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for block in t.blocks(batch.column("text"), 1 << 20):
                parts, at = [rest], len(rest)
                for i, own in enumerate(tokens.encode(block)):
                    if len(own) and int(own.max()) > most:
                        raise ValueError(f"the tokenizer's id {int(own.max())} is over {most}, which two bytes can't hold")
                    owners.append((names[block.first + i], at))
                    parts += [own.astype(TYPE), close]
                    at += len(own) + 1
                out, rest, owners = cut(np.concatenate(parts), owners, False)
                if out:
                    yield batch_of(out)
        out, *_ = cut(rest, owners, True)
        if out:
            yield batch_of(out)

    return t.released(rows)


@lazily
def in_training_order(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, shard: int = SHARD, key: int = KEY, end: int = END) -> DataFrame:
    """A row for each sequence, in range partitions of whole shards and sorted by slot: slot,
    shard, byte_offset, doc_ids, n_tokens, ids_crc32 and tokens (16-bit little-endian ids)."""
    spark = docs.sparkSession
    text = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    written = folder(spark, "sequences") + "/table"
    cut = text.mapInArrow(_sequences(tokenizer or default_path(), length, end), "task int, nth long, doc_ids array<long>, n_tokens int, ids_crc32 long, packed binary")
    cut.write.option("compression", "none").parquet(written)
    cut = spark.read.schema(cut.schema).parquet(written)
    counts = sorted((x["task"], x["count"]) for x in cut.groupBy("task").count().collect())  # one row for each task
    first = dict(zip([k for k, _ in counts], np.cumsum([0, *(n for _, n in counts)]).tolist(), strict=False))
    total = sum(n for _, n in counts)

    @F.pandas_udf("long")
    def slot(task: pd.Series, nth: pd.Series) -> pd.Series:
        return pd.Series(feistel((task.map(first) + nth).to_numpy(), total, key))

    @F.pandas_udf("binary")
    def unpacked(x: pd.Series) -> pd.Series:
        import zstandard

        return x.map(zstandard.ZstdDecompressor().decompress)

    stride = length * np.dtype(TYPE).itemsize
    placed = cut.withColumn("slot", slot("task", "nth")).withColumn("shard", F.expr(f"slot div {shard}")).drop("task", "nth")
    shards = max(1, -(-total // shard))
    ranges = min(shuffle_width(spark), shards)  # known beforehand, so nothing is read to sample them
    placed = placed.repartitionById(ranges, F.expr(f"int(shard * {ranges} div {shards})")).sortWithinPartitions("slot")
    return placed.select("slot", "shard", (F.col("slot") % shard * stride).alias("byte_offset"), "doc_ids", "n_tokens", "ids_crc32", unpacked("packed").alias("tokens"))


def write_shards(ordered: DataFrame, folder: str) -> DataFrame:
    """Writes each shard of ``in_training_order`` as ``folder``/shard-<number>.bin and returns
    shard, first_slot and sequences.  The folder is a URI that all executors can write to."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder)
        now, out, first, n = None, None, 0, 0

        def close():
            out.close()
            store.move(f"{root}/.shard-{now:08d}.{token}", f"{root}/shard-{now:08d}.bin")
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([first], pa.int64()), pa.array([n], pa.int64())], ["shard", "first_slot", "sequences"])

        token = uuid.uuid4().hex
        store.create_dir(root, recursive=True)
        for batch in batches:
            for shard, slot, tokens in zip(batch.column("shard").to_pylist(), batch.column("slot").to_pylist(), batch.column("tokens"), strict=True):
                if shard != now:
                    if out is not None:
                        yield close()
                    now, first, n = shard, slot, 0
                    out = store.open_output_stream(f"{root}/.shard-{shard:08d}.{token}")
                out.write(tokens.as_buffer())
                n += 1
        if out is not None:
            yield close()

    return ordered.mapInArrow(rows, "shard long, first_slot long, sequences long")


def read_from(folder: str, slot: int, count: int, length: int = LENGTH, shard: int = SHARD) -> Iterator[np.ndarray]:
    """``count`` sequences from a slot on, in training order."""
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(folder)
    stride = length * np.dtype(TYPE).itemsize
    for number in range(slot // shard, (slot + count - 1) // shard + 1 if count else 0):
        a, b = max(slot, number * shard), min(slot + count, (number + 1) * shard)
        with store.open_input_file(f"{root}/shard-{number:08d}.bin") as file:
            file.seek((a - number * shard) * stride)
            data = file.read((b - a) * stride)
        yield from np.frombuffer(data, TYPE).reshape(-1, length)


def op9_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_training_order(table(spark, sf_dir, "documents"))
