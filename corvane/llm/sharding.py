"""Sharding: contiguous shards of nearly equal bytes, from global prefix sums of sizes.

Documents are ordered by (doc_id, size, checksum), null ids first, and dealt to range partitions.
Each partition's total is taken, the totals are summed up in order, and every document so learns
the byte and the row at which it starts in the whole corpus.  Shard k takes the documents whose
middle byte lies in the k-th of equal parts, so a shard's bytes miss their target by one document
at most.

A text longer than a shard's target has its middle byte in one shard and goes there whole.  A null or empty text has no bytes of its own but still costs ``OVERHEAD``.  Repeated rows are
rows of their own.  An empty table gives an empty result.  Only doc_id and text are read, so
other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._session import cut, lazily, shuffle_width, table

SHARDS = 24
OVERHEAD = 8


def positions(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and where each row starts: start_byte, start_row, of all_bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    order = ["doc_id", "size", "text_crc32"]
    # the last key splits rows that are wholly equal
    dealt = slim.withColumn("nth", F.monotonically_increasing_id()).repartitionByRange(shuffle_width(docs.sparkSession), *order, "nth")
    dealt = cut(dealt.withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    totals = dealt.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count("*").alias("part_rows"))  # one row for each partition
    totals = totals.select("part", F.coalesce(F.sum("part_bytes").over(before), F.lit(0)).alias("byte_0"), F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("row_0"), F.sum("part_bytes").over(whole).alias("all_bytes"))
    inside = Window.partitionBy("part").orderBy(*order, "nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = dealt.withColumn("upto", F.sum("size").over(inside)).withColumn("nth_here", F.row_number().over(inside))
    return run.join(F.broadcast(totals), "part").select(*order, (F.col("byte_0") + F.col("upto") - F.col("size")).alias("start_byte"), (F.col("row_0") + F.col("nth_here") - 1).alias("start_row"), "all_bytes")


@lazily
def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and the document's slot in its shard."""
    placed = positions(docs).withColumn("shard", F.expr(f"cast(least({shards} - 1, (2 * start_byte + size) * {shards} div (2 * all_bytes)) as int)"))
    firsts = placed.groupBy("shard").agg(F.min("start_row").alias("row_0"))  # as many rows as shards
    return placed.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("start_row") - F.col("row_0")).alias("slot"), "start_byte")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
