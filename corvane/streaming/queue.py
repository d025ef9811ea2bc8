"""The page queue as a stream: snapshots of new pages are drained, batch by batch, into results.

Runs with a checkpoint and an ``availableNow`` trigger, so a rerun takes only what is new; every
batch is written under its own number, so one that is repeated replaces itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import acquire

PAGES = "url string, domain string, status string, row_no long, expected_date string"


def fetch_batch(batch: DataFrame) -> DataFrame:
    """A batch fetched whole, its domains in turn; robots answers and pauses hold inside it."""
    nothing = batch.sparkSession.createDataFrame([], "origin string, domain string, robots_at double, robots_status int, robots_body string, hit_at double")
    n = batch.count()
    return acquire.fetch_all(acquire.known(acquire.wave(batch, n, n), nothing))


def drain(spark: SparkSession, queue: str, out: str, checkpoint: str, fetch: Callable[[DataFrame], DataFrame] = fetch_batch, files_per_batch: int = 1) -> None:
    """Fetches the pending pages of every snapshot file in ``queue`` that wasn't taken before."""

    def commit(batch: DataFrame, number: int) -> None:
        fetch(batch.filter("status = 'pending'").dropDuplicates(["url"])).write.mode("overwrite").parquet(f"{out}/batch={number}")

    pages = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(queue)
    pages.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
