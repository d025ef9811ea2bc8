"""From candidate articles to the page queue: numbering, first-wins pages, merging a cache."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls

INPUT = "row_no", "article_id", "conflict_id", "published_date", "url", "title"


class InputError(ValueError):
    """Input that breaks a declared rule."""


def pages(inputs: DataFrame) -> DataFrame:
    """One page for each address, numbered by its first row; ones that can't be fetched say so.

    Domain and status depend on the address alone, so the first row is a minimum, not a sort.
    """
    first = inputs.groupBy("url").agg(F.min("row_no").alias("row_no"), F.min_by("published_date", "row_no").alias("expected_date"))
    status = F.when(urls.admitted(F.col("url")), "pending").otherwise("invalid_url")
    return first.select("url", urls.domain(F.col("url")).alias("domain"), status.alias("status"), "row_no", "expected_date")


def status_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("status").agg(F.count("*").alias("n"))


def domain_queue(rows: DataFrame) -> DataFrame:
    """Pending domains in the order of their first page."""
    return rows.filter("status = 'pending'").groupBy("domain").agg(F.min("row_no").alias("first_row"), F.count("*").alias("pending")).orderBy("first_row")


def differences(now: DataFrame, then: DataFrame) -> DataFrame:
    """Rows of two inputs that differ at the same number, nulls counting as empty."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    fields = [c for c in INPUT if c != "row_no"]
    a, b = now.select("row_no", F.lit(True).alias("here"), *fields).alias("a"), then.select("row_no", F.lit(True).alias("there"), *fields).alias("b")
    both = a.join(b, "row_no", "full_outer")
    changed = F.lit(False)
    for c in fields:
        changed = changed | (text(F.col("a." + c)) != text(F.col("b." + c)))
    return both.filter(changed | F.col("here").isNull() | F.col("there").isNull()).select("row_no")


def merge_cache(here: DataFrame, cached: DataFrame) -> DataFrame:
    """Pages, with results taken from a cache where the page is pending here and done there."""
    results = ["status", "title", "body", "error", "fetched_at", "final_url"]
    done = cached.filter("status <> 'pending'").select("url", *(F.col(c).alias("cached_" + c) for c in results))
    if not done.filter("cached_status = 'extracted' and coalesce(cached_body, '') = ''").isEmpty():
        raise InputError("the cache holds an extracted page without a body")
    rows = here.join(done, "url", "left")
    take = (F.col("status") == "pending") & F.col("cached_status").isNotNull()
    rows = rows.select(*(c for c in here.columns if c not in (*results, "body_sha256")), *(F.when(take, F.col("cached_" + c)).otherwise(F.col(c) if c in here.columns else F.lit(None)).alias(c) for c in results), take.alias("imported"))
    return rows.withColumn("body_sha256", F.sha2(F.coalesce("body", F.lit("")), 256))
