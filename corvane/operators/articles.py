"""Which input rows become articles: matched, complete, and the first of their kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import complete

FIELDS = "article_id", "conflict_id", "published_date", "url", "title"


def signatures(matches: DataFrame) -> DataFrame:
    """A digest of the distinct (category, name, sentence) of each address; only equality counts."""
    found = F.array_sort(F.collect_set(F.struct("category_id", "matched_name", "sentence")))
    return matches.groupBy("url").agg(F.sha2(F.to_json(found), 256).alias("signature"))


def titled(inputs: DataFrame, pages: DataFrame) -> DataFrame:
    """Input rows of extracted pages; the page's title where it is more than spaces."""
    page = pages.filter("status = 'extracted'").select("url", F.col("title").alias("page_title"))
    rows = inputs.join(page, "url")
    return rows.select("row_no", "article_id", "conflict_id", "published_date", "url", F.when(F.trim(F.coalesce("page_title", F.lit(""))) != "", F.col("page_title")).otherwise(F.col("title")).alias("title"))


def judged(inputs: DataFrame, pages: DataFrame, matches: DataFrame) -> DataFrame:
    """Rows of matched pages with the reason that excludes them, if any, and the article kept
    instead.  The first complete row of a (conflict, normalised address, title, signature) stays."""
    rows = titled(inputs, pages).join(signatures(matches), "url").withColumn("whole", complete(*(F.col(c) for c in FIELDS)))
    key = Window.partitionBy("whole", "conflict_id", urls.normalized(F.col("url")), "title", "signature").orderBy("row_no")
    rows = rows.withColumn("nth", F.row_number().over(key)).withColumn("retained", F.first("article_id").over(key))
    reason = F.when(~F.col("whole"), "missing_required_article_field").when(F.col("nth") > 1, "same_normalized_url_conflict_title_matching_content")
    return rows.select("row_no", *FIELDS, reason.alias("reason"), F.when(F.col("whole") & (F.col("nth") > 1), F.col("retained")).alias("retained_article_id"))


def selected(rows: DataFrame) -> DataFrame:
    return rows.filter("reason is null").select("row_no", *FIELDS)


def exclusions(rows: DataFrame) -> DataFrame:
    return rows.filter("reason is not null").select("row_no", "article_id", "reason", "retained_article_id")
