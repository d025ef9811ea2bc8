"""From decisions to results: the strongest label of each address and category, with evidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT = "article_id", "category_id", "usage_code", "evidence_sentence"


def grouped(matches: DataFrame, decisions: DataFrame) -> DataFrame:
    """url, category_id, usage_code (the smallest) and its sentences, each once, in text order."""
    rows = matches.join(decisions.filter("usage_code is not null").select("match_id", "usage_code"), "match_id")
    # one row for each sentence first: map-side, so that a page with many matches stays small
    rows = rows.groupBy("url", "category_id", "usage_code", "sentence").agg(F.min(F.struct("sentence_no", "match_id")).alias("at"))
    best = rows.groupBy("url", "category_id").agg(F.min("usage_code").alias("usage_code"))
    kept = rows.join(best, ["url", "category_id", "usage_code"])
    told = F.array_sort(F.collect_list(F.struct("at", "sentence")))
    return kept.groupBy("url", "category_id", "usage_code").agg(F.array_join(F.transform(told, lambda x: x["sentence"]), "\n").alias("evidence_sentence"))


def results(selected: DataFrame, labels: DataFrame) -> DataFrame:
    """A result row for each selected article and category of its address."""
    return selected.select("row_no", "article_id", "url").join(labels, "url").select("row_no", *RESULT)


def in_result_order(rows: DataFrame) -> DataFrame:
    return rows.orderBy("row_no", "category_id").select(*RESULT)
