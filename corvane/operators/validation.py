"""Checks of a finished run, each a table of the rows that break it (none if all is well)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import complete
from .articles import FIELDS
from .results import grouped

#: What a row of a table must not be, by name: counted in one pass over it.
ARTICLE_RULES = {"complete articles": lambda: ~complete(*(F.col(c) for c in FIELDS))}
RESULT_RULES = {"codes": lambda: F.col("usage_code").isNull() | ~F.col("usage_code").isin(0, 1, 2)}


def counted(rows: DataFrame, rules: dict) -> dict[str, int]:
    """How many rows break each rule, those that any row breaks."""
    found = rows.agg(*(F.count_if(rule()).alias(name) for name, rule in rules.items())).first()
    return {name: n for name, n in found.asDict().items() if n}


def not_equal(written: DataFrame, stored: DataFrame, ordinal: str = "n") -> DataFrame:
    """Ordinals at which a deliverable and the stored rows differ, nulls counting as empty."""
    text = lambda p, c: F.coalesce(F.col(f"{p}.{c}").cast("string"), F.lit(""))
    a, b = written.withColumn("_a", F.lit(1)).alias("a"), stored.withColumn("_b", F.lit(1)).alias("b")
    differ = F.col("_a").isNull() | F.col("_b").isNull()
    for c in written.columns:
        if c != ordinal:
            differ = differ | (text("a", c) != text("b", c))
    return a.join(b, ordinal, "full_outer").filter(differ).select(ordinal)


def incomplete(articles: DataFrame) -> DataFrame:
    return articles.filter(ARTICLE_RULES["complete articles"]()).select("article_id")


def unknown_articles(results: DataFrame, articles: DataFrame) -> DataFrame:
    return results.join(articles, "article_id", "left_anti").select("article_id", "category_id")


def bad_codes(results: DataFrame) -> DataFrame:
    return results.filter(RESULT_RULES["codes"]()).select("article_id", "category_id")


def repeated_keys(results: DataFrame) -> DataFrame:
    return results.groupBy("article_id", "category_id").count().filter("count > 1").select("article_id", "category_id")


def unknown_categories(results: DataFrame, dictionary: DataFrame) -> DataFrame:
    return results.select("category_id").distinct().join(dictionary.select("category_id").distinct(), "category_id", "left_anti")


def wrong_labels(results: DataFrame, selected: DataFrame, matches: DataFrame, decisions: DataFrame) -> DataFrame:
    """Result rows that are not what the decisions give, and what they give that is missing, each as
    often as it is too many or too few."""
    again = selected.select("article_id", "url").join(grouped(matches, decisions), "url")
    told = lambda rows, sign: rows.select("article_id", "category_id", F.col("usage_code").cast("int").alias("usage_code"), "evidence_sentence", F.lit(sign).alias("sign"))
    both = told(results, 1).union(told(again, -1)).groupBy("article_id", "category_id", "usage_code", "evidence_sentence").agg(F.sum("sign").alias("over"))
    return both.filter("over <> 0").select("article_id", "category_id", F.explode(F.sequence(F.lit(1), F.abs("over").cast("int")))).drop("col")


def undecided(matches: DataFrame, selected: DataFrame, decisions: DataFrame) -> DataFrame:
    return matches.join(selected.select("url").distinct(), "url", "left_semi").join(decisions, "match_id", "left_anti").select("match_id")


def changed(selected: DataFrame, inputs: DataFrame) -> DataFrame:
    """Selected rows that differ from the input in more than the title."""
    a, b = selected.alias("a"), inputs.alias("b")
    differ = F.lit(False)
    for c in ("article_id", "conflict_id", "published_date", "url"):
        differ = differ | F.coalesce(F.col(f"a.{c}") != F.col(f"b.{c}"), F.lit(False))
    return a.join(b, "row_no").filter(differ).select("row_no")
