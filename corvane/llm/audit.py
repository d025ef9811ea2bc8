"""How five filters interact: what each removes in every order of the five, from one histogram.

Every text gets a mask with one bit for each filter that it fails, by native expressions.  Four of
the filters look at the text alone; the fifth, E, asks for an equal text with a smaller doc_id
anywhere in the table, which a group-by on the texts' SHA-256 answers with the smallest id of each.
Since a filter's verdict doesn't depend on what other filters removed, the 32 counts of a part's
masks hold all there is to know: the 120 orders are then worked out from them, not from documents.

Rows are combined before each shuffle, by text and part, so a text that makes up a third of the
table is one row for each task.  No text is shuffled, only its digest.

Null texts are empty, and a null lang is the part ''.  A row without a doc_id fails E never, and is
never the smaller one; rows that repeat an id don't fail by one another.  Very long texts are
read whole, a word list of one text being all that is held.  A document is good (toxic) if one of
its rows in ``labels`` says so; those without a row, or with nulls there, are neither.  An empty table
gives an empty result.  Only doc_id, text and lang are read, and of the labels doc_id, quality and
toxic, so other columns may have any name.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._session import table

FILTERS = "ABCDE"
LEAST_WORDS = 200
SPACE = r"[\x20\x09-\x0D]+"
ORDERS = ["".join(x) for x in permutations(FILTERS)]
_BIT = {name: 1 << k for k, name in enumerate(FILTERS)}
_COUNTS = ["n", "n_good", "n_toxic"]


def text_failures() -> Column:
    """The bits of the filters that look at a text alone, A to D."""
    words = F.filter(F.split("x", SPACE), lambda w: w != "")
    n, kinds = F.size(words), F.size(F.array_distinct(words))
    failed = {"A": n < LEAST_WORDS, "B": 100 * kinds < 50 * n, "C": 100 * F.regexp_count("x", F.lit("[A-Z]")) > 3 * F.char_length("x"), "D": F.col("x").rlike(r"[#$%&*|]")}
    return sum((F.when(f, _BIT[name]).otherwise(0) for name, f in failed.items()), F.lit(0)).cast("int")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with good and toxic; those without an id have no label and are spread out."""
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    rows = rows.withColumn("lane", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)))
    found = rows.join(known.withColumn("lane", F.lit(0).cast("long")), ["doc_id", "lane"], "left").drop("lane")
    return found.fillna(False, ["good", "toxic"])


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, n_good, n_toxic: documents by the filters that they fail, 32 rows a part at most."""
    x = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"), x.alias("x"))
    rows = rows.select("doc_id", "part", F.unhex(F.sha2("x", 256)).alias("digest"), text_failures().alias("mask"))
    each = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))  # more than 1 only for rows that repeat
    kind = ["digest", "mask", "part", "good", "toxic"]
    first = F.min_by(F.struct("doc_id", "n"), "doc_id").alias("first")  # rows without an id are no candidates
    own = _labelled(each, labels).groupBy(*kind).agg(first, F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"))
    # of one text there are now as many rows as it has parts and labels, not documents
    texts = own.groupBy("digest", "mask").agg(F.min("first.doc_id").alias("least"), F.collect_list(F.struct("part", "good", "toxic", "n", "no_id", "first")).alias("own"))
    flat = texts.select("mask", "least", F.explode("own").alias("o")).select("mask", "o.*", F.when(F.col("o.first.doc_id") == F.col("least"), F.col("o.first.n")).otherwise(0).alias("leads"))
    passing = F.col("leads") + F.col("no_id")
    split = F.explode(F.array(F.struct(F.col("mask"), passing.alias("m")), F.struct((F.col("mask") + F.lit(_BIT["E"])).alias("mask"), (F.col("n") - passing).alias("m")))).alias("e")
    counted = flat.select("part", "good", "toxic", split).select("part", "good", "toxic", "e.*").filter("m > 0")
    return counted.groupBy("part", "mask").agg(F.sum("m").alias("n"), F.sum(F.when(F.col("good"), F.col("m")).otherwise(0)).alias("n_good"), F.sum(F.when(F.col("toxic"), F.col("m")).otherwise(0)).alias("n_toxic"))


def _steps() -> Column:
    """All steps of all orders, as an array: the filter's bit and those of the filters before it."""
    every = [(order, k + 1, _BIT[name], sum(_BIT[x] for x in order[:k])) for order in ORDERS for k, name in enumerate(order)]
    return F.from_json(F.lit("[" + ",".join(f'{{"filter_order":"{o}","step":{s},"bit":{b},"before":{e}}}' for o, s, b, e in every) + "]"), "array<struct<filter_order:string,step:int,bit:int,before:int>>")


def interactions(found: DataFrame) -> DataFrame:
    """From ``cells``: a row for each part, order and step."""
    parts = found.groupBy("part").agg(F.collect_list(F.struct("mask", *_COUNTS)).alias("cells"))  # 32 at most
    rows = parts.select("part", "cells", F.explode(_steps()).alias("s")).select("part", "cells", "s.*")

    def total(value, when) -> Column:
        return F.aggregate("cells", F.lit(0).cast("long"), lambda sofar, c: sofar + F.when(when(c["mask"]), value(c)).otherwise(0))

    fails = lambda mask: mask.bitwiseAND(F.col("bit")) != 0
    reached = lambda mask: mask.bitwiseAND(F.col("before")) == 0
    removed = lambda mask: fails(mask) & reached(mask)
    count = lambda name: lambda c: c[name]
    columns = {
        "kept": total(count("n"), lambda mask: reached(mask) & ~fails(mask)),
        "removed": total(count("n"), removed),
        "redundant": total(count("n"), lambda mask: fails(mask) & ~reached(mask)),
        "unique_fails": total(count("n"), lambda mask: mask == F.col("bit")),
        "good_lost": total(count("n_good"), removed),
        "toxic_lost": total(count("n_toxic"), removed),
        # a document is removed by each of the filters that it fails in as many of the orders
        "shapley": total(lambda c: c["n"] * (F.lit(len(ORDERS)) / F.greatest(F.bit_count(c["mask"]), F.lit(1))).cast("long"), fails),
    }
    return rows.select("part", "filter_order", "step", *(c.alias(name) for name, c in columns.items()))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step and the step's counts, for all orders of the five filters."""
    return interactions(cells(docs, labels))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
