"""Dictionary terms in sentences.

``locate`` finds every bounded occurrence of every term.  A text is cut once, by one fixed expression, into its tokens and
what lies between them; a term likewise.  Tokens inside a bounded occurrence are whole tokens of the
text, so an occurrence starts, but for marks in front, with a piece that equals the term's first
token: that piece finds the term in the dictionary, and the term's other pieces are held against the
ones that follow.  No expression is made for a term, and the work is a look-up for each
token of a text and a comparison for each term that starts with it.  Whether the dictionary is sent to all tasks is
left to the planner, which knows its size in bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import segment
from ..functions.text import GAP, LINE_BREAK, TOKEN, norm


#: Input rows of a range in which addresses are numbered together.
RANGE = 10_000


def dictionary(*sources: tuple[DataFrame, str]) -> DataFrame:
    """term, name and category_id of every entry of several dictionaries (table, name column)."""
    rows = None
    for table, column in sources:
        part = table.select(norm(F.col(column)).alias("term"), F.col(column).alias("name"), "category_id")
        rows = part if rows is None else rows.unionByName(part)
    return rows.filter("term <> ''").distinct()


def cut_up(text: Column) -> Column:
    """A text's tokens and what lies between them, in order."""
    return F.regexp_extract_all(text, F.lit(f"{TOKEN}|{GAP}"), F.lit(0))


def _listed(terms: DataFrame, term: str) -> DataFrame:
    """``terms`` with the pieces from the first token to the last, and the marks around them."""
    pieces = terms.withColumn("_all", cut_up(F.col(term))).withColumn("_token", F.get("_all", F.lit(0)).rlike(TOKEN))
    lead = F.when(F.col("_token"), "").otherwise(F.get("_all", F.lit(0)))
    rows = pieces.withColumn("_lead", lead).withColumn("_core", F.when(F.col("_token"), F.col("_all")).otherwise(F.slice("_all", 2, F.greatest(F.size("_all") - 1, F.lit(0)))))
    trail = F.when(F.get("_core", F.size("_core") - 1).rlike(TOKEN), "").otherwise(F.get("_core", F.size("_core") - 1))
    rows = rows.withColumn("_trail", trail).withColumn("_n", F.size("_core") - F.when(F.col("_trail") != "", 1).otherwise(0))
    return rows.withColumn("_first", F.get("_core", F.lit(0))).withColumn("_core", F.array_join(F.slice("_core", 1, F.greatest("_n", F.lit(0))), "")).drop("_all", "_token")


def _around(piece: Column, marks: Column, before: bool) -> Column:
    """Whether a gap (null at either end of a text) holds a term's marks next to the term, and the
    character beyond them is of no token: one of the gap, or none because the text ends there."""
    gap, open_ended = piece["gap"], piece["open"]
    next_to = gap.endswith(marks) if before else gap.startswith(marks)
    return (marks == "") | F.coalesce(next_to & ((F.char_length(gap) > F.char_length(marks)) | open_ended), F.lit(False))


def locate(texts: DataFrame, terms: DataFrame, text: str = "text", term: str = "term") -> DataFrame:
    """Rows of ``texts`` x ``terms`` with start and end (exclusive) of each occurrence whose
    neighbours are no token characters, overlapping ones included.  Both hold normal forms."""
    listed = _listed(terms.filter(F.col(term) != ""), term)
    rows = texts.withColumn("_pieces", cut_up(F.col(text)))
    kept = [*texts.columns, *terms.columns]

    # outer, as for the other kind the planner adds a filter that cuts up every text once more
    at = rows.select("*", F.posexplode_outer("_pieces").alias("_at", "_piece"))
    worded = at.join(listed.filter("_n > 0"), F.col("_piece") == F.col("_first"))
    gap = lambda place, end: F.struct(F.get("_pieces", place).alias("gap"), end.alias("open"))
    before, after = gap(F.col("_at") - 1, F.col("_at") == 1), gap(F.col("_at") + F.col("_n"), F.col("_at") + F.col("_n") + 1 == F.size("_pieces"))
    worded = worded.filter((F.array_join(F.slice("_pieces", F.col("_at") + 1, F.col("_n")), "") == F.col("_core")) & _around(before, F.col("_lead"), True) & _around(after, F.col("_trail"), False))
    worded = worded.withColumn("start", F.char_length(F.array_join(F.slice("_pieces", 1, F.col("_at")), "")) - F.char_length("_lead")).select(*kept, "start")

    # a term without tokens lies inside one gap and is looked for at every place of it
    marked = at.filter(~F.col("_piece").rlike(TOKEN)).select("*", F.posexplode(F.split("_piece", "")).alias("_in", "_mark"))
    marked = marked.join(listed.filter("_n <= 0"), F.col("_mark") == F.substring(term, 1, 1))
    size, stop = F.char_length("_piece"), F.col("_in") + F.char_length(term)
    free = ((F.col("_in") > 0) | (F.col("_at") == 0)) & ((stop < size) | (F.col("_at") == F.size("_pieces") - 1))
    marked = marked.filter((F.substring("_piece", F.col("_in") + 1, F.char_length(term)) == F.col(term)) & free)
    marked = marked.withColumn("start", F.char_length(F.array_join(F.slice("_pieces", 1, F.col("_at")), "")) + F.col("_in")).select(*kept, "start")
    return worded.union(marked).withColumn("end", F.col("start") + F.char_length(term))


def sentences(pages: DataFrame, segmenter: Callable[[str], list[str]] | None = None) -> DataFrame:
    """url, sentence_no, section and sentence: the title, then the body's sentences, each text once.

    Numbers count repeated sentences, of which the first stays; a body sentence equal to the
    title belongs to the title.  The segmenter cuts one line; without one the rules of
    ``segment`` hold, on every machine.
    """

    def cut(lines: list[str]) -> list[str]:
        split = segmenter or segment.sentences
        return [s for line in lines if line.strip() for s in split(line)]

    # not by Arrow: a worker holds 100 texts at once, not 10,000
    body = F.udf(cut, "array<string>", useArrow=False)(F.split(F.coalesce("body", F.lit("")), LINE_BREAK))
    parts = pages.select("url", F.posexplode(F.concat(F.array(F.coalesce("title", F.lit(""))), body)).alias("sentence_no", "sentence"))
    first = parts.groupBy("url", "sentence").agg(F.min("sentence_no").alias("sentence_no"))
    return first.select("url", "sentence_no", F.when(F.col("sentence_no") == 0, "title").otherwise("body").alias("section"), "sentence")


def found(split: DataFrame, terms: DataFrame) -> DataFrame:
    """Matches of ``terms`` in ``sentences``, each once; places refer to the sentence's normal form."""
    rows = locate(split.withColumn("text", norm("sentence")), terms).drop("text", "term")
    return rows.select("url", "sentence_no", "section", "category_id", F.col("name").alias("matched_name"), "sentence", F.col("start").alias("start_pos"), F.col("end").alias("end_pos")).distinct()


def numbered(found: DataFrame, first_rows: DataFrame) -> DataFrame:
    """``found`` with match_id: by the address's first input row, sentence, name, category and place."""
    order = ["sentence_no", "matched_name", "category_id", "start_pos", "end_pos"]
    # numbers come from counts: of addresses in ranges of rows, then inside a range, so that no task
    # holds all matches or all addresses
    sizes = found.groupBy("url").count().join(first_rows, "url").withColumn("range", F.expr(f"row_no div {RANGE}"))
    before = lambda of, by, *within: F.sum(of).over(Window.partitionBy(*within).orderBy(by)) - F.col(of)
    ranges = sizes.groupBy("range").agg(F.sum("count").alias("held")).select("range", before("held", "range").alias("base_0"))
    base = sizes.withColumn("base_1", before("count", "row_no", "range")).join(ranges, "range").select("url", (F.col("base_0") + F.col("base_1")).alias("base"))
    inside = F.row_number().over(Window.partitionBy("url").orderBy(*order))
    return found.join(base, "url").withColumn("match_id", F.col("base") + inside).drop("base")
