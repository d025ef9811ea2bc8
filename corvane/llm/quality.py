"""Quality rules: how much of a text lies inside repeated n-grams and lines.

``repetition`` hashes the words of each whole text and, for several n-gram lengths, measures the
characters inside n-grams that occurred earlier in that text; likewise for whole lines.  Hashes only
bring equal ones together: words, lines and n-grams are then compared themselves.
A text fails when it has too few words, when most of its words lie in repeated 3-word windows
(the first occurrence included), when a share exceeds its threshold, or when symbols outnumber
its words.  One repeated sentence in a short text stays below every threshold.

A text of any length is measured whole.  Null and empty texts have no words and so fail.  Rows are judged one by one: repeated rows give
repeated results, and an empty table an empty one.  Other columns are left out of the result,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from . import _text as t
from ._session import table

MIN_WORDS = 50
#: Most of a text's word characters that may lie in n-grams which occurred before, by n.
NGRAM_SHARE = {5: 0.20, 6: 0.19, 7: 0.18, 8: 0.17, 9: 0.16, 10: 0.15}
#: Most of a text's lines, and of its word characters, that may be repeats of earlier lines.
LINE_SHARE, LINE_CHAR_SHARE = 0.50, 0.20
#: Most symbols for each word; a table has about one cell mark.
SYMBOLS_PER_WORD = 1.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines long, dup_line_chars long, " + ", ".join(f"dup_chars_{n} long" for n in NGRAM_SHARE)
)


def _covered(marks: np.ndarray, n: int, length: int) -> np.ndarray:
    """Positions that a marked window of n positions covers."""
    depth = np.zeros(length + 1, np.int32)
    np.add.at(depth, marks, 1)
    np.add.at(depth, marks + n, -1)
    return np.cumsum(depth[:-1]) > 0


def measure(block: t.Block) -> dict[str, np.ndarray]:
    """The counts of every document of a block."""
    space = t.spaces(block)
    words = t.words(block, space)
    point = (block.data & 0xC0) != 0x80
    chars_to = np.zeros(len(space) + 1, np.int64)
    np.cumsum(point & ~space, out=chars_to[1:])
    out = {"n_words": np.diff(words.at), "word_chars": chars_to[block.at[1:]] - chars_to[block.at[:-1]], "n_symbols": t.per_row(_SYMBOL[block.data], block.at)}
    salt = t.mix(np.arange(1, block.rows + 1, dtype=t.U64))

    cuts = np.flatnonzero(block.data == 10)
    start = np.sort(np.concatenate([cuts + 1, block.at[:-1]]))  # a line that ends a document may start where the next one does
    owner = np.searchsorted(np.concatenate([block.at[:-1], [len(space) + 1]]), start, "right") - 1
    stops = np.sort(np.concatenate([cuts, block.at[1:]]))
    end = np.maximum(start, stops)
    wordy = chars_to[end] > chars_to[start]
    start, end, owner = start[wordy], end[wordy], owner[wordy]
    number, _ = t.distinct(block.data, start, end)
    _, later = t.repeated(number * block.rows + owner)
    chars = chars_to[end] - chars_to[start]
    out["n_lines"] = np.bincount(owner, minlength=block.rows)
    out["n_dup_lines"] = np.bincount(owner[later], minlength=block.rows)
    out["dup_line_chars"] = np.bincount(owner[later], weights=chars[later], minlength=block.rows).astype(np.int64)

    numbers, _ = t.distinct(block.data, words.start, words.end)
    hashes = t.mix(numbers.astype(t.U64) + t.U64(1))
    sizes = chars_to[words.end] - chars_to[words.start]
    last = words.at[1:][words.doc]
    grams = t.ngrams(hashes, 3)
    marks = np.flatnonzero(t.whole(words.at, 3, len(grams)))
    marks = marks[t.repeated_grams(t.mix(grams[marks]) ^ salt[words.doc[marks]], marks, numbers, words.doc, 3)[0]]
    out["n_repeat_words"] = t.per_row(_covered(marks, 3, len(hashes)), words.at)
    grams, n = grams[marks], 3
    for longer in NGRAM_SHARE:  # a repeated n-gram starts where a repeated shorter one does
        while n < longer:
            keep = marks + n < last[marks] if len(marks) else np.zeros(0, bool)
            marks, grams = marks[keep], grams[keep]
            with np.errstate(over="ignore"):
                grams = grams * t._STEP + hashes[marks + n]
            n += 1
        twice, later = t.repeated_grams(t.mix(grams) ^ salt[words.doc[marks]], marks, numbers, words.doc, n)
        out[f"dup_chars_{n}"] = t.per_row(np.where(_covered(marks[later], n, len(hashes)), sizes, 0), words.at)
        marks, grams = marks[twice], grams[twice]
    return out


def judge(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Which documents fail the base rules, and which are kept."""
    failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
    kept = ~failed & (m["n_symbols"] <= SYMBOLS_PER_WORD * m["n_words"]) & (m["n_dup_lines"] <= LINE_SHARE * m["n_lines"]) & (m["dup_line_chars"] <= LINE_CHAR_SHARE * m["word_chars"])
    for n, share in NGRAM_SHARE.items():
        kept &= m[f"dup_chars_{n}"] <= share * m["word_chars"]
    return failed, kept


@t.released
def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for batch in batches:
        for block in t.blocks(batch.column("text")):
            m = measure(block)
            m["base_failed"], m["kept"] = judge(m)
            columns = [batch.column("doc_id").slice(block.first, block.rows), *(pa.array(m[x].astype(bool if x in ("base_failed", "kept") else np.int64)) for x in names[1:])]
            yield pa.RecordBatch.from_arrays(columns, names)


def repetition(docs: DataFrame) -> DataFrame:
    """One row of counts and verdicts for each row of ``docs`` (doc_id, text)."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(_rows, SCHEMA)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text passes, with all their columns."""
    schema = docs.schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [judge(measure(block))[1] for block in t.blocks(batch.column("text"))]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(t.released(rows), schema)


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(table(spark, sf_dir, "documents"))
