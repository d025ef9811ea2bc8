"""Text functions: normal form, token classes, phrases and sentences."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: A token is a run of letters, numbers and these marks.
TOKEN = r"[\p{L}\p{N}_'-]+"
TOKEN_CLASS = r"[\p{L}\p{N}_'-]"
#: What lies between tokens.
GAP = r"[^\p{L}\p{N}_'-]+"
#: Hyphens and dashes, and the apostrophe, with what stands for them.
_MARKS = dict.fromkeys("–—‑‐", "-") | {"’": "'"}
_TABLE = str.maketrans(_MARKS)
#: Where Python's splitlines breaks lines.
LINE_BREAK = "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"


def normal_form(text: str | None) -> str | None:
    """Compatibility form, plain hyphens and apostrophes, single spaces, case folded."""
    if text is None:
        return None
    plain = unicodedata.normalize("NFKC", text).translate(_TABLE)
    return " ".join(plain.split()).casefold()


#: ``normal_form`` of a column.  Not by Arrow: its batches hold 10,000 texts, or 64 MB of them, whose copies
#: a worker would hold at once, against 100 rows here.
norm = F.udf(normal_form, StringType(), useArrow=False)


def norm_ascii(text: Column) -> Column:
    """``norm`` of ASCII text with the mapped marks, without leaving the JVM."""
    plain = F.translate(text, "".join(_MARKS), "".join(_MARKS.values()))
    return F.lower(F.trim(F.regexp_replace(plain, r"[ \t\n\x0b\f\r\x1c-\x1f]+", " ")))


def quoted(text: Column) -> Column:
    """An expression that matches just this text."""
    return F.concat(F.lit(r"\Q"), F.replace(text, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def bounded(text: Column, term: Column, kind: str = TOKEN_CLASS) -> Column:
    """Whether a text has a term between characters of another kind.

    Both get a sign around each run of the kind, so that runs are equal as wholes only; just for
    a term that starts or ends otherwise an expression is made.
    """
    signed = lambda x: F.regexp_replace(x, f"({kind}+)", "\x01$1\x01")
    plain = term.rlike(f"^{kind}") & term.rlike(rf"{kind}\z")
    own = F.regexp_like(text, F.concat(F.lit(f"(?<!{kind})"), quoted(term), F.lit(f"(?!{kind})")))
    return text.contains(term) & F.when(plain, signed(text).contains(signed(term))).otherwise(own)


def complete(*columns: Column) -> Column:
    """Whether every column is there and holds more than white space (of any script)."""
    out = F.lit(True)
    for c in columns:
        out = out & F.coalesce(F.expr("true") & c.cast("string").rlike(r"(?U)[^\s\x1c-\x1f]"), F.lit(False))
    return out


def page_title(html: Column) -> Column:
    """What the first title element of a page says as it is written, with just its signs ``<``, ``>`` and ``&``
    put in for their full references; empty without one.  ``maintext`` reads every reference, as a browser does."""
    out = F.regexp_extract(html, r"(?is)<title[^>]*>([^<]*)</title>", 1)
    for reference, sign in (("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        out = F.replace(out, F.lit(reference), F.lit(sign))
    return F.regexp_replace(out, r"^\p{Zs}+|\p{Zs}+\z", "")


def phrases(form: Column) -> Column:
    """Normal forms of a dictionary form: as it is, and its alternatives without remarks in brackets."""
    bare = F.trim(F.regexp_replace(form, r"\([^)]*\)", ""))
    parts = F.filter(F.split(bare, r"(?U)\s+/\s+"), lambda x: F.trim(x) != "")
    return F.array_union(F.array(form), parts)


def clauses(text: Column) -> Column:
    """Parts between semicolons and the words but, whereas and while; blanks around them stay."""
    return F.split(text, r"(?U);|\bbut\b|\bwhereas\b|\bwhile\b")
