"""Files at the edges: strict CSV in, single deliverables out, manifests and a lock.

A candidate list is read by as many tasks as it has splits, also where values span lines.
A deliverable is one file: tasks write its lines in sorted parts, which are then joined on
the file system through a buffer, so the driver holds no rows.
"""

from __future__ import annotations

import csv
import json
import os
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.ingest import InputError
from .store import Store, Taken

#: Headers of the input and of the deliverables.
INPUT_HEADER = "article_id", "conflict_id", "published_date", "article_url", "title"
RESULT_HEADER = "article_id", "category_id", "usage_code", "evidence_sentence"
#: Records of a range in which rows are numbered together.
RANGE = 100_000
DICTIONARIES = {"sipri_dictionary.csv": ("wp_name", "category_id"), "nato_dictionary.csv": ("tech_name", "category_id"), "usage_patterns.csv": ("pattern_id", "base_form", "trans_form")}


def _home(spark: SparkSession, path: str | Path) -> tuple[Store, str]:
    """The folder of a file as a store, and the file's name."""
    folder, _, name = str(path).rpartition("/")
    return Store(spark, folder or "."), name


def records(spark: SparkSession, path: str) -> DataFrame:
    """record_no and record of each record of a CSV file, in file order; blank ones are left out.

    Lines are read by all tasks.  Whether a line starts inside quotes follows from the number of quotes
    before it: of the splits before its own, which is one number each, and of the lines before it in
    its split.  A line that ends outside quotes ends a record; only the lines of longer records are
    shuffled.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("at"))
    lines = lines.withColumn("quotes", F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit(""))))
    upto = Window.partitionBy("split").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("quotes_here", F.sum("quotes").over(upto))
    splits = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    before = lambda c: F.coalesce(F.sum(c).over(splits), F.lit(0))
    totals = lines.groupBy("split").agg(F.sum("quotes").alias("quotes_in"), F.count_if(F.col("quotes_here") % 2 == 0).alias("ends_even"), F.count("*").alias("held"))
    totals = totals.withColumn("quotes_0", before("quotes_in")).withColumn("ends_in", F.when(F.col("quotes_0") % 2 == 0, F.col("ends_even")).otherwise(F.col("held") - F.col("ends_even")))
    totals = totals.select("split", "quotes_0", before("ends_in").alias("ends_0"))
    sofar = F.col("quotes_0") + F.col("quotes_here")
    lines = lines.join(F.broadcast(totals), "split").withColumns({"ends": sofar % 2 == 0, "starts": (sofar - F.col("quotes")) % 2 == 0})
    own = F.col("ends").cast("long")
    lines = lines.select("at", "value", "starts", "ends", (F.col("ends_0") + F.sum(own).over(upto) - own).alias("record_no"))
    alone = lines.filter("starts and ends").select("record_no", "value")
    several = lines.filter("not (starts and ends)").groupBy("record_no").agg(F.max("ends").alias("closed"), F.array_sort(F.collect_list(F.struct("at", "value"))).alias("own"))
    whole = F.when(F.col("closed"), F.array_join(F.transform("own", lambda x: x["value"]), "\n")).otherwise(F.raise_error(F.lit(f"{path}: a quote isn't closed")))
    plain = F.regexp_replace(F.regexp_replace("value", "\r$", ""), "^\ufeff", "")
    return alone.union(several.select("record_no", whole.alias("value"))).select("record_no", plain.alias("record")).filter("record <> ''")


def _parsed(names: tuple[str, ...], path: str):
    schema = "record_no long, " + ", ".join(f"{c} string" for c in names)

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = []
            for record in batch["record"]:
                try:
                    (got,) = csv.reader([record], strict=True)
                except (csv.Error, ValueError) as problem:
                    raise InputError(f"{path}: {problem}: {record[:200]!r}") from None
                if len(got) != len(names):
                    raise InputError(f"{path}: {len(got)} fields in place of {len(names)}: {record[:200]!r}")
                values.append(got)
            yield pd.DataFrame(values, columns=list(names), dtype=str).assign(record_no=batch["record_no"].to_numpy())[["record_no", *names]]

    return rows, schema


def read_strict(spark: SparkSession, path: str, header: tuple[str, ...]) -> DataFrame:
    """row_no, from 1 in file order, and the columns of a CSV as text, missing values being ''.

    The header must be exact and in order, and every row must have its fields.
    """
    rows, schema = _parsed(header, path)
    every = records(spark, path)
    first = every.orderBy("record_no").limit(1).collect()
    if not first or first[0]["record"].split(",") != list(header):
        raise InputError(f"{path} must start with the columns {', '.join(header)}")
    every = every.filter(F.col("record_no") > first[0]["record_no"]).withColumn("range", F.expr(f"record_no div {RANGE}"))
    # blank lines leave gaps in the numbers of records: what counts is the place among those kept
    held = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = every.groupBy("range").agg(F.count("*").alias("n")).select("range", F.coalesce(F.sum("n").over(held), F.lit(0)).alias("range_0"))
    inside = F.row_number().over(Window.partitionBy("range").orderBy("record_no"))
    numbered = every.withColumn("inside", inside).join(ranges, "range").select((F.col("range_0") + F.col("inside")).alias("record_no"), "record")
    return numbered.mapInPandas(rows, schema).withColumnRenamed("record_no", "row_no")


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """The candidate list as ``read_strict`` gives it; ids must be there and unique, and there must be rows."""
    out = read_strict(spark, path, INPUT_HEADER).withColumnRenamed("article_url", "url")
    facts = out.agg(F.count("*").alias("n"), F.count_if(F.trim("article_id") == "").alias("blank"), F.count_distinct("article_id").alias("ids")).first()
    if not facts["n"]:
        raise InputError(f"{path} has no rows")
    if facts["blank"]:
        raise InputError(f"{path} has {facts['blank']} rows without an id")
    if facts["ids"] != facts["n"]:
        raise InputError(f"{path} repeats {facts['n'] - facts['ids']} ids")
    return out


def read_dictionary(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """A dictionary with at least these columns, an id in every row, and rows."""
    rows = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', encoding="UTF-8")
    rows = rows.toDF(*(c.lstrip("﻿").strip() for c in rows.columns))
    if missing := [c for c in columns if c not in rows.columns]:
        raise InputError(f"{path} lacks {', '.join(missing)}")
    key = "category_id" if "category_id" in columns else "pattern_id"
    rows = rows.select(*(F.coalesce(c, F.lit("")).alias(c) for c in columns))
    n, blank = rows.agg(F.count("*"), F.count_if(F.trim(key) == "")).first()
    if not n or blank:
        raise InputError(f"{path}: {n} rows, {blank} without {key}")
    return rows


def write_csv(path: Path, header: Iterable[str], rows: Iterable[Iterable]) -> int:
    """Writes a CSV with a byte-order mark beside the target and renames it; returns its rows."""
    path.parent.mkdir(parents=True, exist_ok=True)
    part, n = path.with_name(path.name + ".part"), 0
    with part.open("w", encoding="utf-8-sig", newline="") as file:
        out = csv.writer(file)
        out.writerow(header)
        for row in rows:
            out.writerow(row)
            n += 1
    os.replace(part, path)
    return n


def csv_line(columns: Iterable[Column]) -> Column:
    """A line of a CSV as ``write_csv`` writes it, without its end."""

    def cell(c: Column) -> Column:
        text = F.coalesce(c.cast("string"), F.lit(""))
        return F.when(text.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)

    return F.concat_ws(",", *(cell(c) for c in columns))


def export_csv(df: DataFrame, path: str | Path, header: Iterable[str]) -> int:
    """``df``, which is sorted, as one CSV with a byte-order mark, as ``write_csv`` gives it; returns its rows."""
    store, name = _home(df.sparkSession, path)
    store.make()
    parts, seen = f".{name}.{uuid.uuid4().hex}", Observation()
    try:
        lines = df.select(csv_line(F.col(c) for c in df.columns).alias("value")).observe(seen, F.count(F.lit(1)).alias("n"))
        lines.write.option("lineSep", "\r\n").text(f"{store.folder}/{parts}")
        store.joined(name, "\ufeff".encode() + ",".join(header).encode() + b"\r\n", parts)
    finally:
        store.remove(parts)
    return seen.get["n"]


def digest(spark: SparkSession, path: str | Path) -> str:
    store, name = _home(spark, path)
    return store.digest(name)


def file_info(spark: SparkSession, path: str | Path, rows: int) -> dict:
    store, name = _home(spark, path)
    return {"path": str(path), "rows": rows, "bytes": store.size(name), "sha256": store.digest(name)}


class Manifest:
    """Keys and JSON values of a work folder, rewritten whole at each change.

    The format of the folder and the meaning of the usage codes in it must be this engine's.
    """

    FORMAT, CODES = "corvane-work-2", "used 0, not used 1, uncertain 2"

    def __init__(self, store: Store):
        self.store = store
        self.values = json.loads(store.text("manifest.json")) if store.exists("manifest.json") else {"format": self.FORMAT, "codes": self.CODES}
        for key, want in (("format", self.FORMAT), ("codes", self.CODES)):
            if self.values.get(key) != want:
                raise InputError(f"{store.folder}/manifest.json has other {key}: {self.values.get(key)}")

    def get(self, key: str):
        return self.values.get(key)

    def put(self, key: str, value) -> None:
        self.values[key] = value
        self.store.put("manifest.json", json.dumps(self.values, ensure_ascii=False, indent=1, sort_keys=True))


@contextmanager
def locked(store: Store):
    """Exclusive use of a work folder; fails at once if another process has it.

    On a local file system the lock goes with the process.  Elsewhere it is a file made for the
    first time, which names its owner and has to be removed by hand if the owner died.
    """
    store.make()
    scheme, _, local = store.folder.rpartition("://")
    if scheme not in ("", "file"):
        try:
            store.put("lock", f"{os.uname().nodename} {os.getpid()}", new=True)
        except Taken as problem:
            raise InputError(f"{store.folder} is in use by {store.text('lock')}") from problem
        try:
            yield
        finally:
            store.remove("lock")
        return
    folder = Path(local)
    with (folder / ".lock").open("a+") as file:
        try:
            import fcntl

            fcntl.flock(file, fcntl.LOCK_EX | fcntl.LOCK_NB)
        except ImportError:  # not a POSIX system
            import msvcrt

            msvcrt.locking(file.fileno(), msvcrt.LK_NBLCK, 1)
        except BlockingIOError:
            raise InputError(f"{folder} is in use") from None
        yield
