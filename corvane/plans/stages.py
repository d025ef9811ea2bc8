"""Jobs over a work folder: ingest and fetch, then match, select, classify, export and validate.

The folder is a store on any file system that Spark reaches.  Each job reads and writes tables of it
and keeps its report in the manifest; a job that is done returns its report, and one whose
predecessor isn't done refuses.  Tables change as a whole.  The long jobs commit their work bit by bit
and go on from there when they are run again: fetching by waves, matching and
classifying by buckets of addresses.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import acquire, articles, ingest, matching, results, rules, validation
from ..operators.ingest import InputError
from ..sources import files
from ..sources.store import Store, Taken

#: Pages that are fetched before they are committed, and most of one domain among them.
WAVE, EACH = 5_000, 40
#: Buckets of addresses, and how many are committed together.
BUCKETS, TOGETHER = 64, 8
ORDER = "prepare", "collect", "match", "articles", "classify", "export"
EXCLUSION_HEADER = "source_row_no", "article_id", "reason", "retained_article_id"


@dataclass(frozen=True)
class Config:
    input_csv: str
    sources_dir: str
    work_dir: str
    buckets: int = BUCKETS

    @classmethod
    def load(cls, path: str) -> Config:
        """From JSON; places without a scheme are relative to the file."""
        at = Path(path).resolve()
        value = json.loads(at.read_text(encoding="utf-8-sig"))
        return cls(*(value[k] if "://" in value[k] else str(at.parent / value[k]) for k in ("input_csv", "sources_dir", "work_dir")), value.get("buckets", BUCKETS))


def bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("url"), F.lit(buckets)).cast("int").alias("bucket")


class Work:
    def __init__(self, spark: SparkSession, config: Config):
        self.spark, self.config = spark, config
        self.store = Store(spark, config.work_dir)
        self.store.make()
        self.manifest = files.Manifest(self.store)

    def read(self, name: str) -> DataFrame:
        return self.store.read(name)

    def write(self, name: str, rows: DataFrame) -> DataFrame:
        return self.store.write(name, rows)

    def counts(self) -> dict[str, int]:
        return {r["status"]: r["n"] for r in ingest.status_counts(self.read("pages")).collect()}

    # ---- jobs

    def prepare(self) -> dict:
        """Makes the folder's first tables; ``pages`` comes last and is never made twice."""
        if self.store.has("pages"):
            raise InputError(f"{self.config.work_dir} has been prepared already")
        path = self.config.input_csv
        rows = self.write("inputs", files.read_candidates(self.spark, path))
        n = rows.count()
        none = [F.lit(None).cast("string").alias(c) for c in ("title", "body", "error", "final_url")]
        pages = ingest.pages(rows).select("*", *none, F.lit(None).cast("timestamp").alias("fetched_at"), F.sha2(F.lit(""), 256).alias("body_sha256"))
        self.manifest.put("input", files.file_info(self.spark, path, n))
        try:
            self._write_pages(pages, new=True)
        except Taken as problem:
            raise InputError(f"{self.config.work_dir} has been prepared already") from problem
        return {"rows": n, "pages": self.counts()}

    def _write_pages(self, pages: DataFrame, new: bool = False) -> DataFrame:
        """By bucket, so that a job over some buckets reads just these."""
        return self.store.write("pages", pages.withColumn("bucket", bucket(self.config.buckets)).repartition("bucket"), "bucket", new=new)

    def collect(self, transport=None, limit: int = 0, cache: str | None = None, partitions: int = 48, wave: int = WAVE, each: int = EACH, **how) -> dict:
        """Takes results from an older work folder and, with a transport, fetches what is pending.

        Pages are fetched in waves, each of which is committed before the next one starts, so an
        interrupted job loses one wave at most: the next run goes on from those that were
        committed.  A wave takes the domains in turn.  What one wave learns of an origin's robots
        rules, and when a domain was last asked, holds for the later ones, in this run and the next.
        Between waves the limit and a STOP file in the folder are looked at.
        """
        if self.manifest.get("match") or self.manifest.get("matching"):
            raise InputError("pages are frozen once they have been matched")
        pages = self._merged(self.read("pages"))
        if cache:
            then = Store(self.spark, cache)
            if not ingest.differences(self.read("inputs"), then.read("inputs")).isEmpty():
                raise InputError("the cache was made from another input")
            pages = self._write_pages(ingest.merge_cache(pages, then.read("pages")).select(*pages.columns))
        n, done = 0, 0
        while transport and not self.store.exists("STOP") and (not limit or done < limit):
            fetched = self._fetched()
            pending = pages.filter("status = 'pending'").join(fetched.select("url"), "url", "left_anti")
            queue = acquire.known(acquire.wave(pending, min(wave, limit - done) if limit else wave, each), self._visits())
            self.store.fill("fetched", acquire.fetch_all(queue, transport, partitions, **how).withColumn("wave", F.lit(n)), "wave")
            if not (got := self._fetched().filter(F.col("wave") == n).count()):
                break
            n, done = n + 1, done + got
            self.manifest.put("progress", {"waves": n, "fetched": done})
        self._merged(pages)
        counts = self.counts()
        return {"pages": counts, "collection_complete": not counts.get("pending")}

    def _fetched(self) -> DataFrame:
        """What has been fetched but not joined to the pages yet."""
        kept = acquire.FETCHED.replace("barred string, ", "")
        return self.store.filled("fetched", f"{kept}, status string, body_sha256 string, wave int")

    def _visits(self) -> DataFrame:
        """Robots answers of origins and requests to domains, of all waves."""
        kept = ["origin", "domain", "robots_at", "robots_status", "robots_body", "hit_at"]
        rows = self._fetched().select(kept).filter("robots_at is not null or hit_at is not null")
        return rows.unionByName(self.read("visits")) if self.store.has("visits") else rows

    def _merged(self, pages: DataFrame) -> DataFrame:
        """The page table with what has been fetched."""
        fetched = self._fetched()
        if fetched.isEmpty():
            return pages
        visits = self._visits()
        answers = visits.filter("robots_at is not null").groupBy("origin").agg(F.max_by("domain", "robots_at").alias("domain"), F.max("robots_at").alias("robots_at"), *(F.max_by(c, "robots_at").alias(c) for c in ("robots_status", "robots_body")))
        hits = visits.groupBy("domain").agg(F.max("hit_at").alias("hit_at"))
        self.write("visits", answers.unionByName(hits, allowMissingColumns=True))
        new = ["status", "title", "body", "error", "fetched_at", "final_url", "body_sha256"]
        got = fetched.select("url", F.lit(True).alias("new"), *(F.col(c).alias("new_" + c) for c in new))
        rows = pages.join(got, "url", "left")
        pages = self._write_pages(rows.select(*(F.when(F.col("new"), F.col("new_" + c)).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in pages.columns)))
        self.store.remove("open/fetched")
        return pages

    def match(self, allow_pending: bool = False, segmenter=None, together: int = TOGETHER) -> dict:
        """Finds the dictionaries' terms, some buckets at a time; those that are done aren't run again."""
        if (pending := self.counts().get("pending", 0)) and not allow_pending:
            raise InputError(f"{pending} pages are pending")
        if self.manifest.get("dictionaries"):
            self._unchanged()
        else:
            self.manifest.put("dictionaries", {k: files.digest(self.spark, f"{self.config.sources_dir}/{k}") for k in files.DICTIONARIES})
        pages = self.read("pages").filter("status = 'extracted'")
        if not pages.filter("coalesce(body, '') = ''").isEmpty():
            raise InputError("an extracted page has no body")
        self.manifest.put("matching", True)  # pages are frozen from here on
        terms, schema = self.terms(), "url string, bucket int"
        for some in self._open(pages, self.store.filled("matched_pages", schema), "url", together):
            mine = pages.filter(F.col("bucket").isin(some))
            found = matching.found(matching.sentences(mine, segmenter), terms)
            self.store.fill("found", found.withColumn("bucket", bucket(self.config.buckets)), "bucket")
            self.store.fill("matched_pages", mine.select("url", "bucket"), "bucket")  # last: now they are done
        found = self.store.filled("found", "url string, sentence_no int, section string, category_id string, matched_name string, sentence string, start_pos int, end_pos int, bucket int")
        rows = self.store.write("matches", matching.numbered(found, pages.select("url", "row_no")), "bucket")
        n, urls = rows.agg(F.count("*"), F.count_distinct("url")).first()
        return {"matches": n, "pages_with_matches": urls}

    def _open(self, rows: DataFrame, done: DataFrame, key: str, together: int) -> list[list[int]]:
        """The buckets in which rows are left to do, some at a time."""
        left = rows.select(key, "bucket").join(done.select(key), key, "left_anti").select("bucket").distinct().collect()  # BUCKETS at most
        numbers = sorted(r["bucket"] for r in left)
        return [numbers[k : k + together] for k in range(0, len(numbers), together)]

    def articles(self) -> dict:
        rows = self.write("judged", articles.judged(self.read("inputs"), self.read("pages"), self.read("matches")))
        self.write("selected", articles.selected(rows))
        excluded = self.write("exclusions", articles.exclusions(rows))
        path = f"{self.store.folder}/articles.csv"
        n = files.export_csv(self.read("selected").orderBy("row_no").select(*articles.FIELDS), path, files.INPUT_HEADER)
        files.export_csv(excluded.orderBy("row_no").select("row_no", *EXCLUSION_HEADER[1:]), f"{self.store.folder}/article_exclusions.csv", EXCLUSION_HEADER)
        return {"file": files.file_info(self.spark, path, n), "excluded": {r["reason"]: r["count"] for r in excluded.groupBy("reason").count().collect()}}

    def classify(self, together: int = TOGETHER) -> dict:
        """Decides on the matches of selected articles, some buckets at a time, like ``match``."""
        self._unchanged()
        if self.store.digest("articles.csv") != self.manifest.get("articles")["file"]["sha256"]:
            raise InputError("articles.csv has changed since it was written")
        usage = rules.patterns(self._dictionary("usage_patterns.csv"))
        chosen = self.read("matches").join(self.read("selected").select("url").distinct(), "url", "left_semi")
        schema = "match_id long, usage_code int, reason string, pattern_ids array<string>, bucket int"
        for some in self._open(chosen, self.store.filled("decided", schema), "match_id", together):
            mine = chosen.filter(F.col("bucket").isin(some))
            self.store.fill("decided", rules.decide(mine, usage).join(mine.select("match_id", "bucket"), "match_id"), "bucket")
        rows = self.write("decisions", self.store.filled("decided", schema).drop("bucket"))
        return {"rules": rules.VERSION, "codes": {r["code"]: r["n"] for r in rules.decision_counts(rows).collect()}}

    def export(self) -> dict:
        rows = self.write("results", results.results(self.read("selected"), results.grouped(self.read("matches"), self.read("decisions"))))
        path = f"{self.store.folder}/result.csv"
        n = files.export_csv(results.in_result_order(rows), path, files.RESULT_HEADER)
        return {"file": files.file_info(self.spark, path, n), "checks": self.validate()}

    def validate(self) -> dict:
        """Runs every check and raises if one finds anything."""
        self._unchanged()
        if files.digest(self.spark, self.config.input_csv) != self.manifest.get("input")["sha256"]:
            raise InputError("the input file has changed")
        inputs, selected, found, decided, out = (self.read(x) for x in ("inputs", "selected", "matches", "decisions", "results"))
        written = [files.read_strict(self.spark, f"{self.store.folder}/{name}", header).withColumnRenamed("row_no", "n") for name, header in (("articles.csv", files.INPUT_HEADER), ("result.csv", files.RESULT_HEADER))]
        named = selected.select("row_no", *(F.col(a).alias(b) for a, b in zip(articles.FIELDS, files.INPUT_HEADER, strict=True)))
        numbered = self._numbered("numbered_articles", named, "row_no").drop("row_no"), self._numbered("numbered_results", out, "row_no", "category_id").select("n", *results.RESULT)
        checks = {
            "articles.csv": validation.not_equal(written[0], numbered[0]),
            "result.csv": validation.not_equal(written[1], numbered[1]),
            "known articles": validation.unknown_articles(out, selected),
            "unique keys": validation.repeated_keys(out),
            "known categories": validation.unknown_categories(out, self.terms()),
            "labels and evidence": validation.wrong_labels(out, selected, found, decided),
            "every match decided": validation.undecided(found, selected, decided),
            "only titles changed": validation.changed(selected, inputs),
        }
        broken = {k: n for k, rows in checks.items() if (n := rows.count())}
        broken |= validation.counted(selected, validation.ARTICLE_RULES) | validation.counted(out, validation.RESULT_RULES)
        if broken:
            raise InputError(f"checks failed: {broken}")
        return {"checks": len(checks) + len(validation.ARTICLE_RULES) + len(validation.RESULT_RULES), "pages": self.counts()}

    # ---- helpers

    def terms(self) -> DataFrame:
        return matching.dictionary((self._dictionary("sipri_dictionary.csv"), "wp_name"), (self._dictionary("nato_dictionary.csv"), "tech_name"))

    def _dictionary(self, name: str) -> DataFrame:
        return files.read_dictionary(self.spark, f"{self.config.sources_dir}/{name}", files.DICTIONARIES[name])

    def _unchanged(self) -> None:
        for name, old in self.manifest.get("dictionaries").items():
            if files.digest(self.spark, f"{self.config.sources_dir}/{name}") != old:
                raise InputError(f"{name} has changed since the matches were made")

    def _numbered(self, name: str, rows: DataFrame, *order: str) -> DataFrame:
        """Rows in an order, numbered from 1: places in a partition plus the counts of those before."""
        placed = self.write(name, rows.orderBy(*order).withColumn("at", F.monotonically_increasing_id()))
        part = F.shiftright("at", 33)
        counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("held"))  # a row for each partition
        starts = counts.select("part", (F.sum("held").over(Window.orderBy("part")) - F.col("held")).alias("first"))
        return placed.withColumn("part", part).join(F.broadcast(starts), "part").withColumn("n", F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1) + 1).drop("part", "first", "at")

    def run(self, stage: str, **how) -> dict:
        """A stage's report; the stages before it must be done, and a done one isn't run again."""
        with files.locked(self.store):
            if stage in ("validate", "status"):
                return self.validate() if stage == "validate" else {"done": [s for s in ORDER if self.manifest.get(s)], "pages": self.counts()}
            before = ORDER[: ORDER.index(stage)]
            if missing := [s for s in before if not self.manifest.get(s)]:
                raise InputError(f"{stage} needs {missing[0]}")
            if stage != "collect" and (report := self.manifest.get(stage)):
                if stage == "export":
                    self.validate()
                return report
            report = getattr(self, stage)(**how)
            self.manifest.put(stage, report)
            return report
