"""From the public feed to the candidate articles that ``prepare`` reads.

A dataset is a store of tables, on any file system that Spark reaches.  The feed is a folder
with ``events`` and ``mentions``, both partitioned by ``partition_day``.  Where studies of other
conflicts or periods run over the same feed again and again, ``bucketed`` keeps its rows under study in two
tables by event, whose join then needs no shuffle.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import candidates
from ..sources import files
from ..sources.store import Store

#: The conflicts under study by number, the countries of either side, and the period.
CONFLICTS = (
    (164, ("USA",), ("VEN",)),
    (218, ("IND",), ("PAK",)),
    (274, ("CHN",), ("IND",)),
    (294, ("KHM",), ("THA",)),
    (302, ("ISR",), ("SYR",)),
    (324, ("IRN",), ("IRQ",)),
    (409, ("ERI",), ("ETH",)),
    (10383, ("BGD",), ("MMR",)),
    (10771, ("COD",), ("RWA",)),
    (11639, ("AFG",), ("PAK",)),
    (13243, ("RUS",), ("UKR",)),
    (13324, ("KGZ",), ("TJK",)),
    (14609, ("IRN",), ("ISR",)),
    (16099, ("GBR", "USA"), ("YEM",)),
    (16470, ("ISR",), ("YEM",)),
)
PERIOD = "20160101", "20260923"


def plan() -> list[candidates.Conflict]:
    """The plan as rows: a conflict's name and the name of its batch follow from its number."""
    return [candidates.Conflict("_".join((f"ucdp_{number}", *PERIOD)), f"ucdp_{number}", a, b) for number, a, b in CONFLICTS]


@dataclass(frozen=True)
class FeedConfig:
    feed: str
    dataset: str
    export: Path
    tables: str | None = None

    @classmethod
    def load(cls, path: str) -> FeedConfig:
        """From JSON; a relative export is relative to the file."""
        at = Path(path).resolve()
        value = json.loads(at.read_text(encoding="utf-8-sig"))
        return cls(value["feed"], value["dataset"], at.parent / value["input_csv"], value.get("bucketed_tables"))


def bucketed(spark: SparkSession, feed: str, tables: str, buckets: int = 512) -> None:
    """Saves the feed's events between any two countries of the plan and its web mentions as tables
    ``<tables>_events`` and ``<tables>_mentions``, in sorted buckets of the event's number."""
    countries = sorted({x for c in plan() for x in (*c.side_a, *c.side_b)})
    rows = {"events": candidates.events(spark.read.parquet(f"{feed}/events"), countries), "mentions": candidates.mentions(spark.read.parquet(f"{feed}/mentions"))}
    for name, own in rows.items():
        # one task for each bucket, so that a bucket is one sorted file
        own.repartition(buckets, "GLOBALEVENTID").write.mode("overwrite").bucketBy(buckets, "GLOBALEVENTID").sortBy("GLOBALEVENTID").saveAsTable(f"{tables}_{name}")


def candidate_articles(spark: SparkSession, config: FeedConfig, conflicts: list[candidates.Conflict] | None = None) -> dict:
    """Writes ``candidates_raw``, ``candidate_urls`` and the export; returns their rows."""
    chosen = plan() if conflicts is None else conflicts
    countries = sorted({x for c in chosen for x in (*c.side_a, *c.side_b)})
    out = Store(spark, config.dataset)
    if config.tables:
        events, mentions = (spark.table(f"{config.tables}_{name}") for name in ("events", "mentions"))
        events = events.filter(F.col("Actor1CountryCode").isin(*countries) & F.col("Actor2CountryCode").isin(*countries))
    else:
        events, mentions = candidates.events(spark.read.parquet(f"{config.feed}/events"), countries), candidates.mentions(spark.read.parquet(f"{config.feed}/mentions"))
    tagged = candidates.tag(events, candidates.plan_table(spark, chosen))
    raw = out.write("candidates_raw", candidates.candidates_raw(tagged, mentions))
    urls = out.write("candidate_urls", candidates.candidate_urls(raw))
    n = files.export_csv(candidates.in_export_order(candidates.article_export(urls)), config.export, files.INPUT_HEADER)
    return {"candidates_raw": raw.count(), "candidate_urls": urls.count(), "file": files.file_info(spark, config.export, n)}
