"""``python -m corvane STAGE --config FILE``: runs one stage over its work folder, or ``candidates``,
which makes the input of the first one from the feed."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .operators.acquire import HttpTransport
from .plans.feed import FeedConfig, candidate_articles
from .plans.stages import ORDER, Config, Work


def _trafilatura(html: str) -> dict | None:
    import trafilatura

    got = trafilatura.bare_extraction(html, with_metadata=True, include_comments=False, include_tables=False, favor_precision=True)
    got = got.as_dict() if hasattr(got, "as_dict") else got
    return {k: got.get(k) for k in ("title", "date", "text")} if got else None


def _pysbd(line: str) -> list[str]:
    import pysbd

    return [x.strip() for x in pysbd.Segmenter(language="en", clean=False).segment(line) if x.strip()]


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="corvane")
    parser.add_argument("stage", choices=["candidates", *ORDER, "validate", "status"])
    parser.add_argument("--config", required=True)
    parser.add_argument("--workers", type=int, default=48)
    parser.add_argument("--limit", type=int, default=0)
    parser.add_argument("--cached-work", help="an older work folder with the same input")
    parser.add_argument("--fetch-network", action="store_true")
    parser.add_argument("--allow-pending", action="store_true")
    parser.add_argument("--extractor", choices=["density", "trafilatura"], default="density", help="trafilatura must be installed on all machines")
    parser.add_argument("--segmenter", choices=["rules", "pysbd"], default="rules", help="pysbd must be installed on all machines")
    given = parser.parse_args(args)
    how = {}
    if given.stage == "collect":
        if not (given.cached_work or given.fetch_network):
            parser.error("collect needs --cached-work or --fetch-network")
        how = {"transport": HttpTransport if given.fetch_network else None, "limit": given.limit, "cache": given.cached_work, "partitions": given.workers}
        if given.extractor == "trafilatura":
            how["extractor"] = _trafilatura
    elif given.stage == "match":
        how = {"allow_pending": given.allow_pending, "segmenter": _pysbd if given.segmenter == "pysbd" else None}
    spark = SparkSession.builder.getOrCreate()
    if given.stage == "candidates":
        report = candidate_articles(spark, FeedConfig.load(given.config))
    else:
        report = Work(spark, Config.load(given.config)).run(given.stage, **how)
    print(json.dumps(report, ensure_ascii=False, indent=1, default=str))


if __name__ == "__main__":
    main()
