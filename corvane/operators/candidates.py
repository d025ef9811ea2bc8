"""The candidate chain: events tagged with the country pairs under study, their mentions, a summary
of every address and the article export.

Inputs follow the public feed's column names.  Ties that the feed leaves open (any source name, a
representative location among equals) are settled by value, so reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.fingerprint import fingerprint63

#: The period of each feed (half-open), the event kinds and the columns used.
MENTION_DAYS = date(2016, 1, 1), date(2026, 9, 24)
EVENT_DAYS = date(2015, 2, 19), date(2026, 9, 24)
ROOT_CODES = ("15", "17", "18", "19", "20")
QUAD_CLASS, WEB = 4, 1
MENTION_COLUMNS = "GLOBALEVENTID", "MentionIdentifier", "MentionSourceName", "MentionTimeDate", "Confidence", "InRawText", "SentenceID", "MentionDocTranslationInfo"
EVENT_COLUMNS = "GLOBALEVENTID", "SQLDATE", "DATEADDED", "Actor1Name", "Actor2Name", "Actor1CountryCode", "Actor2CountryCode", "EventCode", "EventRootCode", "QuadClass", "ActionGeo_CountryCode", "ActionGeo_FullName", "ActionGeo_Type", "ActionGeo_Lat", "ActionGeo_Long"
GEO = {"ActionGeo_CountryCode": "geo_country_code", "ActionGeo_FullName": "geo_fullname", "ActionGeo_Type": "geo_type", "ActionGeo_Lat": "geo_lat", "ActionGeo_Long": "geo_long"}


@dataclass(frozen=True)
class Conflict:
    batch_id: str
    conflict_id: str
    side_a: tuple[str, ...]
    side_b: tuple[str, ...]


def plan_table(spark: SparkSession, plan: list[Conflict]) -> DataFrame:
    return spark.createDataFrame([(c.batch_id, c.conflict_id, list(c.side_a), list(c.side_b)) for c in plan], "batch_id string, candidate_conflict_id string, side_a array<string>, side_b array<string>")


def directed_pairs(plan: DataFrame) -> DataFrame:
    """Each pair of opposing countries in both directions, once for each conflict."""
    ab = plan.select("batch_id", "candidate_conflict_id", F.explode("side_a").alias("one"), "side_b").select("batch_id", "candidate_conflict_id", "one", F.explode("side_b").alias("two"))
    return ab.union(ab.select("batch_id", "candidate_conflict_id", "two", "one")).distinct()


def mentions(feed: DataFrame, days: tuple[date, date] = MENTION_DAYS) -> DataFrame:
    """Web mentions of the period; the day prunes partitions, the coded time rows."""
    low, high = (int(d.strftime("%Y%m%d")) * 1_000_000 for d in days)
    rows = feed.filter((F.col("partition_day") >= F.lit(days[0])) & (F.col("partition_day") < F.lit(days[1])))
    rows = rows.filter((F.col("MentionTimeDate") >= low) & (F.col("MentionTimeDate") < high) & (F.col("MentionType") == WEB) & F.col("MentionIdentifier").rlike("^https?://"))
    return rows.select(*MENTION_COLUMNS)


def events(feed: DataFrame, countries: list[str], days: tuple[date, date] = EVENT_DAYS) -> DataFrame:
    """Events of the period and kinds under study between countries of the plan."""
    rows = feed.filter((F.col("partition_day") >= F.lit(days[0])) & (F.col("partition_day") < F.lit(days[1])))
    rows = rows.filter(F.col("EventRootCode").isin(*ROOT_CODES) & (F.col("QuadClass") == QUAD_CLASS))
    return rows.filter(F.col("Actor1CountryCode").isin(*countries) & F.col("Actor2CountryCode").isin(*countries)).select(*EVENT_COLUMNS)


def tag(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Each event once for every conflict whose sides its actors are on, in either direction.

    The condition over both sides becomes an equi-join with the plan's directed pairs, a table
    as small as the plan, which is a literal.
    """
    pairs = F.broadcast(directed_pairs(plan))
    return rows.join(pairs, (F.col("Actor1CountryCode") == F.col("one")) & (F.col("Actor2CountryCode") == F.col("two"))).drop("one", "two")


def tag_by_sides(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``tag`` by the sides themselves: the first actor finds the conflicts it has a side in, and the
    second one must be among those on the other."""
    own = lambda a, b: plan.select("batch_id", "candidate_conflict_id", F.explode(a).alias("one"), F.col(b).alias("others"))
    against = own("side_a", "side_b").union(own("side_b", "side_a")).groupBy("batch_id", "candidate_conflict_id", "one").agg(F.flatten(F.collect_list("others")).alias("others"))
    return rows.join(F.broadcast(against), F.col("Actor1CountryCode") == F.col("one")).filter(F.array_contains("others", F.col("Actor2CountryCode"))).drop("one", "others")


def paired(tagged: DataFrame, mentioned: DataFrame) -> DataFrame:
    """Event-mention rows, as often as the feed has them."""
    rows = tagged.join(mentioned, "GLOBALEVENTID")
    names = {"MentionIdentifier": "source_url", "MentionSourceName": "source_name", "MentionTimeDate": "gdelt_mention_time", "Confidence": "extraction_confidence", "MentionDocTranslationInfo": "translation_info"}
    return rows.select("batch_id", "candidate_conflict_id", *EVENT_COLUMNS, *(F.col(c).alias(names.get(c, c)) for c in MENTION_COLUMNS[1:]))


def candidates_raw(tagged: DataFrame, mentioned: DataFrame) -> DataFrame:
    """Distinct event-mention rows."""
    return paired(tagged, mentioned).distinct()


KEY = ["candidate_conflict_id", "source_url"]


def url_summary(raw: DataFrame) -> DataFrame:
    """What the mentions of an address under a conflict have in common."""
    return raw.groupBy(*KEY).agg(
        F.min("source_name").alias("source_name"),
        F.min("gdelt_mention_time").alias("first_mention_time"),
        F.min("SQLDATE").alias("first_event_date"),
        F.max("SQLDATE").alias("last_event_date"),
        F.count_distinct("GLOBALEVENTID").alias("event_count"),
        F.array_join(F.array_sort(F.collect_set("EventRootCode")), ",").alias("root_codes"),
        F.max("extraction_confidence").alias("max_confidence"),
        F.bool_or(F.coalesce(F.col("translation_info"), F.lit("")) != "").alias("translated"),
    )


def location_counts(raw: DataFrame) -> DataFrame:
    """Events and first day of every location of an address."""
    return raw.groupBy(*KEY, *(F.col(a).alias(b) for a, b in GEO.items())).agg(F.count_distinct("GLOBALEVENTID").alias("n"), F.min("SQLDATE").alias("first_day"))


def top_locations(counts: DataFrame) -> DataFrame:
    """The location of each address with coordinates, most events and the earliest day, and how
    many locations there are.  Equals are ordered by their values."""
    geo = F.struct(*GEO.values())
    order = F.struct(F.col("geo_lat").isNull(), -F.col("n"), F.col("first_day"), *GEO.values())
    best = counts.groupBy(*KEY).agg(F.min_by(geo, order).alias("g"), F.count("*").alias("location_count"))
    return best.select(*KEY, "g.*", "location_count")


def candidate_urls(raw: DataFrame) -> DataFrame:
    """``url_summary`` and ``top_locations`` of each address, whether ``raw`` repeats rows or not.

    Rows are rolled up by event, then by location, then by address, each time combined before
    they are shuffled, so all of ``raw`` is shuffled once and an address with very many rows is spread
    over its events.  An event counts for each of its locations, and once for the address: with its first one.
    """
    least = {"source_name": "source_name", "first_mention_time": "gdelt_mention_time", "first_event_date": "SQLDATE"}
    most = {"last_event_date": "SQLDATE", "max_confidence": "extraction_confidence", "translated": "translated"}
    both = lambda names: [*(F.min(names.get(c, c)).alias(c) for c in least), *(F.max(names.get(c, c)).alias(c) for c in most)]
    place = F.struct(*(F.col(a).alias(b) for a, b in GEO.items())).alias("place")
    rows = raw.withColumn("translated", F.coalesce(F.col("translation_info"), F.lit("")) != "")
    events = rows.groupBy(*KEY, "GLOBALEVENTID").agg(*both(least | most), F.collect_set("EventRootCode").alias("roots"), F.collect_set(F.struct(place, F.col("SQLDATE").alias("day"))).alias("seen"))
    days = lambda g: F.array_min(F.transform(F.filter("seen", lambda x: x["place"].eqNullSafe(g)), lambda x: x["day"]))
    places = F.transform(F.array_distinct(F.transform("seen", lambda x: x["place"])), lambda g: F.struct(g.alias("place"), days(g).alias("day")))
    located = events.select(*KEY, *least, *most, "roots", F.posexplode(places).alias("nth", "p")).select("*", "p.place", "p.day")
    roots = F.array_distinct(F.flatten(F.collect_set("roots"))).alias("roots")  # sets of a few codes
    located = located.groupBy(*KEY, "place").agg(*both({}), roots, F.count("*").alias("n"), F.count_if(F.col("nth") == 0).alias("events"), F.min("day").alias("first_day"))
    order = F.struct(F.col("place.geo_lat").isNull(), -F.col("n"), F.col("first_day"), "place")
    best = located.groupBy(*KEY).agg(*both({}), roots, F.sum("events").alias("event_count"), F.min_by("place", order).alias("g"), F.count("*").alias("location_count"))
    return best.select(*KEY, "source_name", "first_mention_time", "first_event_date", "last_event_date", "event_count", F.array_join(F.array_sort("roots"), ",").alias("root_codes"), "max_confidence", "translated", "g.*", "location_count")


def article_export(urls: DataFrame) -> DataFrame:
    """Article rows: id, conflict, day of first mention, address, and a title still to be found."""
    day = F.to_date(F.substring(F.col("first_mention_time").cast("string"), 1, 8), "yyyyMMdd")
    return urls.select(fingerprint63(F.concat("candidate_conflict_id", F.lit("|"), "source_url")).alias("article_id"), F.col("candidate_conflict_id").alias("conflict_id"), day.alias("published_date"), F.col("source_url").alias("article_url"), F.lit(None).cast("string").alias("title"))


def in_export_order(articles: DataFrame) -> DataFrame:
    return articles.orderBy("conflict_id", "published_date", "article_url")
