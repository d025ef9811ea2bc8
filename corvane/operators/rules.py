"""What a sentence says about a named item: used (0), not used (1) or uncertain (2).

A match is judged in columns: gates on the sentence, then, clause by clause, the usage phrases
around the name.  Word lists are data; each is compiled into one expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bounded, clauses, norm, phrases
from .matching import locate

VERSION = "20260923.4"
USED, NOT_USED, UNCERTAIN = 0, 1, 2

# Fixed values of the rules: forms and words with a given meaning.
NOT_USED_FORMS = (
    "can be used", "will be used", "is planning to build", "is preparing to use", "can carry", "(military) exercise / drill", "procurement", "acquisition (of materiel)",
    "distribution (of materiel/supplies)", "maintenance", "delivered (military aid)", "would be delivered", "should be used", "plans to use", "pledged to use",
    "was not launched", "did not fire", "did not engage", "test launch", "war reserves / stockpiled",
)
UNCERTAIN_FORMS = "no", "suggests", "claimed", "says", "has denied supplying", "crashed", "failed to intercept", "engage (fire control order)"
DOUBTFUL_WORDS = "may", "might", "possible", "possibly", "likely", "claimed", "denied"
CONTEXT = (
    "weapons?", "missiles?", "aircraft", "helicopters?", "radars?", "ships?", "vessels?", "submarines?", "tanks?", "drones?", "uavs?", "guns?", "rockets?", "torpedoes?", "fighters?",
    "systems?", "military", "forces", "army", "navy", "soldiers?", "troops", "artillery", "munitions?", "cyber", "electronic", "technology", "technologies", "combat", "battle", "warfare",
)
NOT_IN_ACTION = "exercises?", "drills?", "tests?", "testing", "test-fired", "training", "demonstration", "simulation", "procurement", "maintenance"
NEGATION = "not", "never", "no longer", "didn't", "doesn't", "hasn't", "haven't", "wasn't", "weren't", "isn't", "aren't", "cannot", "can't"
DOUBT = "may", "might", "could", "possibly", "possible", "alleged", "allegedly", "unconfirmed", "unclear", "reportedly", "claimed", "claims", "suggests", "suggested", "likely"
FUTURE = "will", "would", "should", "must", "can", "plans? to", "planning to", "planned to", "intends? to", "intended to", "designed to", "scheduled to", "need to"
ACTION = (
    "used", "using", "employed", "employs", "employing", "utilized", "utilizes", "utilizing", "wielded", "jammed", "jams", "hacked", "hacks", "hacking", "launched", "launches", "launching",
    "carried out", "struck", "strikes", "opened fire", "opens fire", "fired", "firing", "shelled", "shelling", "slammed", "dropped", "drops", "destroyed", "destroys", "destroying", "downed",
    "shoots down", "shot down", "shooting down", "occupied", "imposed", "violated", "fought", "intercepted", "intercepts", "captured", "deployed", "deploys", "deploying", "redeployed",
    "engaged", "engaging", "hit", "detonated", "detonates", "detonating", "targeted", "targeting", "sank", "sunk", "sinks",
)
TYPE_CONTEXT = {
    "W02": ("radar", "sensor", "surveillance", "electronic", "reconnaissance"),
    "W03": ("tank", "armou?red", "vehicle", "apc", "ifv"),
    "W04": ("ship", "vessel", "frigate", "destroyer", "submarine", "corvette", "boat", "naval", "patrol craft"),
    "W05": ("aircraft", "helicopter", "plane", "fighter", "bomber", "drone", "uav", "airframe"),
    "W06": ("missile", "munition", "torpedo", "artillery", "gun", "howitzer", "rocket", "mortar", "ammunition"),
    "W07": ("air.defen[sc]e", "missile", "anti.aircraft"),
    "W09": ("satellite", "spacecraft"),
}
RANKS, RANK_TERMS = ("commander in chief", "lieutenant general", "major general", "prime minister", "king charles", "king abdullah"), ("commander", "general", "king")
TARGET_WORDS = "destroyed", "intercepted", "captured", "shot down", "hit", "targeted"
NEAR, BEFORE = 90, 85
#: A character of a word, of any script.
WORD_CLASS = r"[\p{IsAlphabetic}\p{M}\p{Nd}\p{Pc}\p{IsJoin_Control}]"


def words(options: tuple[str, ...], tail: str = "") -> str:
    """An expression for any of the words as whole words."""
    return r"(?U)\b(?:" + "|".join(options) + ")" + tail + r"\b"


def patterns(usage: DataFrame) -> DataFrame:
    """The rows of ``spelled``, each once."""
    return spelled(usage).distinct()


def spelled(usage: DataFrame, parts: int | None = None) -> DataFrame:
    """phrase, pattern_id, form and code of every phrase of the usage dictionary, some of them more than once;
    those of a pattern and phrase are in one of ``parts`` partitions, or of as many as the planner finds fit.

    The base form's wording gives the code; a doubtful word in the phrase makes it uncertain.  A short file
    makes many phrases: its rows are dealt out before they are taken apart, and phrases before equal ones are
    sought, as a map of all phrases of a file would fill its task's memory without finding any.
    """
    usage = usage.select("pattern_id", "base_form", "trans_form").repartition("pattern_id", "base_form", "trans_form")
    base = F.when(F.col("base_form").isin(*NOT_USED_FORMS), NOT_USED).when(F.col("base_form").isin(*UNCERTAIN_FORMS), UNCERTAIN).otherwise(USED)
    forms = F.filter(F.array(*(F.struct(F.lit(c).alias("form"), F.col(c).alias("raw")) for c in ("base_form", "trans_form"))), lambda x: F.coalesce(x["raw"], F.lit("")) != "")
    rows = usage.select("pattern_id", base.alias("base_code"), F.explode(forms).alias("f")).select("pattern_id", "base_code", "f.form", F.col("f.raw").alias("raw"), F.explode(phrases(F.col("f.raw"))).alias("variant"))
    rows = rows.withColumn("phrase", norm("variant")).filter("phrase <> ''")
    code = F.when(F.col("phrase").rlike(words(DOUBTFUL_WORDS)), UNCERTAIN).otherwise(F.col("base_code"))
    return rows.select("phrase", "pattern_id", "form", code.alias("code")).repartition(*([parts] if parts else []), "pattern_id", "phrase")


def longest(hits: Column) -> Column:
    """Hits (structs with part, start and end) that lie in no longer one of their part."""
    inside = lambda h, g: (g["part"] == h["part"]) & (g["start"] <= h["start"]) & (g["end"] >= h["end"]) & (g["end"] - g["start"] > h["end"] - h["start"])
    return F.filter(hits, lambda h: ~F.exists(hits, lambda g: inside(h, g)))


def plausible(text: Column, term: Column, name: Column, category: Column, sentence: Column, start: Column, end: Column) -> Column:
    """Whether a match may mean the item: the first rule that applies decides."""
    low = F.greatest(start - NEAR, F.lit(0))
    window = F.substring(text, low + 1, end + NEAR - low)
    kind = F.lit(False)
    for prefix, options in TYPE_CONTEXT.items():
        kind = F.when(F.substring(category, 1, 3) == prefix, window.rlike(words(options, "s?"))).otherwise(kind)
    kind = F.when(F.substring(category, 1, 3).isin(*TYPE_CONTEXT), kind).otherwise(window.rlike(words(("weapon",), "s?")))
    as_written = bounded(sentence, name, WORD_CLASS)
    return (
        F.when(category.startswith("T"), True)
        .when(term.rlike(r"^\p{Nd}+$") | (F.char_length(term) == 1), False)
        .when(term.rlike("[a-z]") & term.rlike(r"(?U)\d"), True)
        .when(term.contains(" ") & term.rlike(words(CONTEXT)), True)
        .when(~kind, False)
        .when(text.rlike(words(RANKS)) & term.isin(*RANK_TERMS), False)
        .otherwise(as_written)
    )


def gate(text: Column, term: Column, name: Column, category: Column) -> Column:
    """The reason for which a sentence stays uncertain whatever its phrases, or null."""
    weapon = category.startswith("W")
    shouted = (F.upper(name) == name) & (F.lower(name) != name) & (F.char_length(name) >= 3)
    after = F.slice(F.split(text, r"(?U)\bshot down\s+"), 2, 1_000_000)
    shot = F.exists(after, lambda part: part.startswith(term) | part.startswith(F.concat(F.lit("a "), term)) | part.startswith(F.concat(F.lit("an "), term)) | part.startswith(F.concat(F.lit("the "), term)))
    return (
        F.when((F.char_length(term) <= 3) | term.rlike(r"^\p{Nd}+$"), "ambiguous_short_or_numeric_designation")
        .when(weapon & ~term.rlike(r"(?U)\d") & ~term.contains(" ") & ~shouted, "single_word_weapon_name_requires_review")
        .when(weapon & ~text.rlike(words(CONTEXT)), "weapon_context_unresolved")
        .when(weapon & (text.rlike(r"(?U)\b(?:was|were|been|is|are)\s+(?:" + "|".join(TARGET_WORDS) + r")\b") | shot), "weapon_as_target_does_not_establish_its_use")
        .when(text.rlike(r"(?U)\b(?:armament|equipment|weapon)\s+used\s+by\b") & text.rlike(r"(?U)\bis\b"), "equipment_description_not_specific_use_event")
    )


def adjusted(code: Column, clause: Column, start: Column) -> Column:
    """The code of a hit in its clause.

    The window before a hit is cut from the clause as it was split, at places counted without
    its outer blanks, before any word is looked for in it.
    """
    low = F.greatest(start - BEFORE, F.lit(0))
    prefix = F.substring(clause, low + 1, start - low)
    return (
        F.when(code != USED, code)
        .when(prefix.rlike(words(NEGATION)), NOT_USED)
        .when(prefix.rlike(words(DOUBT)), UNCERTAIN)
        .when(prefix.rlike(words(FUTURE)) | clause.rlike(words(NOT_IN_ACTION)), NOT_USED)
        .when(~clause.rlike(words(ACTION)), UNCERTAIN)
        .otherwise(USED)
    )


def decide(matches: DataFrame, usage: DataFrame) -> DataFrame:
    """match_id, usage_code (null if no verdict), reason and pattern_ids of each match.

    ``usage`` comes from ``patterns``.  A sentence and its clauses are searched together, once for all
    of its matches, and what was found in them is one row for each sentence.
    """
    texts = matches.select("sentence").distinct().withColumn("text", norm("sentence"))
    own = F.transform(clauses(F.col("text")), lambda c, i: F.struct(i.alias("part"), c.alias("clause"), F.trim(c).alias("bare")))
    whole = F.struct(F.lit(-1).alias("part"), F.col("text").alias("clause"), F.col("text").alias("bare"))
    parts = texts.select("sentence", F.explode_outer(F.concat(F.array(whole), own)).alias("p")).select("sentence", "p.*")
    hits = locate(parts, usage, text="bare", term="phrase").withColumn("now", F.when(F.col("part") >= 0, adjusted(F.col("code"), F.col("clause"), F.col("start"))))
    hit = F.when(F.col("part") >= 0, F.struct("part", "bare", "start", "end", "now"))
    found = hits.groupBy("sentence").agg(F.array_sort(F.collect_set(F.when(F.col("part") < 0, F.col("pattern_id")))).alias("pattern_ids"), F.collect_set(hit).alias("hits"))
    found = found.select("sentence", F.when(F.size("pattern_ids") > 0, F.col("pattern_ids")).alias("pattern_ids"), longest(F.col("hits")).alias("hits"))
    named = matches.withColumns({"term": norm("matched_name"), "text": norm("sentence")}).join(found, "sentence", "left")
    near = F.filter("hits", lambda h: bounded(h["bare"], F.col("term")))
    rows = named.withColumn("code", F.array_min(F.transform(near, lambda h: h["now"])))
    args = F.col("text"), F.col("term"), F.col("matched_name"), F.col("category_id")
    rows = rows.withColumn("gate", gate(*args)).withColumn("sound", plausible(*args, F.col("sentence"), F.col("start_pos"), F.col("end_pos")))
    none = F.col("pattern_ids").isNull()
    reason = (
        F.when(~F.col("sound"), "literal_match_without_supported_weapon_reference")
        .when(none, "no_usage_pattern")
        .when(F.col("gate").isNotNull(), F.col("gate"))
        .when(F.col("code").isNull(), "usage_expression_in_other_clause_or_relation_unclear")
        .otherwise("rule_classification")
    )
    code = F.when(~F.col("sound") | none, F.lit(None)).when(F.col("gate").isNotNull(), UNCERTAIN).otherwise(F.coalesce("code", F.lit(UNCERTAIN)))
    return rows.select("match_id", code.cast("int").alias("usage_code"), reason.alias("reason"), F.coalesce("pattern_ids", F.array().cast("array<string>")).alias("pattern_ids"))


def decision_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy(F.coalesce(F.col("usage_code").cast("string"), F.lit("unclassified")).alias("code")).agg(F.count("*").alias("n"))
