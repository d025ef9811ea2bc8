"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Sources get target shares by weight; a target stops at ``CAP`` times its source's words and the
excess is shared again by weight.  The mix consists of equal blocks of words.  Each block goes to
the source with the highest quotient target / (2 * blocks so far + 1), which gives every source
an integer number of blocks, and, house by house, an integer quota for every output shard: the
method is house-monotone, so a shard's quota is the difference between two houses.

A source's documents are laid in the order of a seeded hash, as a ring of words.  Its blocks lie
side by side on the ring from a seeded start, so a source that gives more words than it has repeats
its ring, and no block but a source's first and last cuts a document.  Shard after shard takes its
quota of them: a document's shard is the one whose blocks hold its first word in the mix.

Null and empty texts have no words and give none.  A very long text may hold several blocks; its words count as those
of many short ones would.  A null source is a source, ordered last.
Repeated rows are rows of their own; rows that are equal in doc_id, source and size may swap.  An
empty table gives an empty result.  Everything runs as DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._session import cut, lazily, table

WEIGHTS = (5, 2, 1)
CAP = 3
#: Blocks of a mix; a block has as many words as that takes, one at least.  Where it would have more
#: than one part in ``PARTS`` of the smallest target, it has that many words and there are more blocks.
BLOCKS = 1 << 16
PARTS = 64
SHARDS = 16
SEED = "mix-1"
WORD = r"[^\x20\x09-\x0D]+"


def _size() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _measured(docs: DataFrame, seed: str) -> DataFrame:
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), _size().alias("size"))
    return slim.withColumn("key", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("size").cast("string")).cast("binary")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """From source, source_size: rank by code point, weight and target (a row for each source)."""
    w = Window.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn("rank", F.row_number().over(w)).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    rows = rows.withColumn("most", F.col("source_size") * cap)
    order = Window.orderBy((F.col("most") / F.col("weight")).asc(), "rank")
    whole = Window.partitionBy()
    # the first sources in this order are full; the level is where the others first stay below
    rows = rows.withColumn("nth", F.row_number().over(order)).withColumn("total", F.sum("source_size").over(whole))
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    full, gone = (F.coalesce(F.sum(c).over(upto), F.lit(0)) for c in ("most", "weight"))
    # the weight from here on is what is left of all: a frame that ends with the table is summed anew for each row
    rows = rows.withColumn("level", (F.col("total") - full) / (F.sum("weight").over(whole) - gone))
    level = F.min_by(F.col("level"), F.when(F.col("level") * F.col("weight") <= F.col("most"), F.col("nth"))).over(whole)
    return rows.withColumn("target", F.least(F.col("most").cast("double"), level * F.col("weight"))).select("source", "source_size", "rank", "weight", "total", "target")


def quotas(goals: DataFrame, blocks: int = BLOCKS, shards: int = SHARDS, cap: int = CAP, parts: int | None = None) -> DataFrame:
    """For each source of ``targets`` and each shard: block_words, blocks of the shards so far
    (``upto``) and of this shard (``quota``).

    Rounding each exact share gives the apportionment of some house; the few blocks that are
    over or missing are then taken or given one by one by quotient.  A source of share s can gain or
    lose s (|missing| + sources) + 1 of them at most, so the quotients looked at are a few for each source.  With ``parts``, a block is no
    more than that part of the smallest target above 0.
    """
    words = F.ceil(F.col("total") / blocks)
    if parts:
        words = F.least(words, F.floor(F.min(F.when(F.col("target") > 0, F.col("target"))).over(Window.partitionBy()) / parts))
    rows = goals.withColumn("block_words", F.greatest(F.lit(1), words).cast("long"))
    rows = rows.withColumn("house_all", F.expr("total div block_words")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    rows = rows.withColumn("house", F.expr(f"house_all * (shard + 1) div {shards}"))
    start = F.floor(F.col("house") * F.col("target") / F.greatest(F.col("total"), F.lit(1)) + 0.5)
    rows = rows.withColumn("seats", start).withColumn("short", F.col("house") - F.sum("seats").over(Window.partitionBy("shard")))
    # a source's seats move by its share of the missing ones and of one for each source, and one more, at most
    sources = F.count("*").over(Window.partitionBy("shard"))
    rows = rows.withColumn("most_moves", F.least(F.abs("short") - 1, F.ceil((F.abs("short") + sources) * F.col("target") / F.greatest(F.col("total"), F.lit(1))) + 2).cast("long"))
    step = F.explode_outer(F.when(F.col("short") != 0, F.sequence(F.lit(0).cast("long"), F.col("most_moves"))))
    tried = rows.select("*", step.alias("j"))
    up = F.col("target") / (2 * (F.col("seats") + F.col("j")) + 1)
    down = F.when(F.col("seats") > F.col("j"), -F.col("target") / (2 * (F.col("seats") - F.col("j")) - 1))
    tried = tried.withColumn("quotient", F.when(F.col("short") > 0, up).otherwise(down))
    best = Window.partitionBy("shard").orderBy(F.col("quotient").desc_nulls_last(), "rank", "j")
    move = F.when((F.row_number().over(best) <= F.abs("short")) & F.col("quotient").isNotNull(), F.signum("short")).otherwise(0).cast("long")
    keys = ["source", "source_size", "rank", "target", "block_words", "shard"]
    seats = tried.withColumn("move", move).groupBy(*keys, "seats").agg(F.sum("move").alias("moved"))
    w = Window.partitionBy("rank").orderBy("shard")
    return seats.withColumn("upto", F.col("seats") + F.col("moved")).withColumn("quota", F.col("upto") - F.coalesce(F.lag("upto").over(w), F.lit(0))).select(*keys, "upto", "quota")


def _start(seed: str, source: Column, size: Column) -> Column:
    digest = F.substring(F.md5(F.concat(F.lit(seed + "@"), F.coalesce(source, F.lit(""))).cast("binary")), 1, 12)
    return F.conv(digest, 16, 10).cast("long") % F.greatest(size, F.lit(1))


@lazily
def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, blocks: int = BLOCKS, shards: int = SHARDS, seed: str = SEED) -> DataFrame:
    """A row for each of ``docs``: size, its source's figures, whole copies (``rounds``), the
    words of one more copy from ``extra_from`` (two runs where the ring closes), ``taken`` and the
    ``shard`` (null where nothing is taken)."""
    measured = cut(_measured(docs, seed).withColumn("bucket", F.substring("key", 1, 3)))
    totals = measured.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_words"))
    sizes = totals.groupBy("source").agg(F.sum("bucket_words").alias("source_size"))
    sources = quotas(targets(sizes, weights, cap), blocks, shards, cap, PARTS).groupBy("source", "source_size", "target", "block_words").agg(F.max("upto").alias("n_blocks"), F.sort_array(F.collect_list("upto")).alias("upto"))  # as many as shards
    given = F.least(F.col("n_blocks") * F.col("block_words"), F.col("source_size") * cap)
    size = F.col("source_size")
    sources = sources.withColumn("given", given).withColumn("rounds", F.when(size > 0, F.expr("given div source_size")).otherwise(0)).withColumn("rest", F.when(size > 0, F.col("given") % size).otherwise(0))
    sources = sources.withColumn("ring", _start(seed, F.col("source"), size)).drop("given", "n_blocks")

    # where a document starts in its source's ring: the buckets before its own, then the keys before its own
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("source", "bucket", F.coalesce(F.sum("bucket_words").over(before), F.lit(0)).alias("bucket_at"))
    inside = Window.partitionBy("source", "bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    placed = measured.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    a, b, c = placed.alias("a"), offsets.alias("b"), sources.alias("c")
    rows = a.join(b, F.col("a.source").eqNullSafe(F.col("b.source")) & (F.col("a.bucket") == F.col("b.bucket")))
    rows = rows.join(c, F.col("a.source").eqNullSafe(F.col("c.source")))
    at = F.col("inside") + F.col("bucket_at")
    rows = rows.select("doc_id", F.col("a.source").alias("source"), "size", "source_size", "target", "block_words", "rounds", "ring", "rest", "upto", at.alias("at"))
    end, stop = F.col("at") + F.col("size"), F.col("ring") + F.col("rest")
    one = F.greatest(F.lit(0), F.least(end, stop, F.col("source_size")) - F.greatest("at", "ring"))
    two = F.greatest(F.lit(0), F.least(end, stop - F.col("source_size")) - F.col("at"))
    rows = rows.withColumn("extra", one).withColumn("extra_from", F.greatest("at", "ring") - F.col("at")).withColumn("extra_head", two)
    rows = rows.withColumn("taken", F.col("rounds") * F.col("size") + F.col("extra") + F.col("extra_head"))
    # words of the source's part of the mix before the document's first one
    ahead = F.when((F.col("at") < F.col("ring")) & (end > F.col("ring")), 0).otherwise(F.pmod(F.col("at") - F.col("ring"), F.greatest("source_size", F.lit(1))))
    return rows.withColumn("shard", F.when(F.col("taken") > 0, F.size(F.filter("upto", lambda x: x * F.col("block_words") <= ahead)))).drop("upto")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each whole copy, and, for the two
    documents at most in which a source's last block ends, a row of just the words taken.

    n_chars, where there is such a column, follows the text.  Where ids repeat, a row takes a plan
    of its own id, source and size, and rows equal in these take theirs one by one.  Other columns
    may have any names.
    """
    p = "mix_"
    while any(c.lower().startswith(p) for c in docs.columns):
        p = "_" + p
    own = lambda name: F.col(p + name)  # noqa: E731  a column of the plan, or made here
    plan = mix(docs, **how).select(*(F.col(c).alias(p + n) for n, c in {"id": "doc_id", "source": "source", "size": "size", "rounds": "rounds", "extra": "extra", "from": "extra_from", "head": "extra_head"}.items()))
    if plan.groupBy(p + "id").count().filter("count > 1").isEmpty():
        rows = docs.join(plan.hint("merge"), docs["doc_id"].cast("long").eqNullSafe(own("id")))  # alike at every size
    else:
        equal = Window.partitionBy(p + "id", p + "source", p + "size")
        plan = plan.withColumn(p + "nth", F.row_number().over(equal.orderBy(p + "rounds", p + "extra", p + "from", p + "head")))
        sized = docs.withColumn(p + "words", _size())
        sized = sized.withColumn(p + "row", F.row_number().over(Window.partitionBy("doc_id", "source", p + "words").orderBy(F.xxhash64("text"))))
        same = F.col("doc_id").cast("long").eqNullSafe(own("id")) & F.col("source").cast("string").eqNullSafe(own("source"))
        rows = sized.join(plan.hint("merge"), same & (own("words") == own("size")) & (own("row") == own("nth")))
    full = own("extra") + own("head") == own("size")
    piece = lambda start, n: F.struct(start.cast("int").alias("start"), n.cast("int").alias("n"))
    copies = F.array_repeat(piece(F.lit(0), F.lit(0)), (own("rounds") + F.when(full, 1).otherwise(0)).cast("int"))
    parts = F.filter(F.array(piece(F.lit(0), own("head")), piece(own("from"), own("extra"))), lambda x: x["n"] > 0)
    rows = rows.filter(own("size") > 0).withColumn(p + "piece", F.explode(F.concat(copies, F.when(full, F.slice(parts, 1, 0)).otherwise(parts))))
    start, n = (F.col(f"{p}piece.{x}") for x in ("start", "n"))
    shorter = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), start + 1, n), "")
    changed = {"text": F.when(n == 0, F.col("text")).otherwise(shorter)}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(n == 0, F.col("n_chars")).otherwise(F.char_length(shorter)).cast(docs.schema["n_chars"].dataType)
    return rows.select(*[changed.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "rounds")


def mixing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of each document of the mix, which the SQL of ``op6_mixing`` doesn't have."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "taken", "shard")
