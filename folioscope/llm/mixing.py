"""Mixing sources to target weights by Sainte-Lague apportionment.

Every source is a stream of words, cut into blocks of equally many. Its target is its share by weight of all
words, held at ``max_repeats`` times its own size; what that frees goes to the other sources by weight.
Blocks are allocated to sources by highest quotients target / (2k + 1), and the blocks of a source to its
shards by the same rule on shard sizes. Inside a shard the documents stand in a seeded order, and the quota
is taken as a run of blocks from a seeded start, round and round. The last block of a shard may be partial: what
rounding to blocks, or the limit of a shard, leaves over or short of the target goes to the source's shards in order, so
each source gives its rounded target exactly, and no word is taken more than ``max_repeats`` times.

The highest-quotient rule is not walked block by block: the quotas are the rounded targets in blocks, and only
the quotients around them are ranked for the few blocks that rounding leaves over or short. Only the table of sources
and the shards of one source are ever ordered as a whole; documents are ordered inside a shard, which holds
about ``shard_words`` words of one source.

Defined results: a null text has size 0 and takes nothing; documents of one source with equal id and size are
interchangeable. Documents without id are dealt to shards by their text. A null source is a source, last in order.
Sources without words take nothing, and an empty table gives no rows. Texts of any length are counted whole and may be
taken in part. Extra columns play no part, whatever their names, and are not returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioscope.llm.stages import stage
from folioscope.scale import null_safe_join

BLOCK_WORDS = 128
SHARD_WORDS = 1 << 18
MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
SEED = 17
WORD_BREAK = "[ \\t-\\r]+"
BLANKS = " \t\n\v\f\r"


def word_count(text: Column) -> Column:
    """Runs of characters other than space and 0x09-0x0D; 0 for null."""
    def blank(c: Column) -> Column:
        return F.when(c.isin(*BLANKS), 1).otherwise(0)

    pieces = F.size(F.split(text, WORD_BREAK, -1))  # a blank end of the text adds one empty piece
    counted = pieces - blank(F.substring(text, 1, 1)) - blank(F.substring(text, -1, 1))
    return F.when(text.isNull() | (text == ""), 0).otherwise(counted).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size, weight, target) from (source, size): one row per source.

    The level at which no target is above its limit is found in one pass over the sources in order of
    limit / weight: sources below it stand at their limit, the others at weight times the level.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.asc_nulls_last("source"))
    place = (F.row_number().over(order) - 1) % len(weights) + 1
    weighed = totals.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), place))
    limit = F.col("source_size") * max_repeats
    by_level = Window.orderBy(limit / F.col("weight"), F.asc_nulls_last("source"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(limit).over(before), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    # the level of the first source that fits holds for it and all after it; from there on levels only fall
    fits = weighed.withColumn("__level", level).withColumn("__fits", limit >= F.col("__level") * F.col("weight"))
    found = F.max(F.when(F.col("__fits"), F.col("__level"))).over(whole)
    return fits.withColumn("__found", found).select(
        "source", F.col("source_size").cast("long").alias("source_size"), "weight",
        F.when(limit < F.col("__found") * F.col("weight"), limit.cast("double"))
        .otherwise(F.coalesce(F.col("__found") * F.col("weight"), limit.cast("double"))).alias("target"))


def sainte_lague(rows: DataFrame, claim: str, seats: str, out: str, keys: list[str], within: list[str]) -> DataFrame:
    """Adds ``out``: the seats of each row by highest quotients claim / (2k + 1) among the rows of ``within``.

    claim * seats / total, rounded, gives each row its seats but for the few that the sum is off. Those go
    to the highest next quotients, or are taken back at the lowest last ones. A row can be off by no more than its
    part of (off + 1) against the largest row, and one for rounding, so that many quotients of it are ranked.
    ``keys`` name a row; ties of quotients go by them.
    """
    group = Window.partitionBy(*within)
    exact = F.when(F.sum(claim).over(group) > 0, F.col(claim) * F.col(seats) / F.sum(claim).over(group)).otherwise(0.0)
    rows = rows.withColumn("__exact", exact).withColumn("__seats", F.round("__exact").cast("long"))
    rows = rows.withColumn("__off", F.col(seats) - F.sum("__seats").over(group))
    reach = F.col("__exact") * (F.abs("__off") + 1) / F.max("__exact").over(group) + 1
    steps = rows.withColumn("__reach", reach).filter((F.col("__off") != 0) & (F.col(claim) > 0)).withColumn(
        "__step", F.explode(F.sequence(F.lit(0), F.ceil("__reach").cast("int"))))
    up = F.col("__off") > 0
    held = F.col("__seats") + F.when(up, F.col("__step")).otherwise(-1 - F.col("__step"))
    steps = steps.filter(held >= 0).withColumn("__quotient", F.col(claim) / (2 * held + 1))
    first = F.when(up, -F.col("__quotient")).otherwise(F.col("__quotient"))
    moved = steps.withColumn("__rank", F.row_number().over(group.orderBy(first, *[F.asc_nulls_last(k) for k in keys]))).filter(
        F.col("__rank") <= F.abs("__off")).groupBy(*keys).agg(F.sum(F.signum("__off")).cast("long").alias("__moved"))
    joined = null_safe_join(rows, moved, keys, "left")
    return joined.withColumn(out, F.col("__seats") + F.coalesce("__moved", F.lit(0))).drop("__exact", "__seats", "__off", "__moved")


def to_target(shards: DataFrame, max_repeats: int) -> DataFrame:
    """``words`` of each shard (source, shard, shard_size, target, words) made to sum to the source's rounded target.

    Words that are missing go to the shards in order, as far as each has room; words too many are taken back likewise.
    """
    source = Window.partitionBy("source")
    before = source.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)

    def run(amount: Column, room: Column) -> Column:
        return F.greatest(F.least(amount - F.coalesce(F.sum(room).over(before), F.lit(0)), room), F.lit(0))

    missing = F.round("target").cast("long") - F.sum("words").over(source)
    room = F.col("shard_size") * max_repeats - F.col("words")
    words = F.when(missing >= 0, F.col("words") + run(missing, room)).otherwise(F.col("words") - run(-missing, F.col("words")))
    return shards.withColumn("words", words.cast("long"))


def _hash(seed: int, key: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def _number(digest: Column, start: int) -> Column:
    return F.conv(F.substring(digest, start, 8), 16, 10).cast("long")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", *,
                weights: tuple[int, ...] = WEIGHTS, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
                max_repeats: int = MAX_REPEATS, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken, and the run of words taken.

    ``full`` is how often the whole document is taken; beyond that the words from ``first`` (0-based) up to
    ``last`` and, where the run goes round, from 0 up to ``wrapped`` are taken once more.
    """
    sized = stage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        _hash(seed, F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))).alias("__order")),
        "document-sizes")
    sources = source_targets(sized, weights, max_repeats)
    whole = Window.partitionBy()
    blocks = F.round(F.sum("target").over(whole) / block_words).cast("long")
    sources = sainte_lague(sources.withColumn("__blocks", blocks), "target", "__blocks", "quota", ["source"], [])
    sources = stage(sources.withColumn("shards", F.ceil(F.greatest("source_size", F.lit(1)) / shard_words)), "source-quotas")
    named = sources.select(F.col("source").alias("__s"), "source_size", "target", "quota", "shards")
    placed = sized.join(named, F.col("source").eqNullSafe(F.col("__s"))).drop("__s").withColumn(
        "shard", _number(F.col("__order"), 1) % F.col("shards"))

    sizes = placed.groupBy("source", "shard", "quota", "target").agg(F.sum("size").alias("shard_size"))
    shards = sainte_lague(sizes, "shard_size", "quota", "shard_quota", ["source", "shard"], ["source"])
    start = F.when(F.col("shard_size") > 0, _number(_hash(seed + 1, F.concat_ws(
        "/", F.coalesce("source", F.lit("")), "shard")), 1) % F.col("shard_size"))
    shards = to_target(shards.withColumn("words", F.least(F.col("shard_quota") * block_words, F.col("shard_size") * max_repeats)), max_repeats)
    shards = shards.select(F.col("source").alias("__s"), F.col("shard").alias("__k"), "shard_size", start.alias("start"), "words")
    stream = Window.partitionBy("source", "shard").orderBy("__order", "doc_id", "size")
    placed = placed.withColumn("__end", F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0)))
    joined = placed.join(shards, F.col("source").eqNullSafe(F.col("__s")) & (F.col("shard") == F.col("__k")))

    low, size = F.col("__end") - F.col("size"), F.col("size")
    full = F.when(F.col("shard_size") > 0, F.floor(F.col("words") / F.col("shard_size"))).otherwise(0)
    rest = F.when(F.col("shard_size") > 0, F.col("words") % F.col("shard_size")).otherwise(0)
    over = F.greatest(F.col("start") + rest - F.col("shard_size"), F.lit(0))
    begin = F.least(F.greatest(F.col("start") - low, F.lit(0)), size)
    end = F.greatest(F.least(F.col("start") + rest - low, size), begin)
    wrap = F.least(F.greatest(over - low, F.lit(0)), size)
    out = joined.withColumns({"full": full.cast("long"), "first": F.coalesce(begin, F.lit(0)).cast("long")}).withColumns({
        "last": F.coalesce(end, F.lit(0)).cast("long"), "wrapped": F.coalesce(wrap, F.lit(0)).cast("long")})
    return out.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("full") * size + F.col("last") - F.col("first") + F.col("wrapped")).alias("taken"),
        "shard", "full", "first", "last", "wrapped")
