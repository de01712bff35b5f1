"""Mixing sources to target weights with Sainte-Laguë quotas.

Words are the tokens. Sources, ordered by code point with null last, weigh 5, 2, 1,
repeating, and share ``share`` times the words of all documents. A target stops at
``cap`` times the words of its source; the excess is shared again by weight.

Each source is dealt by a seeded hash of the document's id and text into shards of about
``SHARD_WORDS`` words, each cut into blocks of ``BLOCK_WORDS`` words along a seeded
order of its documents. Quotas come from Sainte-Laguë's method: all targets together make
a house of blocks, the sources compete for it with the quotients target / (2k + 1), k = 0,
1, ..., and the highest quotients win a block each; then the shards of a source compete
in the same way, by their sizes, for the blocks of the source. Equal quotients go to the smaller
source, then shard. A party's list of quotients ends at ``cap`` times its own blocks. A quota
of q blocks takes every block q div n times and a run of q mod n blocks from a seeded
start, around the end.

Quotients that win or lose for certain are counted, not listed: with house H, n parties and
votes V in all, the last winning quotient lies where V / d is within n / 2 of H, so some four
quotients a party are left, which are ranked in ranges over many tasks.

Nothing depends on the size of one source: a source is split into shards, sums are
combined before they are shuffled, and documents join the small table of sources.

Defined results: a null text or one without words has size 0 and is taken 0 times; a
null source is a source of its own; repeated rows are documents of their own, and null ids or
one id for all rows are spread by their texts; an empty table gives an empty result; other
columns are kept, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, fresh, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 16
SHARD_WORDS = 1 << 16
SEED = 20240


@dataclass(frozen=True)
class Mix:
    """``rows`` has the documents and, under the names given here, how they are taken."""

    rows: DataFrame
    size: str
    source_size: str
    target: str
    taken: str
    passes: str
    cuts: tuple[str, str, str, str]


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP, weights=WEIGHTS) -> DataFrame:
    """``sizes`` (source, source_size), a row per source -> source, place, source_size, weight, target and other columns.

    ``place`` numbers the sources in order.
    """
    spark = sizes.sparkSession
    # The order of any number of sources: range partitions, written so that they stay as they are.
    placed = written(
        sizes.repartitionByRange(F.col("source").isNull(), F.col("source"))
        .withColumn("part", F.spark_partition_id()), "mix-sources")
    counts = sorted((r.part, r.n) for r in placed.groupBy("part").agg(F.count("*").alias("n")).collect())
    offset, starts = 0, []
    for part, n in counts:
        starts.append((part, offset))
        offset += n
    starts = spark.createDataFrame(starts, "part int, start long")
    within = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    rank = F.col("start") + F.row_number().over(within) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights)).cast("int") + 1)
    weighed = written(placed.join(F.broadcast(starts), "part")
                      .select(*sizes.columns, rank.cast("long").alias("place"), weight.alias("weight")), "mix-weights")
    total, all_weights = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    total = float(total or 0)
    level, before = (share * total / all_weights if total else 0.0), None
    while level != before and total:
        full = F.col("weight") * level > cap * F.col("source_size")
        capped, free = weighed.agg(
            F.sum(F.when(full, cap * F.col("source_size")).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        level, before = ((share * total - capped) / free if free else level), level
    target = F.least(F.col("weight") * level, cap * F.col("source_size").cast("double"))
    return weighed.withColumn("target", target)


def apportion(parties: DataFrame) -> DataFrame:
    """Seats by Sainte-Laguë's highest quotients, in each group.

    ``parties``: place (the group), party, votes (above 0), house (seats of the group) and most (seats that
    the party can fill). Result: place, party, seats. A group's seats add up to its house, or to what its parties
    can fill. A party whose list of quotients ends early keeps ``most``; the others are dealt the rest again.
    """
    done, left = None, written(parties.select("place", "party", "votes", "house", "most"), "mix-parties")
    while True:
        dealt = written(_highest_quotients(left), "mix-dealt")
        full = dealt.filter("seats >= most")
        over = not dealt.filter("seats > most").isEmpty()
        part = (full.withColumn("seats", F.col("most")) if over else dealt).select("place", "party", "seats")
        done = part if done is None else done.unionByName(part)
        if not over:
            return done
        used = full.groupBy("place").agg(F.sum("most").alias("used"))
        left = written(
            dealt.filter("seats < most").join(used, "place", "left")
            .withColumn("house", F.col("house") - F.coalesce("used", F.lit(0)))
            .select("place", "party", "votes", "house", "most"), "mix-parties")


def _highest_quotients(parties: DataFrame) -> DataFrame:
    """``parties`` and their seats, as if every list of quotients went on."""
    sums = parties.groupBy("place").agg(F.sum("votes").alias("all_votes"), F.count("*").alias("n"))
    scale = F.col("votes") / F.col("all_votes")
    sure = F.ceil(scale * (F.col("house") - F.col("n") / 2) - 0.5) - 1
    never = F.floor(scale * (F.col("house") + F.col("n") / 2) + 0.5) + 1
    bounds = parties.join(sums, "place").withColumns({
        "sure": F.greatest(sure, F.lit(0)).cast("long"), "never": F.greatest(never, F.lit(0)).cast("long")})
    bounds = written(bounds.select(*parties.columns, "sure", "never"), "mix-bounds")
    open_ = (
        bounds.filter("never > sure")
        .select("place", "party", "votes", F.explode(F.sequence(F.col("sure"), F.col("never") - 1)).alias("k"))
        .select("place", "party", (F.col("votes") / (2 * F.col("k") + 1)).alias("quotient"))
    )
    # Ranked in ranges, written so that they stay as they are.
    ranges = written(
        open_.repartitionByRange("place", F.desc("quotient"), "party").withColumn("part", F.spark_partition_id()),
        "mix-quotients")
    counts = ranges.groupBy("place", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("place", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    wanted = bounds.groupBy("place").agg((F.max("house") - F.sum("sure")).alias("wanted"))
    within = Window.partitionBy("place", "part").orderBy(F.desc("quotient"), "party")
    won = (
        ranges.withColumn("nth", F.row_number().over(within)).join(starts, ["place", "part"]).join(wanted, "place")
        .filter(F.col("start") + F.col("nth") <= F.col("wanted"))
        .groupBy("place", "party").agg(F.count("*").alias("won"))
    )
    return (
        bounds.join(won, ["place", "party"], "left")
        .withColumn("seats", F.col("sure") + F.coalesce("won", F.lit(0)))
        .drop("sure", "never", "won")
    )


def source_seats(targets: DataFrame, block: int, cap: float) -> DataFrame:
    """place, house: the blocks of each source, out of as many as all targets together make."""
    votes = targets.filter("target > 0").select(
        F.lit(0).cast("long").alias("place"), F.col("place").alias("party"), F.col("target").alias("votes"),
        F.ceil(cap * F.col("source_size") / block).cast("long").alias("most"))
    house = int((votes.agg(F.sum("votes")).first()[0] or 0) / block + 0.5)
    return apportion(votes.withColumn("house", F.lit(house).cast("long"))).select(
        F.col("party").alias("place"), F.col("seats").alias("house"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        share: float = SHARE, cap: float = CAP, weights=WEIGHTS, block: int = BLOCK_WORDS,
        shard_words: int = SHARD_WORDS, seed: int = SEED) -> Mix:
    names = fresh(docs, "size", "source_size", "target", "taken", "passes", "cut_a", "cut_b", "cut_c", "cut_d",
                  "mix_source", "shard", "draw", "upto", "place", "shards", "shard_size", "seats", "mark")
    (size, source_size, target, taken, passes, a, b, c, d, key, shard, draw, upto, place, shards, shard_size, seats,
     mark) = names
    sized = docs.withColumn(size, words_of(F.col(text_col))).withColumn(
        mark, F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)))
    sums = sized.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(size).alias("source_size"), F.count("*").alias("n_docs"))
    targets = written(source_targets(sums, share, cap, weights), "mix-targets")
    # Documents without words count too, so that no shard has many of them.
    n_shards = F.ceil(F.greatest("source_size", "n_docs") / shard_words).cast("long")
    known = targets.select(F.col("source").alias(key), F.col("place").alias(place), n_shards.alias(shards),
                           F.col("source_size").alias(source_size), F.col("target").alias(target))
    rows = (
        sized.join(known, F.col(source_col).eqNullSafe(F.col(key)))
        .withColumn(shard, F.pmod(F.col(mark), F.col(shards)))
        .withColumn(draw, F.xxhash64(F.lit(seed + 1), F.col(mark)))
    )
    parties = (
        rows.filter(F.col(size) > 0).groupBy(F.col(place).alias("place"), F.col(shard).alias("party"))
        .agg(F.sum(size).alias("votes")).join(source_seats(targets, block, cap), "place")
        .withColumn("most", F.floor(cap * F.ceil(F.col("votes") / block)).cast("long"))
    )
    parties = written(parties, "mix-shards")
    quotas = (
        parties.join(apportion(parties), ["place", "party"])
        .select(F.col("place").alias(place), F.col("party").alias(shard), F.col("votes").alias(shard_size),
                F.col("seats").alias(seats))
    )
    layout = Window.partitionBy(place, shard).orderBy(draw, id_col, size).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(quotas, [place, shard], "left").withColumn(upto, F.sum(size).over(layout))
    blocks = F.greatest(F.ceil(F.coalesce(F.col(shard_size), F.lit(0)) / block), F.lit(1)).cast("long")
    quota = F.coalesce(F.col(seats), F.lit(0)).cast("long")
    rest = quota % blocks
    start = F.pmod(F.xxhash64(F.lit(seed + 2), F.col(key), F.col(shard)), blocks)
    from_, zero = F.col(upto) - F.col(size), F.lit(0).cast("long")

    def within(word: Column) -> Column:
        """A word of the shard as a word of this document."""
        return F.greatest(F.least(word, F.col(upto)), from_) - from_

    # The run of blocks after its start, and the part that goes on at the front.
    rows = (
        rows.withColumn(passes, F.floor(quota / blocks).cast("int"))
        .withColumn(a, within(start * block)).withColumn(b, within((start + rest) * block))
        .withColumn(c, within(zero)).withColumn(d, within(F.greatest((start + rest - blocks) * block, zero)))
        .withColumn(taken, F.col(passes) * F.col(size) + F.col(b) - F.col(a) + F.col(d) - F.col(c))
    )
    return Mix(rows.drop(key, shard, draw, upto, place, shards, shard_size, seats, mark), size, source_size, target, taken, passes, (a, b, c, d))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    n_chars_col: str | None = "n_chars", **options) -> DataFrame:
    """The mix itself: a row for each time a document is taken, cut where only a part is.

    A whole copy for each pass, then the words of the blocks that the rest of the quota
    takes, in the order of the text. Columns as in ``docs``.
    """
    found = mix(docs, id_col, text_col, source_col, **options)
    a, b, c, d = found.cuts
    copy, pieces = fresh(found.rows, "copy", "pieces")
    part = F.col(b) - F.col(a) + F.col(d) - F.col(c)
    rows = (
        found.rows.filter(F.col(found.taken) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(found.passes) + (part > 0).cast("int"))))
        .filter((F.col(copy) <= F.col(found.passes)) | (part > 0))
    )
    whole = (F.col(copy) <= F.col(found.passes)) | (part == F.col(found.size))

    def words(start: str, end: str) -> Column:
        return F.slice(F.col(pieces), F.col(start).cast("int") + 1, (F.col(end) - F.col(start)).cast("int"))

    space = r"[\x20\x09-\x0D]*"
    rows = rows.withColumn(pieces, F.when(~whole, F.regexp_extract_all(F.col(text_col), F.lit(f"{space}{WORD}"),
                                                                       F.lit(0))))
    text = F.when(whole, F.col(text_col)).otherwise(
        F.array_join(F.concat(words(c, d), words(a, b)), ""))
    rows = rows.withColumn(text_col, text)
    if n_chars_col and n_chars_col in docs.columns:
        rows = rows.withColumn(n_chars_col, F.char_length(F.col(text_col)).cast("long"))
    return rows.select(*[F.col(f"`{x}`") for x in docs.columns])
