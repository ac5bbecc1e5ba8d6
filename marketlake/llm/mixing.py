"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame functions only.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and share all words; a target stops at three
times its source's size and the excess is shared again. Blocks of equal size then go to sources by highest quotients,
and each source's blocks go to its shards in the same way, so that every shard has a whole number of blocks. Within a
shard, documents lie in a seeded order; the quota takes the shard's line of words from its start, round after round, so
that documents are taken whole but for one a shard. A source is split into shards by its number of documents: no group
grows with the corpus.

Defined cases: a null or empty text has size 0 and nothing is taken of it; a null source is a source of its own; rows
that repeat are documents of their own; without any words all targets are 0; further columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import WHITE, positions, size_in_words, stored, text_of

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = 42
#: Words of a block.
BLOCK = 16
#: Documents of a shard, on average.
SHARD = 10_000


def sainte_lague(parties: DataFrame, group: str, party: str, votes: str, totals: DataFrame) -> DataFrame:
    """(group, party, quota): the seats of each group shared among its parties by highest quotients votes / (2k + 1).

    `totals` has group, seats and all_votes. Rounding votes over the standard divisor gives all seats but at most half
    as many as there are parties; those are settled by the quotients next to the rounded numbers, which are ranked
    over all groups at once. Ties go to the party that comes first.
    """
    exact = F.when(F.col("all_votes") > 0, F.col(votes) * F.col("seats") / F.col("all_votes")).otherwise(F.lit(0.0))
    rounded = stored(
        parties.join(totals, group).select(group, party, F.col(votes).cast("double").alias("votes"), "seats", "all_votes", F.floor(exact + 0.5).alias("base")),
        "rounded",
    )
    # Between the standard divisor and the final one, a party moves by its share of half the number of parties, and one.
    off = rounded.groupBy(group).agg((F.first("seats") - F.sum("base")).alias("off"), F.count(F.lit(1)).alias("parties"))
    off = stored(off.where("off <> 0"), "seats-off")
    reach = F.ceil(F.col("parties") * F.col("votes") / (2 * F.col("all_votes"))).cast("long") + 1
    more = F.sequence(F.col("base"), F.col("base") + reach)
    fewer = F.sequence(F.greatest(F.lit(0), F.col("base") - reach), F.col("base") - 1)
    seat = F.when(F.col("off") > 0, more).when(F.col("base") > 0, fewer)
    quotient = F.col("votes") / (2 * F.col("seat") + 1)
    near = (
        rounded.where("all_votes > 0").join(off, group)
        .withColumn("seat", F.explode(seat))
        .select(group, party, "off", F.when(F.col("off") > 0, -quotient).otherwise(quotient).alias("turn"), "seat")
    )
    ranked = stored(positions(near, F.col(group), F.col("turn"), F.col(party), F.col("seat")), "quotients")
    first = stored(ranked.groupBy(group).agg(F.min("position").alias("first")), "first-quotients")
    settled = ranked.join(first, group).where(F.col("position") - F.col("first") < F.abs("off"))
    settled = settled.groupBy(group, party).agg(F.sum(F.signum("off")).cast("long").alias("change"))
    return rounded.join(settled, [group, party], "left").select(group, party, (F.col("base") + F.coalesce("change", F.lit(0))).alias("quota"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> tuple[DataFrame, int]:
    """(source, source_size) → (source, source_id, source_size, docs, target), and the number of all words.

    Only sums reach the driver: each round fixes the sources above their limit and shares the rest anew.
    """
    ranked = positions(sizes, F.col("source").asc_nulls_last(), name="source_id")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("source_id") % len(weights)).cast("int") + 1)
    ranked = stored(ranked.withColumn("weight", weight), "sources")
    limit = F.col("source_size") * most
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    share, above = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(share) > limit
        now, fixed, open_weight = ranked.agg(
            F.count_if(over), F.coalesce(F.sum(F.when(over, limit)), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))
        ).first()
        if now == above or not open_weight:
            break
        share, above = (total - fixed) / open_weight, now
    over = F.col("weight") * F.lit(share) > limit
    return ranked.withColumn("target", F.when(over, limit.cast("double")).otherwise(F.col("weight") * F.lit(share))), int(total)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Every document with its plan: row (all columns), doc_id, size, source_size, target, taken.

    `taken` counts words, repeats included; it is at most `most` times the size. What isn't selected is never shuffled.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("doc_id"),
        F.col("source").cast("string").alias("source"),
        size_in_words(text_of()).alias("size"),
        F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).alias("turn"),
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    sources, total = targets(sizes, weights, most)
    sources = stored(sources.withColumn("shards", F.ceil(F.col("docs") / F.lit(SHARD))).withColumn("all", F.lit(0)), "targets")

    blocks = sources.groupBy("all").agg(F.lit(round(total / block)).alias("seats"), F.lit(float(total)).alias("all_votes"))
    source_quotas = sainte_lague(sources, "all", "source_id", "target", stored(blocks, "blocks"))
    source_quotas = sources.select("source_id", F.col("source_size").alias("all_votes")).join(source_quotas.select("source_id", F.col("quota").alias("seats")), "source_id")

    placed = rows.join(sources.select(F.col("source").alias("_source"), "source_id", "source_size", "target", "shards"), F.col("source").eqNullSafe(F.col("_source")))
    placed = placed.withColumn("shard", F.pmod("turn", "shards"))
    shards = stored(placed.groupBy("source_id", "shard").agg(F.sum("size").alias("shard_size")), "shards")
    quotas = stored(sainte_lague(shards, "source_id", "shard", "shard_size", stored(source_quotas, "source-quotas")).join(shards, ["source_id", "shard"]), "quotas")

    words = F.least(F.col("quota") * block, F.col("shard_size") * most)
    rounds = F.when(F.col("shard_size") > 0, F.floor(words / F.col("shard_size"))).otherwise(F.lit(0))
    quotas = quotas.select("source_id", "shard", rounds.alias("rounds"), (words - rounds * F.col("shard_size")).alias("rest"))
    line = Window.partitionBy("source_id", "shard").orderBy("turn", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("start", F.coalesce(F.sum("size").over(line), F.lit(0))).join(quotas, ["source_id", "shard"])
    extra = F.greatest(F.lit(0), F.least(F.col("rest") - F.col("start"), F.col("size")))
    return placed.select("row", "doc_id", "size", "source_size", "target", (F.col("rounds") * F.col("size") + extra).cast("long").alias("taken"))


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus, columns as before: a document as many times as it is taken whole, and once more with its first
    words, joined by spaces, where it is taken in part. What isn't taken goes."""
    plan = mix(docs, **options).where("taken > 0")
    whole, rest = F.floor(F.col("taken") / F.col("size")), F.col("taken") % F.col("size")
    copies = plan.withColumn("whole", whole).withColumn("rest", rest).withColumn("copy", F.explode(F.sequence(F.lit(1), F.expr("whole + if(rest > 0, 1, 0)"))))
    first = F.array_join(F.slice(F.filter(F.split(F.col("row.text"), f"{WHITE}+"), lambda w: w != ""), F.lit(1), F.col("rest").cast("int")), " ")
    text = F.when(F.col("copy") > F.col("whole"), first).otherwise(F.col("row.text"))

    def column(name: str) -> Column:
        if name == "text":
            return text.alias(name)
        if name == "n_chars":
            return F.when(F.col("copy") > F.col("whole"), F.length(text).cast("long")).otherwise(F.col("row.n_chars")).alias(name)
        return F.col(f"row.`{name}`")

    return copies.select(*[column(c) for c in docs.columns])
