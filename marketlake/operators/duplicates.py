"""Duplicate flags without gathering a key's rows in one task."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# Writes a frame out and reads it back, so that the planner knows its size before it picks a join.
Settle = Callable[[DataFrame], DataFrame]


def same_key(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Join condition on a composite key whose NULLs equal each other."""
    return reduce(lambda a, b: a & b, [l.eqNullSafe(r) for l, r in zip(left, right)])


def first_rows(rows: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """(keys, _first): each key's first row in `order_by`. Every map task passes on one row per key, however many a key has."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    return rows.withColumn("_nth", nth).where("_nth = 1").select(*keys, F.struct(*order_by).alias("_first"))


#: Bits of the table of marks, and those of one of its words.
MARKS, WORD = 26, 6


def _mark(hash_: Column) -> tuple[Column, Column]:
    """Word and bit of a hash in the table of marks."""
    place = F.shiftrightunsigned(hash_, 64 - MARKS)
    return F.shiftright(place, WORD), place.bitwiseAND(F.lit((1 << WORD) - 1)).cast("int")


def marked(df: DataFrame, hash_: Column, hashes: DataFrame, flag: str) -> DataFrame:
    """Adds whether a row's hash may be among the hashes (`_h`): true for all that are, and for a few of the others.

    The marks are at most 2^20 words of 64 bits, however many hashes there are, and are broadcast.
    """
    word, bit = _mark(F.col("_h"))
    words = hashes.groupBy(word.alias("_word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("_bits"))
    word, bit = _mark(hash_)
    found = df.withColumn("_at", word).join(F.broadcast(words), F.col("_at") == F.col("_word"), "left")
    hit = F.coalesce(F.call_function("shiftrightunsigned", "_bits", bit).bitwiseAND(F.lit(1).cast("bigint")) == 1, F.lit(False))
    return found.withColumn(flag, hit).drop("_at", "_word", "_bits")


def label_duplicates(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    flag: str = "_is_duplicate",
    history: DataFrame | None = None,
    settle: Settle | None = None,
) -> DataFrame:
    """Flag every row of a key except the first in `order_by`. NULL keys equal each other.

    `order_by` has to tell any two rows of a key apart. Keys are counted by a 64-bit hash first, which a hash aggregate does on
    numbers alone; only rows whose hash repeats are looked through for firsts, and only those firsts are joined back.
    `history` supplies the rows to look for firsts in when `df` is only a part of the table. With `settle`, the
    repeated hashes and the firsts are stored on the way, and a small table of marks tells which rows may be of a repeated key: those alone
    meet the firsts, and the others pass by, so that the table is never shuffled, however many keys repeat. `df` is read several times then, so that it should be a stored
    table. Without `settle` nothing runs until the result is asked for.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = (df if history is None else history).select(F.xxhash64(*keys).alias("_h"), *[F.col(k).alias(n) for k, n in zip(keys, names)], *order_by)
    repeated = rows.groupBy("_h").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_h")
    if settle is not None:
        repeated = settle(repeated)
        rows = marked(rows, F.col("_h"), repeated, "_maybe").where("_maybe").drop("_maybe")
    firsts = first_rows(rows.join(repeated, "_h", "left_semi"), ["_h", *names], order_by).withColumnRenamed("_h", "_fh")
    hit = (F.xxhash64(*keys) == F.col("_fh")) & same_key([F.col(k) for k in keys], [F.col(n) for n in names])
    later = F.col("_first").isNotNull() & (F.struct(*order_by) > F.col("_first"))

    def against_firsts(some: DataFrame, firsts: DataFrame) -> DataFrame:
        return some.join(firsts, hit, "left").withColumn(flag, later).drop("_first", "_fh", *names)

    if settle is None:
        return against_firsts(df, firsts)
    told = marked(df, F.xxhash64(*keys), repeated, "_maybe")
    alone = told.where("NOT _maybe").withColumn(flag, F.lit(False))
    return alone.drop("_maybe").unionByName(against_firsts(told.where("_maybe").drop("_maybe"), settle(firsts)))
