"""SimHash near-dedup: 64-bit fingerprints, pigeonhole blocks, a check of the Hamming distance, connected groups.

Two fingerprints that differ in at most `RADIUS` bits agree in `BLOCKS - RADIUS` of their blocks. Each
distinct fingerprint is therefore dealt out once for each choice of that many blocks, and pairs are verified within a
choice. A choice shared by many different fingerprints isn't paired off: its fingerprints are dealt out again by every
value one bit away (of the bits outside the choice). Two fingerprints are at most two bits apart exactly if they share
such a value, and a value has at most one fingerprint for each free bit, so nothing is left out and no group is large.

Defined cases: a null or empty text has fingerprint zero and links like any other; equal texts have equal
fingerprints; a null doc_id is never the id of a group unless nothing else is in it; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import ship, stored, text_of
from marketlake.llm.components import components

BITS = 64
SEED = 42
#: Four blocks of 16 bits: for a radius of two, six choices of 32 bits.
BLOCKS = 4
#: Differing bits up to which fingerprints are linked. The way around crowded choices rests on this number.
RADIUS = 2
#: A choice of blocks with more distinct fingerprints than this is not paired off but dealt out bit by bit.
PAIRED = 32
#: Shingles are hashed and counted so many at a time, whatever the length of a text.
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int) -> int:
    """Signed 64-bit SimHash over the word shingles, repeats included, that XXH64 hashes."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not found:
        return 0
    total = max(1, len(found) - words + 1)
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, total, CHUNK):
        end = min(total, start + CHUNK)
        hashes = b"".join([xxhash.xxh64_digest(b" ".join(found[i : i + words]), SEED) for i in range(start, end)])
        ones += np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total).view(">i8")[0])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, fp) of every document, stored."""
    ship(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), fp(text_of()).alias("fp")), "fingerprints")


def _choices() -> list[list[int]]:
    """For each choice of blocks, its bits."""
    width = BITS // BLOCKS
    return [[b * width + i for b in chosen for i in range(width)] for chosen in combinations(range(BLOCKS), BLOCKS - RADIUS)]


def _signed(bits: list[int]) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >= 1 << (BITS - 1) else value


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): links between different fingerprints; the groups they connect are those of all links of at most two bits.

    All pairs of an ordinary choice are returned; of a crowded one, for each value one bit away, links to the lowest.
    """
    choices = _choices()
    dealt = distinct.select(
        "fp",
        F.explode(F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(_signed(bits))).alias("key")) for i, bits in enumerate(choices)])).alias("c"),
    ).select("fp", "c.choice", "c.key")
    dealt = stored(dealt, "blocks")
    sizes = stored(dealt.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "block-sizes")
    shared = stored(dealt.join(sizes, ["choice", "key"]), "shared-blocks")

    few = shared.where(F.col("n") <= PAIRED)
    pairs = few.select("choice", "key", F.col("fp").alias("a")).join(few.select("choice", "key", F.col("fp").alias("b")), ["choice", "key"])
    pairs = pairs.where((F.col("a") < F.col("b")) & (_distance(F.col("a"), F.col("b")) <= RADIUS)).select("a", "b").distinct()
    free = F.array(*[F.array(F.lit(0), *[F.lit(_signed([b])) for b in range(BITS) if b not in bits]) for bits in choices])
    crowded = shared.where(F.col("n") > PAIRED)
    near = crowded.select("fp", "choice", F.explode(F.element_at(free, F.col("choice") + 1)).alias("bit"))
    near = near.groupBy("choice", F.col("fp").bitwiseXOR(F.col("bit")).alias("value")).agg(F.collect_list("fp").alias("fps"))
    stars = near.where(F.size("fps") > 1).select(F.explode("fps").alias("a"), F.array_min("fps").alias("b"))
    stars = stars.where((F.col("a") != F.col("b")) & (_distance(F.col("a"), F.col("b")) <= RADIUS)).distinct()
    return pairs.union(stars)


def near_groups(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every document, component_id being the smallest doc_id reachable over links.

    Only distinct fingerprints are linked: copies of one text, however many, are one node.
    """
    prints = fingerprints(docs, words)
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = components(links(distinct))
    rooted = stored(distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root")), "roots")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = stored(rooted.join(stored(ids, "component-ids"), "root").select("fp", "component_id"), "groups")
    return prints.join(groups, "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, words: int = 3) -> DataFrame:
    """The documents of which doc_id is the smallest of its group, with all columns; without a doc_id, one that is in no other group.

    Rows that repeat a doc_id are one document to this stage: all of them stay or go.
    """
    kept = near_groups(docs, words).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("_kept")), "left_semi")
