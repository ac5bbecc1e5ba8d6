"""SimHash near-dedup for a wanted similarity: wide fingerprints, choices of pigeonhole blocks, and a check on the shingles themselves.

`simhash` links by a fixed small distance of 64 bits. Texts whose five-word shingles have a Jaccard similarity of 0.8 differ in some
ten of 64 bits, too many for whole blocks of a useful width to agree. Here a fingerprint has 256 bits, in blocks of two. Two
texts' fingerprints differ in each bit with a probability that follows from their similarity, so that a choice of blocks with k
bits in all agrees with a known probability. Fingerprints are dealt out by as many choices as make it likely that near texts
meet in one; k grows with the logarithm of the number of fingerprints, so that others seldom meet.

Where few meet, all pairs are checked. Where many do, they are first checked against the lowest of them, so that a whole group of near
copies costs one pair for each member. Then every pair of such a crowd that is not in one group yet is compared too, in blocks of
bounded size; a pair within a group could add nothing. So every pair that meets anywhere is checked or joined already.
The check is the Hamming distance, then the exact similarity of the sets of shingles. Links are joined to groups.

Defined cases: only documents with the same text share a fingerprint and a group without a check; texts of fewer words than a shingle
have one shingle, texts without words none, and are alike only to those; a null text is an empty one; a null
doc_id is never the id of a group unless nothing else is in it; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import ship, stored, text_of
from marketlake.llm.components import components

#: Words of a shingle, and the similarity from which texts are near.
WORDS, LEAST = 5, 0.8
#: 64-bit words of a fingerprint, and bits of a block.
LANES, BLOCK = 4, 2
BITS = 64 * LANES
#: Wanted probability that a pair of the least similarity meets in a choice.
MET = 0.97
#: Standard deviations of the Hamming distance that the first check allows beyond the mean for the least similarity.
ALLOWED = 3.0
#: Fingerprints that are paired off where they meet.
PAIRED = 8
#: Fingerprints of a crowd that meet as many others in one task; rows of them that are compared at once.
SIDE, STRIP = 2048, 256
#: Shingles of a block of a crowd, about.
SHINGLES = 1 << 21
CHUNK = 1 << 15
SEED = 42


def differing(similarity: float) -> float:
    """Share of bits in which fingerprints of sets of equal size and this Jaccard similarity differ."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


RADIUS = math.ceil(BITS * differing(LEAST) + ALLOWED * math.sqrt(BITS * differing(LEAST) * (1 - differing(LEAST))))


def choices(number: int) -> list[list[int]]:
    """Choices of blocks for so many fingerprints: each a list of blocks, without repeats, seeded."""
    blocks = max(3, math.ceil((math.log2(max(2, number)) + 2) / BLOCK))
    one = (1 - differing(LEAST)) ** (blocks * BLOCK)
    draw = random.Random(SEED)
    made: set[tuple[int, ...]] = set()
    while len(made) < math.ceil(math.log(1 - MET) / math.log(1 - one)):
        made.add(tuple(sorted(draw.sample(range(BITS // BLOCK), blocks))))
    return [list(c) for c in sorted(made)]


def shingles(text: str) -> np.ndarray:
    """64-bit hashes of the different shingles, ascending."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    total = max(1, len(found) - WORDS + 1)
    return np.unique(np.array([xxhash.xxh64_intdigest(b" ".join(found[i : i + WORDS]), SEED) for i in range(total)], dtype=np.uint64))


def _mixed(hashes: np.ndarray, lane: int) -> np.ndarray:
    """Other 64 bits out of a shingle's hash for each lane."""
    x = hashes + np.uint64((lane * 0x9E3779B97F4A7C15) & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprint(hashes: np.ndarray) -> list[int]:
    """Signed 64-bit lanes of the SimHash over the shingles."""
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start : start + CHUNK]
        lanes = np.stack([_mixed(part, lane) for lane in range(LANES)], axis=1).astype(">u8")
        ones += np.unpackbits(lanes.view(np.uint8).reshape(len(part), -1), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > max(1, len(hashes))).view(">i8").tolist()


def placed(lanes: np.ndarray, chosen: list[list[int]], only: list[int] | None = None) -> np.ndarray:
    """A place for each fingerprint (row of lanes) and choice (or those choices `only`): a hash of the choice and of its blocks' bits."""
    in_lane = 64 // BLOCK
    lanes, mask = lanes.view(np.uint64), np.uint64((1 << BLOCK) - 1)
    blocks = [lanes[:, b // in_lane] >> np.uint64(BLOCK * (b % in_lane)) & mask for b in range(LANES * in_lane)]
    only = list(range(len(chosen))) if only is None else only
    out = np.empty((len(lanes), len(only)), dtype=np.uint64)
    for column, n in enumerate(only):
        key = np.zeros(len(lanes), dtype=np.uint64)
        for b in chosen[n]:
            key = key << np.uint64(BLOCK) | blocks[b]
        out[:, column] = _mixed(key, n + 1)  # no two of them meet: keys are far shorter than the gaps between the choices' shifts
    return out.view(np.int64)


def _lane(name: str, lane: int) -> Column:
    return F.col(f"{name}.l{lane}")


def _distance(a: str, b: str) -> Column:
    return sum((F.bit_count(_lane(a, n).bitwiseXOR(_lane(b, n))) for n in range(LANES)), F.lit(0))


def prints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, fp) of every document, stored. `text_id` is a hash of the text, the same for equal texts alone."""
    ship(docs.sparkSession)
    kind = "struct<" + ",".join(f"l{n}:long" for n in range(LANES)) + ">"

    @F.pandas_udf(kind)
    def fp(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([fingerprint(shingles(t)) for t in texts], columns=[f"l{n}" for n in range(LANES)])

    return stored(_texts(docs).select("doc_id", "text_id", fp("text").alias("fp")), "wide-prints")


#: Bits of a place: those that name its bucket (some 4,000 buckets) and the others.
BUCKET, REST = 12, 32


def places_of(hashes: np.ndarray) -> np.ndarray:
    """Places as they are kept: the first bits alone."""
    return (hashes.view(np.uint64) >> np.uint64(64 - BUCKET - REST)).astype(np.int64)


def meeting(distinct: DataFrame, chosen: list[list[int]]) -> DataFrame:
    """(place, n, lowest, text_id, fp), stored: the texts that meet in a choice, how many they are there, and whether one has the lowest number of them.

    Most texts meet nobody, so that their places go to one of some buckets packed: 32 bits of a place and 16 bits of a text's number, as
    arrays of bytes. Two places may share these bits; who meets so by chance is told apart by the checks.
    """
    spark = distinct.sparkSession

    def deal(batches):
        for batch in batches:
            numbers = batch["number"].to_numpy()
            lanes = batch[[f"l{n}" for n in range(LANES)]].to_numpy()
            for base in np.unique(numbers >> 16):
                own = np.flatnonzero(numbers >> 16 == base)
                places = places_of(placed(lanes[own], chosen)).ravel()
                buckets = places >> REST
                order = np.argsort(buckets, kind="stable")
                rest = places[order].astype(np.uint32)
                offsets = np.repeat((numbers[own] & 0xFFFF).astype(np.uint16), len(chosen))[order]
                found, starts = np.unique(buckets[order], return_index=True)
                ends = np.append(starts[1:], len(order))
                yield pd.DataFrame({
                    "bucket": found, "base": int(base) << 16,
                    "places": [rest[x:y].tobytes() for x, y in zip(starts, ends)], "offsets": [offsets[x:y].tobytes() for x, y in zip(starts, ends)],
                })

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        rest = np.concatenate([np.frombuffer(x, np.uint32) for x in group["places"]])
        numbers = np.concatenate([base + np.frombuffer(x, np.uint16).astype(np.int64) for base, x in zip(group["base"], group["offsets"])])
        order = np.lexsort((numbers, rest))
        rest, numbers = rest[order], numbers[order]
        starts = np.flatnonzero(np.append(True, rest[1:] != rest[:-1]))
        counts = np.diff(np.append(starts, len(rest)))
        n, lowest = np.repeat(counts, counts), np.zeros(len(rest), dtype=bool)
        lowest[starts] = True
        met = n > 1
        place = (int(group["bucket"].iloc[0]) << REST) + rest[met].astype(np.int64)
        return pd.DataFrame({"place": place, "n": n[met], "lowest": lowest[met], "number": numbers[met]})

    lanes = distinct.select("number", *[F.col(f"fp.l{n}").alias(f"l{n}") for n in range(LANES)])
    packed = lanes.mapInPandas(deal, "bucket long, base long, places binary, offsets binary")
    # By the number of partitions asked for: the bytes are few.
    packed = packed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "bucket")
    met = stored(packed.groupBy("bucket").applyInPandas(meet, "place long, n long, lowest boolean, number long"), "met-ids")
    # The others' bits join those that meet somebody.
    return stored(met.join(distinct, "number").select("place", "n", "lowest", "text_id", "fp"), "met")


def candidates(met: DataFrame) -> DataFrame:
    """(a, b), stored: texts whose fingerprints differ in at most RADIUS bits, out of all pairs of a place where few meet, and of the lowest with all others of a crowd."""
    few, crowded = met.where(F.col("n") <= PAIRED), met.where(F.col("n") > PAIRED)
    pairs = few.select("place", F.col("text_id").alias("a"), F.col("fp").alias("fa")).join(few.select("place", F.col("text_id").alias("b"), F.col("fp").alias("fb")), "place")
    pairs = pairs.where((F.col("a") < F.col("b")) & (_distance("fa", "fb") <= RADIUS)).select("a", "b")
    lowest = crowded.where("lowest").select("place", F.col("text_id").alias("low"), F.col("fp").alias("fb"))
    against = crowded.where("NOT lowest").join(lowest, "place").where(_distance("fp", "fb") <= RADIUS)
    return stored(pairs.union(against.select(F.least("low", "text_id").alias("a"), F.greatest("low", "text_id").alias("b"))).distinct(), "candidates")


def _strips(left: np.ndarray, right: np.ndarray, lanes: np.ndarray, root: np.ndarray):
    """Rows (x, y) of texts in different groups whose fingerprints differ in at most RADIUS bits, strip by strip."""
    for start in range(0, len(left), STRIP):
        strip = left[start : start + STRIP]
        distance = np.zeros((len(strip), len(right)), dtype=np.uint16)
        for n in range(LANES):
            distance += np.bitwise_count(lanes[strip, n][:, None] ^ lanes[right, n][None, :])
        x, y = np.nonzero((distance <= RADIUS) & (root[strip][:, None] != root[right][None, :]))
        yield strip[x], right[y]


def _sides(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    first = group["own"].to_numpy() == group["i"].iloc[0]
    return np.flatnonzero(first), np.flatnonzero(first if group["i"].iloc[0] == group["j"].iloc[0] else ~first)


def crossing(met: DataFrame, roots: DataFrame, held: DataFrame, chosen: list[list[int]]) -> DataFrame:
    """(a, b), stored: links between texts of a crowd that are near and in different groups so far.

    A crowd is dealt into blocks of a bounded number of texts and shingles; a task compares one block with one. First by the fingerprints: who has a pair within RADIUS
    that meets in no earlier choice stays. Then by the sets of shingles, which go to the blocks of those that stayed. A block gives no more
    links than it has texts, as a pair that is joined by then adds nothing; pairs themselves are never rows.
    """
    bits = [f"l{n}" for n in range(LANES)]
    crowded = met.where(F.col("n") > PAIRED).join(roots, F.col("text_id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "text_id"))
    crowded = crowded.join(held.select("text_id", "size"), "text_id")
    crowded = stored(crowded.select("place", "text_id", "root", "size", *[_lane("fp", n).alias(f"l{n}") for n in range(LANES)]), "crowds")
    number = F.ceil(F.greatest(F.count(F.lit(1)) / SIDE, F.sum("size") / SHINGLES)).cast("int")
    mixed = crowded.groupBy("place").agg(F.min("root").alias("least"), F.max("root").alias("most"), number.alias("blocks")).where("least < most")
    dealt = (
        crowded.join(mixed, "place")
        .withColumn("own", F.pmod(F.xxhash64("text_id"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("place", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "text_id", "root", *bits)
    )
    uses = np.zeros((BITS // BLOCK, len(chosen)), dtype=np.float32)
    for n, numbers in enumerate(chosen):
        uses[numbers, n] = 1

    def stay(group: pd.DataFrame) -> pd.DataFrame:
        lanes, root = group[bits].to_numpy().view(np.uint64), group["root"].to_numpy()
        wanted, kept = group["place"].iloc[0], np.zeros(len(group), dtype=bool)
        for x, y in _strips(*_sides(group), lanes, root):
            for start in range(0, len(x), CHUNK):
                u, v = x[start : start + CHUNK], y[start : start + CHUNK]
                differ = np.unpackbits((lanes[u] ^ lanes[v]).astype(">u8").view(np.uint8).reshape(len(u), LANES, 8), axis=2)
                # A lane's blocks are numbered from its last bits on.
                differ = differ.reshape(len(u), LANES, 64 // BLOCK, BLOCK).any(axis=3)[:, :, ::-1].reshape(len(u), -1)
                agree = differ.astype(np.float32) @ uses == 0
                first = agree.argmax(axis=1)
                here = agree[np.arange(len(u)), first]
                for choice in np.unique(first[here]).tolist():
                    of = here & (first == choice)
                    at = places_of(placed(lanes[u[of]].view(np.int64), chosen, [choice])[:, 0]) == wanted
                    kept[u[of][at]] = kept[v[of][at]] = True
        return group[kept]

    def check(group: pd.DataFrame) -> pd.DataFrame:
        ids, root, size = group["text_id"].to_numpy(), group["root"].to_numpy().copy(), group["size"].to_numpy()
        lanes, sets = group[bits].to_numpy().view(np.uint64), group["held"].to_numpy()
        ends = np.cumsum([0, *[len(held) for held in sets]])
        known, codes = np.unique(np.concatenate(sets), return_inverse=True)
        of, links = np.zeros(len(known), dtype=bool), []
        for x, y in _strips(*_sides(group), lanes, root):
            near_size = np.minimum(size[x], size[y]) >= LEAST * np.maximum(size[x], size[y])
            for u in np.unique(x[near_size]):
                mine = codes[ends[u] : ends[u + 1]]
                of[mine] = True
                for v in y[near_size & (x == u)]:
                    if root[u] != root[v]:
                        both = int(of[codes[ends[v] : ends[v + 1]]].sum())
                        if both >= LEAST * (size[u] + size[v] - both):
                            links.append((min(ids[u], ids[v]), max(ids[u], ids[v])))
                            root[root == root[v]] = root[u]
                of[mine] = False
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    schema = "place long, i int, j int, own int, text_id long, root long, " + ", ".join(f"{b} long" for b in bits)
    # By the number of partitions asked for: the blocks are few bytes and much work, so that they must not be put together by size.
    parts, block = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions")), ["place", "i", "j"]
    stayed = stored(dealt.repartition(parts, *block).groupBy(*block).applyInPandas(stay, schema), "stayed")
    blocks = stayed.join(held, "text_id").repartition(parts, *block)
    return stored(blocks.groupBy(*block).applyInPandas(check, "a long, b long").distinct(), "crossing")


def shingle_sets(asked: DataFrame, docs: DataFrame, firsts: DataFrame) -> DataFrame:
    """(text_id, held, size), stored: the shingles of the texts asked for, of one copy each. The texts are moved once."""

    @F.pandas_udf("array<long>")
    def hashed(values: pd.Series) -> pd.Series:
        return pd.Series([shingles(t).view(np.int64) for t in values])

    asked = stored(asked.distinct().join(firsts, "text_id"), "asked")
    texts = _texts(docs).join(asked, "text_id").where(F.col("doc_id").eqNullSafe(F.col("first_id")))
    return stored(texts.select("text_id", hashed("text").alias("held")).dropDuplicates(["text_id"]).withColumn("size", F.size("held")), "shingles")


def verified(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs whose sets of shingles have a Jaccard similarity of LEAST or more: each set goes to its pairs, where the JVM compares them row by row."""
    a, b = (held.select(F.col("text_id").alias(n), F.col("held").alias(f"h{n}"), F.col("size").alias(f"n{n}")) for n in "ab")
    # Sets of too different a size go before any set is moved.
    sized = pairs.join(a.drop("ha"), "a").join(b.drop("hb"), "b").where(F.least("na", "nb") >= LEAST * F.greatest("na", "nb")).select("a", "b")
    both = stored(sized, "sized-pairs").join(a, "a").join(b, "b").withColumn("both", F.size(F.array_intersect("ha", "hb")))
    return stored(both.where(F.col("both") >= LEAST * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b"), "near-links")


def _texts(docs: DataFrame) -> DataFrame:
    text = text_of()
    return docs.select(F.xxhash64(text, F.lit(SEED), F.length(text)).alias("text_id"), F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))


def near_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, text_id, component_id) of every document: the smallest doc_id reachable over pairs of near texts."""
    seen = prints(docs)
    distinct = stored(seen.groupBy("text_id").agg(F.min("doc_id").alias("first_id"), *[F.min(_lane("fp", n)).alias(f"l{n}") for n in range(LANES)])
                      .select("text_id", "first_id", F.monotonically_increasing_id().alias("number"), F.struct(*[f"l{n}" for n in range(LANES)]).alias("fp")), "distinct-texts")
    chosen = choices(distinct.count())
    met = meeting(distinct, chosen)
    firsts = distinct.select("text_id", "first_id")
    pairs = candidates(met)
    # Whoever is in a crowd may be compared again.
    asked = pairs.select(F.explode(F.array("a", "b")).alias("text_id")).union(met.where(F.col("n") > PAIRED).select("text_id"))
    held = shingle_sets(asked, docs, firsts)
    links = verified(pairs, held)
    roots = components(links)
    further = crossing(met, roots, held, chosen)
    if further.head(1):
        roots = components(links.union(further))
    rooted = stored(firsts.join(roots, F.col("text_id") == F.col("node"), "left").select("text_id", "first_id", F.coalesce("root", "text_id").alias("root")), "near-roots")
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    groups = stored(rooted.join(stored(ids, "near-ids"), "root").select("text_id", "component_id"), "near-groups")
    return seen.join(groups, "text_id").select("doc_id", "text_id", "component_id")


def representatives(docs: DataFrame) -> DataFrame:
    """The documents of which doc_id is the smallest of its group, with all columns; without a doc_id, one that is in no other group.

    Rows that repeat a doc_id are one document to this stage: all of them stay or go.
    """
    kept = near_groups(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_kept")).distinct()
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("_kept")), "left_semi")
