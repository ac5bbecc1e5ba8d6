"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A term is a word, its weight the number of times it occurs. Every term has, by hashing alone, a bin and the random
numbers of consistent weighted sampling: r and c from Gamma(2, 1), b from (0, 1). With t = floor(ln w / r + b), the bin
keeps the term with the least ln c - r (t - b + 1), as (term, t). Two texts keep the same sample in a bin with a
probability of their generalised Jaccard similarity (the sum of the lesser weights over that of the greater), so the
share of equal samples among the bins that either text fills is the likeness. Dealing each term out to a few bins takes
a few samples a term instead of one for each term and place of the signature.

Texts are shuffled once, by document, and the words of a document are counted where they then lie.

Defined cases: a null text is an empty one; an empty text has an empty fingerprint, of likeness 1 to another empty one
and 0 to any other; a null doc_id comes after all others, equal doc_ids come in an order of their texts' hashes; rows
that repeat both are one document in the order and all get its result; a table of one document has itself as the next;
further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import WHITE, bucketed, positions, stored, text_of

BINS = 128
#: A weight above this is cut into pieces of it, each a term of its own, at the same places in all texts. That leaves sums of
#: lesser and greater weights as they are, and no bin is ruled by one heavy term.
PIECE = 2
#: Every piece is dealt to so many bins, each time by numbers of its own, so that short texts give more samples.
DEALS = 2
#: Low bits of a sample that the fingerprint keeps beside the number of its bin.
KEPT = 16
#: Least value of the sampling key that is told apart from lower ones, and its steps.
LEAST, STEPS = 128, 1 << 23


def _unit(bits: Column) -> Column:
    """32 random bits as a number between 0 and 1, ends excluded."""
    return (bits + F.lit(0.5)) / F.lit(float(1 << 32))


def _low(hashed: Column) -> Column:
    return hashed.bitwiseAND(F.lit((1 << 32) - 1))


def _high(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 32)


def _gamma(hashed: Column) -> Column:
    """Gamma(2, 1): minus the logarithm of the product of two uniform numbers."""
    return -F.ln(_unit(_low(hashed)) * _unit(_high(hashed)))


def samples(counts: DataFrame, keys: list[str], term: str, weights: list[str], carried: list[str] | None = None) -> DataFrame:
    """(keys, term, weights) → (keys, bin, sample_0, sample_1, ...): of each bin the sample with the least key, for each weight.

    A term's numbers are the same for all weights. A weight of 0 takes no part. Of `carried` columns each bin keeps the least value.
    """
    carried = carried or []
    most = F.greatest(F.lit(1), F.ceil(F.greatest(*weights) / PIECE))
    cut = counts.select(*keys, *carried, *weights, F.col(term).alias("term"), F.explode(F.sequence(F.lit(0).cast("long"), most - 1)).alias("piece"))
    part = lambda w: F.greatest(F.lit(0.0), F.least(F.lit(float(PIECE)), F.col(w) - F.col("piece") * PIECE))
    cut = cut.select(*keys, *carried, *[part(w).alias(w) for w in weights], F.xxhash64("term", "piece").alias("term"))
    dealt = cut.select(*keys, *carried, *weights, "term", F.explode(F.array(*[F.lit(i) for i in range(DEALS)])).alias("deal"))
    hashed = lambda n: F.xxhash64(F.lit(n), F.col("deal"), F.col("term"))
    drawn = dealt.withColumns({"r": _gamma(hashed(1)), "log_c": F.ln(_gamma(hashed(2))), "third": hashed(3)})
    drawn = drawn.withColumn("b", _unit(_low(F.col("third"))))

    def sample(weight: str) -> Column:
        t = F.floor(F.ln(F.col(weight).cast("double")) / F.col("r") + F.col("b"))
        least = F.col("log_c") - F.col("r") * (t - F.col("b") + 1)
        key = F.floor(F.greatest(F.lit(0.0), (least + LEAST) * STEPS)).cast("long")
        return F.when(F.col(weight) > 0, F.shiftleft(key, 32).bitwiseOR(_low(F.xxhash64("term", t))))

    own = BINS // DEALS
    bin_ = (F.col("deal") * own + (_high(F.col("third")) % own)).cast("int").alias("bin")
    found = drawn.select(*keys, *carried, bin_, *[sample(w).alias(f"sample_{i}") for i, w in enumerate(weights)])
    return found.groupBy(*keys, "bin").agg(*[F.min(c).alias(c) for c in [f"sample_{i}" for i in range(len(weights))] + carried])


#: A SHA-256 hash as four numbers, which a hash aggregate can keep.
QUARTERS = ["hash_0", "hash_1", "hash_2", "hash_3"]


def quarters(text: Column) -> list[Column]:
    hashed = F.sha2(text, 256)
    return [F.conv(F.substring(hashed, 16 * i + 1, 16), 16, -10).cast("long").alias(name) for i, name in enumerate(QUARTERS)]


def whole_hash() -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(name), 16, "0") for name in QUARTERS]))


def words(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, term, hash): a row for each word of the text; and one with an empty word where there is a hash."""
    found = rows.select(*keys, *QUARTERS, F.explode(F.split(F.col(text), f"{WHITE}+")).alias("word")).where("word <> '' OR hash_0 IS NOT NULL")
    return found.select(*keys, *QUARTERS, F.xxhash64("word").alias("term"))


def as_text(fingerprint: Column) -> Column:
    """Six hexadecimal digits for each entry."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 6, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples among the bins that either of two fingerprints fills."""
    bins = lambda f: F.transform(f, lambda x: F.shiftright(x, KEPT))
    filled = F.size(a) + F.size(b) - F.size(F.array_intersect(bins(a), bins(b)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def _keyed(docs: DataFrame) -> DataFrame:
    """Two columns without nulls that tell documents apart, and the text."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.xxhash64("doc_id", text_of()).alias("h"),
        text_of().alias("text"),
    )


def following(docs: DataFrame) -> DataFrame:
    """(id, h, doc_id, n_chars, rows, next_id, next_h, next_rows) of every different document, stored."""
    light = docs.groupBy("doc_id", "id", "h").agg(F.min(F.length("text")).cast("long").alias("n_chars"), F.count(F.lit(1)).alias("rows"))
    ranked = stored(positions(light, F.col("doc_id").asc_nulls_last(), F.col("h")), "order")
    number = max(1, ranked.count())
    after = ranked.select(F.col("position").alias("at"), F.col("id").alias("next_id"), F.col("h").alias("next_h"), F.col("rows").alias("next_rows"))
    return stored(ranked.join(after, F.col("at") == (F.col("position") + 1) % number).drop("position", "at"), "following")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document and its edited text: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    A fingerprint is an ascending array of integers, a bin in the high bits and its sample in the low ones.
    """
    docs = _keyed(docs)
    order = following(docs)
    # What the document before takes from a text: at most a quarter of its own length.
    heads = docs.join(order.select(F.col("id").alias("to_id"), F.col("h").alias("to_h"), F.floor(F.col("n_chars") / 4).alias("cut"), F.col("next_id"), F.col("next_h")),
                      (F.col("id") == F.col("next_id")) & (docs["h"] == F.col("next_h")))
    heads = heads.select("to_id", "to_h", F.expr("left(text, int(cut))").alias("head"))
    edited = F.concat(F.expr("left(text, int(n_chars - floor(n_chars / 4)))"), F.col("head"))
    placed = (
        docs.drop("doc_id")
        .join(order, ["id", "h"])
        .join(heads, (F.col("id") == F.col("to_id")) & (F.col("h") == F.col("to_h")))
        .select("id", "h", "doc_id", "n_chars", "rows", (F.col("rows") * F.col("next_rows")).alias("copies"), "text", edited.alias("edited"))
    )
    none = [F.lit(None).cast("long").alias(name) for name in QUARTERS]
    sides = [
        F.struct(F.lit(0).alias("side"), F.col("text"), *none),
        F.struct(F.lit(1).alias("side"), F.col("edited").alias("text"), *none),
        # The edited text's hash goes along as a row of its own, which counts for neither side.
        F.struct(F.lit(2).alias("side"), F.lit("").alias("text"), *quarters(F.col("edited"))),
    ]
    texts = placed.select("id", "h", "copies", F.inline(F.array(*sides)))
    # Rows that repeat a document bring its words so many times; the weight is that of one.
    counts = words(texts, ["id", "h", "copies", "side"], "text").groupBy("id", "h", "copies", "term")
    counts = counts.agg(*[F.count_if(F.col("side") == n).alias(f"n{n}") for n in (0, 1)], *[F.min(name).alias(name) for name in QUARTERS])
    counts = counts.select("id", "h", "term", *QUARTERS, *[(F.col(f"n{n}") / F.col("copies")).alias(f"w{n}") for n in (0, 1)])
    kept = samples(counts, ["id", "h"], "term", ["w0", "w1"], QUARTERS)
    entry = lambda n: F.shiftleft(F.col("bin"), KEPT).bitwiseOR(F.col(f"sample_{n}").bitwiseAND(F.lit((1 << KEPT) - 1)).cast("int"))
    prints = kept.groupBy("id", "h").agg(*[F.sort_array(F.collect_list(entry(n))).alias(name) for n, name in enumerate(("fingerprint", "edited_fingerprint"))], *[F.min(name).alias(name) for name in QUARTERS])
    # Bucketed as it lies, so that the two joins that follow don't shuffle it.
    prints = bucketed(prints, "prints", "id", "h")

    after = order.select(F.col("id").alias("to_id"), F.col("h").alias("to_h"), F.col("next_id").alias("id"), F.col("next_h").alias("h"))
    next_prints = after.join(prints.select("id", "h", F.col("fingerprint").alias("next_fingerprint")), ["id", "h"]).drop("id", "h")
    full = (
        order.select("id", "h", "doc_id", "n_chars", "rows").join(prints, ["id", "h"])
        .join(next_prints, (F.col("id") == F.col("to_id")) & (F.col("h") == F.col("to_h")))
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    )
    return full.select(
        "doc_id", "n_chars", whole_hash().alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )
