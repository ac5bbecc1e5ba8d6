"""Token ids in files of 64-bit words by Simple-8b, written and read by Spark tasks.

A word holds a selector in its high four bits and 60 bits of ids: as many ids as fit at the selector's width, from 240
zeros down to one id of 60 bits. Ids are coded in blocks of a fixed number; the offset of every block in the words is kept, so that
any block is decoded by itself and all words of a selector are unpacked at once. An id that 60 bits don't hold is an
escape: its place in the words has all bits set and its value stands in a list, with offsets by block as well.

A segment is one image of bytes (`encode`): header, block offsets, escape offsets, words, escapes. `write` orders the documents by
doc_id over range partitions; every partition is a shard and writes its segments, each a row with the image and the ids and lengths of
its whole documents. The rows lie in Parquet files, so that lost tasks and executors leave no half-written segment
and any file system that Spark knows will do. `read` gives the documents back, `tokens` a stretch of the stream of all ids.

Defined cases: a null or empty text is the end token alone; a null doc_id comes before all others; rows with equal doc_id are each
written, in an order of their texts; a text of any length lies in one segment; an empty table gives no rows; no column besides
doc_id and text is read. A text that holds the name of a special token gets that token's id, as the tokenizer gives it.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.llm.common import WORD, scratch, ship, text_of

TOKENIZER, END = "word_bpe_49k.json", 2
#: Fixed values of the code: ids in a word and bits of an id, by selector.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
ESCAPE = (1 << 60) - 1
#: Ids in a block, and ids after which a segment is closed.
BLOCK, SEGMENT = 1024, 1 << 20
MAGIC, HEADER = b"S8TK", struct.Struct("<4sIQQQ")
SEGMENTS = "shard int, segment int, start long, n_ids long, doc_ids array<long>, lengths array<long>, image binary"


# --- the code -----------------------------------------------------------------------------------


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs."""
    if ids.size and int(ids.max()) >= 1 << 53:
        return np.searchsorted(np.uint64(1) << np.arange(61, dtype=np.uint64), ids, "right").astype(np.uint8)
    return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)


def _selectors(ids: np.ndarray) -> np.ndarray:
    """Blocks of ids, each row followed by at least 240 zeros → at every place the selector that takes the most ids from there on."""
    places = ids.shape[1] - COUNTS[0]
    most, span = _bits(ids), 1
    found = np.full((len(ids), places), 15, dtype=np.uint8)
    for selector in range(14, -1, -1):
        count = COUNTS[selector]
        while 2 * span <= count:  # the most over twice as many ids
            most = np.maximum(most[:, :-span], most[:, span:])
            span *= 2
        widest = np.maximum(most[:, :places], most[:, count - span : count - span + places])
        found[widest <= WIDTHS[selector]] = selector
    return found


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """Any unsigned 64-bit ids as the image of a segment."""
    ids = np.asarray(ids, dtype=np.uint64)
    blocks = -(-len(ids) // block)
    big = ids >= ESCAPE
    escapes = ids[big]
    padded = np.zeros(blocks * block, dtype=np.uint64)
    padded[: len(ids)] = np.where(big, np.uint64(ESCAPE), ids)
    rows = np.zeros((blocks, block + COUNTS[0]), dtype=np.uint64)
    rows[:, :block] = padded.reshape(blocks, block)
    length = np.minimum(block, len(ids) - block * np.arange(blocks))
    chosen, counts = _selectors(rows), np.array(COUNTS)
    own, at = np.arange(blocks), np.zeros(blocks, dtype=np.int64)
    steps = [(own[:0], at[:0], np.zeros(0, dtype=np.uint8))]
    while len(own):  # one word of every block at a time
        selector = chosen[own, at]
        steps.append((own, at, selector))
        at = at + counts[selector]
        on = at < length[own]
        own, at = own[on], at[on]
    of, place, selector = (np.concatenate(x) for x in zip(*steps))
    order = np.lexsort((place, of))
    of, place, selector = of[order], place[order], selector[order]
    words = selector.astype(np.uint64) << np.uint64(60)
    for s in range(16):
        at = np.flatnonzero(selector == s)
        if len(at) and WIDTHS[s]:
            for i in range(COUNTS[s]):
                words[at] |= rows[of[at], place[at] + i] << np.uint64(WIDTHS[s] * i)
    offsets = np.searchsorted(of, np.arange(blocks + 1))
    escape_offsets = np.searchsorted(np.flatnonzero(big) // block, np.arange(blocks + 1))
    head = HEADER.pack(MAGIC, block, len(ids), len(words), len(escapes))
    return b"".join([head, *[x.astype("<u8").tobytes() for x in (offsets, escape_offsets, words, escapes)]])


def decode(image: bytes, start: int = 0, end: int | None = None) -> np.ndarray:
    """The ids of an image from `start` to before `end`; only the blocks that hold them are unpacked."""
    magic, block, n, n_words, n_escapes = HEADER.unpack_from(image)
    if magic != MAGIC:
        raise ValueError("not a segment of token ids")
    end = n if end is None else min(end, n)
    if start >= end:
        return np.zeros(0, dtype=np.uint64)
    blocks = -(-n // block)
    body = np.frombuffer(image, dtype="<u8", offset=HEADER.size)
    offsets, escape_offsets = body[: blocks + 1].astype(np.int64), body[blocks + 1 : 2 * blocks + 2].astype(np.int64)
    words, escapes = body[2 * blocks + 2 :][:n_words], body[2 * blocks + 2 + n_words :][:n_escapes]
    low, high = start // block, -(-end // block)
    words = words[offsets[low] : offsets[high]]
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array(COUNTS)[selector]
    # The last word of a block may have room for more ids than the block has left.
    before = np.concatenate(([0], np.cumsum(counts)))
    ends = offsets[low + 1 : high + 1] - offsets[low]
    length = np.minimum(block, n - block * np.arange(low, high))
    counts[ends - 1] -= before[ends] - before[offsets[low:high] - offsets[low]] - length
    place = np.concatenate(([0], np.cumsum(counts)))
    ids = np.zeros(place[-1], dtype=np.uint64)
    for s in range(2, 16):
        at = np.flatnonzero(selector == s)
        mask = np.uint64((1 << WIDTHS[s]) - 1)
        for i in range(COUNTS[s] if len(at) else 0):
            filled = at if s == 15 else at[counts[at] > i]
            ids[place[filled] + i] = (words[filled] >> np.uint64(WIDTHS[s] * i)) & mask
    ids[ids == ESCAPE] = escapes[escape_offsets[low] : escape_offsets[high]]
    return ids[start - low * block : end - low * block]


# --- token ids ----------------------------------------------------------------------------------


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for themselves, the others from 256 on in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b if b in plain else 256 + others.index(b)) for b in range(256)}


class Encoder(dict):
    """Token ids of `tokenizers`, as bytes of little-endian unsigned 32-bit integers.

    The vocabulary's patterns drop white space and no token spans it, so that a text's ids are those of its words in turn;
    words are kept once coded. A word of Western letters with ASCII punctuation around it falls into those parts, which go to the
    model as they are; other words go through the whole tokenizer, as do texts with the name of a special token. Tests
    compare all with texts coded whole.
    """

    #: Words kept, and the longest that is kept.
    KEPT, LONGEST = 1 << 20, 64
    #: No apostrophe in front: with a letter it may be an ending of the vocabulary's patterns.
    SIMPLE = re.compile(r"([!-&(-/:-@\[-`{-~]*)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words, self.separators = re.compile(WORD), re.compile("[\x1c-\x1f]")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def part(self, part: str) -> bytes:
        """Letters in lower case, or punctuation."""
        coded = "".join(map(self.letters.__getitem__, part.encode()))
        return struct.pack(f"<{len(ids)}I", *ids) if (ids := [t.id for t in self.model.tokenize(coded)]) else b""

    def __missing__(self, word: str) -> bytes:
        if len(word) > self.LONGEST:
            return self.whole(word)
        if (simple := self.SIMPLE.fullmatch(word)) is None:
            coded = self.whole(word)
        else:
            before, letters, after = simple.groups()
            lower = letters.lower()
            coded = self.part(lower) if word == lower else b"".join(self[p] if p != word else self.part(p) for p in (before, lower, after) if p)
        if len(self) >= self.KEPT:
            self.clear()
        self[word] = coded
        return coded

    def __call__(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.whole(text)
        # Python's own splitting takes four more characters for white space than the tokenizer does.
        found = self.words.findall(text) if self.separators.search(text) else text.split()
        return b"".join(map(self.__getitem__, found))


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


# --- files --------------------------------------------------------------------------------------


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end: int = END) -> None:
    """Codes every document, with the end token, into segments below `path`, in ascending order of doc_id."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path(TOKENIZER)
    ship(docs.sparkSession)

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code, shard = _encoder(tokenizer), TaskContext.get().partitionId()
        last = np.array([end], dtype="<u4").tobytes()
        doc_ids, parts, held, start, number = [], [], 0, 0, 0

        def row() -> pd.DataFrame:
            ids = np.frombuffer(b"".join(parts), dtype="<u4")
            lengths = [len(p) // 4 for p in parts]
            values = (shard, number, start, len(ids), doc_ids, lengths, encode(ids))
            return pd.DataFrame([values], columns=["shard", "segment", "start", "n_ids", "doc_ids", "lengths", "image"])

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                doc_ids.append(None if pd.isna(doc_id) else int(doc_id))
                parts.append(code(text) + last)
                held += len(parts[-1]) // 4
                if held >= SEGMENT:
                    yield row()
                    start, number = start + held, number + 1
                    doc_ids, parts, held = [], [], 0
        if parts:
            yield row()

    # Rows that repeat a doc_id are dealt out by their texts' hashes, and copies at random, so that no id needs to fit in one task.
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    keyed = keyed.select("doc_id", F.xxhash64("text").alias("hash"), F.rand(0).alias("copy"), "text")
    ordered = keyed.repartitionByRange("doc_id", "hash", "copy").sortWithinPartitions("doc_id", "hash", "copy")
    # The image is packed already.
    ordered.select("doc_id", "text").mapInPandas(segments, SEGMENTS).write.option("compression", "none").parquet(path)


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with their place in the stream of all ids. One row for each shard meets in one task, not one for each segment."""
    found = spark.read.schema(SEGMENTS).parquet(path)
    sizes = found.groupBy("shard").agg(F.sum("n_ids").alias("size"))
    before = F.sum("size").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("shard", F.coalesce(before, F.lit(0)).alias("before"))
    return found.join(starts, "shard").withColumn("start", F.col("start") + F.col("before")).drop("before")


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and, if asked for, ids (little-endian unsigned 32-bit) of every document in the files."""
    ship(spark)
    fields = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * ids

    def documents(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start, doc_ids, lengths, image in zip(batch["start"], batch["doc_ids"], batch["lengths"], batch["image"]):
                data = memoryview(decode(image).astype("<u4").tobytes())
                ends = np.cumsum(lengths)
                own = [data[4 * (e - n) : 4 * e] for e, n in zip(ends, lengths)]
                # Arrow hands a list with a null over as floats; those are whole again below 2^53, so it is asked for as text.
                rows = {
                    "doc_id": pd.array([None if d is None else int(d) for d in doc_ids], dtype="Int64"),
                    "start": start + ends - lengths, "n_tokens": lengths, "ids_crc32": [zlib.crc32(x) for x in own],
                }
                yield pd.DataFrame(rows | ({"ids": [bytes(x) for x in own]} if ids else {}))

    found = _segments(spark, path).select("start", F.col("doc_ids").cast("array<string>").alias("doc_ids"), "lengths", "image")
    return found.mapInPandas(documents, fields)


def tokens(spark: SparkSession, path: str, start: int, n: int) -> np.ndarray:
    """`n` ids of the stream of all documents from place `start` on, as a trainer reads them. Only segments and blocks that hold them are read."""
    own = _segments(spark, path).where((F.col("start") < start + n) & (F.col("start") + F.col("n_ids") > start))
    rows = own.select("start", "image").orderBy("start").collect()  # the stretch asked for
    parts = [decode(bytes(r["image"]), max(0, start - r["start"]), start + n - r["start"]) for r in rows]
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)


def encoded(docs: DataFrame, ids: bool = False) -> DataFrame:
    """Writes the documents to a new folder and reads them back."""
    path = scratch(docs.sparkSession, "tokens")
    write(docs, path)
    return read(docs.sparkSession, path, ids)
