"""Best-fit packing of tokenized documents into sequences of a fixed capacity.

Only the number of pieces of each length matters to the packing, and there are at most `capacity` lengths. Spark
tokenizes the documents, stores the pieces and counts them by length; the plan is made on that histogram: lengths above
a third of the capacity are matched in pairs, the largest first and each with the largest that fits; smaller
ones go, the largest first, where the least room is left. The plan says which ranks of a length go where, in a number of
steps that depends on the capacity alone, and each piece finds its place by its rank.

Defined cases: a null or empty text is the end token alone; repeated rows are packed each on its own; a text of any
length is cut, its first piece being the short one; an empty table gives an empty result; no other column is read.
"""

from __future__ import annotations

import base64
import bisect
import json
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import scratch, ship, stored, text_of

CAPACITY = 2048
END = 0
#: Ids that a task holds before it passes their pieces on.
HELD = 1 << 20
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"
PIECES = "doc_id long, piece int, start long, length int, ids binary, task long, nth long"


class Encoder:
    """Token ids of the vocabulary file of `tokenizers`.

    The same vocabulary as byte-pair ranks gives the same ids several times faster (a test compares the two); texts that hold the
    name of a special token, or that the faster way refuses, go through `tokenizers` itself.
    """

    def __init__(self, tokenizer: str, ranks: str):
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as lines:
            known = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
        with open(tokenizer, encoding="utf-8") as file:
            self.special = [t["content"] for t in json.load(file)["added_tokens"]]
        self.tokenizer = tokenizer

    @cached_property
    def full(self):
        """The tokenizer itself, loaded only where a text needs it."""
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.tokenizer)

    def __call__(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4")
        try:
            return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
        except ValueError:  # its pattern gives up on very long runs of white space
            return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype="<u4")


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(tokenizer: str, ranks: str) -> Encoder:
    """One for each Python worker."""
    if (tokenizer, ranks) not in _ENCODERS:
        _ENCODERS[tokenizer, ranks] = Encoder(tokenizer, ranks)
    return _ENCODERS[tokenizer, ranks]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """Every document's ids and the end token, cut into pieces of at most `capacity`, stored: doc_id, piece, start, length,
    ids (little-endian unsigned 32-bit), and task, nth: the piece's place among those of its length in the task that made it."""
    tokenizer, ranks = tokenizer or vocabulary(TOKENIZER), ranks or vocabulary(RANKS)
    ship(docs.sparkSession)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, task, seen = _encoder(tokenizer, ranks), TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64)
        columns = ["doc_id", "piece", "start", "length", "ids", "task", "nth"]
        for batch in batches:
            rows, held = [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                ids = np.append(encode(text), np.array([END], dtype="<u4"))
                start, piece = 0, 0
                end = (len(ids) - 1) % capacity + 1
                while start < len(ids):
                    rows.append((None if pd.isna(doc_id) else int(doc_id), piece, start, end - start, ids[start:end].tobytes(), task, int(seen[end - start])))
                    seen[end - start] += 1
                    start, end, piece = end, end + capacity, piece + 1
                held += len(ids)
                if held >= HELD:
                    yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})

    path = scratch(docs.sparkSession, "pieces")
    cut_docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(cut, PIECES)
    cut_docs.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(PIECES).parquet(path)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[pd.DataFrame, int]:
    """Histogram of lengths → steps, and the number of sequences.

    A step puts the pieces of one length with ranks from `first`, `each` to a sequence, into the sequences from
    `sequence` on, at `offset` and the places after it.
    """
    left = {length: n for length, n in counts.items() if n}
    rank = dict.fromkeys(left, 0)
    steps: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = {}  # room left → runs of sequences (first, number)
    rooms: list[int] = []  # its keys in order
    sequences = 0

    def put(length: int, n: int, each: int, sequence: int, offset: int) -> None:
        steps.append((length, rank[length], each, sequence, offset))
        rank[length] += n
        left[length] -= n

    def leave(space: int, first: int, number: int) -> None:
        if space and number:
            if space not in room:
                room[space] = []
                bisect.insort(rooms, space)
            room[space].append((first, number))

    large = sorted(length for length in left if 3 * length > capacity)
    while large:
        length = large[-1]
        if not left[length]:
            large.pop()
            continue
        at = bisect.bisect_right(large, capacity - length) - 1
        while at >= 0 and (not left[large[at]] or (large[at] == length and left[length] < 2)):
            at -= 1
        mate = large[at] if at >= 0 else None
        if mate is None:
            n = left[length]
            put(length, n, 1, sequences, 0)
        elif mate == length:
            n = left[length] // 2
            put(length, 2 * n, 2, sequences, 0)
        else:
            n = min(left[length], left[mate])
            put(length, n, 1, sequences, 0)
            put(mate, n, 1, sequences, length)
        leave(capacity - length - (mate or 0), sequences, n)
        sequences += n
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(rooms, length)
            if at == len(rooms):  # no room: open as many sequences as the rest fills
                number = -(-left[length] // (capacity // length))
                leave(capacity, sequences, number)
                sequences += number
                continue
            space = rooms[at]
            first, number = room[space].pop()
            if not room[space]:
                del room[space]
                rooms.pop(at)
            each = space // length
            full = min(number, left[length] // each)
            if full:
                put(length, full * each, each, first, capacity - space)
                leave(space - each * length, first, full)
                leave(space, first + full, number - full)
            else:
                n = left[length]
                put(length, n, n, first, capacity - space)
                leave(space - n * length, first, 1)
                leave(space, first + 1, number - 1)
    return pd.DataFrame(steps, columns=["length", "first", "each", "sequence", "offset"]), sequences


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` → the same rows with sequence_id and offset in place of task and nth.

    The driver sees one count for each length. A piece's rank among all of its length is its place in its task and
    the counts of the tasks before, which are one row for each length and task.
    """
    by_task = stored(cut.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n")), "lengths")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    steps, _ = plan(counts, capacity)
    steps = steps.sort_values(["length", "first"]).astype("int64")
    lengths, firsts, each, sequence, offset = (steps[c].to_numpy() for c in ("length", "first", "each", "sequence", "offset"))
    begin = {length: (int(np.searchsorted(lengths, length)), int(np.searchsorted(lengths, length, "right"))) for length in counts}

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence_ids, offsets = np.zeros(len(length), dtype=np.int64), np.zeros(len(length), dtype=np.int64)
        for value, own in length.groupby(length).indices.items():
            lo, hi = begin[int(value)]
            ranks = rank.to_numpy()[own]
            step = lo + np.searchsorted(firsts[lo:hi], ranks, "right") - 1
            past = ranks - firsts[step]
            sequence_ids[own] = sequence[step] + past // each[step]
            offsets[own] = offset[step] + past % each[step] * int(value)
        return pd.DataFrame({"sequence_id": sequence_ids, "offset": offsets})

    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    starts = stored(by_task.select("length", "task", F.coalesce(before, F.lit(0)).alias("before")), "rank-starts")
    ranked = cut.join(starts, ["length", "task"]).withColumn("place", look_up("length", F.col("before") + F.col("nth")))
    return ranked.select(*[c for c in cut.columns if c not in ("task", "nth")], "place.sequence_id", "place.offset")


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids, sequence_id, offset of every piece. The ids are read and moved only if selected."""
    return place(pieces(docs, capacity, tokenizer, ranks), capacity)


def summary(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None, ranks: str | None = None) -> DataFrame:
    """As `pack`, with ids_crc32 in place of the ids, which stay in the stored pieces."""
    cut = pieces(docs, capacity, tokenizer, ranks).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(cut, capacity).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", "offset"
    )
