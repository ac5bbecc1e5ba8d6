"""Hard negatives by a secondary-sort shuffle.

A row's score for an anchor is their vectors' inner product in whole numbers. The positives of an anchor are its best rows of the
same label; a negative of a positive is one of the best rows of other labels whose score lies in a window given by the positive's.

Rows are stored in blocks of a few thousand vectors, one matrix each. Anchors are taken in chunks of a bounded size, which a
broadcast gives to all tasks; the rows are never shuffled. A first pass scores the rows of the anchor's label and keeps the best of each
task, then of all. A second pass scores all rows and passes on, for each window, the best of each task: any row
that counts is among them. Those scores go, packed into (anchor, descending score, kind, id), through `repartitionAndSortWithinPartitions`.
An iterator then reads each anchor's scores from the highest on: a positive opens its window, a row of another label is
given out to the open windows that want it. It holds the open windows of one anchor and nothing else.

Defined cases: rows without an id, a label or a usable vector take no part; a row that repeats another counts beside it; of anchor
rows with one id, the one with the least label, then the least vector is the anchor, and no row with its id is among its
positives or negatives; only vectors of one length are compared; components are taken within ±2^24 / 256; an
empty table gives no rows; no further columns are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator
from itertools import groupby

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import positions, scratch, ship, stored
from marketlake.llm.vectors import products, usable, whole

POSITIVES, NEGATIVES = 5, 3
#: A negative's score in hundredths of its positive's.
LEAST, MOST = 50, 95
#: Components in a chunk of anchors (32 MB), and vectors in a block.
CHUNK, BLOCK = 1 << 23, 4096
#: Rows that a scoring task takes, where there are enough for all cores: what it passes on is that of so many rows.
TASK = 1 << 19
BLOCKS = "length int, n int, ids binary, labels binary, components binary"
FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
NONE = np.iinfo(np.int64).min


def blocks(rows: DataFrame) -> DataFrame:
    """(id, label, vector) → matrices of at most BLOCK rows."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = (batch.column(n).to_numpy() for n in (0, 1))
            for own, components in whole(batch.column(2)):
                for at in range(0, len(own), BLOCK):
                    part = own[at : at + BLOCK]
                    part = part[np.argsort(ids[part], kind="stable")]
                    values = components[np.searchsorted(own, part)]
                    yield pa.RecordBatch.from_pydict({
                        "length": pa.array([values.shape[1]], pa.int32()), "n": pa.array([len(part)], pa.int32()),
                        "ids": [ids[part].astype("<i8").tobytes()], "labels": [labels[part].astype("<i4").tobytes()],
                        "components": [values.astype("<i4").tobytes()],
                    })

    return rows.mapInArrow(pack, BLOCKS)


def _matrices(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, labels and components of a block."""
    values = np.frombuffer(row["components"], dtype="<i4").reshape(row["n"], row["length"])
    return np.frombuffer(row["ids"], dtype="<i8"), np.frombuffer(row["labels"], dtype="<i4"), values


class Best:
    """The k best (score, id) of each of a number of groups: higher scores first, then smaller ids."""

    def __init__(self, groups: int, k: int):
        self.k = k
        self.scores = np.full((groups, k), NONE, dtype=np.int64)
        self.ids = np.zeros((groups, k), dtype=np.int64)

    def least(self) -> np.ndarray:
        """The score below which a row changes nothing."""
        return self.scores[:, -1]

    def add(self, groups: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched, place = np.unique(groups, return_inverse=True)
        group = np.concatenate([np.repeat(np.arange(len(touched)), self.k), place])
        score = np.concatenate([self.scores[touched].ravel(), scores])
        id_ = np.concatenate([self.ids[touched].ravel(), ids])
        order = np.lexsort((id_, -score, group))  # a free place has the least score, which is its own negative: see below
        group, score, id_ = group[order], score[order], id_[order]
        free = score == NONE
        nth = np.arange(len(group)) - np.searchsorted(group, group)
        shift = np.cumsum(free) - np.concatenate(([0], np.cumsum(free)))[np.searchsorted(group, group)]
        nth = np.where(free, -1, nth - shift)
        kept = (nth >= 0) & (nth < self.k)
        self.scores[touched], self.ids[touched] = NONE, 0
        self.scores[touched[group[kept]], nth[kept]] = score[kept]
        self.ids[touched[group[kept]], nth[kept]] = id_[kept]

    def items(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        groups, places = np.nonzero(self.scores != NONE)
        return groups, self.scores[groups, places], self.ids[groups, places]


def window(score: int) -> tuple[int, int]:
    """Least and greatest score of a positive's negatives."""
    return -(-LEAST * score // 100), MOST * score // 100


class Chunk:
    """Anchors of one chunk, by length of vector; with their positives, once known."""

    def __init__(self, frame: pd.DataFrame):
        self.groups = {}
        for length, own in frame.groupby("length"):
            own = own.sort_values(["label", "id"])
            values = np.frombuffer(b"".join(own["components"]), dtype="<i4").reshape(len(own), length)
            self.groups[int(length)] = (own["id"].to_numpy("<i8"), own["label"].to_numpy("<i4"), values)

    def positives(self, rows: Iterable) -> Iterator[pd.DataFrame]:
        """The best rows of each anchor's label among these blocks: anchor_id, id, score."""
        best = {length: Best(len(ids), POSITIVES) for length, (ids, _, _) in self.groups.items()}
        for row in rows:
            if row["length"] not in best:
                continue
            anchors, labels, vectors = self.groups[row["length"]]
            own, ids_labels, values = _matrices(row)
            for label in np.unique(ids_labels):
                low, high = np.searchsorted(labels, [label, label + 1]) if label < np.iinfo(np.int32).max else (np.searchsorted(labels, label), len(labels))
                if low == high:
                    continue
                of = np.flatnonzero(ids_labels == label)
                scores = products(vectors[low:high], values[of])
                a, r = np.nonzero((scores >= best[row["length"]].least()[low:high, None]) & (anchors[low:high, None] != own[of]))
                best[row["length"]].add(a + low, scores[a, r], own[of[r]])
        for length, (anchors, _, _) in self.groups.items():
            groups, scores, ids = best[length].items()
            yield pd.DataFrame({"anchor_id": anchors[groups], "id": ids, "score": scores})

    def open(self, found: pd.DataFrame) -> None:
        """Takes the positives of all anchors (anchor_id, score)."""
        self.windows = {}
        for length, (anchors, _, _) in self.groups.items():
            low, high = np.full((len(anchors), POSITIVES), 1, dtype=np.int64), np.zeros((len(anchors), POSITIVES), dtype=np.int64)
            order = np.argsort(anchors)
            place = order[np.searchsorted(anchors, found["anchor_id"], sorter=order).clip(max=len(anchors) - 1)] if len(anchors) else []
            used = np.zeros(len(anchors), dtype=np.int64)
            for at, anchor, score in zip(place, found["anchor_id"], found["score"]):
                if anchors[at] == anchor:
                    low[at, used[at]], high[at, used[at]] = window(int(score))
                    used[at] += 1
            self.windows[length] = low, high

    def negatives(self, rows: Iterable) -> Iterator[bytes]:
        """Keys of the rows among these blocks that an anchor may want: for each window the best."""
        best = {length: Best(low.size, NEGATIVES) for length, (low, _) in self.windows.items()}
        for row in rows:
            if row["length"] not in best:
                continue
            anchors, labels, vectors = self.groups[row["length"]]
            low, high = self.windows[row["length"]]
            own, own_labels, values = _matrices(row)
            scores = products(vectors, values)
            kept = best[row["length"]]
            least = np.where(low <= high, np.maximum(low, kept.least().reshape(low.shape)), np.iinfo(np.int64).max)
            wanted = (scores >= least.min(axis=1)[:, None]) & (scores <= np.where(low <= high, high, NONE).max(axis=1)[:, None])
            a, r = np.nonzero(wanted & (labels[:, None] != own_labels) & (anchors[:, None] != own))
            score = scores[a, r]
            for w in range(POSITIVES):
                fits = (score >= least[a, w]) & (score <= high[a, w])
                kept.add(a[fits] * POSITIVES + w, score[fits], own[r[fits]])
        for length, (anchors, _, _) in self.groups.items():
            groups, scores, ids = best[length].items()
            # One row may be among the best of several windows of an anchor; it is passed on once, with its number of copies.
            found = pd.DataFrame({"anchor": anchors[groups // POSITIVES], "window": groups % POSITIVES, "score": scores, "id": ids})
            copies = found.groupby(["anchor", "score", "id", "window"]).size().groupby(["anchor", "score", "id"]).max()
            for (anchor, score, id_), n in copies.items():
                yield from [key(anchor, score, NEGATIVE, id_)] * n


# --- the secondary sort -------------------------------------------------------------------------

POSITIVE, NEGATIVE = 0, 1
KEY = struct.Struct(">QQBQ")
_SIGN = 1 << 63


def key(anchor: int, score: int, kind: int, id_: int) -> bytes:
    """Bytes whose order is that of (anchor, descending score, kind, id)."""
    return KEY.pack(int(anchor) + _SIGN, _SIGN - 1 - int(score), kind, int(id_) + _SIGN)


def unpack(packed: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, id_ = KEY.unpack(packed)
    return anchor - _SIGN, _SIGN - 1 - score, kind, id_ - _SIGN


def partition(packed: bytes) -> int:
    """All keys of an anchor go together. Its id is mixed first, as anchors may share a divisor with the partitions."""
    return (int.from_bytes(packed[:8], "big") * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 33


def emit(sorted_keys: Iterable[tuple[bytes, None]]) -> Iterator[tuple[int, int, int, int, int, int]]:
    """The negatives of each positive, from keys in order."""
    for anchor, own in groupby((unpack(k) for k, _ in sorted_keys), lambda k: k[0]):
        opened: list[list[int]] = []  # [positive id, its score, least, greatest, given out]
        for _, score, kind, id_ in own:
            if kind == POSITIVE:
                opened.append([id_, score, *window(score), 0])
                continue
            for one in opened:
                if one[4] < NEGATIVES and one[2] <= score <= one[3]:
                    one[4] += 1
                    yield anchor, one[0], one[4], id_, one[1], score


def mine(rows: DataFrame, anchor: Column, id_: str = "vec_id", label: str = "label", vector: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows for which `anchor` holds."""
    spark = rows.sparkSession
    ship(spark)
    taken = rows.where(F.col(id_).isNotNull() & F.col(label).isNotNull() & usable(vector))
    columns = [F.col(id_).cast("long").alias("id"), F.col(label).cast("int").alias("label"), F.col(vector).alias("vector")]
    packed = stored(blocks(taken.select(*columns)), "vector-blocks")
    single = taken.where(anchor).select(*columns).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("first"))
    anchors = stored(positions(single.select("id", "first.label", "first.vector"), F.col("id")), "anchors")
    size = packed.agg(F.sum("n"), F.max("length")).first()
    if not size[0] or not anchors.head(1):
        return spark.createDataFrame([], FOUND)
    each, number = max(1, CHUNK // max(1, size[1])), anchors.agg(F.max("position")).first()[0] + 1
    tasks = max(1, -(-size[0] // TASK), min(spark.sparkContext.defaultParallelism, size[0] // BLOCK))
    path = scratch(spark, "hard-negatives")
    for first in range(0, number, each):
        chunk = _chunk(anchors.where(F.col("position").between(first, first + each - 1)))
        _mine_chunk(packed, chunk, tasks).write.mode("append").parquet(path)
    return spark.read.schema(FOUND).parquet(path)


def _chunk(anchors: DataFrame) -> Chunk:
    """Fetches the anchors of one chunk, of at most CHUNK components."""
    frame = anchors.select("id", "label", "vector").toArrow()
    parts = []
    for own, values in whole(frame.column("vector")):
        ids, labels = (frame.column(n).to_numpy()[own] for n in ("id", "label"))
        parts.append(pd.DataFrame({"id": ids, "label": labels, "length": values.shape[1], "components": [v.astype("<i4").tobytes() for v in values]}))
    return Chunk(pd.concat(parts))


def _mine_chunk(packed: DataFrame, chunk: Chunk, tasks: int) -> DataFrame:
    spark = packed.sparkSession
    dealt, given = packed.repartition(tasks), spark.sparkContext.broadcast(chunk)

    def first(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from given.value.positives(row for batch in batches for _, row in batch.iterrows())

    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    scored = dealt.mapInPandas(first, "anchor_id long, id long, score long")
    positives = stored(scored.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= POSITIVES).drop("nth"), "positives")
    chunk.open(positives.toPandas())  # POSITIVES rows for each anchor of the chunk
    opened = spark.sparkContext.broadcast(chunk)

    def keyed(rows: Iterable) -> Iterator[tuple[bytes, None]]:
        return ((k, None) for k in opened.value.negatives(rows))

    negatives = dealt.rdd.mapPartitions(keyed)
    starts = positives.rdd.map(lambda r: (key(r["anchor_id"], r["score"], POSITIVE, r["id"]), None))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = negatives.union(starts).repartitionAndSortWithinPartitions(partitions, partition)
    return ordered.mapPartitions(emit).toDF(FOUND)
