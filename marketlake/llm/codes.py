"""Vector codes of product codebooks, trained by exact Lloyd rounds with norm-of-sum bounds.

A vector is cut into equal parts, and each part is coded by the index of its nearest codebook entry. The codebooks of all rounds are
kept. For every part a row carries, for each group of entries, a bound below the distance from the part to the group's entries other
than its own, and the round in which the bound was found. An entry that has moved away and back again since then has moved
little: the bound falls by the norm of the sum of its moves, which is the true distance between its places in the two rounds, and
not by the sum of their norms. Only groups that the bound does not rule out are scanned again, with exact distances; so results are
those of a full scan, ties included.

A round is one pass over the rows: each task writes its rows' new codes and bounds, and its sums of parts by entry, which Spark
adds up; the driver sees the codebooks alone. Components are whole numbers, so that sums are the same in any order.

Defined cases: rows without a usable vector are dropped; with fewer rows than entries there are as many entries as rows; rows that
repeat another are coded each; a null id is coded and comes last for the first codebook, equal ids come in the
order of their vectors; vectors are filled up with zeros to the greatest length, and that to a multiple of the number of parts;
components are taken within ±2^24 / 256; an empty table gives no rows; no further columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import discard, scratch, ship
from marketlake.llm.vectors import usable, whole

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: Groups of entries that have a bound of their own.
GROUPS = 4
STATE, SUMS = 0, 1


def distances(parts: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of whole-numbered rows to entries, as int64, exact."""
    most = max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * parts.shape[1] * most * most < 1 << 53:
        x, c = parts.astype(np.float64), entries.astype(np.float64)
        return ((x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)).astype(np.int64)
    out = np.zeros((len(parts), len(entries)), dtype=np.int64)
    for x, c in zip(parts.T.astype(np.int64), entries.T.astype(np.int64)):
        out += (x[:, None] - c) ** 2
    return out


def _below(squared: np.ndarray) -> np.ndarray:
    """A single-precision number below the root."""
    return (np.sqrt(squared.astype(np.float64)) * (1 - 1e-6)).astype(np.float32)


class Part:
    """One part position's codebooks of all rounds so far."""

    def __init__(self, history: list[np.ndarray]):
        self.history, self.now = history, history[-1]
        self.groups = np.array_split(np.arange(len(self.now)), min(GROUPS, len(self.now)))
        # How far the entry of each group that moved most is from where it was, for each earlier round.
        moved = [np.sqrt(((self.now - old).astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-6) for old in history]
        self.moved = np.array([[m[g].max() for g in self.groups] for m in moved])

    def start(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A full scan: codes, squared distances, bounds, stamps."""
        near = distances(parts, self.now)
        codes = near.argmin(axis=1)
        error = near[np.arange(len(parts)), codes]
        near[np.arange(len(parts)), codes] = np.iinfo(np.int64).max
        low = np.stack([_below(near[:, g].min(axis=1)) for g in self.groups], axis=1)
        return codes, error, low, np.full(low.shape, len(self.history) - 1, dtype=np.uint8)

    def next(self, parts: np.ndarray, codes: np.ndarray, low: np.ndarray, stamps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
        """As `start`, from the state of an earlier round; and the number of distances computed."""
        stamp, rows = len(self.history) - 1, np.arange(len(parts))
        own = ((parts.astype(np.int64) - self.now[codes]) ** 2).sum(axis=1)
        bound = low.astype(np.float64) - self.moved[stamps, np.arange(len(self.groups))]
        scanned = ~((bound > 0) & (bound * bound > own[:, None] * (1 + 1e-6) + 1e-6))
        best, error, count = codes.astype(np.int64), own.copy(), len(parts)
        near = []
        for g, entries in enumerate(self.groups):
            at = np.flatnonzero(scanned[:, g])
            found = distances(parts[at], self.now[entries])
            near.append((at, found))
            count += found.size
            first = found.argmin(axis=1) if len(at) else np.zeros(0, dtype=np.int64)
            value, index = found[np.arange(len(at)), first], entries[first]
            better = (value < error[at]) | ((value == error[at]) & (index < best[at]))
            best[at[better]], error[at[better]] = index[better], value[better]
        group_of = np.concatenate([np.full(len(e), g) for g, e in enumerate(self.groups)])
        low, stamps = low.copy(), stamps.copy()
        for g, (entries, (at, found)) in enumerate(zip(self.groups, near)):
            # Bounds of scanned groups are exact and of this round.
            mine = group_of[best[at]] == g
            found[np.flatnonzero(mine), best[at[mine]] - entries[0]] = np.iinfo(np.int64).max
            low[at, g] = _below(found.min(axis=1, initial=np.iinfo(np.int64).max))
            stamps[at, g] = stamp
            # A group that was not scanned gets back the entry that the row has left.
            left = np.flatnonzero((best != codes) & (group_of[codes] == g) & ~scanned[rows, g])
            low[left, g] = np.minimum((bound[left, g] * (1 - 1e-6)).astype(np.float32), _below(own[left]))
            stamps[left, g] = stamp
        return best, error, low, stamps, count


def _round(history: list[np.ndarray], width: int, source: bool) -> Callable[[np.ndarray, pa.RecordBatch], tuple]:
    """A function of a batch's components and its state → codes, errors, bounds and stamps, one column for each part."""
    books = [Part([book[p] for book in history]) for p in range(PARTS)]
    groups = len(books[0].groups)

    def assign(components: np.ndarray, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n = len(components)
        parts = components.reshape(n, PARTS, width)
        if source:
            made = [books[p].start(parts[:, p]) for p in range(PARTS)]
        else:
            flat = lambda name, kind: np.frombuffer(b"".join(x.as_py() for x in batch.column(name)), dtype=kind)
            codes, low = flat("codes", np.uint8).reshape(n, PARTS), flat("low", "<f4").reshape(n, PARTS, groups)
            stamps = flat("stamps", np.uint8).reshape(n, PARTS, groups)
            made = [books[p].next(parts[:, p], codes[:, p], low[:, p], stamps[:, p])[:4] for p in range(PARTS)]
        codes, errors, low, stamps = (np.stack(x, axis=1) for x in zip(*made))
        return codes.astype(np.uint8), errors, low, stamps

    return assign


def _rows(matrix: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(matrix)]


def _components(batch: pa.RecordBatch, length: int, source: bool) -> np.ndarray:
    if not source:
        return np.frombuffer(b"".join(x.as_py() for x in batch.column("vector")), dtype="<i4").reshape(batch.num_rows, length)
    out = np.zeros((batch.num_rows, length), dtype=np.int32)
    for rows, values in whole(batch.column("vector")):
        out[rows, : values.shape[1]] = values
    return out


def fit(vectors: DataFrame, id_: str = "vec_id", label: str = "label", vector: str = "embedding") -> tuple[list[np.ndarray], DataFrame]:
    """Codebooks of all rounds (parts × entries × components), and every row's id, label, code and error for the last."""
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.where(usable(vector)).select(F.col(id_).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vector"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    out = f"id {kinds['id']}, label {kinds['label']}, code string, error long"
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return [], spark.createDataFrame([], out)
    width = -(-longest // PARTS)
    length = PARTS * width
    # The rows that the first codebook is made of, in their order.
    first = rows.orderBy(F.col("id").asc_nulls_last(), "vector").limit(ENTRIES)
    table = first.select("vector").toArrow().combine_chunks()
    batch = pa.RecordBatch.from_arrays([table.column("vector").combine_chunks()], ["vector"])
    history = [_components(batch, length, True).reshape(batch.num_rows, PARTS, width).transpose(1, 0, 2).astype(np.int64)]
    entries = batch.num_rows
    state = f"kind int, id {kinds['id']}, label {kinds['label']}, vector binary, codes binary, low binary, stamps binary, sums array<long>"

    def step(source: bool) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        books = list(history)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            assign = _round(books, width, source)
            # Sums of components and, last, numbers of parts.
            sums, empty = np.zeros((PARTS, entries, width + 1), dtype=np.int64), None
            for batch in batches:
                empty = batch.slice(0, 0)
                components = _components(batch, length, source)
                codes, _, low, stamps = assign(components, batch)
                n = len(codes)
                for p in range(PARTS):
                    for w in range(width):
                        # Each value in two halves: every total is exact in double precision.
                        values = components[:, p * width + w]
                        high = np.bincount(codes[:, p], values >> 12, entries).astype(np.int64)
                        sums[p, :, w] += (high << 12) + np.bincount(codes[:, p], values & 4095, entries).astype(np.int64)
                    sums[p, :, width] += np.bincount(codes[:, p], minlength=entries)
                yield pa.RecordBatch.from_pydict({
                    "kind": pa.array(np.full(n, STATE, dtype=np.int32)), "id": batch.column("id"), "label": batch.column("label"),
                    "vector": pa.array(_rows(components.astype("<i4")), pa.binary()), "codes": pa.array(_rows(codes), pa.binary()),
                    "low": pa.array(_rows(low.astype("<f4")), pa.binary()), "stamps": pa.array(_rows(stamps), pa.binary()),
                    "sums": pa.nulls(n, pa.list_(pa.int64())),
                })
            if empty is not None:
                none = pa.nulls(1, pa.binary())
                yield pa.RecordBatch.from_pydict({
                    "kind": pa.array([SUMS], pa.int32()), "id": pa.nulls(1, empty.column("id").type), "label": pa.nulls(1, empty.column("label").type),
                    "vector": none, "codes": none, "low": none, "stamps": none, "sums": pa.array([sums.ravel().tolist()], pa.list_(pa.int64())),
                })

        return run

    current, source = rows, True
    for _ in range(ROUNDS):
        path = scratch(spark, "vector-codes")
        current.mapInArrow(step(source), state).write.partitionBy("kind").parquet(path)
        made = spark.read.schema(state).parquet(path)
        totals = made.where(F.col("kind") == SUMS).select(F.posexplode("sums").alias("at", "value")).groupBy("at").agg(F.sum("value").alias("value"))
        flat = np.zeros(PARTS * entries * (width + 1), dtype=object)
        for row in totals.collect():  # one number for each component of the codebooks
            flat[row["at"]] = row["value"]
        sums = flat.reshape(PARTS, entries, width + 1)
        book = history[-1].copy()
        for p in range(PARTS):
            for e in range(entries):
                if sums[p, e, width]:
                    book[p, e] = [s // sums[p, e, width] for s in sums[p, e, :width]]
        history.append(book)
        if not source:
            discard(current)  # the rows of the round before, which this one has written anew
        current = made.where(F.col("kind") == STATE).select("id", "label", "vector", "codes", "low", "stamps")
        source = False
    last = list(history)

    def final(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        assign = _round(last, width, False)
        for batch in batches:
            codes, errors, _, _ = assign(_components(batch, length, False), batch)
            yield pa.RecordBatch.from_pydict({
                "id": batch.column("id"), "label": batch.column("label"),
                "code": pa.array([row.tobytes().hex() for row in codes], pa.string()), "error": pa.array(errors.sum(axis=1)),
            })

    return history, current.mapInArrow(final, out)


def digest(history: list[np.ndarray]) -> str:
    """SHA-256 of the last codebooks' components by part, entry and place."""
    return hashlib.sha256(",".join(str(int(v)) for v in history[-1].ravel()).encode()).hexdigest()


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error: the sum of errors of all rows with the label, those without one taken together."""
    keyed = coded.withColumn("_label", F.struct("label"))
    by_label = keyed.groupBy("_label").agg(F.sum("error").alias("label_error"))
    return keyed.join(by_label, "_label").drop("_label")
