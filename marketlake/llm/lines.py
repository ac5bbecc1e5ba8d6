"""Line dedup by winnowing over line hashes.

A document is the sequence of its lines that aren't blank, without white space at either end. Of every window of `run`
lines, the line with the least hash is a fingerprint; two copies of a run of at least that length choose the same ones,
so every repeated run has a fingerprint at two positions. Only such fingerprints are followed up: each is extended both
ways to the windows that it stands for, and a window of which the lines occurred earlier is a repeat. A line
in a repeat goes: what stays of a repeated run is its first copy. Documents come in order of doc_id.

Lines are told apart by 128-bit hashes; a position joins with the first one of its window, never with all others.

Defined cases: a null text is an empty one; a document of fewer lines than a run stays as it is; a null doc_id comes
after all others; equal doc_ids come in order of their texts' hashes; rows that repeat both are one document, and
all get its result; blank lines stay; a run that overlaps its own first copy leaves that copy's start; further columns
are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import ship, stored, text_of

#: Lines of a run that is found for certain, and the least that is deleted.
RUN = 3
_ENDS = " \t\x0b\x0c\r"


def numbered(text: str) -> tuple[list[str], list[int]]:
    """All lines, and the numbers of those that count."""
    lines = text.split("\n")
    return lines, [i for i, line in enumerate(lines) if line.strip(_ENDS)]


def winnow(hashes: np.ndarray, run: int) -> np.ndarray:
    """For every window its chosen place: that of the least hash, the last one of equals."""
    windows = np.lib.stride_tricks.sliding_window_view(hashes, run)
    return np.arange(len(windows)) + run - 1 - windows[:, ::-1].argmin(axis=1)


def fingerprints(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, h, fingerprint, windows) of every chosen line, stored: windows holds (first line, hash of the whole window) of each window it was chosen for."""

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, h, text in zip(batch["doc_id"], batch["h"], batch["text"]):
                lines, own = numbered(text)
                if len(own) < run:
                    continue
                digests = [xxhash.xxh3_128_digest(lines[i].strip(_ENDS).encode("utf-8", "surrogatepass")) for i in own]
                heads = np.frombuffer(b"".join(digests), dtype=">u8")[::2].astype(np.uint64)
                places = winnow(heads, run)
                windows: dict[int, list[tuple[int, bytes]]] = {}
                for first, place in enumerate(places.tolist()):
                    windows.setdefault(place, []).append((first, xxhash.xxh3_128_digest(b"".join(digests[first : first + run]))))
                for place, found in windows.items():
                    rows.append((None if pd.isna(doc_id) else int(doc_id), h, heads[place : place + 1].view(np.int64)[0], found))
            out = pd.DataFrame(rows, columns=["doc_id", "h", "fingerprint", "windows"])
            yield out.astype({"doc_id": "Int64", "h": "int64", "fingerprint": "int64"})

    schema = "doc_id long, h long, fingerprint long, windows array<struct<first:int,hash:binary>>"
    return stored(docs.select("doc_id", "h", "text").mapInPandas(choose, schema), "line-fingerprints")


def _keyed(docs: DataFrame) -> list[Column]:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), text_of()).alias("h"), text_of().alias("text")]


def repeats(docs: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, h, firsts): the first lines (counted without blank ones) of a document's windows that occurred earlier."""
    ship(docs.sparkSession)
    chosen = fingerprints(docs.select(*_keyed(docs)), run)
    again = stored(chosen.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fingerprint"), "repeated-fingerprints")
    windows = stored(chosen.join(again, "fingerprint", "left_semi").select("doc_id", "h", F.inline("windows")), "windows")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "h", "first")
    first = stored(windows.groupBy("hash").agg(F.min(place).alias("earliest"), F.max(place).alias("latest")).where("earliest <> latest").select("hash", "earliest"), "first-windows")
    later = windows.join(first, "hash").where(place != F.col("earliest"))
    return later.groupBy("doc_id", "h").agg(F.collect_set("first").alias("firsts"))


def without(text: str, firsts: list[int] | None, run: int) -> tuple[str, int, int]:
    """What stays of a text, its number of lines that count, and of those deleted."""
    lines, own = numbered(text)
    if firsts is None:
        return text, len(own), 0
    gone = {own[i] for first in firsts for i in range(first, first + run)}
    return "\n".join(line for i, line in enumerate(lines) if i not in gone), len(own), len(gone)


def dedup(docs: DataFrame, run: int = RUN) -> DataFrame:
    """All columns and `dedup`: a struct of text (what stays), lines and deleted."""
    ship(docs.sparkSession)
    found = repeats(docs, run).select(F.col("doc_id").alias("_doc_id"), F.col("h").alias("_h"), "firsts")

    @F.pandas_udf("text string, lines long, deleted long")
    def clean(texts: pd.Series, firsts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([without(t, f, run) for t, f in zip(texts, firsts)], columns=["text", "lines", "deleted"])

    doc_id, h, text = _keyed(docs)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), doc_id, h, text)
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("h") == F.col("_h"))
    return rows.join(found, same, "left").select("row.*", clean("text", "firsts").alias("dedup"))
