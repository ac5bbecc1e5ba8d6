"""Hard negatives and vector codes against brute force, on the smallest tables and on odd rows."""

import hashlib
import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from marketlake.llm import codes, negatives
from marketlake.llm.codes import Part, distances
from marketlake.llm.common import stored
from marketlake.llm.oracle import ORACLE
from marketlake.llm.queries import QUERIES
from pyspark.sql import functions as F
from tests.conftest import SF_DIR

VECTORS = "vec_id long, label int, embedding array<float>, id long, vector string, score long, length int"


@pytest.fixture(scope="module")
def odd_vectors(spark):
    """Nulls everywhere, components that are no numbers, ties, repeated rows and ids, other lengths, clashing names."""
    draw = np.random.default_rng(5)
    rows = []
    for i in range(120):
        v = [float(np.float32(x)) for x in draw.integers(-3, 4, 32) / 8]
        rows.append((i, int(i % 3), v))
    rows += [(40, 1, rows[40][2]), (50, 2, rows[3][2]), (200, 1, rows[7][2]), (201, 1, rows[7][2]), (250, 0, rows[9][2])]
    rows += [(300, 1, None), (301, None, rows[2][2]), (None, 1, rows[4][2]), (302, 1, [1.0, None] * 16), (303, 1, [float("nan")] * 32)]
    rows += [(304, 1, [float("inf")] * 32), (350, 1, [3e38] * 32), (305, 2, [0.5] * 20), (400, 2, [0.25] * 20), (306, 0, []), (307, 2, [-1e20] * 32)]
    return spark.createDataFrame([(*r, 9, "v", 1, 2) for r in rows], VECTORS)


def plain_vectors(df):
    out = []
    for r in df.select("vec_id", "label", "embedding").collect():
        if r[2] is not None and all(x is not None and math.isfinite(x) for x in r[2]):
            out.append((r[0], r[1], [min(max(math.floor(256 * x), -(1 << 24)), 1 << 24) for x in r[2]]))
    return out


# --- hard negatives -----------------------------------------------------------------------------


def plain_negatives(rows, is_anchor):
    rows = [r for r in rows if r[0] is not None and r[1] is not None]
    anchors = {}
    for r in sorted(rows):
        if is_anchor(r[0]):
            anchors.setdefault(r[0], r)
    out = []
    for a, label, x in anchors.values():
        scored = [(-sum(p * q for p, q in zip(x, v)), i, lab) for i, lab, v in rows if i != a and len(v) == len(x)]
        scored.sort(key=lambda s: s[:2])
        for minus, positive, _ in [s for s in scored if s[2] == label][:5]:
            fits = [s for s in scored if s[2] != label and 50 * -minus <= 100 * -s[0] <= 95 * -minus][:3]
            out += [(a, positive, n, s[1], -minus, -s[0]) for n, s in enumerate(fits, 1)]
    return sorted(out)


def test_negatives_by_brute_force(spark, odd_vectors, monkeypatch):
    expected = plain_negatives(plain_vectors(odd_vectors), lambda i: i % 10 == 0)
    assert len(expected) > 30
    assert sorted(map(tuple, negatives.mine(odd_vectors, F.col("vec_id") % 10 == 0).collect())) == expected
    # Small blocks, several tasks and a chunk of two anchors each.
    monkeypatch.setattr(negatives, "BLOCK", 7)
    monkeypatch.setattr(negatives, "TASK", 40)
    monkeypatch.setattr(negatives, "CHUNK", 200)
    assert sorted(map(tuple, negatives.mine(odd_vectors.repartition(5), F.col("vec_id") % 10 == 0).collect())) == expected


def test_negatives_of_nothing(spark, odd_vectors):
    assert negatives.mine(odd_vectors.where("false"), F.col("vec_id") % 10 == 0).collect() == []
    assert negatives.mine(odd_vectors, F.lit(False)).collect() == []
    one = odd_vectors.where("vec_id = 10")
    assert negatives.mine(one, F.lit(True)).collect() == []


def test_keys_sort_by_anchor_falling_score_kind_and_id():
    draw = np.random.default_rng(1)
    values = [tuple(int(x) for x in (draw.integers(-3, 3), draw.integers(-(1 << 50), 1 << 50) if n % 2 else draw.integers(-2, 2), draw.integers(0, 2), draw.integers(-5, 5))) for n in range(500)]
    packed = sorted(negatives.key(*v) for v in values)
    assert [negatives.unpack(p) for p in packed] == sorted(values, key=lambda v: (v[0], -v[1], v[2], v[3]))


def test_best_rows_of_groups_in_any_batches():
    draw = np.random.default_rng(2)
    groups, scores, ids = draw.integers(0, 9, 800), draw.integers(-4, 4, 800), draw.integers(0, 50, 800)
    best = negatives.Best(9, 3)
    for at in range(0, 800, 37):
        best.add(groups[at : at + 37], scores[at : at + 37], ids[at : at + 37])
    expected = defaultdict(list)
    for g, s, i in zip(groups, scores, ids):
        expected[g].append((-s, i))
    got = defaultdict(list)
    for g, s, i in zip(*best.items()):
        got[g].append((-s, i))
    assert got == {g: sorted(v)[:3] for g, v in expected.items()}


# --- vector codes -------------------------------------------------------------------------------


def plain_codes(rows, parts=16, entries=64, rounds=2):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    length = -(-max(len(v) for *_, v in rows) // parts) * parts
    width = length // parts
    cut = [[tuple((v + [0] * length)[p * width : (p + 1) * width]) for p in range(parts)] for *_, v in rows]
    books = [[cut[e][p] for e in range(min(entries, len(rows)))] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = defaultdict(list)
            for row in cut:
                members[nearest(row[p], books[p])[1]].append(row[p])
            books[p] = [tuple(sum(c) // len(c) for c in zip(*members[i])) if members[i] else c for i, c in enumerate(books[p])]
    found = [[nearest(row[p], books[p]) for p in range(parts)] for row in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = defaultdict(int)
    for (_, label, _), e in zip(rows, errors):
        by_label[label] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(i, label, "".join(f"{n:02x}" for _, n in f), e, by_label[label]) for (i, label, _), f, e in zip(rows, found, errors)], sha


def test_codes_by_brute_force(odd_vectors):
    # Codes of ties between rows with one id are compared as well: the rows are told apart by their results.
    rows = [r for r in plain_vectors(odd_vectors) if abs(max(r[2], default=0, key=abs)) < 1 << 20]
    kept = odd_vectors.where("vec_id IS NULL OR vec_id NOT IN (350, 307)")
    expected, sha = plain_codes(rows)
    history, coded = codes.fit(kept)
    found = codes.with_label_errors(stored(coded, "codes")).collect()
    assert codes.digest(history) == sha
    got = [(r["id"], r["label"], r["code"], r["error"], r["label_error"]) for r in found]
    assert sorted(map(repr, got)) == sorted(map(repr, expected))


def test_codes_of_huge_components(odd_vectors):
    expected, sha = plain_codes(plain_vectors(odd_vectors))
    history, coded = codes.fit(odd_vectors)
    assert codes.digest(history) == sha
    assert sorted((repr(r["id"]), r["code"], r["error"]) for r in coded.collect()) == sorted((repr(i), c, e) for i, _, c, e, _ in expected)


def test_codes_of_few_rows_and_none(odd_vectors):
    few = odd_vectors.where("vec_id IN (3, 4, 305)")
    expected, sha = plain_codes(plain_vectors(few))
    history, coded = codes.fit(few)
    assert codes.digest(history) == sha and len(history[0][0]) == 3
    assert sorted((r["id"], r["code"], r["error"]) for r in coded.collect()) == sorted((i, c, e) for i, _, c, e, _ in expected)
    history, coded = codes.fit(odd_vectors.where("vec_id = 300"))
    assert history == [] and coded.collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_bounds_never_change_a_code_and_spare_distances(seed):
    """Rounds with bounds against full scans, over codebooks that move, stay and come back; many ties."""
    draw = np.random.default_rng(seed)
    coarse = 3 if seed % 2 else 300
    parts = draw.integers(-coarse, coarse + 1, (700, 4)).astype(np.int32)
    history = [draw.integers(-coarse, coarse + 1, (20, 4)).astype(np.int64)]
    found, error, low, stamps = Part(history).start(parts)
    computed = full = 0
    for n in range(8):
        moved = history[-1] + draw.integers(-1, 2, (20, 4)) * (draw.random((20, 1)) < 0.4)
        history.append(history[0].copy() if n == 5 else moved)
        found, error, low, stamps, count = Part(history).next(parts, found, low, stamps)
        near = distances(parts, history[-1])
        assert (found == near.argmin(axis=1)).all() and (error == near.min(axis=1)).all()
        computed, full = computed + count, full + near.size
    if coarse == 300:
        assert computed < 0.5 * full


def test_the_sum_of_moves_counts_not_their_lengths():
    """Entries that go and come back leave the bounds as they were, so that nothing is scanned again."""
    draw = np.random.default_rng(9)
    start, away = draw.integers(-1000, 1000, (16, 4)).astype(np.int64), None
    parts = (start[draw.integers(0, 16, 400)] + draw.integers(-3, 4, (400, 4))).astype(np.int32)
    away = start + 400
    found, _, low, stamps = Part([start]).start(parts)
    *_, count = Part([start, away, start]).next(parts, found, low, stamps)
    assert count < 1.5 * len(parts)


def test_distances_are_exact_when_large():
    draw = np.random.default_rng(3)
    a, b = draw.integers(-(1 << 24), 1 << 24, (20, 40)), draw.integers(-(1 << 24), 1 << 24, (10, 40))
    expected = [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, q)) for q in b] for p in a]
    assert distances(a, b).tolist() == expected


# --- the queries --------------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["op11_hard_negatives", "op13_vector_codes"])
def test_queries_equal_their_sql(run, name):
    got = run(name)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF_DIR}/embeddings.parquet'")
    expected = con.execute(ORACLE[name]).df()
    columns = sorted(expected.columns)
    assert columns == sorted(got.columns) and name in QUERIES
    rows = lambda df: sorted(map(repr, df[columns].astype(object).itertuples(index=False, name=None)))
    assert rows(got) == rows(expected)
