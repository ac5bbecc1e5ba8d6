"""Near-duplicate documents of five-word shingles and a similarity of 0.8, against all pairs."""

import numpy as np
import pytest

from marketlake.llm import neardup
from tests.llm.test_repeats import sentence


def plain_pairs(texts):
    """All pairs of documents whose sets of shingles are as much alike as asked for, and not by the same text."""
    sets = {d: frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := (t or "").lower().split()) else frozenset() for d, t in texts.items()}
    ids = sorted(sets)
    near = lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    return [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if near(a, b)]


def plain_near_groups(texts):
    group = {d: d for d in texts}

    def root(d):
        while group[d] != d:
            d = group[d]
        return d

    for a, b in plain_pairs(texts):
        low, high = sorted((root(a), root(b)))
        group[high] = low
    return {d: root(d) for d in texts}


def groups_of(spark, texts):
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    return {r["doc_id"]: r["component_id"] for r in neardup.near_groups(docs).collect()}


def changed(random, text, share):
    return " ".join(w if random.random() >= share else sentence(random, 1) for w in text.split())


def test_near_copies_are_found_and_others_left(spark):
    """Copies with words changed up to the least similarity, among texts that share parts but not enough."""
    random = np.random.default_rng(3)
    texts = {}
    for n in range(0, 300, 3):
        texts[n] = sentence(random, int(random.integers(60, 400)))
        texts[n + 1] = changed(random, texts[n], float(random.choice([0.005, 0.01, 0.015, 0.02])))
        words = texts[n].split()
        texts[n + 2] = " ".join(words[: len(words) // 2]) + " " + sentence(random, len(words) // 2)
    texts[300], texts[301], texts[302], texts[303], texts[304] = None, "", "a b", "A  b", "a b c"
    got, pairs = groups_of(spark, texts), plain_pairs(texts)
    assert len(pairs) > 80 and sum(got[a] == got[b] for a, b in pairs) >= 0.95 * len(pairs)
    truth = plain_near_groups(texts)
    assert all(truth[d] == truth[g] for d, g in got.items())  # nothing is joined that isn't near
    assert all(got[n + 2] == n + 2 for n in range(0, 300, 3))


def test_large_groups_and_crowds_that_are_not_near(spark, monkeypatch):
    """Hundreds of near copies of one text, and many texts that share half of a form without being near."""
    monkeypatch.setattr(neardup, "PAIRED", 4)
    random = np.random.default_rng(5)
    base, form = sentence(random, 300), sentence(random, 200).split()
    texts = {n: changed(random, base, 0.004) for n in range(150)}
    for n in range(200, 320):
        texts[n] = " ".join(form[:150]) + " " + sentence(random, 70) + " " + " ".join(form[150:])
    for n in range(400, 440):
        texts[n] = changed(random, texts[n - 200], 0.005)
    got, pairs = groups_of(spark, texts), plain_pairs(texts)
    truth = plain_near_groups(texts)
    assert all(truth[d] == truth[g] for d, g in got.items())
    assert all(got[n] == 0 for n in range(150))
    apart = [(a, b) for a, b in pairs if a >= 200]
    assert len(apart) >= 35 and sum(got[a] == got[b] for a, b in apart) >= 0.9 * len(apart)


@pytest.mark.parametrize("side", [neardup.SIDE, 8])
def test_a_crowd_whose_lowest_is_near_nobody_loses_no_pair(spark, monkeypatch, side):
    """Texts whose fingerprints are near the lowest one's, though the texts are not: each is near to two others of the crowd."""
    monkeypatch.setattr(neardup, "PAIRED", 1)
    monkeypatch.setattr(neardup, "SIDE", side)
    monkeypatch.setattr(neardup, "STRIP", 3)
    random = np.random.default_rng(8)
    form, texts = sentence(random, 340), {}
    for n in range(0, 90, 3):
        texts[n] = form + " " + sentence(random, 60)
        texts[n + 1], texts[n + 2] = (changed(random, texts[n], 0.004) for _ in range(2))
    got, truth = groups_of(spark, texts), plain_near_groups(texts)
    assert len(set(truth.values())) < 90 and got == truth


def test_odd_rows(odd, no_docs):
    got = neardup.near_groups(odd).collect()
    assert len(got) == odd.count()
    by = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert by[1] == by[2] == by[6] == 1 and by[3] == by[4] == by[5] == 3 and by[7] == 7 and by[8] == 8
    assert neardup.representatives(odd).columns == odd.columns
    assert neardup.near_groups(no_docs).collect() == []


@pytest.mark.parametrize("number", [1, 1000, 10**6, 10**10])
def test_choices_reach_the_wanted_probability(number):
    chosen = neardup.choices(number)
    bits = len(chosen[0]) * neardup.BLOCK
    one = (1 - neardup.differing(neardup.LEAST)) ** bits
    assert 1 - (1 - one) ** len(chosen) >= neardup.MET and bits >= np.log2(max(2, number))


def test_places_are_those_of_the_chosen_blocks():
    random = np.random.default_rng(9)
    lanes = random.integers(-(2**63), 2**63 - 1, size=(300, neardup.LANES))
    lanes[150:] = lanes[:150] ^ (1 << random.integers(0, 63, size=(150, neardup.LANES)))
    chosen = neardup.choices(300)
    bits = [tuple(int(lane) >> at & 3 for lane in row for at in range(0, 64, 2)) for row in lanes]
    keys = [[(n, *[row[b] for b in c]) for n, c in enumerate(chosen)] for row in bits]
    got = neardup.placed(lanes, chosen).tolist()
    pairs = {(key, place) for k, p in zip(keys, got) for key, place in zip(k, p)}
    assert len(pairs) == len({k for k, _ in pairs}) == len({p for _, p in pairs})


def test_pairs_of_a_crowd_that_are_not_near_never_become_rows(spark, monkeypatch):
    """All fingerprints of a crowd are within the radius and its texts are not near: rows that are joined don't grow with its square."""
    monkeypatch.setattr(neardup, "PAIRED", 1)
    random, asked, plain = np.random.default_rng(8), [], neardup.verified
    form = sentence(random, 340)
    texts = {n: form + " " + sentence(random, 50) for n in range(160)}
    texts[160] = changed(random, texts[100], 0.004)
    monkeypatch.setattr(neardup, "verified", lambda pairs, held: asked.append(pairs.count()) or plain(pairs, held))
    assert groups_of(spark, texts) == plain_near_groups(texts)
    assert sum(asked) < 161 * 160 / 2 / 4, asked
