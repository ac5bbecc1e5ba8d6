"""The operators on documents against brute force, on the smallest tables and on odd rows."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
import xxhash

from marketlake.llm import exact, langid, mixing, packing, simhash, weighted

WHITE, WORD = re.compile(r"[\x20\x09-\x0D]"), re.compile(r"[^\x20\x09-\x0D]+")


def none(value):
    return None if value is None or value != value else value


# --- exact dedup --------------------------------------------------------------------------------


def plain_dedup(rows):
    groups = defaultdict(list)
    for at, (doc_id, text) in enumerate(rows):
        groups[hashlib.sha256(WHITE.sub("", text or "").encode()).hexdigest()].append((-len(text or ""), doc_id is None, doc_id or 0, at))
    out = []
    for digest, own in groups.items():
        first = min(own)
        out += [(rows[at][0], rows[first[3]][0], len(own), digest, at == first[3]) for *_, at in own]
    return out


def test_exact_dedup_keeps_one_row_of_each_text(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["digest"].hex(), r["kept"]) for r in exact.decide(odd).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain_dedup(rows)))
    kept = exact.survivors(odd)
    assert kept.columns == odd.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(d for d, *_, k in plain_dedup(rows) if k)


def test_exact_dedup_against_earlier_batches(spark, odd, tmp_path):
    first = exact.DigestIndex(spark, str(tmp_path / "index"), buckets=4)
    kept = [r["doc_id"] for r in exact.survivors(odd, first).collect()]
    later = exact.DigestIndex(spark, str(tmp_path / "index"))
    assert later.buckets == 4
    more = spark.createDataFrame([(100, "thecatsatonthemat and longer than before" [:17] + "     "), (101, "new")], "doc_id long, text string")
    decided = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact.decide(more, later).collect()}
    assert decided == {100: (2, False), 101: (101, True)}
    # The same batch again: its own digests don't count against it.
    assert sorted(map(repr, (r["doc_id"] for r in exact.survivors(odd, later).collect()))) == sorted(map(repr, kept))


def test_index_is_matched_by_sort_merge_and_not_shuffled(spark, odd, tmp_path):
    index = exact.DigestIndex(spark, str(tmp_path / "plan"), buckets=4)
    index.register(exact.keyed(odd))
    groups = exact.keyed(odd).groupBy("digest").count()
    plan = groups.join(index.entries().select("digest").hint("merge"), "digest", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan and plan.count("Exchange") == 1


def test_survivors_shuffle_the_texts_once(spark, odd):
    """One shuffle of the rows, one of the keepers; and the rows themselves: null ids and repeated rows among them."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = exact.survivors(odd)
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = got.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert plan.count("Exchange hashpartitioning") == 2 and got.columns == odd.columns
    kept = {(r["doc_id"], r["keep_id"]) for r in exact.decide(odd).collect() if r["kept"]}
    assert sorted(r["doc_id"] for r in rows) == sorted(d for d, _ in kept) and len({(r["text"] or "").strip() for r in rows}) == len(rows)


# --- SimHash ------------------------------------------------------------------------------------


def plain_fingerprint(text, words=3):
    found = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(found[i : i + words]).encode(), 42) for i in range(max(1, len(found) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """{doc_id: fingerprint} → {doc_id: smallest doc_id reachable}, by all pairs of different fingerprints."""
    docs = defaultdict(list)
    for d, f in prints.items():
        docs[f].append(d)
    values = sorted(docs)
    root = {f: f for f in values}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for a, b in itertools.combinations(values, 2):
        if (a ^ b).bit_count() <= 2:
            root[find(a)] = find(b)
    smallest = {}
    for f in values:
        smallest[find(f)] = min([smallest.get(find(f), 1 << 62), *docs[f]])
    return {d: smallest[find(f)] for d, f in prints.items()}


def test_simhash_query_against_all_pairs(run, given):
    prints = {d: plain_fingerprint(t) for d, t in zip(given["doc_id"], given["text"])}
    groups = plain_groups(prints)
    got = run("op9_simhash_groups")
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got.itertuples()} == {d: (f"{f:016x}", groups[d]) for d, f in prints.items()}


def test_simhash_chunks_of_a_long_text(monkeypatch):
    text = " ".join(str(i * i % 7919) for i in range(5000))
    whole = simhash.fingerprint(text, 3) & (1 << 64) - 1
    monkeypatch.setattr(simhash, "CHUNK", 100)
    assert whole == simhash.fingerprint(text, 3) & (1 << 64) - 1 == plain_fingerprint(text)


@pytest.mark.parametrize("paired", [1, 32])
def test_simhash_links_reach_every_group(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)  # 1: every shared block is dealt out bit by bit
    random = np.random.default_rng(3)
    prints = set()
    for _ in range(12):
        value = int(random.integers(0, 1 << 63))
        for _ in range(20):
            prints.add(value)
            for bit in random.integers(0, 64, random.integers(1, 4)):
                value ^= 1 << int(bit)
    prints = {i: f for i, f in enumerate(sorted(prints))}
    frame = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in prints.values()], "fp long")
    edges = [(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in simhash.links(frame).collect()]
    assert all((a ^ b).bit_count() <= 2 for a, b in edges)
    roots = {r["node"] & (1 << 64) - 1: r["root"] & (1 << 64) - 1 for r in simhash.components(simhash.links(frame)).collect()}
    expected, at = plain_groups(prints), {f: i for i, f in prints.items()}
    got = defaultdict(set)
    for i, f in prints.items():
        got[roots.get(f, f)].add(i)
    assert sorted(map(sorted, got.values())) == sorted(sorted(i for i in prints if expected[i] == g) for g in set(expected.values()))


def test_simhash_odd_rows(odd, no_docs):
    got = [(r["doc_id"], r["component_id"]) for r in simhash.near_groups(odd).collect()]
    ids = dict(got)
    assert len(got) == odd.count()
    assert ids[1] == ids[2] == ids[6] == 1 and ids[3] == ids[4] == ids[5] == 3 and ids[7] == 7
    kept = simhash.representatives(odd)
    assert kept.columns == odd.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 7, 8, 9]
    assert simhash.near_groups(no_docs).count() == 0


# --- packing ------------------------------------------------------------------------------------


def check_packing(pieces, capacity):
    pieces = pieces.sort_values(["sequence_id", "offset"])
    length = pieces.groupby("sequence_id")["length"]
    assert (length.cumsum() - pieces["length"] == pieces["offset"]).all()
    assert length.sum().max() <= capacity


def test_packing_query(run, given):
    from tokenizers import Tokenizer

    encode = Tokenizer.from_file(packing.vocabulary(packing.TOKENIZER))
    got = run("op1_best_fit_packing")
    check_packing(got, 2048)
    expected = []
    for doc_id, text in zip(given["doc_id"], given["text"]):
        ids = [*encode.encode(text, add_special_tokens=False).ids, 0]
        cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
        for piece, (a, b) in enumerate(itertools.pairwise(cuts)):
            expected.append((doc_id, piece, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(got[columns].itertuples(index=False, name=None)) == sorted(expected)
    assert got["sequence_id"].nunique() <= max(-(-got["length"].sum() // 2048) + 2, (got["length"] > 1024).sum())


def test_ranks_give_the_ids_of_the_tokenizer():
    encode = packing.Encoder(packing.vocabulary(packing.TOKENIZER), packing.vocabulary(packing.RANKS))
    random = np.random.default_rng(5)
    pools = [range(1, 0x250), range(0x300, 0x3000), range(0x3000, 0xD800), range(0x1F300, 0x1FA00), [9, 10, 32, 32, 160, 0x3000, 0x85]]
    texts = ["", " ", "\n\n  x", "a<|endoftext|>b", "don't  stop 123"] + [
        "".join(chr(random.choice(pools[random.integers(5)])) for _ in range(random.integers(0, 30))) for _ in range(2000)
    ]
    for text in texts:
        assert encode(text).tolist() == encode.full.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_close_to_the_least_number(seed):
    random = np.random.default_rng(seed)
    lengths = random.integers(1, [100, 60, 35, 100, 50, 20][seed] + 1, 3000)
    counts = Counter(map(int, lengths))
    steps, sequences = packing.plan(dict(counts), 100)
    rank, used = Counter(), defaultdict(list)
    for step in steps.sort_values(["length", "first"]).itertuples():
        following = steps[(steps["length"] == step.length) & (steps["first"] > step.first)]["first"].min()
        end = counts[step.length] if following != following else int(following)
        assert rank[step.length] == step.first
        for r in range(step.first, end):
            used[step.sequence + (r - step.first) // step.each].append((step.offset + (r - step.first) % step.each * step.length, step.length))
        rank[step.length] = end
    assert rank == counts and len(used) == sequences
    for own in used.values():
        assert [o for o, _ in sorted(own)] == list(itertools.accumulate([0, *[n for _, n in sorted(own)]]))[:-1]
        assert sum(n for _, n in own) <= 100
        assert sum(3 * n > 100 for _, n in own) <= 2
    assert sequences <= max(-(-lengths.sum() // 100), (2 * lengths > 100).sum()) * 1.03 + 1


def test_packing_odd_rows(odd, no_docs):
    got = packing.pack(odd, capacity=64).toPandas()
    check_packing(got, 64)
    assert (got["ids"].str.len() == 4 * got["length"]).all()
    whole = got[got["doc_id"] == 7].sort_values("piece")
    ids = np.frombuffer(b"".join(whole["ids"]), dtype="<u4")
    encode = packing.Encoder(packing.vocabulary(packing.TOKENIZER), packing.vocabulary(packing.RANKS))
    assert encode.full.decode(ids[:-1].tolist()) == odd.where("doc_id = 7").first()["text"] and ids[-1] == 0
    assert (whole["length"].iloc[1:] == 64).all() and got["doc_id"].isna().sum() == 2
    assert got[got["doc_id"].isin([3, 4])]["length"].tolist() == [1, 1]
    assert packing.pack(no_docs).count() == 0


# --- mixing -------------------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    fixed, total = set(), sum(sizes.values())
    while True:
        rest, open_ = total - sum(most * sizes[s] for s in fixed), [s for s in names if s not in fixed]
        share = rest / sum(weight[s] for s in open_) if open_ else 0
        over = [s for s in open_ if weight[s] * share > most * sizes[s]]
        if not over:
            return {s: most * sizes[s] if s in fixed else weight[s] * share for s in names}
        fixed |= set(over)


def check_mix(plan, source_of):
    plan["source"] = [none(s) for s in source_of]
    sizes = defaultdict(int)
    for s, n in zip(plan["source"], plan["size"]):
        sizes[s] += n
    targets = plain_targets(sizes)
    assert (plan["taken"] <= 3 * plan["size"]).all() and (plan["taken"] >= 0).all()
    for s, own in plan.groupby("source", dropna=False):
        s = none(s)
        assert own["source_size"].iloc[0] == sizes[s] and own["target"].iloc[0] == pytest.approx(targets[s])
        assert abs(own["taken"].sum() - targets[s]) <= mixing.BLOCK
    assert abs(plan["taken"].sum() - sum(sizes.values())) <= 2 * mixing.BLOCK


def test_mix_query(run, given):
    got = run("op6_mix_sources").sort_values("doc_id").reset_index(drop=True)
    assert got["size"].tolist() == [len(WORD.findall(t)) for t in given["text"]]
    check_mix(got, given["source"])


def test_mix_limits_shards_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD", 7)
    docs = [(i, " ".join(["w"] * (1 + i * 13 % 40)), ["tiny", "b", "c", None][0 if i < 3 else 1 + i % 3]) for i in range(200)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    plans = [mixing.mix(frame.repartition(n)).drop("row").toPandas().sort_values("doc_id").reset_index(drop=True) for n in (2, 5)]
    pd.testing.assert_frame_equal(*plans)
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(text.split())
    targets = plain_targets(sizes)
    assert targets["tiny"] < 3 * sizes["tiny"] * 1.0001 and sum(targets.values()) == pytest.approx(sum(sizes.values()))
    for source, total in sizes.items():
        taken = sum(t for t, d in zip(plans[0]["taken"], docs) if d[2] == source)
        assert abs(taken - targets[source]) <= mixing.BLOCK * (1 + (targets[source] == 3 * total) * total / 7)
    mixed = mixing.mixture(frame).toPandas()
    assert mixed["text"].map(lambda t: len(t.split())).sum() == plans[0]["taken"].sum()


def highest_quotients(votes, seats):
    won = Counter()
    for _ in range(seats):
        won[max(votes, key=lambda p: (votes[p] / (2 * won[p] + 1), -p))] += 1
    return [won[p] for p in sorted(votes)]


@pytest.mark.parametrize("seed", range(4))
def test_sainte_lague_by_highest_quotients(spark, seed):
    random = np.random.default_rng(seed)
    votes = {p: int(v) for p, v in enumerate(random.integers(0, [1000, 10, 100000, 3][seed], 23))}
    seats = [100, 17, 5000, 40][seed]
    parties = spark.createDataFrame([(0, p, v) for p, v in votes.items()], "g int, p int, v long")
    totals = spark.createDataFrame([(0, seats, sum(votes.values()))], "g int, seats long, all_votes long")
    got = mixing.sainte_lague(parties, "g", "p", "v", totals).collect()
    assert [r["quota"] for r in sorted(got, key=lambda r: r["p"])] == highest_quotients(votes, seats)


def test_mix_odd_rows(odd, no_docs):
    rows = odd.collect()
    plan = mixing.mix(odd).select("row.*", "size", "source_size", "target", "taken").toPandas()
    assert len(plan) == len(rows)
    check_mix(plan, plan["source"])
    assert (plan[plan["text"].isna() | (plan["text"] == "")]["taken"] == 0).all()
    assert mixing.mixture(odd).columns == odd.columns
    assert mixing.mix(no_docs).count() == 0 and mixing.mixture(no_docs).count() == 0


# --- language ID --------------------------------------------------------------------------------


def test_language_id_query(run, given):
    got = run("op10_language_id").sort_values("doc_id").reset_index(drop=True)
    assert got["held_out"].tolist() == [zlib.crc32(str(d).encode()) % 3 == 1 for d in given["doc_id"]]
    own = got["held_out"]
    assert (got["lang_pred"] == given["lang"])[own].mean() >= 0.97
    assert got["score"].between(0, 1).all()


def test_tables_give_the_sums_of_the_network():
    texts = ["the cat sat on the mat " * 30, "der Hund und die Katze über " * 30] * 4
    model = langid.train(texts, ["en", "de"] * 4)
    found, sizes = langid.windows(texts[1])
    assert sizes.sum() == len(texts[1].encode()) and found.shape[1] == langid.WINDOW
    pooled = []
    for window in found:
        inputs = np.stack([np.concatenate([model.embedding[b] for b in window[i : i + 4]]) for i in range(langid.WINDOW - 3)])
        pooled.append((inputs @ model.filters).max(axis=0))
    plain = langid._softmax(np.maximum(np.array(pooled) + model.bias, 0) @ model.out + model.out_bias)
    assert np.allclose(plain, model.probabilities(found), atol=1e-4)
    assert langid.identify(model, texts[0])[0] == "en" and langid.identify(model, texts[1])[0] == "de"


def test_language_id_odd_rows(odd, no_docs):
    model = langid.fit(odd)
    assert set(model.languages) <= {"en", "de"}
    got = [(r["doc_id"], r["prediction"]["lang_pred"], r["prediction"]["score"]) for r in langid.predict(odd, model).collect()]
    und = {d for d, lang, score in got if lang == "und" and score == 0}
    assert und == {3, 4, 5, 8, None} and len(got) == odd.count()
    kept = langid.accepted(odd, least=0.0)
    assert kept.columns == odd.columns and not {3, 4, 5, 8} & {r["doc_id"] for r in kept.collect()}
    assert langid.fit(no_docs) is None and langid.accepted(no_docs).count() == 0
    assert {r["prediction"]["lang_pred"] for r in langid.predict(odd, None).collect()} == {"und"}


def test_packing_survives_very_long_runs_of_white_space(spark):
    """The faster way to encode gives up on them; the ids are the tokenizer's all the same."""
    from tokenizers import Tokenizer

    texts = [" " * 1_000_000 + "x", "\t" * 1_000_000 + "x", "\n" * 1_000_000 + "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = defaultdict(list)
    for r in sorted(packing.pack(docs).collect(), key=lambda r: (r["doc_id"], r["piece"])):
        got[r["doc_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    plain = Tokenizer.from_file(packing.vocabulary(packing.TOKENIZER))
    assert got == {n: [*plain.encode(t, add_special_tokens=False).ids, 0] for n, t in enumerate(texts)}


# --- weighted fingerprints ----------------------------------------------------------------------


def generalised_jaccard(a, b):
    a, b = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 1.0


def test_weighted_fingerprints_query(run, given):
    got = run("op7_weighted_fingerprints").sort_values("doc_id").reset_index(drop=True)
    texts = given["text"].tolist()
    edited = [t[: len(t) - len(t) // 4] + n[: len(t) // 4] for t, n in zip(texts, [*texts[1:], texts[0]])]
    assert got["n_chars"].tolist() == [len(t) for t in texts]
    assert got["edited_sha256"].tolist() == [hashlib.sha256(e.encode()).hexdigest() for e in edited]
    true_edited = [generalised_jaccard(t, e) for t, e in zip(texts, edited)]
    true_next = [generalised_jaccard(t, n) for t, n in zip(texts, [*texts[1:], texts[0]])]
    wrong = np.abs(np.concatenate([got["near_edited"] - true_edited, got["near_next"] - true_next]))
    assert wrong.mean() < 0.05 and np.quantile(wrong, 0.99) < 0.2
    assert abs((got["near_edited"] - true_edited).mean()) < 0.015
    same = defaultdict(set)
    for text, print_ in zip(texts, got["fingerprint"]):
        same[text].add(print_)
    assert all(len(s) == 1 for s in same.values())
    assert all(isinstance(p, str) and len(p) % 6 == 0 for p in [*got["fingerprint"], *got["edited_fingerprint"]])


def test_weighted_odd_rows(odd, no_docs):
    got = weighted.fingerprints(odd).toPandas()
    assert len(got) == odd.count()
    by = {none(r.doc_id): r for r in got.itertuples()}
    assert len(by[3].fingerprint) == 0 and by[4].near_next == 1.0 and by[4].near_edited == 1.0
    assert list(by[1].fingerprint) == list(by[2].fingerprint) == list(by[6].fingerprint)
    assert by[7].n_chars == len(odd.where("doc_id = 7").first()["text"])
    assert weighted.fingerprints(no_docs).count() == 0


def test_equal_texts_alone(spark):
    one = spark.createDataFrame([(1, "a b c a")], "doc_id long, text string")
    row = weighted.fingerprints(one).first()
    assert row["near_next"] == 1.0 and row["edited_sha256"] == hashlib.sha256(b"a b c a").hexdigest()


def test_query_columns_and_whole_tables(run, given):
    for name in ("op1_best_fit_packing", "op4_exact_dedup", "op6_mix_sources", "op7_weighted_fingerprints", "op9_simhash_groups", "op10_language_id"):
        assert set(run(name)["doc_id"]) == set(given["doc_id"]), name
