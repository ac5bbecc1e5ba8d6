"""Toxicity: accuracy on documents not learned from, the ordinal model itself, odd rows."""

import duckdb
import numpy as np

from marketlake.llm import toxicity

DATA = "/root/testdata/sf0.1"


def rows():
    return duckdb.sql(
        f"SELECT doc_id, text, lang, toxic FROM '{DATA}/documents.parquet' JOIN '{DATA}/labels.parquet' USING (doc_id) WHERE text IS NOT NULL ORDER BY doc_id"
    ).fetchall()


def test_documents_not_learned_from():
    found = rows()
    learned, rest = [r for r in found if r[0] % 3], [r for r in found if r[0] % 3 == 0]
    model = toxicity.train([r[1] for r in learned], [r[3] for r in learned])
    flagged = np.array([model.at_least(r[1])[0] >= toxicity.TOXIC for r in rest])
    toxic = np.array([r[3] == 1 for r in rest])
    assert flagged[~toxic].mean() < 0.01
    assert flagged[toxic].mean() > 0.8  # some labelled texts have no toxic word at all
    severity = np.array([model.at_least(r[1]).sum() for r in rest])
    assert severity[toxic].mean() > 10 * severity[~toxic].mean()


def test_grades_given_are_learned_in_order():
    random = np.random.default_rng(1)
    texts, grades = [], []
    for _ in range(900):
        grade = int(random.integers(0, 3))
        words = [f"w{'abcdefgh'[i]}{'abcdefgh'[j]}" for i, j in random.integers(0, 8, (20, 2))]
        words += [["vile"], ["vile", "awful", "nasty", "dire"]][grade - 1] if grade else []
        texts.append(" ".join(words))
        grades.append(grade)
    model = toxicity.train(texts, grades, graded=True)
    assert model.thresholds == sorted(model.thresholds) and len(model.thresholds) == 2
    predicted = [int((model.at_least(t) >= 0.5).sum()) for t in texts]
    assert np.mean(np.array(predicted) == grades) > 0.97
    assert np.all(np.diff([model.at_least(t) for t in texts], axis=1) <= 0)


def test_query_and_odd_rows(run, given, spark, odd, no_docs):
    got = run("op3_toxicity")
    assert set(got["doc_id"]) == set(given["doc_id"]) and got["severity"].between(0, 3).all()
    model = toxicity.train(["you idiot " + "abc"[i % 3] * 3 for i in range(60)] + ["fine day " + "abc"[i % 3] * 3 for i in range(60)], [1] * 60 + [0] * 60)
    graded = toxicity.grade(odd, model)
    assert graded.columns == [*odd.columns, "toxicity"] and graded.count() == odd.count()
    assert graded.where("toxicity.severity IS NULL").count() == 0
    assert toxicity.grade(no_docs, model).count() == 0
    one = spark.createDataFrame([(1, 0), (2, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.fit(odd, one) is None
    assert {r["toxicity"]["severity"] for r in toxicity.grade(odd, None).collect()} == {0.0}


def test_sums_do_not_depend_on_order():
    model = toxicity.Model({"aa": 0.1, "bb": 0.2, "cc": 0.3, "^dddd": -7.7}, [0.5])
    assert model.total("AA bb, cc dddde") == model.total("dddde cc bb aa") == toxicity.math.fsum([0.1, 0.2, 0.3, -7.7])


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "PER_LABEL", 20)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 100 == 0)) for i in range(3000)], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, labels).toPandas()
    assert sample["label"].value_counts().to_dict() == {0: 20, 1: 20}
    assert abs(sample.groupby("label")["weight"].sum()[0] - 2970) < 1


def plain_ordinal(texts, grades, decay):
    """Gradient descent with halved steps on the cumulative-link loss, over a dense matrix of the same features: probabilities of grade 1 and above, 2 and above."""
    counted = [toxicity.Counter(f for w, n in toxicity.Counter(toxicity.words(t)).items() for f in toxicity.features(w)) for t in texts]
    grades = np.array(grades)
    names = toxicity.telling((grades > 0).astype(int), counted)
    x = np.array([[c[f] for f in names] for c in counted], dtype=float)
    over = (grades[:, None] >= np.arange(1, grades.max() + 1)).astype(float)

    def loss(w, t):
        z = (x @ w)[:, None] - t
        return (np.logaddexp(0, z) - over * z).sum(axis=1).mean() + decay / 2 * (w @ w)

    w, t, rate = np.zeros(len(names)), np.linspace(0.5, 1.5, over.shape[1]), 1.0
    for _ in range(20_000):
        wrong = (1 / (1 + np.exp(t - (x @ w)[:, None])) - over) / len(x)
        to_w, to_t = x.T @ wrong.sum(axis=1) + decay * w, -wrong.sum(axis=0)
        while rate > 1e-9 and loss(w - rate * to_w, t - rate * to_t) > loss(w, t):
            rate /= 2
        w, t, rate = w - rate * to_w, t - rate * to_t, rate * 1.1
    return 1 / (1 + np.exp(t - (x @ w)[:, None]))


def test_fit_and_grades_by_plain_gradient_descent(spark):
    """The whole way through Spark against a plain fit of the same rows: probability of being toxic, and expected grade."""
    random = np.random.default_rng(8)
    texts, grades = [], []
    for _ in range(400):
        grade = int(random.integers(0, 3))
        # Every grade has some words of the others, so that no threshold parts the texts for good.
        shown = int(np.clip(grade + random.choice([-1, 0, 0, 0, 1]), 0, 2))
        words = [f"w{'abcdefgh'[i]}{'abcdefgh'[j]}" for i, j in random.integers(0, 8, (12, 2))] + [["vile"], ["vile", "awful"]][shown - 1] * (shown > 0)
        texts.append(" ".join(words))
        grades.append(grade)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(grades)), "doc_id long, toxic int")
    graded = toxicity.grade(docs, toxicity.fit(docs, labels, graded=True)).orderBy("doc_id").select("toxicity.*").toPandas()
    expected = plain_ordinal(texts, grades, toxicity.DECAY)
    assert np.abs(graded["p_toxic"] - expected[:, 0]).max() < 0.03
    assert np.abs(graded["severity"] - expected.sum(axis=1)).max() < 0.05
