"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

P(grade >= k) = s(w . x - threshold_k): one weight vector for all grades, ascending thresholds, s the logistic function.
The features of a text are its different words (runs of letters, lower case) and their first four and five letters, each counted once
for every different word it comes from; so a text's sum is that of its words, and words are scored once a task. The expected
severity is the sum of the probabilities.

Grades come from a column, or from 0/1 labels: the toxic texts of the sample are split, at equal shares, by how many of their words
have a feature that is far more frequent in toxic texts than in others.

Defined cases: null and empty texts and texts without letters have the sum 0 and count as such; labelled rows without
a text or label are not learned from; without both labels every severity is 0; texts of any length are read whole;
repeated labels of a document count each; further columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import ship

#: Bound of the sample that is learned from: documents of each label.
PER_LABEL = 2500
#: Grades above 0.
GRADES = 3
#: A feature is learned if its shares of toxic and of other texts differ by so many standard errors.
LEAST_ERRORS = 5.0
#: How much more frequent in toxic texts a feature is that counts for a text's grade.
MARKED = 8.0
#: From this probability of grade 1 or above a document counts as toxic: a missed one costs more than a doubtful one.
TOXIC = 0.3
STEPS, RATE, DECAY = 300, 0.05, 1e-4
SEED = 42
#: Words whose scores a task remembers.
REMEMBERED = 1 << 20
PREFIXES = (4, 5)
_WORDS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def features(word: str) -> list[str]:
    return [word, *["^" + word[:n] for n in PREFIXES if len(word) >= n]]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Model:
    weights: dict[str, float]
    thresholds: list[float]
    _scores: dict[str, float] = field(default_factory=dict, repr=False)

    def total(self, text: str | None) -> float:
        different, scores = set(words(text)), self._scores
        new = [w for w in different if w not in scores]
        if new:
            if len(scores) + len(new) > REMEMBERED:
                scores.clear()
                new = list(different)
            for word in new:
                scores[word] = math.fsum(self.weights.get(f, 0.0) for f in features(word))
        return math.fsum(map(scores.__getitem__, different))  # the same in any order

    def at_least(self, text: str | None) -> np.ndarray:
        """Probabilities of grade 1 and above, 2 and above, and so on."""
        return _logistic(self.total(text) - np.array(self.thresholds))


def telling(toxic: np.ndarray, sparse: list[Counter]) -> list[str]:
    """The features whose shares of the two kinds of texts differ beyond chance."""
    having = [Counter(), Counter()]
    for t, own in zip(toxic, sparse):
        having[t].update(own.keys())
    size = [max(1, int((toxic == t).sum())) for t in (0, 1)]
    found = []
    for feature in having[0].keys() | having[1].keys():
        n = [having[0][feature], having[1][feature]]
        overall = sum(n) / sum(size)
        error = math.sqrt(overall * (1 - overall) * (1 / size[0] + 1 / size[1]))
        if error and abs(n[1] / size[1] - n[0] / size[0]) >= LEAST_ERRORS * error:
            found.append(feature)
    return sorted(found)


def grades_of(texts: list[Counter], toxic: np.ndarray, names: list[str], rows: np.ndarray, columns: np.ndarray, grades: int) -> np.ndarray:
    """0 for a clean text, else 1 to `grades`, by the share of toxic texts with no more marked words."""
    with_feature = [np.bincount(columns[toxic[rows] == t], minlength=len(names)) for t in (0, 1)]
    share = [(n + 0.5) / (max(1, (toxic == t).sum()) + 1) for t, n in enumerate(with_feature)]
    marked = {names[i] for i in np.flatnonzero(share[1] > MARKED * share[0])}
    hits = np.array([sum(n for w, n in text.items() if any(f in marked for f in features(w))) for text in texts])
    cuts = np.quantile(hits[toxic == 1], np.arange(1, grades) / grades) if (toxic == 1).any() else []
    return np.where(toxic == 1, 1 + np.searchsorted(cuts, hits, side="left"), 0)


def train(texts: list[str], labels: list[int], weights: list[float] | None = None, grades: int = GRADES, graded: bool = False) -> Model | None:
    """Fits the weights and thresholds by Adam on all rows at once. labels: 0/1, or grades from 0 up if `graded`."""
    labels = np.array(labels, dtype=np.int64)
    if len(set(labels.tolist())) < 2:
        return None
    counted = [Counter(words(t)) for t in texts]
    sparse = [Counter(f for w in c for f in features(w)) for c in counted]
    names = telling((labels > 0).astype(np.int64), sparse)
    index = {f: i for i, f in enumerate(names)}
    entries = [(row, index[f], n) for row, own in enumerate(sparse) for f, n in sorted(own.items()) if f in index]
    rows, columns, values = (np.array(x) for x in zip(*entries)) if entries else (np.zeros(0, dtype=np.int64),) * 3
    y = labels if graded else grades_of(counted, labels, names, rows, columns, grades)
    top = int(y.max()) if graded else grades
    over = (y[:, None] >= np.arange(1, top + 1)).astype(np.float64)
    weight = np.ones(len(y)) if weights is None else np.array(weights, dtype=np.float64)
    weight /= weight.sum()
    # Ascending thresholds: the first one, and the logarithms of the steps.
    values_now = {"w": np.zeros(len(names)), "t": np.concatenate([[1.0], np.zeros(top - 1)])}
    mean = {k: np.zeros_like(v) for k, v in values_now.items()}
    square = {k: np.zeros_like(v) for k, v in values_now.items()}
    for step in range(1, STEPS + 1):
        sums = np.bincount(rows, values * values_now["w"][columns], minlength=len(y)) if len(rows) else np.zeros(len(y))
        widths = np.exp(values_now["t"][1:])
        thresholds = values_now["t"][0] + np.concatenate([[0.0], np.cumsum(widths)])
        wrong = (_logistic(sums[:, None] - thresholds) - over) * weight[:, None]
        by_threshold = -wrong.sum(axis=0)
        slopes = {
            "w": (np.bincount(columns, values * wrong.sum(axis=1)[rows], minlength=len(names)) if len(rows) else 0.0) + DECAY * values_now["w"],
            "t": np.concatenate([[by_threshold.sum()], widths * np.cumsum(by_threshold[:0:-1])[::-1]]),
        }
        for k, slope in slopes.items():
            mean[k] += 0.1 * (slope - mean[k])
            square[k] += 0.001 * (slope * slope - square[k])
            values_now[k] = values_now[k] - RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-10)
    thresholds = values_now["t"][0] + np.concatenate([[0.0], np.cumsum(np.exp(values_now["t"][1:]))])
    return Model(dict(zip(names, values_now["w"].tolist())), thresholds.tolist())


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str = "toxic", seed: int = SEED) -> DataFrame:
    """(text, label, weight): at most `PER_LABEL` documents of each label by a seeded hash; the weight makes up for those left out."""
    ids = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    ids = ids.withColumn("turn", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)))
    counts = ids.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    ids = ids.join(F.broadcast(counts), "label")  # one row a label
    thinned = ids.where(F.col("turn") / F.lit(float(1 << 30)) * F.col("n") < 2 * PER_LABEL)
    first = F.row_number().over(Window.partitionBy("label").orderBy("turn", "doc_id"))
    chosen = thinned.withColumn("nth", first).where(F.col("nth") <= PER_LABEL)
    chosen = chosen.select("doc_id", "label", "turn", (F.col("n") / F.least("n", F.lit(PER_LABEL))).alias("weight"))
    found = docs.select("doc_id", "text").where(F.col("text").isNotNull())
    return found.join(F.broadcast(chosen), "doc_id").select("text", "label", "weight", "turn", "doc_id")  # at most PER_LABEL rows a label


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", graded: bool = False) -> Model | None:
    rows = labelled_sample(docs, labels, label).toPandas().sort_values(["turn", "doc_id", "text", "label"])
    return train(rows["text"].tolist(), rows["label"].tolist(), rows["weight"].tolist(), graded=graded)


def grade(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns and `toxicity`: a struct of severity (expected grade), p_toxic (grade 1 or above) and grade (the median)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else (model.weights, model.thresholds))
    made: dict[str, Model] = {}

    @F.pandas_udf("severity double, p_toxic double, grade int")
    def answer(texts: pd.Series) -> pd.DataFrame:
        if shared.value is not None and not made:
            made["model"] = Model(*shared.value)
        rows = []
        for text in texts:
            p = made["model"].at_least(text) if made else np.zeros(1)
            rows.append((float(p.sum()), float(p[0]), int((p >= 0.5).sum())))
        return pd.DataFrame(rows, columns=["severity", "p_toxic", "grade"])

    return docs.withColumn("toxicity", answer("text"))
