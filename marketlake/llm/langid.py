"""Language ID by a convolutional network over bytes, trained in numpy and applied to windows of the whole text.

A window is a fixed number of bytes. Each byte has a small embedding; filters two, three and four bytes wide run over
the window, the largest answer of each filter is kept, and a softmax layer weighs them. A text's answer is the mean of
its windows' answers, weighted by their bytes. For prediction, the products of embeddings and filters are tabulated by
byte pairs, which gives the same sums by look-up.

Defined cases: null text or text without a letter: `und`, score 0; labelled rows with null or empty text are not
learned from; if nothing can be learned, everything is `und`; a null doc_id is neither held out nor learned from;
texts of any length are read whole, so many windows at a time; further columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import ship, stored

WINDOW = 256
EMBEDDING = 8
FILTERS = 16
WIDTHS = (2, 3, 4)
REACH = max(WIDTHS)
#: Bounds of the sample that is learned from: documents of a language, windows of a document.
PER_LANGUAGE = 300
PER_DOCUMENT = 6
EPOCHS = 6
BATCH = 64
SEED = 42
#: Windows that are scored at once.
AT_ONCE = 64
UNKNOWN = "und"
#: Below this score the pipeline rejects a document: no language stands out.
LEAST_SCORE = 0.3
#: Up to so many different labels their counts are broadcast; more than that is no list of languages, and the texts are shuffled.
FEW_LANGUAGES = 10_000
_ASCII_LETTER = re.compile(r"[A-Za-z]")


def windows(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the whole text, the last one filled up with zeros, and the number of bytes in each."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    number = max(1, -(-len(raw) // WINDOW))
    filled = np.zeros(number * WINDOW, dtype=np.uint8)
    filled[: len(raw)] = raw
    sizes = np.full(number, WINDOW)
    sizes[-1] = len(raw) - (number - 1) * WINDOW
    return filled.reshape(number, WINDOW), sizes


def _mask() -> np.ndarray:
    """Filters narrower than the widest have no weights for the bytes beyond."""
    mask = np.zeros((REACH, EMBEDDING, len(WIDTHS) * FILTERS), dtype=np.float32)
    for i, width in enumerate(WIDTHS):
        mask[:width, :, i * FILTERS : (i + 1) * FILTERS] = 1
    return mask.reshape(REACH * EMBEDDING, -1)


@dataclass
class Model:
    languages: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def __post_init__(self) -> None:
        """Sums by the first two bytes of a place, for all filters, and by the next two, for the wider ones."""
        one = [self.embedding @ self.filters[j * EMBEDDING : (j + 1) * EMBEDDING] for j in range(REACH)]
        self._first = (one[0][:, None, :] + one[1][None, :, :]).reshape(1 << 16, -1)
        self._next = (one[2][:, None, FILTERS:] + one[3][None, :, FILTERS:]).reshape(1 << 16, -1)

    def probabilities(self, found: np.ndarray) -> np.ndarray:
        pooled = np.empty((len(found), len(WIDTHS) * FILTERS), dtype=np.float32)
        for at in range(0, len(found), AT_ONCE):
            part = found[at : at + AT_ONCE].astype(np.int32)
            pairs = part[:, :-1] * 256 + part[:, 1:]
            sums = self._first[pairs[:, : WINDOW - REACH + 1]]
            sums[:, :, FILTERS:] += self._next[pairs[:, 2:]]
            pooled[at : at + AT_ONCE] = sums.max(axis=1)
        return _softmax(np.maximum(pooled + self.bias, 0) @ self.out + self.out_bias)


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], seed: int = SEED) -> Model | None:
    """Fits a model by Adam on the windows of the texts; the order of rows and all random numbers come from the seed."""
    languages = sorted(set(labels))
    if not languages:
        return None
    random = np.random.default_rng(seed)
    samples, classes = [], []
    for text, label in zip(texts, labels):
        found, _ = windows(text)
        chosen = np.unique(np.linspace(0, len(found) - 1, min(PER_DOCUMENT, len(found))).astype(int))
        samples.append(found[chosen])
        classes += [languages.index(label)] * len(chosen)
    x, y = np.concatenate(samples), np.array(classes)
    weight = (len(y) / (len(languages) * np.bincount(y, minlength=len(languages))))[y].astype(np.float32)

    width, mask = len(WIDTHS) * FILTERS, _mask()
    normal = lambda *shape, scale: random.normal(0, scale, shape).astype(np.float32)
    values = {
        "embedding": normal(256, EMBEDDING, scale=0.5),
        "filters": normal(REACH * EMBEDDING, width, scale=0.25) * mask,
        "bias": np.zeros(width, dtype=np.float32),
        "out": normal(width, len(languages), scale=0.1),
        "out_bias": np.zeros(len(languages), dtype=np.float32),
    }
    mean = {k: np.zeros_like(v) for k, v in values.items()}
    square = {k: np.zeros_like(v) for k, v in values.items()}
    step, places = 0, WINDOW - REACH + 1
    for _ in range(EPOCHS):
        order = random.permutation(len(x))
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            n = len(own)
            bytes_ = np.lib.stride_tricks.sliding_window_view(x[own], REACH, axis=1)  # n, places, REACH
            inputs = values["embedding"][bytes_].reshape(n * places, -1)
            answers = (inputs @ values["filters"]).reshape(n, places, width)
            best = answers.argmax(axis=1)
            pooled = np.take_along_axis(answers, best[:, None, :], axis=1)[:, 0] + values["bias"]
            hidden = np.maximum(pooled, 0)
            wrong = _softmax(hidden @ values["out"] + values["out_bias"])
            wrong[np.arange(n), y[own]] -= 1
            wrong *= (weight[own] / n)[:, None]
            back = (wrong @ values["out"].T) * (pooled > 0)
            seen = bytes_[np.arange(n)[:, None], best]  # n, width, REACH: the bytes each filter answered to
            chosen = values["embedding"][seen].reshape(n, width, -1)
            to_embedding = (back[:, :, None] * values["filters"].T[None]).reshape(n * width * REACH, EMBEDDING)
            embedding = np.zeros_like(values["embedding"])
            np.add.at(embedding, seen.reshape(-1), to_embedding)
            slopes = {
                "embedding": embedding,
                "filters": np.einsum("nf,nfd->df", back, chosen) * mask,
                "bias": back.sum(axis=0),
                "out": hidden.T @ wrong,
                "out_bias": wrong.sum(axis=0),
            }
            step += 1
            for k, slope in slopes.items():
                mean[k] += 0.1 * (slope - mean[k])
                square[k] += 0.001 * (slope * slope - square[k])
                values[k] -= 0.01 * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    return Model(languages, **values)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """At most `PER_LANGUAGE` labelled documents of each language that are not held out, by a seeded hash.

    A hash threshold from the language's count thins each language out in the scan, so that only some
    hundreds of a language meet in one task.
    """
    usable = docs.where(
        F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & (F.length("text") > 0)
    ).select("lang", "text", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)).alias("turn"), "doc_id")
    labels = stored(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    if labels.count() <= FEW_LANGUAGES:
        labels = F.broadcast(labels)
    thinned = usable.join(labels, "lang").where(F.col("turn") / F.lit(float(1 << 30)) * F.col("n") < 4 * PER_LANGUAGE)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("turn", "doc_id", "text"))
    return thinned.withColumn("nth", first).where(F.col("nth") <= PER_LANGUAGE).select("lang", "text", "turn")


def fit(docs: DataFrame, seed: int = SEED) -> Model | None:
    """Learns from the sample, which is bounded by the number of languages, on the driver."""
    rows = labelled_sample(docs, seed).toPandas().sort_values(["lang", "turn", "text"])
    return train(rows["text"].tolist(), rows["lang"].tolist(), seed)


def has_letter(text: str) -> bool:
    return _ASCII_LETTER.search(text) is not None or any(c.isalpha() for c in text)


def identify(model: Model | None, text: str | None) -> tuple[str, float]:
    if model is None or text is None or not has_letter(text):
        return UNKNOWN, 0.0
    found, sizes = windows(text)
    mean = sizes @ model.probabilities(found) / sizes.sum()
    best = int(mean.argmax())
    return model.languages[best], float(min(1.0, mean[best]))


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """All columns and `prediction`: a struct of lang_pred and score. The model is some 20 MB of tables, whatever the corpus."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(None if model is None else {k: getattr(model, k) for k in Model.__dataclass_fields__})
    made: dict[str, Model | None] = {}

    @F.pandas_udf("lang_pred string, score double")
    def answer(texts: pd.Series) -> pd.DataFrame:
        if not made:
            made["model"] = None if shared.value is None else Model(**shared.value)
        return pd.DataFrame([identify(made["model"], t) for t in texts], columns=["lang_pred", "score"])

    return docs.withColumn("prediction", answer("text"))


def accepted(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """The documents whose language is known with a score of `least` or more, columns as before."""
    names = docs.columns
    found = predict(docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col("text")), fit(docs))
    return found.where((F.col("prediction.lang_pred") != UNKNOWN) & (F.col("prediction.score") >= least)).select("row.*")
