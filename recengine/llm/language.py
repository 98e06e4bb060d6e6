"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Features are the 1- to 3-grams of the lower-cased text, hashed to 2**15 places, with linear counts,
inverse document frequencies over all documents that may be learned from, and unit length.  The
weights are fitted by follow-the-regularised-leader with elastic-net penalties on a bounded sample
(``fit_rows``, taken by a hash of the id in equal parts for each language, languages with fewer rows
giving all), and the softmax is calibrated by one temperature on the part of the sample left out.
Only the fit is bounded; document frequencies and predictions cover every row and whole texts.

Defined cases: null texts and texts without a letter are ``und`` with score 0; without a row to learn
from every text is ``und``; with one language that language has score 1; of more than
``MOST_LANGUAGES`` languages those of most rows are learned (ties by name), and other texts get the likeliest of
them; repeated rows give repeated results; an empty table gives an empty table; result columns replace input columns of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recengine.llm.common import with_results

BITS = 15
PLACES = 1 << BITS
#: Characters that are hashed at a time, so that memory stays bounded for texts of any length.
PIECE = 1 << 20
#: A model has places x languages weights, so it learns at most this many languages, those of most rows first.
MOST_LANGUAGES = 512
UND = "und"


def counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(places, counts): how often each place occurs among the text's 1-, 2- and 3-grams, places ascending."""
    text, pieces = text.lower(), []
    for at in range(0, len(text), PIECE):
        c = np.frombuffer(text[max(0, at - 2): at + PIECE].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        fresh = min(at, 2)  # leading characters seen before; a gram counts where it ends
        gram, found = np.zeros(len(c), np.uint64), []
        for n in range(3):
            if n >= len(c):
                break
            gram = c if n == 0 else gram[:-1] * np.uint64(0x1F123BB5) + c[n:]
            mixed = (gram + np.uint64(n + 1)) * np.uint64(0x9E3779B97F4A7C15)
            found.append((mixed >> np.uint64(64 - BITS)).astype(np.int64)[max(0, fresh - n):])
        pieces.append(np.concatenate(found))
    if sum(map(len, pieces)) < PLACES // 8:
        return np.unique(np.concatenate([np.zeros(0, np.int64), *pieces]), return_counts=True)
    table = sum(np.bincount(x, minlength=PLACES) for x in pieces)
    at = np.flatnonzero(table)
    return at, table[at]


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class LanguageModel:
    """Weights of the places that have any (``rows`` says where a place's are, -1: it has none), and intercepts."""

    languages: list[str]
    idf: np.ndarray
    rows: np.ndarray
    weights: np.ndarray  # a row for each place with weights, a column for each language
    intercepts: np.ndarray
    temperature: float = 1.0

    @classmethod
    def of(cls, languages: list[str], idf: np.ndarray, dense: np.ndarray) -> LanguageModel:
        """From places + 1 rows of weights, the last for the intercepts."""
        used = np.flatnonzero(dense[:-1].any(axis=1))
        rows = np.full(PLACES, -1, np.int32)
        rows[used] = np.arange(len(used))
        return cls(languages, idf, rows, dense[used], dense[-1])

    def logits(self, places: np.ndarray, many: np.ndarray) -> np.ndarray:
        v = many * self.idf[places]
        norm = np.sqrt(v @ v)
        row = self.rows[places]
        here = row >= 0
        return (v[here] @ self.weights[row[here]]) / (norm or 1.0) + self.intercepts

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UND, 0.0
        p = softmax(self.logits(*counts(text)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(min(1.0, p[best]))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = 3, alpha: float = 1.0,
         beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> np.ndarray:
    """Weights by follow-the-regularised-leader; a row is (places, values, class)."""
    z, n = np.zeros((PLACES + 1, classes)), np.zeros((PLACES + 1, classes))

    def weight(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        w = (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2)
        return np.where(np.abs(z) > l1, w, 0.0)

    for _ in range(epochs):
        for places, values, y in rows:
            zi, ni = z[places], n[places]
            w = weight(zi, ni)
            p = softmax(values @ w)
            p[y] -= 1.0
            g = values[:, None] * p
            n_new = ni + g * g
            z[places] = zi + g - (np.sqrt(n_new) - np.sqrt(ni)) / alpha * w
            n[places] = n_new
    return weight(z, n)


def calibrated(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature of lowest log loss, by golden-section search on its logarithm."""
    if not len(y):
        return 1.0

    def loss(t: float) -> float:
        return -np.log(np.maximum(softmax(logits / np.exp(t))[np.arange(len(y)), y], 1e-12)).mean()

    low, high, r = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = high - r * (high - low), low + r * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each place occurs, over all rows; each task sends its sums once."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(PLACES, np.int64), 0
        for b in batches:
            for t in b["text"]:
                df[counts(t)[0]] += 1
                n += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"place": np.append(at, PLACES), "n": np.append(df[at], n)})

    found = texts.mapInPandas(partial, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(PLACES + 1, np.int64)
    out[found["place"]] = found["n"]
    return out[:-1], int(out[-1])


def sample_features(rows: DataFrame, idf: np.ndarray) -> pd.DataFrame:
    """Unit TF-IDF vectors of the sample as (lang, rank, places, values)."""

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text, lang, rank in zip(b["text"], b["lang"], b["rank"], strict=True):
                at, many = counts(text)
                v = many * idf[at]
                norm = np.sqrt((v ** 2).sum()) or 1.0
                out.append((lang, rank, at.astype("int32").tobytes(), (v / norm).astype("float32").tobytes()))
            yield pd.DataFrame(out, columns=["lang", "rank", "places", "values"])

    return rows.mapInPandas(vectors, "lang string, rank long, places binary, values binary").toPandas()


def fit(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang", key: str = "doc_id",
        fit_rows: int = 3000) -> LanguageModel:
    """Learn from rows where ``learn`` holds and text and language are given; at most about ``fit_rows`` fit weights."""
    rows = (docs.where(learn & F.col(text).isNotNull() & F.col(lang).isNotNull())
            .select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"),
                    F.xxhash64(F.lit("language"), F.col(key)).alias("rank")))
    most = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    sizes = {r["lang"]: r["count"] for r in sorted(most, key=lambda r: r["lang"])}
    if not sizes:
        return LanguageModel.of([], np.zeros(PLACES), np.zeros((PLACES + 1, 0)))
    df, n = document_frequencies(rows.select("text"))
    idf = np.log((1.0 + n) / (1.0 + df)) + 1.0
    each = max(1, fit_rows // len(sizes))
    part = F.lit(0.0)
    for name, size in sizes.items():
        part = F.when(F.col("lang") == name, min(1.0, each / size)).otherwise(part)
    # The hash, seen as a fraction of its range, is below the language's share.
    chosen = rows.where((F.col("rank").cast("double") / 2.0 ** 64 + 0.5) < part)
    sample = sample_features(chosen, idf).sort_values(["rank", "lang", "places", "values"], kind="stable")
    languages = list(sizes)
    at = {name: i for i, name in enumerate(languages)}
    data = [(np.append(np.frombuffer(r.places, "int32"), PLACES), np.append(np.frombuffer(r.values, "float32").astype("float64"), 1.0),
             at[r.lang]) for r in sample.itertuples()]
    order = np.random.default_rng(0).permutation(len(data))
    held, used = order[: len(order) // 5], order[len(order) // 5:]
    dense = ftrl([data[i] for i in used], len(languages))
    model = LanguageModel.of(languages, idf, dense)
    if len(held) and len(languages) > 1:
        z = np.array([data[i][1] @ dense[data[i][0]] for i in held])
        model.temperature = calibrated(z, np.array([data[i][2] for i in held]))
    return model


def predict(df: DataFrame, model: LanguageModel, text: str = "text", lang_pred: str = "lang_pred",
            score: str = "score") -> DataFrame:
    """Append the predicted language and its calibrated probability."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded: places x languages

    @F.pandas_udf("lang string, score double")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            yield pd.DataFrame([own.predict(t) for t in texts], columns=["lang", "score"])

    p = "_" + "_".join(df.columns)  # a name that no column has
    return (with_results(df, {p: predicted(df[text])})
            .withColumns({lang_pred: F.col(f"`{p}`.lang"), score: F.col(f"`{p}`.score")}).drop(p))
