"""Toxicity scores from the nearest labelled examples by exact TF-IDF cosine.

Terms are lower-cased words and the character 5-grams of words (with a mark at either end), so that
inflected forms meet.  A bounded sample of labelled rows (``fit_rows``, a quarter of it toxic, by
a hash of the id) gives the examples.  Terms that the labels depend on there (chi-square of presence) form
the vocabulary; their document frequencies are counted over all documents.

An index lists, for each term, the examples that hold it in blocks with the block's largest weight.
A query adds up those maxima to an upper bound for each block and scores blocks from the highest bound
down, until no block left can reach its k-th similarity; so the neighbours are exact.  The score is
the similarity-weighted vote of the neighbours, shrunk to the labels' base rate where similarities are
small, and calibrated by a logistic fit on leave-one-out votes weighted to the labels' true shares.
The neighbours, their labels and similarities are the evidence.

Only the sample is bounded; document frequencies and scores cover every row and whole texts.

Defined cases: null and empty texts, and texts without a vocabulary term, have no neighbours and get
the calibrated base rate; without any labelled row every score is 0; an id labelled more than once
counts as toxic if one of its labels says so, null labels don't count; equal similarities go to the
smaller place in the sample; repeated rows give repeated results; an empty table gives an empty table;
result columns replace input columns of the same name.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recengine.llm.common import with_results

TOKEN = re.compile(r"[^\W_]+")
GRAM = 5
#: Longest word whose grams are looked at one by one, and words a Python worker remembers.
REMEMBERED = 200_000
#: A text of an example has at most this many bytes; longer ones are not drawn into the sample.
EXAMPLE_BYTES = 1 << 18
BLOCK, NEIGHBOURS, SHRINK = 32, 15, 0.25
#: A term needs this chi-square and, as chi-square grows with the sample, this share of the sample's size.
CHI_SQUARE, CHI_SHARE, LEAST_EXAMPLES, MOST_TERMS = 16.0, 0.01, 4, 50_000


def word_terms(word: str) -> list[str]:
    marked = f"^{word}$"
    return [word, *(marked[i: i + GRAM] for i in range(max(0, len(marked) - GRAM + 1)))]


def words(text: str | None) -> Counter:
    return Counter(TOKEN.findall(text.lower())) if text else Counter()


@dataclass
class Terms:
    """Term ids of words; most words have none, and a word is looked at once per worker."""

    ids: dict[str, int]
    known: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def counts(self, text: str | None) -> dict[int, int]:
        out: dict[int, int] = {}
        known = self.known
        for w, n in words(text).items():
            own = known.get(w)
            if own is None:
                own = tuple(i for t in word_terms(w) if (i := self.ids.get(t)) is not None)
                if len(known) >= REMEMBERED:
                    known.clear()
                known[w] = own
            for i in own:
                out[i] = out.get(i, 0) + n
        return out


def spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The places of all ranges [start, end), one range after the other."""
    lengths = ends - starts
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class BlockMaxIndex:
    """Postings by term in blocks of examples, with each block's largest weight.

    An entry is a term's part of one block: its block, its largest weight and where its postings lie; entries lie by term.
    """

    def __init__(self, vectors: list[dict[int, float]], block: int = BLOCK):
        # Examples with the same strongest terms share blocks, which keeps the bounds tight.
        lead = [max(v, key=lambda t: (v[t], -t)) if v else -1 for v in vectors]
        self.order = sorted(range(len(vectors)), key=lambda i: (lead[i], i))
        self.block = block
        self.blocks = -(-len(vectors) // block)
        found = [(t, place, w) for place, i in enumerate(self.order) for t, w in vectors[i].items()]
        term, self.at, self.weights = (np.array(x) for x in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        by = np.lexsort((self.at, term))
        term, self.at, self.weights = term[by], self.at[by], self.weights[by]
        part = np.stack([term, self.at // block])
        self.starts = np.flatnonzero(np.append(True, (part[:, 1:] != part[:, :-1]).any(axis=0))) if len(term) else np.zeros(0, int)
        self.ends = np.append(self.starts[1:], len(term))[: len(self.starts)]
        self.entry_block = part[1, self.starts]
        self.top = np.maximum.reduceat(self.weights, self.starts) if len(term) else np.zeros(0)
        terms, first = np.unique(term[self.starts], return_index=True)
        last = np.append(first[1:], len(self.starts))
        self.entries = {t: (a, z) for t, a, z in zip(terms.tolist(), first.tolist(), last.tolist(), strict=True)}
        self.scored = 0  # postings looked at, for tests

    def nearest(self, query: dict[int, float], k: int, but: int = -1) -> list[tuple[float, int]]:
        """The k examples of highest positive similarity as (similarity, example), ties to the smaller example.

        Blocks come by falling bound, some at a time, twice as many each time; only their postings are read. The
        search ends once the next bound is below the k-th similarity.
        """
        own = [(w, *self.entries[t]) for t, w in query.items() if t in self.entries]
        if not own:
            return []
        weight, first, last = (np.array(x) for x in zip(*own, strict=True))
        entry, weight = spans(first, last), np.repeat(weight, last - first)
        block = self.entry_block[entry]
        bounds = np.bincount(block, weight * self.top[entry], self.blocks)
        order = np.argsort(-bounds, kind="stable")
        best: list[tuple[float, int]] = []
        done, step = 0, 2
        while done < len(order) and bounds[order[done]] > 0 and (len(best) < k or bounds[order[done]] >= best[-1][0] - 1e-9):
            use = np.zeros(self.blocks, bool)
            use[order[done: done + step]] = True
            here = use[block]
            a, z = self.starts[entry[here]], self.ends[entry[here]]
            posting = spans(a, z)
            self.scored += len(posting)
            scores = np.bincount(self.at[posting], np.repeat(weight[here], z - a) * self.weights[posting])
            at = np.flatnonzero(scores)
            if len(at) > 4 * k:  # keep what reaches the k-th score of these, ties included, and one for ``but``
                least = np.partition(scores[at], len(at) - k - 1)[len(at) - k - 1]
                at = at[scores[at] >= least - 1e-9]
            found = [(round(s, 12), self.order[p]) for s, p in zip(scores[at].tolist(), at.tolist(), strict=True)]
            best = sorted([*best, *(x for x in found if x[1] != but)], key=lambda x: (-x[0], x[1]))[:k]
            done, step = done + step, 2 * step
        return best


@dataclass
class ToxicityModel:
    terms: Terms
    idf: np.ndarray
    index: BlockMaxIndex | None
    labels: list[int]
    ids: list
    base: float = 0.0
    slope: float = 1.0
    shift: float = 0.0
    k: int = NEIGHBOURS

    def vector(self, counts: dict[int, int]) -> dict[int, float]:
        v = {t: (1.0 + math.log(n)) * self.idf[t] for t, n in counts.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {t: x / norm for t, x in sorted(v.items())} if norm else {}

    def vote(self, near: list[tuple[float, int]]) -> float:
        mass = sum(s for s, _ in near)
        return (sum(s * self.labels[i] for s, i in near) + SHRINK * self.base) / (mass + SHRINK)

    def score(self, text: str | None) -> tuple[float, list[tuple[float, int]]]:
        if self.index is None:
            return 0.0, []
        v = self.vector(self.terms.counts(text))
        near = self.index.nearest(v, self.k) if v else []
        return logistic(self.slope * logit(self.vote(near)) + self.shift), near


def logit(p: float) -> float:
    p = min(max(p, 1e-4), 1 - 1e-4)
    return math.log(p / (1 - p))


def logistic(z: float) -> float:
    return 1 / (1 + math.exp(-min(max(z, -40.0), 40.0)))


def platt(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of a weighted logistic fit by Newton's method, with a small ridge towards (1, 0)."""
    a, b, ridge = 1.0, 0.0, 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -40, 40)))
        g = np.array([(w * (p - y) * x).sum() + ridge * (a - 1), (w * (p - y)).sum() + ridge * b])
        h = w * p * (1 - p)
        m = np.array([[(h * x * x).sum() + ridge, (h * x).sum()], [(h * x).sum(), h.sum() + ridge]])
        step = np.linalg.solve(m, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 1e-3), float(b)


def examples(docs: DataFrame, labels: DataFrame, learn: Column, text: str, key: str, label: str,
             fit_rows: int) -> tuple[list[tuple], float]:
    """[(id, label, text)] of the sample and the share of label 1 among the rows that may be learned from."""
    own = (labels.where(learn & F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("key"))
           .agg(F.max((F.col(label) == 1).cast("int")).alias("label")))
    sizes = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
    if not sizes:
        return [], 0.0
    rank = F.xxhash64(F.lit("toxicity"), F.col("key"))
    drawn = None
    for value in (0, 1):  # top rows by hash: the documented bound of the sample
        size = fit_rows // 4 if value else fit_rows - fit_rows // 4
        part = own.where(F.col("label") == value).orderBy(rank, "key").limit(size)
        drawn = part if drawn is None else drawn.unionByName(part)
    rows = (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .where(F.col("text").isNotNull() & (F.octet_length("text") <= EXAMPLE_BYTES))
            .join(F.broadcast(drawn), "key")  # at most fit_rows rows of two numbers
            .groupBy("key", "label").agg(F.min("text").alias("text")).orderBy(rank, "key").collect())
    return [(r["key"], r["label"], r["text"]) for r in rows], sizes.get(1, 0) / sum(sizes.values())


def vocabulary(sample: list[tuple]) -> dict[str, int]:
    """Terms whose presence depends on the label: chi-square with one degree of freedom."""
    has = (Counter(), Counter())
    for _, y, text in sample:
        has[y].update({t for w in words(text) for t in word_terms(w)})
    n = len(sample)
    n1 = sum(y for _, y, _ in sample)
    found = []
    for t in has[0].keys() | has[1].keys():
        a, b = has[1][t], has[0][t]
        c, d = n1 - a, n - n1 - b
        if a + b >= LEAST_EXAMPLES and (part := (a + b) * (c + d) * n1 * (n - n1)):
            chi = n * (a * d - b * c) ** 2 / part
            if chi >= max(CHI_SQUARE, CHI_SHARE * n):
                found.append((-chi, t))
    return {t: i for i, (_, t) in enumerate(sorted(found)[:MOST_TERMS])}


def document_frequencies(texts: DataFrame, terms: Terms) -> tuple[np.ndarray, int]:
    """In how many of all texts each term occurs; each task sends its sums once."""
    shared = texts.sparkSession.sparkContext.broadcast(terms)
    size = len(terms.ids)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df, n = np.zeros(size + 1, np.int64), 0
        for b in batches:
            for t in b["text"]:
                for i in shared.value.counts(t):
                    df[i] += 1
            n += len(b)
        df[size] = n
        at = np.flatnonzero(df)
        yield pd.DataFrame({"term": at, "n": df[at]})

    found = texts.mapInPandas(partial, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size + 1, np.int64)
    out[found["term"]] = found["n"]
    return out[:-1], int(out[-1])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, text: str = "text", key: str = "doc_id",
        label: str = "toxic", fit_rows: int = 6000) -> ToxicityModel:
    """Examples from the labels where ``learn`` holds; document frequencies from all of ``docs``."""
    sample, base = examples(docs, labels, learn, text, key, label, fit_rows)
    if not sample:
        return ToxicityModel(Terms({}), np.zeros(0), None, [], [])
    terms = Terms(vocabulary(sample))
    df, n = document_frequencies(docs.select(F.col(text).alias("text")), terms)
    model = ToxicityModel(terms, np.log((1.0 + n) / (1.0 + df)) + 1.0, None, [y for _, y, _ in sample],
                          [i for i, _, _ in sample], base)
    vectors = [model.vector(terms.counts(t)) for _, _, t in sample]
    model.index = BlockMaxIndex(vectors)
    y = np.array(model.labels)
    x = np.array([logit(model.vote(model.index.nearest(v, model.k, but=i) if v else [])) for i, v in enumerate(vectors)])
    share = {1: base, 0: 1 - base}
    w = np.array([share[c] / max(1, (y == c).sum()) * len(y) for c in y])
    model.slope, model.shift = platt(x, y, w)
    terms.known.clear()
    return model


def score(df: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score", predicted: str = "predicted",
          evidence: str | None = "evidence", threshold: float = 0.5) -> DataFrame:
    """Append the score, whether it reaches the threshold, and the neighbours behind it."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded by fit_rows and the vocabulary

    @F.pandas_udf("score double, near array<struct<example:string,label:int,similarity:double>>")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = shared.value
        for texts in batches:
            out = []
            for t in texts:
                s, near = own.score(t)
                out.append((s, [{"example": str(own.ids[i]), "label": own.labels[i], "similarity": x} for x, i in near]))
            yield pd.DataFrame(out, columns=["score", "near"])

    p = "_" + "_".join(df.columns)  # a name that no column has
    out = with_results(df, {p: scored(df[text])}).withColumns({score: F.col(f"`{p}`.score")})
    out = out.withColumns({predicted: (F.col(score) >= threshold).cast("int")})
    return (out.withColumns({evidence: F.col(f"`{p}`.near")}) if evidence else out).drop(p)
