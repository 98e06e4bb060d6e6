"""Ranked lexical search by presence-mask grouping.

The items are a stated query set that meets all documents.  Documents lie in blocks; a block has, for each
term that some item asks for, the documents that hold it as a bitmap, and as a list with what the term
adds to each of them.

1. One scan of the documents makes the blocks (only terms of items are kept, as lists) and the counts:
   documents with terms, terms with repeats, documents for each term.
2. A block answers an item with bitmap operations: the bitmaps of the item's terms, stacked and transposed,
   give every document the mask of the terms it holds, and equal masks form one group.  A mask's bound is the
   sum of the most that each of its terms adds to any document of the block.
3. Masks are scored from the highest bound down, some documents at a time.  The item is finished once the next
   bound is below its k-th score, over all that the task has seen; equal bounds are still scored, since a
   smaller id could win.
4. A task returns its k best of each item; the best k over all tasks stay.

Items are cut into slices of about ``SLICE_TERMS`` terms, each with a scan of its own, so what a task holds
does not grow with the number of items.  Nothing is shuffled by term, and no pairs of item and document are
written but each task's best.

Scores are whole numbers: see ``rank_documents``.

Defined cases: null and empty texts have no term, match nothing and don't count as documents; an item without
terms has no result; each row of the items is ranked for itself, whatever its id; each document row is ranked,
repeated ids too; equal scores are ordered by id, null ids last, then by place in the table; no documents or no
items give an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recengine.llm.common import Scratch

#: Documents of a block, and terms of the items that one scan looks for (about).
BLOCK, SLICE_TERMS = 8192, 400_000
#: Documents that the first masks scored hold at least; doubled each time.
FIRST = 64
#: Every ASCII byte but letters and digits parts terms; A-Z become a-z; other bytes stay.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(TERM_BYTES).split() if text else []


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def slices_of(items: DataFrame, item: str, text: str) -> DataFrame:
    """(row, item, slice, terms, times): an item's distinct terms and how often it has each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts = [Counter(terms_of(t)) for t in b["text"]]
            yield b[["row", "item"]].assign(terms=[list(c) for c in counts], times=[list(c.values()) for c in counts])

    rows = items.select(F.monotonically_increasing_id().alias("row"), F.col(item).cast("string").alias("item"), F.col(text).alias("text"))
    return rows.mapInPandas(run, "row long, item string, terms array<binary>, times array<int>").where(F.size("terms") > 0)


def scanned(docs: DataFrame, known) -> DataFrame:
    """Blocks of (key, empty, text): keys, lengths, and for each known term its documents and their counts."""

    def block(keys, empty, rows, lengths, found) -> pd.DataFrame:
        at = np.repeat(np.arange(len(found), dtype="int32"), [len(x) for x in found])
        term = np.fromiter((t for x in found for t in x), "int32", len(at))
        many = np.fromiter((n for x in found for n in x.values()), "int32", len(at))
        order = np.argsort(term, kind="stable")
        ids, starts = np.unique(term[order], return_index=True)
        return pd.DataFrame([{
            "n": len(keys), "keys": np.array(keys, "int64").tobytes(), "empty": np.array(empty, bool).tobytes(),
            "rows": np.array(rows, "int64").tobytes(), "lengths": np.array(lengths, "int64").tobytes(),
            "terms": ids.astype("int32").tobytes(), "starts": starts.astype("int32").tobytes(),
            "at": at[order].astype("int16").tobytes(), "many": many[order].tobytes(),
            "documents": sum(x > 0 for x in lengths), "words": sum(lengths)}])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = known.value
        held = [[] for _ in range(5)]
        for b in batches:
            for key, empty, row, text in zip(b["key"], b["empty"], b["row"], b["text"], strict=True):
                words = terms_of(text)
                found = Counter(map(ids.get, words))
                found.pop(None, None)
                for x, y in zip(held, (key, empty, row, len(words), found), strict=True):
                    x.append(y)
                if len(held[0]) == BLOCK:
                    yield block(*held)
                    held = [[] for _ in range(5)]
        if held[0]:
            yield block(*held)

    return docs.mapInPandas(run, "n int, keys binary, empty binary, rows binary, lengths binary, terms binary, starts binary, "
                                 "at binary, many binary, documents long, words long")


def document_counts(blocks: DataFrame, terms: int) -> np.ndarray:
    """The documents that hold each term; a bounded table (one number for each term of the slice)."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.zeros(terms, np.int64)
        for b in batches:
            for ids, starts, size in zip(b["terms"], b["starts"], b["size"], strict=True):
                table[np.frombuffer(ids, "int32")] += np.diff(np.frombuffer(starts, "int32"), append=size)
        at = np.flatnonzero(table)
        yield pd.DataFrame({"term": at, "n": table[at]})

    each = blocks.select("terms", "starts", (F.length("at") / 2).cast("int").alias("size")).mapInPandas(count, "term int, n long")
    table = np.zeros(terms, np.int64)
    for r in each.groupBy("term").agg(F.sum("n").alias("n")).collect():
        table[r["term"]] = r["n"]
    return table


class Block:
    """A block's bitmaps, lists and bounds."""

    def __init__(self, r, documents: int, words: int):
        self.n = r.n
        self.keys, self.rows = np.frombuffer(r.keys, "int64"), np.frombuffer(r.rows, "int64")
        self.empty = np.frombuffer(r.empty, bool)
        self.terms = np.frombuffer(r.terms, "int32")
        self.at = np.frombuffer(r.at, "int16").astype("int64")
        self.ends = np.append(np.frombuffer(r.starts, "int32"), len(self.at))
        many, lengths = np.frombuffer(r.many, "int32").astype("int64"), np.frombuffer(r.lengths, "int64")
        # Python's whole numbers where 25 * n * N would pass 64 bits
        small = 25 * int(lengths.max(initial=0)) * documents < 2 ** 63
        m = 75 + (25 * lengths * documents // words if small else np.array([25 * int(x) * documents // words for x in lengths], "int64"))
        self.adds = 1_000_000_000 * many // (1000 * many + 12 * m[self.at])
        self.most = np.maximum.reduceat(self.adds, self.ends[:-1])
        bits = np.zeros((len(self.terms), BLOCK), bool)
        bits[np.repeat(np.arange(len(self.terms)), np.diff(self.ends)), self.at] = True
        self.bitmaps = np.packbits(bits, axis=1)

    def masks(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(masks as rows of bits, the mask of each of the documents, documents) for the terms at ``own``."""
        stacked = np.unpackbits(self.bitmaps[own], axis=1, count=self.n)
        docs = np.flatnonzero(stacked.any(axis=0))
        packed = np.packbits(stacked[:, docs], axis=0)  # 8 terms a byte
        wide = np.zeros((len(docs), -(-len(packed) // 8) * 8), np.uint8)
        wide[:, :len(packed)] = packed.T
        words = wide.view(np.uint64)
        if words.shape[1] == 1:
            _, first, mask = np.unique(words[:, 0], return_index=True, return_inverse=True)
        else:
            _, first, mask = np.unique(words, axis=0, return_index=True, return_inverse=True)
        return stacked[:, docs[first]].T, mask.ravel(), docs

    def score(self, own: np.ndarray, weights: np.ndarray, docs: np.ndarray) -> np.ndarray:
        out = np.zeros(len(docs), np.int64)
        for i, w in zip(own, weights, strict=True):
            a, z = self.ends[i], self.ends[i + 1]
            place = np.minimum(np.searchsorted(self.at[a:z], docs), z - a - 1) + a
            out += np.where(self.at[place] == docs, w * self.adds[place], 0)
        return out


class Best:
    """The k best (score, empty, key, row) that a task has seen of one item."""

    def __init__(self, k: int):
        self.k, self.held = k, [np.zeros(0, np.int64)] * 4

    def least(self) -> int:
        """The lowest score that can still enter."""
        return max(1, int(self.held[0][-1])) if len(self.held[0]) == self.k else 1

    def add(self, score, empty, key, row) -> None:
        use = score >= self.least()
        score, empty, key, row = (np.concatenate([x, y[use]]) for x, y in zip(self.held, (score, empty, key, row), strict=True))
        order = np.lexsort((row, key, empty, -score))[: self.k]
        self.held = [score[order], empty[order], key[order], row[order]]


def search(block: Block, own: np.ndarray, weights: np.ndarray, best: Best) -> None:
    """Adds the block's best documents for the terms at ``own``, masks by descending bound."""
    bits, mask, docs = block.masks(own)
    bound = bits.astype("int64") @ (weights * block.most[own])
    down = np.argsort(-bound, kind="stable")
    place = np.empty(len(down), np.int64)
    place[down] = np.arange(len(down))
    order = np.argsort(place[mask], kind="stable")  # documents, the masks of the highest bounds first
    docs, bounds = docs[order], bound[mask[order]]
    at, step = 0, FIRST
    while at < len(docs) and bounds[at] >= best.least():
        to = min(len(docs), at + step)
        part = np.sort(docs[at:to])
        best.add(block.score(own, weights, part), block.empty[part].astype("int64"), block.keys[part], block.rows[part])
        at, step = to, 2 * step


def searched(blocks: DataFrame, shared, k: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, weights, documents, words = shared.value
        best = {row: Best(k) for row, _, _ in items}
        place = np.full(len(weights), -1, np.int64)
        for b in batches:
            for r in b.itertuples():
                block = Block(r, documents, words) if len(r.terms) else None
                if block is None:
                    continue
                place[block.terms] = np.arange(len(block.terms))
                for row, terms, times in items:
                    own = place[terms]
                    here = own >= 0
                    if here.any():
                        search(block, own[here], weights[terms[here]] * times[here], best[row])
                place[block.terms] = -1
        for row, x in best.items():
            if len(x.held[0]):
                yield pd.DataFrame(dict(zip(("score", "empty", "key", "doc"), x.held, strict=True))).assign(item=row)

    return blocks.mapInPandas(run, "item long, score long, empty long, key long, doc long")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text",
                   item: str = "item_id", item_text: str = "text", rank: str = "rank", score: str = "score") -> DataFrame:
    """(item, rank, key, score): the k highest-scoring documents of each item, scores above 0.

    The weight w of a term is floor(1000 * ln((2 N + 2) / (2 df + 1))), N the documents with terms and df those
    that hold it.  A document of n terms has m = 75 + (25 n N) div L, L being all terms.  It scores the sum over
    the item's terms, repeats included, of w * ((10**9 tf) div (1000 tf + 12 m)).
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "lexical_search")
    asked = scratch.save(slices_of(items, item, item_text))
    size = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    slices = max(1, -(-size // SLICE_TERMS))
    texts = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long")).alias("key"), F.col(key).isNull().alias("empty"),
                        F.monotonically_increasing_id().alias("row"), F.col(text).alias("text"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), "empty", "key", "doc")
    out = None
    for i in range(slices):
        own = asked.where(F.pmod(F.xxhash64("row"), F.lit(slices)) == i).select("row", "terms", "times").collect()
        known: dict[bytes, int] = {}
        wanted = [(r["row"], np.array([known.setdefault(bytes(t), len(known)) for t in r["terms"]]), np.array(r["times"], "int64")) for r in own]
        if not wanted and i + 1 < slices:
            continue
        blocks = scratch.save(scanned(texts, spark.sparkContext.broadcast(known)))
        counts = blocks.agg(F.sum("documents"), F.sum("words")).first()
        n = counts[0] or 0
        weights = np.array([weight(n, int(x)) for x in document_counts(blocks, len(known))], "int64")
        near = searched(blocks, spark.sparkContext.broadcast((wanted, weights, n, counts[1] or 0)), k)
        best = scratch.save(near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
        scratch.drop(blocks)
        out = best if out is None else out.unionByName(best)
    names = asked.select(F.col("row").alias("item"), F.col("item").alias("name"))
    return out.join(names, "item").select(
        F.col("name").cast(items.schema[item].dataType).alias(item), F.col("rank").cast("int").alias(rank),
        F.when(F.col("empty") == 0, F.col("key")).cast(docs.schema[key].dataType).alias(key), F.col("score").alias(score))
