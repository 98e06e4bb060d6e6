"""Hashed word shingles of whole texts, and connected components of links."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine.llm.common import Scratch

#: Odd multipliers for the places of a shingle, as many as its words at most.
PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63,
                   0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit numbers."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def spread(x: np.ndarray) -> np.ndarray:
    """A cheaper bijection, for numbers that are mixed already."""
    return (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but ASCII white space, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingles(text: str | None, k: int = 5) -> np.ndarray:
    """64-bit hashes of the text's k-word shingles in order; a shorter text is one shingle, no words are none."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = mixed(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)))
    n = max(1, len(h) - k + 1)
    if len(h) < k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):  # multilinear in the mixed word hashes
        out += h[i: i + n] * PLACES[i]
    return mixed(out)


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b): the smallest node it is connected with.

    Large star and small star in turn: each node's larger neighbours, then its smaller ones, are linked
    to the smallest of them, until nothing changes.  Every step is joins and grouped minima; a hub's
    links stay spread over rows.
    """
    edges = scratch.save(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003)).first()

    was = state(edges)
    while was[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = scratch.save(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = scratch.save(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        scratch.drop(edges, large)
        edges, now = after, state(after)
        if now == was:
            break
        was = now
    least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    found = scratch.save(least.unionByName(roots).groupBy("node").agg(F.min("component").alias("component")))
    scratch.drop(edges)
    return found
