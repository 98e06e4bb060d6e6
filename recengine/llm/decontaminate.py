"""Benchmark decontamination by spaced-seed hashing, in SQL functions alone.

Words are runs of letters and digits, lower-cased.  At each word a fixed mask picks some of the next
words and ignores the others, and the picked ones are hashed; so a substituted word spoils only the
seeds that pick it.  The masks leave a seed for every two substitutions in ``window`` words; items of
fewer words have masks of their own length that leave one for every allowed substitution.  Equal seeds of a document and a benchmark item give a diagonal (document position
minus item position).  Along each diagonal the words are compared one by one: an item is found where
some stretch of ``window`` words (the whole item, if it has fewer) agrees in at least ``agree`` of its
places.  Verification compares words, so equal hashes of different words do no harm.

The seeds of the benchmark are broadcast if they are at most ``BROADCAST_SEEDS`` (counted first) and
joined by a shuffle otherwise.  A document's seeds, its diagonals and what is found go by a hash of its whole text, so
copies are looked up once and rows without an id are rows of their own; equal hashes of different
texts cost a comparison and lose nothing.

Defined cases: null and empty texts and items of fewer than ``least_words`` words (by default as many as the
shortest mask spans) are never found; rows of equal id and text are reported once, those of equal id and other
text for themselves; equal stretches are reported at the first; repeated items are reported by id, items
without an id with a null id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recengine.llm.common import Scratch

#: Fixed masks: 1 picks the word, 0 ignores it.
MASKS = ("1111011", "111001011")
#: Seeds that may be broadcast; a seed has three numbers.
BROADCAST_SEEDS = 1_000_000
WINDOW, AGREE = 13, 0.8


def word_codes(text: Column) -> Column:
    """A 64-bit code for each word."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def short_masks(n: int, agree: float = AGREE) -> tuple[str, ...]:
    """Masks for items of n words: all but as many blocks as words may differ, so that some mask picks none of those."""
    misses = n - math.ceil(n * agree - 1e-9)
    cuts = [n * i // (misses + 2) for i in range(misses + 3)] if n > misses + 1 else list(range(n + 1))
    out = {}
    for left_out in combinations(range(len(cuts) - 1), misses):
        picks = "".join(("0" if i in left_out else "1") * (cuts[i + 1] - cuts[i]) for i in range(len(cuts) - 1))
        out[picks.strip("0")] = None
    return tuple(m for m in out if m)


def seeds(codes: str, masks: tuple[str, ...]) -> Column:
    """array<struct<seed, at>> of all masks over the array column ``codes``, which must be a plain column."""
    def of(mask: str) -> Column:
        picked = [i for i, c in enumerate(mask) if c == "1"]
        last = F.size(codes) - len(mask)
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(
            F.xxhash64(F.lit(int(mask, 2)), *(F.get(F.col(codes), i + p) for p in picked)).alias("seed"), i.alias("at"))))

    none = F.array().cast("array<struct<seed:bigint,at:int>>")
    return F.concat(*(F.coalesce(of(mask), none) for mask in masks))


def find_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
               item_text: str = "text", masks: tuple[str, ...] = MASKS, window: int = WINDOW,
               agree: float = AGREE, least_words: int | None = None) -> DataFrame:
    """(key, item, item_words, equal_words, first_word, text_hash): one row for each document id, text and item found in it.

    ``first_word`` is where in the document the item (or the part of it that fits) would begin;
    ``equal_words`` counts the agreeing places along that diagonal.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    least = min(map(len, masks)) if least_words is None else max(1, least_words)
    items = scratch.save(benchmark.select(F.col(item).alias("item"), word_codes(F.col(item_text)).alias("item_codes"))
                         .where(F.size("item_codes") >= least).distinct())
    # Masks by the items' lengths: those of fewer words than the window (so a few lengths at most) have their own.
    lengths = [r["n"] for r in items.select(F.least(F.size("item_codes"), F.lit(window)).alias("n")).distinct().orderBy("n").collect()]
    of_length = {n: short_masks(n, agree) if n < window else masks for n in lengths}
    own = F.array().cast("array<struct<seed:bigint,at:int>>")
    for n, some in of_length.items():
        own = F.when(F.least(F.size("item_codes"), F.lit(window)) == n, seeds("item_codes", some)).otherwise(own)
    marks = scratch.save(items.select("item", F.explode(own).alias("s"))
                         .select("item", "s.seed", F.col("s.at").alias("item_at")).distinct())
    masks = tuple(dict.fromkeys(m for some in of_length.values() for m in some)) or masks
    small = marks.count() <= BROADCAST_SEEDS
    words = docs.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("look"), word_codes(F.col(text)).alias("codes"))
    hits = (words.select("look", F.explode(seeds("codes", masks)).alias("s")).select("look", "s.seed", "s.at")
            .join(F.broadcast(marks) if small else marks, "seed")
            .select("look", "item", (F.col("at") - F.col("item_at")).alias("shift")).distinct())
    hits = scratch.save(hits)

    # Along the diagonal: equal[j] says whether word j of the item is word shift + j of the document.
    near = (words.join(hits, "look")
            .join(items.withColumnRenamed("item", "_item"), F.col("item").eqNullSafe(F.col("_item"))).where(F.size("codes") > 0))
    same = F.transform("item_codes", lambda c, j: F.when(
        F.col("shift") + j >= 0, F.get("codes", F.col("shift") + j) == c).otherwise(F.lit(False)))
    near = near.select("key", "look", "item", "shift", F.transform(same, lambda e: F.coalesce(e, F.lit(False)).cast("int")).alias("equal"))
    n = F.size("equal")
    size = F.least(n, F.lit(window))
    need = F.ceil(size * F.lit(agree) - F.lit(1e-9))
    best = F.array_max(F.transform(F.sequence(F.lit(1), n - size + 1), lambda a: F.aggregate(
        F.slice("equal", a, size), F.lit(0), lambda s, e: s + e)))
    total = F.aggregate("equal", F.lit(0), lambda s, e: s + e)
    found = near.select("key", "look", "item", "shift", n.alias("item_words"), total.alias("equal_words"), best.alias("best"), need.alias("need"))
    found = found.where(F.col("best") >= F.col("need")).groupBy("key", "look", "item").agg(F.max(F.struct(
        "equal_words", (-F.col("shift")).alias("back"), "item_words")).alias("m"))
    return found.select(F.col("key").alias(key), F.col("item").alias(item), F.col("m.item_words").alias("item_words"),
                        F.col("m.equal_words").alias("equal_words"), F.greatest(F.lit(0), -F.col("m.back")).alias("first_word"),
                        F.col("look").alias("text_hash"))


def without_leaks(docs: DataFrame, leaks: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` in whose text no item was found; ``leaks`` is what ``find_leaks`` gave for them."""
    scratch = Scratch(docs.sparkSession, "leaks")
    found = scratch.save(leaks.select(F.col(key).alias("leak"), "text_hash").distinct())
    few = found.limit(BROADCAST_SEEDS + 1).count() <= BROADCAST_SEEDS
    same = docs[key].eqNullSafe(found["leak"]) & (F.xxhash64(docs[text]) == found["text_hash"])
    return docs.join(F.broadcast(found) if few else found, same, "left_anti")
