"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Targets: sources by code point, null last, take the weights in turn and share ``share`` times all
words; no source gets more than ``cap`` times its own words, and what is above that is shared again
by weight among the others until nobody is above.  All arithmetic on targets is in integers.

Schedule: a source with target T has ceil(T / block) cells of a row of N cells, side by side, so the
cells are its cumulative weight.  Slot t of the schedule falls on cell (t * g) mod N, where g is the
number next to N / golden ratio that has no common factor with N: golden-ratio points at resolution
1 / N that meet every cell once.  Any stretch of slots thus holds the sources in proportion, and every
source gets all of its slots.  Slots are ranked per source; a source's documents, shuffled by a hash
of seed and id and repeated ``cap`` times, are cut into blocks of equal words; slot number r of a
source takes its block r.  The last block of a source ends at its target.  A row gets the first slot that
serves words of it and the number of its pieces in slots, so a reader can deal the mix out in the
schedule's order.

Every rank and running sum is made in two levels (chunk, then row within chunk), so a source with a
third of all rows is spread over all tasks.

Defined cases: null text has no words; null is a source of its own; a table without words has targets
0; ties in the shuffle (repeated ids) are ordered by size and are interchangeable beyond that;
repeated rows are rows of their own; an empty table gives an empty table; other columns pass, and
result columns replace input columns of the same name.
"""

from __future__ import annotations

from fractions import Fraction
from math import gcd

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recengine.llm.common import WORD, Scratch, fresh_name

WEIGHTS = (5, 2, 1)
#: Rows a chunk of a running sum has about.
CHUNK = 4096
BIG = "decimal(38,0)"


def words_in(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def running(df: DataFrame, group: str, chunk: str, order: list, value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over the rows before this one in its group; ``chunk`` must not fall along the order."""
    before = (Window.unboundedPreceding, -1)
    offsets = (df.groupBy(group, chunk).agg(F.sum(value).alias("_s"))
               .withColumn("_o", F.sum("_s").over(Window.partitionBy(group).orderBy(chunk).rowsBetween(*before)))
               .drop("_s"))
    own = F.sum(value).over(Window.partitionBy(group, chunk).orderBy(*order).rowsBetween(*before))
    return (df.withColumn("_i", own).join(offsets, [group, chunk])
            .withColumn(out, F.coalesce("_i", F.lit(0)) + F.coalesce("_o", F.lit(0))).drop("_i", "_o"))


def ranked_sources(scratch: Scratch, sizes: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """(source, source_size, sid, weight): sid is the place by code point, null last."""
    s = scratch.save(sizes.orderBy(F.asc_nulls_last("source")).withColumn("_m", F.monotonically_increasing_id()))
    s = s.withColumn("_p", F.shiftright("_m", 33)).withColumn("_k", F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
    starts = (s.groupBy("_p").agg(F.count("*").alias("_n"))  # a row for each partition of the sort
              .withColumn("_at", F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1))))
    place = F.col("_k") + F.coalesce("_at", F.lit(0))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    return (s.join(starts.drop("_n"), "_p").withColumn("sid", place).withColumn("weight", weight)
            .select("source", "source_size", "sid", "weight"))


def with_targets(sources: DataFrame, share: Fraction, cap: int) -> DataFrame:
    """Append target and quota, its nearest whole number of words."""
    num, den = share.numerator, share.denominator
    total = int(sources.agg(F.sum("source_size")).first()[0] or 0)
    size, weight = F.col("source_size").cast(BIG), F.col("weight").cast(BIG)

    def big(x: int) -> Column:
        return F.lit(str(x)).cast(BIG)

    capped, was = F.lit(False), -1
    while True:  # each round caps at least one more source, or ends; a round is one small aggregate
        n, held, free = sources.agg(F.sum(capped.cast("long")), F.sum(F.when(capped, size)),
                                    F.sum(F.when(~capped, weight))).first()
        n, held, free = n or 0, int(held or 0), int(free or 0)
        rest = num * total - den * cap * held  # what the others share, times den
        if n == was:
            break
        was, capped = n, capped | (big(rest) * weight > big(cap * den) * size * big(free))
    open_target = weight.cast("double") * F.lit(float(rest)) / F.lit(float(den * max(free, 1)))
    return (sources.withColumn("target", F.when(capped, (size * cap).cast("double")).otherwise(open_target))
            .withColumn("quota", F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * cap).cast("long")))


def schedule(scratch: Scratch, sources: DataFrame, block: int) -> DataFrame:
    """(t, sid, rank): slot t takes block ``rank`` of source ``sid``."""
    spark = sources.sparkSession
    cells = F.ceil(F.col("quota") / block).cast("long")
    # Cells side by side: start of each source's stretch; chunks of sources in order of sid.
    cum = running(sources.where(F.col("quota") > 0).withColumn("_g", F.lit(0)).withColumn("cells", cells)
                  .withColumn("_c", F.floor(F.col("sid") / CHUNK)), "_g", "_c", ["sid"], F.col("cells"), "cell0")
    cum = scratch.save(cum.select("sid", "cells", "cell0"))
    n = int(cum.agg(F.sum("cells")).first()[0] or 0)
    step = max(1, round(n * (5 ** 0.5 - 1) / 2))
    while n and gcd(step, n) != 1:
        step += 1
    # A source's stretch is put out in two steps, so that no task writes a hot source's cells alone.
    parts = (cum.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("cells") - 1) / 65536))))
             .repartition("sid", "part"))
    cell = parts.select("sid", F.explode(F.sequence(F.col("cell0") + F.col("part") * 65536, F.least(
        F.col("cell0") + F.col("cells"), F.col("cell0") + (F.col("part") + 1) * 65536) - 1)).alias("cell"))
    at = (F.col("t").cast(BIG) * F.lit(str(step)).cast(BIG)) % F.lit(str(max(n, 1))).cast(BIG)
    slots = spark.range(n).withColumnRenamed("id", "t").withColumn("cell", at.cast("long")).join(cell, "cell")
    slots = slots.withColumn("_c", F.floor(F.col("t") / CHUNK))
    return running(slots, "sid", "_c", ["t"], F.lit(1).cast("long"), "rank").select("t", "sid", "rank")


def mix(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", share: Fraction = Fraction(3, 2),
        cap: int = 2, weights: tuple[int, ...] = WEIGHTS, block: int = 4096, seed: str = "mix") -> DataFrame:
    """Append size, source_size, target, taken (the words that the mix takes of each row, repeats counted), first_slot (the
    first slot of the schedule with words of the row, null if none) and slots (its pieces in slots)."""
    scratch = Scratch(df.sparkSession, "mix")
    results = ("size", "source_size", "target", "taken", "first_slot", "slots")
    key = fresh_name(df, "_row")
    rows = df.select(*(c for c in df.columns if c.lower() not in results or c in (doc_id, source) or c == text))
    kept = [c for c in rows.columns if c != text and c.lower() not in results]
    rows = scratch.save(rows.withColumns({"size": words_in(F.col(text))}).select(
        *kept, "size").withColumn(key, F.monotonically_increasing_id()))
    own = rows.select(F.col(key).alias("_row"), F.col(source).alias("source"), "size",
                      F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary")).alias("h"))
    sources = scratch.save(with_targets(ranked_sources(scratch, own.groupBy("source").agg(
        F.sum("size").alias("source_size")), weights), share, cap))

    bits = max(0, (rows.count() // CHUNK).bit_length())
    first = F.conv(F.substring("h", 1, 8), 16, 10).cast("long")
    own = own.join(sources, own["source"].eqNullSafe(sources["source"])).drop("source")
    own = own.withColumn("_c", F.shiftright(first, 32 - bits))
    own = scratch.save(running(own, "sid", "_c", ["h", "size", "_row"], F.col("size"), "at")
                       .select("_row", "sid", "size", "source_size", "target", "quota", "at"))

    # Pieces: where the document's words lie in the blocks of each pass over its source, below the quota.
    piece = (own.where(F.col("size") > 0).withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(cap - 1))))
             .withColumn("a", F.col("pass") * F.col("source_size") + F.col("at"))
             .withColumn("b", F.least(F.col("a") + F.col("size"), "quota")).where(F.col("a") < F.col("b"))
             .withColumn("rank", F.explode(F.sequence(F.floor(F.col("a") / block), F.floor((F.col("b") - 1) / block))))
             .select("_row", "sid", "rank", (F.least("b", (F.col("rank") + 1) * block) - F.greatest(
                 "a", F.col("rank") * block)).alias("words")))
    taken = piece.join(schedule(scratch, sources, block), ["sid", "rank"]).groupBy("_row").agg(
        F.sum("words").alias("taken"), F.min("t").alias("first_slot"), F.count("*").alias("slots"))
    out = own.select("_row", "source_size", "target").join(taken, "_row", "left").withColumnRenamed("_row", key)
    return rows.join(out, key).select(*kept, "size", "source_size", "target",
                                      F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot",
                                      F.coalesce("slots", F.lit(0)).cast("long").alias("slots"))
