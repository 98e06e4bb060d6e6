"""Exact deduplication with a split of frequent digests from the rest.

1. Every text gets its SHA-256 digest, its length in bytes and a second 64-bit hash; together they stand
   for the text.  Rows of these few numbers are written once; the texts themselves are never shuffled.
2. Misra-Gries: each task keeps a bounded number of counters and lowers them together when they run out.
   Summed over tasks, a digest of at least ``share`` of all rows keeps a sum of at least share / 2 of them,
   so at most 2 / share candidates go on, and no frequent digest is missed.
3. Candidates are verified by an exact count over all rows, combined in the tasks that read them.  Those
   that do hold ``share`` of the rows are frequent; their winners (largest key) are broadcast, at most
   1 / share of them, and settle their rows where they are read.
4. The remaining digests, each with fewer rows than that, go through an ordinary grouping by digest and a
   join with the groups of two rows or more.

Of equal texts the row with the largest key stays; a null key is less than any other, and of several rows
with that key one stays (the last in reading order).

Defined cases: a null text counts as the empty text; rows with a null key take part, and a group of only
such rows has a null keep id; repeated rows are copies of each other; an empty table gives an empty table;
other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recengine.llm.common import Scratch, fresh_name

#: A digest of at least this share of all rows is frequent.
SHARE = 1 / 1024
#: Groups of copies that ``without_copies`` broadcasts at most (about 60 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 500_000
IDENTITY = ["digest", "bytes", "second"]


def identity(text: Column) -> list[Column]:
    """The columns that stand for a text."""
    raw = F.coalesce(text.cast("string"), F.lit("")).cast("binary")
    return [F.unhex(F.sha2(raw, 256)).alias("digest"), F.length(raw).alias("bytes"), F.xxhash64(raw).alias("second")]


def lowered(counters: dict[bytes, int], most: int) -> dict[bytes, int]:
    """The Misra-Gries step: with more than ``most`` counters, all are lowered by the first that has no room."""
    if len(counters) <= most:
        return counters
    by = sorted(counters.values(), reverse=True)[most]
    return {k: n - by for k, n in counters.items() if n > by}


def frequent_candidates(digests: DataFrame, rows: int, share: float) -> DataFrame:
    """(digest): every digest of at least ``share`` of the rows is among them; 2 / share at most."""
    most = int(2 / share)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters: dict[bytes, int] = {}
        for b in batches:
            for k, n in b["digest"].value_counts().items():
                counters[k] = counters.get(k, 0) + n
            counters = lowered(counters, most)
        yield pd.DataFrame({"digest": list(counters), "n": list(counters.values())})

    summed = digests.select("digest").mapInPandas(count, "digest binary, n long").groupBy("digest").agg(F.sum("n").alias("n"))
    return summed.where(F.col("n") >= max(2, int(rows * share / 2))).select("digest")


def groups_of(rows: DataFrame) -> DataFrame:
    """One row for each text: the winner (key, row), the rows, and the rows that have the winner's key."""
    return rows.groupBy(*IDENTITY).agg(F.max(F.struct("key", "row")).alias("winner"), F.count("*").alias("size"))


class Dedup:
    """One run over (key, digest, bytes, second, row); groups are those of two rows or more."""

    def __init__(self, df: DataFrame, key: str, text: str, share: float = SHARE):
        self.scratch = Scratch(df.sparkSession, "exact_dedup")
        scan = df.select(F.col(key).alias("key"), *identity(F.col(text))).withColumn("row", F.monotonically_increasing_id())
        self.rows = self.scratch.save(scan)
        n = self.rows.count()
        candidates = self.scratch.save(frequent_candidates(self.rows, n, share))
        exact = groups_of(self.rows.join(F.broadcast(candidates), "digest"))
        self.frequent = self.scratch.save(exact.where(F.col("size") >= max(2, int(n * share))))
        self.scratch.drop(candidates)

    def split(self) -> tuple[DataFrame, DataFrame]:
        """(rows of frequent texts with their group, the other rows)."""
        few = F.broadcast(self.frequent)
        return self.rows.join(few, IDENTITY), self.rows.join(few, IDENTITY, "left_anti")

    def annotated(self) -> DataFrame:
        hot, rest = self.split()
        copies = groups_of(rest).where("size > 1")
        both = hot.unionByName(rest.join(copies, IDENTITY, "left"), allowMissingColumns=True)
        return both.withColumns({"winner": F.coalesce("winner", F.struct("key", "row")), "size": F.coalesce("size", F.lit(1).cast("long"))})

    def copies(self) -> DataFrame:
        _, rest = self.split()
        return self.frequent.unionByName(groups_of(rest).where("size > 1"))


def exact_copies(df: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "keep_id", size: str = "group_size",
                 kept: str = "kept", digest: str = "text_sha256", share: float = SHARE) -> DataFrame:
    """(key, keep, size, kept, digest): a row for each input row, dropped ones too."""
    rows = Dedup(df, key, text, share).annotated()
    return rows.select(F.col("key").alias(key), F.col("winner.key").alias(keep), F.col("size").alias(size),
                       (F.col("row") == F.col("winner.row")).alias(kept), F.lower(F.hex("digest")).alias(digest))


def without_copies(df: DataFrame, key: str = "doc_id", text: str = "text", share: float = SHARE) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    run = Dedup(df, key, text, share)
    copies = run.copies().select(*IDENTITY, F.col("winner.key").alias("winner_key"))
    twice = (run.rows.join(run.frequent, IDENTITY, "left_anti").groupBy(*IDENTITY, "key").count()
             .unionByName(run.rows.join(F.broadcast(run.frequent), IDENTITY, "left_semi").groupBy(*IDENTITY, "key").count())
             .where("count > 1").select(*IDENTITY, F.col("key").alias("winner_key"), F.lit(True).alias("twice")))
    same = [F.col(f"c.{c}") == F.col(f"t.{c}") for c in IDENTITY] + [F.col("c.winner_key").eqNullSafe(F.col("t.winner_key"))]
    copies = copies.alias("c").join(twice.alias("t"), same, "left").select(
        *(F.col(f"c.{c}") for c in (*IDENTITY, "winner_key")), F.coalesce("t.twice", F.lit(False)).alias("twice"))
    copies = run.scratch.save(copies)
    few = copies.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    names = [fresh_name(df, f"_{c}") for c in IDENTITY]
    own = df.withColumns(dict(zip(names, identity(F.col(text)), strict=True)))
    right = (F.broadcast(copies) if few else copies).alias("g")
    met = own.alias("d").join(right, [F.col(f"d.{n}") == F.col(f"g.{c}") for n, c in zip(names, IDENTITY, strict=True)], "left")
    stay = met.where(F.col("g.digest").isNull() | F.col(f"d.{key}").eqNullSafe(F.col("g.winner_key")))
    once = stay.where(~F.coalesce("g.twice", F.lit(False))).select("d.*")
    again = stay.where("g.twice").select("d.*").dropDuplicates([key, *names])
    return once.unionByName(again).drop(*names)
