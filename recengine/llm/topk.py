"""Exact top-k search by distributed histogram selection.

Vectors and queries are packed into blocks, and every query block meets every vector block: a stated
query set against all rows.  A round scores everything and puts the scores of each query's current
interval into equal bins.  A block reports only its bins from the top down to the one that holds its
own k-th score, which loses nothing, since the k-th score over all blocks is no lower.  The summed
histogram places the k-th value in one bin, which is the next round's interval, until a bin holds a
single score.  A last round keeps what reaches that value and breaks ties by the smaller id.

Scores are integer inner products of components floor(scale * x), x as double.  They are exact: the
products run in double precision where every sum is below 2**53 and in Python integers beyond.  A score
beyond 62 bits counts as the largest (or least) number of 62 bits; such scores are ties.

Query blocks are broadcast.  More than ``BROADCAST_BYTES`` of them are cut into slices of about that size, which are
searched one after the other, so what a task holds does not grow with the queries and no key joins all blocks.

Defined cases: vectors that are null, empty or hold null or non-finite components, and rows without
an id take no part, nor do those not finite once scaled; vectors of different lengths have no score; a query never meets its own row, but
meets other rows of the same id; an empty table gives an empty result; columns other than id and
vector are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recengine.llm.common import Scratch
from recengine.llm.vector_codes import from_bytes, to_bytes

#: Rows of a vector block and of a query block; bits that one round's histogram adds.
VECTOR_BLOCK, QUERY_BLOCK, ROUND_BITS = 4096, 512, 11
#: Bytes of query blocks that are broadcast at a time, about.
BROADCAST_BYTES = 32 << 20
EXACT_DOUBLE, REACH = 2 ** 53, 2 ** 62 - 1

PACKED = "dim int, n int, ids binary, rows binary, data binary, top double, squares double"


def packed(vectors: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` rows of (row, id, v); components are integers, held as few bytes each as they need."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            lengths = b["v"].map(len)
            for dim, own in b.groupby(lengths, sort=False):
                for at in range(0, len(own), size):
                    part = own.iloc[at: at + size]
                    data = np.stack(part["v"].to_numpy()).astype("float64")
                    top, squares = float(np.abs(data).max()), float((data * data).sum(axis=1).max())
                    if top >= EXACT_DOUBLE:
                        data = np.array([[int(y) for y in x] for x in data], object)
                    yield pd.DataFrame([{
                        "dim": int(dim), "n": len(part), "ids": part["id"].to_numpy("int64").tobytes(),
                        "rows": part["row"].to_numpy("int64").tobytes(), "data": to_bytes(data), "top": top, "squares": squares}])

    return vectors.mapInPandas(pack, PACKED)


def block(r, prefix: str = "") -> np.ndarray:
    return from_bytes(getattr(r, prefix + "data")).reshape(getattr(r, prefix + "n"), r.dim)


def numbers(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "int64")


def scored(r) -> np.ndarray:
    """Scores of a joined row: queries down, vectors across; a query's own row gets the lowest number."""
    q, v = block(r, "q_"), block(r)
    if r.top * r.q_top * r.dim < EXACT_DOUBLE:
        s = (q.astype("float64") @ v.astype("float64").T).astype("int64")
    else:
        exact = q.astype(object) @ v.astype(object).T
        s = np.clip(exact, -REACH, REACH).astype("int64")
    s[numbers(r.q_rows)[:, None] == numbers(r.rows)[None, :]] = np.iinfo("int64").min
    return s


def counted(k: int):
    """Per joined row: for each query, the filled bins of its interval down to the k-th score of this block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                s, rows = scored(r), numbers(r.q_rows)
                low, bits = np.asarray(r.low), int(r.bits)
                bins = np.where(s == np.iinfo("int64").min, -1, (s - low[:, None]) >> bits)
                out = []
                for i in range(len(rows)):
                    own = bins[i][(bins[i] >= 0)]
                    own = own[own < (1 << ROUND_BITS)]  # what is above counts in r.above
                    values, n = np.unique(own, return_counts=True)
                    reached = np.cumsum(n[::-1])[::-1]
                    use = np.concatenate([reached[1:], [0]]) < k if len(n) else np.zeros(0, bool)
                    out.append(pd.DataFrame({"query": rows[i], "bin": values[use], "n": n[use]}))
                yield pd.concat(out) if out else pd.DataFrame({"query": [], "bin": [], "n": []}, dtype="int64")

    return run


def kept(k: int):
    """Per joined row: scores above each query's k-th value, and the k smallest ids that equal it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                s, q_rows, q_ids = scored(r), numbers(r.q_rows), numbers(r.q_ids)
                ids, low, out = numbers(r.ids), np.asarray(r.low), []
                for i in range(len(q_rows)):
                    at = np.flatnonzero((s[i] >= low[i]) & (s[i] != np.iinfo("int64").min))
                    at = at[np.lexsort((ids[at], -s[i][at]))][:k]
                    out.append(pd.DataFrame({"query": q_rows[i], "query_id": q_ids[i], "vec_id": ids[at], "score": s[i][at]}))
                yield pd.concat(out)

    return run


def integer_vectors(df: DataFrame, id_col: str, vector: str, scale: float) -> DataFrame:
    """(id, v) of the rows that take part; v has doubles with integer values."""
    x = F.transform(F.col("x"), lambda e: e.cast("double") * scale)
    # Beyond 2**53 a double is whole already; floor() would cut it to 64 bits.
    whole = F.transform("x", lambda e: F.when(F.abs(e) < EXACT_DOUBLE, F.floor(e).cast("double")).otherwise(e))
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return (df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).alias("x"))
            .where(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)).withColumn("x", x).where(fine)
            .select("id", whole.alias("v")))


def top_k(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector: str = "embedding",
          scale: float = 1024.0) -> DataFrame:
    """The k highest scores of each query row against all other rows: query_id, rank, vec_id, score.

    ``is_query`` is a condition on the column ``id``.
    """
    scratch = Scratch(df.sparkSession, "topk")
    rows = scratch.save(integer_vectors(df, id_col, vector, scale).withColumn("row", F.monotonically_increasing_id()))
    blocks = scratch.save(packed(rows, VECTOR_BLOCK))
    asked = scratch.save(packed(rows.where(is_query).repartition(F.pmod("row", F.lit(64))), QUERY_BLOCK)
                         .withColumn("block", F.monotonically_increasing_id()))
    scratch.drop(rows)
    size = asked.agg(F.sum(F.length("data") + F.length("rows") * 3)).first()[0] or 0
    slices = max(1, -(-size // BROADCAST_BYTES))
    out = None
    for i in range(slices):
        found = selected(scratch, blocks, asked.where(F.pmod(F.xxhash64("block"), F.lit(slices)) == i), k)
        found = found if slices == 1 else scratch.save(found)
        out = found if out is None else out.unionByName(found)
    return out


def selected(scratch: Scratch, blocks: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The search of one slice of query blocks, which is broadcast."""
    # All scores are within the product of the largest norms (Cauchy and Schwarz).
    squares = [x.agg(F.max("squares")).first()[0] or 0.0 for x in (blocks, asked)]
    reach = min(REACH - 2, int(min(1e19, squares[0] ** 0.5 * squares[1] ** 0.5))) + 2
    bits = max(0, (2 * reach).bit_length() - ROUND_BITS)
    state = asked.select("block", F.transform(F.sequence(F.lit(1), "n"), lambda _: F.lit(-reach).cast("long")).alias("low"))

    def met(state: DataFrame, bits: int) -> DataFrame:
        q = asked.join(state, "block").select(
            "dim", "low", F.lit(bits).alias("bits"), *(F.col(c).alias(f"q_{c}") for c in ("n", "ids", "rows", "data", "top")))
        return blocks.join(F.broadcast(q), "dim")

    place = asked.select("block", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: i)).alias("at", "i"))
    where = scratch.save(rows_of(asked).join(place.drop("i"), ["block", "at"]))
    above = None
    while True:
        hist = met(state, bits).mapInPandas(counted(k), "query long, bin long, n long").groupBy("query", "bin").agg(F.sum("n").alias("n"))
        if above is not None:
            hist = hist.join(above, "query", "left")
        else:
            hist = hist.withColumn("above", F.lit(0).cast("long"))
        down = Window.partitionBy("query").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, 0)
        reached = hist.withColumn("sum", F.sum("n").over(down) + F.col("above"))
        found = (reached.where((F.col("sum") >= k) & (F.col("sum") - F.col("n") < k))
                 .select("query", F.col("bin").alias("found"), (F.col("sum") - F.col("n")).alias("above")))
        lows = where.join(state.select("block", F.posexplode("low").alias("at", "was")), ["block", "at"]).join(found, "query", "left")
        step = 1 << bits
        lows = scratch.save(lows.select("block", "at", "query", F.coalesce("above", F.lit(0)).cast("long").alias("above"),
                                        (F.col("was") + F.coalesce("found", F.lit(0)) * F.lit(step)).alias("low")))
        above = lows.select("query", "above")
        state = lows.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "low"))).alias("x")).select(
            "block", F.col("x.low").alias("low"))
        if bits == 0:
            break
        bits = max(0, bits - ROUND_BITS)

    near = met(state, 0).mapInPandas(kept(k), "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def rows_of(asked: DataFrame) -> DataFrame:
    """(block, at, query): the row number of each query and its place in its block."""

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for r in b.itertuples():
                rows = numbers(r.rows)
                yield pd.DataFrame({"block": r.block, "at": np.arange(len(rows), dtype="int32"), "query": rows})

    return asked.select("block", "rows").mapInPandas(unpack, "block long, at int, query long")
