"""Vector code compression: product codebooks trained by active-entry Lloyd rounds, in whole numbers.

Components become floor(scale * x), x as double.  Vectors are cut into equal consecutive parts, and each part
position has a codebook that starts as that part of the first vectors by id.  A round assigns every part to
the nearest entry (squared Euclidean distance, ties to the lower index) and replaces each entry by the floor of
its parts' mean; unused entries stay.  After the last round parts are assigned again.

Vectors lie in blocks, each a row with its numbers, its codes and the exact distance to each assigned entry.
Between two assignments some entries move and some stay.  A part whose entry stayed has already beaten all
other entries that stayed, so it is compared with the moved ones only; the stored distance stands for its own.
A part whose entry moved is compared with all.  Both give what a full scan gives, ties included.

The blocks after each assignment are written below spark.checkpoint.dir, so a lost executor costs the running
stage only.  Each task adds up its own sums for every entry; only those are shuffled, and the codebooks
(parts x entries x width numbers) are what the driver holds and broadcasts.

Distances are exact: double precision where every intermediate value is below 2**53, Python integers beyond.

Defined cases: vectors that are null, empty or hold null or non-finite components (also: not finite once scaled)
take no part; so do vectors of another length than most have (the smaller length on a tie) or of a length that
the parts do not divide.  With fewer vectors than entries the codebooks are as short.  Rows without an id take
part and come last in the order of ids; equal ids are ordered by their numbers.  Sums of errors beyond 64 bits
end at the largest long.  An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine.llm.common import Scratch

#: Vectors of a block; labels that are broadcast at most (more are joined by a shuffle).
BLOCK, BROADCAST_ROWS = 4096, 500_000
EXACT_DOUBLE, LONG = 2 ** 53, 2 ** 63 - 1
STATE = "n int, ids array<string>, labels array<string>, data binary, codes binary, far binary"


def to_bytes(x: np.ndarray) -> bytes:
    """Whole numbers as bytes, as few each as the largest needs; as text where one needs more than 8."""
    flat = x.ravel()
    top = max(abs(int(flat.max())), abs(int(flat.min()))) if len(flat) else 0
    for kind in ("i2", "i4", "i8"):
        if top < 1 << (8 * int(kind[1]) - 1):
            return kind[1].encode() + flat.astype(kind).tobytes()
    return b"," + ",".join(map(str, flat)).encode()


def from_bytes(raw: bytes) -> np.ndarray:
    if raw[:1] == b",":
        return np.array([int(x) for x in raw[1:].split(b",")], object)
    return np.frombuffer(raw, f"i{raw[:1].decode()}", offset=1).astype("int64")


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, rows of x down, entries across; exact."""
    top = max([int(abs(y).max()) for y in (x, entries) if y.size], default=0)
    if 4 * top * top * x.shape[1] < EXACT_DOUBLE:
        a, b = x.astype("float64"), entries.astype("float64")
        return ((a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]).astype("int64")
    a, b = x.astype(object), entries.astype(object)
    return ((a[:, None, :] - b[None, :, :]) ** 2).sum(axis=2)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, distance) of each row's nearest entry, the lower index on ties."""
    d = distances(x, entries)
    at = d.argmin(axis=1)
    return at, d[np.arange(len(x)), at]


def assigned(x: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray | None,
             far: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """New codes and distances of one part position; moved marks the entries that are not where they were."""
    if code is None:
        return nearest(x, entries)
    code, far = code.copy(), far.copy()
    scan = moved[code]
    if scan.any():
        at, d = nearest(x[scan], entries)
        if d.dtype == object:
            far = far.astype(object)
        code[scan], far[scan] = at, d
    some = np.flatnonzero(moved)
    rows = np.flatnonzero(~scan)
    if len(some) and len(rows):
        at, d = nearest(x[rows], entries[some])
        at = some[at]
        closer = (d < far[rows]) | ((d == far[rows]) & (at < code[rows]))
        if d.dtype == object:
            far = far.astype(object)
        code[rows[closer]], far[rows[closer]] = at[closer], d[closer]
    return code, far


def packed(vectors: DataFrame, dim: int) -> DataFrame:
    """Blocks without codes yet, of (id, label, v)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), BLOCK):
                own = b.iloc[at: at + BLOCK]
                data = np.stack(own["v"].to_numpy())
                if np.abs(data).max() >= 2 ** 62:
                    data = np.array([[int(y) for y in x] for x in data], object)
                yield pd.DataFrame([{"n": len(own), "ids": own["id"].to_list(), "labels": own["label"].to_list(),
                                     "data": to_bytes(data), "codes": None, "far": None}])

    return vectors.mapInPandas(run, STATE)


class Codes:
    """Codebooks (parts, entries, width) of whole numbers, and the blocks assigned to them."""

    def __init__(self, blocks: DataFrame, books: np.ndarray, scratch: Scratch):
        self.blocks, self.books, self.scratch = blocks, books, scratch
        self.moved = np.ones(books.shape[:2], bool)

    def assign(self) -> None:
        """Every part to its nearest entry; the blocks are written anew."""
        spark = self.blocks.sparkSession
        parts, _, width = self.books.shape
        shared = spark.sparkContext.broadcast((self.books, self.moved))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            books, moved = shared.value
            for b in batches:
                codes, fars = [], []
                for n, data, codes_was, far_was in zip(b["n"], b["data"], b["codes"], b["far"], strict=True):
                    x = from_bytes(data).reshape(n, parts, width)
                    was = codes_was is not None
                    c = np.frombuffer(codes_was, "int32").reshape(parts, n) if was else [None] * parts
                    f = from_bytes(far_was).reshape(parts, n) if was else [None] * parts
                    new = [assigned(x[:, p], books[p], moved[p], c[p], f[p]) for p in range(parts)]
                    codes.append(np.stack([y[0] for y in new]).astype("int32").tobytes())
                    fars.append(to_bytes(np.stack([y[1] for y in new])))
                yield b.assign(codes=codes, far=fars)

        after = self.scratch.save(self.blocks.mapInPandas(run, STATE))
        self.scratch.drop(self.blocks)
        self.blocks = after

    def update(self) -> None:
        """Entries become the floor of their parts' mean; each task adds up its own blocks first."""
        parts, entries, width = self.books.shape

        def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            many = np.zeros((parts, entries), np.int64)
            total = np.zeros((parts, entries, width), np.int64)
            reach = 0  # no sum is beyond this
            for b in batches:
                for n, data, codes in zip(b["n"], b["data"], b["codes"], strict=True):
                    x, c = from_bytes(data).reshape(n, parts, width), np.frombuffer(codes, "int32").reshape(parts, n)
                    reach += n * int(abs(x).max())
                    if reach > LONG:
                        x, total = x.astype(object), total.astype(object)
                    for p in range(parts):
                        many[p] += np.bincount(c[p], minlength=entries)
                        np.add.at(total[p], c[p], x[:, p])
            p, e = np.nonzero(many)
            yield pd.DataFrame({"part": p, "entry": e, "n": many[p, e], "total": [to_bytes(y) for y in total[p, e]]})

        def add(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            total = sum((from_bytes(y).astype(object) for y in rows["total"]), np.zeros(width, object))
            n = int(rows["n"].sum())
            return pd.DataFrame([(*key, to_bytes(np.array([y // n for y in total], object)))], columns=["part", "entry", "mean"])

        each = self.blocks.select("n", "data", "codes").mapInPandas(sums, "part int, entry int, n long, total binary")
        books = self.books.copy()
        for r in each.groupBy("part", "entry").applyInPandas(add, "part int, entry int, mean binary").collect():
            mean = from_bytes(r["mean"])
            if mean.dtype == object and books.dtype != object:
                books = books.astype(object)
            books[r["part"], r["entry"]] = mean
        self.moved = (books != self.books).any(axis=2)
        self.books = books

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.books.ravel())).encode()).hexdigest()


def whole_vectors(df: DataFrame, id_col: str, vector: str, label: str, scale: float, parts: int) -> tuple[DataFrame, int]:
    """(id, label, v) of the vectors that take part, and their length (0 if there is none)."""
    x = F.transform(F.col(vector), lambda e: e.cast("double") * scale)
    # Beyond 2**53 a double is whole already; floor() would cut it to 64 bits.
    whole = F.transform("x", lambda e: F.when(F.abs(e) < EXACT_DOUBLE, F.floor(e).cast("double")).otherwise(e))
    fine = F.forall("x", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = (df.select(F.col(id_col).alias("id"), F.col(label).cast("string").alias("label"), x.alias("x"))
            .where(F.col("x").isNotNull() & (F.size("x") > 0) & (F.size("x") % parts == 0)).where(fine)
            .select("id", "label", whole.alias("v")))
    most = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    dim = most["dim"] if most else 0
    return rows.where(F.size("v") == dim), dim


def train(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4,
          entries: int = 256, rounds: int = 4, scale: float = 1024.0) -> Codes | None:
    """Codebooks after ``rounds`` rounds and the blocks assigned to them; None if no vector takes part."""
    scratch = Scratch(df.sparkSession, "vector_codes")
    rows, dim = whole_vectors(df, id_col, vector, label, scale, parts)
    if not dim:
        return None
    first = rows.orderBy(F.col("id").isNull(), "id", "v").limit(entries).select("v").collect()
    books = np.array([[int(y) for y in r["v"]] for r in first], object).reshape(len(first), parts, dim // parts).transpose(1, 0, 2)
    if max(abs(int(books.max())), abs(int(books.min()))) < 2 ** 62:
        books = books.astype("int64")
    blocks = scratch.save(packed(rows.select(F.col("id").cast("string").alias("id"), "label", "v"), dim))
    run = Codes(blocks, np.ascontiguousarray(books), scratch)
    for _ in range(rounds):
        run.assign()
        run.update()
    run.assign()
    return run


def coded(run: Codes) -> DataFrame:
    """(id as text, label as text, code, error) of every vector that takes part."""
    parts = run.books.shape[0]
    digits = max(2, (run.books.shape[1] - 1).bit_length() + 3 >> 2)

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for n, ids, labels, codes, far in zip(b["n"], b["ids"], b["labels"], b["codes"], b["far"], strict=True):
                c = np.frombuffer(codes, "int32").reshape(parts, n)
                error = from_bytes(far).reshape(parts, n).astype(object).sum(axis=0)
                yield pd.DataFrame({"id": ids, "label": labels, "code": ["".join(f"{y:0{digits}x}" for y in x) for x in c.T],
                                    "error": [min(int(y), LONG) for y in error]})

    return run.blocks.select("n", "ids", "labels", "codes", "far").mapInPandas(
        unpack, "id string, label string, code string, error long")


def vector_codes(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4,
                 entries: int = 256, rounds: int = 4, scale: float = 1024.0) -> DataFrame:
    """id, code, error, label_error, codebooks_sha256: a row for every vector that takes part."""
    kind = df.schema[id_col].dataType
    run = train(df, id_col, vector, label, parts, entries, rounds, scale)
    if run is None:
        return df.limit(0).select(F.col(id_col), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                                  F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    rows = run.scratch.save(coded(run))
    run.scratch.drop(run.blocks)
    same = F.coalesce(F.concat(F.lit("="), "label"), F.lit(""))  # nulls together
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")
    sums = run.scratch.save(rows.groupBy(same.alias("same")).agg(total.alias("label_error")))
    if sums.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        sums = F.broadcast(sums)
    return rows.withColumn("same", same).join(sums, "same").select(
        F.col("id").cast(kind).alias(id_col), "code", "error", "label_error", F.lit(run.digest()).alias("codebooks_sha256"))
