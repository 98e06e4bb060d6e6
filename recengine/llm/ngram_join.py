"""N-gram Jaccard join by adaptive multi-match prefixes.

A document is the set of its distinct k-word shingles, as 64-bit hashes.  Documents of equal sets form
one class; everything after that is on classes.

1. Order.  A table of shingle counts in 2**19 buckets, over all documents, orders shingles from rare to
   frequent (estimate, then hash).
2. Prefixes.  With similarity t, two sets of sizes n and m that are similar share at least
   need(n, m) = ceil(t / (1 + t) * (n + m)) shingles.  A prefix of p shingles leaves n - p out, so at least
   need - (n - p) shared shingles lie in it.  The shortest prefix that leaves one shared shingle to
   any possible partner is lengthened by l - 1 where the estimated cost (postings read, plus verification
   of the candidates that still share l) is lower; a pair then has to share correspondingly more
   prefix shingles, min over both sides of need - (n - p), before it is verified.
3. Stars.  Classes are numbered by how common their prefix shingles are: in a group of near copies the copy with the
   fewest changes of its own comes first.  In every prefix shingle's list each class meets the first; pairs that
   share a fair part of what is needed there are verified, and connected.
4. Rounds.  In lists that still hold more than one component, shared shingles of pairs in different
   components are counted (as packed arrays for each class, not a row for each pair and shingle).  Every class
   verifies only its few best candidates, by their share of what is required; links connect components, and
   candidates that have come into one component need no check any more.  The classes that have candidates left go
   into the next round, with four times as many each, until none has; so the components are those of all links.
   Long lists are cut into chunks that meet in pairs of chunks.
5. Verification compares whole sets, made again from the texts of the classes concerned.

Hash equality stands for shingle equality: for two sets of 10**4 shingles a false match has probability
10**8 / 2**64.

Defined cases: null texts and texts without words have the empty set and are linked with nothing; texts
of fewer than k words are one shingle; equal sets are linked; rows with a null id take part, and a
component of only such rows has a null id; repeated rows and ids give a row each; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine.llm.common import Scratch, fresh_name
from recengine.llm.shingles import components, shingles

BITS, SLICES = 19, 64
SLOTS = 1 << BITS
#: Rows of a list that are held at a time; longer lists meet chunk by chunk.
CHUNK = 8192
#: Classes whose texts are looked up by a broadcast of two numbers each; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
LENGTHS = (1, 2, 4, 8, 16, 32)
#: A star's centre leads only part of the lists that a pair shares, so this part of what is required is enough
#: to verify a pair there; the rounds ask for all of it, over all lists.
STAR_PART = 4
#: Candidates that a class verifies in the first round; four times as many in each round that follows.
FEW = 4
PARTNER = np.dtype([("node", "i8"), ("n", "i4"), ("p", "i4")])
#: Packed partner lists above this many bytes are compressed, column by column.
LARGE = 1024


def need(n, m, num: int, den: int):
    """Least number of shared shingles of similar sets: ceil(num * (n + m) / (num + den))."""
    return -((-num * (n + m)) // (num + den))


def enough(n, p, m, q, num: int, den: int):
    """Least number of shared prefix shingles; sizes n, m and prefix lengths p, q."""
    return need(n, m, num, den) - np.maximum(n - p, m - q)


def signature(s: np.ndarray) -> tuple[int, int]:
    x = xxhash.xxh128_intdigest(s.tobytes())
    return (x >> 64) - (1 << 63), (x & ((1 << 64) - 1)) - (1 << 63)


def slot(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - BITS)).astype(np.int64)


def scanned(docs: DataFrame, k: int) -> DataFrame:
    """One pass over the texts: a row for each document, and each task's bucket counts in slices."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, compressor = np.zeros(SLOTS, np.int64), zstandard.ZstdCompressor()
        for b in batches:
            out, slots = [], []
            for key, text, look in zip(b["key"], b["text"], b["look"], strict=True):
                s = np.unique(shingles(text, k))
                slots.append(slot(s))
                out.append((key, look, len(s), *(signature(s) if len(s) else (0, 0))))
            table += np.bincount(np.concatenate(slots), minlength=SLOTS)
            yield pd.DataFrame(out, columns=["key", "look", "n", "s1", "s2"]).assign(slice=-1, counts=None)
        if table.any():
            counts = [np.array([np.flatnonzero(x), x[x > 0]], np.int32) for x in np.split(table, SLICES)]
            yield pd.DataFrame({"key": None, "look": 0, "n": 0, "s1": 0, "s2": 0, "slice": range(SLICES),
                                "counts": [compressor.compress(x.tobytes()) for x in counts]})

    return docs.mapInPandas(run, "key string, look long, n long, s1 long, s2 long, slice int, counts binary")


def summed_counts(slices: DataFrame) -> np.ndarray:
    """The bucket counts over all documents; a bounded table (SLOTS numbers)."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for i, raw in zip(b["slice"], b["counts"], strict=True):
                sums.setdefault(i, np.zeros(SLOTS // SLICES, np.int64))
                at, n = np.frombuffer(zstandard.decompress(raw), "int32").reshape(2, -1)
                sums[i][at] += n
        yield pd.DataFrame({"slice": list(sums), "counts": [x.tobytes() for x in sums.values()]})

    table = np.zeros((SLICES, SLOTS // SLICES), np.int64)
    for r in slices.repartition(SLICES, "slice").mapInPandas(add, "slice int, counts binary").collect():
        table[r["slice"]] += np.frombuffer(r["counts"], "int64")
    return table.reshape(-1)


def prefix(s: np.ndarray, table: np.ndarray, usual: float, num: int, den: int) -> tuple[np.ndarray, float]:
    """The rare end of a sorted set, as long as its estimated cost asks for, and how common its first shingles are.

    ``usual`` is a bucket's mean load.
    """
    n = len(s)
    seen = table[slot(s)]
    order = np.argsort(seen, kind="stable")
    s, seen = s[order], seen[order]
    extra = np.cumsum(np.maximum(seen - usual, 0.0))
    first = n + (-num * n) // den + 1
    best, cost = first, None
    for length in LENGTHS:
        p = min(n, first + length - 1)
        read = extra[p - 1]
        own = read + n * read / length
        if cost is None or own < cost:
            best, cost = p, own
    return s[:best], float(seen[:first].mean())


def with_prefixes(docs: DataFrame, table, k: int, num: int, den: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        usual = float(table.value.mean())
        for b in batches:
            out = []
            for text, look in zip(b["text"], b["look"], strict=True):
                s = np.unique(shingles(text, k))
                if len(s):
                    own, common = prefix(s, table.value, usual, num, den)
                    out.append((*signature(s), len(s), look, own.tobytes(), common))
            yield pd.DataFrame(out, columns=["s1", "s2", "n", "look", "prefix", "common"])

    return docs.mapInPandas(run, "s1 long, s2 long, n int, look long, prefix binary, common double")


def postings(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            lists = [np.frombuffer(x, "int64") for x in b["prefix"]]
            for at in range(0, len(lists), 256):
                part = lists[at: at + 256]
                yield pd.DataFrame({"token": np.concatenate(part), "node": np.repeat(
                    b["node"].to_numpy()[at: at + 256], [len(x) for x in part])})

    return classes.select("node", "prefix").mapInPandas(run, "token long, node long")


def shared_lists(posts: DataFrame) -> DataFrame:
    """(token, node, lead, place) of tokens with two nodes or more; lead is the smallest node, at place 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        token = node = np.zeros(0, np.int64)
        lead = place = None  # of the run that the first row carried over belongs to, if it has begun before
        for b in batches:
            token = np.concatenate([token, b["token"].to_numpy()])
            node = np.concatenate([node, b["node"].to_numpy()])
            if len(token) < 2:
                continue
            new = np.concatenate([[True], token[1:] != token[:-1]])
            start = np.maximum.accumulate(np.where(new, np.arange(len(token)), 0))
            places, leads = np.arange(len(token)) - start, node[start]
            if lead is not None:
                first = start == 0
                places, leads = places + np.where(first, place, 0), np.where(first, lead, leads)
            several = (places > 0) | np.concatenate([~new[1:], [False]])
            done = several[:-1]
            yield pd.DataFrame({"token": token[:-1][done], "node": node[:-1][done], "lead": leads[:-1][done],
                                "place": places[:-1][done]})
            lead, place = leads[-1], places[-1]
            token, node = token[-1:], node[-1:]
        if len(token) and place:
            yield pd.DataFrame({"token": token, "node": node, "lead": [lead], "place": [place]})

    return (posts.repartition("token").sortWithinPartitions("token", "node")
            .mapInPandas(run, "token long, node long, lead long, place long"))


def partners(members: DataFrame) -> DataFrame:
    """(node, with): for each open row of a list, its packed partners of other components and smaller number."""

    def lists(batches):
        last, held = None, []
        for b in batches:
            key = b[["token", "i", "j"]].to_numpy()
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(b)]
            cols = [b[c].to_numpy() for c in ("node", "component", "n", "p", "chunk", "i", "j", "open")]
            for a, z in zip(cuts, cuts[1:], strict=False):
                if a == z:
                    continue
                now = tuple(key[a])
                if now != last and held:
                    yield [np.concatenate(x) for x in zip(*held, strict=True)]
                    held = []
                last = now
                held.append([c[a:z] for c in cols])
        if held:
            yield [np.concatenate(x) for x in zip(*held, strict=True)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, size = [], 0
        for node, component, n, p, chunk, i, j, open_ in lists(batches):
            if len(node) < 2 or (component == component[0]).all():
                continue
            packed = np.zeros(len(node), PARTNER)
            packed["node"], packed["n"], packed["p"] = node, n, p
            for x in np.flatnonzero(open_):
                with_ = (node < node[x]) & (component != component[x])
                if i[0] != j[0]:
                    with_ &= chunk != chunk[x]
                if with_.any():
                    raw = pack(packed[with_])
                    out.append((node[x], n[x], p[x], raw))
                    size += len(raw)
            if size > 4 << 20:
                yield pd.DataFrame(out, columns=["node", "n", "p", "raw"])
                out, size = [], 0
        if out:
            yield pd.DataFrame(out, columns=["node", "n", "p", "raw"])

    return (members.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
            .mapInPandas(run, "node long, n int, p int, raw binary"))


def sharing_enough(rows: DataFrame, few: int, num: int, den: int) -> DataFrame:
    """(a, b, share, last): of each class b its ``few`` best candidates a whose shared prefix shingles are enough.

    Shared shingles are counted over all lists; ``share`` is their part of what is required, and candidates come by
    descending share, then by number, from where the class stopped in the round before (was_share, was_node) on.
    ``last`` marks the last one taken of a class that has more.
    """

    def counted(held: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        own, many = np.concatenate(held), np.concatenate(counts)
        node, first, at = np.unique(own["node"], return_index=True, return_inverse=True)
        return own[first], np.bincount(at, many).astype(np.int64)

    def found(node: int, n: int, p: int, was_share: float, was_node: int, held: list, counts: list) -> pd.DataFrame:
        own, many = counted(held, counts)
        small, large = np.minimum(own["n"], n).astype(np.int64), np.maximum(own["n"], n).astype(np.int64)
        required = enough(n, p, own["n"].astype(np.int64), own["p"].astype(np.int64), num, den)
        share = many / np.maximum(required, 1)
        fine = (den * small >= num * large) & (many >= required)
        fine &= (share < was_share) | ((share == was_share) & (own["node"] > was_node))
        at = np.flatnonzero(fine)
        best = at[np.lexsort((own["node"][at], -share[at]))][:few]
        last = np.zeros(len(best), bool)
        last[-1:] = len(at) > few
        return pd.DataFrame({"a": own["node"][best], "b": node, "share": share[best], "last": last})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, held, counts, size, out = None, [], [], 0, []
        for b in batches:
            for node, n, p, was_share, was_node, raw in zip(
                    b["node"], b["n"], b["p"], b["was_share"], b["was_node"], b["raw"], strict=True):
                if last is not None and node != last[0]:
                    out.append(found(*last, held, counts))
                    held, counts, size = [], [], 0
                last = (node, n, p, was_share, was_node)
                held.append(unpack(raw))
                counts.append(np.ones(len(held[-1])))
                size += len(held[-1])
                if size > 1 << 20:
                    own, many = counted(held, counts)
                    held, counts, size = [own], [many], 0
            if out:
                yield pd.concat(out)
                out = []
        if last is not None:
            yield found(*last, held, counts)

    return rows.repartition("node").sortWithinPartitions("node").mapInPandas(run, "a long, b long, share double, last boolean")


def pack(rows: np.ndarray) -> bytes:
    """Partners as bytes; large lists column by column, the nodes as differences, compressed."""
    if rows.nbytes <= LARGE:
        return b"\0" + rows.tobytes()
    return b"\1" + zstandard.compress(np.diff(rows["node"], prepend=0).tobytes() + rows["n"].tobytes() + rows["p"].tobytes())


def unpack(raw: bytes) -> np.ndarray:
    if not raw[0]:
        return np.frombuffer(raw, PARTNER, offset=1)
    data = zstandard.decompress(raw[1:])
    n = len(data) // PARTNER.itemsize
    out = np.zeros(n, PARTNER)
    out["node"] = np.cumsum(np.frombuffer(data, "i8", n))
    out["n"] = np.frombuffer(data, "i4", n, 8 * n)
    out["p"] = np.frombuffer(data, "i4", n, 12 * n)
    return out


class Join:
    """One run of the join over (key, text, look); the key as text, so that null ids pass pandas unharmed."""

    def __init__(self, docs: DataFrame, k: int, num: int, den: int):
        self.docs, self.k, self.num, self.den = docs, k, num, den
        self.scratch = Scratch(docs.sparkSession, "ngram_join")
        self.sets: list[DataFrame] = []
        self.pairs: list[DataFrame] = []  # what was verified in each step

    def sets_of(self, nodes: DataFrame, classes: DataFrame) -> None:
        """Adds the sets of those nodes that aren't held yet; the texts are read only if there are any."""
        wanted = nodes
        for held in self.sets:
            wanted = wanted.join(held.select("node"), "node", "left_anti")
        wanted = self.scratch.save(classes.select("node", "look", "s1", "s2").join(wanted, "node"))
        many, k = wanted.count(), self.k

        def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = []
                for node, text, s1, s2 in zip(b["node"], b["text"], b["s1"], b["s2"], strict=True):
                    s = np.unique(shingles(text, k))
                    if signature(s) == (s1, s2):
                        out.append((node, s.tobytes()))
                yield pd.DataFrame(out, columns=["node", "own"])

        if many:
            own = (self.docs.join(F.broadcast(wanted) if many <= BROADCAST_ROWS else wanted, "look").select("node", "text", "s1", "s2")
                   .mapInPandas(sets, "node long, own binary").groupBy("node").agg(F.first("own").alias("own")))
            self.sets.append(self.scratch.save(own))
        self.scratch.drop(wanted)

    def verified(self, pairs: DataFrame, classes: DataFrame) -> DataFrame:
        """The pairs of a saved table whose whole sets are similar."""
        num, den = self.num, self.den
        nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        self.sets_of(nodes, classes)
        if not self.sets:
            return pairs.limit(0)
        own = reduce(DataFrame.unionByName, self.sets)
        own = own.join(nodes, "node", "left_semi") if len(self.sets) > 1 else own
        both = (pairs.join(own.toDF("a", "x"), "a").join(own.toDF("b", "y"), "b"))

        def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                fine = []
                for x, y in zip(b["x"], b["y"], strict=True):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    fine.append(den * shared >= num * (len(x) + len(y) - shared))
                yield b.loc[fine, ["a", "b"]]

        return self.scratch.save(both.mapInPandas(check, "a long, b long"))

    def members(self, lists: DataFrame, sizes: DataFrame, near: DataFrame, stopped: DataFrame | None) -> DataFrame:
        """The rows of the lists with their components; after the first round only lists of classes that have stopped."""
        if stopped is not None:
            again = stopped.select("node", F.lit(True).alias("open"))
            tokens = lists.join(again, "node").select("token").distinct()
            lists = lists.join(tokens, "token", "left_semi").join(again, "node", "left")
        else:
            lists = lists.withColumn("open", F.lit(True))
        part = F.floor(F.col("place") / CHUNK)
        rows = lists.select("token", "node", part.alias("chunk"), F.coalesce("open", F.lit(False)).alias("open")).join(
            sizes, "node").join(near, "node", "left").withColumn("component", F.coalesce("component", "node"))
        long = lists.where(F.col("place") >= CHUNK).groupBy("token").agg(F.max(part).alias("last"))
        # A row of chunk c meets the rows of every chunk of its list: as (c, j) for j <= c and (i, c) for i > c.
        rows = rows.join(long, "token", "left").withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("last", F.lit(0).cast("long")))))
        return rows.select("token", "node", "n", "p", "component", "chunk", "open", F.greatest("chunk", "other").alias("i"),
                           F.least("chunk", "other").alias("j"))

    def run(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """(documents, nodes of their signatures, components of nodes)."""
        num, den, scratch = self.num, self.den, self.scratch
        scan = scratch.save(scanned(self.docs, self.k))
        table = self.docs.sparkSession.sparkContext.broadcast(
            summed_counts(scan.where("slice >= 0").select("slice", "counts")))
        documents = scan.where("slice < 0").select("key", "look", "n", "s1", "s2")
        classes = (with_prefixes(self.docs, table, self.k, num, den).groupBy("s1", "s2")
                   .agg(F.first("n").alias("n"), F.min("look").alias("look"), F.first("prefix").alias("prefix"), F.first("common").alias("common")))
        order = [F.desc("common"), F.col("s1"), F.col("s2")]
        classes = (classes.repartitionByRange(*order).sortWithinPartitions(*order).drop("common")
                   .withColumn("node", F.monotonically_increasing_id())
                   .withColumn("p", (F.length("prefix") / 8).cast("int")))
        classes = scratch.save(classes)
        sizes = classes.select("node", "n", "p")
        lists = scratch.save(shared_lists(postings(classes)))

        a, b = (sizes.toDF(x, f"n_{x}", f"p_{x}") for x in "ab")
        left = F.col("n_a") + F.col("n_b")
        required = F.ceil(num * left / (num + den)) - F.greatest(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b"))
        stars = (lists.where("place > 0").groupBy(F.col("lead").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("shared"))
                 .where("a <> b").join(a, "a").join(b, "b")
                 .where((F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num) & (F.col("shared") * STAR_PART >= required))
                 .select("a", "b"))
        self.pairs.append(scratch.save(stars))
        near = components(scratch, self.verified(self.pairs[-1], classes))
        stopped, few = None, FEW
        while True:
            rows = partners(self.members(lists, sizes, near, stopped))
            if stopped is None:
                rows = rows.withColumns({"was_share": F.lit(float("inf")), "was_node": F.lit(-1).cast("long")})
            else:
                rows = rows.join(stopped, "node")
            found = scratch.save(sharing_enough(rows, few, num, den))
            self.pairs.append(found)
            more = self.verified(found.select("a", "b"), classes)
            links = more.unionByName(near.select(F.col("node").alias("a"), F.col("component").alias("b")))
            near = components(scratch, links)
            stopped = found.where("last").select(F.col("b").alias("node"), F.col("share").alias("was_share"), F.col("a").alias("was_node"))
            few *= 4
            if not stopped.limit(1).count():
                break
        names = scratch.save(classes.select("s1", "s2", "node"))
        scratch.keep_only(scan, names, near)
        return documents, names, near


def grouped(df: DataFrame, key: str, text: str, k: int, similarity: tuple[int, int]) -> DataFrame:
    """(key, look, n, group): a row for each input row; look is the text's hash, group is null for the empty set."""
    num, den = similarity
    docs = df.select(F.col(key).cast("string").alias("key"), F.col(text).alias("text"),
                     F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("look"))
    documents, names, near = Join(docs, k, num, den).run()
    names = names.join(near, "node", "left").select("s1", "s2", F.coalesce("component", "node").alias("group"))
    rows = documents.where("n > 0").join(names, ["s1", "s2"])  # the many rows of one text are split by adaptive execution
    rows = rows.unionByName(documents.where("n = 0").withColumn("group", F.lit(None).cast("long")))
    return rows.select(F.col("key").cast(df.schema[key].dataType).alias("key"), "look", "n", "group")


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, similarity: tuple[int, int] = (75, 100),
                    n_shingles: str = "n_shingles", component: str = "component_id") -> DataFrame:
    """(key, n_shingles, component): a row for each input row; the component is the smallest key that links reach."""
    scratch = Scratch(df.sparkSession, "near_duplicates")
    rows = scratch.save(grouped(df, key, text, k, similarity))
    least = rows.where("n > 0").groupBy("group").agg(F.min("key").alias("least"), F.count("*").alias("rows"))
    least = scratch.save(least.where("rows > 1").select("group", "least"))
    if least.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        least = F.broadcast(least)
    met = rows.where("n > 0").join(least, "group", "left").select(
        F.col("key").alias(key), F.col("n").alias(n_shingles), F.coalesce("least", "key").alias(component))
    return met.unionByName(rows.where("n = 0").select(F.col("key").alias(key), F.col("n").alias(n_shingles), F.col("key").alias(component)))


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5,
                similarity: tuple[int, int] = (75, 100)) -> DataFrame:
    """The rows of ``df`` without near copies: of each group the row of the smallest id (null last) stays.

    Rows without words have no group and all stay.
    """
    scratch = Scratch(df.sparkSession, "one_of_each")
    rows = scratch.save(grouped(df, key, text, k, similarity))
    first = rows.where("group is not null").groupBy("group").agg(F.min(F.struct(F.col("key").isNull(), "key", "look")).alias("m"))
    stay = scratch.save(first.select(F.col("m.key").alias("stay_key"), F.col("m.look").alias("stay_look")))
    look = fresh_name(df, "_look")
    own = df.withColumn(look, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    few = stay.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    right = (F.broadcast(stay) if few else stay).alias("s")
    met = lambda x, k, h: x[k].eqNullSafe(F.col("s.stay_key")) & (x[h] == F.col("s.stay_look"))
    kept = own.join(right, met(own, key, look), "left_semi")
    again = rows.join(right, met(rows, "key", "look"), "left_semi")
    if again.groupBy("key", "look").count().where("count > 1").limit(1).count():  # the staying row is there more than once
        kept = kept.dropDuplicates([key, look])
    empty = rows.where("group is null").select(F.col("look").alias("empty_look")).distinct()  # of texts without words
    few = empty.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return kept.unionByName(own.join(F.broadcast(empty) if few else empty, own[look] == F.col("empty_look"), "left_semi")).drop(look)
