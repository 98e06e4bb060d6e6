"""Token counts of byte-level BPE by heap and linked list.

A text is cut at the tokenizer's added tokens, each of which counts as one.  The rest is cut into
pre-tokens; each pre-token starts as one symbol per UTF-8 byte.  Adjacent pairs wait in a heap by
(rank, position); the lowest is popped, merged in a doubly linked list, and its new neighbours are
pushed.  The count is the number of initial symbols minus the number of merges; no identifiers are
put out.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows give repeated results;
an empty table gives an empty table; columns of the result replace input columns of the same name.
Texts are processed whole.  Memory per task: one Arrow batch and a bounded table of counted pre-tokens.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recengine.llm.common import with_results

# The white space of Unicode's White_Space property.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def pre_token(letter: str, number: str, both: str) -> str:
    """The pattern that cuts a text into pre-tokens, for one way to write letters and numbers."""
    return (r"'s|'t|'re|'ve|'m|'ll|'d"
            rf"| ?{letter}+| ?{number}+| ?[^{SPACE}{both}]+"
            rf"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


# The letters and numbers below U+0250, for texts that have nothing above it.
LATIN_END, LATIN_L, LATIN_N = "\u024f", "A-Za-zªµºÀ-ÖØ-öø-\u024f", "0-9²³¹¼-¾"

#: Counted pre-tokens a Python worker remembers, and the longest one it remembers.
REMEMBERED, REMEMBERED_CHARS = 400_000, 48
#: Texts above this many characters are cut by an iterator instead of into one list.
STREAM_CHARS = 1_000_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class BytePairCounter:
    """Counts the tokens of whole texts for one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        self.first = [ids[c] for c in byte_symbols()]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        added = sorted((t["content"] for t in spec.get("added_tokens") or ()), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, added))) if added else None
        self.cut = regex.compile(pre_token(r"\p{L}", r"\p{N}", r"\p{L}\p{N}"))
        self.cut_latin = re.compile(pre_token(f"[{LATIN_L}]", f"[{LATIN_N}]", LATIN_L + LATIN_N))
        self.beyond_latin = re.compile(rf"[^\x00-{LATIN_END}]")
        self.known: dict[str, int] = {}

    def merged(self, piece: str) -> int:
        """Symbols left of one pre-token: initial symbols minus merges."""
        symbols = [self.first[b] for b in piece.encode("utf-8")]
        n, merges = len(symbols), self.merges
        heap = [(*m, i) for i in range(n - 1) if (m := merges.get((symbols[i], symbols[i + 1])))]
        heapq.heapify(heap)
        heap_pop, heap_push = heapq.heappop, heapq.heappush
        before, after, done = list(range(-1, n - 1)), list(range(1, n + 1)), 0
        while heap:
            rank, new, i = heap_pop(heap)
            j = after[i] if symbols[i] >= 0 else n
            if j >= n or merges.get((symbols[i], symbols[j])) != (rank, new):
                continue  # one side has merged since
            done += 1
            symbols[i], symbols[j] = new, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if m := merges.get((new, symbols[k])):
                    heap_push(heap, (*m, i))
            h = before[i]
            if h >= 0 and (m := merges.get((symbols[h], new))):
                heap_push(heap, (*m, h))
        return n - done

    def remember(self, pieces: set[str]) -> None:
        if len(self.known) + len(pieces) > REMEMBERED:
            self.known.clear()
        self.known.update((p, self.merged(p)) for p in pieces if len(p) <= REMEMBERED_CHARS)

    def plain(self, text: str) -> int:
        cut = self.cut if self.beyond_latin.search(text) else self.cut_latin
        if len(text) >= STREAM_CHARS:
            known = self.known
            return sum(known[p] if p in known else self.merged(p) for p in (m.group() for m in cut.finditer(text)))
        pieces = cut.findall(text)
        try:
            return sum(map(self.known.__getitem__, pieces))
        except KeyError:
            self.remember(set(pieces).difference(self.known))
            known = self.known
            return sum(known[p] if p in known else self.merged(p) for p in pieces)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.added is None or not self.added.search(text):
            return self.plain(text)
        parts = self.added.split(text)
        return len(parts) - 1 + sum(map(self.plain, parts))


@lru_cache(maxsize=2)
def counter(path: str) -> BytePairCounter:
    return BytePairCounter(path)


def count_tokens(df: DataFrame, vocabulary: str, text: str = "text", limit: int = 1024,
                 n_bytes: str = "n_bytes", n_tokens: str = "n_tokens", over_limit: str = "over_limit") -> DataFrame:
    """Append byte count, token count and whether the count is over ``limit``.

    ``vocabulary`` is the path of a byte-level BPE file (JSON) that every executor can read.
    """

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = counter(vocabulary)
        for texts in batches:
            yield pd.Series([own.count(t) for t in texts], dtype="int64")

    t = F.coalesce(df[text], F.lit(""))
    return with_results(df, {n_bytes: F.octet_length(t).cast("long"), n_tokens: counted(t)}).withColumn(
        over_limit, F.col(n_tokens) > limit)
