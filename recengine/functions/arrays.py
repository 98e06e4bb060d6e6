"""Array / vector expressions built from higher-order functions (JVM side, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(F.aggregate(_c(a), F.lit(0.0), lambda acc, v: acc + v * v))


def cosine(a, b) -> Column:
    """Null when either vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_distance(a, b) -> Column:
    diff2 = F.zip_with(_c(a), _c(b), lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(diff2, F.lit(0.0), lambda acc, v: acc + v))


def to_double_array(a) -> Column:
    return F.transform(_c(a), lambda x: x.cast("double"))


def zeros(d: int) -> Column:
    return F.array_repeat(F.lit(0.0), d)



def flat_sorted(lists) -> Column:
    """All entries of the lists, sorted (native sort; ``array_sort`` would call a lambda for every comparison)."""
    return F.sort_array(F.flatten(_c(lists)))


def rank_sorted_by_frequency(sorted_col, reversed_col) -> Column:
    """Distinct values of a sorted array, most frequent first, ties alphabetical.

    The count of ``q`` is (last index - first index + 1), both found by the native
    ``array_position`` on the sorted array and on its reverse; no per-element lambda scan.
    Each distinct value becomes the key ``(10**9 - count)`` zero-padded to 10 digits followed by
    the value, so one native string sort orders by count descending, then by value.
    """
    s, rs = _c(sorted_col), _c(reversed_col)
    n = F.size(s)

    def key(q):
        count = n - F.array_position(rs, q) - F.array_position(s, q) + 2
        return F.concat(F.lpad((F.lit(10 ** 9) - count).cast("string"), 10, "0"), q)

    ranked = F.sort_array(F.transform(F.array_distinct(s), key))
    return F.transform(ranked, lambda k: F.substring(k, 11, 1 << 30))
