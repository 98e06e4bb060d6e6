"""Scalar Column expressions. All of them stay inside whole-stage codegen (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recengine import schemas as S


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label(rating="rating", threshold: float = S.LABEL_THRESHOLD) -> Column:
    """1 when rating >= threshold, else 0 (a null rating gives 0)."""
    return F.when(_c(rating) >= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def release_year(title="title", default: int = S.DEFAULT_RELEASE_YEAR) -> Column:
    """Four digits right before the last character of the trimmed title, else ``default``."""
    digits = F.regexp_extract(F.trim(_c(title)), r".(\d{4}).$", 1)
    return F.coalesce(digits.try_cast("int"), F.lit(default))


def genre_slot(genres="genres", i: int = 0) -> Column:
    """i-th (0-based) entry of the ``|``-separated genre text, null when absent."""
    return F.get(F.split(_c(genres), r"\|"), i)


def two_decimals(x) -> Column:
    """Number as text with two decimals and thousands separators.

    The value is rounded to 9 places first so that the last-bit differences between
    summation orders cannot flip a tie at the second decimal.
    """
    return F.format_number(F.round(_c(x), 9), S.NUMBER_PRECISION)


def parse_number(text) -> Column:
    """Inverse of :func:`two_decimals` (strips thousands separators)."""
    return F.regexp_replace(_c(text), ",", "").try_cast("double")


def id_bucket(col, n: int, on_invalid: str = "null") -> Column:
    """Identity bucket: the id when it lies in [0, n); other ids are null, or an error with ``on_invalid="error"``."""
    c = _c(col)
    fine = (c >= 0) & (c < n)
    if on_invalid == "error":
        wrong = F.raise_error(F.concat(F.lit(f"id outside [0, {n}): "), c.cast("string")))
        return F.when(fine, c).when(c.isNotNull(), wrong.cast("bigint"))
    return F.when(fine, c)


def vocab_index(col, vocabulary: list[str]) -> Column:
    """0-based index in a fixed vocabulary; -1 for unknown or null."""
    vocab = F.array(*[F.lit(v) for v in vocabulary])
    return (F.coalesce(F.array_position(vocab, _c(col)), F.lit(0)) - 1).cast("int")


def md5_bucket(cols: list, n: int, salt: str | None = None) -> Column:
    """Portable hash bucket in [0, n): first 32 bits of md5 of the '_'-joined text, modulo n.

    md5 has a twin in every SQL engine, so bucket assignments can be checked independently.
    """
    parts = [F.lit(salt)] if salt is not None else []
    parts += [_c(c).cast("string") for c in cols]
    text = F.concat_ws("_", *parts)
    return F.pmod(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), F.lit(n))


def sigmoid(x) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(x)))
