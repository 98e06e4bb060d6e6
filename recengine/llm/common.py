"""Small helpers shared by the operators: scratch tables, result columns, partition counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recengine.session import Scratch  # noqa: F401  (the operators take it from here)

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(col: Column) -> Column:
    """A-Z to a-z; every other character stays as it is (``lower`` would also fold other scripts)."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def with_results(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Append result columns; an input column of the same name is replaced."""
    return df.withColumns(columns)


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that the frame doesn't have (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def crc_text(col: Column) -> Column:
    """crc32 of the value written as text; null counts as the empty text."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))
