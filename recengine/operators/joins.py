"""Joins against dimension-like tables with a *checked* broadcast.

A side is broadcast only after counting at most ``max_rows + 1`` of its rows (a bounded read);
otherwise the join is left to the planner (sort-merge, AQE skew-join splitting, AQE runtime
broadcast when the real size turns out small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_BROADCAST_ROWS = 1_000_000
# Budget for one broadcast side; wide rows (vectors) get fewer rows than the row default.
MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def rows_for_width(row_bytes: int, max_rows: int = DEFAULT_BROADCAST_ROWS) -> int:
    """Row cap so that rows * row_bytes stays inside the broadcast byte budget."""
    return max(1, min(max_rows, MAX_BROADCAST_BYTES // max(1, row_bytes)))


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads at most max_rows + 1 rows)."""
    return df.limit(max_rows + 1).count() <= max_rows


def table_bytes(df: DataFrame) -> int:
    """About what the rows of ``df`` take in a broadcast hash table: 8 bytes a column, the texts, 24 for each row."""
    texts = [F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)) + 8 for f in df.schema if f.dataType.typeName() == "string"]
    width = F.lit(8 * len(df.columns) + 24).cast("bigint") + sum(texts, F.lit(0))
    return int(df.agg(F.sum(width)).first()[0] or 0)


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                   max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    if max_broadcast_rows and fits_broadcast(dim, max_broadcast_rows):
        dim = F.broadcast(dim)
    return fact.join(dim, on, how)
