"""Skew-safe ordered work inside groups.

A group (a user) may hold a third of all rows. Shuffling by the group key alone would send it to
one task. The tools here split such *hot* groups while keeping results exact:

* :func:`hot_keys` finds groups above a row threshold with one partial aggregation.
* :func:`group_positions` gives every row of the hot groups its 0-based position inside its group.
  It range-partitions the hot rows on (key, order...) — Spark samples the composite key, so one
  group spreads over many tasks in order — tags rows with ``monotonically_increasing_id`` and
  pins those ids with a reliable checkpoint. Per-partition row counts (one row per partition)
  turn the ids into dense global positions, and per-group minima into in-group positions.
* :func:`frame_groups` uses the positions to cut each hot group into chunks of ``chunk_rows``
  rows, and copies the last ``lookback`` rows of a chunk into the next one as *halo* rows. A
  window ``partitionBy(key, _chunk).rowsBetween(-lookback, -1)`` then sees exactly the rows it
  would see over the whole group; halo rows are dropped afterwards.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recengine.operators.joins import fits_broadcast
from recengine.session import reliable_checkpoint

# A group above this many rows is split. Normal groups stay whole (one task holds at most this).
DEFAULT_HOT_ROWS = 2_000_000
# Hot keys are passed as an IN-set literal up to this many; beyond, they are joined as a frame.
MAX_HOT_LITERALS = 10_000
# Target rows per range partition of hot data.
ROWS_PER_RANGE_PARTITION = 2_000_000

_MASK33 = (1 << 33) - 1


def total_order(order: list[str] | None, columns: list[str], ties: tuple[str, ...] = ("movieId", "rating")) -> list[str]:
    """The order (timestamp by default) with the columns appended that break its ties."""
    order = list(order or ["timestamp"])
    return order + [c for c in ties if c not in order and c in columns]


@dataclass
class HotKeys:
    key: str
    values: list | None          # literal list when small
    frame: DataFrame | None      # (key) frame when there are many
    rows: int                    # rows held by the hot keys

    @property
    def empty(self) -> bool:
        return self.values is not None and len(self.values) == 0

    def condition(self) -> "F.Column":
        """Never null: a null key is hot when the null group is (null keys form one group too)."""
        k = F.col(self.key)
        present = [v for v in self.values if v is not None]
        cond = F.coalesce(k.isin(present), F.lit(False)) if present else F.lit(False)
        return cond | k.isNull() if None in self.values else cond


def hot_keys(df: DataFrame, key: str, threshold: int = DEFAULT_HOT_ROWS) -> HotKeys:
    """Keys with more than ``threshold`` rows. One partial aggregation over the key column only."""
    return hot_keys_from_counts(df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), key, threshold)


def hot_keys_from_counts(counts: DataFrame, key: str, threshold: int = DEFAULT_HOT_ROWS) -> HotKeys:
    """Hot keys from an existing (key, _n) count table."""
    counts = counts.where(F.col("_n") > threshold).select(key, "_n")
    head = counts.limit(MAX_HOT_LITERALS + 1).collect()
    if len(head) <= MAX_HOT_LITERALS:
        return HotKeys(key, [r[key] for r in head], None, sum(int(r["_n"]) for r in head))
    total = counts.agg(F.sum("_n")).collect()[0][0]
    return HotKeys(key, None, reliable_checkpoint(counts.select(key)), int(total))


def split_by_hot(df: DataFrame, hot: HotKeys) -> tuple[DataFrame, DataFrame]:
    """(normal rows, hot rows)."""
    if hot.values is not None:
        cond = hot.condition()
        return df.where(~cond), df.where(cond)
    on = df[hot.key].eqNullSafe(hot.frame[hot.key])
    return df.join(hot.frame, on, "left_anti"), df.join(hot.frame, on, "left_semi")


def group_positions(df: DataFrame, key: str, order: list[str], total_rows: int | None = None,
                    rows_per_partition: int = ROWS_PER_RANGE_PARTITION) -> DataFrame:
    """Adds ``_pos``: 0-based position of each row inside its ``key`` group in ``order``.

    ``order`` must make rows unique inside a group. No group is ever held by one task.
    """
    n_parts = max(1, -(-int(total_rows or rows_per_partition) // rows_per_partition))
    ranged = (df.repartitionByRange(n_parts, F.col(key), *[F.col(c) for c in order])
                .sortWithinPartitions(key, *order)
                .withColumn("_mid", F.monotonically_increasing_id()))
    ranged = reliable_checkpoint(ranged)
    part = F.shiftright(F.col("_mid"), 33)
    local = F.col("_mid").bitwiseAND(F.lit(_MASK33))
    sizes = ranged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_sz"))
    # one row per range partition: a bounded table, broadcast by construction
    offsets = sizes.select("_p", F.coalesce(
        F.sum("_sz").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ).alias("_off"))
    g = (ranged.withColumn("_p", part)
               .join(F.broadcast(offsets), "_p")
               .withColumn("_g", F.col("_off") + local))
    # one row per hot group: broadcast only if they are few
    starts = g.groupBy(F.col(key).alias("_sk")).agg(F.min("_g").alias("_start"))
    # null-safe: a null key is one group as in a window partition
    starts = F.broadcast(starts) if fits_broadcast(starts, MAX_HOT_LITERALS) else starts
    return (g.join(starts, g[key].eqNullSafe(starts["_sk"]))
             .withColumn("_pos", F.col("_g") - F.col("_start"))
             .drop("_mid", "_p", "_off", "_g", "_start", "_sk"))


def frame_groups(df: DataFrame, key: str, order: list[str], lookback: int,
                 hot_threshold: int = DEFAULT_HOT_ROWS, chunk_rows: int | None = None,
                 hot: HotKeys | None = None) -> DataFrame:
    """Adds ``_chunk`` (sub-group id), ``_halo`` (copy only needed as look-back) and ``_pos`` for a bounded
    row-frame window ``partitionBy(key, _chunk).orderBy(_pos, order).rowsBetween(-lookback, -1)``.

    ``_pos`` is the position inside a hot group, so that rows tied in ``order`` keep the places by
    which they were cut into chunks; it is 0 in normal groups.

    Normal groups get ``_chunk = 0`` and no halo rows, so the common case costs one shuffle.
    ``hot`` may be computed by the caller on a cheaper frame with the same rows per key.
    """
    chunk_rows = chunk_rows or hot_threshold
    hot = hot if hot is not None else hot_keys(df, key, hot_threshold)
    if hot.empty:
        return df.withColumns({"_chunk": F.lit(0).cast("bigint"), "_halo": F.lit(False), "_pos": F.lit(0).cast("bigint")})
    normal, hot_rows = split_by_hot(df, hot)
    pos = group_positions(hot_rows, key, order, hot.rows)
    own = F.floor(F.col("_pos") / chunk_rows)
    last = F.floor((F.col("_pos") + lookback) / chunk_rows)
    exploded = (pos.withColumn("_own", own)
                   .withColumn("_chunk", F.explode(F.sequence(own, last)))
                   .withColumn("_halo", F.col("_chunk") != F.col("_own"))
                   .drop("_own"))
    normal = normal.withColumns({"_chunk": F.lit(0).cast("bigint"), "_halo": F.lit(False), "_pos": F.lit(0).cast("bigint")})
    return normal.unionByName(exploded)
