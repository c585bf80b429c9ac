"""Identity, deduplication and sharding."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dedup_least(df: DataFrame, key: str, first: str, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """One row for each key: the least by column first, then by all others in order. A hash aggregation with partial sums, no sort.

    leave_out: columns that can't be compared; they are dropped.
    """
    rest = [c for c in df.columns if c not in (key, first, *leave_out)]
    out = df.groupBy(key).agg(F.min(F.struct(first, *rest)).alias("__least"))
    return out.select(*[F.col(key) if c == key else F.col(f"__least.{c}") for c in df.columns if c not in leave_out])


def dedup_batches(batches: list[DataFrame], key: str, first: str) -> DataFrame:
    """Deduplication within and then across batches; the same as over their union."""
    return dedup_least(reduce(DataFrame.unionByName, (dedup_least(b, key, first) for b in batches)), key, first)


def one_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """The least row of each key, in place of an arbitrary one."""
    rest = [c for c in df.columns if c not in keys]
    out = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__least")) if rest else df.select(*keys).distinct()
    return out.select(*[F.col(c) if c in keys else F.col(f"__least.{c}") for c in df.columns])


def shard(key: Column, shards: int) -> Column:
    """A stable shard number of a key (Murmur3)."""
    return F.pmod(F.hash(key), F.lit(shards))
