"""Best-of merging, de-duplication and state overlays."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_ranked(frames: list[DataFrame]) -> DataFrame:
    """Union by name, missing columns null; ``_src`` numbers the inputs (0 = master), later ones win ties."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.withColumn("_src", F.lit(i)) for i, f in enumerate(frames)])


def best_of(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key (null equals null): the one with the greatest ``order``, all other columns taken from it.

    One aggregation with map-side partial states, so a hot key shrinks before the shuffle.
    """
    rest = [c for c in df.columns if c not in key]
    return df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_best")).select(*key, *[F.col("_best")[c].alias(c) for c in rest])


def fetch_order(*arrival: str) -> list[Column]:
    """200 before all others, then more retries (null is 0), then later arrival."""
    return [F.coalesce(F.col("status_code") == 200, F.lit(False)), F.coalesce("retries", F.lit(0)), *[F.col(c) for c in arrival]]


def overlay(old: DataFrame, new: DataFrame, key: str, either: list[str]) -> DataFrame:
    """Full outer by key: new values replace old ones where the key is present; columns in ``either`` are or-ed."""
    cols = [c for c in old.columns if c != key]
    a = old.select(F.col(key).alias("_ka"), *[F.col(c).alias(f"_a_{c}") for c in cols], F.lit(True).alias("_in_a"))
    b = new.select(F.col(key).alias("_kb"), *[F.col(c).alias(f"_b_{c}") for c in cols], F.lit(True).alias("_in_b"))
    j = a.join(b, a["_ka"].eqNullSafe(b["_kb"]), "full_outer")
    pick = lambda c: (F.coalesce(f"_a_{c}", F.lit(False)) | F.coalesce(f"_b_{c}", F.lit(False))) if c in either else F.when(F.col("_in_b"), F.col(f"_b_{c}")).otherwise(F.col(f"_a_{c}"))
    return j.select(F.coalesce("_kb", "_ka").alias(key), *[pick(c).alias(c) for c in cols])


def first_seen(df: DataFrame, key: str, order: str) -> DataFrame:
    """Distinct keys with the place they were first seen at."""
    return df.groupBy(key).agg(F.min(order).alias(order))


def history(df: DataFrame, key: str, order: str, value: str, size: int = 10_000) -> DataFrame:
    """``key, piece, history``: the values of each key in ``order``, as arrays of at most ``size`` values, numbered from 0.

    A key may have any number of rows: they are numbered over blocks and cut into pieces, so no array and no task holds them all.
    """
    from harvestry.functions.prefix import blocked, number_rows

    frozen, block = blocked(df.select(key, order, value), order)
    pieces = number_rows(frozen, key, order, block, "_number").withColumn("piece", F.floor(F.col("_number") / size).cast("long"))
    listed = pieces.groupBy(key, "piece").agg(F.array_sort(F.collect_list(F.struct("_number", F.col(value).alias("v")))).alias("h"))
    return listed.select(key, "piece", F.transform("h", lambda x: x["v"]).alias("history"))
