"""Exact prefix sums and row numbers that never put one key, or the whole table, into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestry.session import fresh, stored

#: About how many rows one block of a frozen table holds; the number of blocks grows with the table.
ROWS_PER_BLOCK = 500_000


def blocked(df: DataFrame, order: str | list[str], rows: int = 0) -> tuple[DataFrame, str]:
    """(``df`` frozen in ranges of ``order``, name of the new column that numbers the ranges).

    The ranges are cut at sampled quantiles, so they hold about ``rows`` rows each (ROWS_PER_BLOCK if 0) however the
    values lie: one far value doesn't widen them. Each row is written together with its range's number, so a task that
    is computed again can't move a row. Ranges are numbered in ``order``, which should be unique.
    """
    order = [order] if isinstance(order, str) else order
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // (rows or ROWS_PER_BLOCK)))
    (name,) = fresh(df.columns, "_block")
    return stored(df.repartitionByRange(parts, *order).withColumn(name, F.spark_partition_id()), "blocked")[0], name


def running_total(df: DataFrame, order: list[str], value: str, out: str, rows: int = 0) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows before this one in ``order`` (exclusive prefix).

    The rows are frozen in ranges (``blocked``). Sums per range (as many rows as ranges) are prefix-summed, and each
    range adds its own running sum. ``order`` must be unique for a defined result; null values count as 0.
    """
    frozen, block = blocked(df, order, rows)
    before, upto = fresh([*frozen.columns, out], "_before", "_upto")
    amount = F.coalesce(F.col(value).cast("long"), F.lit(0).cast("long"))
    sums = frozen.groupBy(F.col(block).alias("b")).agg(F.sum(amount).alias("s"))
    offsets = sums.select("b", (F.sum("s").over(Window.orderBy("b")) - F.col("s")).alias(before))
    inside = Window.partitionBy(block).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = frozen.withColumn(upto, F.sum(amount).over(inside) - amount).join(F.broadcast(offsets), F.col(block) == F.col("b"), "left")  # a row per range
    return joined.withColumn(out, F.col(before) + F.col(upto)).select(*[c for c in df.columns if c != out], out)


def running(df: DataFrame, key: str | list[str], order: str | list[str], block: str, sums: dict[str, Column] | None = None, maxima: dict[str, Column] | None = None, before: bool = False) -> DataFrame:
    """Add running sums and maxima per key in ``order`` (up to and with the row), as a window would, but in pieces.

    The column ``block`` (see ``blocked``) cuts every key into pieces that are monotone in ``order``, which must be
    unique within the key. States per (key, block) are combined along the blocks, and rows only meet rows of their own
    block. Null keys form one key. With ``before``, the row itself is left out (sums begin with 0, maxima with null).
    """
    order, keys = [order] if isinstance(order, str) else order, [key] if isinstance(key, str) else key
    amounts = {**{o: F.coalesce(c.cast("long"), F.lit(0).cast("long")) for o, c in (sums or {}).items()}, **(maxima or {})}
    taken = [*df.columns, *amounts]
    value, state, carry, local_ = (dict(zip(amounts, fresh(taken, *[f"{p}{o}" for o in amounts]), strict=True)) for p in ("_v_", "_s_", "_p_", "_l_"))
    names, (at,) = fresh(taken, *[f"_key{i}" for i in range(len(keys))]), fresh(taken, "_b")
    work = df.withColumns({value[o]: c for o, c in amounts.items()})
    fold = lambda o, c: F.sum(c) if o in (sums or {}) else F.max(c)
    states = work.groupBy(*keys, block).agg(*[fold(o, value[o]).alias(state[o]) for o in amounts])
    earlier = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carried = states.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(block).alias(at), *[fold(o, state[o]).over(earlier).alias(carry[o]) for o in amounts])
    inside = Window.partitionBy(*keys, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    local = work.withColumns({local_[o]: fold(o, value[o]).over(inside) for o in amounts})
    same = F.col(block).eqNullSafe(F.col(at))
    for k, n in zip(keys, names, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(n))
    joined, zero = local.join(carried, same), F.lit(0).cast("long")
    kinds = dict(work.dtypes)

    def both(o: str) -> Column:
        a, b = F.col(carry[o]), F.col(local_[o])
        if o in (sums or {}):
            return F.coalesce(a, zero) + F.coalesce(b, zero)
        return F.array_max(F.array(a, b)) if kinds[value[o]].startswith("struct") else F.greatest(a, b)

    return joined.select(*df.columns, *[both(o).alias(o) for o in amounts])


def previous(df: DataFrame, key: str, order: str | list[str], block: str, values: dict[str, Column]) -> DataFrame:
    """Add the values of the row before this one of the same key in ``order``, across blocks; null at a key's first row."""
    held = F.struct(*[F.col(c).alias(f"_at{i}") for i, c in enumerate([order] if isinstance(order, str) else order)], *[c.alias(o) for o, c in values.items()])
    (last,) = fresh(df.columns, "_last")
    out = running(df, key, order, block, maxima={last: held}, before=True)
    return out.select(*df.columns, *[F.col(last)[o].alias(o) for o in values])


def number_rows(df: DataFrame, key: str, order: str | list[str], block: str, out: str, weight: str | None = None) -> DataFrame:
    """Add ``out``: the row's number (from 0) within its key by ``order``; with ``weight``, the sum of the weights of
    the rows before it instead. See ``running`` for how keys are cut."""
    amount = F.coalesce(F.col(weight).cast("long"), F.lit(0).cast("long")) if weight else F.lit(1).cast("long")
    return running(df, key, order, block, {out: amount}).withColumn(out, (F.col(out) - amount).cast("long"))
