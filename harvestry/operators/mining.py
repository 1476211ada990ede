"""Token mining: coverage of six-letter pieces and greedy set cover."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.text import plain_greek
from harvestry.session import cut


def stems(value: Column, size: int = 6, prefix: bool = False) -> Column:
    """Distinct pieces of ``size`` letters of the words long enough; with ``prefix`` only their beginnings."""
    words = F.filter(F.transform(F.split(plain_greek(value), r"\s+"), lambda w: F.regexp_replace(w, r"[^\p{L}]", "")), lambda w: F.length(w) >= size)
    if prefix:
        return F.array_distinct(F.transform(words, lambda w: F.substring(w, 1, size)))
    pieces = F.transform(words, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - size + 1), lambda i: F.substr(w, i, F.lit(size))))
    return F.array_distinct(F.flatten(pieces))


def coverage(values: DataFrame, key: str, value: str, prefix: bool = False) -> DataFrame:
    """``token, n, fraction`` over all values: how many have the token."""
    total = values.count()
    flat = values.select(key, F.explode(stems(F.col(value), prefix=prefix)).alias("token"))
    return flat.groupBy("token").agg(F.count(F.lit(1)).alias("n")).withColumn("fraction", F.col("n") / F.lit(max(1, total)))


def ranked(tokens: DataFrame) -> DataFrame:
    """``rank`` from 1 by coverage, then by token, counted over ranges of tokens."""
    from harvestry.functions.prefix import running_total

    numbered = running_total(tokens.withColumn("_less", -F.col("n")).withColumn("_one", F.lit(1)), ["_less", "token"], "_one", "rank")
    return numbered.withColumn("rank", (F.col("rank") + 1).cast("long")).drop("_less", "_one")


def greedy_cover(values: DataFrame, key: str, value: str, fraction: float) -> DataFrame:
    """``step, token, gain, covered``: tokens that cover the fraction of values, by greatest gain at each step.

    Ties: the larger coverage, then the smaller token. Each step is one aggregation over the pairs still uncovered;
    only the chosen token comes to the driver.
    """
    spark = values.sparkSession
    pairs = cut(values.select(F.col(key).alias("k"), F.explode(stems(F.col(value))).alias("token")))
    size = pairs.groupBy("token").agg(F.count(F.lit(1)).alias("size"))
    target, covered, out = int(fraction * values.count()), 0, []
    left = pairs
    while covered < target:
        best = left.groupBy("token").agg(F.count(F.lit(1)).alias("gain")).join(size, "token").orderBy(F.desc("gain"), F.desc("size"), "token").limit(1).collect()
        if not best:
            break
        covered += best[0]["gain"]
        out.append((len(out) + 1, best[0]["token"], best[0]["gain"], covered))
        done = left.where(F.col("token") == best[0]["token"]).select("k")
        left = left.join(done, "k", "left_anti")
        if len(out) % 5 == 0:
            left = cut(left)
    return spark.createDataFrame(out, "step bigint, token string, gain bigint, covered bigint")
