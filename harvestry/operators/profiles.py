"""Group profiles: shares, error rates, histograms, top-N lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_when(cond: Column) -> Column:
    """How many rows meet the condition (null: no)."""
    return F.count_if(F.coalesce(cond, F.lit(False)))


def language_shares(df: DataFrame, threshold: float = 0.8, slug: str = "collection_slug") -> DataFrame:
    """Per collection (null ones dropped): total, ELL, NONE, their shares, and whether a share reaches the threshold."""
    g = df.where(F.col(slug).isNotNull()).groupBy(slug).agg(F.count(F.lit(1)).alias("total"), count_when(F.col("language_code") == "ELL").alias("ELL"), count_when(F.col("language_code") == "NONE").alias("NONE"))
    g = g.withColumn("pct_ELL", F.col("ELL") / F.col("total")).withColumn("pct_NONE", F.col("NONE") / F.col("total"))
    return g.withColumn("ELL_high", F.col("pct_ELL") >= threshold).withColumn("NONE_high", F.col("pct_NONE") >= threshold)


def collection_summary(df: DataFrame, top_n: int = 5, slug: str = "collection_slug") -> DataFrame:
    """Totals, ELL/NONE counts and shares, and the ``top_n`` types with counts and shares; null types count as NA."""
    rows = df.where(F.col(slug).isNotNull()).select(slug, F.coalesce("language_code", F.lit("")).alias("language_code"), F.coalesce("type", F.lit("NA")).alias("type"))
    cells = rows.groupBy(slug, "type").agg(F.count(F.lit(1)).alias("n"), count_when(F.col("language_code") == "ELL").alias("e"), count_when(F.col("language_code") == "NONE").alias("o"))
    totals = cells.groupBy(slug).agg(F.sum("n").alias("total_items"), F.sum("e").alias("num_ELL"), F.sum("o").alias("num_NONE"))
    rank = F.row_number().over(Window.partitionBy(slug).orderBy(F.desc("n"), "type"))
    top = cells.withColumn("r", rank).where(F.col("r") <= top_n).groupBy(slug).agg(F.sort_array(F.collect_list(F.struct("r", "type", "n"))).alias("t"))
    j = totals.join(top, slug)
    pct = lambda a: F.col(a) / F.col("total_items")
    return j.select(
        slug, "total_items", "num_ELL", pct("num_ELL").alias("pct_ELL"), "num_NONE", pct("num_NONE").alias("pct_NONE"),
        F.transform("t", lambda x: x["type"]).alias("types_top"), F.transform("t", lambda x: x["n"]).alias("types_top_counts"),
        F.transform("t", lambda x: x["n"] / F.col("total_items")).alias("types_top_pcts"),
    )


def error_rate(df: DataFrame, by: list[str], groups: DataFrame | None = None) -> DataFrame:
    """Percent of rows that aren't 200, leaving out -3 and 404; 0 if nothing is left. Of ``groups`` (distinct ``by``), one
    without any row is at 100."""
    counted = ~F.coalesce(F.col("status_code").isin(-3, 404), F.lit(False))
    n, ok = count_when(counted), count_when(F.col("status_code") == 200)
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), n.alias("n_counted"), ok.alias("n_ok"))
    if groups is not None:
        g = groups.select(*[F.col(c).alias(f"_g_{c}") for c in by])
        same = F.lit(True)
        for c in by:
            same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
        zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
        out = g.join(out, same, "left").select(*[F.col(f"_g_{c}").alias(c) for c in by], zero("n_rows"), zero("n_counted"), zero("n_ok"))
    pct = F.when(F.col("n_rows") == 0, 100.0).when(F.col("n_counted") == 0, 0.0).otherwise((F.col("n_counted") - F.col("n_ok")) * 100.0 / F.col("n_counted"))
    return out.withColumn("error_pct", pct)


def merge_summaries(old: DataFrame, new: DataFrame, key: str, largest: list[str], first: list[str]) -> DataFrame:
    """Old and new summaries in one: the largest of the numeric columns, the first known value (old before new) of the others."""
    both = old.select(key, *largest, *first, F.lit(0).alias("_src")).unionByName(new.select(key, *largest, *first, F.lit(1).alias("_src")))
    return both.groupBy(key).agg(*[F.max(c).alias(c) for c in largest], *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_src"))).alias(c) for c in first])


def fleet_rollup(workers: DataFrame, queued: DataFrame | None = None) -> DataFrame:
    """One row over ``workers(target, attempted, speed)``: how many, what remains of theirs and of the ``queued(target)``, their
    speed together, and the time that takes (0 without speed)."""
    left = F.greatest(F.lit(0), F.coalesce("target", "attempted") - F.col("attempted"))
    g = workers.agg(F.count(F.lit(1)).alias("workers"), F.coalesce(F.sum(left), F.lit(0)).alias("remaining"), F.coalesce(F.sum(F.greatest(F.lit(0.0), F.col("speed"))), F.lit(0.0)).alias("speed"))
    waiting = queued.agg(F.coalesce(F.sum("target"), F.lit(0)).alias("queued")) if queued is not None else g.sparkSession.range(1).select(F.lit(0).cast("long").alias("queued"))
    j = g.join(waiting, F.lit(True))  # one row each
    return j.select("workers", "remaining", "queued", "speed", F.when(F.col("speed") > 1e-6, (F.col("remaining") + F.col("queued")) / F.col("speed")).otherwise(0.0).alias("eta_s"))


def error_analysis(df: DataFrame, slug: str = "collection_slug") -> DataFrame:
    """Total, ok, fail, error percent and the most frequent failure (ties: the smaller code) per collection."""
    cells = df.where(F.col(slug).isNotNull() & F.col("status_code").isNotNull()).groupBy(slug, "status_code").agg(F.count(F.lit(1)).alias("n"))
    bad = F.col("status_code") != 200
    out = cells.groupBy(slug).agg(
        F.sum("n").alias("total"), F.sum(F.when(~bad, F.col("n")).otherwise(0)).alias("ok"),
        F.max(F.when(bad, F.struct("n", (-F.col("status_code")).alias("minus")))).alias("top"),
    )
    return out.select(slug, "total", "ok", (F.col("total") - F.col("ok")).alias("fail"), ((F.col("total") - F.col("ok")) * 100.0 / F.col("total")).alias("error_pct"), (-F.col("top.minus")).alias("top_error"), F.coalesce(F.col("top.n"), F.lit(0)).alias("top_error_count"))


def status_rank(c: Column) -> Column:
    """200, 404, server errors, negative codes, others: 0 to 4."""
    return F.when(c == 200, 0).when(c == 404, 1).when(c >= 500, 2).when(c < 0, 3).otherwise(4)


def unique_breakdown(df: DataFrame, by: list[str], url: str, order: str) -> DataFrame:
    """Best status per URL (by rank, then first seen; -3 left out), counted per group."""
    rows = df.where(F.col(url).isNotNull() & (F.col("status_code") != -3))
    best = rows.groupBy(*by, url).agg(F.min_by("status_code", F.struct(status_rank(F.col("status_code")), F.col(order))).alias("s"))
    return best.groupBy(*by).agg(
        F.count(F.lit(1)).alias("attempted"), count_when(F.col("s") == 200).alias("ok"), count_when(F.col("s") == 404).alias("n404"), count_when(F.col("s") >= 500).alias("n5xx"), count_when(F.col("s") < 0).alias("n_negative"),
    )


def top_counts(df: DataFrame, by: str, n: int) -> DataFrame:
    """The n most frequent values, nulls left out; ties by value."""
    return df.where(F.col(by).isNotNull()).groupBy(by).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), by).limit(n)


def describe(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles (linear) and maximum.

    The quartiles are exact: equal values are counted, their counts prefix-summed over ranges, and only the two values next to
    each quartile come together; no task holds all values.
    """
    from harvestry.functions.prefix import running_total

    c = F.col(col)
    basic = df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"))
    counts = df.where(c.isNotNull()).groupBy(c.alias("v")).agg(F.count(F.lit(1)).alias("k"))
    placed = running_total(counts, ["v"], "k", "before")
    marks = basic.select("n", F.explode(F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias("p")).withColumn("at", (F.col("n") - 1) * F.col("p"))  # three rows
    near = placed.join(F.broadcast(marks), (F.col("before") <= F.ceil("at")) & (F.col("before") + F.col("k") > F.floor("at")))
    low, high = F.max(F.when(F.col("before") <= F.floor("at"), F.col("v"))), F.max("v")
    share = F.first("at") - F.floor(F.first("at"))
    q = near.groupBy("p").agg((low + (high - low) * share).alias("q")).agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))])
    return basic.join(q, F.lit(True)).select("n", "mean", "std", "min", "p25", "p50", "p75", "max")  # one row each


def null_counts(df: DataFrame) -> DataFrame:
    """One row: how many nulls each column has."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def domain_rollup(df: DataFrame, host: Column) -> DataFrame:
    """Per host: completed, failed, elapsed, remaining, and the time that the rest takes at the pace so far."""
    done = F.col("status_code").isNotNull() & (F.col("status_code") != -3)
    g = df.groupBy(host.alias("host")).agg(
        count_when(done).alias("completed"), count_when(done & (F.col("status_code") != 200)).alias("failed"), F.sum(F.when(done, F.col("elapsed_s"))).alias("sum_elapsed"),
        count_when(~F.coalesce(done, F.lit(False))).alias("remaining"), F.min(F.when(done, F.col("fetched_at"))).alias("t0"), F.max(F.when(done, F.col("fetched_at"))).alias("t1"),
    )
    span = F.unix_micros("t1") - F.unix_micros("t0")
    return g.select("host", "completed", "failed", "sum_elapsed", "remaining", F.when((span > 0) & (F.col("completed") > 0), F.col("remaining") * (span / 1e6) / F.col("completed")).alias("eta_s"))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins from minimum to maximum, the right edge in the last one: ``bin`` (from 1), ``n``."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin bigint, n bigint")
    width = (hi - lo) / bins or 1.0
    place = F.least(F.floor((F.col(col) - F.lit(lo)) / F.lit(width)), F.lit(bins - 1)) + 1
    return df.where(F.col(col).isNotNull()).groupBy(place.cast("long").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
