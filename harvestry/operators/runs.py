"""Run metrics as time series, streaks, stage control and trend models."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from harvestry.functions.prefix import blocked, previous, running
from harvestry.operators.profiles import status_rank
from harvestry.session import stored

#: The column that numbers the blocks of a run's rows; samples keep it, so that they are folded in the same blocks.
BLOCK = "_run_block"
#: Bounds of the fitted curves ``a exp(b x) + c`` and ``a x^b + c`` over thousands of requests.
EXPONENTIAL, POWER = {"a": (0.0, 100.0), "b": (0.0, 0.1), "c": (0.0, 100.0)}, {"a": (0.0, 100.0), "b": (0.0, 2.0), "c": (-10.0, 10.0)}


def in_blocks(df: DataFrame, order: str | list[str]) -> DataFrame:
    """``df`` with BLOCK, frozen unless it has that column already."""
    if BLOCK in df.columns:
        return df
    frozen, name = blocked(df, order)
    return frozen.withColumnRenamed(name, BLOCK)


def running_counts(df: DataFrame, run: str, order: str, further: dict[str, Column] | None = None) -> DataFrame:
    """Completed and failed so far and the failure percent, per run in completion order (``order``: a unique bigint).

    A run may be the whole table: it is cut into blocks of about equal row counts, and only their sums are added along
    the run. ``further`` names more running sums. The blocks stay as a column for what follows.
    """
    failed = F.when(F.col("status_code").eqNullSafe(F.lit(200)), 0).otherwise(1)
    out = running(in_blocks(df, order), run, order, BLOCK, {"completed": F.lit(1), "failed": failed, **(further or {})})
    return out.withColumn("fail_pct", F.col("failed") * 100.0 / F.greatest(F.lit(1), F.col("completed")))


def sampled(counts: DataFrame, every: int = 100) -> DataFrame:
    """The sample taken at each ``every``-th completion."""
    return counts.where(F.col("completed") % every == 0)


def progress_marks(counts: DataFrame, run: str, every: int = 10) -> DataFrame:
    """``run, pct, completed``: where each run first reached each mark of its work, in steps of ``every`` percent."""
    totals = counts.groupBy(F.col(run).alias("_r")).agg(F.max("completed").alias("_total"))
    marks = totals.select("_r", "_total", F.explode(F.sequence(F.lit(every), F.lit(100), F.lit(every))).alias("pct")).withColumn("_need", F.greatest(F.lit(1), F.floor(F.col("pct") * F.col("_total") / 100.0)))
    j = counts.select(run, "completed").join(F.broadcast(marks), counts[run].eqNullSafe(F.col("_r")) & (F.col("completed") == F.col("_need")))  # a few rows per run
    return j.groupBy(run, "pct").agg(F.min("completed").alias("completed"))


def deltas(samples: DataFrame, run: str) -> DataFrame:
    """Change of the failure percent since the last sample and per request; the first is against 0. A run's samples are
    compared inside their blocks; only each block's last sample is carried to the next."""
    kept = previous(in_blocks(samples, "completed"), run, "completed", BLOCK, {"_pct": F.col("fail_pct"), "_n": F.col("completed")})
    d = F.col("fail_pct") - F.coalesce("_pct", F.lit(0.0))
    n = F.col("completed") - F.coalesce("_n", F.lit(0))
    return kept.withColumn("delta_fail_pct", d).withColumn("derivative", d / F.greatest(F.lit(1), n)).drop("_pct", "_n")


def projected(samples: DataFrame, total: int) -> DataFrame:
    """Linear projection of the failure percent to ``total`` requests, within 0..100, and its count (half to even)."""
    pct = F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("fail_pct") + F.col("derivative") * (F.lit(total) - F.col("completed"))))
    return samples.withColumn("project_fail_pct", pct).withColumn("project_fail_count", F.bround(F.col("project_fail_pct") / 100 * total).cast("long"))


def moving_rate(samples: DataFrame, run: str, n: int = 10) -> DataFrame:
    """Failure rate over the last ``n`` samples of each run."""
    w = Window.partitionBy(run).orderBy(F.desc("completed"))
    last = samples.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    return last.groupBy(run).agg(((F.max("failed") - F.min("failed")) / F.greatest(F.lit(1), F.max("completed") - F.min("completed"))).alias("moving_rate"), F.count(F.lit(1)).alias("n_samples"))


def acceleration(samples: DataFrame, run: str, order: str | list[str] = "completed") -> DataFrame:
    """Mean and population deviation of the change of the derivative."""
    kept = previous(in_blocks(samples, order), run, order, BLOCK, {"_before": F.col("derivative")})
    return kept.withColumn("_d", F.col("derivative") - F.col("_before")).groupBy(run).agg(F.avg("_d").alias("mean_acceleration"), F.stddev_pop("_d").alias("std_acceleration"))


def ema(samples: DataFrame, run: str, value: str, order: str, alpha: float = 0.3) -> DataFrame:
    """Exponential moving average at the end of each run of values that are never below 0 (speeds), seeded anew whenever
    it is 0; null counts as 0.

    Each block becomes one state: its number of samples, its average from 0, and its average seeded at its first value
    above 0. States are applied to each other along the run: as values aren't negative, an average is 0 only until the
    first value above 0.
    """
    s = in_blocks(samples.select(run, order, F.coalesce(value, F.lit(0.0)).cast("double").alias("_x"), *[c for c in samples.columns if c == BLOCK]), order)
    numbered = s.withColumn("_k", F.row_number().over(Window.partitionBy(run, BLOCK).orderBy(order)))
    whole = Window.partitionBy(run, BLOCK)
    numbered = numbered.withColumn("_n", F.count(F.lit(1)).over(whole)).withColumn("_f", F.min(F.when(F.col("_x") > 0, F.col("_k"))).over(whole))
    fade = F.pow(F.lit(1 - alpha), F.col("_n") - F.col("_k"))
    first = F.when(F.col("_k") == F.col("_f"), fade * F.col("_x")).when(F.col("_k") > F.col("_f"), alpha * fade * F.col("_x"))
    states = numbered.groupBy(run, BLOCK).agg(F.first("_n").alias("n"), F.sum(alpha * fade * F.col("_x")).alias("b"), F.sum(first).alias("seeded"))
    line = states.groupBy(run).agg(F.array_sort(F.collect_list(F.struct(BLOCK, "n", "b", "seeded"))).alias("s"))  # a state per block of samples
    step = F.aggregate("s", F.lit(0.0), lambda a, x: F.when(a == 0, F.coalesce(x["seeded"], F.lit(0.0))).otherwise(F.pow(F.lit(1 - alpha), x["n"]) * a + x["b"]))
    return line.select(run, step.alias("ema"))


def timeout_streaks(df: DataFrame, key: str, order: str, code: int = -1) -> DataFrame:
    """``streak``: how many rows in a row, up to this one, ended with ``code``, per key (``order``: a unique bigint).

    The streak is the row's number less that of the last other row; both run over blocks, so a hot key is split.
    """
    hit = F.col("status_code").eqNullSafe(F.lit(code))
    numbered = running(in_blocks(df, order), key, order, BLOCK, {"_number": F.lit(1)})
    out = running(numbered, key, order, BLOCK, maxima={"_reset": F.when(~hit, F.col("_number"))})
    return out.withColumn("streak", F.col("_number") - F.coalesce("_reset", F.lit(0))).drop("_number", "_reset", BLOCK)


def stopped_at(streaks: DataFrame, key: str, order: str, threshold: int) -> DataFrame:
    """Where each key first reached the threshold; keys that never did are left out."""
    return streaks.where(F.col("streak") >= threshold).groupBy(key).agg(F.min(order).alias("stopped_at"))


def skip_after_stop(streaks: DataFrame, key: str, order: str, threshold: int, code: int = -1) -> DataFrame:
    """Every row of a key behind the one where its streak first reached the threshold gets ``code``; the others stay.
    A key is stopped once: one row per key is joined back (null keys are one key)."""
    stops = stopped_at(streaks, key, order, threshold).withColumnRenamed(key, "_key")
    j = streaks.join(stops, streaks[key].eqNullSafe(stops["_key"]), "left")
    return j.withColumn("status_code", F.when(F.col(order) > F.col("stopped_at"), F.lit(code)).otherwise(F.col("status_code"))).drop("_key", "stopped_at")


def abort_point(df: DataFrame, key: str | None, order: str, ratio: float = 0.99, at_least: int = 1000, code: int = 500) -> DataFrame:
    """The first row at which the share of ``code`` exceeds ``ratio`` after ``at_least`` requests, per key, or over the
    whole table where ``key`` is None (one row, null if the point is never reached)."""
    rows = in_blocks(df, order).withColumn("_all", F.lit(0))
    out = running(rows, key or "_all", order, BLOCK, {"_n": F.lit(1), "_b": F.when(F.col("status_code") == code, 1).otherwise(0)})
    over = out.where((F.col("_n") >= at_least) & (F.col("_b") / F.col("_n") > ratio))
    return (over.groupBy(key) if key else over).agg(F.min(order).alias("abort_at"))


def cancelled(df: DataFrame, order: str, ratio: float = 0.99, at_least: int = 1000, code: int = 500, mark: int = -3) -> DataFrame:
    """The global abort: every row behind the abort point of the whole table counts as never sent (``mark``)."""
    at = abort_point(df, None, order, ratio, at_least, code)
    return df.join(F.broadcast(at), F.lit(True)).withColumn("status_code", F.when(F.col(order) > F.col("abort_at"), F.lit(mark)).otherwise(F.col("status_code"))).drop("abort_at")  # one row


def ticks(counts: DataFrame, key: str, number: str, every: int) -> DataFrame:
    """The rows of each key whose ``number`` (1, 2, ... within the key) is a multiple of ``every``, and the key's last
    row, so that neither a key with fewer rows nor the tail is lost."""
    rest = [c for c in counts.columns if c != key]
    tick = F.floor((F.col(number) - 1) / every).alias("_tick")
    return counts.groupBy(key, tick).agg(F.max_by(F.struct(*rest), number).alias("_row")).select(key, "_row.*")


def unique_counts(df: DataFrame, key: str, url: str, order: str) -> DataFrame:
    """Adds ``attempted, ok, failish``: URLs of the key tried so far, and how many of them stand at 200, or at a failure
    other than 404, by their best status so far (rank, then first seen). Rows of status -3, null status or without a URL
    add nothing. Each row adds the change that it makes to its URL's best status; both steps run over blocks.
    """
    s, rows = F.col("status_code"), in_blocks(df, order)
    seen = F.when(F.col(url).isNotNull() & s.isNotNull() & (s != -3), F.struct((-status_rank(s)).alias("r"), (-F.col(order)).alias("o"), s.alias("s")))
    bests = running(rows, [key, url], order, BLOCK, maxima={"_was": seen}, before=True).withColumn("_own", seen)
    now = F.when(F.col("_was").isNull() | (F.col("_own.r") > F.col("_was.r")), F.col("_own.s")).otherwise(F.col("_was.s"))
    bests = bests.select(*rows.columns, F.col("_was.s").alias("_old"), F.when(F.col("_own").isNotNull(), now).alias("_new"))
    bad = lambda c: F.when((c < 0) | ((c >= 400) & (c != 404)), 1).otherwise(0)
    good = lambda c: F.when(c == 200, 1).otherwise(0)
    old, new = F.col("_old"), F.col("_new")
    change = lambda f: F.when(new.isNotNull(), f(new) - f(old)).otherwise(0)
    return running(bests, key, order, BLOCK, {"attempted": F.when(new.isNotNull() & old.isNull(), 1).otherwise(0), "ok": change(good), "failish": change(bad)}).drop("_old", "_new")


def stage_machine(ticks: DataFrame, key: str, order: str) -> DataFrame:
    """Back-off stages per worker over its ticks ``(attempted, ok, failish)``, cumulative; one transition per tick at most.

    A->B at 300 attempts in the stage with 20 % of all attempts failing, B->C at 30 %; none where a column ``target`` says
    that all is attempted. A tick with at least 200 attempts since the last tick of which none succeeded and 95 % failed
    (against the last tick that was judged) adds to the negative streak, else it resets; at 1000 the worker is lowered once,
    the second time dropped, which ends it. Ticks are sorted by worker and folded one after another as they stream
    through a task, so a long history takes time but no memory.
    """
    kinds = dict(ticks.dtypes)
    target = "target" in kinds

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, stage, base, last, streak, lowered, dropped, judged = object(), "A", 0, 0, 0, False, False, (0, 0)
        for pdf in batches:
            out = []
            for k, at, tried, good, bad, goal in zip(pdf[key], pdf[order], pdf["attempted"], pdf["ok"], pdf["failish"], pdf["target"] if target else [None] * len(pdf), strict=True):
                k = None if pd.isna(k) else k
                if k != now:
                    now, stage, base, last, streak, lowered, dropped, judged = k, "A", 0, 0, 0, False, False, (0, 0)
                if dropped:
                    continue
                pct = 100.0 * bad / tried if tried else 0.0
                if (goal is None or pd.isna(goal) or tried < goal) and tried - base >= 300 and (stage == "A" and pct >= 20 or stage == "B" and pct >= 30):
                    stage, base = ("B" if stage == "A" else "C"), tried
                new = max(0, tried - last)
                if new >= 200:
                    streak = streak + new if good <= judged[0] and max(0, bad - judged[1]) / new >= 0.95 else 0
                    judged = (good, bad)
                last = tried
                if streak >= 1000:
                    dropped, lowered, streak = lowered, True, streak if lowered else 0
                out.append((k, at, stage, streak, lowered, dropped))
            yield pd.DataFrame(out, columns=[key, order, "stage", "negative_streak", "lowered", "dropped"])

    sorted_ticks = ticks.repartition(F.col(key)).sortWithinPartitions(key, order)
    return sorted_ticks.mapInPandas(fold, f"{key} {kinds[key]}, {order} {kinds[order]}, stage string, negative_streak bigint, lowered boolean, dropped boolean")


def linear_models(samples: DataFrame, run: str, target: int, positive: bool = False) -> DataFrame:
    """Slope, intercept, r2, p value (two-sided t test of the slope) and standard error of the failure percent over
    completions, and the value at ``target``; with ``positive`` over the samples above 0 in both."""
    samples = samples.where("completed > 0 AND fail_pct > 0") if positive else samples
    y, x = F.col("fail_pct"), F.col("completed").cast("double")
    g = samples.groupBy(run).agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.regr_sxx(y, x).alias("sxx"), F.regr_syy(y, x).alias("syy"), F.regr_sxy(y, x).alias("sxy"), F.count(F.lit(1)).alias("n"))
    error = F.when((F.col("n") > 2) & (F.col("sxx") > 0), F.sqrt(F.greatest(F.lit(0.0), (F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx")) / (F.col("n") - 2) / F.col("sxx"))))
    g = g.withColumn("stderr", error).withColumn("p_value", _two_sided(F.col("slope") / F.nullif("stderr", F.lit(0.0)), F.col("n") - 2))
    return g.select(run, "n", "slope", "intercept", "r2", F.coalesce("p_value", F.when(F.col("stderr") == 0, F.lit(0.0))).alias("p_value"), "stderr", (F.col("intercept") + F.col("slope") * target).alias("at_target"))


@F.pandas_udf(DoubleType())
def _two_sided(t: pd.Series, freedom: pd.Series) -> pd.Series:
    """Chance of a t value at least this far from 0: the incomplete beta function by its continued fraction."""

    def one(t: float, v: float) -> float | None:
        if t is None or t != t or v is None or v < 1:
            return None
        x, a, b = v / (v + t * t), v / 2, 0.5
        if x >= 1:
            return 1.0
        front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) if x > 0 else 0.0
        flip = x > (a + 1) / (a + b + 2)
        p, q, z = (b, a, 1 - x) if flip else (a, b, x)
        c, d = 1.0, 1 / ((1 - (p + q) * z / (p + 1)) or 1e-300)
        h = d
        for m in range(1, 400):
            for top in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
                d, c = 1 / ((1 + top * d) or 1e-300), (1 + top / c) or 1e-300
                h *= d * c
            if abs(d * c - 1) < 1e-14:
                break
        part = front * h / p
        return min(1.0, max(0.0, 1 - part if flip else part))

    return pd.Series([one(x, v) for x, v in zip(t, freedom, strict=True)], dtype="float64")


def _boxed(n: float, e: float, ee: float, ey: float, y: float, yy: float, a_box: tuple, c_box: tuple) -> tuple[float, float, float]:
    """(squared error, a, c) of the best ``a f + c`` inside the box, from the sums of f, f^2, f y, y and y^2."""
    cost = lambda a, c: a * a * ee + n * c * c + yy + 2 * a * c * e - 2 * a * ey - 2 * c * y
    clip = lambda v, box: min(box[1], max(box[0], v))
    det = n * ee - e * e
    tries = []
    if det > 1e-12 * max(1.0, n * ee):
        a, c = (n * ey - e * y) / det, (y * ee - e * ey) / det
        if a_box[0] <= a <= a_box[1] and c_box[0] <= c <= c_box[1]:
            tries.append((a, c))
    tries += [(a, clip((y - a * e) / n, c_box)) for a in a_box]
    tries += [(clip((ey - c * e) / ee, a_box) if ee else a_box[0], c) for c in c_box]
    return min((cost(a, c), a, c) for a, c in tries)


def _bounded(samples: DataFrame, run: str, power: bool, rounds: int = 5, points: int = 24) -> DataFrame:
    """``run, a, b, c`` of the bounded curve of least squared error over ``_x`` and ``_y``.

    For a given exponent the curve is linear, so its sums suffice: each round sums them at ``points`` exponents per run in
    one aggregation, takes the best box-constrained (a, c) of each, and goes on between the neighbours of the best exponent.
    Samples stay where they are; a run's state is one row.
    """
    box = POWER if power else EXPONENTIAL
    low, high = box["b"]
    start = np.append(0.0, np.geomspace(high * 1e-6, high, points - 1)) if not power else np.linspace(low, high, points)
    grid = samples.groupBy(run).agg(F.lit(start.tolist()).cast("array<double>").alias("_grid")).withColumnRenamed(run, "_run")
    kind = dict(samples.dtypes)[run]

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        r, best, tried = pdf.iloc[0], None, list(pdf.iloc[0]["_grid"])
        for i, b in enumerate(tried):
            sums = [float(r["n"]), *(float(r[f"{k}{i}"]) if r[f"{k}{i}"] is not None else math.nan for k in ("e", "ee", "ey")), float(r["y"]), float(r["yy"])]
            if all(math.isfinite(v) for v in sums):
                got = (*_boxed(*sums, box["a"], box["c"]), b, i)
                best = got if best is None or got[0] < best[0] else best
        if best is None:
            return pd.DataFrame([], columns=["_run", "a", "b", "c", "_grid"])
        i = best[4]
        near = np.linspace(tried[max(0, i - 1)], tried[min(len(tried) - 1, i + 1)], points)
        return pd.DataFrame([(r["_run"], best[1], best[3], best[2], near.tolist())], columns=["_run", "a", "b", "c", "_grid"])

    for _ in range(rounds):
        j = samples.join(grid.select("_run", "_grid"), samples[run].eqNullSafe(grid["_run"]))
        f = lambda i: F.pow(F.col("_x"), F.col("_grid")[i]) if power else F.exp(F.col("_x") * F.col("_grid")[i])
        sums = [F.count(F.lit(1)).alias("n"), F.sum("_y").alias("y"), F.sum(F.col("_y") * F.col("_y")).alias("yy"), F.first("_grid").alias("_grid")]
        for i in range(points):
            sums += [F.sum(f(i)).alias(f"e{i}"), F.sum(f(i) * f(i)).alias(f"ee{i}"), F.sum(f(i) * F.col("_y")).alias(f"ey{i}")]
        grid, _ = stored(j.groupBy("_run").agg(*sums).groupBy("_run").applyInPandas(choose, f"_run {kind}, a double, b double, c double, _grid array<double>"), "fit")
    return grid.select(F.col("_run").alias(run), F.array("a", "b", "c").alias("parameters"))


def _polynomials(samples: DataFrame, run: str) -> DataFrame:
    """``run, model, parameters`` (highest power first) of the least-squares polynomials of degree 2 and 3, from power sums."""
    kind = dict(samples.dtypes)[run]
    top = samples.groupBy(F.col(run).alias("_run")).agg(F.max("_x").alias("_top"))
    j = samples.join(top, samples[run].eqNullSafe(top["_run"])).withColumn("_u", F.col("_x") / F.nullif("_top", F.lit(0.0)))
    sums = j.groupBy("_run").agg(F.first("_top").alias("top"), *[F.sum(F.pow("_u", F.lit(k))).alias(f"u{k}") for k in range(7)], *[F.sum(F.pow("_u", F.lit(k)) * F.col("_y")).alias(f"v{k}") for k in range(4)])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        r, out = pdf.iloc[0], []
        for degree in (2, 3):
            if r["u0"] is not None and r["u0"] > degree and r["top"]:
                m = np.array([[float(r[f"u{i + k}"]) for k in range(degree + 1)] for i in range(degree + 1)])
                c, *_ = np.linalg.lstsq(m, np.array([float(r[f"v{i}"]) for i in range(degree + 1)]), rcond=None)
                out.append((r["_run"], f"polynomial_{degree}", [float(c[k] / r["top"] ** k) for k in range(degree, -1, -1)]))
        return pd.DataFrame(out, columns=[run, "model", "parameters"])

    return sums.groupBy("_run").applyInPandas(solve, f"{run} {kind}, model string, parameters array<double>")


def _curve(model: Column, p: Column, x: Column) -> Column:
    """Value of a model at ``x``."""
    poly = F.aggregate(p, F.lit(0.0), lambda acc, c: acc * x + c)
    return F.when(model.startswith("polynomial"), poly).when(model == "exponential", p[0] * F.exp(p[1] * x) + p[2]).otherwise(p[0] * F.pow(x, p[1]) + p[2])


def curve_models(samples: DataFrame, run: str, target: int) -> DataFrame:
    """Linear, polynomial, exponential and power-law models of the failure percent per run:
    ``run, model, prediction, failed_count, r_squared, parameters``.

    ``x`` counts thousands of requests. The bounds are those of EXPONENTIAL and POWER; the power law is fitted to the values
    shifted by their least one less 0.1 and shifted back; both predictions end at 100. The linear model has no
    ``r_squared``. A model that can't be fitted (too few samples) is left out; a run without samples has no rows. Fits
    need sums only, so a run may have any number of samples.
    """
    base, _ = stored(samples.where(F.col("completed").isNotNull() & F.col("fail_pct").isNotNull()).select(run, (F.col("completed") / 1000.0).alias("_x"), F.col("fail_pct").cast("double").alias("_y")), "samples")
    least = base.groupBy(F.col(run).alias("_r")).agg(F.min("_y").alias("_low"), F.avg("_y").alias("_mean"), F.count(F.lit(1)).alias("_n"))
    full = base.join(least, base[run].eqNullSafe(least["_r"])).where("_n > 2")
    shifted = full.where("_x > 0").select(run, "_x", (F.col("_y") - F.col("_low") + 0.1).alias("_y"))
    fits = _polynomials(base, run)
    fits = fits.unionByName(_bounded(full.select(run, "_x", "_y"), run, False).select(run, F.lit("exponential").alias("model"), "parameters"))
    fits, _ = stored(fits.unionByName(_bounded(shifted, run, True).select(run, F.lit("power_law").alias("model"), "parameters")), "fits")
    models = fits.join(least, fits[run].eqNullSafe(least["_r"])).select(F.col(run).alias("_run"), "model", "parameters", F.when(F.col("model") == "power_law", F.col("_low") - 0.1).otherwise(0.0).alias("_shift"), "_mean")
    at = lambda x: _curve(F.col("model"), F.col("parameters"), x) + F.col("_shift")
    j = base.join(models, base[run].eqNullSafe(models["_run"]))
    rest = j.groupBy("_run", "model").agg(F.sum(F.pow(F.col("_y") - at(F.col("_x")), F.lit(2))).alias("_off"), F.sum(F.pow(F.col("_y") - F.col("_mean"), F.lit(2))).alias("_all"), F.first("parameters").alias("parameters"), F.first("_shift").alias("_shift"))
    value = at(F.lit(target / 1000.0))
    curves = rest.select(F.col("_run").alias(run), "model", F.when(F.col("model").isin("exponential", "power_law"), F.least(value, F.lit(100.0))).otherwise(value).alias("prediction"), F.when(F.col("_all") > 0, 1 - F.col("_off") / F.col("_all")).otherwise(0.0).alias("r_squared"), "parameters")
    line = linear_models(samples, run, target).where("slope IS NOT NULL").select(run, F.lit("linear").alias("model"), F.col("at_target").alias("prediction"), F.lit(None).cast("double").alias("r_squared"), F.array("slope", "intercept").alias("parameters"))
    return line.unionByName(curves).select(run, "model", "prediction", (F.col("prediction") * target / 100).cast("long").alias("failed_count"), "r_squared", "parameters")


def ensemble(models: DataFrame, run: str, target: int) -> DataFrame:
    """Prediction of all models that have an ``r_squared``, weighed by it (0.1 at least): ``run, prediction, failed_count, components``."""
    w = F.greatest(F.lit(0.1), F.col("r_squared"))
    known = models.where("prediction IS NOT NULL AND r_squared IS NOT NULL")
    g = known.groupBy(run).agg((F.sum(w * F.col("prediction")) / F.sum(w)).alias("prediction"), F.count(F.lit(1)).alias("components"))
    return g.select(run, "prediction", (F.col("prediction") * target / 100).cast("long").alias("failed_count"), "components")


def recommendations(predictions: DataFrame, accelerations: DataFrame, target: int) -> DataFrame:
    """One row: mean and population deviation over all predictions of all runs, the interval of 95 %, the failures they
    stand for, and the flags ``high_failure`` (mean over 10) and ``accelerating`` (of more than half of the runs)."""
    g = predictions.where("prediction IS NOT NULL").agg(F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("mean"), F.stddev_pop("prediction").alias("std"))
    a = accelerations.agg(F.count(F.lit(1)).alias("runs"), F.count_if(F.col("mean_acceleration") > 0).alias("up"))
    j = g.join(a, F.lit(True))  # one row each
    m, sd = F.col("mean"), F.col("std")
    return j.select("n", "mean", "std", (m - 1.96 * sd).alias("low"), (m + 1.96 * sd).alias("high"), (m * target / 100).cast("long").alias("failures"), ((m + sd) * target / 100).cast("long").alias("failures_high"), (m > 10).alias("high_failure"), (F.col("up") * 2 > F.col("runs")).alias("accelerating"))


def run_report(samples: DataFrame, run: str, target: int, combined: str = "combined") -> DataFrame:
    """``run, statistics, models``: of each run and, where there are several, of all samples together (run ``combined``).

    The statistics are a struct of final numbers, ``models`` the fitted models and their ensemble as a list of structs.
    """
    rows = samples.select(F.col(run).cast("string").alias("run"), "completed", "failed", "fail_pct")
    told = deltas(rows, "run").drop(BLOCK).withColumn("_own", F.col("run"))
    several = rows.select("run").distinct().limit(2).count() > 1
    both, _ = stored(told.unionByName(told.withColumn("run", F.lit(combined))) if several else told, "runs")
    trend = acceleration(both, "run", ["completed", "_own"])
    models = curve_models(both, "run", target)
    models, _ = stored(models.unionByName(ensemble(models, "run", target).select("run", F.lit("ensemble").alias("model"), "prediction", "failed_count", F.lit(None).cast("double").alias("r_squared"), F.lit(None).cast("array<double>").alias("parameters"))), "models")
    stats = both.groupBy("run").agg(F.max("completed").alias("total_requests"), F.max("failed").alias("total_failed"), F.max_by("fail_pct", "completed").alias("final_fail_pct"), F.avg("fail_pct").alias("mean_fail_pct"), F.stddev_samp("fail_pct").alias("std_fail_pct"))
    listed = models.groupBy("run").agg(F.array_sort(F.collect_list(F.struct("model", "prediction", "failed_count", "r_squared", "parameters"))).alias("models"))  # six models a run
    return stats.join(trend, "run").join(listed, "run", "left").select("run", F.struct(*[c for c in stats.columns if c != "run"], "mean_acceleration", F.when(F.col("mean_acceleration") > 0, "accelerating").otherwise("decelerating").alias("trend")).alias("statistics"), "models")
