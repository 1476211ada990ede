"""One surviving record per group of duplicates: Bayesian fusion with copy detection."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.urls import page_of, spelling_of
from harvestry.session import stored

#: Bits used of a number that stands for a set of sources (as many numbers as it takes), and sources counted against in one pass.
WORD, COUNTED = 62, 60
#: How many wrong values there are to choose from, prior of a copy, chance that a copier copies a value.
WRONG_VALUES, COPY_PRIOR, COPY_RATE = 8, 0.1, 0.8
OK = 200


def page_key(slug: Column, page: Column, url: Column) -> Column:
    """A text for (slug, page, page of the URL); null equals null and nothing else."""
    mark = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))
    return F.concat_ws("\u0001", mark(slug), mark(page), mark(page_of(url)))


def claims_by_page(df: DataFrame) -> tuple[DataFrame, list[int]]:
    """One row per item page with its claims, stored in the shared folder; and the sources, in order.

    A source is a crawl wave: the month in the shard name as ``yyyymm``, 0 for all other rows; there are as many as months.
    Claims are first aggregated per (page, source, status, spelling), so a page's list is bounded by sources x values
    however many rows it has, and a page that holds a third of all rows shrinks before the shuffle.
    """
    month = F.coalesce(F.regexp_extract("shard", r"__(\d{6})\d{2}_", 1).try_cast("int"), F.lit(0))
    key = page_key(F.col("collection_slug"), F.col("page_number"), F.col("edm_url"))
    rows = df.select(key.alias("_page"), month.alias("src"), F.col("status_code").alias("status"), F.coalesce("retries", F.lit(0)).cast("long").alias("retries"),
        spelling_of(F.col("edm_url")).alias("spelling"), F.col("row_id"),
    )
    # the key is made once per row and then stands for itself as 128 bits
    rows = rows.select(F.xxhash64(F.lit(1), "_page").alias("k1"), F.xxhash64(F.lit(2), "_page").alias("k2"), "src", "status", "retries", "spelling", "row_id")
    small = rows.groupBy("k1", "k2", "src", "status", "spelling").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("retries", "row_id")).alias("best"))
    pages = small.groupBy("k1", "k2").agg(F.collect_list(F.struct("src", "status", "spelling", "n", "best")).alias("claims"))
    pages, _ = stored(pages, "claims")
    sources = [r[0] for r in pages.select(F.explode("claims.src").alias("s")).distinct().orderBy("s").collect()]  # a row per month
    return pages, sources


def _value(c: Column) -> Column:
    return F.coalesce(c["status"], F.lit(-999).cast("long"))


def _weight_of(sources: list[int], weights: list[float]) -> Column:
    """``map`` of source to weight; a source unknown to it weighs nothing."""
    pairs = [F.lit(x) for s, w in zip(sources, weights, strict=True) for x in (s, float(w))]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<int,double>")


def _scores(weights: Column) -> Column:
    """Log-posterior per status of a page, up to a constant: whether a 200 is claimed (certain, see ``fuse_pages``), and the
    discounted votes of the sources that claim the status (each source once)."""
    values = F.array_distinct(F.transform("claims", _value))

    def score(v: Column) -> Column:
        sources = F.array_distinct(F.transform(F.filter("claims", lambda c: _value(c) == v), lambda c: c["src"]))
        votes = F.aggregate(sources, F.lit(0.0), lambda a, s: a + F.coalesce(F.try_element_at(weights, s), F.lit(0.0)))
        return F.struct(F.when(v == OK, F.lit(1)).otherwise(0).alias("ok"), votes.alias("votes"), v.alias("v"))

    return F.transform(values, score)


def source_weights(pages: DataFrame, sources: list[int], rounds: int = 2) -> tuple[list[float], list[float], list[float]]:
    """Accuracy, independence and vote weight of every source, estimated over all pages with several claims.

    Each round finds the likeliest value per page, then counts, per source, its right claims, and per pair of sources
    how often they share a true value, share a false one, or differ; no pairs of rows are formed: a claim row adds to
    one counter per source, COUNTED of them in one pass. Dependence is the posterior of copying given these counts (shared
    false values weigh most), and a source's votes are discounted by the chance that it copied. Counters of sources x sources
    size come to the driver.
    """
    n = len(sources)
    accuracy, free = [0.8] * n, [1.0] * n
    several = pages.where(F.size("claims") > 1)
    place = F.array(*[F.lit(s) for s in sources]) if sources else F.array().cast("array<int>")
    words = range(-(-n // WORD))
    at = lambda c: (F.array_position(place, c["src"]) - 1).cast("int")

    def members(keep) -> Column:  # noqa: ANN001
        """The set of sources of the claims kept, as an array of bit words."""
        kept = F.transform(F.filter("claims", keep), at)

        def word(w: int) -> Column:
            own = F.filter(kept, lambda i: F.floor(i / WORD) == w)
            return F.aggregate(own, F.lit(0).cast("long"), lambda a, i: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), (i % WORD).cast("int"))))

        return F.array(*[word(w) for w in words])

    for _ in range(rounds):
        best = several.select("claims", F.array_max(_scores(_weight_of(sources, _weights(accuracy, free))))["v"].alias("truth"))
        marked = best.select("claims", "truth", members(lambda c: F.lit(True)).alias("everyone"))
        one = marked.select("everyone", "truth", F.explode("claims").alias("c"), "claims")
        one = one.select(at(F.col("c")).alias("src"), "everyone", (_value(F.col("c")) == F.col("truth")).alias("true"), members(lambda x: _value(x) == _value(F.col("c"))).alias("same"))
        has = lambda c, j: F.call_function("shiftrightunsigned", F.get(c, F.lit(j // WORD)), F.lit(j % WORD)).bitwiseAND(F.lit(1).cast("long"))
        counts: dict[int, dict] = {}
        for low in range(0, n, COUNTED):
            sums = [F.count(F.lit(1)).alias("n"), F.count_if("true").alias("t")]
            for j in range(low, min(n, low + COUNTED)):
                sums += [F.sum(F.when(F.col("true"), has("same", j)).otherwise(0)).alias(f"t{j}"), F.sum(F.when(~F.col("true"), has("same", j)).otherwise(0)).alias(f"f{j}"), F.sum(has("everyone", j)).alias(f"a{j}")]
            for r in one.groupBy("src").agg(*sums).collect():  # one row per source
                counts.setdefault(r["src"], {}).update(r.asDict())
        accuracy = [min(0.99, max(0.05, (counts[i]["t"] + 4) / (counts[i]["n"] + 5))) if i in counts else 0.8 for i in range(n)]
        free = [1.0] * n
        for i, c in counts.items():
            for j in counts:
                if i != j:
                    apart = max(0, (c[f"a{j}"] or 0) - (c[f"t{j}"] or 0) - (c[f"f{j}"] or 0))
                    copied = _dependence(accuracy[i], accuracy[j], c[f"t{j}"] or 0, c[f"f{j}"] or 0, apart)
                    free[i] *= 1 - COPY_RATE * max(0.0, copied - COPY_PRIOR) / (1 - COPY_PRIOR) / 2  # sources that never met say nothing
    return accuracy, free, _weights(accuracy, free)


def _weights(accuracy: list[float], free: list[float]) -> list[float]:
    return [max(0.01, f * math.log(WRONG_VALUES * a / (1 - a))) for a, f in zip(accuracy, free, strict=True)]


def _dependence(a: float, b: float, both_true: int, both_false: int, differ: int) -> float:
    """Posterior that two sources depend, from shared true values, shared false values and differences."""
    same_t, same_f = a * b, (1 - a) * (1 - b) / WRONG_VALUES
    c = COPY_RATE
    log = both_true * math.log(same_t / (c * b + (1 - c) * same_t)) + both_false * math.log(same_f / (c * (1 - b) + (1 - c) * same_f)) + differ * math.log(1 / (1 - c))
    return 1 / (1 + (1 - COPY_PRIOR) / COPY_PRIOR * math.exp(min(50.0, max(-50.0, log))))


def fuse_pages(df: DataFrame, rounds: int = 2, weights: list[float] | None = None) -> DataFrame:
    """One fused record per item page of ``df``: ``row_id, n_rows, n_sources, status_code, retries, spelling, url_row_id, confidence``.

    * ``status_code``: the value of greatest posterior. An answer 200 cannot be observed on a page that doesn't answer, so
      its likelihood under any other truth is 0 and a claimed 200 is certain; among failures the votes decide, weighed by
      source accuracy and discounted for copying; ties go to the greater code.
    * ``retries``: the counter only rises, so a claim above the truth has likelihood 0 and the greatest claim among the
      rows of the fused status is the likeliest. Null counts as 0.
    * ``spelling`` / ``url_row_id``: the way of writing the URL with most discounted votes, and the last row that uses it.
    * ``row_id``: the row whose values are likeliest by the merge order, which is a certain prior over rows: 200 before all
      others, then more retries, then later arrival. No vote can outweigh it, so the weights decide the fused values only;
      on a page without a 200 the kept row's own status may differ from the fused ``status_code``.
    * ``confidence``: the posterior of ``status_code`` against the other claimed values.

    ``weights`` (per source, in order) replace the estimated ones. Null slug, page and URL equal each other; repeated rows
    count as one vote of their source but in ``n_rows``; an empty table gives no rows; further columns are ignored.
    """
    pages, sources = claims_by_page(df)
    if weights is None:
        _, _, weights = source_weights(pages, sources, rounds)
    w = _weight_of(sources, weights)
    scored = pages.withColumn("scores", _scores(w)).withColumn("fused", F.array_max("scores"))
    agree = F.filter("claims", lambda c: (_value(c) == OK) == (F.col("fused.ok") == 1))
    best = F.array_max(F.transform(agree, lambda c: c["best"]))
    counter = F.array_max(F.transform(F.filter("claims", lambda c: _value(c) == F.col("fused.v")), lambda c: c["best"]["retries"]))
    forms = F.array_distinct(F.transform("claims", lambda c: c["spelling"]))
    voters = lambda v: F.array_distinct(F.transform(F.filter("claims", lambda c: c["spelling"] == v), lambda c: c["src"]))
    form = F.array_max(F.transform(forms, lambda v: F.struct(F.aggregate(voters(v), F.lit(0.0), lambda a, s: a + F.coalesce(F.try_element_at(w, s), F.lit(0.0))).alias("votes"), (-v).alias("plain"), v.alias("v"))))
    out = scored.withColumn("kept", best).withColumn("form", form).withColumn("counter", counter)
    votes = F.aggregate("scores", F.lit(0.0), lambda a, s: a + F.exp(F.least(s["votes"] - F.col("fused.votes"), F.lit(0.0))))
    return out.select(
        F.col("kept.row_id").alias("row_id"),
        F.aggregate("claims", F.lit(0).cast("long"), lambda a, c: a + c["n"]).alias("n_rows"),
        F.size(F.array_distinct(F.transform("claims", lambda c: c["src"]))).cast("long").alias("n_sources"),
        F.nullif("fused.v", F.lit(-999).cast("long")).alias("status_code"),
        F.col("counter").alias("retries"),
        F.col("form.v").cast("long").alias("spelling"),
        F.array_max(F.transform(F.filter("claims", lambda c: c["spelling"] == F.col("form.v")), lambda c: c["best"]["row_id"])).alias("url_row_id"),
        F.when(F.col("fused.ok") == 1, F.lit(1.0)).otherwise(1 / votes).alias("confidence"),
    )
