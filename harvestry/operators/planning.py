"""Resumable fetch planning: which of a universe of URLs to fetch, given what is known of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def known_state(df: DataFrame, url: str, order: str) -> DataFrame:
    """``url, status, retries, has_pdf`` per URL: best by (200, retries), last wins; any row with documents counts."""
    rows = df.where(F.col(url).isNotNull())
    ok = F.coalesce(F.col("status_code") == 200, F.lit(False))
    g = rows.groupBy(F.col(url).alias("url")).agg(
        F.max_by(F.struct("status_code", "retries"), F.struct(ok, F.coalesce("retries", F.lit(0)), F.col(order))).alias("b"),
        F.max(F.coalesce(F.col("status_code") == 200, F.lit(False)) & (F.coalesce("pdf_links_count", F.lit(0)) > 0)).alias("has_pdf"),
    )
    return g.select("url", F.col("b.status_code").alias("status"), F.col("b.retries").alias("retries"), "has_pdf")


def plan(universe: DataFrame, state: DataFrame, mode: str, resample: bool = False) -> DataFrame:
    """URLs of ``universe(url)`` to fetch under a mode:

    ``full`` all; ``retry`` not 200, or 200 without documents if ``resample``; ``retry_only`` the same among known
    ones; ``resume`` without documents, and not 200 unless ``resample``; ``fresh`` without documents;
    ``unseen`` not known at all; ``failed`` not 200, known or not; ``failed_only`` known and not 200.
    A URL without state counts as not 200.
    """
    if mode == "full":
        return universe
    if mode == "unseen":
        return universe.join(state.select("url"), "url", "left_anti")
    if mode == "fresh":
        return universe.join(state.where("has_pdf").select("url"), "url", "left_anti")
    how = "inner" if mode in ("retry_only", "failed_only") else "left"
    j = universe.join(state.select("url", "status", "has_pdf"), "url", how)
    bad, pdf = ~F.col("status").eqNullSafe(F.lit(200)), F.coalesce("has_pdf", F.lit(False))
    if mode in ("failed", "failed_only"):
        keep = bad
    elif mode in ("retry", "retry_only"):
        keep = bad | (F.lit(resample) & ~pdf)
    elif mode == "resume":
        keep = ~pdf & (bad | F.lit(resample))
    else:
        raise ValueError(f"unknown mode {mode}")
    return j.where(keep).select("url")


def pages_to_fetch(pages: DataFrame, totals: DataFrame, slug: str = "collection_slug") -> DataFrame:
    """Listing pages from the last recorded one + 1 up to the total, per collection; gaps stay."""
    last = pages.groupBy(slug).agg(F.max("page_number").alias("last"))
    j = totals.join(last, slug, "left").withColumn("from", F.coalesce("last", F.lit(0)) + 1).where(F.col("from") <= F.col("total_pages"))
    return j.select(slug, F.explode(F.sequence("from", "total_pages")).alias("page_number"))


def eligible(cols: DataFrame, min_items: int = 1000) -> DataFrame:
    """Collections large enough with any Greek or unstated language; nulls count as 0."""
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    return cols.where(F.col("collection_slug").isNotNull() & (z("item_count") >= min_items) & ((z("pct_ELL") > 0) | (z("pct_NONE") > 0))).select("collection_slug").distinct()


def work_rows(rows: DataFrame, slugs: DataFrame) -> DataFrame:
    """Rows of the selected collections in Greek or unstated language with a link."""
    return rows.where(F.col("language_code").isin("ELL", "NONE") & F.col("external_link").isNotNull() & (F.col("external_link") != "")).join(slugs, "collection_slug", "left_semi")


def fan_out(rows: DataFrame, results: DataFrame, on: str, inner: bool = False) -> DataFrame:
    """Results per URL back to every row; rows without one get status -3 and zeros."""
    j = rows.join(results, on, "inner" if inner else "left")
    z = lambda c, v: F.coalesce(F.col(c), F.lit(v)).alias(c)
    return j.select(*rows.columns, z("status_code", -3), z("elapsed_s", 0.0), z("pdf_links_count", 0), z("retries", 0))


def needs_discovery(link: Column, force: bool = False) -> Column:
    """No usable link yet: blank, missing or the text "not found"."""
    t = F.lower(F.trim(F.coalesce(link, F.lit(""))))
    return F.lit(force) | (t == "") | (t == "not found")


def overwrite_probe(old: Column, new: Column, old_elapsed: Column, new_elapsed: Column) -> Column:
    """The status to keep: new if there was none, it differs, or an earlier time is known and differs."""
    return F.when(old.isNull() | (old != new) | (old_elapsed.isNotNull() & (old_elapsed != new_elapsed)), new).otherwise(old)
