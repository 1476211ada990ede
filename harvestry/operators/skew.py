"""Per-key results where a handful of keys hold most rows (exact offset chunking)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestry.functions.prefix import blocked, number_rows
from harvestry.session import fresh, stored


def chunked(df: DataFrame, key: str, order: str, chunk_rows: int = 100_000, rows_per_block: int = 0) -> tuple[DataFrame, str, str]:
    """(``df`` with row number and chunk, their column names): pieces of exactly ``chunk_rows`` rows of each key by ``order``.

    The table is frozen in input partitions of about equal row counts (``blocked``: ranges of the unique ``order`` cut
    at sampled quantiles, however its values lie), keys are counted per partition, the counts are prefix-summed to
    offsets, and rows are numbered inside (key, partition). No task sees a whole key, whatever its share of the rows.
    """
    frozen, block = blocked(df, order, rows_per_block)
    number, chunk = fresh(frozen.columns, "_number", "_chunk")
    out = number_rows(frozen, key, order, block, number).withColumn(chunk, F.floor(F.col(number) / F.lit(chunk_rows)).cast("long"))
    return out.drop(block), number, chunk


def collection_results(rows: DataFrame, claims: DataFrame, top_n: int = 5, chunk_rows: int = 100_000) -> DataFrame:
    """Per collection: rows, languages, language switches, top types, claimed against found items.

    Each equal-sized chunk yields counts per (language, type) and an ordered boundary state (first and last language,
    switches inside); chunk states are merged in chunk order, adding a switch where two neighbours meet in different
    languages. ``claims`` may list a collection many times: its largest ``item_count`` is the claim. Null collections
    form one row with null slug; collections that only claim items come out with 0 rows; null types count as ``NA``.
    Types with equal counts are ordered by name. The numbered chunks are stored once and read by each aggregate.
    """
    base = rows.select("row_id", "collection_slug", F.coalesce("language_code", F.lit("")).alias("language"), F.coalesce("type", F.lit("NA")).alias("type"), "edm_url")
    pieces, number, chunk = chunked(base.drop("edm_url"), "collection_slug", "row_id", chunk_rows)
    pieces, _ = stored(pieces.select("collection_slug", F.col(chunk).alias("_chunk"), F.col(number).alias("_number"), "language", "type"), "chunks")
    slug = "collection_slug"
    # counts: pre-aggregated per chunk, merged per key
    per_chunk = pieces.groupBy(slug, "_chunk", "language", "type").agg(F.count(F.lit(1)).alias("n"))
    merged = per_chunk.groupBy(slug, "language", "type").agg(F.sum("n").alias("n"))
    languages = merged.groupBy(slug, "language").agg(F.sum("n").alias("n")).groupBy(slug).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_languages"), F.max_by("language", F.struct("n", "language")).alias("main_language"),
        F.sum(F.when(F.col("language") == "ELL", F.col("n")).otherwise(0)).alias("rows_ell"),
    )
    by_type = merged.groupBy(slug, "type").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy(slug).orderBy(F.desc("n"), "type"))
    top = by_type.withColumn("r", rank).where(F.col("r") <= top_n).groupBy(slug).agg(F.sort_array(F.collect_list(F.struct("r", "type", "n"))).alias("t"))
    top = top.select(slug, F.concat_ws("|", F.transform("t", lambda x: F.concat(x["type"], F.lit("="), x["n"].cast("string")))).alias("top_types"))
    # ordered boundary states: neighbours inside a chunk are joined by number, chunk ends are merged in order
    at = pieces.select(slug, "_chunk", "_number", "language")
    inner = at.withColumn("_prev", F.lag("language").over(Window.partitionBy(slug, "_chunk").orderBy("_number")))
    states = inner.groupBy(slug, "_chunk").agg(
        F.min_by("language", "_number").alias("first"), F.max_by("language", "_number").alias("last"),
        F.count_if(F.col("_prev").isNotNull() & (F.col("_prev") != F.col("language"))).alias("switches"),
    )
    met = F.lag("last").over(Window.partitionBy(slug).orderBy("_chunk"))
    switches = states.withColumn("_met", met).groupBy(slug).agg((F.sum("switches") + F.count_if(F.col("_met") != F.col("first"))).alias("language_switches"))
    # distinct items: de-duplicated by (key, item) first, so the count runs over small states
    items = base.where(F.col("edm_url").isNotNull()).select(slug, F.regexp_replace("edm_url", r"[?].*$", "").alias("u")).distinct().groupBy(slug).agg(F.count(F.lit(1)).alias("n_items"))
    claimed = claims.groupBy(slug).agg(F.max("item_count").alias("claimed_items"))
    out = languages
    for side in (top, switches, items):
        side = side.withColumnRenamed(slug, "_k")
        out = out.join(side, out[slug].eqNullSafe(side["_k"]), "left").drop("_k")
    side = claimed.withColumnRenamed(slug, "_k")
    out = out.join(side, out[slug].eqNullSafe(side["_k"]), "full_outer").withColumn(slug, F.coalesce(slug, "_k")).drop("_k")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(
        slug, zero("n_rows"), zero("n_items"), zero("n_languages"), "main_language", zero("rows_ell"), zero("language_switches"), "top_types", "claimed_items",
        (F.col("claimed_items") - F.coalesce("n_items", F.lit(0))).cast("long").alias("claimed_minus_found"),
    )
