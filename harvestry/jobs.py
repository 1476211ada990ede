"""Whole flows from files to files, as functions and as ``python -m harvestry.jobs NAME --option value ...``.

Each returns the small report that it also prints. Paths may lead to any file system that Spark knows.
"""

from __future__ import annotations

import argparse
import inspect
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.functions import html as H
from harvestry.functions import text as T
from harvestry.operators import labels, merge, mining, planning, profiles, runs
from harvestry.session import stored
from harvestry.sources import fetch, sinks, tables

KEY = ["collection_slug", "page_number", "edm_url"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a rules file with their number: a file's lines stay in order only if it is read whole."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.split("value", r"\r?\n")).alias("ord", "value"))


def _there(spark: SparkSession, path: str) -> DataFrame | None:
    fs, target = sinks._fs(spark, path)
    return spark.read.parquet(path) if fs.exists(target) else None


def merge_shards(spark: SparkSession, master: str, shards: str, compression: str = "snappy", dry_run: bool = False) -> dict:
    """Merge all readable shards below a folder into the master, best row per key; a dry run only tells what it would add."""
    old, new = _there(spark, master), tables.shard_scan(spark, shards).drop("_file")
    rows = merge.union_ranked(([old] if old is not None else []) + [merge.best_of(new, KEY, merge.fetch_order())])
    best, _ = stored(merge.best_of(rows, KEY, merge.fetch_order("_src")).drop("_src"), "merged")
    ok = lambda f: f.where("status_code = 200").count()
    before = ok(merge.best_of(old, KEY, merge.fetch_order())) if old is not None else 0
    report = {"ok_before": before, "ok_after": ok(best), "written": not dry_run}
    if not dry_run:
        sinks.swap(best, master, compression)
    return report | {"gain": report["ok_after"] - before}


def label(spark: SparkSession, source: str, out: str, language_rules: str, type_rules: str) -> dict:
    """Label every record by its metadata: language code, type and whether its title is all English."""
    lang = labels.parse_language_rules(_lines(spark, language_rules)).select(T.normalized("lhs").alias("token"), F.col("code").alias("label"), "ord").where("token <> ''")
    kinds = labels.parse_type_rules(_lines(spark, type_rules)).select(F.explode("values").alias("v"), "label", "ord").select(T.normalized("v").alias("token"), "label", "ord").where("token <> ''")
    sinks.swap(labels.label_records(spark.read.parquet(source), "metadata_json", lang, kinds), out)
    done = spark.read.parquet(out)
    languages = {r["language_code"]: r["n"] for r in done.groupBy("language_code").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per code
    types = {r["type"]: r["n"] for r in profiles.top_counts(done, "type", 20).collect()}
    return {"rows": sum(languages.values()), "language_counts": languages, "type_counts_top": types, "title_all_english_true": done.agg(profiles.count_when(F.col("title_all_english"))).first()[0]}


def language_stats(spark: SparkSession, source: str, out: str, threshold: float = 0.8) -> dict:
    """Shares of Greek and unstated language per collection, as a table, and how many collections reach the threshold."""
    shares = profiles.language_shares(spark.read.parquet(source), threshold)
    sinks.swap(shares, out)
    return spark.read.parquet(out).agg(F.count(F.lit(1)).alias("collections"), F.count_if("ELL_high").alias("ell_high"), F.count_if("NONE_high").alias("none_high")).first().asDict()


def collection_summary(spark: SparkSession, source: str, out: str, top_n: int = 5) -> dict:
    """Totals, language shares and most frequent types per collection, as a table."""
    sinks.swap(profiles.collection_summary(spark.read.parquet(source), top_n), out)
    return {"collections": spark.read.parquet(out).count()}


def failure_report(spark: SparkSession, metrics: str, out: str, target_total: int = 830_313) -> dict:
    """Statistics, models and recommendations of one or more runs (metrics files below comma-separated paths), as JSON."""
    rows = None
    for k, path in enumerate(metrics.split(",")):
        own = tables.metrics_csv(spark, path).select(F.lit(f"run_{k + 1}").alias("run"), "completed", "failed", "fail_pct")
        rows = own if rows is None else rows.unionByName(own)
    rows, _ = stored(rows, "metrics")
    report, _ = stored(runs.run_report(rows, "run", target_total), "report")
    each = report.where("run <> 'combined'")
    told = runs.recommendations(each.select(F.explode("models.prediction").alias("prediction")), each.select(F.col("statistics.mean_acceleration").alias("mean_acceleration")), target_total)
    result = {"runs": [r.asDict(recursive=True) for r in report.orderBy("run").collect()], "recommendations": told.first().asDict()}  # a row per run
    sinks.write_text(spark, out, json.dumps(result, ensure_ascii=False, indent=2, default=str))
    return result["recommendations"]


def mine_tokens(spark: SparkSession, source: str, out: str, fraction: float = 0.8) -> dict:
    """Six-letter pieces of a frequency document's values: ranked lines, and the tokens that cover the fraction."""
    values = tables.frequencies(spark, source).select("value", F.xxhash64("value").alias("id"))
    sinks.to_tsv(mining.coverage(values, "id", "value"), f"{out}/ranked")
    cover = mining.greedy_cover(values, "id", "value", fraction)
    sinks.to_json(cover, f"{out}/cover.json")
    last = cover.agg(F.max("step"), F.max("covered")).first()
    return {"tokens": last[0] or 0, "covered": last[1] or 0, "values": values.count()}


def fetch_metadata(spark: SparkSession, links: str, out: str, limit: int = 0, concurrency: int = 15, timeout: float = 1.0, wait: float = 0.0, retries: int = 0, resume: bool = False, retry_only: bool = False, compression: str = "snappy", fetcher: fetch.Fetcher | None = None) -> dict:
    """Fetch and read the item pages of a table of links ``(collection_slug, collection_url, page_number, edm_url)``.

    With ``resume``, what ``out`` holds decides: without ``retries`` only unknown pages are asked for, with them also those that
    aren't 200 (``retry_only``: only those). Results are merged into ``out``; ``limit`` ends the list of pages after so many (0: all).
    """
    wanted = spark.read.parquet(links).where("edm_url IS NOT NULL").dropDuplicates(KEY)
    known = _there(spark, out) if resume else None
    universe = wanted.select(F.col("edm_url").alias("url")).distinct()
    if known is not None:
        best = merge.best_of(known.where("edm_url IS NOT NULL").select("edm_url", "status_code", "retries"), ["edm_url"], merge.fetch_order())
        state = best.select(F.col("edm_url").alias("url"), F.col("status_code").alias("status"), "retries", F.lit(False).alias("has_pdf"))
        universe = planning.plan(universe, state, ("failed_only" if retry_only else "failed") if retries > 0 else "unseen")
        universe = universe.join(state.select("url", F.col("retries").alias("earlier")), "url", "left")
    else:
        universe = universe.withColumn("earlier", F.lit(0).cast("long"))
    asked = universe.orderBy("url").limit(limit) if limit else universe
    pages = fetch.fetch(asked, fetcher or fetch.http_fetcher(timeout), fetch.Policy(retries=retries, wait=wait, concurrency=concurrency, done=(200,)), earlier="earlier")
    pages, _ = stored(pages, "pages")
    meta = F.map_filter(F.coalesce(H.html_metadata("body"), F.create_map().cast(T.MAP_TEXT)), lambda _, v: v != "")
    read = pages.withColumn("m", F.when(F.col("body").isNotNull(), meta)).select(F.col("url").alias("edm_url"), "status_code", "elapsed_s", F.when(F.col("body").isNotNull(), H.html_external_link("body", "url")).alias("external_link"), F.to_json("m").alias("metadata_json"), F.coalesce(F.size("m"), F.lit(0)).cast("long").alias("metadata_num_fields"), "retries")
    rows = wanted.select(*KEY, "collection_url").join(read, "edm_url")
    written = sinks.merge_into(rows, out, KEY, compression=compression)
    n = pages.agg(F.count(F.lit(1)).alias("fetched"), F.count_if(F.col("status_code") == 200).alias("ok")).first()
    return {"fetched": n["fetched"], "ok": n["ok"], "written": written}


def probe_links(spark: SparkSession, source: str, out: str, column: str = "external_link", concurrency: int = 15, timeout: float = 15.0, retries: int = 1, fetcher: fetch.Fetcher | None = None) -> dict:
    """Probe the distinct links of a table and count what they answer."""
    got = fetch.probe(spark.read.parquet(source), fetcher or fetch.http_fetcher(timeout), retries, column, fetch.Policy(concurrency=concurrency))
    sinks.swap(got, out)
    return {str(r["status_code"]): r["n"] for r in spark.read.parquet(out).groupBy("status_code").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per status


JOBS = {f.__name__.replace("_", "-"): f for f in (merge_shards, label, language_stats, collection_summary, failure_report, mine_tokens, fetch_metadata, probe_links)}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="harvestry.jobs", description=__doc__)
    sub = parser.add_subparsers(dest="job", required=True)
    for name, f in JOBS.items():
        p = sub.add_parser(name, help=inspect.getdoc(f))
        for k, v in list(inspect.signature(f).parameters.items())[1:]:
            if k != "fetcher":
                flag, none = f"--{k.replace('_', '-')}", v.default is inspect.Parameter.empty
                if isinstance(v.default, bool):
                    p.add_argument(flag, action="store_true")
                else:
                    p.add_argument(flag, required=none, default=None if none else v.default, type=str if none else type(v.default))
    args = vars(parser.parse_args(argv))
    report = JOBS[args.pop("job")](spark or SparkSession.builder.appName("harvestry").getOrCreate(), **args)
    print(json.dumps(report, ensure_ascii=False, indent=2, default=str))
    return report


if __name__ == "__main__":
    main()
