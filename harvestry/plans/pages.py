"""Queries over HTML, fetched pages, files and streams. The pages are written from table rows, so SQL knows what must come back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.functions import html as H
from harvestry.functions import text as T
from harvestry.operators import runs
from harvestry.plans.reference import KEY, OK, SRC, parts, samples, stages_sql, x
from harvestry.plans.registry import Registry, table
from harvestry.session import new_path
from harvestry.sources import sinks, tables
from harvestry.streaming import live

R = Registry()
BASE = "https://aggregator.example/portal/"


def item_pages(spark, d) -> DataFrame:
    """One item page per labelled row: a metadata panel, an external link and some documents."""
    row = table(spark, d, "edm_labeled")
    group = lambda name, c: F.concat(F.lit(f'<div class="form-group"><label class="item-label">{name}:</label><div class="item-control-static"> '), F.coalesce(c, F.lit("")), F.lit(" </div></div>"))
    safe = F.replace(F.replace(F.replace("type", F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    panel = F.concat(F.lit('<div class="form-horizontal fieldset container-fluid">'), group("Slug", F.col("collection_slug")), group("Page", F.col("page_number").cast("string")), group("Type", safe), group("Slug", F.lit("second")), F.lit("</div>"))
    link = F.when(F.col("external_link") != "", F.concat(F.lit('<a class="right-column-title-link x" href="'), F.col("external_link"), F.lit('">out</a>'))).otherwise("")
    docs = F.concat(F.lit('<a href="../bitstream/'), F.col("row_id").cast("string"), F.lit('/1.pdf">A  title</a><a href="#top">up</a><a href="/help">help</a><img src="/download/x"><a href="../bitstream/'), F.col("row_id").cast("string"), F.lit('/1.pdf">again</a>'))
    return row.select("row_id", "collection_slug", "page_number", "external_link", F.concat(F.lit("<html><head><title>T | "), F.coalesce("collection_slug", F.lit("none")), F.lit("</title></head><body><h1>H</h1>"), panel, link, docs, F.lit("</body></html>")).alias("html"))


@R.add("h11_external_link", "SELECT row_id, nullif(external_link, '') AS link FROM edm_labeled")
def h11(spark, d):
    return item_pages(spark, d).select("row_id", H.html_external_link("html", F.lit(BASE)).alias("link"))


@R.add("h12_metadata_panel", "SELECT row_id, coalesce(nullif(collection_slug, ''), 'second') AS slug, coalesce(CAST(page_number AS VARCHAR), '') AS page FROM edm_labeled")
def h12(spark, d):
    m = item_pages(spark, d).select("row_id", H.html_metadata("html").alias("m"))
    return m.select("row_id", F.col("m")["Slug"].alias("slug"), F.col("m")["Page"].alias("page"))


@R.add("h14_document_links", f"SELECT row_id, ['https://aggregator.example/bitstream/' || row_id || '/1.pdf', 'https://aggregator.example/download/x'] AS links FROM edm_labeled")
def h14(spark, d):
    return item_pages(spark, d).select("row_id", H.html_documents("html", F.lit(BASE)).alias("links"))


@R.add("h07_document_titles", "SELECT row_id, ['A title', 'again'] AS titles FROM edm_labeled")
def h07(spark, d):
    return item_pages(spark, d).select("row_id", H.html_pdf_titles("html").alias("titles"))


@R.add("h20_anchors", "SELECT row_id, CAST(4 + CASE WHEN external_link <> '' THEN 1 ELSE 0 END AS INTEGER) AS n, CASE WHEN external_link <> '' THEN external_link ELSE '../bitstream/' || row_id || '/1.pdf' END AS first FROM edm_labeled")
def h20(spark, d):
    a = item_pages(spark, d).select("row_id", H.html_anchors("html").alias("a"))
    return a.select("row_id", F.size("a").alias("n"), F.col("a")[0]["href"].alias("first"))


@R.add("x03_search_pages", "SELECT DISTINCT collection_url, collection_url || '/search?page.page=3&sortResults=SCORE' AS page FROM collections")
def x03(spark, d):
    return table(spark, d, "collections").select("collection_url", H.search_page_url("collection_url", F.lit(3)).alias("page")).distinct()


@R.add("x04_next_page", "SELECT DISTINCT collection_url, collection_url || '/search?page.page=4' AS page FROM collections")
def x04(spark, d):
    return table(spark, d, "collections").select("collection_url", H.next_page_url(H.search_page_url("collection_url", F.lit(3))).alias("page")).distinct()


@R.add("x02_url_join", "SELECT row_id, 'https://aggregator.example/bitstream/' || row_id AS url FROM edm_labeled")
def x02(spark, d):
    return table(spark, d, "edm_labeled").select("row_id", H.url_join(F.lit(BASE), F.concat(F.lit("../bitstream/"), F.col("row_id").cast("string"))).alias("url"))


@R.add("x10_total_pages", "SELECT collection_slug, CAST(greatest(1, ceil(item_count / 30.0)) AS BIGINT) AS pages, 'count' AS source FROM collections WHERE item_count IS NOT NULL")
def x10(spark, d):
    c = table(spark, d, "collections").where("item_count IS NOT NULL").withColumn("html", F.concat(F.lit("<b>"), F.format_number("item_count", 0), F.lit(" τεκμήρια</b>")))
    return c.select("collection_slug", T.total_pages(F.col("html")).alias("pages"), T.pages_source(F.col("html")).alias("source"))


@R.add("x12_retry_after", "SELECT row_id, CAST(coalesce(retries, 0) AS DOUBLE) AS wait FROM external_pdfs")
def x12(spark, d):
    return x(spark, d).select("row_id", T.retry_after(F.coalesce(F.col("retries").cast("string"), F.lit("soon")), F.current_timestamp()).alias("wait"))


@R.add("x25_progress", "SELECT run, completed, repeat('#', CAST(floor(least(1.0, completed / 10000.0) * 20) AS INTEGER)) || repeat('-', 20 - CAST(floor(least(1.0, completed / 10000.0) * 20) AS INTEGER)) AS bar, CAST(completed // 60 AS VARCHAR) || ':' || lpad(CAST(completed % 60 AS VARCHAR), 2, '0') AS eta FROM (SELECT " + SRC + " AS run, row_number() OVER (PARTITION BY " + SRC + " ORDER BY row_id) AS completed FROM external_pdfs) WHERE completed % 100 = 0")
def x25(spark, d):
    return samples(spark, d).select("run", "completed", T.progress_bar(F.col("completed"), F.lit(10000)).alias("bar"), T.eta_text(F.col("completed")).alias("eta"))


@R.add("s05_metrics_csv", f"WITH r AS (SELECT {SRC} AS run, row_number() OVER (PARTITION BY {SRC} ORDER BY row_id) AS completed FROM external_pdfs) SELECT completed, count(*) AS n FROM r WHERE completed % 100 = 0 GROUP BY 1")
def s05(spark, d):
    path = new_path(spark, "metrics")
    s = samples(spark, d)
    zero = F.lit(0).cast("long")
    s.select(zero.alias("t_epoch"), "completed", "failed", "fail_pct", F.lit(1.0).alias("speed_ps"), zero.alias("eta_s"), zero.alias("remaining")).write.option("header", "true").csv(path)
    return tables.metrics_csv(spark, path).groupBy("completed").agg(F.count(F.lit(1)).alias("n"))


@R.add("k04_merging_write", f"SELECT collection_slug, page_number, edm_url, status_code, row_id FROM (SELECT *, row_number() OVER (PARTITION BY collection_slug, page_number, edm_url ORDER BY {OK} DESC, coalesce(retries, 0) DESC, {SRC} DESC, row_id DESC) AS r FROM external_pdfs) WHERE r = 1")
def k04(spark, d):
    """The master is written, then the shards are merged into it; the table is read from where it was swapped in."""
    from harvestry.operators.merge import best_of, fetch_order

    path = new_path(spark, "master")
    old, new = (best_of(p.select(*KEY, "status_code", "retries", "row_id"), KEY, fetch_order("row_id")) for p in parts(spark, d))
    sinks.swap(old, path)
    sinks.merge_into(new, path, KEY)
    return spark.read.parquet(path).select(*KEY, "status_code", "row_id")


def streamed(spark, df: DataFrame, label: str, files: int = 0) -> DataFrame:
    """A table as a file stream, with so many files in a micro-batch (all if 0)."""
    path = new_path(spark, label)
    df.write.parquet(path)
    reader = spark.readStream.schema(df.schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


@R.add("z02_checkpoint_merge", f"SELECT collection_slug, page_number, edm_url, status_code, row_id FROM (SELECT *, row_number() OVER (PARTITION BY collection_slug, page_number, edm_url ORDER BY {OK} DESC, coalesce(retries, 0) DESC, row_id DESC) AS r FROM external_pdfs) WHERE r = 1")
def z02(spark, d):
    """All results as they came, repeated ones too, streamed into the master in several merging micro-batches."""
    path = new_path(spark, "live")
    rows = x(spark, d).select(*KEY, "status_code", "retries", "row_id")
    stream = streamed(spark, rows.repartitionByRange(3, "row_id"), "results", files=1)
    live.checkpoint_merge(stream, f"{path}/master", f"{path}/log", once=True, arrival="row_id").awaitTermination()
    return spark.read.parquet(f"{path}/master").select(*KEY, "status_code", "row_id")


@R.add("z16_failure_windows", "SELECT CAST(fetched_at AS DATE) AS start, count(*) AS n, count(*) FILTER (WHERE status_code IS DISTINCT FROM 200) AS failed FROM external_pdfs WHERE fetched_at IS NOT NULL GROUP BY 1")
def z16(spark, d):
    rows = x(spark, d).where("fetched_at IS NOT NULL").select("fetched_at", "status_code")
    windows = live.failure_windows(streamed(spark, rows, "events"), "fetched_at", "status_code", "1 day", late="30 days")
    told = live.drain(windows, new_path(spark, "windows"), "update")
    return told.groupBy(F.col("start").cast("date").alias("start")).agg(F.max("n").alias("n"), F.max_by("failed", "n").alias("failed"))


@R.add("z03_live_streaks", "WITH n AS (SELECT collection_slug, row_id, status_code IS NOT DISTINCT FROM -1 AS hit, row_number() OVER (PARTITION BY collection_slug ORDER BY row_id) AS k FROM external_pdfs WHERE collection_slug IS NOT NULL), s AS (SELECT *, k - coalesce(max(CASE WHEN NOT hit THEN k END) OVER (PARTITION BY collection_slug ORDER BY row_id), 0) AS streak FROM n) SELECT collection_slug, arg_max(streak, row_id) AS streak, max(streak) >= 3 AS tripped FROM s GROUP BY 1")
def z03(spark, d):
    """The streaks at the end of the stream; a key's rows of one micro-batch count in order."""
    rows = x(spark, d).where("collection_slug IS NOT NULL").select("collection_slug", "row_id", "status_code")
    return live.drain(live.live_streaks(streamed(spark, rows, "fetches"), "collection_slug", "row_id"), new_path(spark, "streaks"), "update")


@R.add("w12_negative_streaks", stages_sql("collection_slug", "(SELECT * FROM external_pdfs WHERE collection_slug IS NOT NULL)", 50, "key AS collection_slug, row_id"))
def w12(spark, d, every: int = 50):
    """Ticks of every collection, at each ``every``-th row and at its last, through the stage machine."""
    rows = x(spark, d).where("collection_slug IS NOT NULL").select("collection_slug", "row_id", "status_code", "external_link")
    t = runs.running_counts(runs.unique_counts(rows, "collection_slug", "external_link", "row_id"), "collection_slug", "row_id")
    ticks = runs.ticks(t.select("collection_slug", "row_id", "completed", "attempted", "ok", "failish"), "collection_slug", "completed", every)
    return runs.stage_machine(ticks, "collection_slug", "row_id")
