"""Queries of fetching, files, reports and control. What they read is written first, from table rows, so SQL knows what must come back;
the network is a function of the URL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestry.functions import html as H
from harvestry.functions import text as T
from harvestry.operators import labels, mining, profiles, runs
from harvestry.plans.reference import LINT_RULES, OK, SAMPLES, SRC, lint_rules, parts, samples, x
from harvestry.plans.registry import Registry, table
from harvestry.session import new_path
from harvestry.sources import fetch, sinks, tables

R = Registry()
BASE = "https://aggregator.example/portal/"
LINKS = "(SELECT DISTINCT external_link AS url FROM edm_labeled WHERE external_link <> '')"


def links(spark, d) -> DataFrame:
    return table(spark, d, "edm_labeled").where("external_link <> ''").select(F.col("external_link").alias("url")).distinct()


def network(url: str, headers: dict[str, str], met: dict | None = None) -> fetch.Answer:
    """By the length of the URL: found, missing, timeout, failure, or busy at first and then found."""
    kind = len(url) % 5
    if kind == 4 and met is not None:
        met[url] = n = met.get(url, 0) + 1
        return (200, _item(url), None) if n > 1 else (503, None, 0.001)
    return [(200, _item(url), None), (404, None, None), (-1, None, None), (-2, None, None), (503, None, None)][kind]


def _item(url: str) -> str:
    field = '<div class="form-group"><label class="item-label">{}:</label><div class="item-control-static">{}</div></div>'
    return f'<h1>x</h1><a class="right-column-title-link" href="../next/{len(url)}">out</a><div class="form-horizontal fieldset container-fluid">{field.format("Length", len(url))}{field.format("Empty", "")}</div>'


def flaky():
    met: dict = {}
    return lambda url, headers: network(url, headers, met)


@R.add("s14_fetch", f"SELECT url, CASE length(url) % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN -1 WHEN 3 THEN -2 ELSE 503 END AS status_code, length(url) % 5 = 0 AS has_body FROM {LINKS}")
def s14(spark, d):
    """Every link asked for once, eight at a time in each task."""
    got = fetch.fetch(links(spark, d), network, fetch.Policy(concurrency=8))
    return got.select("url", "status_code", F.col("body").isNotNull().alias("has_body"))


@R.add("s15_busy_servers", f"SELECT url, CASE length(url) % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN -1 WHEN 3 THEN -2 ELSE 200 END AS status_code, 0 AS retries FROM {LINKS}")
def s15(spark, d):
    """A busy server is asked once more after its Retry-After, within the same attempt."""
    return fetch.fetch(links(spark, d), flaky(), fetch.Policy(concurrency=4, agent_mode="per_domain")).select("url", "status_code", "retries")


@R.add("r13_retries", f"SELECT url, CASE length(url) % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN -1 WHEN 3 THEN -2 ELSE 503 END AS status_code, length(url) % 3 + CASE WHEN length(url) % 5 <= 1 THEN 0 ELSE 2 END AS retries FROM {LINKS}")
def r13(spark, d):
    """Attempts end at 200 or 404; the retries written are those before and those now."""
    urls = links(spark, d).withColumn("earlier", F.length("url") % 3)
    return fetch.fetch(urls, network, fetch.Policy(retries=2, concurrency=4), earlier="earlier").select("url", "status_code", "retries")


@R.add("s17_session_policy", f"SELECT url, CASE length(url) % 5 WHEN 4 THEN 3 ELSE 0 END AS retries FROM {LINKS}")
def s17(spark, d):
    """The session's policy repeats on busy and broken servers only."""
    import dataclasses

    policy = dataclasses.replace(fetch.SESSION, backoff=0.0, concurrency=8)
    return fetch.fetch(links(spark, d), network, policy).select("url", "retries")


@R.add("s16_item_pages", f"SELECT url, length(url) % 5 = 0 AS found, CASE WHEN length(url) % 5 = 0 THEN regexp_replace(url, '^(https?://[^/]*).*$', '\\1/') IS NOT NULL END AS has_link, CASE WHEN length(url) % 5 = 0 THEN CAST(length(url) AS VARCHAR) END AS stated, CASE WHEN length(url) % 5 = 0 THEN 1 ELSE 0 END AS n FROM {LINKS}")
def s16(spark, d):
    got = fetch.fetch_items(links(spark, d), network, fetch.Policy(concurrency=8))
    return got.select("url", (F.col("status_code") == 200).alias("found"), F.when(F.col("status_code") == 200, F.col("external_link").isNotNull()).alias("has_link"), F.try_element_at("metadata", F.lit("Length")).alias("stated"), F.col("metadata_num_fields").alias("n"))


@R.add("s13_snapshots", f"SELECT url, length(url) % 5 = 0 OR length(url) % 2 = 0 AS found, length(url) % 2 = 0 AS from_snapshot FROM {LINKS}")
def s13(spark, d):
    """Half of the pages are in the snapshots; the rest is fetched and added to them, and then read from there."""
    path = new_path(spark, "snapshots")
    sinks.append_snapshots(links(spark, d).where(F.length("url") % 2 == 0).select("url", F.lit("kept").alias("body")), path)
    pages, fresh = fetch.with_snapshots(links(spark, d), spark.read.parquet(path), network, fetch.Policy(concurrency=8))
    sinks.append_snapshots(fresh, path)
    return pages.select("url", (F.col("status_code") == 200).alias("found"), F.coalesce(F.col("body") == "kept", F.lit(False)).alias("from_snapshot"))


@R.add("k10_snapshots_kept", f"SELECT count(*) AS n, count(*) FILTER (WHERE length(url) % 2 = 0) AS kept FROM {LINKS} WHERE length(url) % 5 = 0 OR length(url) % 2 = 0")
def k10(spark, d):
    path = new_path(spark, "snapshots")
    sinks.append_snapshots(links(spark, d).where(F.length("url") % 2 == 0).select("url", F.lit("kept").alias("body")), path)
    _, fresh = fetch.with_snapshots(links(spark, d), spark.read.parquet(path), network)
    sinks.append_snapshots(fresh, path)
    sinks.append_snapshots(fresh, path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("body") == "kept").alias("kept"))


@R.add("s18_probe", f"SELECT url, CASE length(url) % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 0 WHEN 3 THEN -1 ELSE 503 END AS status_code FROM {LINKS}")
def s18(spark, d):
    """Probing with one further round for what isn't 200."""
    return fetch.probe(links(spark, d), network, rounds=1).select("url", "status_code")


# ---- files ---------------------------------------------------------------------------------------------------------


def metrics_files(spark, d) -> list[str]:
    """A metrics file per run, as a crawl leaves it, with a broken line at the end."""
    s = samples(spark, d)
    left = F.lit(1_000_000) - F.col("completed")
    lines = s.select("run", "completed", F.concat_ws(",", F.lit(0), "completed", "failed", F.round("fail_pct", 4), F.lit(2.0), (left / 2).cast("string"), left.cast("string")).alias("line"))
    paths = []
    for r in s.select("run").distinct().orderBy("run").collect():  # a row per metrics file
        folder = new_path(spark, "metrics")
        own = lines.where(F.col("run") == r["run"])
        head = spark.createDataFrame([("t_epoch,completed,failed,fail_pct,speed_ps,eta_s,remaining", -1)], "line string, completed bigint")
        tail = spark.createDataFrame([("1,2,broken", 1 << 60)], "line string, completed bigint")
        head.unionByName(own.select("line", "completed")).unionByName(tail).repartition(1).sortWithinPartitions("completed").select("line").write.text(folder)
        paths += [f.getPath().toString() for f in _files(spark, folder)]
    return paths


def _files(spark, folder: str) -> list:
    p = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return [f for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p) if f.getPath().getName().startswith("part-")]


_LAST = f"(SELECT run, max(completed) AS completed FROM {SAMPLES} GROUP BY run)"


@R.add("s06_last_metrics_line", f"SELECT completed, (1000000 - completed) / 2 AS eta_s FROM {_LAST}")
def s06(spark, d):
    return tables.tail_metrics(spark, metrics_files(spark, d)).select("completed", "eta_s")


@R.add("s07_metrics_snapshot", f"SELECT completed, (1000000 - completed) / 2 AS eta_s, 2.0 AS speed_ps, 1000000 - completed AS remaining FROM {_LAST}")
def s07(spark, d):
    return tables.tail_metrics(spark, [*metrics_files(spark, d)]).drop("path")


@R.add("k06_metrics_appended", f"SELECT run, count(*) AS n, max(completed) AS completed FROM {SAMPLES} GROUP BY run")
def k06(spark, d):
    """Each run's lines appended to one folder, then read as one table."""
    path = new_path(spark, "metrics")
    for run in (0, 1):
        own = samples(spark, d).where(F.col("run") == run)
        sinks.append_metrics(own.select(F.lit(run).cast("long").alias("t_epoch"), "completed", "failed", "fail_pct", F.lit(1.0).alias("speed_ps"), F.lit(0).cast("long").alias("eta_s"), F.lit(0).cast("long").alias("remaining")), path)
    return tables.metrics_csv(spark, path).groupBy(F.col("t_epoch").cast("int").alias("run")).agg(F.count(F.lit(1)).alias("n"), F.max("completed").alias("completed"))


@R.add("s04_shard_scan", "SELECT regexp_extract(shard, '__([0-9]{6})', 1) AS month, count(*) AS n FROM external_pdfs GROUP BY 1")
def s04(spark, d):
    """A folder of shards, among them an empty one and one that can't be read."""
    path = new_path(spark, "shards")
    rows = x(spark, d).select("row_id", "status_code", F.regexp_extract("shard", r"__(\d{6})", 1).alias("month"))
    rows.repartition("month").write.parquet(path)
    rows.limit(0).coalesce(1).write.mode("append").parquet(path)
    sinks.write_text(spark, f"{path}/part-99999-broken.parquet", "no table")
    return tables.shard_scan(spark, path).groupBy("month").agg(F.count(F.lit(1)).alias("n"))


CONFIG = '{"thymari_hub": {"per_concurrency": 5, "wait": 9.0}, "ydria_theses": {"per_concurrency": 2, "wait": 1.0, "force_http1": true}, "thymari_hub": {"per_concurrency": 3, "wait": 0.5, "retries": 2}}'


@R.add("s11_settings_file", "SELECT * FROM (VALUES ('thymari_hub', 3, CAST(0.5 AS DOUBLE), 2, NULL), ('ydria_theses', 2, CAST(1 AS DOUBLE), NULL, true)) v(slug, per_concurrency, wait, retries, force_http1)")
def s11(spark, d):
    path = new_path(spark, "settings") + ".json"
    sinks.write_text(spark, path, CONFIG)
    return tables.overrides_file(spark, path).select("slug", "per_concurrency", "wait", "retries", "force_http1")


@R.add("s12_frequency_document", "SELECT value, length(value) AS n FROM type_values")
def s12(spark, d):
    """Counts written as one JSON document and read again."""
    path = new_path(spark, "frequencies") + ".json"
    rows = table(spark, d, "type_values").select("value", F.length("value").alias("n")).collect()  # the vocabulary, a few hundred rows
    import json

    sinks.write_text(spark, path, json.dumps({"values_sorted": [[r["value"], r["n"]] for r in rows]}, ensure_ascii=False, indent=2))
    return tables.frequencies(spark, path)


@R.add("k08_ranked_tokens", "WITH w AS (SELECT value_id, regexp_replace(unnest(string_split_regex(translate(lower(trim(value)), 'άέήίόύώϊϋΐΰς', 'αεηιουωιυιυσ'), '\\s+')), '[^\\p{L}]', '', 'g') AS w FROM type_values), p AS (SELECT DISTINCT value_id, substr(w, 1, 6) AS token FROM w WHERE length(w) >= 6) SELECT count(*) || chr(9) || printf('%.4f', count(*) / (SELECT count(*) FROM type_values)) || chr(9) || token AS line FROM p GROUP BY token")
def k08(spark, d):
    path = new_path(spark, "tokens")
    sinks.to_tsv(mining.coverage(table(spark, d, "type_values"), "value_id", "value", prefix=True), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@R.add("k03_compressed", "SELECT codec, (SELECT count(*) FROM collections) AS n FROM (VALUES ('snappy'), ('zstd'), ('gzip'), ('none')) v(codec)")
def k03(spark, d):
    out = None
    for codec in ("snappy", "zstd", "gzip", "none"):
        path = new_path(spark, "codec")
        sinks.swap(table(spark, d, "collections"), path, codec)
        one = spark.read.parquet(path).agg(F.lit(codec).alias("codec"), F.count(F.lit(1)).alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


@R.add("k11_backup", "SELECT collection_slug, item_count FROM collections WHERE item_count IS NOT NULL")
def k11(spark, d):
    """The master is copied, then replaced by nothing; the copy is what comes back."""
    rows, path = table(spark, d, "collections").where("item_count IS NOT NULL").select("collection_slug", "item_count"), new_path(spark, "master")
    sinks.swap(rows, path)
    copy = sinks.backup_copy(spark, path, new_path(spark, "backups"))
    sinks.swap(rows.limit(0), path)
    return spark.read.parquet(copy)


@R.add("r15_nothing_new", f"SELECT count(*) AS n, false AS written FROM external_pdfs WHERE {OK}")
def r15(spark, d):
    """A run without results leaves the master as it is."""
    path = new_path(spark, "master")
    rows = x(spark, d).where("status_code = 200").select("row_id", "collection_slug", "status_code", "retries")
    sinks.swap(rows, path)
    written = sinks.merge_into(rows.limit(0), path, ["row_id"])
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n"), F.lit(written).alias("written"))


# ---- rules ---------------------------------------------------------------------------------------------------------

EDITS = [(1, "merge", 2, None, "1"), (2, "relabel", None, "[[X]] ", ""), (3, "mark", 5, None, "[[D]]"), (4, "mark", None, "Δ", "[[X]]"), (5, "mark", 6, None, "[[X]]")]


@R.add("l06_rewritten_rules", """WITH r AS (SELECT label_id AS ord, CASE WHEN label_id % 4 = 0 THEN '[[X]] ' ELSE '' END || label_el || ' -> ' || label_en || ' : ["' || label_el || '"' || CASE WHEN label_id = 2 THEN ', "' || (SELECT label_el FROM type_labels WHERE label_id = 1) || '"' ELSE '' END || ']' AS line FROM type_labels)
SELECT ord, CASE WHEN line LIKE '[[X]] %' THEN substr(line, 7) WHEN ord = 5 THEN '[[D]] ' || line WHEN line LIKE 'Δ%' OR ord = 6 THEN '[[X]] ' || line ELSE line END AS value FROM r""")
def l06(spark, d):
    """A table of edits made to rule lines; written as a rules file and read again (k09)."""
    t, i = table(spark, d, "type_labels"), F.col("label_id")
    lines = t.select(i.alias("ord"), F.concat(F.when(i % 4 == 0, "[[X]] ").otherwise(""), "label_el", F.lit(" -> "), "label_en", F.lit(' : ["'), "label_el", F.lit('"]')).alias("value"))
    edits = spark.createDataFrame(EDITS, "step int, action string, line bigint, prefix string, text string")
    path = new_path(spark, "rules")
    done = labels.rewrite_rules(lines, edits)
    sinks.to_lines(done.withColumn("text", F.concat(F.col("ord").cast("string"), F.lit("\t"), "value")), path, ["ord"], "text")
    back = spark.read.text(path)
    return back.select(F.split_part("value", F.lit("\t"), F.lit(1)).cast("long").alias("ord"), F.regexp_extract("value", r"^\d+\t(.*)$", 1).alias("value"))


@R.add("l08_short_tokens", f"SELECT line, token FROM {LINT_RULES} WHERE NOT marked AND length(token) <= 2")
def l08(spark, d):
    return labels.lint(lint_rules(spark, d)).where("section = 'short token'").select(F.col("value").alias("line"), F.col("a").alias("token"))


# ---- pages ---------------------------------------------------------------------------------------------------------


def collection_pages(spark, d) -> DataFrame:
    """A page per listed collection, in four shapes: with a breadcrumb, with a named container, with a marked element, with neither."""
    c = table(spark, d, "collections").where("collection_slug IS NOT NULL").groupBy("collection_slug").agg(F.min("institution_slug").alias("inst"), F.max("item_count").alias("n"))
    k = F.length("collection_slug") % 4
    crumb = F.concat(F.lit('<ul class="breadcrumb"><li><a href="/">In '), "inst", F.lit("</a></li></ul>"))
    box = F.concat(F.lit('<div id="containerId"><span class="institution-name x">Box '), "inst", F.lit("</span></div>"))
    mark = F.concat(F.lit('<p data-testid="repository-name">Mark '), "inst", F.lit("</p>"))
    head = F.when(k == 3, "").otherwise(F.concat(F.lit('<h1 class="page-title"> The <b>'), "collection_slug", F.lit("</b></h1>")))
    where = F.when(k == 0, crumb).when(k == 1, box).when(k == 2, mark).otherwise("")
    link = F.when(k == 3, "").otherwise(F.concat(F.lit('<a href="/portal/institutions/'), "inst", F.lit('"> Of '), "inst", F.lit("</a>")))
    count = F.when(F.col("n").isNotNull(), F.concat(F.lit("<p>"), F.format_number("n", 0), F.lit(" τεκμήρια</p>"))).otherwise("")
    docs = F.lit("<a href='/portal/edm/2'>b</a><a href='/portal/edm/1'>a</a><a href='../edm/2'>b</a>")
    html = F.concat(F.lit("<html><head><title>Portal | "), "collection_slug", F.lit("</title></head><body>"), where, head, link, count, docs, F.lit("</body></html>"))
    return c.select("collection_slug", "inst", "n", k.alias("k"), F.concat(F.lit(BASE + "collections/"), "collection_slug").alias("url"), html.alias("html"))


_C = "(SELECT collection_slug, min(institution_slug) AS inst, max(item_count) AS n, length(collection_slug) % 4 AS k FROM collections WHERE collection_slug IS NOT NULL GROUP BY 1)"


@R.add("h04_item_links", f"SELECT collection_slug, ['https://aggregator.example/portal/edm/2', 'https://aggregator.example/portal/edm/1'] AS links FROM {_C}")
def h04(spark, d):
    return collection_pages(spark, d).select("collection_slug", H.html_links("html", "url").alias("links"))


@R.add("h05_headings", f"SELECT collection_slug, CASE WHEN k < 3 THEN 'The ' || collection_slug END AS collection_name, CASE k WHEN 0 THEN 'In ' || inst WHEN 1 THEN 'Box ' || inst WHEN 2 THEN 'Mark ' || inst END AS institution_name FROM {_C}")
def h05(spark, d):
    p = collection_pages(spark, d)
    return p.select("collection_slug", H.html_collection_name("html").alias("collection_name"), H.html_institution_name("html").alias("institution_name"))


@R.add("h10_institution_name", f"SELECT collection_slug, CASE WHEN k < 3 THEN 'The ' || collection_slug ELSE collection_slug END AS name, CASE WHEN k < 3 THEN 'heading' ELSE 'title' END AS found_in FROM {_C}")
def h10(spark, d):
    return collection_pages(spark, d).select("collection_slug", H.html_named_institution("html").alias("i")).select("collection_slug", "i.name", "i.found_in")


@R.add("h13_collection_detail", f"SELECT collection_slug, CASE WHEN k < 3 THEN inst END AS institution_slug, CASE WHEN k < 3 THEN 'Of ' || inst END AS institution_name, CASE WHEN k < 3 THEN 'The ' || collection_slug END AS collection_name, CASE WHEN k < 3 THEN n END AS item_count FROM {_C}")
def h13(spark, d):
    """The row of a collection that no institution lists, from its own page; null where the page names no institution."""
    r = collection_pages(spark, d).select("collection_slug", H.html_collection_detail("html", "url").alias("r"))
    return r.select("collection_slug", "r.institution_slug", "r.institution_name", "r.collection_name", "r.item_count")


@R.add("h09_listed_collections", "SELECT institution_slug, list('https://aggregator.example/portal/collections/' || collection_slug ORDER BY collection_slug) AS urls, list(n ORDER BY collection_slug) AS counts FROM (SELECT institution_slug, collection_slug, max(item_count) AS n FROM collections WHERE institution_slug IS NOT NULL AND collection_slug IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
def h09(spark, d):
    """An institution's page lists its collections, each with its items in a block around it."""
    c = table(spark, d, "collections").where("institution_slug IS NOT NULL AND collection_slug IS NOT NULL").groupBy("institution_slug", "collection_slug").agg(F.max("item_count").alias("n"))
    count = F.when(F.col("n").isNotNull(), F.concat(F.lit('<div class="collection_type"><i>all</i><i class="lastText">'), F.format_number("n", 0), F.lit(" τεκμήρια</i></div>"))).otherwise("")
    one = F.concat(F.lit('<div><div><span><a class="x collection_title" href="collections/'), "collection_slug", F.lit('">'), "collection_slug", F.lit("</a></span></div>"), count, F.lit("</div>"))
    pages = c.groupBy("institution_slug").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("collection_slug", one.alias("h")))), lambda v: v["h"]), "").alias("html"))  # an institution's collections
    got = pages.select("institution_slug", H.html_collections("html", F.lit(BASE)).alias("c"))
    return got.select("institution_slug", F.col("c.url").alias("urls"), F.col("c.items").alias("counts"))


@R.add("h22_sentinel_report", "SELECT collection_slug, CAST(m - 1 AS BIGINT) AS fewer_links, n <> m AS cards_differ, false AS pagination_differs, m AS max_pages FROM (SELECT collection_slug, count(DISTINCT page_number) AS m, 1 AS n FROM edm_labeled WHERE collection_slug IS NOT NULL AND page_number IS NOT NULL GROUP BY 1)")
def h22(spark, d):
    """The first listing page against the last one: what differs in links, cards, pagination and stated counts."""
    rows = table(spark, d, "edm_labeled").where("collection_slug IS NOT NULL AND page_number IS NOT NULL").groupBy("collection_slug").agg(F.count_distinct("page_number").alias("m"))
    page = lambda n: F.concat(F.lit("<script>var maxPages = '"), F.col("m").cast("string"), F.lit("';</script>"), F.repeat(F.lit('<div class="edm-entity-result"><a href="/edm/1">i</a></div>'), n), F.lit("<a href='?page.page=2'>next</a>"))
    s = rows.select("collection_slug", H.html_page_signs(page(F.col("m").cast("int"))).alias("a"), H.html_page_signs(page(F.lit(1))).alias("b"))
    return s.select("collection_slug", (F.col("a.links") - F.col("b.links")).alias("fewer_links"), (F.col("a.cards") != F.col("b.cards")).alias("cards_differ"), (F.col("a.pagination") != F.col("b.pagination")).alias("pagination_differs"), F.col("b.max_pages").alias("max_pages"))


# ---- small functions -----------------------------------------------------------------------------------------------


@R.add("x21_safe_name", "SELECT DISTINCT collection_url, regexp_extract(regexp_replace(regexp_replace(collection_url, '[?#].*$', ''), '/+$', ''), '([^/]+)/+[^/]+$', 1) || '_' || regexp_extract(regexp_replace(collection_url, '/+$', ''), '([^/]*)$', 1) AS name FROM collections WHERE collection_url LIKE 'http%//%/%/%'")
def x21(spark, d):
    return table(spark, d, "collections").where("collection_url LIKE 'http%//%/%/%'").select("collection_url", T.safe_path_name(F.col("collection_url")).alias("name")).distinct()


@R.add("x22_agent_of_host", "SELECT host, 1 AS agents, true AS known FROM (SELECT DISTINCT coalesce(lower(regexp_extract(external_link, '^[a-zA-Z]+://([^/?#]*)', 1)), '') AS host FROM edm_labeled WHERE external_link <> '')")
def x22(spark, d):
    """A host gets the same user agent at every request."""
    from harvestry.functions.urls import domain_of

    hosts = links(spark, d).select(domain_of(F.col("url")).alias("host"), F.length("url").alias("n"))
    return hosts.withColumn("agent", T.agent_of_host("host")).groupBy("host").agg(F.count_distinct("agent").cast("int").alias("agents"), F.bool_and(F.col("agent").isin(fetch.AGENTS)).alias("known"))


@R.add("x24_jitter", "SELECT collection_slug, true AS within, true AS spread FROM (SELECT DISTINCT collection_slug FROM collections)")
def x24(spark, d):
    c = table(spark, d, "collections").select("collection_slug").distinct().withColumn("w", T.jittered(F.lit(0.3), 7))
    spread = c.agg((F.stddev_pop("w") > 0.01).alias("spread"))  # one row
    return c.select("collection_slug", F.col("w").between(0.3 * 0.8, 0.3 * 1.5).alias("within")).join(spread, F.lit(True))


@R.add("x31_rounding", "SELECT row_id, round(elapsed_s, 1) AS a, CAST(round_even(elapsed_s * 100, 0) AS BIGINT) AS b, CAST(ceil(coalesce(retries, 0) / 3.0) AS BIGINT) AS c FROM external_pdfs WHERE elapsed_s IS NOT NULL")
def x31(spark, d):
    return x(spark, d).where("elapsed_s IS NOT NULL").select("row_id", F.round("elapsed_s", 1).alias("a"), F.rint(F.col("elapsed_s") * 100).cast("long").alias("b"), F.ceil(F.coalesce("retries", F.lit(0)) / 3.0).cast("long").alias("c"))


@R.add("x32_percent_text", "SELECT status_code, printf('%.1f', 100.0 * count(*) / (SELECT count(*) FROM external_pdfs)) || '%' AS share FROM external_pdfs WHERE status_code IS NOT NULL GROUP BY 1")
def x32(spark, d):
    rows = x(spark, d)
    total = rows.agg(F.count(F.lit(1)).alias("total"))  # one row
    return rows.where("status_code IS NOT NULL").groupBy("status_code").agg(F.count(F.lit(1)).alias("n")).join(total, F.lit(True)).select("status_code", T.percent_text(F.col("n"), F.col("total")).alias("share"))


@R.add("p04_columns", "SELECT row_id AS arrival, 'x' AS source, status_code FROM external_pdfs")
def p04(spark, d):
    """A column renamed, one put in front, others dropped."""
    return x(spark, d).withColumnRenamed("row_id", "arrival").withColumn("source", F.lit("x")).select("arrival", "source", "status_code")


@R.add("a33_table_shape", "SELECT count(*) AS n_rows, (SELECT string_agg(column_name, ',' ORDER BY i) FROM (SELECT column_name, row_number() OVER () AS i FROM (DESCRIBE external_pdfs))) AS columns FROM external_pdfs")
def a33(spark, d):
    t = x(spark, d)
    return t.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("columns", F.lit(",".join(t.columns)))


@R.add("j06_missing_collections", "SELECT url FROM (SELECT DISTINCT collection_url AS url FROM edm_metadata_full WHERE collection_url IS NOT NULL) WHERE url NOT IN (SELECT collection_url FROM collections WHERE item_count > 5000 AND collection_url IS NOT NULL)")
def j06(spark, d):
    """Collections of the index that aren't among the known ones."""
    index = table(spark, d, "edm_metadata_full").where("collection_url IS NOT NULL").select(F.col("collection_url").alias("url")).distinct()
    known = table(spark, d, "collections").where("item_count > 5000 AND collection_url IS NOT NULL").select(F.col("collection_url").alias("url"))
    return index.join(known, "url", "left_anti")


# ---- reports and control -------------------------------------------------------------------------------------------


def predictions(spark, d) -> DataFrame:
    """Predictions that SQL can make too: a straight line and the last value of each run."""
    s = samples(spark, d)
    line = runs.linear_models(s, "run", 1_000_000).select("run", F.lit("linear").alias("model"), F.col("at_target").alias("prediction"))
    return line.unionByName(s.groupBy("run").agg(F.lit("last").alias("model"), F.max_by("fail_pct", "completed").alias("prediction")))


@R.add("a24_recommendations", f"""WITH p AS (SELECT regr_intercept(fail_pct, completed) + regr_slope(fail_pct, completed) * 1000000 AS v FROM {SAMPLES} GROUP BY run UNION ALL SELECT arg_max(fail_pct, completed) FROM {SAMPLES} GROUP BY run)
SELECT count(*) AS n, round(avg(v), 5) AS mean, round(stddev_pop(v), 5) AS std, round(avg(v) - 1.96 * stddev_pop(v), 5) AS low, round(avg(v) + 1.96 * stddev_pop(v), 5) AS high, avg(v) > 10 AS high_failure FROM p""")
def a24(spark, d):
    r = runs.recommendations(predictions(spark, d), runs.acceleration(runs.deltas(samples(spark, d), "run"), "run"), 1_000_000)
    return r.select("n", *[F.round(c, 5).alias(c) for c in ("mean", "std", "low", "high")], "high_failure")


@R.add("d06_weighted_line", f"WITH m AS (SELECT run, regr_intercept(fail_pct, completed) + regr_slope(fail_pct, completed) * 1000000 AS a, regr_r2(fail_pct, completed) AS w, arg_max(fail_pct, completed) AS b FROM {SAMPLES} GROUP BY run) SELECT run, round((greatest(0.1, w) * a + 0.1 * b) / (greatest(0.1, w) + 0.1), 4) AS prediction, 2 AS components FROM m")
def d06_weighted_line(spark, d):
    """The ensemble over models that SQL has too: the straight line with its r2, and the last value with none to speak of."""
    s = samples(spark, d)
    line = runs.linear_models(s, "run", 1_000_000).select("run", F.lit("line").alias("model"), F.col("at_target").alias("prediction"), F.col("r2").alias("r_squared"))
    last = s.groupBy("run").agg(F.lit("last").alias("model"), F.max_by("fail_pct", "completed").alias("prediction"), F.lit(-0.5).alias("r_squared"))
    return runs.ensemble(line.unionByName(last), "run", 1_000_000).select("run", F.round("prediction", 4).alias("prediction"), F.col("components").cast("int").alias("components"))


@R.add("d10_run_report")
def d10(spark, d):
    """Statistics and models of each run and of all together, as JSON."""
    r = runs.run_report(samples(spark, d), "run", 830_313)
    return r.select("run", F.to_json("statistics").alias("statistics"), F.to_json("models").alias("models"))


@R.add("a28_wave_totals", "WITH b AS (SELECT collection_slug, external_link, arg_min(status_code, (CASE WHEN status_code = 200 THEN 0 WHEN status_code = 404 THEN 1 WHEN status_code >= 500 THEN 2 WHEN status_code < 0 THEN 3 ELSE 4 END) * 10000000000 + row_id) AS s FROM external_pdfs WHERE external_link IS NOT NULL AND status_code <> -3 AND collection_slug IS NOT NULL GROUP BY 1, 2), g AS (SELECT collection_slug, count(*) AS attempted, count(*) FILTER (WHERE s = 200) AS ok FROM b GROUP BY 1), w AS (SELECT *, CAST(floor((row_number() OVER (ORDER BY attempted DESC, collection_slug) - 1) / 10) AS BIGINT) AS wave FROM g) SELECT wave, count(*) AS collections, CAST(sum(attempted) AS BIGINT) AS attempted, CAST(sum(ok) AS BIGINT) AS added_200, CAST(sum(sum(ok)) OVER (ORDER BY wave) AS BIGINT) AS total_200 FROM w GROUP BY wave")
def a28(spark, d):
    g = profiles.unique_breakdown(x(spark, d).where("collection_slug IS NOT NULL"), ["collection_slug"], "external_link", "row_id")
    place = F.row_number().over(Window.orderBy(F.desc("attempted"), "collection_slug"))  # a row per collection
    w = g.withColumn("wave", F.floor((place - 1) / 10)).groupBy("wave").agg(F.count(F.lit(1)).alias("collections"), F.sum("attempted").alias("attempted"), F.sum("ok").alias("added_200"))
    return w.withColumn("total_200", F.sum("added_200").over(Window.orderBy("wave")))


_WORK = f"""(SELECT t.collection_slug, target, coalesce(attempted, 0) AS attempted, coalesce(remaining, 0) AS remaining, coalesce(speed, 0) AS speed FROM (SELECT collection_slug, count(DISTINCT external_link) AS target FROM edm_labeled WHERE collection_slug IS NOT NULL GROUP BY 1) t
 LEFT JOIN (SELECT collection_slug, count(DISTINCT external_link) FILTER (WHERE status_code <> -3) AS attempted, count(*) FILTER (WHERE status_code = -3) AS remaining FROM external_pdfs GROUP BY 1) u USING (collection_slug)
 LEFT JOIN (SELECT collection_slug, list_reduce(list_prepend(CAST(0 AS DOUBLE), list(CAST(elapsed_s AS DOUBLE) ORDER BY row_id)), lambda a, v: CASE WHEN a = 0 THEN v ELSE 0.3 * v + 0.7 * a END) AS speed FROM external_pdfs WHERE elapsed_s IS NOT NULL AND collection_slug IS NOT NULL GROUP BY 1) e USING (collection_slug))"""


def workers(spark, d) -> DataFrame:
    """A worker per collection: what it has to do, has done, has left, and its average speed."""
    target = table(spark, d, "edm_labeled").where("collection_slug IS NOT NULL").groupBy("collection_slug").agg(F.count_distinct("external_link").alias("target"))
    done = x(spark, d).groupBy("collection_slug").agg(F.count_distinct(F.when(F.col("status_code") != -3, F.col("external_link"))).alias("attempted"), profiles.count_when(F.col("status_code") == -3).alias("remaining"))
    speed = runs.ema(x(spark, d).where("elapsed_s IS NOT NULL AND collection_slug IS NOT NULL"), "collection_slug", "elapsed_s", "row_id").withColumnRenamed("ema", "speed")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return target.join(done, "collection_slug", "left").join(speed, "collection_slug", "left").select("collection_slug", "target", zero("attempted"), zero("remaining"), zero("speed"))


@R.add("a26_fleet_rollup", f"WITH w AS {_WORK}, a AS (SELECT count(*) AS workers, CAST(sum(greatest(0, target - attempted)) AS BIGINT) AS remaining, sum(speed) AS speed FROM w WHERE attempted > 20), q AS (SELECT CAST(coalesce(sum(target), 0) AS BIGINT) AS queued FROM w WHERE attempted <= 20) SELECT workers, remaining, queued, round(speed, 5) AS speed, round(CASE WHEN speed > 0.000001 THEN (remaining + queued) / speed ELSE 0 END, 3) AS eta_s FROM a, q")
def a26(spark, d):
    """Collections with more than twenty attempts are at work, the others wait."""
    w = workers(spark, d)
    r = profiles.fleet_rollup(w.where("attempted > 20"), w.where("attempted <= 20"))
    return r.withColumn("speed", F.round("speed", 5)).withColumn("eta_s", F.round("eta_s", 3))


@R.add("z07_finished", f"SELECT collection_slug, attempted >= target AND remaining = 0 AS stop FROM {_WORK}")
def z07(spark, d):
    """A worker stops when all its links were tried and nothing is left."""
    return workers(spark, d).select("collection_slug", ((F.col("attempted") >= F.col("target")) & (F.col("remaining") == 0)).alias("stop"))


@R.add("z12_eta_fallback", f"SELECT collection_slug, round(CASE WHEN remaining > 0 THEN remaining * 2.0 WHEN speed > 0.000001 AND target > attempted THEN (target - attempted) / speed ELSE 60.0 END, 5) AS eta FROM {_WORK}")
def z12(spark, d):
    """Time left: as the metrics tell it, else by the average speed, else as it was last."""
    w = workers(spark, d)
    told = F.nullif(F.col("remaining") * 2.0, F.lit(0.0))
    own = F.when((F.col("speed") > 1e-6) & (F.col("target") > F.col("attempted")), (F.col("target") - F.col("attempted")) / F.col("speed"))
    return w.select("collection_slug", F.round(F.coalesce(told, own, F.lit(60.0)), 5).alias("eta"))


@R.add("z06_retry_decision", f"WITH e AS (SELECT collection_slug, count(*) FILTER (WHERE NOT coalesce(status_code IN (-3, 404), false)) AS n, count(*) FILTER (WHERE status_code = 200) AS ok, CAST(max(coalesce(retries, 0)) AS BIGINT) % 3 AS passes FROM external_pdfs GROUP BY 1) SELECT w.collection_slug, CASE WHEN n IS NULL THEN true WHEN n = 0 THEN false ELSE (n - ok) * 100.0 / n >= 5 END AND attempted < target AND coalesce(passes, 0) < 2 AS retry FROM {_WORK} w LEFT JOIN e ON e.collection_slug = w.collection_slug")
def z06(spark, d):
    """Once more if five percent failed, links are left, and fewer than two passes were made."""
    w = workers(spark, d)
    e = profiles.error_rate(x(spark, d), ["collection_slug"], w.select("collection_slug")).select("collection_slug", "error_pct")
    passes = x(spark, d).groupBy("collection_slug").agg((F.max(F.coalesce("retries", F.lit(0))) % 3).alias("passes"))
    j = w.join(e, "collection_slug").join(passes, "collection_slug", "left")
    return j.select("collection_slug", ((F.col("error_pct") >= 5) & (F.col("attempted") < F.col("target")) & (F.coalesce("passes", F.lit(0)) < 2)).alias("retry"))
