"""Further operators of the inventory, each as one query with its SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from harvestry.functions import html as H
from harvestry.functions import text as T
from harvestry.operators import labels, mining, planning, profiles, runs
from harvestry.plans.pages import item_pages
from harvestry.plans.reference import A01, COVER, NG, OK, SAMPLES, rule_lines, samples, x
from harvestry.plans.registry import Registry, table
from harvestry.sources.tables import overrides

R = Registry()
CONFIG = '{"thymari_hub": {"per_concurrency": 5, "wait": 9.0}, "ydria_theses": {"per_concurrency": 2, "wait": 1.0, "force_http1": true}, "thymari_hub": {"per_concurrency": 3, "wait": 0.5, "retries": 2}}'


@R.add("s10_lint_lines", "SELECT label_id AS line, label_el AS token, label_en AS target, true AS marked FROM type_labels")
def s10(spark, d):
    return labels.parse_lint_lines(rule_lines(spark, d))


@R.add("effective_settings", """WITH o AS (SELECT * FROM (VALUES ('thymari_hub', 3, 0.5, 2), ('ydria_theses', 2, 1.0, NULL)) v(slug, c, w, r)) SELECT DISTINCT collection_slug, CAST(coalesce(c, 15) AS INTEGER) AS per_concurrency, CAST(coalesce(w, 0.3) AS DOUBLE) AS wait, CAST(coalesce(r, 0) AS INTEGER) AS retries FROM collections LEFT JOIN o ON slug = collection_slug""")
def effective_settings(spark, d):
    o = F.broadcast(overrides(spark, CONFIG))  # a configuration: a row per named collection
    c = table(spark, d, "collections").select("collection_slug").distinct()
    j = c.join(o, c["collection_slug"] == o["slug"], "left")
    return j.select("collection_slug", F.coalesce("per_concurrency", F.lit(15)).alias("per_concurrency"), F.coalesce("wait", F.lit(0.3)).alias("wait"), F.coalesce("retries", F.lit(0)).alias("retries"))


@R.add("f07_head_after_filter", "SELECT row_id, external_link FROM edm_labeled WHERE language_code = 'ELL' ORDER BY row_id LIMIT 500")
def f07(spark, d):
    return table(spark, d, "edm_labeled").where("language_code = 'ELL'").select("row_id", "external_link").orderBy("row_id").limit(500)


@R.add("f10_threshold_split", "SELECT CASE WHEN bad * 100.0 / n < 50 THEN 'low' ELSE 'high' END AS side, count(*) AS n FROM (SELECT collection_slug, count(*) AS n, count(*) FILTER (WHERE status_code <> 200) AS bad FROM external_pdfs WHERE collection_slug IS NOT NULL AND status_code IS NOT NULL GROUP BY 1) GROUP BY 1")
def f10(spark, d):
    return profiles.error_analysis(x(spark, d)).groupBy(F.when(F.col("error_pct") < 50, "low").otherwise("high").alias("side")).agg(F.count(F.lit(1)).alias("n"))


@R.add("f11_positive_domain", f"SELECT run, count(*) AS n FROM {SAMPLES} WHERE completed > 0 AND fail_pct > 0 GROUP BY run")
def f11(spark, d):
    return samples(spark, d).where("completed > 0 AND fail_pct > 0").groupBy("run").agg(F.count(F.lit(1)).alias("n"))


@R.add("a17_status_histogram", "SELECT collection_slug, string_agg(status_code || '=' || n, ',' ORDER BY status_code) AS statuses FROM (SELECT collection_slug, status_code, count(*) AS n FROM external_pdfs WHERE status_code IS NOT NULL GROUP BY 1, 2) GROUP BY 1")
def a17(spark, d):
    c = x(spark, d).where("status_code IS NOT NULL").groupBy("collection_slug", "status_code").agg(F.count(F.lit(1)).alias("n"))
    m = c.groupBy("collection_slug").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("status_code", "n")))).alias("m"))
    return m.select("collection_slug", F.array_join(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"].cast("string"), F.lit("="), e["value"].cast("string"))), ",").alias("statuses"))


@R.add("a22_largest_page", "SELECT collection_slug, max(page_number) AS pages FROM edm_metadata_full GROUP BY 1")
def a22(spark, d):
    return table(spark, d, "edm_metadata_full").groupBy("collection_slug").agg(F.max("page_number").alias("pages"))


@R.add("a23_metric_statistics", f"SELECT run, max(completed) AS completed, CAST(max(failed) AS BIGINT) AS failed, round(arg_max(fail_pct, completed), 6) AS final_pct, round(avg(fail_pct), 6) AS mean_pct, round(stddev_samp(fail_pct), 6) AS std_pct, round(min(fail_pct), 6) AS min_pct, round(max(fail_pct), 6) AS max_pct FROM {SAMPLES} GROUP BY run")
def a23(spark, d):
    r = lambda c, n: F.round(c, 6).alias(n)
    return samples(spark, d).groupBy("run").agg(F.max("completed").alias("completed"), F.max("failed").alias("failed"), r(F.max_by("fail_pct", "completed"), "final_pct"), r(F.avg("fail_pct"), "mean_pct"), r(F.stddev_samp("fail_pct"), "std_pct"), r(F.min("fail_pct"), "min_pct"), r(F.max("fail_pct"), "max_pct"))


@R.add("a29_rule_statistics", "SELECT count(*) AS rules, count(DISTINCT label_el) AS tokens, count(DISTINCT label_en) AS targets, count(*) AS marked FROM type_labels")
def a29(spark, d):
    r = labels.parse_lint_lines(rule_lines(spark, d))
    return r.agg(F.count(F.lit(1)).alias("rules"), F.count_distinct("token").alias("tokens"), F.count_distinct("target").alias("targets"), F.count_if("marked").alias("marked"))


@R.add("a30_repeated_keys", "SELECT collection_slug, list(item_count ORDER BY item_count) AS counts FROM collections WHERE item_count IS NOT NULL GROUP BY 1 HAVING count(*) > 1")
def a30(spark, d):
    g = table(spark, d, "collections").where("item_count IS NOT NULL").groupBy("collection_slug").agg(F.sort_array(F.collect_list("item_count")).alias("counts"))
    return g.where(F.size("counts") > 1)


@R.add("w07_moving_projection", f"SELECT run, round((max(failed) - min(failed)) / greatest(1, max(completed) - min(completed)) * 830313, 3) AS projected FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY completed DESC) AS r FROM {SAMPLES}) WHERE r <= 10 GROUP BY run")
def w07(spark, d):
    return runs.moving_rate(samples(spark, d), "run").select("run", F.round(F.col("moving_rate") * 830_313, 3).alias("projected"))


@R.add("o08_tail", f"SELECT run, completed FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY completed DESC) AS r FROM {SAMPLES}) WHERE r <= 5 ORDER BY run, completed")
def o08(spark, d):
    r = F.row_number().over(Window.partitionBy("run").orderBy(F.desc("completed")))
    return samples(spark, d).withColumn("r", r).where("r <= 5").select("run", "completed").orderBy("run", "completed")


@R.add("o09_combined_order", f"SELECT CAST(row_number() OVER (ORDER BY completed, run) AS BIGINT) AS place, run, completed FROM {SAMPLES}")
def o09(spark, d):
    from harvestry.functions.prefix import running_total

    return running_total(samples(spark, d).select("run", "completed").withColumn("one", F.lit(1)), ["completed", "run"], "one", "place").select((F.col("place") + 1).alias("place"), "run", "completed")


@R.add("r12_recorded_totals", "SELECT collection_slug, max(page_number) AS total_pages, bool_or(page_number = 1 AND status_code = 200) AS has_first FROM edm_metadata_full WHERE page_number IS NOT NULL AND collection_slug IS NOT NULL AND status_code IS NOT NULL GROUP BY 1")
def r12(spark, d):
    e = table(spark, d, "edm_metadata_full").where("page_number IS NOT NULL AND collection_slug IS NOT NULL AND status_code IS NOT NULL")
    return e.groupBy("collection_slug").agg(F.max("page_number").alias("total_pages"), F.bool_or((F.col("page_number") == 1) & (F.col("status_code") == 200)).alias("has_first"))


@R.add("r14_retries_written", "SELECT row_id, coalesce(retries, 0) + CASE WHEN status_code IN (200, 404) THEN 0 ELSE 1 END AS retries FROM external_pdfs")
def r14(spark, d):
    again = F.when(F.col("status_code").isin(200, 404), 0).otherwise(1)
    return x(spark, d).select("row_id", (F.coalesce("retries", F.lit(0)) + again).alias("retries"))


PROBE = "(SELECT external_link, arg_{}(status_code, row_id) AS s, arg_{}(elapsed_s, row_id) AS e FROM external_pdfs WHERE external_link <> '' AND status_code IS NOT NULL AND elapsed_s IS NOT NULL GROUP BY 1)"


@R.add("r17_probe_overwrite", f"SELECT o.external_link, CASE WHEN o.s <> n.s OR o.e <> n.e THEN n.s ELSE o.s END AS status FROM {PROBE.format('min', 'min')} o JOIN {PROBE.format('max', 'max')} n USING (external_link)")
def r17(spark, d):
    g = x(spark, d).where("external_link <> '' AND status_code IS NOT NULL AND elapsed_s IS NOT NULL").groupBy("external_link").agg(
        F.min_by("status_code", "row_id").alias("s0"), F.max_by("status_code", "row_id").alias("s1"), F.min_by("elapsed_s", "row_id").alias("e0"), F.max_by("elapsed_s", "row_id").alias("e1"))
    return g.select("external_link", planning.overwrite_probe(F.col("s0"), F.col("s1"), F.col("e0"), F.col("e1")).alias("status"))


@R.add("r20_pages_before_stop", "WITH p AS (SELECT collection_slug, page_number, bool_and(coalesce(status_code = 200, false)) AS ok FROM edm_metadata_full WHERE collection_slug IS NOT NULL AND page_number IS NOT NULL GROUP BY 1, 2), s AS (SELECT collection_slug, min(page_number) AS stop FROM p WHERE NOT ok GROUP BY 1) SELECT p.collection_slug, count(*) AS pages FROM p LEFT JOIN s USING (collection_slug) WHERE s.stop IS NULL OR page_number < s.stop GROUP BY 1")
def r20(spark, d):
    p = table(spark, d, "edm_metadata_full").where("collection_slug IS NOT NULL AND page_number IS NOT NULL").groupBy("collection_slug", "page_number").agg(F.bool_and(F.coalesce(F.col("status_code") == 200, F.lit(False))).alias("ok"))
    stop = p.where("NOT ok").groupBy("collection_slug").agg(F.min("page_number").alias("stop"))
    return p.join(stop, "collection_slug", "left").where("stop IS NULL OR page_number < stop").groupBy("collection_slug").agg(F.count(F.lit(1)).alias("pages"))


@R.add("x07_type_words", "SELECT value_id, regexp_replace(regexp_replace(translate(lower(trim(value)), 'άέήίόύώϊϋΐΰς', 'αεηιουωιυιυσ'), '\\s+', ' ', 'g'), '[^\\p{L}\\p{N}_\\s]', ' ', 'g') AS words FROM type_values")
def x07(spark, d):
    plain = F.regexp_replace(T.plain_greek(F.col("value")), r"\s+", " ")
    return table(spark, d, "type_values").select("value_id", F.regexp_replace(plain, r"[^\p{L}\p{N}_\s]", " ").alias("words"))


@R.add("x08_document_urls", "SELECT row_id, list_bool_or(list_transform(CAST(from_json(pdf_links_json, '[\"VARCHAR\"]') AS VARCHAR[]), lambda u: lower(u) LIKE '%.pdf')) AS any_pdf FROM external_pdfs WHERE pdf_links_json IS NOT NULL AND pdf_links_json <> '[]'")
def x08(spark, d):
    links = F.from_json("pdf_links_json", "array<string>")
    path = lambda u: F.lower(F.try_parse_url(u, F.lit("PATH"))).endswith(".pdf")
    return x(spark, d).where("pdf_links_json IS NOT NULL AND pdf_links_json <> '[]'").select("row_id", F.exists(links, path).alias("any_pdf"))


@R.add("x09_counted_items", "SELECT collection_slug, item_count AS n FROM collections WHERE item_count IS NOT NULL")
def x09(spark, d):
    c = table(spark, d, "collections").where("item_count IS NOT NULL")
    return c.select("collection_slug", T.counted(F.concat(F.lit("σύνολο "), F.format_number("item_count", 0), F.lit(" τεκμήρια"))).alias("n"))


@R.add("x20_containment", "SELECT label_id, contains(lower(label_el), lower(label_en)) OR contains(lower(label_en), lower(label_el)) AS c FROM type_labels")
def x20(spark, d):
    a, b = F.lower("label_el"), F.lower("label_en")
    return table(spark, d, "type_labels").select("label_id", (a.contains(b) | b.contains(a)).alias("c"))


@R.add("x28_title_part", "SELECT row_id, coalesce(collection_slug, 'none') AS title FROM edm_labeled")
def x28(spark, d):
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return item_pages(spark, d).select("row_id", F.trim(F.element_at(F.split(title, r"\|"), -1)).alias("title"))


@R.add("x29_model_functions", f"SELECT run, completed, round(0.5 * exp(-0.0001 * completed) + 3, 8) AS exponential, round(0.5 * pow(completed, 0.25) + 3, 8) AS power FROM {SAMPLES}")
def x29(spark, d):
    c = F.col("completed")
    return samples(spark, d).select("run", "completed", F.round(0.5 * F.exp(-0.0001 * c) + 3, 8).alias("exponential"), F.round(0.5 * F.pow(c, F.lit(0.25)) + 3, 8).alias("power"))


# ---- pages ---------------------------------------------------------------------------------------------------------


def listing_pages(spark, d) -> DataFrame:
    """One listing page per collection: its institution, itself, and the first items by address."""
    c = table(spark, d, "collections").where("collection_slug IS NOT NULL").groupBy("collection_slug").agg(F.min("institution_slug").alias("inst"), F.max("item_count").alias("n"))
    items = table(spark, d, "edm_labeled").where("collection_slug IS NOT NULL").groupBy("collection_slug").agg(F.sort_array(F.collect_set("page_number")).alias("pages"))
    cards = F.array_join(F.transform("pages", lambda p: F.concat(F.lit('<div class="edm-entity-result"><a href="/edm/'), p.cast("string"), F.lit('">i</a></div>'))), "")
    html = F.concat(F.lit('<h1>List</h1><a class="organisation_title" href="/institutions/'), F.col("inst"), F.lit('"></a><a href="/collections/'), F.col("collection_slug"), F.lit("\"> The  list </a><script>var maxPages = '"), F.size("pages").cast("string"), F.lit("';</script>"), cards, F.lit("<a href='?page.page=2'>next</a>"))
    return c.join(items, "collection_slug").select("collection_slug", "inst", F.size("pages").alias("n_pages"), html.alias("html"))


LISTING = "(SELECT collection_slug, min(institution_slug) AS inst FROM collections WHERE collection_slug IS NOT NULL GROUP BY 1) c JOIN (SELECT collection_slug, count(DISTINCT page_number) AS n FROM edm_labeled WHERE collection_slug IS NOT NULL GROUP BY 1) i USING (collection_slug)"


@R.add("h01_first_links", f"SELECT collection_slug, 'https://aggregator.example/collections/' || collection_slug AS collection, 'https://aggregator.example/institutions/' || inst AS institution FROM {LISTING}")
def h01(spark, d):
    first = lambda p: H.url_join(F.lit("https://aggregator.example/"), F.filter("a", lambda x: x["href"].contains(p))[0]["href"])
    a = listing_pages(spark, d).withColumn("a", H.html_anchors("html"))
    return a.select("collection_slug", first("/collections/").alias("collection"), first("/institutions/").alias("institution"))


@R.add("h08_named_links", f"SELECT collection_slug, 'The list' AS name, inst AS institution FROM {LISTING}")
def h08(spark, d):
    a = listing_pages(spark, d).withColumn("a", H.html_anchors("html"))
    name = lambda p: F.filter("a", lambda x: x["href"].contains(p))[0]
    last = F.element_at(F.split(name("/institutions/")["href"], "/"), -1)
    return a.select("collection_slug", name("/collections/")["text"].alias("name"), F.coalesce(F.nullif(name("/institutions/")["text"], F.lit("")), last).alias("institution"))


@R.add("h16_item_anchors", f"SELECT collection_slug, CAST(n AS INTEGER) AS anchors, n AS cards, n AS max_pages, true AS pagination FROM {LISTING}")
def h16(spark, d):
    js = F.regexp_extract("html", r"var\s+maxPages\s*=\s*['\"](\d+)['\"]\s*;", 1).try_cast("long")
    a = listing_pages(spark, d).withColumn("a", H.html_anchors("html"))
    return a.select("collection_slug", F.size(F.filter("a", lambda x: x["href"].contains("/edm/"))).alias("anchors"), H.html_card_count("html").alias("cards"), js.alias("max_pages"), F.col("html").contains("page.page=").alias("pagination"))


@R.add("h21_visible_text", f"SELECT collection_slug, 'List The list' || repeat(' i', CAST(n AS INTEGER)) || ' next' AS text FROM {LISTING}")
def h21(spark, d):
    return listing_pages(spark, d).select("collection_slug", H.html_text("html").alias("text"))


@R.add("h15_accept_patterns", "SELECT row_id, list_transform(CAST(from_json(pdf_links_json, '[\"VARCHAR\"]') AS VARCHAR[]), lambda u: regexp_matches(u, '(?i)(\\.pdf($|[?#])|/bitstreams?/|/article/download/|/download/|/view/manf/|viewer\\.html\\?file=|pdfjs)')) AS accepted FROM external_pdfs WHERE pdf_links_json IS NOT NULL")
def h15(spark, d):
    pattern = "(?i)(" + "|".join(H.ACCEPT) + ")"
    return x(spark, d).where("pdf_links_json IS NOT NULL").select("row_id", F.transform(F.from_json("pdf_links_json", "array<string>"), lambda u: u.rlike(pattern)).alias("accepted"))


# ---- labelling, mining, models, control ------------------------------------------------------------------------------


@R.add("l09_token_mismatch")
def l09(spark, d):
    r = labels.parse_lint_lines(rule_lines(spark, d)).withColumn("ratio", T.similarity("token", "target"))
    a, b = F.lower("token"), F.lower("target")
    return r.where(~a.contains(b) & ~b.contains(a) & (F.col("ratio") < 0.5)).select("line", "token", "target")


@R.add("t02_ngrams", f"SELECT value_id, token FROM {NG}")
def t02(spark, d):
    return table(spark, d, "type_values").select("value_id", F.explode(mining.stems(F.col("value"))).alias("token"))


@R.add("t05_clusters", f"SELECT token, list(value ORDER BY value) AS \"values\" FROM (SELECT n.value_id, any_value(v.value) AS value, arg_min(c.token, c.step) AS token FROM {NG} n JOIN {COVER} c USING (token) JOIN type_values v ON v.value_id = n.value_id GROUP BY n.value_id) GROUP BY token")
def t05(spark, d):
    """Each value under the first selected token that covers it."""
    v = table(spark, d, "type_values")
    chosen = mining.greedy_cover(v, "value_id", "value", 0.8)
    flat = v.select("value_id", "value", F.explode(mining.stems(F.col("value"))).alias("token")).join(chosen.select("token", "step"), "token")
    own = flat.groupBy("value_id").agg(F.min_by(F.struct("token", "value"), "step").alias("b"))
    return own.groupBy(F.col("b.token").alias("token")).agg(F.sort_array(F.collect_list("b.value")).alias("values"))


@R.add("d02_linear_prediction", f"SELECT run, round(regr_intercept(fail_pct, completed) + regr_slope(fail_pct, completed) * 830313, 3) AS at_target FROM {SAMPLES} GROUP BY run")
def d02(spark, d):
    return runs.linear_models(samples(spark, d), "run", 830_313).select("run", F.round("at_target", 3).alias("at_target"))


@R.add("d09_line_series", f"WITH m AS (SELECT run, regr_slope(fail_pct, completed) AS s, regr_intercept(fail_pct, completed) AS i FROM {SAMPLES} GROUP BY run) SELECT run, CAST(k AS BIGINT) AS x, round(i + s * k, 3) AS y FROM m, range(0, 830001, 10000) AS r(k)")
def d09(spark, d):
    m = runs.linear_models(samples(spark, d), "run", 0)
    line = m.select("run", "slope", "intercept", F.explode(F.sequence(F.lit(0), F.lit(830_000), F.lit(10_000))).alias("x"))
    return line.select("run", F.col("x").cast("long").alias("x"), F.round(F.col("intercept") + F.col("slope") * F.col("x"), 3).alias("y"))


@R.add("z13_failish_share", "WITH b AS (SELECT collection_slug, external_link, arg_min(status_code, (CASE WHEN status_code = 200 THEN 0 WHEN status_code = 404 THEN 1 WHEN status_code >= 500 THEN 2 WHEN status_code < 0 THEN 3 ELSE 4 END) * 10000000000 + row_id) AS s FROM external_pdfs WHERE external_link IS NOT NULL AND status_code <> -3 GROUP BY 1, 2) SELECT collection_slug, count(*) AS attempted, round(count(*) FILTER (WHERE s < 0 OR (s >= 400 AND s <> 404)) * 100.0 / count(*), 6) AS fail_pct FROM b GROUP BY 1")
def z13(spark, d):
    rows = x(spark, d).where("external_link IS NOT NULL AND status_code <> -3")
    b = rows.groupBy("collection_slug", "external_link").agg(F.min_by("status_code", F.struct(profiles.status_rank(F.col("status_code")), "row_id")).alias("s"))
    s = F.col("s")
    return b.groupBy("collection_slug").agg(F.count(F.lit(1)).alias("attempted"), F.round(profiles.count_when((s < 0) | ((s >= 400) & (s != 404))) * 100.0 / F.count(F.lit(1)), 6).alias("fail_pct"))


@R.add("o01_multi_key_sort", f"SELECT collection_slug, total FROM ({A01}) ORDER BY total DESC, collection_slug")
def o01(spark, d):
    return profiles.language_shares(table(spark, d, "edm_labeled")).select("collection_slug", "total").orderBy(F.desc("total"), "collection_slug")


@R.add("u06_append_skipped", f"SELECT row_id, status_code FROM external_pdfs WHERE {OK} UNION ALL SELECT row_id, -3 FROM external_pdfs WHERE NOT {OK}")
def u06(spark, d):
    rows, ok = x(spark, d).select("row_id", "status_code"), F.coalesce(F.col("status_code") == 200, F.lit(False))
    return rows.where(ok).unionByName(rows.where(~ok).select("row_id", F.lit(-3).cast("long").alias("status_code")))
