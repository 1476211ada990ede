"""Queries of the harvest operators, each over whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.functions import text as T
from harvestry.functions.urls import domain_of, last_segment
from harvestry.operators import labels, merge, mining, planning, profiles, runs
from harvestry.plans.registry import Registry, table
from harvestry.sources.tables import ensure_columns

R = Registry()
KEY = ["collection_slug", "page_number", "edm_url"]
#: The day that parts the fetch results into a master table and the shards that came later.
SPLIT = "20240101"


def x(spark, d) -> DataFrame:
    return table(spark, d, "external_pdfs")


def parts(spark, d) -> tuple[DataFrame, DataFrame]:
    """(master, shards): shards lack the refined columns, as early ones do."""
    rows = x(spark, d)
    late = F.regexp_extract("shard", r"__(\d{8})_", 1) >= SPLIT
    return rows.where(~late), rows.where(late).drop("refined_pdf_links_json", "refined_pdf_links_count")


SRC = f"CASE WHEN regexp_extract(shard, '__([0-9]{{8}})_', 1) >= '{SPLIT}' THEN 1 ELSE 0 END"
OK = "coalesce(status_code = 200, false)"


def best_sql(key: str, order: str, cols: str, source: str = "external_pdfs") -> str:
    return f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}) WHERE rn = 1"


# ---- sources -------------------------------------------------------------------------------------------------------


@R.add("s01_full_scan", "SELECT * FROM collections")
def s01(spark, d):
    return table(spark, d, "collections")


@R.add("s02_pruned_scan", "SELECT collection_slug, status_code, retries FROM external_pdfs")
def s02(spark, d):
    return x(spark, d).select("collection_slug", "status_code", "retries")


@R.add("s03_tolerant_scan", "SELECT collection_slug, item_count, CAST(0 AS BIGINT) AS retries, CAST(0 AS DOUBLE) AS pct_ELL FROM collections")
def s03(spark, d):
    return ensure_columns(table(spark, d, "collections").select("collection_slug", "item_count"), {"retries": F.lit(0).cast("long"), "pct_ELL": F.lit(0.0), "item_count": F.lit(0)})


@R.add("s09_type_rules", "SELECT label_el AS token, label_en AS label, [label_el, label_en] AS \"values\", label_id AS ord FROM type_labels")
def s09(spark, d):
    return labels.parse_type_rules(rule_lines(spark, d))


def rule_lines(spark, d) -> DataFrame:
    """Rule lines as they stand in a rule file, one per canonical type."""
    t = table(spark, d, "type_labels")
    return t.select(F.concat(F.lit("[[X]] "), F.col("label_el"), F.lit(" -> "), F.col("label_en"), F.lit(" : "), F.to_json(F.array("label_el", "label_en"))).alias("value"), F.col("label_id").alias("ord"))


@R.add("s08_language_rules", "SELECT lang AS lhs, upper(substr(lang, 1, 3)) AS code FROM (SELECT DISTINCT lang FROM documents WHERE lang IS NOT NULL)")
def s08(spark, d):
    langs = table(spark, d, "documents").where("lang IS NOT NULL").select("lang").distinct()
    lines = langs.select(F.concat("lang", F.lit(" -> "), F.upper(F.substring("lang", 1, 3)), F.lit(" [note]")).alias("value"), F.lit(1).alias("ord"))
    return labels.parse_language_rules(lines).select("lhs", "code")


# ---- merge ---------------------------------------------------------------------------------------------------------


@R.add("m01_best_of_merge", best_sql("collection_slug, page_number, edm_url", f"{OK} DESC, coalesce(retries, 0) DESC, {SRC} DESC, row_id DESC", f"collection_slug, page_number, edm_url, status_code, retries, row_id, CASE WHEN {SRC} = 0 THEN refined_pdf_links_count END AS refined_pdf_links_count"))
def m01(spark, d):
    rows = merge.union_ranked(list(parts(spark, d)))
    return merge.best_of(rows.select(*KEY, "status_code", "retries", "row_id", "refined_pdf_links_count", "_src"), KEY, merge.fetch_order("_src", "row_id")).drop("_src")


@R.add("m02_page_merge", best_sql("collection_slug, page_number", f"{OK} DESC, coalesce(retries, 0) DESC, row_id DESC", "collection_slug, page_number, status_code, retries, row_id"))
def m02(spark, d):
    return merge.best_of(x(spark, d).select("collection_slug", "page_number", "status_code", "retries", "row_id"), ["collection_slug", "page_number"], merge.fetch_order("row_id"))


@R.add("m03_link_merge", best_sql("collection_slug, page_number, edm_url", "row_id DESC", "collection_slug, page_number, edm_url, row_id", "edm_labeled"))
def m03(spark, d):
    return merge.best_of(table(spark, d, "edm_labeled").select(*KEY, "row_id"), KEY, [F.col("row_id")])


STATE = f"""(SELECT url, arg_max(status_code, o) AS status, arg_max(coalesce(retries, -99), o) AS retries, bool_or({OK} AND coalesce(pdf_links_count, 0) > 0) AS has_pdf
 FROM (SELECT *, external_link AS url, (CASE WHEN {OK} THEN 1 ELSE 0 END) * 10000000000000 + (coalesce(retries, 0) + 5) * 10000000000 + row_id AS o FROM external_pdfs WHERE external_link IS NOT NULL{{}}) GROUP BY url)"""
STATE = STATE.replace("arg_max(status_code, o)", "nullif(arg_max(coalesce(status_code, -99), o), -99)").replace("arg_max(coalesce(retries, -99), o)", "nullif(arg_max(coalesce(retries, -99), o), -99)")


@R.add("m04_state_per_url", f"SELECT * FROM {STATE.format('')}")
def m04(spark, d):
    return planning.known_state(x(spark, d), "external_link", "row_id")


@R.add("m05_baseline_state", best_sql("external_link", f"{OK} DESC, row_id DESC", "external_link, status_code, row_id", "(SELECT * FROM external_pdfs WHERE external_link IS NOT NULL)"))
def m05(spark, d):
    rows = x(spark, d).where("external_link IS NOT NULL").select("external_link", "status_code", "row_id")
    return merge.best_of(rows, ["external_link"], [F.coalesce(F.col("status_code") == 200, F.lit(False)), F.col("row_id")])


OVERLAY = f"""(SELECT coalesce(b.url, a.url) AS url, CASE WHEN b.url IS NOT NULL THEN b.status ELSE a.status END AS status, CASE WHEN b.url IS NOT NULL THEN b.retries ELSE a.retries END AS retries,
 coalesce(a.has_pdf, false) OR coalesce(b.has_pdf, false) AS has_pdf FROM {STATE.format(f' AND {SRC} = 0')} a FULL OUTER JOIN {STATE.format(f' AND {SRC} = 1')} b ON a.url = b.url)"""


@R.add("m06_state_overlay", f"SELECT * FROM {OVERLAY}")
def m06(spark, d):
    return state(spark, d)


def state(spark, d) -> DataFrame:
    old, new = parts(spark, d)
    return merge.overlay(planning.known_state(old, "external_link", "row_id"), planning.known_state(new, "external_link", "row_id"), "url", ["has_pdf"])


@R.add("m07_first_seen", "SELECT external_link, min(row_id) AS row_id FROM edm_labeled GROUP BY external_link")
def m07(spark, d):
    return merge.first_seen(table(spark, d, "edm_labeled"), "external_link", "row_id")


@R.add("m08_pages_done", "SELECT count(*) AS n_pages FROM (SELECT DISTINCT collection_slug, page_number FROM external_pdfs WHERE status_code = 200 AND collection_slug IS NOT NULL AND page_number IS NOT NULL)")
def m08(spark, d):
    return x(spark, d).where("status_code = 200").agg(F.count_distinct("collection_slug", "page_number").alias("n_pages"))


@R.add("m09_list_dedupe", "SELECT row_id, list_filter(l, lambda u, i: list_position(l, u) = i) AS links FROM (SELECT row_id, CAST(from_json(pdf_links_json, '[\"VARCHAR\"]') AS VARCHAR[]) AS l FROM external_pdfs WHERE pdf_links_json IS NOT NULL)")
def m09(spark, d):
    links = F.array_distinct(F.from_json("pdf_links_json", "array<string>"))
    return x(spark, d).where("pdf_links_json IS NOT NULL").select("row_id", links.alias("links"))


@R.add("m10_page_state", best_sql("collection_slug, page_number", "meta_id DESC", "collection_slug, page_number, status_code, retries, meta_id", "(SELECT * FROM edm_metadata_full WHERE page_number > 0 AND collection_slug IS NOT NULL)"))
def m10(spark, d):
    rows = table(spark, d, "edm_metadata_full").where("page_number > 0 AND collection_slug IS NOT NULL").select("collection_slug", "page_number", "status_code", "retries", "meta_id")
    return merge.best_of(rows, ["collection_slug", "page_number"], [F.col("meta_id")])


@R.add("a25_merge_gain", f"WITH a AS (SELECT max(CASE WHEN {OK} THEN 1 ELSE 0 END) AS ok, max(CASE WHEN {OK} AND {SRC} = 0 THEN 1 ELSE 0 END) AS ok0 FROM external_pdfs GROUP BY collection_slug, page_number, edm_url) SELECT CAST(sum(ok0) AS BIGINT) AS ok_before, CAST(sum(ok) AS BIGINT) AS ok_after, CAST(sum(ok) - sum(ok0) AS BIGINT) AS gain FROM a")
def a25(spark, d):
    old, new = parts(spark, d)
    both = merge.best_of(merge.union_ranked([old, new]).select(*KEY, "status_code", "retries", "row_id", "_src"), KEY, merge.fetch_order("_src", "row_id"))
    before = merge.best_of(old.select(*KEY, "status_code", "retries", "row_id"), KEY, merge.fetch_order("row_id"))
    n = lambda f, c: f.agg(F.count_if(F.col("status_code") == 200).alias(c))
    return n(before, "ok_before").join(n(both, "ok_after"), F.lit(True)).withColumn("gain", F.col("ok_after") - F.col("ok_before"))  # one row each


@R.add("u01_union_by_name", f"SELECT row_id, status_code, CASE WHEN {SRC} = 0 THEN refined_pdf_links_count END AS refined_pdf_links_count, CAST({SRC} AS INTEGER) AS src FROM external_pdfs")
def u01(spark, d):
    return merge.union_ranked(list(parts(spark, d))).select("row_id", "status_code", "refined_pdf_links_count", F.col("_src").alias("src"))


@R.add("u02_distinct", "SELECT DISTINCT collection_slug, status_code FROM external_pdfs")
def u02(spark, d):
    return x(spark, d).select("collection_slug", "status_code").distinct()


@R.add("u03_intersection", "SELECT DISTINCT external_link FROM edm_labeled WHERE external_link IN (SELECT external_link FROM external_pdfs WHERE status_code = 200)")
def u03(spark, d):
    done = x(spark, d).where("status_code = 200").select("external_link")
    return table(spark, d, "edm_labeled").select("external_link").join(done, "external_link", "left_semi").distinct()


@R.add("u04_difference", "SELECT DISTINCT external_link FROM edm_labeled l WHERE NOT EXISTS (SELECT 1 FROM external_pdfs x WHERE x.external_link = l.external_link)")
def u04(spark, d):
    return table(spark, d, "edm_labeled").select("external_link").join(x(spark, d).select("external_link"), "external_link", "left_anti").distinct()


@R.add("u05_set_union", f"SELECT DISTINCT external_link FROM external_pdfs WHERE {OK} AND pdf_links_count > 0 AND external_link IS NOT NULL")
def u05(spark, d):
    old, new = (p.where("status_code = 200 AND pdf_links_count > 0 AND external_link IS NOT NULL").select("external_link") for p in parts(spark, d))
    return old.union(new).distinct()


# ---- filters, projections, joins -----------------------------------------------------------------------------------

ENRICHED = """(SELECT c.collection_slug, c.item_count, s.total, s.pct_ELL, s.pct_NONE FROM (SELECT collection_slug, max(item_count) AS item_count FROM collections GROUP BY collection_slug) c
 JOIN (SELECT collection_slug, count(*) AS total, count(*) FILTER (WHERE language_code = 'ELL') / count(*) AS pct_ELL, count(*) FILTER (WHERE language_code = 'NONE') / count(*) AS pct_NONE FROM edm_labeled WHERE collection_slug IS NOT NULL GROUP BY collection_slug) s USING (collection_slug))"""
SLUGS = f"(SELECT DISTINCT collection_slug FROM {ENRICHED} WHERE coalesce(item_count, 0) >= 1000 AND (coalesce(pct_ELL, 0) > 0 OR coalesce(pct_NONE, 0) > 0))"


def enriched(spark, d) -> DataFrame:
    c = table(spark, d, "collections").groupBy("collection_slug").agg(F.max("item_count").alias("item_count"))
    return c.join(profiles.language_shares(table(spark, d, "edm_labeled")).select("collection_slug", "total", "pct_ELL", "pct_NONE"), "collection_slug")


@R.add("j15_enriched_collections", f"SELECT collection_slug, item_count, total, round(pct_ELL, 9) AS pct_ELL, round(pct_NONE, 9) AS pct_NONE FROM {ENRICHED} WHERE item_count >= 1000")
def j15(spark, d):
    return enriched(spark, d).where("item_count >= 1000").select("collection_slug", "item_count", "total", F.round("pct_ELL", 9).alias("pct_ELL"), F.round("pct_NONE", 9).alias("pct_NONE"))


@R.add("f01_eligible_collections", f"SELECT * FROM {SLUGS}")
def f01(spark, d):
    return planning.eligible(enriched(spark, d))


@R.add("f02_eligible_present", f"SELECT * FROM {SLUGS} s WHERE collection_slug NOT LIKE 'ammos%' AND EXISTS (SELECT 1 FROM edm_metadata_full e WHERE e.collection_slug = s.collection_slug)")
def f02(spark, d):
    return planning.eligible(enriched(spark, d)).where("collection_slug NOT LIKE 'ammos%'").join(table(spark, d, "edm_metadata_full").select("collection_slug"), "collection_slug", "left_semi")


@R.add("f03_largest_candidates", f"SELECT collection_slug, item_count FROM {ENRICHED} e WHERE item_count >= 1000 AND (pct_ELL > 0 OR pct_NONE > 0) ORDER BY item_count DESC, collection_slug LIMIT 20")
def f03(spark, d):
    e = enriched(spark, d).where("item_count >= 1000 AND (pct_ELL > 0 OR pct_NONE > 0)")
    return e.select("collection_slug", "item_count").orderBy(F.desc("item_count"), "collection_slug").limit(20)


WORK = f"(SELECT * FROM edm_labeled WHERE language_code IN ('ELL', 'NONE') AND external_link IS NOT NULL AND external_link <> '' AND collection_slug IN (SELECT collection_slug FROM {SLUGS}))"


@R.add("f04_work_rows", f"SELECT row_id, collection_slug, external_link FROM {WORK}")
def f04(spark, d):
    return planning.work_rows(table(spark, d, "edm_labeled"), planning.eligible(enriched(spark, d))).select("row_id", "collection_slug", "external_link")


@R.add("f05_include_only", "SELECT row_id, collection_slug FROM edm_labeled WHERE collection_slug IN ('thymari_hub', 'ydria_theses')")
def f05(spark, d):
    return table(spark, d, "edm_labeled").where(F.col("collection_slug").isin("thymari_hub", "ydria_theses")).select("row_id", "collection_slug")


@R.add("f06_skip_split", "SELECT row_id, CASE WHEN coalesce(collection_slug LIKE 'ammos%', false) THEN -3 ELSE status_code END AS status_code FROM external_pdfs")
def f06(spark, d):
    rows, skip = x(spark, d).select("row_id", "collection_slug", "status_code"), F.coalesce(F.col("collection_slug").like("ammos%"), F.lit(False))
    return rows.where(~skip).unionByName(rows.where(skip).withColumn("status_code", F.lit(-3).cast("long"))).select("row_id", "status_code")


@R.add("f08_failed_sample", "SELECT row_id, status_code FROM external_pdfs WHERE status_code <> 200 ORDER BY row_id LIMIT 3")
def f08(spark, d):
    return x(spark, d).where("status_code <> 200").select("row_id", "status_code").orderBy("row_id").limit(3)


@R.add("f09_error_population", "SELECT row_id FROM external_pdfs WHERE NOT coalesce(status_code IN (-3, 404), false)")
def f09(spark, d):
    return x(spark, d).where(~F.coalesce(F.col("status_code").isin(-3, 404), F.lit(False))).select("row_id")


@R.add("column_defaults", "SELECT row_id, coalesce(retries, 0) AS retries, coalesce(page_number, 0) AS page_number, CAST(CASE WHEN status_code = 200 THEN 1 ELSE 0 END AS INTEGER) AS ok FROM external_pdfs")
def p02(spark, d):
    return x(spark, d).select("row_id", F.coalesce("retries", F.lit(0)).alias("retries"), F.coalesce("page_number", F.lit(0)).alias("page_number"), F.when(F.col("status_code") == 200, 1).otherwise(0).alias("ok"))


@R.add("status_buckets", "SELECT CASE WHEN status_code = 200 THEN 'ok' WHEN status_code = 404 THEN 'missing' WHEN status_code = 500 THEN 'server' WHEN status_code = -1 THEN 'timeout' ELSE 'other' END AS bucket, count(*) AS n FROM external_pdfs GROUP BY 1")
def p05(spark, d):
    s = F.col("status_code")
    return x(spark, d).groupBy(F.when(s == 200, "ok").when(s == 404, "missing").when(s == 500, "server").when(s == -1, "timeout").otherwise("other").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@R.add("status_ranks", "SELECT row_id, CAST(CASE WHEN status_code = 200 THEN 0 WHEN status_code = 404 THEN 1 WHEN status_code >= 500 THEN 2 WHEN status_code < 0 THEN 3 ELSE 4 END AS INTEGER) AS rank FROM external_pdfs")
def p06(spark, d):
    return x(spark, d).select("row_id", profiles.status_rank(F.col("status_code")).alias("rank"))


@R.add("j01_semi", "SELECT row_id FROM edm_labeled WHERE collection_slug IN (SELECT collection_slug FROM collections WHERE item_count > 10000)")
def j01(spark, d):
    return table(spark, d, "edm_labeled").join(table(spark, d, "collections").where("item_count > 10000").select("collection_slug"), "collection_slug", "left_semi").select("row_id")


@R.add("j02_anti", "SELECT row_id FROM edm_labeled l WHERE NOT EXISTS (SELECT 1 FROM collections c WHERE c.item_count > 10000 AND c.collection_slug = l.collection_slug)")
def j02(spark, d):
    return table(spark, d, "edm_labeled").join(table(spark, d, "collections").where("item_count > 10000").select("collection_slug"), "collection_slug", "left_anti").select("row_id")


RESULTS = best_sql("external_link", f"{OK} DESC, coalesce(retries, 0) DESC, row_id DESC", "external_link, status_code, elapsed_s, pdf_links_count, retries", "(SELECT * FROM external_pdfs WHERE external_link IS NOT NULL)")


def results(spark, d) -> DataFrame:
    rows = x(spark, d).where("external_link IS NOT NULL").select("external_link", "status_code", "elapsed_s", "pdf_links_count", "retries", "row_id")
    return merge.best_of(rows, ["external_link"], merge.fetch_order("row_id")).drop("row_id")


FAN = "coalesce(r.status_code, -3) AS status_code, coalesce(r.elapsed_s, 0) AS elapsed_s, coalesce(r.pdf_links_count, 0) AS pdf_links_count, coalesce(r.retries, 0) AS retries"


@R.add("j03_fan_out", f"SELECT l.row_id, l.external_link, {FAN} FROM edm_labeled l LEFT JOIN ({RESULTS}) r ON l.external_link = r.external_link")
def j03(spark, d):
    return planning.fan_out(table(spark, d, "edm_labeled").select("row_id", "external_link"), results(spark, d), "external_link")


@R.add("j04_attempted_only", f"SELECT l.row_id, l.external_link, {FAN} FROM edm_labeled l JOIN ({RESULTS}) r ON l.external_link = r.external_link")
def j04(spark, d):
    return planning.fan_out(table(spark, d, "edm_labeled").select("row_id", "external_link"), results(spark, d), "external_link", inner=True)


@R.add("j10_url_to_slug", "SELECT external_link, arg_max(coalesce(collection_slug, '~'), row_id) AS slug FROM edm_labeled WHERE external_link IS NOT NULL GROUP BY external_link")
def j10(spark, d):
    return table(spark, d, "edm_labeled").where("external_link IS NOT NULL").groupBy("external_link").agg(F.max_by(F.coalesce("collection_slug", F.lit("~")), "row_id").alias("slug"))


#: DuckDB counts edits in bytes, so its side writes Greek letters as capital Latin ones (the rest is lower case).
ONE_BYTE = "translate(translate(lower(trim({})), 'άέήίόύώϊϋΐΰς', 'αεηιουωιυιυσ'), 'αβγδεζηθικλμνξοπρστυφχψω', 'ABCDEFGHIJKLMNOPQRSTUVWX')"
NEAR = f"(SELECT a.v AS a, b.v AS b, levenshtein(a.t, b.t) AS d FROM (SELECT DISTINCT translate(lower(trim(value)), 'άέήίόύώϊϋΐΰς', 'αεηιουωιυιυσ') AS v, {ONE_BYTE.format('value')} AS t FROM type_values) a, (SELECT DISTINCT translate(lower(trim(value)), 'άέήίόύώϊϋΐΰς', 'αεηιουωιυιυσ') AS v, {ONE_BYTE.format('value')} AS t FROM type_values) b WHERE a.v < b.v)"


def token_rules(spark, d) -> DataFrame:
    return table(spark, d, "type_values").select(T.plain_greek(F.col("value")).alias("token"), F.col("value").alias("label"))


@R.add("j12_near_tokens", f"SELECT a, b, CAST(d AS BIGINT) AS d FROM {NEAR} WHERE d BETWEEN 1 AND 2")
def j12(spark, d):
    return labels.near_tokens(token_rules(spark, d))


#: Rule lines with what a lint has to find: short tokens, repeated ones, targets alike but for case, marks on a third.
LINT_RULES = f"""(SELECT value_id AS line, t AS token, CASE WHEN value_id % 7 = 0 THEN upper(value) ELSE value END AS target, value_id % 3 = 0 AS marked FROM
 (SELECT *, CASE WHEN value_id % 5 = 0 THEN substr(value, 1, 2) WHEN value_id % 11 = 0 THEN 'xyz' ELSE value END AS t FROM (SELECT * FROM type_values UNION ALL SELECT value_id + 100000, value FROM type_values WHERE value_id % 13 = 0)) WHERE t NOT LIKE '%-%' AND value NOT LIKE '%:%' AND value NOT LIKE '%-%')"""


def lint_rules(spark, d) -> DataFrame:
    """The same, written as rule lines and parsed."""
    v = table(spark, d, "type_values")
    v = v.unionByName(v.where("value_id % 13 = 0").withColumn("value_id", F.col("value_id") + 100_000))
    i = F.col("value_id")
    t = F.when(i % 5 == 0, F.substring("value", 1, 2)).when(i % 11 == 0, "xyz").otherwise(F.col("value"))
    kept = v.withColumn("t", t).where("t NOT LIKE '%-%' AND value NOT LIKE '%:%' AND value NOT LIKE '%-%'")
    line = F.concat(F.when(i % 3 == 0, "[[X]] ").otherwise(""), F.col("t"), F.lit(" -> "), F.when(i % 7 == 0, F.upper("value")).otherwise(F.col("value")), F.lit(' : ["v"]'))
    return labels.parse_lint_lines(kept.select(line.alias("value"), i.alias("ord")))


PLAIN = "replace(strip_accents(lower(trim({}))), 'ς', 'σ')"
LINT_SQL = f"""WITH r AS (SELECT * FROM {LINT_RULES})
SELECT 'repeated token' AS section, token AS a, string_agg(line, ',' ORDER BY line) AS b, count(*) AS value FROM r GROUP BY token HAVING count(*) > 1
UNION ALL SELECT 'repeated target', target, string_agg(line, ',' ORDER BY line), count(*) FROM r GROUP BY target HAVING count(*) > 1
UNION ALL SELECT 'alike targets', x.target, y.target, NULL FROM (SELECT DISTINCT target FROM r) x JOIN (SELECT DISTINCT target FROM r) y ON {PLAIN.format('x.target')} = {PLAIN.format('y.target')} AND x.target < y.target
UNION ALL SELECT 'total', 'rules', NULL, count(*) FROM r UNION ALL SELECT 'total', 'tokens', NULL, count(DISTINCT token) FROM r UNION ALL SELECT 'total', 'targets', NULL, count(DISTINCT target) FROM r UNION ALL SELECT 'total', 'marked', NULL, count(*) FROM r WHERE marked
UNION ALL SELECT 'token length', CAST(length(token) AS VARCHAR), NULL, count(*) FROM r GROUP BY 2
UNION ALL SELECT 'short token', token, target, line FROM r WHERE NOT marked AND length(token) <= 2"""


@R.add("l07_rule_lint", LINT_SQL)
def l07(spark, d):
    """All sections but those of edits and likeness, which have queries of their own (j12, l09)."""
    return labels.lint(lint_rules(spark, d)).where("section NOT IN ('near tokens', 'unlike target')")


@R.add("j13_residual_targets", f"SELECT t.collection_slug, t.n AS target, coalesce(b.n, 0) AS done, greatest(0, t.n - coalesce(b.n, 0)) AS residual FROM (SELECT collection_slug, count(DISTINCT external_link) AS n FROM edm_labeled WHERE language_code IN ('ELL', 'NONE') AND collection_slug IS NOT NULL GROUP BY 1) t LEFT JOIN (SELECT collection_slug, count(DISTINCT external_link) AS n FROM external_pdfs WHERE {OK} AND pdf_links_count > 0 GROUP BY 1) b USING (collection_slug)")
def j13(spark, d):
    t = table(spark, d, "edm_labeled").where("language_code IN ('ELL', 'NONE') AND collection_slug IS NOT NULL").groupBy("collection_slug").agg(F.count_distinct("external_link").alias("target"))
    b = x(spark, d).where("status_code = 200 AND pdf_links_count > 0").groupBy("collection_slug").agg(F.count_distinct("external_link").alias("done"))
    return t.join(b, "collection_slug", "left").select("collection_slug", "target", F.coalesce("done", F.lit(0)).alias("done"), F.greatest(F.lit(0), F.col("target") - F.coalesce("done", F.lit(0))).alias("residual"))


# ---- aggregations --------------------------------------------------------------------------------------------------

A01 = "SELECT collection_slug, count(*) AS total, count(*) FILTER (WHERE language_code = 'ELL') AS ELL, count(*) FILTER (WHERE language_code = 'NONE') AS NONE FROM edm_labeled WHERE collection_slug IS NOT NULL GROUP BY collection_slug"


@R.add("a01_language_shares", f"SELECT collection_slug, total, ELL, NONE, round(ELL / total, 9) AS pct_ELL, round(NONE / total, 9) AS pct_NONE, ELL / total >= 0.5 AS ELL_high, NONE / total >= 0.5 AS NONE_high FROM ({A01})")
def a01(spark, d):
    return profiles.language_shares(table(spark, d, "edm_labeled"), 0.5).withColumn("pct_ELL", F.round("pct_ELL", 9)).withColumn("pct_NONE", F.round("pct_NONE", 9))


@R.add("a02_language_totals", f"SELECT count(*) AS n_collections, count(*) FILTER (WHERE ELL / total >= 0.5) AS n_ell_high, count(*) FILTER (WHERE NONE / total >= 0.5) AS n_none_high FROM ({A01})")
def a02(spark, d):
    s = profiles.language_shares(table(spark, d, "edm_labeled"), 0.5)
    return s.agg(F.count(F.lit(1)).alias("n_collections"), F.count_if("ELL_high").alias("n_ell_high"), F.count_if("NONE_high").alias("n_none_high"))


@R.add("a03_ranked_collections", f"SELECT row_number() OVER (ORDER BY ELL / total DESC, total DESC, collection_slug) AS place, collection_slug, total, ELL FROM ({A01}) WHERE ELL / total >= 0.5")
def a03(spark, d):
    from pyspark.sql import Window

    s = profiles.language_shares(table(spark, d, "edm_labeled"), 0.5).where("ELL_high")
    place = F.row_number().over(Window.orderBy(F.desc("pct_ELL"), F.desc("total"), "collection_slug"))  # a row per collection
    return s.select(place.cast("long").alias("place"), "collection_slug", "total", "ELL")


@R.add("a04_collection_summary", """WITH b AS (SELECT collection_slug, coalesce(language_code, '') AS lc, coalesce(type, 'NA') AS type FROM edm_labeled WHERE collection_slug IS NOT NULL),
t AS (SELECT collection_slug, count(*) AS total_items, count(*) FILTER (WHERE lc = 'ELL') AS num_ELL, count(*) FILTER (WHERE lc = 'NONE') AS num_NONE FROM b GROUP BY 1),
r AS (SELECT *, row_number() OVER (PARTITION BY collection_slug ORDER BY n DESC, type) AS r FROM (SELECT collection_slug, type, count(*) AS n FROM b GROUP BY 1, 2)),
l AS (SELECT collection_slug, list(type ORDER BY r) AS types_top, list(n ORDER BY r) AS types_top_counts, list(round(n / t.total_items, 9) ORDER BY r) AS types_top_pcts FROM r JOIN t USING (collection_slug) WHERE r <= 5 GROUP BY 1)
SELECT collection_slug, total_items, num_ELL, round(num_ELL / total_items, 9) AS pct_ELL, num_NONE, round(num_NONE / total_items, 9) AS pct_NONE, types_top, types_top_counts, types_top_pcts FROM t JOIN l USING (collection_slug)""")
def a04(spark, d):
    s = profiles.collection_summary(table(spark, d, "edm_labeled"), 5)
    return s.withColumn("pct_ELL", F.round("pct_ELL", 9)).withColumn("pct_NONE", F.round("pct_NONE", 9)).withColumn("types_top_pcts", F.transform("types_top_pcts", lambda v: F.round(v, 9)))


@R.add("a05_top_types", "SELECT type, count(*) AS n FROM edm_labeled WHERE type IS NOT NULL GROUP BY type ORDER BY n DESC, type LIMIT 20")
def a05(spark, d):
    return profiles.top_counts(table(spark, d, "edm_labeled"), "type", 20)


@R.add("a06_status_counts", "SELECT status_code, count(*) AS n FROM edm_metadata_full WHERE status_code IS NOT NULL GROUP BY status_code ORDER BY status_code")
def a06(spark, d):
    return table(spark, d, "edm_metadata_full").where("status_code IS NOT NULL").groupBy("status_code").agg(F.count(F.lit(1)).alias("n")).orderBy("status_code")


@R.add("a07_top_collections", "SELECT collection_slug, count(*) AS n FROM edm_metadata_full WHERE collection_slug IS NOT NULL GROUP BY 1 ORDER BY n DESC, collection_slug LIMIT 10")
def a07(spark, d):
    return profiles.top_counts(table(spark, d, "edm_metadata_full"), "collection_slug", 10)


@R.add("a08_distinct_and_repeated", "SELECT count(DISTINCT edm_url) AS n_distinct, count(*) - count(DISTINCT edm_url) AS n_repeated FROM edm_metadata_full")
def a08(spark, d):
    return table(spark, d, "edm_metadata_full").agg(F.count_distinct("edm_url").alias("n_distinct"), (F.count(F.lit(1)) - F.count_distinct("edm_url")).alias("n_repeated"))


@R.add("a09_link_targets", "SELECT collection_slug, count(DISTINCT external_link) AS n FROM edm_labeled WHERE language_code IN ('ELL', 'NONE') AND external_link IS NOT NULL GROUP BY 1")
def a09(spark, d):
    return table(spark, d, "edm_labeled").where("language_code IN ('ELL', 'NONE') AND external_link IS NOT NULL").groupBy("collection_slug").agg(F.count_distinct("external_link").alias("n"))


@R.add("a10_links_with_documents", "SELECT collection_slug, count(DISTINCT external_link) AS n FROM external_pdfs WHERE status_code = 200 AND pdf_links_count > 0 GROUP BY 1")
def a10(spark, d):
    return x(spark, d).where("status_code = 200 AND pdf_links_count > 0").groupBy("collection_slug").agg(F.count_distinct("external_link").alias("n"))


NULLABLE = ["collection_slug", "page_number", "external_link", "status_code", "retries", "pdf_links_json", "refined_pdf_links_count", "fetched_at"]


@R.add("a11_null_counts", "SELECT " + ", ".join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in NULLABLE) + " FROM external_pdfs")
def a11(spark, d):
    return profiles.null_counts(x(spark, d).select(*NULLABLE))


@R.add("a12_describe", "SELECT count(elapsed_s) AS n, round(avg(elapsed_s), 6) AS mean, round(stddev_samp(elapsed_s), 6) AS std, min(elapsed_s) AS min, round(quantile_cont(elapsed_s, 0.25), 6) AS p25, round(quantile_cont(elapsed_s, 0.5), 6) AS p50, round(quantile_cont(elapsed_s, 0.75), 6) AS p75, max(elapsed_s) AS max FROM external_pdfs")
def a12(spark, d):
    s = profiles.describe(x(spark, d), "elapsed_s")
    return s.select("n", *[F.round(c, 6).alias(c) for c in ("mean", "std")], "min", *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max")


@R.add("a13_coverage", "SELECT count(external_link) AS n, round(100.0 * count(external_link) / count(*), 6) AS pct FROM edm_metadata_full")
def a13(spark, d):
    return table(spark, d, "edm_metadata_full").agg(F.count("external_link").alias("n"), F.round(100.0 * F.count("external_link") / F.count(F.lit(1)), 6).alias("pct"))


@R.add("a14_json_validity", "SELECT CASE WHEN metadata_json IS NULL OR NOT json_valid(metadata_json) THEN 'invalid' WHEN trim(metadata_json) IN ('{}', '[]', 'null', '\"\"', '0', 'false') THEN 'empty' WHEN status_code = 200 THEN 'filled' ELSE 'uncounted' END AS kind, count(*) AS n FROM edm_metadata_full GROUP BY 1")
def a14(spark, d):
    j = F.col("metadata_json")
    both = F.from_json(F.concat(F.lit("["), j, F.lit(',"end of text"]')), "array<string>")
    valid = (F.size(both) == 2) & (F.get(both, F.lit(1)) == "end of text")
    kind = F.when(~F.coalesce(valid, F.lit(False)), "invalid").when(F.trim(j).isin("{}", "[]", "null", '""', "0", "false"), "empty").when(F.col("status_code") == 200, "filled").otherwise("uncounted")
    return table(spark, d, "edm_metadata_full").groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@R.add("a15_error_rate", "SELECT g.collection_slug, coalesce(n_rows, 0) AS n_rows, coalesce(n_counted, 0) AS n_counted, coalesce(n_ok, 0) AS n_ok, round(CASE WHEN n_rows IS NULL THEN 100 WHEN n_counted = 0 THEN 0 ELSE (n_counted - n_ok) * 100.0 / n_counted END, 6) AS error_pct FROM (SELECT DISTINCT collection_slug FROM (SELECT collection_slug FROM collections UNION ALL SELECT collection_slug FROM external_pdfs UNION ALL SELECT 'without rows')) g LEFT JOIN (SELECT collection_slug, count(*) AS n_rows, count(*) FILTER (WHERE NOT coalesce(status_code IN (-3, 404), false)) AS n_counted, count(*) FILTER (WHERE status_code = 200) AS n_ok FROM external_pdfs GROUP BY 1) e ON e.collection_slug IS NOT DISTINCT FROM g.collection_slug")
def a15(spark, d):
    groups = table(spark, d, "collections").select("collection_slug").union(x(spark, d).select("collection_slug")).union(spark.createDataFrame([("without rows",)], "collection_slug string")).distinct()
    return profiles.error_rate(x(spark, d), ["collection_slug"], groups).withColumn("error_pct", F.round("error_pct", 6))


@R.add("a16_attempt_counters", "SELECT collection_slug, count(*) AS attempted, count(*) FILTER (WHERE status_code = 200) AS ok, count(*) FILTER (WHERE status_code = 404) AS n404, count(*) FILTER (WHERE status_code = 500) AS n500, count(*) FILTER (WHERE status_code < 0) AS negative FROM external_pdfs GROUP BY 1")
def a16(spark, d):
    s, w = F.col("status_code"), profiles.count_when
    return x(spark, d).groupBy("collection_slug").agg(F.count(F.lit(1)).alias("attempted"), w(s == 200).alias("ok"), w(s == 404).alias("n404"), w(s == 500).alias("n500"), w(s < 0).alias("negative"))


@R.add("a18_unique_breakdown", """WITH b AS (SELECT collection_slug, external_link, arg_min(status_code, (CASE WHEN status_code = 200 THEN 0 WHEN status_code = 404 THEN 1 WHEN status_code >= 500 THEN 2 WHEN status_code < 0 THEN 3 ELSE 4 END) * 10000000000 + row_id) AS s FROM external_pdfs WHERE external_link IS NOT NULL AND status_code <> -3 GROUP BY 1, 2)
SELECT collection_slug, count(*) AS attempted, count(*) FILTER (WHERE s = 200) AS ok, count(*) FILTER (WHERE s = 404) AS n404, count(*) FILTER (WHERE s >= 500) AS n5xx, count(*) FILTER (WHERE s < 0) AS n_negative FROM b GROUP BY 1""")
def a18(spark, d):
    return profiles.unique_breakdown(x(spark, d), ["collection_slug"], "external_link", "row_id")


@R.add("a19_error_analysis", """WITH c AS (SELECT collection_slug, status_code, count(*) AS n FROM external_pdfs WHERE collection_slug IS NOT NULL AND status_code IS NOT NULL GROUP BY 1, 2),
t AS (SELECT collection_slug, status_code AS top_error, n AS top_error_count FROM c WHERE status_code <> 200 QUALIFY row_number() OVER (PARTITION BY collection_slug ORDER BY n DESC, status_code) = 1)
SELECT g.collection_slug, total, ok, total - ok AS fail, round((total - ok) * 100.0 / total, 6) AS error_pct, top_error, coalesce(top_error_count, 0) AS top_error_count FROM (SELECT collection_slug, CAST(sum(n) AS BIGINT) AS total, CAST(sum(CASE WHEN status_code = 200 THEN n ELSE 0 END) AS BIGINT) AS ok FROM c GROUP BY 1) g LEFT JOIN t USING (collection_slug)""")
def a19(spark, d):
    return profiles.error_analysis(x(spark, d)).withColumn("error_pct", F.round("error_pct", 6))


@R.add("a20_crawl_summary", "SELECT collection_slug, count(*) AS attempted, count(*) FILTER (WHERE status_code = 200) AS ok, count(*) FILTER (WHERE status_code = 500) AS n500, CAST(coalesce(sum(pdf_links_count), 0) AS BIGINT) AS links FROM external_pdfs GROUP BY 1")
def a20(spark, d):
    w, s = profiles.count_when, F.col("status_code")
    return x(spark, d).groupBy("collection_slug").agg(F.count(F.lit(1)).alias("attempted"), w(s == 200).alias("ok"), w(s == 500).alias("n500"), F.coalesce(F.sum("pdf_links_count"), F.lit(0)).alias("links"))


def _summary(src: int) -> str:
    return f"SELECT collection_slug, max(page_number) AS pages, max(pdf_links_count) AS links, max(collection_url) AS collection_url FROM external_pdfs WHERE {SRC} = {src} GROUP BY 1"


@R.add("a21_summary_merge", f"WITH o AS ({_summary(0)}), n AS ({_summary(1)}) SELECT coalesce(o.collection_slug, n.collection_slug) AS collection_slug, CASE WHEN o.pages IS NULL OR n.pages > o.pages THEN n.pages ELSE o.pages END AS pages, CASE WHEN o.links IS NULL OR n.links > o.links THEN n.links ELSE o.links END AS links, coalesce(o.collection_url, n.collection_url) AS collection_url FROM o FULL OUTER JOIN n ON o.collection_slug IS NOT DISTINCT FROM n.collection_slug")
def a21(spark, d):
    old, new = (p.groupBy("collection_slug").agg(F.max("page_number").alias("pages"), F.max("pdf_links_count").alias("links"), F.max("collection_url").alias("collection_url")) for p in parts(spark, d))
    return profiles.merge_summaries(old, new, "collection_slug", ["pages", "links"], ["collection_url"])


@R.add("a27_domain_rollup", """WITH r AS (SELECT coalesce(lower(regexp_extract(external_link, '^[a-zA-Z]+://([^/?#]*)', 1)), '') AS host, status_code, elapsed_s, epoch_us(fetched_at) AS t, coalesce(status_code <> -3, false) AS done FROM external_pdfs),
g AS (SELECT host, count(*) FILTER (WHERE done) AS completed, count(*) FILTER (WHERE done AND status_code <> 200) AS failed, count(*) FILTER (WHERE NOT done) AS remaining, min(t) FILTER (WHERE done) AS a, max(t) FILTER (WHERE done) AS b FROM r GROUP BY 1)
SELECT host, completed, failed, remaining, round(CASE WHEN b > a AND completed > 0 THEN remaining * ((b - a) / 1e6) / completed END, 3) AS eta_s FROM g""")
def a27(spark, d):
    return profiles.domain_rollup(x(spark, d), domain_of(F.col("external_link"))).drop("sum_elapsed").withColumn("eta_s", F.round("eta_s", 3))


@R.add("a31_length_histogram", "SELECT CAST(length(value) AS INTEGER) AS length, count(*) AS n FROM type_values GROUP BY 1")
def a31(spark, d):
    return table(spark, d, "type_values").groupBy(F.length("value").alias("length")).agg(F.count(F.lit(1)).alias("n"))


@R.add("a32_histogram", "WITH m AS (SELECT min(elapsed_s) AS lo, max(elapsed_s) AS hi FROM external_pdfs) SELECT CAST(least(floor((elapsed_s - lo) / ((hi - lo) / 20)), 19) + 1 AS BIGINT) AS bin, count(*) AS n FROM external_pdfs, m WHERE elapsed_s IS NOT NULL GROUP BY 1")
def a32(spark, d):
    return profiles.histogram(x(spark, d), "elapsed_s", 20)


@R.add("a34_flag_count", "SELECT count(*) FILTER (WHERE title_all_english) AS n FROM edm_labeled")
def a34(spark, d):
    return table(spark, d, "edm_labeled").agg(profiles.count_when(F.col("title_all_english")).alias("n"))


# ---- planning modes ------------------------------------------------------------------------------------------------

U = "(SELECT DISTINCT external_link AS url FROM edm_labeled WHERE external_link IS NOT NULL AND external_link <> '')"
PLANS = {
    "r01_full_rescan": ("full", False, "true"),
    "r02_retry": ("retry", False, "s.status IS DISTINCT FROM 200"),
    "r02_retry_resample": ("retry", True, "(s.status IS DISTINCT FROM 200 OR NOT coalesce(s.has_pdf, false))"),
    "r03_retry_only": ("retry_only", False, "s.url IS NOT NULL AND s.status IS DISTINCT FROM 200"),
    "r04_resume": ("resume", False, "NOT coalesce(s.has_pdf, false) AND s.status IS DISTINCT FROM 200"),
    "r04_resume_resample": ("resume", True, "NOT coalesce(s.has_pdf, false)"),
    "r05_fresh": ("fresh", False, "NOT coalesce(s.has_pdf, false)"),
    "r07_failed": ("failed", False, "s.status IS DISTINCT FROM 200"),
    "r07_failed_only": ("failed_only", False, "s.url IS NOT NULL AND s.status IS DISTINCT FROM 200"),
    "r08_unseen": ("unseen", False, "s.url IS NULL"),
}


def universe(spark, d) -> DataFrame:
    return table(spark, d, "edm_labeled").where("external_link IS NOT NULL AND external_link <> ''").select(F.col("external_link").alias("url")).distinct()


for _name, (_mode, _resample, _where) in PLANS.items():
    R.add(_name, f"SELECT u.url FROM {U} u LEFT JOIN {OVERLAY} s ON u.url = s.url WHERE {_where}")(lambda spark, d, m=_mode, r=_resample: planning.plan(universe(spark, d), state(spark, d), m, r))


@R.add("r06_without_skipped", f"SELECT u.url FROM {U} u WHERE u.url NOT IN (SELECT external_link FROM edm_labeled WHERE collection_slug LIKE 'ammos%' AND external_link IS NOT NULL)")
def r06(spark, d):
    skipped = table(spark, d, "edm_labeled").where("collection_slug LIKE 'ammos%'").select(F.col("external_link").alias("url"))
    return universe(spark, d).join(skipped, "url", "left_anti")


@R.add("r10_retry_pages", "SELECT collection_slug, page_number FROM (SELECT collection_slug, page_number, bool_or(status_code = 200) AS ok FROM edm_metadata_full WHERE page_number IS NOT NULL AND collection_slug IS NOT NULL GROUP BY 1, 2) WHERE NOT coalesce(ok, false)")
def r10(spark, d):
    g = table(spark, d, "edm_metadata_full").where("page_number IS NOT NULL AND collection_slug IS NOT NULL").groupBy("collection_slug", "page_number").agg(F.bool_or(F.col("status_code") == 200).alias("ok"))
    return g.where(~F.coalesce("ok", F.lit(False))).select("collection_slug", "page_number")


@R.add("r11_pages_to_fetch", "WITH t AS (SELECT collection_slug, CAST(ceil(max(item_count) / 30.0) AS BIGINT) AS total FROM collections WHERE item_count > 0 GROUP BY 1), l AS (SELECT collection_slug, max(page_number) AS last FROM edm_metadata_full GROUP BY 1), j AS (SELECT t.collection_slug, coalesce(l.last, 0) + 1 AS a, total FROM t LEFT JOIN l USING (collection_slug) WHERE coalesce(l.last, 0) + 1 <= total) SELECT collection_slug, unnest(range(a, total + 1)) AS page_number FROM j")
def r11(spark, d):
    totals = table(spark, d, "collections").where("item_count > 0").groupBy("collection_slug").agg(F.ceil(F.max("item_count") / 30.0).alias("total_pages"))
    return planning.pages_to_fetch(table(spark, d, "edm_metadata_full"), totals)


@R.add("r16_needs_discovery", "SELECT meta_id FROM edm_metadata_full WHERE trim(coalesce(external_link, '')) = '' OR lower(trim(external_link)) = 'not found'")
def r16(spark, d):
    return table(spark, d, "edm_metadata_full").where(planning.needs_discovery(F.col("external_link"))).select("meta_id")


@R.add("r19_first_link", "SELECT collection_slug, arg_min(external_link, page_number * 10000000000 + row_id) AS external_link FROM edm_labeled WHERE external_link <> '' AND page_number <= 8 GROUP BY 1")
def r19(spark, d):
    return table(spark, d, "edm_labeled").where("external_link <> '' AND page_number <= 8").groupBy("collection_slug").agg(F.min_by("external_link", F.struct("page_number", "row_id")).alias("external_link"))


# ---- windows, runs, models -----------------------------------------------------------------------------------------

RUN = f"""(SELECT *, sum(CASE WHEN {OK} THEN 0 ELSE 1 END) OVER w AS failed, count(*) OVER w AS completed, sum(CASE WHEN {OK} THEN 0 ELSE 1 END) OVER w * 100.0 / count(*) OVER w AS fail_pct FROM (SELECT row_id, status_code, CAST({SRC} AS INTEGER) AS run FROM external_pdfs) WINDOW w AS (PARTITION BY run ORDER BY row_id))"""
SAMPLES = f"(SELECT * FROM {RUN} WHERE completed % 100 = 0)"
DELTAS = f"(SELECT *, fail_pct - lag(fail_pct, 1, 0.0) OVER q AS delta_fail_pct, (fail_pct - lag(fail_pct, 1, 0.0) OVER q) / greatest(1, completed - lag(completed, 1, 0) OVER q) AS derivative FROM {SAMPLES} WINDOW q AS (PARTITION BY run ORDER BY completed))"


def run_rows(spark, d, *further: str) -> DataFrame:
    src = F.when(F.regexp_extract("shard", r"__(\d{8})_", 1) >= SPLIT, 1).otherwise(0)
    return x(spark, d).select("row_id", "status_code", src.alias("run"), *further)


def samples(spark, d) -> DataFrame:
    return runs.sampled(runs.running_counts(run_rows(spark, d), "run", "row_id"))


@R.add("w02_running_counts", f"SELECT row_id, run, completed, CAST(failed AS BIGINT) AS failed, round(fail_pct, 6) AS fail_pct FROM {RUN}")
def w02(spark, d):
    return runs.running_counts(run_rows(spark, d), "run", "row_id").select("row_id", "run", "completed", "failed", F.round("fail_pct", 6).alias("fail_pct"))


@R.add("w04_deltas", f"SELECT run, completed, round(delta_fail_pct, 6) AS delta_fail_pct, round(derivative, 8) AS derivative FROM {DELTAS}")
def w04(spark, d):
    return runs.deltas(samples(spark, d), "run").select("run", "completed", F.round("delta_fail_pct", 6).alias("delta_fail_pct"), F.round("derivative", 8).alias("derivative"))


@R.add("w05_projection", f"SELECT run, completed, round(greatest(0.0, least(100.0, fail_pct + derivative * (1000000 - completed))), 4) AS project_fail_pct, CAST(round_even(greatest(0.0, least(100.0, fail_pct + derivative * (1000000 - completed))) / 100 * 1000000, 0) AS BIGINT) AS project_fail_count FROM {DELTAS}")
def w05(spark, d):
    return runs.projected(runs.deltas(samples(spark, d), "run"), 1_000_000).select("run", "completed", F.round("project_fail_pct", 4).alias("project_fail_pct"), "project_fail_count")


@R.add("w06_moving_rate", f"SELECT run, round((max(failed) - min(failed)) / greatest(1, max(completed) - min(completed)), 8) AS moving_rate, count(*) AS n_samples FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY completed DESC) AS r FROM {SAMPLES}) WHERE r <= 10 GROUP BY run")
def w06(spark, d):
    return runs.moving_rate(samples(spark, d), "run").withColumn("moving_rate", F.round("moving_rate", 8))


@R.add("w08_acceleration", f"SELECT run, round(avg(dd), 10) AS mean_acceleration, round(stddev_pop(dd), 8) AS std_acceleration FROM (SELECT run, derivative - lag(derivative) OVER (PARTITION BY run ORDER BY completed) AS dd FROM {DELTAS}) GROUP BY run")
def w08(spark, d):
    return runs.acceleration(runs.deltas(samples(spark, d), "run"), "run").select("run", F.round("mean_acceleration", 10).alias("mean_acceleration"), F.round("std_acceleration", 8).alias("std_acceleration"))


@R.add("w09_ema", f"SELECT run, round(list_reduce(list_prepend(CAST(0 AS DOUBLE), list(CAST(fail_pct AS DOUBLE) ORDER BY completed)), lambda a, x: CASE WHEN a = 0 THEN x ELSE 0.3 * x + 0.7 * a END), 6) AS ema FROM {SAMPLES} GROUP BY run")
def w09(spark, d):
    s = samples(spark, d)
    return runs.ema(s, "run", "fail_pct", "completed").withColumn("ema", F.round("ema", 6))


STREAK = "(SELECT *, CASE WHEN status_code IS NOT DISTINCT FROM -1 THEN 1 ELSE 0 END AS hit, sum(CASE WHEN status_code IS NOT DISTINCT FROM -1 THEN 0 ELSE 1 END) OVER (PARTITION BY collection_slug ORDER BY row_id) AS isl FROM external_pdfs)"
STREAK = f"(SELECT row_id, collection_slug, CAST(sum(hit) OVER (PARTITION BY collection_slug, isl ORDER BY row_id) AS BIGINT) AS streak FROM {STREAK})"


@R.add("w10_timeout_streaks", f"SELECT * FROM {STREAK}")
def w10(spark, d):
    return runs.timeout_streaks(x(spark, d).select("row_id", "collection_slug", "status_code"), "collection_slug", "row_id").select("row_id", "collection_slug", "streak")


@R.add("w11_stopped_at", f"SELECT collection_slug, min(row_id) AS stopped_at FROM {STREAK} WHERE streak >= 3 GROUP BY 1")
def w11(spark, d):
    s = runs.timeout_streaks(x(spark, d).select("row_id", "collection_slug", "status_code"), "collection_slug", "row_id")
    return runs.stopped_at(s, "collection_slug", "row_id", 3)


@R.add("w11_skipped_rows", f"WITH s AS (SELECT collection_slug, min(row_id) AS stopped_at FROM {STREAK} WHERE streak >= 3 GROUP BY 1) SELECT x.row_id, CASE WHEN x.row_id > s.stopped_at THEN -1 ELSE x.status_code END AS status_code FROM external_pdfs x LEFT JOIN s ON x.collection_slug IS NOT DISTINCT FROM s.collection_slug")
def w11_rows(spark, d):
    s = runs.timeout_streaks(x(spark, d).select("row_id", "collection_slug", "status_code"), "collection_slug", "row_id")
    return runs.skip_after_stop(s, "collection_slug", "row_id", 3).select("row_id", "status_code")


@R.add("z11_cancelled_rows", "WITH c AS (SELECT row_id, status_code, count(*) OVER w AS n, sum(CASE WHEN status_code = 500 THEN 1 ELSE 0 END) OVER w AS b FROM external_pdfs WINDOW w AS (ORDER BY row_id)), a AS (SELECT min(row_id) AS abort_at FROM c WHERE n >= 20 AND b / n > 0.05) SELECT row_id, CASE WHEN row_id > abort_at THEN -3 ELSE status_code END AS status_code FROM c, a")
def z11(spark, d):
    return runs.cancelled(x(spark, d).select("row_id", "status_code"), "row_id", 0.05, 20).select("row_id", "status_code")


@R.add("w13_abort_point", "SELECT collection_slug, min(row_id) AS abort_at FROM (SELECT collection_slug, row_id, count(*) OVER w AS n, sum(CASE WHEN status_code = 500 THEN 1 ELSE 0 END) OVER w AS b FROM external_pdfs WINDOW w AS (PARTITION BY collection_slug ORDER BY row_id)) WHERE n >= 20 AND b / n > 0.1 GROUP BY 1")
def w13(spark, d):
    return runs.abort_point(x(spark, d).select("row_id", "collection_slug", "status_code"), "collection_slug", "row_id", 0.1, 20)


@R.add("w14_progress_marks", f"WITH t AS (SELECT run, max(completed) AS total FROM {RUN} GROUP BY run), p AS (SELECT t.run, CAST(k AS INTEGER) AS pct, CAST(floor(k * total / 100.0) AS BIGINT) AS need FROM t, range(10, 101, 10) AS r(k)) SELECT p.run, p.pct, min(completed) AS completed FROM p JOIN {RUN} c ON c.run = p.run AND c.completed = greatest(1, p.need) GROUP BY 1, 2")
def w14(spark, d):
    return runs.progress_marks(runs.running_counts(run_rows(spark, d), "run", "row_id"), "run").select("run", "pct", "completed")


@R.add("w15_history", "SELECT external_link, CAST((n - 1) // 10 AS BIGINT) AS piece, list(status_code ORDER BY row_id) AS history FROM (SELECT *, row_number() OVER (PARTITION BY external_link ORDER BY row_id) AS n FROM external_pdfs WHERE external_link IS NOT NULL AND status_code IS NOT NULL) GROUP BY 1, 2")
def w15(spark, d):
    rows = x(spark, d).where("external_link IS NOT NULL AND status_code IS NOT NULL")
    return merge.history(rows, "external_link", "row_id", "status_code", 10)


@R.add("d01_linear_model", f"SELECT run, count(*) AS n, round(regr_slope(fail_pct, completed), 9) AS slope, round(regr_intercept(fail_pct, completed), 5) AS intercept, round(regr_r2(fail_pct, completed), 6) AS r2 FROM {SAMPLES} WHERE completed > 0 AND fail_pct > 0 GROUP BY run")
def d01(spark, d):
    m = runs.linear_models(samples(spark, d), "run", 830_313, positive=True)
    return m.select("run", "n", F.round("slope", 9).alias("slope"), F.round("intercept", 5).alias("intercept"), F.round("r2", 6).alias("r2"))


@R.add("d03_curve_models")
def d03(spark, d):
    return runs.curve_models(samples(spark, d), "run", 830_313)


@R.add("d06_ensemble")
def d06(spark, d):
    return runs.ensemble(runs.curve_models(samples(spark, d), "run", 830_313), "run", 830_313)


_BAD = lambda c: f"CASE WHEN {c} < 0 OR ({c} >= 400 AND {c} <> 404) THEN 1 ELSE 0 END"


def unique_sql(key: str, rows: str = "external_pdfs") -> str:
    """Links tried so far and how they stand, after every row of each ``key``."""
    return f"""(WITH r AS (SELECT row_id, {key} AS key, external_link, status_code AS s, coalesce(external_link IS NOT NULL AND status_code <> -3, false) AS valid,
 CASE WHEN status_code = 200 THEN 0 WHEN status_code = 404 THEN 1 WHEN status_code >= 500 THEN 2 WHEN status_code < 0 THEN 3 ELSE 4 END * 10000000000 + row_id AS k FROM {rows}),
b AS (SELECT *, arg_min(s, CASE WHEN valid THEN k END) OVER (PARTITION BY key, external_link ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS old, arg_min(s, CASE WHEN valid THEN k END) OVER (PARTITION BY key, external_link ORDER BY row_id ROWS UNBOUNDED PRECEDING) AS new FROM r)
SELECT row_id, key, row_number() OVER w AS completed, CAST(sum(CASE WHEN valid AND old IS NULL THEN 1 ELSE 0 END) OVER w AS BIGINT) AS attempted, CAST(sum(CASE WHEN valid THEN CAST(new = 200 AS INTEGER) - CAST(coalesce(old = 200, false) AS INTEGER) ELSE 0 END) OVER w AS BIGINT) AS ok,
 CAST(sum(CASE WHEN valid THEN {_BAD('new')} - {_BAD('old')} ELSE 0 END) OVER w AS BIGINT) AS failish FROM b WINDOW w AS (PARTITION BY key ORDER BY row_id))"""


def stages_sql(key: str, rows: str, every: int, columns: str) -> str:
    """The stage machine as a recursion over the ticks of each key."""
    return f"""WITH RECURSIVE t AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY completed) AS i FROM (SELECT * FROM {unique_sql(key, rows)} QUALIFY row_number() OVER (PARTITION BY key, (completed - 1) // {every} ORDER BY completed DESC) = 1)),
st AS (SELECT key, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS row_id, CAST(0 AS BIGINT) AS completed, 'A' AS stage, CAST(0 AS BIGINT) AS base, CAST(0 AS BIGINT) AS last, CAST(0 AS BIGINT) AS streak, false AS lowered, false AS dropped, CAST(0 AS BIGINT) AS jok, CAST(0 AS BIGINT) AS jbad FROM (SELECT DISTINCT key FROM t)
 UNION ALL SELECT key, i, row_id, completed, CASE WHEN up THEN CASE stage WHEN 'A' THEN 'B' ELSE 'C' END ELSE stage END, CASE WHEN up THEN attempted ELSE base END, attempted, CASE WHEN s >= 1000 AND NOT lowered THEN 0 ELSE s END, lowered OR s >= 1000, s >= 1000 AND lowered, CASE WHEN new >= 200 THEN ok ELSE jok END, CASE WHEN new >= 200 THEN failish ELSE jbad END
 FROM (SELECT *, CASE WHEN new >= 200 THEN CASE WHEN ok <= jok AND greatest(0, failish - jbad) / new >= 0.95 THEN streak + new ELSE 0 END ELSE streak END AS s,
   attempted - base >= 300 AND (stage = 'A' AND 100.0 * failish / attempted >= 20 OR stage = 'B' AND 100.0 * failish / attempted >= 30) AS up
  FROM (SELECT t.key, t.i, t.row_id, t.completed, t.attempted, t.ok, t.failish, stage, base, last, streak, lowered, jok, jbad, greatest(0, t.attempted - last) AS new FROM st JOIN t ON t.key = st.key AND t.i = st.i + 1 WHERE NOT st.dropped)))
SELECT {columns}, stage, streak AS negative_streak, lowered, dropped FROM st WHERE i > 0"""


@R.add("z04_stage_machine", stages_sql(f"CAST({SRC} AS INTEGER)", "external_pdfs", 250, "key AS run, completed"))
def z04(spark, d, every: int = 250):
    """Ticks of every run, at each ``every``-th completion and at its last, through the stage machine."""
    counts = runs.unique_counts(run_rows(spark, d, "external_link"), "run", "external_link", "row_id")
    counts = runs.running_counts(counts, "run", "row_id")
    ticks = runs.ticks(counts.select("run", "completed", "attempted", "ok", "failish"), "run", "completed", every)
    return runs.stage_machine(ticks, "run", "completed")


@R.add("z13_counts_so_far", f"SELECT row_id, attempted, ok, failish FROM {unique_sql('collection_slug')}")
def z13_counts(spark, d):
    """Of every collection after every row: links tried so far, and how many of them stand at 200 or at a failure; what the
    stages and streaks are decided by."""
    return runs.unique_counts(x(spark, d).select("row_id", "collection_slug", "external_link", "status_code"), "collection_slug", "external_link", "row_id").select("row_id", "attempted", "ok", "failish")


@R.add("z08_waves", "SELECT collection_slug, CAST(floor((row_number() OVER (ORDER BY n DESC, collection_slug) - 1) / 10) AS BIGINT) AS wave FROM (SELECT collection_slug, count(*) AS n FROM edm_labeled WHERE collection_slug IS NOT NULL GROUP BY 1)")
def z08(spark, d):
    from pyspark.sql import Window

    g = table(spark, d, "edm_labeled").where("collection_slug IS NOT NULL").groupBy("collection_slug").agg(F.count(F.lit(1)).alias("n"))
    return g.select("collection_slug", F.floor((F.row_number().over(Window.orderBy(F.desc("n"), "collection_slug")) - 1) / 10).alias("wave"))  # a row per collection


# ---- scalar functions ----------------------------------------------------------------------------------------------


@R.add("x01_last_segment", "SELECT DISTINCT collection_url, regexp_extract(collection_url, '/([^/]*)/*$', 1) AS slug FROM collections")
def x01(spark, d):
    return table(spark, d, "collections").select("collection_url", last_segment(F.col("collection_url")).alias("slug")).distinct()


@R.add("x05_domain", "SELECT external_link, coalesce(lower(regexp_extract(external_link, '^[a-zA-Z]+://([^/?#]*)', 1)), '') AS host FROM edm_labeled WHERE external_link IS NOT NULL")
def x05(spark, d):
    return table(spark, d, "edm_labeled").where("external_link IS NOT NULL").select("external_link", domain_of(F.col("external_link")).alias("host"))


@R.add("x06_normalize", "SELECT value_id, replace(strip_accents(lower(trim(value))), 'ς', 'σ') AS norm FROM type_values")
def x06(spark, d):
    return table(spark, d, "type_values").select("value_id", F.replace(T.normalized("value"), F.lit("ς"), F.lit("σ")).alias("norm"))


_PICK = lambda *names: "coalesce(" + ", ".join(f"nullif(json_extract_string(j, '$.\"{n}\"'), '')" for n in names) + ", '')"


@R.add("x13_json_fields", "SELECT meta_id, " + ", ".join(f"{_PICK(*n)} AS {k}" for k, n in {"language": ("Γλώσσα", "Language", "language"), "type": ("Τύπος", "Type", "type"), "title": ("Τίτλος", "Title", "title")}.items()) + " FROM (SELECT meta_id, CASE WHEN json_valid(metadata_json) THEN CAST(metadata_json AS JSON) END AS j FROM edm_metadata_full) ORDER BY meta_id")
def x13(spark, d):
    f = labels.fields(F.col("metadata_json"))
    return table(spark, d, "edm_metadata_full").select("meta_id", *[c.alias(k) for k, c in f.items()])


@R.add("x15_all_english", "SELECT doc_id, text <> '' AND NOT regexp_matches(text, '[^\\P{L}A-Za-z]') AS english FROM documents")
def x15(spark, d):
    return table(spark, d, "documents").select("doc_id", T.all_english(F.col("text")).alias("english"))


@R.add("x16_json_list", "SELECT row_id, pdf_links_json AS links FROM external_pdfs WHERE pdf_links_json IS NOT NULL")
def x16(spark, d):
    """The link lists read and written again as the harvest writes them."""
    return x(spark, d).where("pdf_links_json IS NOT NULL").select("row_id", T.json_list(F.from_json("pdf_links_json", "array<string>")).alias("links"))


@R.add("x18_levenshtein", f"SELECT label_id, CAST(levenshtein({ONE_BYTE.format('label_el')}, lower(label_en)) AS INTEGER) AS d FROM type_labels")
def x18(spark, d):
    return table(spark, d, "type_labels").select("label_id", F.levenshtein(T.plain_greek(F.col("label_el")), F.lower("label_en")).alias("d"))


@R.add("x19_similarity")
def x19(spark, d):
    return table(spark, d, "type_labels").select("label_id", F.round(T.similarity("label_el", "label_en"), 6).alias("ratio"))


@R.add("x30_shard_times", "SELECT shard, regexp_extract(shard, '__([a-z_]+)__', 1) AS slug, strptime(regexp_extract(shard, '__([0-9]{8}_[0-9]{6})__', 1), '%Y%m%d_%H%M%S') AS written FROM shard_manifest")
def x30(spark, d):
    return table(spark, d, "shard_manifest").select("shard", F.regexp_extract("shard", "__([a-z_]+)__", 1).alias("slug"), F.to_timestamp(F.regexp_extract("shard", r"__(\d{8}_\d{6})__", 1), "yyyyMMdd_HHmmss").cast("timestamp_ntz").alias("written"))


# ---- labelling and mining ------------------------------------------------------------------------------------------


def rules(spark, d) -> tuple[DataFrame, DataFrame]:
    """(language rules, type rules) as normalised tokens."""
    lang = spark.createDataFrame(_LANGS, "token string, label string, ord int")
    t = labels.parse_type_rules(rule_lines(spark, d)).select(F.explode("values").alias("v"), "label", "ord")
    return lang, t.select(T.normalized("v").alias("token"), "label", "ord")


_LANGS = [("ελληνικ", "ELL", 1), ("ell", "ELL", 2), ("gre", "ELL", 3), ("αγγλικ", "ENG", 4), ("eng", "ENG", 5), ("fre", "FRA", 6), ("γαλλικ", "FRA", 7)]
_FIELD = {"lang": _PICK("Γλώσσα", "Language", "language"), "type": _PICK("Τύπος", "Type", "type"), "title": _PICK("Τίτλος", "Title", "title")}
L05 = f"""WITH m AS (SELECT meta_id, {', '.join(f'{v} AS {k}' for k, v in _FIELD.items())} FROM (SELECT meta_id, CASE WHEN json_valid(metadata_json) THEN CAST(metadata_json AS JSON) END AS j FROM edm_metadata_full)),
lr AS (SELECT * FROM (VALUES {', '.join(f"('{t}', '{c}', {o})" for t, c, o in _LANGS)}) v(token, label, ord)),
tr AS (SELECT {PLAIN.format('v')} AS token, label, ord FROM (SELECT unnest([label_el, label_en]) AS v, label_en AS label, label_id AS ord FROM type_labels)),
l AS (SELECT lang, norm, coalesce((SELECT label FROM lr WHERE token = norm ORDER BY ord DESC LIMIT 1), (SELECT label FROM lr WHERE contains(norm, token) ORDER BY length(token) DESC, ord LIMIT 1), 'OTHER') AS code FROM (SELECT DISTINCT lang, {PLAIN.format('lang')} AS norm FROM m)),
t AS (SELECT type, norm, coalesce((SELECT label FROM tr WHERE token = norm ORDER BY ord LIMIT 1), (SELECT label FROM tr WHERE contains(norm, token) OR contains(token, norm) ORDER BY length(token) DESC, ord LIMIT 1), 'NA') AS label FROM (SELECT DISTINCT type, {PLAIN.format('type')} AS norm FROM m))
SELECT meta_id, title <> '' AND NOT regexp_matches(title, '[^\\P{{L}}A-Za-z]') AS title_all_english, CASE WHEN l.norm = '' THEN 'NONE' ELSE code END AS language_code, CASE WHEN t.norm = '' THEN 'NA' ELSE t.label END AS type FROM m JOIN l USING (lang) JOIN t USING (type)"""


@R.add("l05_label_records", L05)
def l05(spark, d):
    lang, types = rules(spark, d)
    return labels.label_records(table(spark, d, "edm_metadata_full").select("meta_id", "metadata_json"), "metadata_json", lang, types).drop("metadata_json")


@R.add("l04_type_labels", """WITH r AS (SELECT unnest([label_el, label_en]) AS v, label_en AS label, label_id AS ord FROM type_labels), n AS (SELECT replace(strip_accents(lower(trim(v))), 'ς', 'σ') AS token, label, ord FROM r),
v AS (SELECT value, replace(strip_accents(lower(trim(value))), 'ς', 'σ') AS norm FROM type_values)
SELECT value, coalesce((SELECT label FROM n WHERE n.token = v.norm ORDER BY ord LIMIT 1), (SELECT label FROM n WHERE contains(v.norm, n.token) OR contains(n.token, v.norm) ORDER BY length(n.token) DESC, ord LIMIT 1), 'NA') AS label FROM v""")
def l04(spark, d):
    _, types = rules(spark, d)
    out = labels.match_rules(table(spark, d, "type_values"), "value", types, True, True)
    return out.select("value", F.coalesce("label", F.lit("NA")).alias("label"))


NG = "(SELECT DISTINCT value_id, substr(w, CAST(i AS INTEGER), 6) AS token FROM (SELECT value_id, w, unnest(range(1, length(w) - 4)) AS i FROM (SELECT value_id, regexp_replace(unnest(string_split_regex(translate(lower(trim(value)), 'άέήίόύώϊϋΐΰς', 'αεηιουωιυιυσ'), '\\s+')), '[^\\p{L}]', '', 'g') AS w FROM type_values) WHERE length(w) >= 6))"


@R.add("t03_stem_coverage", f"SELECT token, count(*) AS n, round(count(*) / (SELECT count(*) FROM type_values), 6) AS fraction, row_number() OVER (ORDER BY count(*) DESC, token) AS rank FROM {NG} GROUP BY token")
def t03(spark, d):
    return mining.ranked(mining.coverage(table(spark, d, "type_values"), "value_id", "value")).withColumn("fraction", F.round("fraction", 6))


@R.add("t06_prefix_coverage", "WITH w AS (SELECT value_id, regexp_replace(unnest(string_split_regex(translate(lower(trim(value)), 'άέήίόύώϊϋΐΰς', 'αεηιουωιυιυσ'), '\\s+')), '[^\\p{L}]', '', 'g') AS w FROM type_values), p AS (SELECT DISTINCT value_id, substr(w, 1, 6) AS token FROM w WHERE length(w) >= 6) SELECT token, count(*) AS n, round(count(*) / (SELECT count(*) FROM type_values), 6) AS fraction, row_number() OVER (ORDER BY count(*) DESC, token) AS rank FROM p GROUP BY token")
def t06(spark, d):
    return mining.ranked(mining.coverage(table(spark, d, "type_values"), "value_id", "value", prefix=True)).withColumn("fraction", F.round("fraction", 6))


#: The greedy cover as a recursion: each step takes the token that most values not yet covered have.
COVER = f"""(WITH RECURSIVE n AS (SELECT * FROM {NG}), g AS (
 SELECT CAST(0 AS BIGINT) AS step, CAST('' AS VARCHAR) AS token, CAST(0 AS BIGINT) AS gain, CAST([] AS BIGINT[]) AS ids
 UNION ALL SELECT step + 1, b.token, b.gain, list_concat(ids, (SELECT list(value_id) FROM n WHERE n.token = b.token AND NOT list_contains(ids, n.value_id)))
 FROM g, LATERAL (SELECT c.token, c.gain FROM (SELECT n.token, count(*) FILTER (WHERE NOT list_contains(g.ids, n.value_id)) AS gain, count(*) AS size FROM n GROUP BY n.token) c ORDER BY c.gain DESC, c.size DESC, c.token LIMIT 1) b
 WHERE len(ids) < (SELECT CAST(floor(0.8 * count(*)) AS BIGINT) FROM type_values) AND b.gain > 0)
SELECT step, token, gain, CAST(len(ids) AS BIGINT) AS covered FROM g WHERE step > 0)"""


@R.add("t04_greedy_cover", f"SELECT * FROM {COVER}")
def t04(spark, d):
    return mining.greedy_cover(table(spark, d, "type_values"), "value_id", "value", 0.8)
