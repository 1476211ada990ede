"""Queries of the general training-data operators (compaction, pivoting, skew)."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.operators.compaction import compact, plan_groups
from harvestry.operators.pivoting import discover_attributes, explode_fields, field_counts, fields_of, wide_records
from harvestry.operators.skew import collection_results
from harvestry.plans.registry import Registry, table

R = Registry()
TARGET = 64 << 20


def _plan(target: int) -> str:
    return f"""
WITH files AS (SELECT shard, max(n_rows) AS n_rows, greatest(coalesce(max(n_bytes), 0), 0) AS n_bytes FROM shard_manifest WHERE shard IS NOT NULL GROUP BY shard),
cum AS (SELECT *, coalesce(sum(n_bytes) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start_byte FROM files),
plan AS (SELECT shard, n_rows, n_bytes, CAST(start_byte AS BIGINT) AS start_byte, CAST(floor(start_byte / {target}.0) AS BIGINT) AS group_id FROM cum)"""


#: Nothing may be lost or doubled: the counts of the source are the counts written, and the last column is 0 by demand.
_REPORT = """,
src AS (SELECT shard, count(*) AS n FROM external_pdfs GROUP BY shard),
lo AS (SELECT group_id, min(shard) AS lo FROM plan GROUP BY group_id),
unl AS (SELECT s.shard, s.n, CASE WHEN s.shard IS NULL THEN -1 ELSE coalesce((SELECT max(group_id) FROM lo WHERE lo.lo <= s.shard), 0) END AS group_id FROM src s WHERE s.shard IS NULL OR s.shard NOT IN (SELECT shard FROM plan)),
per AS (SELECT p.group_id, 1 AS planned, 0 AS unlisted, p.n_bytes, p.n_rows AS stated, coalesce(s.n, 0) AS n FROM plan p LEFT JOIN src s USING (shard)
        UNION ALL SELECT group_id, 0, 1, 0, NULL, n FROM unl)
SELECT group_id, CAST(sum(planned) AS BIGINT) AS files_planned, CAST(sum(unlisted) AS BIGINT) AS files_unlisted, CAST(sum(n_bytes) AS BIGINT) AS bytes_planned,
 CAST(sum(coalesce(stated, 0)) AS BIGINT) AS manifest_rows, CAST(sum(n) AS BIGINT) AS source_rows, CAST(sum(n) AS BIGINT) AS written_rows,
 CAST(count(*) FILTER (WHERE planned = 1 AND stated <> n) AS BIGINT) AS manifest_differs, CAST(count(*) FILTER (WHERE planned = 1 AND stated IS NULL) AS BIGINT) AS manifest_unstated,
 CAST(0 AS BIGINT) AS lost_or_doubled
FROM per GROUP BY group_id"""


@R.add("p3_compaction", _plan(TARGET) + _REPORT)
def p3_compaction(spark, d):
    return compact(table(spark, d, "external_pdfs"), table(spark, d, "shard_manifest"), TARGET)[0]


#: A target that makes many groups of the smaller test data too.
SMALL = 1 << 20


@R.add("p3_many_groups", _plan(SMALL) + _REPORT)
def p3_many_groups(spark, d):
    return compact(table(spark, d, "external_pdfs"), table(spark, d, "shard_manifest"), SMALL)[0]


@R.add("p3_rows_kept", "SELECT row_id, shard FROM external_pdfs")
def p3_rows_kept(spark, d):
    """The rows as they stand in the compacted files."""
    _, path = compact(table(spark, d, "external_pdfs"), table(spark, d, "shard_manifest"), SMALL)
    return spark.read.parquet(path).select("row_id", "shard")


@R.add("p3_plan", _plan(TARGET) + " SELECT * FROM plan")
def p3_plan(spark, d):
    return plan_groups(table(spark, d, "shard_manifest"), TARGET)


#: Records with their number of valued names, by the database's own JSON functions.
_FIELDS = """(SELECT m.meta_id, m.metadata_num_fields, coalesce(n, 0) AS n FROM edm_metadata_full m LEFT JOIN
 (SELECT t.meta_id, count(DISTINCT e.key) AS n FROM (SELECT meta_id, metadata_json FROM edm_metadata_full WHERE CASE WHEN json_valid(metadata_json) THEN json_type(metadata_json) = 'OBJECT' ELSE false END) t, json_each(t.metadata_json) e
  WHERE e.type <> 'NULL' AND (e.type <> 'VARCHAR' OR regexp_matches(json_extract_string(e.value, '$'), '[^\\s\\p{Z}\\x{85}\\x{1c}-\\x{1f}\\x{b}]')) GROUP BY 1) f USING (meta_id))"""


@R.add("p5_found", f"SELECT meta_id FROM {_FIELDS} WHERE metadata_num_fields IS NULL OR metadata_num_fields <> n")
def p5_found(spark, d):
    return field_counts(table(spark, d, "edm_metadata_full"), "meta_id", "metadata_json", "metadata_num_fields").where(~F.col("count_matches")).select("meta_id")


@R.add("p5_counts", f"SELECT meta_id, n AS n_fields, metadata_num_fields AS n_stated, coalesce(metadata_num_fields = n, false) AS count_matches FROM {_FIELDS}")
def p5_counts(spark, d):
    """The wide records' counts, with every column of theirs."""
    return wide_records(table(spark, d, "edm_metadata_full"), "meta_id", "metadata_json", "metadata_num_fields").select("meta_id", "n_fields", "n_stated", "count_matches")


@R.add("p5_wide")
def p5_wide(spark, d):
    return wide_records(table(spark, d, "edm_metadata_full"), "meta_id", "metadata_json", "metadata_num_fields")


@R.add("p5_names", """WITH e AS (SELECT t.meta_id, e.key FROM (SELECT meta_id, metadata_json FROM edm_metadata_full WHERE CASE WHEN json_valid(metadata_json) THEN json_type(metadata_json) = 'OBJECT' ELSE false END) t, json_each(t.metadata_json) e
 WHERE e.type <> 'NULL' AND (e.type <> 'VARCHAR' OR regexp_matches(json_extract_string(e.value, '$'), '[^\\s\\p{Z}\\x{85}\\x{1c}-\\x{1f}\\x{b}]'))) SELECT key AS name, count(DISTINCT meta_id) AS n_records, count(*) AS n_values FROM e GROUP BY 1""")
def p5_names(spark, d):
    return p5_attributes(spark, d).select("name", "n_records", "n_values")


@R.add("p5_attributes")
def p5_attributes(spark, d):
    return discover_attributes(explode_fields(fields_of(table(spark, d, "edm_metadata_full").select("meta_id", "metadata_json"), "metadata_json")))


@R.add("p6_collections", """
WITH base AS (SELECT row_id, collection_slug, coalesce(language_code, '') AS language, coalesce(type, 'NA') AS type, edm_url FROM edm_labeled),
lang AS (SELECT collection_slug, language, count(*) AS n FROM base GROUP BY ALL),
l AS (SELECT collection_slug, sum(n) AS n_rows, count(*) AS n_languages, arg_max(language, lpad(CAST(n AS VARCHAR), 12, '0') || language) AS main_language, sum(CASE WHEN language = 'ELL' THEN n ELSE 0 END) AS rows_ell FROM lang GROUP BY ALL),
ty AS (SELECT *, row_number() OVER (PARTITION BY collection_slug ORDER BY n DESC, type) AS r FROM (SELECT collection_slug, type, count(*) AS n FROM base GROUP BY ALL)),
t AS (SELECT collection_slug, string_agg(type || '=' || n, '|' ORDER BY r) AS top_types FROM ty WHERE r <= 5 GROUP BY ALL),
sw AS (SELECT collection_slug, count(*) FILTER (WHERE p <> language) AS language_switches FROM (SELECT collection_slug, language, lag(language) OVER (PARTITION BY collection_slug ORDER BY row_id) AS p FROM base) GROUP BY ALL),
i AS (SELECT collection_slug, count(DISTINCT regexp_replace(edm_url, '[?].*$', '')) AS n_items FROM base WHERE edm_url IS NOT NULL GROUP BY ALL),
c AS (SELECT collection_slug, max(item_count) AS claimed_items FROM collections GROUP BY ALL),
o AS (SELECT l.*, t.top_types, sw.language_switches, coalesce(i.n_items, 0) AS n_items FROM l JOIN t ON l.collection_slug IS NOT DISTINCT FROM t.collection_slug JOIN sw ON l.collection_slug IS NOT DISTINCT FROM sw.collection_slug LEFT JOIN i ON l.collection_slug IS NOT DISTINCT FROM i.collection_slug)
SELECT coalesce(o.collection_slug, c.collection_slug) AS collection_slug, CAST(coalesce(n_rows, 0) AS BIGINT) AS n_rows, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, CAST(coalesce(n_languages, 0) AS BIGINT) AS n_languages,
 main_language, CAST(coalesce(rows_ell, 0) AS BIGINT) AS rows_ell, CAST(coalesce(language_switches, 0) AS BIGINT) AS language_switches, top_types, claimed_items, CAST(claimed_items - coalesce(n_items, 0) AS BIGINT) AS claimed_minus_found
FROM o FULL OUTER JOIN c ON o.collection_slug IS NOT DISTINCT FROM c.collection_slug""")
def p6_collections(spark, d):
    return collection_results(table(spark, d, "edm_labeled"), table(spark, d, "collections"))
