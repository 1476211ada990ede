"""Queries of the training-data operators and, where SQL can say them, their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from harvestry.llm.canon import map_values
from harvestry.llm.fusion import fuse_pages
from harvestry.llm.leaks import find_leaks
from harvestry.llm.lookalikes import unify
from harvestry.llm.mixing import mix
from harvestry.llm.pii import entity_lines, redact
from harvestry.plans.registry import Registry, table

R = Registry()
#: A deployment passes its own.
KEY = b"key of this test corpus"


#: The page that an address leads to, in the database's own words: blanks around it, scheme, user, default port, letter case of
#: the host, empty and dot segments, percent signs, fragment and all parameters but ``part`` set aside.
_U = "regexp_replace(edm_url, '^[\\s\\x{200B}\\x{FEFF}]+|[\\s\\x{200B}\\x{FEFF}]+$', '', 'g')"
_PAGE = f"""(SELECT row_id, collection_slug, page_number, status_code, retries, CASE WHEN edm_url IS NULL THEN NULL ELSE
  lower(regexp_replace(regexp_replace(auth, '^[^@]*@', ''), ':(80|443)?$', '')) || '/' ||
  array_to_string(list_reduce(list_prepend(CAST([] AS VARCHAR[]), list_transform(string_split(url_decode(replace(path, '+', '%2B')), '/'), lambda e: [e])),
   lambda acc, e: CASE WHEN e[1] IN ('', '.') THEN acc WHEN e[1] = '..' THEN acc[:-2] ELSE list_concat(acc, e) END), '/') ||
  CASE WHEN part <> '' THEN '?part=' || part ELSE '' END END AS page
 FROM (SELECT *, regexp_extract(rest, '^//([^/?]*)', 1) AS auth, regexp_replace(regexp_replace(rest, '^//[^/?]*', ''), '[?].*$', '') AS path, regexp_extract(rest, '[?&;]part=([^&;]*)', 1) AS part
  FROM (SELECT *, regexp_replace(regexp_replace({_U}, '(?s)#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*:', '') AS rest FROM external_pdfs)))"""


@R.add("p1_found", f"SELECT arg_max(row_id, (CASE WHEN status_code = 200 THEN 1000000 ELSE 0 END + coalesce(retries, 0)) * 10000000000 + row_id) AS row_id FROM {_PAGE} GROUP BY collection_slug, page_number, page HAVING count(*) > 1")
def p1_found(spark, d):
    return fuse_pages(table(spark, d, "external_pdfs")).where("n_rows > 1").select("row_id")


@R.add("p1_fused")
def p1_fused(spark, d):
    """The fused records with the URL as most trusted sources write it."""
    rows = table(spark, d, "external_pdfs")
    fused = fuse_pages(rows)
    return fused.join(rows.select(F.col("row_id").alias("url_row_id"), "edm_url"), "url_row_id", "left").drop("url_row_id")


def _mapped(spark, d):
    return map_values(table(spark, d, "edm_labeled"), "type", table(spark, d, "type_labels"), "label_id", ["label_el", "label_en"], ["row_id", "type"])


@R.add("p2_found")
def p2_found(spark, d):
    return _mapped(spark, d).select("row_id", "label_id")


@R.add("p2_unmatched")
def p2_unmatched(spark, d):
    """Report of the values that stand for no entry."""
    return _mapped(spark, d).where(F.col("label_id") == -1).groupBy("type").agg(F.count(F.lit(1)).alias("n_rows"))


def _unified(spark, d):
    return unify(table(spark, d, "edm_labeled"), "type", table(spark, d, "type_values"), "value_id", "value", ["row_id", "type"])


@R.add("p4_found")
def p4_found(spark, d):
    return _unified(spark, d).where(F.col("value_id").isNotNull() & (F.col("type") != F.col("unified"))).select("row_id", "value_id")


@R.add("p4_unified")
def p4_unified(spark, d):
    return _unified(spark, d)


@R.add("p7_found")
def p7_found(spark, d):
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items")).select("doc_id", "item_id").distinct()


@R.add("p7_spans")
def p7_spans(spark, d):
    """Where to cut: merged removal spans in characters."""
    return find_leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


@R.add("p8_mixture")
def p8_mixture(spark, d):
    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


@R.add("p8_shares")
def p8_shares(spark, d):
    return mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


_FOLD = "lower(regexp_replace(trim(source), '[\\s-]+', '_', 'g'))"


@R.add("p8_shares_in_characters", f"""WITH g AS (SELECT {_FOLD} AS s, max(target_share) AS w, coalesce(max(max_repeats), 1) AS r, max(max_repeats) AS told FROM mix_targets WHERE source IS NOT NULL GROUP BY 1),
h AS (SELECT {_FOLD} AS s, count(*) AS n_docs, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS n FROM documents GROUP BY 1),
live AS (SELECT g.*, h.n, sum(w) OVER () AS total_w FROM g JOIN h ON g.s = h.s WHERE h.n > 0 AND w > 0),
p AS (SELECT CAST(floor(min(r * n * total_w / w)) AS BIGINT) AS tokens FROM live),
b AS (SELECT tokens, greatest(1, least(8192, greatest(tokens // 2000, 1))) AS block FROM p),
k AS (SELECT block, tokens // block AS slots, length(bin(tokens // block)) AS bits FROM b),
u AS (SELECT block, i, (list_sum(list_transform(range(bits), lambda j: ((i >> j) & 1) << (bits - 1 - j))) + 0.5) / pow(2, bits) AS u FROM (SELECT *, unnest(range(slots)) AS i FROM k)),
c AS (SELECT s, sum(w / total_w) OVER (ORDER BY s) AS c, max(s) OVER () AS last FROM live),
o AS (SELECT i, any_value(block) AS block, coalesce(min(s) FILTER (WHERE c > u), max(last)) AS s FROM u, c GROUP BY i),
t AS (SELECT live.s, least(count(*) * any_value(block), any_value(n * r)) AS taken FROM o JOIN live ON live.s = o.s GROUP BY 1)
SELECT coalesce(h.s, g.s) AS source, g.w AS target_share, g.told AS max_repeats, coalesce(h.n_docs, 0) AS n_docs, coalesce(h.n, 0) AS n_tokens, CAST(coalesce(t.taken, 0) AS BIGINT) AS tokens_taken,
 CAST(coalesce(ceil(t.taken / h.n), 0) AS BIGINT) AS repeats_used, round(coalesce(t.taken, 0) / (SELECT sum(taken) FROM t), 9) AS actual_share FROM h FULL OUTER JOIN g ON h.s = g.s LEFT JOIN t ON t.s = coalesce(h.s, g.s)""")
def p8_shares_in_characters(spark, d):
    """The same schedule over sizes that SQL can count: characters instead of tokens."""
    docs = table(spark, d, "documents").withColumn("size", F.length("text"))
    return mix(docs, table(spark, d, "mix_targets"), size="size")[1].withColumn("actual_share", F.round("actual_share", 9))


@R.add("p9_found")
def p9_found(spark, d):
    return entity_lines(table(spark, d, "documents"), KEY)


@R.add("p9_redacted")
def p9_redacted(spark, d):
    """The texts with typed placeholders; a deployment passes its own key."""
    return redact(table(spark, d, "documents"), KEY).select("doc_id", "text", "n_entities")
