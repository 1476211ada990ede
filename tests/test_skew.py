from collections import Counter

from pyspark.sql import functions as F

from harvestry.operators.skew import chunked, collection_results

L = "row_id bigint, collection_slug string, language_code string, type string, edm_url string, _chunk int, _block int"
C = "collection_slug string, item_count bigint"


def test_chunks_have_equal_size(spark):
    df = spark.range(1, 5001).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 > 0, "hot").otherwise((F.col("id") % 30).cast("string")).alias("k"))
    pieces, _, chunk = chunked(df, "k", "row_id", 100, 300)
    out = pieces.groupBy("k", chunk).count().collect()
    for k in {r["k"] for r in out}:
        sizes = [r["count"] for r in sorted((r for r in out if r["k"] == k), key=lambda r: r[chunk])]
        assert all(s == 100 for s in sizes[:-1])


def test_results_match_brute_force(spark):
    rows = []
    for i in range(1, 901):
        slug = None if i % 10 == 0 else "hot" if i % 2 else f"c{i % 5}"
        rows.append((i, slug, ["ELL", "ENG", None][i * i % 3], [None, "a", "b", "c"][i % 4], None if i % 17 == 0 else f"u{i % 40}?part={i}", 1, 2))
    claims = spark.createDataFrame([("hot", 10), ("hot", 50), ("only", 3), ("c1", None)], C)
    got = {r["collection_slug"]: r for r in collection_results(spark.createDataFrame(rows, L), claims, 2, 37).collect()}
    assert got["only"]["n_rows"] == 0 and got["only"]["claimed_minus_found"] == 3
    for slug in {r[1] for r in rows}:
        own = [r for r in rows if r[1] == slug]
        lang = [r[2] or "" for r in own]
        r = got[slug]
        assert r["n_rows"] == len(own)
        assert r["language_switches"] == sum(a != b for a, b in zip(lang, lang[1:], strict=False))
        assert r["n_items"] == len({x[4].split("?")[0] for x in own if x[4]})
        top = sorted(Counter(x[3] or "NA" for x in own).items(), key=lambda x: (-x[1], x[0]))[:2]
        assert r["top_types"] == "|".join(f"{a}={n}" for a, n in top)
    assert got["hot"]["claimed_items"] == 50


def test_empty(spark):
    assert collection_results(spark.createDataFrame([], L), spark.createDataFrame([], C)).count() == 0
