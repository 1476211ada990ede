import itertools
import random
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from harvestry.functions.urls import page_of, spelling_of
from harvestry.llm import fusion
from harvestry.llm.fusion import _dependence, claims_by_page, fuse_pages, source_weights

X = "row_id bigint, shard string, collection_slug string, page_number bigint, edm_url string, status_code bigint, retries bigint, k1 string, claims int, status int"
U = "https://host.example/edm/a_b/0123456789"
SAME = [U, U + "/", U + "//", U + "#x", U + "#", U + "\n", " " + U + "\n", U.replace("https", "http"), U.replace("host.", "HOST."), U.replace(".example", ".example:443"), U + "?utm=1", U.replace("0123", "%30123"), U.replace("/edm", "//edm"), U.replace("/edm", "/./edm"), U.replace("/edm", "/portal/../edm"), U.replace("https://", "https://user@")]
OTHER = [U + "?part=1", U + "?sid=3&part=2", U[:-1] + "8", U.upper(), U.replace("host", "hosts"), U.replace(".example", ".example:8080"), U.replace("a_b", "a%2Fb")]


def test_page_of(spark):
    df = spark.createDataFrame([(u,) for u in [*SAME, *OTHER, None, ""]], "u string").select("u", page_of(F.col("u")).alias("p"), spelling_of(F.col("u")).alias("s"))
    got = {r["u"]: (r["p"], r["s"]) for r in df.collect()}
    assert len({got[u][0] for u in SAME}) == 1, {u: got[u][0] for u in SAME}
    assert len({got[u][0] for u in OTHER}) == len(OTHER) and not {got[u][0] for u in OTHER} & {got[U][0]}
    assert got[None] == (None, 0) and got[U][1] == 0 and all(0 <= s < 256 for _, s in got.values())


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 2) for r in rows], X)


def test_keeps_the_row_of_the_merge_order(spark):
    rng = random.Random(4)
    rows = [(i, f"external_pdfs__s__2023{rng.randint(1, 12):02d}01_000000__1", rng.choice(["s", "t", None]), rng.choice([1, None]), rng.choice([*SAME[:6], *OTHER[:2], None]), rng.choice([200, 404, 500, -1, None]), rng.choice([None, -1, 0, 1, 5])) for i in range(400)]
    rows += [(400 + i, None, "hot", 1, U, rng.choice([404, -1]), i % 3) for i in range(300)]
    got = {r["row_id"]: r["n_rows"] for r in fuse_pages(rows_of(spark, rows)).collect()}

    def page(u):
        return None if u is None else (unquote(u.strip()).lower().split("#")[0].split("?")[0].rstrip("/").replace("http:", "https:"), "part=1" in u, "part=2" in u)

    want = {}
    for _, g in itertools.groupby(sorted(rows, key=lambda r: repr((r[2], r[3], page(r[4])))), key=lambda r: (r[2], r[3], page(r[4]))):
        g = list(g)
        want[max(g, key=lambda r: (r[5] == 200, r[6] or 0, r[0]))[0]] = len(g)
    assert got == want


def copied(waves=("01", "02", "03", "04", "05", "06")):
    """Waves 1 to 3 are as often right as 4 and 5, but share their errors; wave 6 tells the truth on all but the last pages."""
    rows, n = [], 0
    for page in range(103):
        codes = [200] * 6 if page < 70 else [404, 404, 404, 410 + page % 7, 500 + page % 5, 200] if page < 100 else [404, 404, 404, 503, 503, None]
        for wave, code in zip(waves, codes, strict=True):
            if code is not None:
                n += 1
                rows.append((n, f"external_pdfs__s__2023{wave}01_000000__1" if len(wave) == 2 else f"external_pdfs__s__{wave}01_000000__1", "s", page, U, code, page % 3))
    return rows


def test_copied_votes_lose_where_counting_would_let_them_win(spark):
    df = rows_of(spark, copied())
    pages, sources = claims_by_page(df)
    accuracy, free, weights = source_weights(pages, sources)
    assert sources == [202301, 202302, 202303, 202304, 202305, 202306]
    assert max(free[:3]) < 0.5 < min(free[3:]) and max(abs(a - b) for a in accuracy[:5] for b in accuracy[:5]) < 0.2
    fused = {r["row_id"]: r["status_code"] for r in fuse_pages(df).collect()}
    plain = {r["row_id"]: r["status_code"] for r in fuse_pages(df, weights=[1.0] * 6).collect()}
    assert fused.keys() == plain.keys()  # the merge order keeps the same rows
    assert sorted(set(fused.values())) == [200, 503] and sorted(set(plain.values())) == [200, 404]
    assert _dependence(0.8, 0.8, 0, 30, 0) > 0.99 > 0.5 > _dependence(0.8, 0.8, 0, 0, 30)


def test_more_sources_than_bits_of_a_number(spark, monkeypatch):
    few = source_weights(*claims_by_page(rows_of(spark, copied())))
    many = copied() + [(10_000 + k, f"external_pdfs__s__{1900 + k}0101_000000__1", "t", k // 2, U, 404, 0) for k in range(80)]
    pages, sources = claims_by_page(rows_of(spark, many))
    assert len(sources) == 86
    got = source_weights(pages, sources)
    at = [sources.index(202300 + k) for k in range(1, 7)]
    assert [got[2][i] for i in at] == pytest.approx(few[2])
    monkeypatch.setattr(fusion, "COUNTED", 7)
    monkeypatch.setattr(fusion, "WORD", 5)
    assert source_weights(pages, sources) == got


def test_fused_fields_and_empty_table(spark):
    rows = [(1, "a", "s", 1, U + "/", 404, 2), (2, "b", "s", 1, U, 200, None), (3, "c", "s", 1, U, 200, 1), (4, "c", "s", 1, U, 200, 1), (5, "d", "s", 1, U, 500, 9)]
    r = fuse_pages(rows_of(spark, rows)).first()
    assert (r["row_id"], r["n_rows"], r["status_code"], r["retries"], r["spelling"], r["url_row_id"]) == (4, 5, 200, 1, 0, 5)
    assert r["confidence"] == pytest.approx(1.0)
    assert fuse_pages(rows_of(spark, [])).count() == 0
    lone = fuse_pages(rows_of(spark, [(1, None, None, None, None, None, None)])).first()
    assert (lone["row_id"], lone["status_code"], lone["n_rows"]) == (1, None, 1)
    long = fuse_pages(rows_of(spark, [(1, "a", "s", 1, "https://h.example/" + "x/../" * 20_000 + "y", 200, 0), (2, "a", "s", 1, "https://h.example/y", 200, 0)])).collect()
    assert [r["row_id"] for r in long] == [2]
