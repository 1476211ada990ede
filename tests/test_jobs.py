"""Whole flows over small files."""

import json

import pytest

from harvestry import jobs

X = "collection_slug string, page_number bigint, edm_url string, status_code bigint, retries bigint"


def test_merge_shards(spark, tmp_path):
    master, shards = str(tmp_path / "master"), str(tmp_path / "shards")
    spark.createDataFrame([("s", 1, "u", 404, 0), ("s", 1, "v", 200, 0)], X).write.parquet(master)
    spark.createDataFrame([("s", 1, "u", 200, 1), ("s", 2, "w", 500, 0)], X).coalesce(1).write.parquet(shards)
    (tmp_path / "shards" / "broken.parquet").write_text("nothing")
    assert jobs.merge_shards(spark, master, shards, dry_run=True) == {"ok_before": 1, "ok_after": 2, "written": False, "gain": 1}
    assert spark.read.parquet(master).count() == 2
    report = jobs.main(["merge-shards", "--master", master, "--shards", shards, "--compression", "zstd"], spark)
    assert report["gain"] == 1 and sorted(r["status_code"] for r in spark.read.parquet(master).collect()) == [200, 200, 500]


def test_label_and_profiles(spark, tmp_path):
    at = str(tmp_path)
    (tmp_path / "lang.txt").write_text("ελληνικά -> ELL\nbad line\nfrançais -> FRA [note]\n")
    (tmp_path / "types.txt").write_text('[[X]] αρθρ -> άρθρο : ["Άρθρο", "article"]\ndis -> διατριβή : ["thesis"]\nbroken -> x : [\n')
    metas = [{"Γλώσσα": "Νέα Ελληνικά", "Τύπος": "ARTICLE", "Title": "Abc"}, {"Language": "klingon", "Type": "phd thesis"}, {"title": "Ωραίο"}]
    rows = [("s", json.dumps(m, ensure_ascii=False)) for m in metas] + [("s", None), (None, "{")]
    spark.createDataFrame(rows, "collection_slug string, metadata_json string").write.parquet(f"{at}/in")
    report = jobs.label(spark, f"{at}/in", f"{at}/out", f"{at}/lang.txt", f"{at}/types.txt")
    assert report == {"rows": 5, "language_counts": {"ELL": 1, "OTHER": 1, "NONE": 3}, "type_counts_top": {"NA": 3, "άρθρο": 1, "διατριβή": 1}, "title_all_english_true": 1}
    assert jobs.language_stats(spark, f"{at}/out", f"{at}/shares", 0.5) == {"collections": 1, "ell_high": 0, "none_high": 1}
    assert jobs.collection_summary(spark, f"{at}/out", f"{at}/summary", 2) == {"collections": 1}
    assert spark.read.parquet(f"{at}/summary").first()["types_top"][0] == "NA"


def test_failure_report(spark, tmp_path):
    head = "t_epoch,completed,failed,fail_pct,speed_ps,eta_s,remaining\n"
    for name, slope in (("a.csv", 0.001), ("b.csv", 0.002)):
        (tmp_path / name).write_text(head + "".join(f"1,{x},{int(x * 0.1)},{5 + slope * x},1,1,1\n" for x in range(100, 3100, 100)))
    told = jobs.failure_report(spark, f"{tmp_path}/a.csv,{tmp_path}/b.csv", str(tmp_path / "report.json"), 10_000)
    report = json.loads((tmp_path / "report.json").read_text())
    assert [r["run"] for r in report["runs"]] == ["combined", "run_1", "run_2"] and told["high_failure"]
    linear = {r["run"]: m["prediction"] for r in report["runs"] for m in r["models"] if m["model"] == "linear"}
    assert linear["run_1"] == pytest.approx(15.0) and linear["run_2"] == pytest.approx(25.0)


def test_mine_tokens(spark, tmp_path):
    (tmp_path / "f.json").write_text(json.dumps({"values_sorted": [["abcdefg", 3], ["abcdefx", 2], ["zzzzzzz", 1]]}))
    assert jobs.mine_tokens(spark, str(tmp_path / "f.json"), str(tmp_path / "out"), 0.6) == {"tokens": 1, "covered": 2, "values": 3}
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "out" / "ranked")).collect())
    assert "2\t0.6667\tabcdef" in lines and json.loads((tmp_path / "out" / "cover.json").read_text())[0]["token"] == "abcdef"


def test_fetch_metadata_resumes(spark, tmp_path):
    links, out = str(tmp_path / "links"), str(tmp_path / "out")
    spark.createDataFrame([("s", "c", 1, u) for u in ("http://h/a", "http://h/b", "http://h/c")] + [("t", "c", 2, "http://h/a"), ("t", "c", 3, None)], "collection_slug string, collection_url string, page_number bigint, edm_url string").write.parquet(links)
    page = '<a class="right-column-title-link" href="/x">o</a><div class="form-horizontal fieldset container-fluid"><div class="form-group"><label class="item-label">K</label><div class="item-control-static">v</div></div></div>'

    def server(*found):
        return lambda url, headers: (200, page, None) if url[-1] in found else (500, None, None)

    assert jobs.fetch_metadata(spark, links, out, fetcher=server("a")) == {"fetched": 3, "ok": 1, "written": True}
    rows = {(r["collection_slug"], r["edm_url"][-1]): r for r in spark.read.parquet(out).collect()}
    assert set(rows) == {("s", "a"), ("s", "b"), ("s", "c"), ("t", "a")} and json.loads(rows["t", "a"]["metadata_json"]) == {"K": "v"} and rows["s", "a"]["external_link"] == "http://h/x"
    assert jobs.fetch_metadata(spark, links, out, resume=True, fetcher=server("a", "b")) == {"fetched": 0, "ok": 0, "written": False}
    assert jobs.fetch_metadata(spark, links, out, resume=True, retries=2, retry_only=True, fetcher=server("b")) == {"fetched": 2, "ok": 1, "written": True}
    state = {(r["collection_slug"], r["edm_url"][-1]): (r["status_code"], r["retries"]) for r in spark.read.parquet(out).collect()}
    assert state == {("s", "a"): (200, 0), ("t", "a"): (200, 0), ("s", "b"): (200, 0), ("s", "c"): (500, 2)}
    assert jobs.fetch_metadata(spark, links, str(tmp_path / "one"), limit=1, fetcher=server("a"))["fetched"] == 1


def test_probe_links(spark, tmp_path):
    spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "external_link string").write.parquet(str(tmp_path / "in"))
    assert jobs.probe_links(spark, str(tmp_path / "in"), str(tmp_path / "out"), fetcher=lambda u, h: (200 if u == "a" else -1, "", None)) == {"200": 1, "0": 1}
