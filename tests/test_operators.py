"""Hand-written cases of the harvest operators."""

import itertools
import json
import math
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from harvestry.functions import html as H
from harvestry.functions import text as T
from harvestry.functions.urls import domain_of, last_segment
from harvestry.operators import labels, merge, mining, planning, profiles, runs
from harvestry.sources import fetch, sinks, tables

KEY = ["collection_slug", "page_number", "edm_url"]
S = "collection_slug string, page_number bigint, edm_url string, status_code bigint, retries bigint, ord bigint"


def best(spark, *frames):
    dfs = [spark.createDataFrame([("s", 1, "u", *r) if len(r) == 3 else r for r in f], S) for f in frames]
    rows = merge.best_of(merge.union_ranked(dfs), KEY, merge.fetch_order("_src", "ord")).collect()
    return [(r["status_code"], r["retries"], r["ord"]) for r in rows]


def test_best_of_contract(spark):
    assert best(spark, [(200, 0, 1), (404, 5, 2)]) == [(200, 0, 1)]
    assert best(spark, [(200, 0, 1), (200, 0, 2)]) == [(200, 0, 2)]
    assert best(spark, [(200, 1, 1), (200, 0, 2)]) == [(200, 1, 1)]
    assert best(spark, [(-1, None, 1), (-1, 1, 2)]) == [(-1, 1, 2)]
    assert best(spark, [(500, -1, 2), (500, 0, 1)]) == [(500, 0, 1)]
    assert best(spark, [(200, 0, 9)], [(200, 0, 1)]) == [(200, 0, 1)]
    assert best(spark, [], [(404, 0, 1)]) == [(404, 0, 1)] and best(spark, []) == []
    assert len(best(spark, [(None, 1, "u", 200, 0, 1), (None, 1, "u", 200, 0, 2), (None, None, None, 1, 1, 1)])) == 2


def test_best_of_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["a", None]), rng.choice([1, 2, None]), rng.choice("xy"), rng.choice([200, 404, None]), rng.choice([None, -1, 0, 3]), i) for i in range(300)]
    want = {}
    for r in rows:
        k, v = r[:3], (r[3] == 200, r[4] or 0, r[5])
        want[k] = max(want.get(k, v), v)
    got = merge.best_of(spark.createDataFrame(rows, S), KEY, merge.fetch_order("ord")).collect()
    assert {(r["collection_slug"], r["page_number"], r["edm_url"]): r["ord"] for r in got} == {k: v[2] for k, v in want.items()}


@pytest.mark.parametrize("resample", [False, True])
def test_planning_modes(spark, resample):
    urls = [f"{s}-{p}" for s, p in itertools.product(["absent", "200", "404", "-1", "null"], [0, 1])]
    known = [(u, None if u.startswith("null") else int(u.rpartition("-")[0]), 0, u.endswith("1")) for u in urls if not u.startswith("absent")]
    universe, state = spark.createDataFrame([(u,) for u in urls], "url string"), spark.createDataFrame(known, "url string, status bigint, retries bigint, has_pdf boolean")
    k = {u: (s, p) for u, s, _, p in known}
    rule = {
        "full": lambda u: True, "unseen": lambda u: u not in k, "fresh": lambda u: not (u in k and k[u][1]),
        "retry": lambda u: u not in k or k[u][0] != 200 or (resample and not k[u][1]), "retry_only": lambda u: u in k and (k[u][0] != 200 or (resample and not k[u][1])),
        "resume": lambda u: not (u in k and k[u][1]) and (u not in k or k[u][0] != 200 or resample), "failed": lambda u: u not in k or k[u][0] != 200, "failed_only": lambda u: u in k and k[u][0] != 200,
    }
    for mode, keep in rule.items():
        assert {r["url"] for r in planning.plan(universe, state, mode, resample).collect()} == {u for u in urls if keep(u)}, mode
    with pytest.raises(ValueError):
        planning.plan(universe, state, "other")


def test_overlay_and_discovery(spark):
    st = "url string, status bigint, has_pdf boolean"
    out = merge.overlay(spark.createDataFrame([("a", 200, True), ("b", 404, False)], st), spark.createDataFrame([("a", None, False), ("c", 500, True)], st), "url", ["has_pdf"])
    assert {r["url"]: (r["status"], r["has_pdf"]) for r in out.collect()} == {"a": (None, True), "b": (404, False), "c": (500, True)}
    df = spark.createDataFrame([(None,), (" ",), ("Not Found",), ("http://x",)], "u string").select(planning.needs_discovery(F.col("u")).alias("n"))
    assert [r["n"] for r in df.collect()] == [True, True, True, False]


def test_error_rates(spark):
    rows = [("none", -3), ("none", 404), ("half", 200), ("half", 500), ("bad", -1), ("ok", 200), ("tie", 404), ("tie", 500), (None, 200)]
    df = spark.createDataFrame(rows, "collection_slug string, status_code bigint")
    assert {r["collection_slug"]: r["error_pct"] for r in profiles.error_rate(df, ["collection_slug"]).collect()} == {"none": 0.0, "half": 50.0, "bad": 100.0, "ok": 0.0, "tie": 100.0, None: 0.0}
    tops = {r["collection_slug"]: r["top_error"] for r in profiles.error_analysis(df).collect()}
    assert tops["tie"] == 404 and tops["ok"] is None and None not in tops


def test_unique_breakdown_and_summary(spark):
    df = spark.createDataFrame([("s", "u", 404, 1), ("s", "u", 200, 2), ("s", "v", -3, 3), ("s", "w", 403, 4), ("s", None, 200, 5)], "collection_slug string, url string, status_code bigint, o bigint")
    r = profiles.unique_breakdown(df, ["collection_slug"], "url", "o").first()
    assert (r["attempted"], r["ok"], r["n404"]) == (2, 1, 0)
    t = spark.createDataFrame([("s", "ELL", None), ("s", "NONE", "b"), ("s", None, "a"), (None, "ELL", "a")], "collection_slug string, language_code string, type string")
    r = profiles.collection_summary(t, 2).first()
    assert r["types_top"] == ["NA", "a"] and r["total_items"] == 3 and r["types_top_counts"] == [1, 1]
    assert profiles.histogram(df.limit(0), "o").count() == 0 and profiles.histogram(df, "o", 4).agg(F.sum("n")).first()[0] == 5


def test_streaks_and_stops(spark):
    df = spark.createDataFrame([("a", i, s) for i, s in enumerate([-1, -1, 200, -1, -1, -1, None])], "k string, o bigint, status_code bigint")
    out = runs.timeout_streaks(df, "k", "o")
    assert [r["streak"] for r in out.orderBy("o").collect()] == [1, 2, 0, 1, 2, 3, 0]
    assert runs.stopped_at(out, "k", "o", 3).first()["stopped_at"] == 5 and runs.stopped_at(out, "k", "o", 4).count() == 0


def test_ema_is_seeded_anew_at_zero(spark):
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate([0.0, 0.0, 4.0, 0.0])], "run string, o bigint, v double")
    assert runs.ema(df, "run", "v", "o").first()["ema"] == pytest.approx(2.8)


def test_stage_machine_moves_once_per_tick(spark):
    ticks = [("w", i, a, ok, bad) for i, (a, ok, bad) in enumerate([(299, 0, 299), (300, 200, 100), (600, 300, 200), (900, 400, 300), (1300, 400, 700), (1900, 400, 1300), (3000, 400, 2400), (9000, 400, 8400)])]
    out = runs.stage_machine(spark.createDataFrame(ticks, "w string, t bigint, attempted bigint, ok bigint, failish bigint"), "w", "t").orderBy("t").collect()
    assert [r["stage"] for r in out][:4] == ["A", "B", "C", "C"]
    assert out[-1]["dropped"] and not out[0]["lowered"]


def test_ticks_lose_no_key_and_no_tail(spark):
    rows = [(k, i, i * 10) for k, n in (("a", 7), ("b", 1), ("c", 6)) for i in range(1, n + 1)]
    out = runs.ticks(spark.createDataFrame(rows, "k string, n bigint, v bigint"), "k", "n", 3).collect()
    assert sorted(map(tuple, out)) == [("a", 3, 30), ("a", 6, 60), ("a", 7, 70), ("b", 1, 10), ("c", 3, 30), ("c", 6, 60)]


def test_every_collection_reaches_the_stage_machine(spark, small):
    from harvestry.plans.pages import w12
    from harvestry.plans.reference import x

    rows = x(spark, small).where("collection_slug IS NOT NULL")
    assert {r[0] for r in w12(spark, small).select("collection_slug").collect()} == {r[0] for r in rows.select("collection_slug").distinct().collect()}


def test_text_functions(spark):
    df = spark.createDataFrame([("ΤΕΎΧΟΣ ", "Abc, 1", "var maxPages = '7';"), (None, "", "x = 1; var itemsNum='61'; var pageSize='30';"), ("Ά", "Abc é", "pages: 4"), ("é", "123", "1.234 τεκμήρια"), ("x", "ΑΒ", "none")], "a string, b string, c string")
    r = df.select(T.normalized("a").alias("a"), T.all_english(F.col("b")).alias("b"), T.total_pages(F.col("c")).alias("c"), T.pages_source(F.col("c")).alias("d")).collect()
    assert [x["a"] for x in r] == ["τευχος", "", "α", "e", "x"]
    assert [x["b"] for x in r] == [True, False, False, True, False]
    assert [x["c"] for x in r] == [7, 3, 4, 42, None] and [x["d"] for x in r] == ["maxPages", "itemsNum", "pages", "count", "none"]
    w = spark.createDataFrame([("120",), ("Wed, 21 Oct 2015 07:28:00 GMT",), ("Wed, 21 Oct 2095 07:28:00 GMT",), ("soon",)], "v string").select(T.retry_after(F.col("v"), F.current_timestamp()).alias("w")).collect()
    assert w[0]["w"] == 120 and w[1]["w"] == 0 and w[2]["w"] > 0 and w[3]["w"] == 0
    u = spark.createDataFrame([("https://H.Example:80/a/b/",), (None,), ("x",)], "u string").select(domain_of(F.col("u")).alias("d"), last_segment(F.col("u")).alias("s")).collect()
    assert (u[0]["d"], u[0]["s"], u[1]["d"]) == ("h.example:80", "b", "")


def test_html_functions():
    base = "http://h.g/download/p/q?z=1"
    page = "<a href='../a.pdf'>x</a><a href='//h/x.pdf'>y</a><a href='?f=1'>z</a><a href='#a'>n</a><a href='javascript:x'>n</a><a href='mailto:m'>n</a><a href=x.pdf>n</a><a href='../a.pdf'>x</a>"
    assert H.document_links(page, base) == ["http://h.g/download/a.pdf", "http://h/x.pdf", "http://h.g/download/p/q?f=1"]
    assert H.document_links("<img src='s.pdf'><a href='h.pdf'>", "http://h/") == ["http://h/h.pdf", "http://h/s.pdf"]
    assert H.document_links("<iframe src='/web/viewer.html?file=/x.pdf&z'></iframe>", "http://h/")[0] == "http://h/x.pdf"
    assert H.document_links(None, "") == []
    g = "<div class='form-group'><label class='item-label'>K:</label>{}</div>"
    panel = "<div class='form-horizontal fieldset container-fluid'>" + g.format("<div class='item-control-static'></div>") + g.format("<div class='item-control-static'>v <b>w</b></div>") + "</div>"
    assert H.metadata_panel(panel) == {"K": "v w"} and H.metadata_panel("<div class='form-horizontal'>" + g + "</div>") == {}
    assert H.search_page("https://h/collections/x/search?page.page=3&a=1&b=", 5) == "https://h/collections/x/search?page.page=5&a=1&sortResults=SCORE"
    assert H.next_page("https://h/x?page.page=z") == "https://h/x?page.page=2"
    assert H.collections_of("<div><div class='collection_type'><i class='lastText'>1.234 τεκμήρια</i></div><a class='collection_title' href='/c'>C</a><a class='collection_title' href='/c'>again</a></div>", "https://h") == [("https://h/c", "C", 1234)]
    assert H.named_links("<a href='/i/a'></a><a href='/i/a'>A</a><a href='/i/b'>B</a>", "https://h", "/i/") == [("https://h/i/a", "a"), ("https://h/i/b", "B")]
    assert H.links_with("<a href='/edm/1'>", "https://h", "/edm/") == ["https://h/edm/1"] and H.external_link("", "x") is None


def test_rules(spark):
    lines = spark.createDataFrame([("[[X]] [[D]] tok -> lab, b : [\"v\", \"w\"]", 1), ("no arrow", 2), ("bad -> l : [broken", 3), ("tok -> other : []", 4)], "value string, ord int")
    out = {r["token"]: (r["label"], r["values"]) for r in labels.parse_type_rules(lines).collect()}
    assert out == {"tok": ("other", []), "bad": ("l", [])}
    langs = spark.createDataFrame([("ελληνικη γλωσσα -> ELL [note]", 1), ("x", 2), ("x -> A", 3), ("x -> B", 4)], "value string, ord int")
    assert {r["lhs"]: r["code"] for r in labels.parse_language_rules(langs).collect()} == {"ελληνικη γλωσσα": "ELL", "x": "B"}


def test_label_records(spark):
    rules = "token string, label string, ord int"
    lang = spark.createDataFrame([("ελληνικη γλωσσα", "ELL", 1), ("γλωσσα", "SHORT", 2), ("hrv", "CRT", 3)], rules)
    types = spark.createDataFrame([("διατριβη", "thesis", 1), ("αρθρο περιοδικου", "article", 2), ("αρθρο", "paper", 3), ("αρθρο", "late", 4)], rules)
    metas = [{"Γλώσσα": "Ελληνική γλώσσα"}, {"Γλώσσα": "", "Language": "hrv"}, {"Γλώσσα": " "}, {"language": "klingon"}, {"Γλώσσα": "xx ελληνικη γλωσσα yy"}, {"Τύπος": "ΑΡΘΡΟ"}, {"Type": "νέο αρθρο περιοδικου"}, {"Type": "διατρ"}, {"Type": "z"}]
    df = spark.createDataFrame([(i, json.dumps(m, ensure_ascii=False), "old") for i, m in enumerate(metas)] + [(90, "bad", "old"), (91, None, "old")], "id bigint, j string, type string")
    out = {r["id"]: (r["language_code"], r["type"]) for r in labels.label_records(df, "j", lang, types).collect()}
    assert [out[i][0] for i in range(5)] == ["ELL", "CRT", "NONE", "OTHER", "ELL"]
    assert [out[i][1] for i in range(5, 9)] == ["paper", "article", "thesis", "NA"] and out[90] == out[91] == ("NONE", "NA")


def test_greedy_cover(spark):
    df = spark.createDataFrame([(1, "abcdefg"), (2, "abcdefx"), (3, "zzzzzzz"), (4, "short")], "id bigint, v string")
    out = mining.greedy_cover(df, "id", "v", 0.75).orderBy("step").collect()
    assert [(r["token"], r["gain"], r["covered"]) for r in out] == [("abcdef", 2, 2), ("zzzzzz", 1, 3)]
    assert mining.greedy_cover(df, "id", "v", 1.0).count() == 2 and mining.coverage(df, "id", "v", prefix=True).count() == 2


def test_fetch_policies():
    waits = []
    policy = lambda **k: fetch.Policy(sleep=waits.append, **k)

    def server(*answers):
        told = iter(answers)
        return lambda url, headers: next(told)

    assert fetch.one("u", server((500, None, None), (404, None, None)), policy(retries=3))[0::3] == (404, 1)
    assert fetch.one("u", server((-1, None, None), (200, "b", None)), policy(retries=3))[2:] == ("b", 1) and waits == []
    assert fetch.one("u", server((503, None, 120.0), (200, "b", None)), policy())[0] == 200 and waits == [60.0]
    waits.clear()
    assert fetch.one("u", server((429, None, None), (200, "b", None)), policy(wait=1.0))[0] == 200 and 0.8 <= waits[0] <= 1.5 and 1.0 <= waits[1] <= 2.0
    waits.clear()
    assert fetch.one("u", server(*[(502, None, None)] * 4), policy(retries=3, backoff=0.5, again=(429, 500, 502, 503, 504)))[0::3] == (502, 3) and waits == [0.5, 1.0, 2.0]
    assert fetch.one("u", server((403, None, None)), policy(retries=3, again=(500,)))[0::3] == (403, 0)
    agents = []
    fetch.one("http://h/x", lambda u, h: agents.append(h["User-Agent"]) or (200, "", None), policy(agent_mode="per_domain"))
    assert agents[0] in fetch.AGENTS and agents[0] == fetch.agent_for("https://H/other", "per_domain") and fetch.agent_for("u", "random") in fetch.AGENTS and fetch.agent_for("u") == fetch.OWN_AGENT
    assert fetch.seconds_to_wait("120") == 120 and fetch.seconds_to_wait("Wed, 21 Oct 2015 07:28:00 GMT") == 0 and fetch.seconds_to_wait("Wed, 21 Oct 2095 07:28:00 GMT") > 1e9 and fetch.seconds_to_wait("soon") is None is fetch.seconds_to_wait(None)
    assert fetch.decoded("ά".encode("windows-1253"), None) == fetch.decoded("ά".encode(), None) == fetch.decoded("ά".encode("iso-8859-7"), "iso-8859-7") == "ά"


def test_fetch_counts_earlier_retries_and_asks_in_parallel(spark):
    def answers(url, headers):
        return {"a": (200, "body", None), "b": (404, None, None), "c": (500, None, None)}[url]

    urls = spark.createDataFrame([("a", 3), ("b", None), ("c", 1), (None, 1)], "url string, before bigint")
    out = {r["url"]: (r["status_code"], r["retries"], r["body"]) for r in fetch.fetch(urls, answers, fetch.Policy(retries=2, concurrency=3), earlier="before").collect()}
    assert out == {"a": (200, 3, "body"), "b": (404, 0, None), "c": (500, 3, None)}


def test_probe_asks_again_what_is_not_200(spark, tmp_path):
    at = str(tmp_path)

    def answers(url, headers):
        import os

        met = os.path.join(at, url)
        seen = os.path.exists(met)
        open(met, "a").write("x")
        return {"late": (200 if seen else -1, "", None), "gone": (404, None, None), "down": (-2, None, None), "slow": (-1, None, None), "ok": (200, "", None)}[url]

    urls = spark.createDataFrame([(u,) for u in ("late", "gone", "down", "slow", "ok", "ok", None)], "url string")
    assert {r["url"]: r["status_code"] for r in fetch.probe(urls, answers, rounds=2).collect()} == {"late": 200, "gone": 404, "down": -1, "slow": 0, "ok": 200}
    assert len((tmp_path / "ok").read_text()) == 1 and len((tmp_path / "slow").read_text()) == 3


def test_pages_are_read_from_snapshots_first(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    sinks.append_snapshots(spark.createDataFrame([("a", "old"), ("a", "old")], "url string, body string"), path)
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "url string")
    pages, fresh = fetch.with_snapshots(asked, spark.read.parquet(path), lambda u, h: (200 if u == "b" else 500, "new", None))
    assert {r["url"]: (r["status_code"], r["body"]) for r in pages.collect()} == {"a": (200, "old"), "b": (200, "new"), "c": (500, None)}
    sinks.append_snapshots(fresh, path)
    sinks.append_snapshots(fresh, path)
    assert sorted(r["url"] for r in spark.read.parquet(path).collect()) == ["a", "b"]
    assert fetch.with_snapshots(asked, None, lambda u, h: (404, None, None))[0].count() == 3


def test_a_failed_swap_leaves_the_table(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    sinks.swap(spark.range(5), path)
    monkeypatch.setattr(sinks, "_rename", lambda fs, a, b: False)
    with pytest.raises(OSError, match="cannot rename"):
        sinks.swap(spark.range(9), path)
    assert spark.read.parquet(path).count() == 5 and sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    monkeypatch.undo()
    copy = sinks.backup_copy(spark, path, str(tmp_path / "kept"))
    sinks.swap(spark.range(9), path)
    assert spark.read.parquet(copy).count() == 5 and spark.read.parquet(path).count() == 9 and sinks.backup_copy(spark, str(tmp_path / "none"), str(tmp_path)) is None


def test_ties_inside_one_batch_are_decided(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("s", 1, "u", 200, 0, 7), ("s", 1, "u", 200, 0, 9), ("s", 1, "u", 200, 0, 8)]
    assert sinks.merge_into(spark.createDataFrame(rows, S).repartition(3), path, KEY, "ord")
    assert [r["ord"] for r in spark.read.parquet(path).collect()] == [9]
    late = spark.createDataFrame([("s", 1, "u", 200, 0, 3)], S)
    sinks.merge_into(late, path, KEY, "ord")
    assert [r["ord"] for r in spark.read.parquet(path).collect()] == [9]
    sinks.merge_into(late, path, KEY)
    assert [r["ord"] for r in spark.read.parquet(path).collect()] == [3] and not sinks.merge_into(spark.createDataFrame([], S), path, KEY)


def test_tails_of_metrics_files(spark, tmp_path):
    head = "t_epoch,completed,failed,fail_pct,speed_ps,eta_s,remaining\n"
    files = {"good": head + "1,100,1,1.0,2.5,40,60\n2,200,4,2.0,3.5,20.5,10\nbroken,x\n", "long": head + "".join(f"1,{k},0,0,1,{k},9\n" for k in range(5000)), "empty": "", "header": head, "bad": head + "1,x,y,z,a,b,c\n"}
    for n, t in files.items():
        (tmp_path / n).write_text(t)
    out = {r["path"].rpartition("/")[2]: tuple(r)[1:] for r in tables.tail_metrics(spark, [str(tmp_path / n) for n in (*files, "missing")]).collect()}
    zero = (0, 0.0, 0.0, 0)
    assert out == {"good": (200, 20.5, 3.5, 10), "long": (4999, 4999.0, 1.0, 9), "empty": zero, "header": zero, "bad": zero, "missing": zero}


def test_names_of_pages():
    crumb = "<ul class='x breadcrumb'><li><a href='/'> First </a></li><li><a>Second</a></li></ul>"
    box, mark = "<div id='containerId'><i class='institution-name'>Box</i></div>", "<p data-testid='repository-name'>Mark</p>"
    assert [H.institution_name(h) for h in (crumb + box + mark, box + mark, mark, "<h1>x</h1><title>t</title>", None)] == ["First", "Box", "Mark", None, None]
    assert [H.collection_name(h) for h in ("<h1 class='title'> A <b>b</b></h1>", "<title>t</title>", "<h1></h1>", None)] == ["A b", None, None, None]
    assert [H.named_institution(h) for h in ("<a class='organisation_title'>L</a><h1>H</h1>", "<h1>H</h1>", "<title>a | T </title>", "")] == [("L", "link"), ("H", "heading"), ("T", "title"), (None, "none")]
    page = "<a href='/p/institutions/inst/'></a><h1>C</h1><p>1.234 τεκμήρια</p>"
    assert H.collection_detail(page, "https://h/p/collections/c/", "/institutions/") == {"institution_slug": "inst", "institution_name": "inst", "institution_url": "https://h/p/institutions/inst/", "collection_slug": "c", "collection_name": "C", "collection_url": "https://h/p/collections/c/", "item_count": 1234}
    assert H.collection_detail("<h1>C</h1>", "https://h/c", "/institutions/") is None


def test_rewritten_rules(spark):
    lines = spark.createDataFrame([(1, 'a -> A : ["x", "y"]', 8), (2, 'b -> B : ["y"]', 8), (3, "[[X]] en -> EN : [1]", 8), (4, "no list", 8), (5, 'b -> C : ["z"]', 8), (6, "[[D]] done", 8), (7, None, 8)], "ord int, value string, _line int")
    edits = spark.createDataFrame([(1, "merge", 1, None, "2"), (2, "merge", 1, None, "5"), (3, "merge", 4, None, "5"), (4, "relabel", None, "[[X]] en -> EN", "en -> number"), (5, "mark", None, "b -> ", "[[X]]"), (6, "mark", 5, None, "[[D]]"), (7, "mark", 6, None, "[[D]]")], "step int, action string, line bigint, prefix string, text string")
    out = {r["ord"]: r["value"] for r in labels.rewrite_rules(lines, edits).collect()}
    assert out == {1: 'a -> A : ["x", "y", "z"]', 2: '[[X]] b -> B : ["y"]', 3: "en -> number : [1]", 4: "no list", 5: '[[X]] b -> C : ["z"]', 6: "[[D]] done", 7: None}
    assert labels.rewrite_rules(lines, edits.limit(0)).count() == 7


def test_lint_sections(spark):
    rules = spark.createDataFrame([(1, "word", "Word", False), (2, "word", "other", False), (3, "words", "Άλλο", False), (4, "ab", "abc", False), (5, "ab", "zz", True), (6, "qqqqq", "thesis", False), (7, "wxyz", "άλλο", True)], "line bigint, token string, target string, marked boolean")
    out = {}
    for r in labels.lint(rules).collect():
        out.setdefault(r["section"], []).append((r["a"], r["b"], r["value"]))
    assert sorted(out["repeated token"]) == [("ab", "4,5", 2), ("word", "1,2", 2)] and "repeated target" not in out
    assert out["near tokens"] == [("word", "words", 1)] and sorted(out["alike targets"]) == [("Άλλο", "άλλο", None)]
    assert ("rules", None, 7) in out["total"] and ("marked", None, 2) in out["total"] and ("4", None, 3) in out["token length"]
    assert out["short token"] == [("ab", "abc", 4)] and sorted(out["unlike target"]) == [("qqqqq", "thesis", 6), ("word", "other", 2), ("words", "Άλλο", 3)]


def test_containing_texts_equal_brute_force(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randint(0, 9)))
    a, b = sorted({word() for _ in range(120)}), sorted({word() for _ in range(80)})
    got = {(r["long"], r["short"]) for r in labels._containing(spark.createDataFrame([(x,) for x in a], "long string"), spark.createDataFrame([(x,) for x in b], "short string")).collect()}
    assert got == {(x, y) for x in a for y in b if y and y in x}


def test_quartiles_equal_a_plain_sort(spark):
    import statistics

    for values in ([5.0], [1.0, 2.0], [3.0, 1.0, 1.0, 1.0, 9.0], [float(k * k % 37) for k in range(101)]):
        r = profiles.describe(spark.createDataFrame([(v,) for v in [*values, None]], "v double"), "v").first()
        q = statistics.quantiles(values, n=4, method="inclusive") if len(values) > 1 else values * 3
        assert [r["p25"], r["p50"], r["p75"]] == pytest.approx(q) and r["n"] == len(values)
    assert profiles.describe(spark.createDataFrame([], "v double"), "v").first()["n"] == 0


def test_groups_without_rows_and_merged_summaries(spark):
    df = spark.createDataFrame([("a", 200), (None, 500)], "k string, status_code bigint")
    groups = spark.createDataFrame([("a",), ("empty",), (None,)], "k string")
    assert {r["k"]: r["error_pct"] for r in profiles.error_rate(df, ["k"], groups).collect()} == {"a": 0.0, "empty": 100.0, None: 100.0}
    kind = "k string, n bigint, u string"
    old, new = spark.createDataFrame([("a", 5, None), ("b", None, "old")], kind), spark.createDataFrame([("a", 3, "new"), ("b", 2, "new"), ("c", 1, None)], kind)
    assert {tuple(r) for r in profiles.merge_summaries(old, new, "k", ["n"], ["u"]).collect()} == {("a", 5, "new"), ("b", 2, "old"), ("c", 1, None)}
    w = spark.createDataFrame([(10, 4, 2.0), (None, 7, 1.0), (3, 9, -1.0)], "target bigint, attempted bigint, speed double")
    r = profiles.fleet_rollup(w, spark.createDataFrame([(30,)], "target bigint")).first()
    assert (r["workers"], r["remaining"], r["queued"], r["speed"], r["eta_s"]) == (3, 6, 30, 3.0, 12.0)
    assert profiles.fleet_rollup(w.limit(0)).first()["eta_s"] == 0.0


def test_stored_tables_are_released(spark):
    import os

    from harvestry import session

    df, path = session.stored(spark.range(3), "test")
    assert df.count() == 3 and os.path.exists(path)
    assert session.release(spark) >= 1 and not os.path.exists(path) and session.release(spark) == 0


def test_sources_and_sinks(spark, tmp_path):
    assert tables.ensure_columns(spark.range(1), {"id": F.lit(9), "n": F.lit(0)}).first().asDict() == {"id": 0, "n": 0}
    o = {r["slug"]: r["wait"] for r in tables.overrides(spark, '{"a": {"wait": 1}, "b": {"wait": 2, "retries": 3}, "a": {"wait": 5}}').collect()}
    assert o == {"a": 5.0, "b": 2.0}
    (tmp_path / "m.csv").write_text("t_epoch,completed,failed,fail_pct,speed_ps,eta_s,remaining\n1,100,1,1.0,1,1,1\n2,200,4,2.0,1,1,1\nbroken,x\n")
    m = tables.metrics_csv(spark, str(tmp_path / "m.csv"))
    assert m.count() == 2 and tables.last_sample(m).first()["completed"] == 200
    rows = spark.createDataFrame([("s", 1, "u", 404, 0, 1)], S)
    path = str(tmp_path / "t")
    sinks.merge_into(rows, path, KEY)
    sinks.merge_into(spark.createDataFrame([("s", 1, "u", 200, 0, 2), ("s", 2, "u", 500, 0, 3)], S), path, KEY, compression="none")
    sinks.merge_into(rows.limit(0), path, KEY)
    assert sorted(r["status_code"] for r in spark.read.parquet(path).collect()) == [200, 500]
    sinks.swap(rows, path, backup=str(tmp_path / "old"))
    assert spark.read.parquet(path).count() == 1 and spark.read.parquet(str(tmp_path / "old")).count() == 2
    sinks.to_json(rows, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text())[0]["edm_url"] == "u"
    with pytest.raises(ValueError):
        sinks.to_json(spark.range(20), str(tmp_path / "r.json"), limit=10)


def test_linear_model_and_its_p_value(spark):
    df = spark.createDataFrame(pd.DataFrame({"run": "r", "completed": range(100, 2100, 100), "fail_pct": [2 + 0.001 * k for k in range(100, 2100, 100)]}))
    m = runs.linear_models(df, "run", 10_000).first()
    assert m["slope"] == pytest.approx(0.001) and m["at_target"] == pytest.approx(12.0) and m["stderr"] == pytest.approx(0, abs=1e-6)
    noisy = spark.createDataFrame([("r", c, float(p)) for c, p in ((1, 2), (2, 1), (3, 4), (4, 3), (5, 6), (-1, 50), (6, 0))], "run string, completed bigint, fail_pct double")
    m = runs.linear_models(noisy, "run", 10, positive=True).first()
    assert (m["n"], m["slope"], m["intercept"]) == (5, pytest.approx(1.0), pytest.approx(0.2))
    u = 2.5 / math.sqrt(3)  # three degrees of freedom have a closed form
    assert m["p_value"] == pytest.approx(1 - 2 / math.pi * (math.atan(u) + u / (1 + u * u)), rel=1e-9) and m["stderr"] == pytest.approx(0.4, abs=1e-9)


def curve(spark, f, xs=range(1000, 101_000, 1000)):
    return spark.createDataFrame([("r", x, float(f(x / 1000))) for x in xs], "run string, completed bigint, fail_pct double")


@pytest.mark.parametrize(("model", "f", "params"), [
    ("exponential", lambda x: 5 * math.exp(0.01 * x) + 1, (5, 0.01, 1)), ("exponential", lambda x: 0.5 * math.exp(0.03 * x) + 4, (0.5, 0.03, 4)),
    ("power_law", lambda x: 2 * x**0.5 + 0, (2, 0.5, None)), ("power_law", lambda x: 0.01 * x**1.7 + 3, (0.01, 1.7, None)),
    ("polynomial_2", lambda x: 0.002 * x * x - 0.1 * x + 7, (0.002, -0.1, 7)), ("polynomial_3", lambda x: 1e-5 * x**3 - 0.001 * x * x + 0.2 * x + 1, (1e-5, -0.001, 0.2, 1)),
])
def test_known_curves_are_recovered(spark, model, f, params):
    r = {r["model"]: r for r in runs.curve_models(curve(spark, f), "run", 200_000).collect()}[model]
    assert r["r_squared"] > 0.9999
    for got, want in zip(r["parameters"], params, strict=True):
        assert want is None or got == pytest.approx(want, rel=0.03, abs=0.03 if abs(want) >= 1 else 1e-6)
    value = f(200)
    assert r["prediction"] == pytest.approx(min(value, 100.0) if model in ("exponential", "power_law") else value, rel=0.02)
    assert r["failed_count"] == int(r["prediction"] * 2000)


def test_ensemble_leaves_the_linear_model_out(spark):
    kind = "run string, model string, prediction double, failed_count bigint, r_squared double, parameters array<double>"
    m = spark.createDataFrame([("r", "linear", 99.0, 1, None, None), ("r", "a", 10.0, 1, 0.9, None), ("r", "b", 20.0, 1, -3.0, None), ("q", "linear", 5.0, 1, None, None)], kind)
    out = {r["run"]: r for r in runs.ensemble(m, "run", 1000).collect()}
    assert set(out) == {"r"} and out["r"]["prediction"] == pytest.approx((9 + 2) / 1.0) and out["r"]["failed_count"] == 110 and out["r"]["components"] == 2
    a = spark.createDataFrame([("r", 0.1), ("q", -0.1), ("p", 0.2)], "run string, mean_acceleration double")
    r = runs.recommendations(m, a, 1000).first()
    assert (r["n"], r["mean"], r["high_failure"], r["accelerating"]) == (4, pytest.approx(33.5), True, True) and r["low"] == pytest.approx(33.5 - 1.96 * r["std"])


def test_report_of_runs_and_of_all_together(spark):
    rows = [(k, x, x // (10 if k == "a" else 5), 100 * (x // (10 if k == "a" else 5)) / x) for k in "ab" for x in range(100, 2100, 100)]
    out = {r["run"]: r for r in runs.run_report(spark.createDataFrame(rows, "k string, completed bigint, failed bigint, fail_pct double"), "k", 5000).collect()}
    assert set(out) == {"a", "b", "combined"} and out["combined"]["statistics"]["total_failed"] == 400
    assert {m["model"] for m in out["a"]["models"]} == {"linear", "polynomial_2", "polynomial_3", "exponential", "power_law", "ensemble"}
    one = runs.run_report(spark.createDataFrame(rows[:20], "k string, completed bigint, failed bigint, fail_pct double"), "k", 5000).collect()
    assert [r["run"] for r in one] == ["a"]


def test_ema_in_blocks_equals_a_plain_fold(spark):
    import random as rnd

    rng = rnd.Random(8)
    rows = [(k, i, rng.choice([0.0, 0.0, 1.5, 7.0]) if i > 40 else 0.0) for k in ("a", "b", None) for i in range(300 if k else 30)]
    got = {r["k"]: r["ema"] for r in runs.ema(spark.createDataFrame(rows, "k string, o bigint, v double").withColumn(runs.BLOCK, F.floor(F.col("o") / 17)), "k", "v", "o").collect()}
    for k in ("a", "b", None):
        acc = 0.0
        for q, _, v in rows:
            if q == k:
                acc = v if acc == 0 else 0.3 * v + 0.7 * acc
        assert got[k] == pytest.approx(acc)


def test_counts_by_best_status_per_url(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice(["u", "v", "w", None]), rng.choice([200, 404, 403, 302, 500, 503, -1, -2, -3, None])) for i in range(300)]
    df = spark.createDataFrame(rows, "o bigint, k string, u string, status_code bigint").withColumn(runs.BLOCK, F.floor(F.col("o") / 23))
    got = {r["o"]: (r["attempted"], r["ok"], r["failish"]) for r in runs.unique_counts(df, "k", "u", "o").collect()}
    rank = lambda s: 0 if s == 200 else 1 if s == 404 else 2 if s >= 500 else 3 if s < 0 else 4
    best = {}
    for o, k, u, s in rows:
        if u is not None and s not in (None, -3) and ((k, u) not in best or rank(s) < rank(best[k, u])):
            best[k, u] = s
        own = [v for (kk, _), v in best.items() if kk == k]
        assert got[o] == (len(own), sum(v == 200 for v in own), sum(v < 0 or (v >= 400 and v != 404) for v in own)), o


def test_rows_behind_a_stop_are_marked(spark):
    df = spark.createDataFrame([(k, i, s) for k in ("a", None) for i, s in enumerate([-1, -1, 200, -1, -1, 200, 404] if k else [200] * 4)], "k string, o bigint, status_code bigint")
    out = runs.skip_after_stop(runs.timeout_streaks(df, "k", "o"), "k", "o", 2)
    assert [r["status_code"] for r in out.where("k = 'a'").orderBy("o").collect()] == [-1, -1, -1, -1, -1, -1, -1] and out.where("k IS NULL AND status_code = 200").count() == 4
    c = runs.cancelled(spark.createDataFrame([(i, 500 if i % 2 else 200) for i in range(10)], "o bigint, status_code bigint"), "o", 0.45, 4)
    assert [r["status_code"] for r in c.orderBy("o").collect()] == [200, 500, 200, 500, -3, -3, -3, -3, -3, -3]
