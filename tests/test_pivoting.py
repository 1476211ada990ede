import json

import pytest
from pyspark.sql import functions as F

from harvestry.operators.pivoting import discover_attributes, explode_fields, field_counts, fields_of, object_map, wide_records

BAD = [None, "", " ", "null", "[]", '[{"a":1}]', '{"a":1', '{"a":1} x', '{"a":1}{"b":2}', '{"a":1},{"b":2}', '{"a":1}]', "{'a':1}", '{"a":NaN}', '"text"', "1", "<html>", '{"a":1}],{"b":2}', '{"a" "b"}', "{a:1}"]
GOOD = ["{}", '{"a":1}', ' {"a":"x","a":"y"}\n', '{"a":null,"b":"","c":"  ","d":[],"e":{"f":1},"g":false,"h":"0"}', '{"\\u0391":"x"}', '{"a":"\\"}"}']


def test_object_map_is_strict(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(BAD + GOOD)], "i int, t string")
    got = {r["i"]: r["n"] for r in df.select("i", F.size(object_map(F.col("t"))).alias("n")).collect()}
    for i, t in enumerate(BAD):
        assert got[i] in (-1, None), t
    for i, t in enumerate(GOOD):
        assert got[len(BAD) + i] >= 0, t


def test_counts_duplicates_types_and_clashes(spark):
    rows = [
        (1, '{"Έτος":"1999","Σελίδες":"12 σ.","meta_id":"z","Δωρεάν":"Ναι","Βάρος":"2,5"}', 5),
        (2, '{"Έτος":"05/03/1980","Έτος":"2001-02-03","Σελίδες":"σ. 40","έτος":"k","Δωρεάν":"Όχι"}', 9),
        (2, '{"Έτος":"12 Απριλίου 1985","Σελίδες":"xii, 331 σ.","Βάρος":"3.5","Δωρεάν":"NAI"}', 4),
        (3, "{", 0), (4, None, None), (None, '{"Σελίδες":"χ.αρ."}', 1),
    ]
    out = wide_records(spark.createDataFrame(rows, "meta_id bigint, j string, n bigint"), "meta_id", "j", "n").collect()
    assert len(out) == 6
    cols = out[0].asDict()
    assert {"meta_id", "meta_id_2", "n_fields", "count_matches"} <= set(cols) and sum(c.lower().startswith("έτος") for c in cols) == 2
    by = {(r["meta_id"], r["n_stated"]): r for r in out}
    assert by[1, 5]["count_matches"] and by[1, 5]["n_fields"] == 5
    assert by[2, 9]["n_fields"] == 4 and not by[2, 9]["count_matches"]
    assert str(by[2, 9]["Έτος"]) == "2001-02-03" and by[2, 9]["Σελίδες"] == 40
    assert str(by[2, 4]["Έτος"]) == "1985-04-12" and by[2, 4]["Σελίδες"] == 331 and by[2, 4]["Δωρεάν"] is True
    assert by[3, 0]["n_fields"] == 0 and by[3, 0]["count_matches"]
    assert by[4, None]["n_fields"] == 0 and not by[4, None]["count_matches"]
    assert by[None, 1]["n_fields"] == 1 and by[None, 1]["Σελίδες"] is None
    assert by[1, 5]["Βάρος"] == pytest.approx(2.5)


def test_rare_attributes_go_to_a_typed_map(spark):
    rows = [(i, json.dumps({"a": "x", f"r{i}": f"{i}.5", "z": "no number" if i == 3 else str(1990 + i)}), 3) for i in range(9)]
    df = spark.createDataFrame(rows, "id bigint, j string, n bigint")
    whole = {r["id"]: r for r in wide_records(df, "id", "j", "n").collect()}
    out = wide_records(df, "id", "j", "n", max_columns=1).collect()
    for r in out:
        other, full = r["other_fields"], whole[r["id"]]
        assert r["count_matches"] and r["a"] == "x" and r["unread_fields"] == full["unread_fields"] == ({"z": ["no number"]} if r["id"] == 3 else {})
        assert set(other) == ({f"r{r['id']}"} if r["id"] == 3 else {f"r{r['id']}", "z"})
        assert other[f"r{r['id']}"]["real"] == full[f"r{r['id']}"] == r["id"] + 0.5 and (r["id"] == 3 or other["z"]["day"] == full["z"])
    a, b = (sorted(map(tuple, field_counts(df, "id", "j", "n", m).collect())) for m in (1, 500))
    assert a == b == [(i, 3, 3, True) for i in range(9)]


def test_many_entries_that_do_not_read(spark):
    entries = ",".join(f'"Έτος":"{"x" if k % 3 else 1900 + k % 90}"' for k in range(150))
    rows = [(i, json.dumps({"Έτος": str(1950 + i % 50)}), 1) for i in range(800)] + [(900, "{" + entries + "}", 1)]
    r = wide_records(spark.createDataFrame(rows, "id bigint, j string, n bigint"), "id", "j", "n").where("id = 900").first()
    assert r["unread_fields"] == {"Έτος": ["x"] * 100} and str(r["Έτος"]) == "1957-01-01" and r["n_fields"] == 1


def test_long_text_and_empty_table(spark):
    df = spark.createDataFrame([(1, json.dumps({"a": "y" * 200_000}), 1)], "id bigint, j string, n bigint")
    assert len(wide_records(df, "id", "j", "n").first()["a"]) == 200_000
    assert wide_records(df.limit(0), "id", "j", "n").count() == 0
    assert discover_attributes(explode_fields(fields_of(df.limit(0), "j"))).count() == 0


def test_values_that_do_not_read_are_kept(spark):
    rows = [(i, json.dumps({"Έτος": str(1950 + i), "Βάρος": "2,5"}), 2) for i in range(20)]
    rows += [
        (20, '{"Έτος":"[2016]"}', 1), (21, '{"Έτος":"1999","Έτος":" c1968"}', 2), (22, '{"Έτος":"1951?","Έτος":"n.d.","Βάρος":"n/a"}', 3),
        (23, json.dumps({"Έτος": "2001-02-03T" + "0" * 60}), 1), (24, '{"Έτος":"1990","Έτος":"x","Έτος":"1991"}', 3),
    ]
    df = spark.createDataFrame(rows, "id bigint, j string, n bigint")
    by = {r["id"]: r for r in wide_records(df, "id", "j", "n").collect()}
    assert by[0]["unread_fields"] == {} and str(by[0]["Έτος"]) == "1950-01-01"
    assert by[20]["Έτος"] is None and by[20]["unread_fields"] == {"Έτος": ["[2016]"]}
    assert str(by[21]["Έτος"]) == "1999-01-01" and by[21]["unread_fields"] == {"Έτος": [" c1968"]}
    assert by[22]["unread_fields"] == {"Έτος": ["1951?", "n.d."], "Βάρος": ["n/a"]} and by[22]["n_fields"] == 2
    assert str(by[23]["Έτος"]) == "2001-02-03" and by[23]["unread_fields"] == {}
    assert str(by[24]["Έτος"]) == "1991-01-01" and by[24]["unread_fields"] == {"Έτος": ["x"]}
    told = {r["name"]: r["n_unread"] for r in discover_attributes(explode_fields(fields_of(df, "j"))).collect()}
    assert told == {"Έτος": 5, "Βάρος": 1}
