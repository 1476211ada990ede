from pyspark.sql import functions as F

from harvestry.functions.prefix import number_rows, running_total
from harvestry.operators import compaction
from harvestry.operators.compaction import compact, plan_groups

ROWS = "row_id bigint, shard string, body string, _group string, group_id string, _at int"
FILES = "shard string, collection_slug string, n_rows bigint, n_bytes bigint"


def data(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def test_running_total_is_exact(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("k"), (F.col("id") % 7).alias("v"))
    out = {r["k"]: r["t"] for r in running_total(df, ["k"], "v", "t", 90).collect()}
    total = 0
    for i in range(1000):
        assert out[f"{i:05d}"] == total
        total += i % 7


def test_number_rows_with_hot_and_null_keys(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    out = number_rows(df.withColumn("b", F.floor(F.col("id") / 100)), "k", "id", "b", "n").collect()
    assert len(out) == 3000
    for key in (None, "hot"):
        assert sorted(r["n"] for r in out if r["k"] == key) == list(range(1000))


def test_plan_intervals_and_dirt(spark):
    m = spark.createDataFrame([("a", "x", 1, 60), ("b", "x", None, 60), ("b", "x", 3, 50), ("c", None, 0, None), ("d", "x", 1, 100), (None, "x", 1, 9)], FILES)
    got = {r["shard"]: (r["start_byte"], r["group_id"]) for r in plan_groups(m, 100).collect()}
    assert got == {"a": (0, 0), "b": (60, 0), "c": (120, 1), "d": (120, 1)}


def test_compact_keeps_each_row_once(spark):
    rows = [(i, None if i % 11 == 0 else f"f{i % 9}", "t" * (i % 50), "g", "q", i) for i in range(500)] + [(7, "f7", "", "g", "q", 1)] * 2
    m = spark.createDataFrame([(f"f{k}", "s", None if k == 2 else 5, 700) for k in range(8)] + [("empty", "s", 0, 10)], FILES)
    report, path = compact(data(spark, rows), m, 1500)
    out = report.collect()
    assert sum(r["source_rows"] for r in out) == sum(r["written_rows"] for r in out) == 502
    assert all(r["lost_or_doubled"] == 0 for r in out)
    assert next(r for r in out if r["group_id"] == -1)["written_rows"] == sum(i % 11 == 0 for i in range(500))
    assert sum(r["files_unlisted"] for r in out) == 2  # f8, and rows without a file
    back = spark.read.parquet(path)
    assert back.count() == 502 and set(ROWS_COLUMNS) <= set(back.columns)


ROWS_COLUMNS = [c.split()[0] for c in ROWS.split(", ")]


def test_huge_file_is_split_and_join_path_agrees(spark, monkeypatch):
    rows = [(i, "big", "x", "g", "q", 0) for i in range(200)]
    m = spark.createDataFrame([("big", "s", 200, 10_000)], FILES)
    report, path = compact(data(spark, rows), m, 1000)
    assert report.first()["written_rows"] == 200
    assert spark.read.parquet(path).select("_part").distinct().count() > 1
    monkeypatch.setattr(compaction, "MAX_BOUNDARIES", 0)
    again, _ = compact(data(spark, rows), m, 1000)
    assert again.first()["written_rows"] == 200 and again.first()["lost_or_doubled"] == 0


def test_both_ways_to_a_group_agree(spark, monkeypatch):
    rows = [(i, None if i % 7 == 0 else f"{'abcdefgh'[i % 8]}{i % 3}", "x" * 20, "g", "q", i) for i in range(400)]
    m = spark.createDataFrame([(f"{c}1", "s", 17, 900) for c in "bdfg"], FILES)
    monkeypatch.setattr(compaction, "MAX_TASKS", 2)

    def both():
        report, path = compact(data(spark, rows), m, 1000)
        placed = {(r["shard"], r["_group_"]) for r in spark.read.parquet(path).select("shard", "_group_").distinct().collect()}
        return sorted(map(tuple, report.collect())), placed, len({r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()})

    sent = both()
    monkeypatch.setattr(compaction, "MAX_BOUNDARIES", 0)
    assert both() == sent
    groups = dict(sent[1])
    assert groups[None] == -1 and groups["a0"] == groups["b1"] == 0 and groups["e2"] == groups["d1"] and groups["h0"] == groups["g1"]
    assert sum(r[6] for r in sent[0]) == 400 and all(r[9] == 0 for r in sent[0])


def test_rows_without_a_file_name_are_split(spark):
    rows = [(i, None, "x", "g", "q", 0) for i in range(900)]
    m = spark.createDataFrame([("a", "s", 10, 1000)], FILES)
    report, path = compact(data(spark, rows), m, 5000)
    assert [(r["group_id"], r["written_rows"]) for r in report.orderBy("group_id").collect()] == [(-1, 900), (0, 0)]
    assert spark.read.parquet(path).select("_part").distinct().count() == 9


def test_empty_tables(spark):
    report, _ = compact(data(spark, []), spark.createDataFrame([], FILES), 100)
    assert report.count() == 0
    report, _ = compact(data(spark, [(1, "a", "b", "c", "d", 2)]), spark.createDataFrame([], FILES), 100)
    assert [(r["group_id"], r["written_rows"], r["lost_or_doubled"]) for r in report.collect()] == [(-1, 1, 0)]
