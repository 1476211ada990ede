import random

from pyspark.sql import functions as F

from harvestry.functions.prefix import blocked, previous, running


def test_running_sums_and_maxima_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(i * 3 - 50, rng.choice(["hot", "hot", "hot", "a", None]), rng.choice([None, 0, 1, 5]), "clash", 7) for i in range(800)]
    df = spark.createDataFrame(rows, "o bigint, k string, v bigint, _v_s string, _b int")
    frozen, block = blocked(df, "o", 37)
    out = running(frozen, "k", "o", block, {"s": F.col("v")}, {"m": F.when(F.col("v") == 5, F.col("o"))}).collect()
    assert len(out) == len(rows)
    state = {}
    got = {r["o"]: (r["s"], r["m"]) for r in out}
    for o, k, v, *_ in rows:
        s, m = state.get(k, (0, None))
        state[k] = s, m = s + (v or 0), o if v == 5 else m
        assert got[o] == (s, m)


def test_before_and_previous_equal_brute_force(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice(["hot", "hot", "a", None]), rng.choice([None, 1, 2])) for i in range(500)]
    frozen, block = blocked(spark.createDataFrame(rows, "o bigint, k string, v bigint"), "o", 29)
    got = {r["o"]: (r["s"], r["m"]) for r in running(frozen, "k", "o", block, {"s": F.col("v")}, {"m": F.struct(F.col("o").alias("o"))}, before=True).collect()}
    last = {r["o"]: (r["lo"], r["lv"]) for r in previous(frozen, "k", "o", block, {"lo": F.col("o"), "lv": F.col("v")}).collect()}
    total, met = {}, {}
    for o, k, v in rows:
        assert got[o][0] == total.get(k, 0) and (got[o][1]["o"] if got[o][1] else None) == met.get(k, (None, None))[0]
        assert last[o] == met.get(k, (None, None))
        total[k], met[k] = total.get(k, 0) + (v or 0), (o, v)


def test_one_far_value_does_not_widen_the_blocks(spark):
    df = spark.range(20_000).select(F.when(F.col("id") == 0, 10**15).otherwise(F.col("id")).alias("o"), F.when(F.col("id") % 10 > 0, "hot").otherwise("k").alias("k"))
    frozen, block = blocked(df, "o", 500)
    sizes = [r["count"] for r in frozen.groupBy(block).count().collect()]
    assert len(sizes) == 40 and max(sizes) < 1500 and sum(sizes) == 20_000
    out = running(frozen, "k", "o", block, {"n": F.lit(1)})
    assert out.groupBy("k").agg(F.max("n").alias("n"), F.count_distinct("n").alias("d")).orderBy("k").collect() == [("hot", 18_000, 18_000), ("k", 2_000, 2_000)]


def test_running_on_nothing(spark):
    df = spark.createDataFrame([], "o bigint, k string")
    frozen, block = blocked(df, "o")
    assert running(frozen, "k", "o", block, {"s": F.lit(1)}).count() == 0
