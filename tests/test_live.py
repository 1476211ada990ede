from pyspark.sql import functions as F

from harvestry.operators.runs import stopped_at, timeout_streaks
from harvestry.streaming.live import live_streaks


def drained(stream, at):
    told = []
    w = live_streaks(stream, "k", "row_id").writeStream.outputMode("update").option("checkpointLocation", at)
    w.foreachBatch(lambda df, _: told.extend(df.collect())).trigger(availableNow=True).start().awaitTermination()
    return {r["k"]: (r["streak"], r["tripped"]) for r in told}


def test_hot_key_of_many_arrow_batches_equals_the_batch_form(spark, tmp_path):
    i = F.col("id")
    last = F.when(i >= 39_980, -1).when(i % 3 < 2, -1).otherwise(200)
    rows = spark.range(40_000).select(F.when(i % 20 == 0, F.concat(F.lit("c"), (i % 7).cast("string"))).otherwise("hot").alias("k"), i.alias("row_id"), last.cast("long").alias("status_code"))
    rows = rows.withColumn("status_code", F.when(F.col("row_id") % 11 > 0, F.col("status_code")))
    rows.repartition(6, F.xxhash64("row_id")).sortWithinPartitions(F.xxhash64("row_id")).write.parquet(f"{tmp_path}/rows")
    got = drained(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/rows"), f"{tmp_path}/log")
    streaks = timeout_streaks(rows, "k", "row_id")
    ends = {r["k"]: r["s"] for r in streaks.groupBy("k").agg(F.max_by("streak", "row_id").alias("s")).collect()}
    stops = {r["k"] for r in stopped_at(streaks, "k", "row_id", 3).collect()}
    assert got == {k: (n, k in stops) for k, n in ends.items()} and len(got) == 8


def test_state_goes_on_over_micro_batches(spark, tmp_path):
    kind = "k string, row_id bigint, status_code bigint"
    (tmp_path / "rows").mkdir()
    stream = spark.readStream.schema(kind).parquet(f"{tmp_path}/rows")
    told = []
    for part in ([("a", 2, -1), ("a", 1, 200), ("b", 1, -1)], [("a", 4, -1), ("a", 3, -1)], [("a", 5, None), ("a", 6, -1)]):
        spark.createDataFrame(part, kind).write.mode("append").parquet(f"{tmp_path}/rows")
        told.append(drained(stream, f"{tmp_path}/log"))
    assert told[0] == {"a": (1, False), "b": (1, False)} and told[1] == {"a": (3, True)} and told[2] == {"a": (1, True)}
