"""Live forms: merging checkpoints, windowed failure rates, streaks with state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from harvestry.sources.sinks import merge_into

KEY = ["collection_slug", "page_number", "edm_url"]


def checkpoint_merge(stream: DataFrame, path: str, checkpoint: str, every: str = "10 seconds", once: bool = False, arrival: str | None = None) -> StreamingQuery:
    """Merge each micro-batch into the master table; ``once`` drains what is there and stops. A checkpoint is due after ``every``,
    or after as many rows as a micro-batch of the source may hold (``maxFilesPerTrigger`` and the like)."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: merge_into(df, path, KEY, arrival))
    return (w.trigger(availableNow=True) if once else w.trigger(processingTime=every)).start()


def drain(stream: DataFrame, path: str, mode: str) -> DataFrame:
    """Everything that a stream gives now, written as a table below ``path`` by its executors; each micro-batch adds its rows
    once, also when it is repeated after a failure."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")

    w = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/log").foreachBatch(write)
    w.trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/rows").select(*stream.columns)


def failure_windows(stream: DataFrame, ts: str, status: str, size: str = "10 minutes", slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Rows and failures per event-time window; rows later than the watermark are left out."""
    timed = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return timed.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col(status).eqNullSafe(F.lit(200))).alias("failed")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "failed")


def live_streaks(stream: DataFrame, key: str, order: str, threshold: int = 3, code: int = -1) -> DataFrame:
    """Per key: the streak of ``code`` after each micro-batch and whether it ever reached the threshold.

    Within a micro-batch the rows of a key count in the order of ``order`` (unique), however many Arrow batches they
    come in; micro-batches count as they arrive. Of a key's rows in one micro-batch nine bytes each are held.
    """

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak, tripped = state.get if state.exists else (0, False)
        pieces = [(pdf[order].to_numpy(), (pdf["status_code"] == code).to_numpy(bool)) for pdf in batches]
        at, hit = (np.concatenate(p) for p in zip(*pieces, strict=True))
        hit, number = hit[np.argsort(at, kind="stable")], np.arange(len(hit))
        reset = np.maximum.accumulate(np.where(hit, -1, number))
        streaks = number - reset + np.where(reset < 0, streak, 0)
        streak, tripped = int(streaks[-1]), bool(tripped or streaks.max() >= threshold)
        state.update((streak, tripped))
        yield pd.DataFrame({key: [k[0]], "streak": [streak], "tripped": [tripped]})

    kind = dict(stream.dtypes)[key]
    return stream.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, streak bigint, tripped boolean", "streak bigint, tripped boolean", "update", GroupStateTimeout.NoTimeout)
