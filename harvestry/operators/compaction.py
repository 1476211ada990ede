"""Consolidate millions of tiny files into few well-sized ones (cumulative-size grouping)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.functions.prefix import running_total
from harvestry.session import fresh, stored

#: Boundaries (one per group of files) that may be broadcast; beyond it rows are joined to the plan by file name, with the same result.
MAX_BOUNDARIES = 1_000_000
#: Tasks of the rewriting; more output files than that are written one after another by the same tasks.
MAX_TASKS = 20_000


def plan_groups(manifest: DataFrame, target_bytes: int = 128 << 20, shard: str = "shard", size: str = "n_bytes", rows: str = "n_rows") -> DataFrame:
    """One row per file: ``shard, n_rows, n_bytes, start_byte, group_id``. Planning is SQL only.

    The manifest is frozen in file-name order (names begin with the collection, so a collection stays together),
    bytes are window-summed, and a file belongs to the ``target_bytes`` interval that its first byte falls in.
    A file listed more than once counts once with its largest numbers; null sizes count as 0; a null name is no file.
    An empty manifest gives an empty plan.
    """
    files = (
        manifest.where(F.col(shard).isNotNull())
        .groupBy(F.col(shard).alias("shard"))
        .agg(F.max(rows).cast("long").alias("n_rows"), F.coalesce(F.greatest(F.max(size).cast("long"), F.lit(0)), F.lit(0)).alias("n_bytes"))
    )
    summed = running_total(files, ["shard"], "n_bytes", "start_byte")
    return summed.select("shard", "n_rows", "n_bytes", "start_byte", F.floor(F.col("start_byte") / F.lit(target_bytes)).cast("long").alias("group_id"))


def _files(source: DataFrame, plan: DataFrame) -> DataFrame:
    """``name, group_id, stated, n_bytes, listed, source_rows, source_rows_check`` of every file, listed or met in the data.

    A file that the plan lacks belongs to the last group whose first name isn't behind its own (else the first group);
    rows without a file name belong to group -1, and so do all rows where nothing is planned. Names and boundaries are
    sorted together and the boundaries before each name counted by a prefix sum, so no task holds them all.
    """
    lows = plan.groupBy("group_id").agg(F.min("shard").alias("name"))
    strangers = source.where(F.col("s").isNotNull()).join(plan.select(F.col("shard").alias("s")), "s", "left_anti")
    line = lows.select("name", F.lit(1).cast("long").alias("is_low"), "group_id").unionByName(strangers.select(F.col("s").alias("name"), F.lit(0).cast("long").alias("is_low"), F.lit(None).cast("long").alias("group_id")))
    placed = running_total(line, ["name"], "is_low", "lows_before")
    rank = placed.where("is_low = 1").select(F.col("lows_before").alias("r"), F.col("group_id").alias("g"))
    found = placed.where("is_low = 0").select("name", F.greatest(F.col("lows_before") - 1, F.lit(0)).alias("r")).join(rank, "r", "left").select("name", F.coalesce("g", F.lit(-1).cast("long")).alias("away"))
    known = plan.select(F.col("shard").alias("p_name"), F.col("group_id").alias("planned"), F.col("n_rows").alias("stated"), "n_bytes", F.lit(True).alias("listed"))
    both = source.join(known, F.col("s") == F.col("p_name"), "full_outer").withColumn("name", F.coalesce("s", "p_name")).drop("s", "p_name")
    both = both.join(found.withColumnRenamed("name", "f_name"), F.col("name") == F.col("f_name"), "left").drop("f_name")
    return both.withColumn("group_id", F.coalesce("planned", "away", F.lit(-1).cast("long"))).drop("planned", "away")


def _with_file(data: DataFrame, files: DataFrame, target_bytes: int, shard: str, own: list[str], group: str, piece: str, file: str) -> tuple[DataFrame, int]:
    """(``data`` with ``group``, ``piece`` and the number of the output ``file``, how many output files there are)."""
    sums = files.agg(F.sum("n_bytes"), F.sum(F.when(F.col("listed"), F.col("stated")))).first()
    per_row = max(1, (sums[0] or 0) // max(1, sums[1] or 0))
    size = F.when(F.col("listed"), F.col("n_bytes")).otherwise(F.coalesce("source_rows", F.lit(0)) * per_row)
    groups = files.groupBy("group_id").agg(F.min("name").alias("lo"), F.min(F.when(F.col("listed"), F.col("name"))).alias("low"), F.sum(size).alias("bytes"))
    groups = groups.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("bytes") / F.lit(2 * target_bytes))).cast("long"))
    groups, _ = stored(running_total(groups, ["group_id"], "parts", "first"), "groups")
    n_groups, n_files = groups.agg(F.count(F.lit(1)), F.sum("parts")).first()
    if n_groups > MAX_BOUNDARIES:
        name, g = fresh(data.columns, "_shard", "_g")
        sized = files.select(F.col("name").alias(name), F.col("group_id").alias(group)).join(groups.select(F.col("group_id").alias(g), F.col("parts").alias(piece), F.col("first").alias(file)), F.col(group) == F.col(g)).drop(g)
        placed = data.join(sized, F.col(shard).eqNullSafe(F.col(name)), "left").drop(name)
    else:
        rows = groups.orderBy("low").select("group_id", "low", "parts", "first").toPandas()  # a row per group of files, counted above
        named = rows[rows["low"].notna()]
        lows = named["low"].to_numpy(object)
        at = named[["group_id", "parts", "first"]].to_numpy("int64")
        rest = rows[rows["group_id"] == -1][["group_id", "parts", "first"]].to_numpy("int64")
        none = rest[0] if len(rest) else np.array([-1, 1, 0])
        sent = data.sparkSession.sparkContext.broadcast((lows, at, none))

        @F.pandas_udf("struct<g:bigint,p:bigint,f:bigint>")
        def locate(names: pd.Series) -> pd.DataFrame:
            lows, at, none = sent.value
            out = np.tile(none, (len(names), 1))
            codes, uniques = pd.factorize(names)
            if len(lows) and len(uniques):
                place = np.maximum(np.searchsorted(lows, np.asarray(uniques, object), side="right") - 1, 0)
                out[codes >= 0] = at[place[codes[codes >= 0]]]
            return pd.DataFrame(out, columns=["g", "p", "f"])

        (found,) = fresh(data.columns, "_found")
        placed = data.withColumn(found, locate(F.col(shard))).withColumns({group: F.col(f"{found}.g"), piece: F.col(f"{found}.p"), file: F.col(f"{found}.f")}).drop(found)
    part = F.when(F.col(piece) > 1, F.pmod(F.xxhash64(*own), F.col(piece))).otherwise(F.lit(0).cast("long"))
    return placed.withColumn(piece, part).withColumn(file, F.col(file) + F.col(piece)), int(n_files or 0)


def compact(data: DataFrame, manifest: DataFrame, target_bytes: int = 128 << 20, shard: str = "shard", row_key: str = "row_id") -> tuple[DataFrame, str]:
    """Rewrite ``data`` into well-sized files below the shared folder and reconcile; returns (report, path).

    Every output file has a number, all its rows go to the task of that number, and they move once; a group larger than
    two targets (a huge file, many unlisted rows, rows without a file name) is split into files by a hash of its rows. The
    report has one row per group: files and bytes planned, rows by the manifest, in the source and written, and the
    files whose three counts (or row-key checksums) differ. Rows with a null file name are written into group -1, rows of
    files that no manifest lists into the group their name sorts into (group -1 if nothing is planned), and are counted
    in ``files_unlisted``. Nothing is dropped; repeated rows stay; empty tables give an empty report.
    """
    plan = plan_groups(manifest, target_bytes, shard)
    own = data.columns
    count = lambda name: [F.count(F.lit(1)).alias(name), F.bit_xor(F.xxhash64(F.col(row_key))).alias(f"{name}_check")]
    source, _ = stored(data.groupBy(F.col(shard).alias("s")).agg(*count("source_rows")), "source")
    files, _ = stored(_files(source, plan), "files")
    group, piece, file = fresh(own, "_group", "_part", "_file")
    placed, n_files = _with_file(data, files, target_bytes, shard, own, group, piece, file)
    tasks = max(1, min(n_files, MAX_TASKS))
    moved = placed.repartitionById(tasks, F.pmod(F.col(file), F.lit(tasks)).cast("int")).drop(file)
    written, path = stored(moved, "compacted", [group, piece])

    result = written.groupBy(F.col(shard).alias("w")).agg(*count("written_rows"), F.min(F.col(group)).alias("g"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    report = (
        files.join(result, F.col("name").eqNullSafe(F.col("w")), "full_outer")
        .groupBy(F.coalesce("g", "group_id").cast("long").alias("group_id"))
        .agg(
            F.count_if(F.col("listed")).alias("files_planned"),
            F.count_if(F.col("listed").isNull()).alias("files_unlisted"),
            F.sum(zero("n_bytes")).alias("bytes_planned"),
            F.sum(zero("stated")).alias("manifest_rows"),
            F.sum(zero("source_rows")).alias("source_rows"),
            F.sum(zero("written_rows")).alias("written_rows"),
            F.count_if(F.col("listed") & (F.col("stated") != zero("source_rows"))).alias("manifest_differs"),
            F.count_if(F.col("listed") & F.col("stated").isNull()).alias("manifest_unstated"),
            F.count_if((zero("source_rows") != zero("written_rows")) | (zero("source_rows_check") != zero("written_rows_check"))).alias("lost_or_doubled"),
        )
    )
    return report, path
