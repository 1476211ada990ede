"""Sinks: swaps that are atomic, merging writes, backups, small reports."""

from __future__ import annotations

import json
import uuid
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harvestry.operators.merge import best_of, fetch_order, union_ranked
from harvestry.session import stored


def _fs(spark: SparkSession, path: str):  # noqa: ANN202
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def swap(df: DataFrame, path: str, compression: str = "snappy", backup: str | None = None) -> None:
    """Write beside the target, then rename; the old table goes to ``backup`` or is removed after the new one stands.

    A rename of a folder isn't atomic together with another, so the old table is put back if the new one can't take its place:
    a failure at any step leaves the table as it was.
    """
    spark = df.sparkSession
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    staged = f"{path.rstrip('/')}.tmp-{uuid.uuid4().hex}"
    fs, target = _fs(spark, path)
    old = path_of(backup or f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
    moved = False
    try:
        df.write.option("compression", "uncompressed" if compression == "none" else compression).parquet(staged)
        if fs.exists(target):
            if not fs.rename(target, old):
                raise OSError(f"cannot move {path}")
            moved = True
        if not _rename(fs, path_of(staged), target):
            raise OSError(f"cannot rename {staged}")
    except Exception:
        if moved and not fs.exists(target):
            fs.rename(old, target)
        fs.delete(path_of(staged), True)
        raise
    if not backup and fs.exists(old):
        fs.delete(old, True)


def _rename(fs, a, b) -> bool:  # noqa: ANN001
    return fs.rename(a, b)


def backup_copy(spark: SparkSession, path: str, folder: str) -> str | None:
    """Copy the table at ``path`` into ``folder`` under its name and the time; returns where, or None if there is no table."""
    fs, source = _fs(spark, path)
    if not fs.exists(source):
        return None
    name = f"{folder.rstrip('/')}/{source.getName()}_{datetime.now(UTC):%Y%m%d_%H%M%S_%f}"
    there, target = _fs(spark, name)
    there.mkdirs(target.getParent())
    if not spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, there, target, False, spark._jsc.hadoopConfiguration()):
        raise OSError(f"cannot copy {path}")
    return name


def merge_into(new: DataFrame, path: str, key: list[str], arrival: str | None = None, compression: str = "snappy") -> bool:
    """Best-of merge of new rows into the table at ``path``; nothing new leaves it as it is (and gives False).

    Of rows that are equal in outcome and retries the one with the greatest ``arrival`` (a column of both) wins, in whatever
    order the batches came; without such a column the later table's, and inside one table the greatest by all columns, so
    that the result is defined.
    """
    spark = new.sparkSession
    fs, target = _fs(spark, path)
    if new.isEmpty():
        return False
    frames = [spark.read.parquet(path), new] if fs.exists(target) else [new]
    rows = union_ranked(frames)
    rest = [F.to_json(F.struct(*[c for c in rows.columns if c != "_src"]))]
    merged = best_of(rows, key, [*fetch_order(*([arrival] if arrival else []), "_src"), *rest]).drop("_src")
    swap(merged, path, compression)
    return True


def append_metrics(samples: DataFrame, path: str) -> None:
    """Append metrics lines as CSV files with a header."""
    samples.write.mode("append").option("header", "true").csv(path)


def append_snapshots(pages: DataFrame, path: str) -> None:
    """Append fetched pages ``(url, body)`` to a table of snapshots; what is in it already stays as it is.

    The pages are stored first: they are fetched once, and their plan, which may read the same table as it was before, doesn't
    meet the one that reads it now.
    """
    spark = pages.sparkSession
    fs, target = _fs(spark, path)
    fresh, _ = stored(pages.select("url", "body").dropDuplicates(["url"]), "fetched")
    if fs.exists(target):
        fresh = fresh.join(spark.read.parquet(path).select("url"), "url", "left_anti")
    fresh.write.mode("append").parquet(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file wherever the path leads."""
    fs, target = _fs(spark, path)
    out = fs.create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def to_json(df: DataFrame, path: str, limit: int = 10_000) -> None:
    """A small report as one JSON document; more than ``limit`` rows are refused, not cut."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a report has at most {limit} rows")
    write_text(df.sparkSession, path, json.dumps([r.asDict(recursive=True) for r in rows], ensure_ascii=False, indent=2, default=str))


def to_lines(df: DataFrame, path: str, order: list[str], text: str) -> None:
    """One text file of a small, ordered table."""
    df.orderBy(*order).select(text).coalesce(1).write.mode("overwrite").text(path)


def to_tsv(coverage: DataFrame, path: str) -> None:
    """Ranked tokens as ``count TAB fraction TAB token`` lines: most covering first, then by token."""
    ranked = coverage.select("n", "token", F.concat_ws("\t", F.col("n").cast("string"), F.format_string("%.4f", F.col("fraction")), "token").alias("line"))
    ranked.orderBy(F.desc("n"), "token").select("line").coalesce(1).write.mode("overwrite").text(path)
