"""Tables from files: schemas by contract, tolerant of what is missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

METRICS = "t_epoch bigint, completed bigint, failed bigint, fail_pct double, speed_ps double, eta_s bigint, remaining bigint"


def ensure_columns(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """``df`` with every column of ``defaults``; missing ones take the default."""
    missing = {c: v for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def shard_scan(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """All shard files below a path, with the file each row came from; unreadable files are skipped, schemas merged."""
    reader = spark.read.option("mergeSchema", "true").option("ignoreCorruptFiles", "true").option("pathGlobFilter", pattern)
    return reader.parquet(path).select("*", F.col("_metadata.file_name").alias("_file"))


def metrics_csv(spark: SparkSession, paths: list[str] | str, schema: str = METRICS) -> DataFrame:
    """Metrics files with a header and a fixed schema; malformed lines are dropped."""
    return spark.read.schema(schema).option("header", "true").csv(paths).where("t_epoch IS NOT NULL AND completed IS NOT NULL")


def last_sample(metrics: DataFrame, run: str | None = None) -> DataFrame:
    """The last metrics line (greatest completed, then latest), per run if named."""
    rest = F.struct(*[c for c in metrics.columns if c != run])
    g = metrics.groupBy(run) if run else metrics
    return g.agg(F.max_by(rest, F.struct("completed", "t_epoch")).alias("b")).select(*([run] if run else []), "b.*")


def tail_metrics(spark: SparkSession, paths: list[str], size: int = 8192) -> DataFrame:
    """``path, completed, eta_s, speed_ps, remaining`` of the last whole line in the last ``size`` bytes of each metrics file.

    Headers and lines of fewer than seven fields are passed over; a missing, empty or unreadable file gives zeros. Only the
    tails are read, one file per run.
    """
    rows = []
    for path in paths:
        got = (0, 0.0, 0.0, 0)
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
            length = fs.getFileStatus(p).getLen()
            stream = fs.open(p)
            try:
                stream.seek(max(0, length - size))
                text = bytes(stream.readNBytes(size)).decode("utf-8", "ignore")
            finally:
                stream.close()
            for line in reversed(text.splitlines()):
                f = [x.strip() for x in line.split(",")]
                if len(f) >= 7 and f[0] != "t_epoch":
                    got = (int(float(f[1])), float(f[5] or 0), float(f[4] or 0), int(float(f[6] or 0)))
                    break
        except Exception:  # noqa: S110
            pass
        rows.append((path, *got))
    return spark.createDataFrame(rows, "path string, completed bigint, eta_s double, speed_ps double, remaining bigint")


def frequencies(spark: SparkSession, path: str) -> DataFrame:
    """``value, n`` of a JSON document ``{"values_sorted": [[value, count], ...]}``."""
    doc = spark.read.schema("values_sorted array<array<string>>").option("multiLine", "true").json(path)
    return doc.select(F.explode("values_sorted").alias("p")).select(F.col("p")[0].alias("value"), F.col("p")[1].cast("long").alias("n"))


def overrides_file(spark: SparkSession, path: str) -> DataFrame:
    """``overrides`` of a JSON file."""
    return overrides(spark, "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))  # a configuration file


def overrides(spark: SparkSession, text: str) -> DataFrame:
    """``slug`` and its settings from a JSON object; of a repeated name the last one wins."""
    import json

    rows = [(k, v.get("per_concurrency"), v.get("wait"), v.get("timeout"), v.get("retries"), v.get("ua_mode"), v.get("force_http1")) for k, v in json.loads(text).items()]
    rows = [(k, *(None if x is None else t(x) for x, t in zip(r, (int, float, float, int, str, bool), strict=True))) for k, *r in rows]
    return spark.createDataFrame(rows, "slug string, per_concurrency int, wait double, timeout double, retries int, ua_mode string, force_http1 boolean")
