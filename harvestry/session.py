"""Session helpers: where shared files live, how lineage is cut, and how what was stored is removed again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_FALLBACK: dict[str, str] = {}
_STORED: dict[str, list[str]] = {}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("harvestry")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def tuned(spark: SparkSession) -> SparkSession:
    """The session, told to give up whole-stage code beyond 8,000 bytes a method unless it has a setting of its own.

    HotSpot never compiles a longer method but interprets it, several times slower than the operators one by one.
    """
    if spark.conf.get("spark.sql.codegen.hugeMethodLimit", "65535") == "65535":
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors share: ``spark.checkpoint.dir``, else the context's checkpoint folder.

    Where neither is set, a temporary folder serves a session whose executors are threads of one machine; any other
    session must name a folder, as a machine's own would not be seen by the others.
    """
    context = tuned(spark).sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not at:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        app = context.applicationId
        if app not in _FALLBACK:
            _FALLBACK[app] = tempfile.mkdtemp(prefix="harvestry-")
        at = _FALLBACK[app]
    return at.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that ``release`` removes."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def stored(df: DataFrame, label: str, partition_by: list[str] | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as Parquet below the shared folder and read it again; returns the table and its path."""
    path = new_path(df.sparkSession, label)
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession) -> int:
    """Remove every table this application stored; results that read from them must have been written out before."""
    paths = _STORED.pop(spark.sparkContext.applicationId, [])
    hadoop = spark._jsc.hadoopConfiguration()
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(hadoop).delete(p, True)
    return len(paths)


def fresh(taken: list[str], *names: str) -> list[str]:
    """``names``, each lengthened until no column is called so (case aside)."""
    low, out = {t.lower() for t in taken}, []
    for n in names:
        while n.lower() in low:
            n += "_"
        out.append(n)
    return out
