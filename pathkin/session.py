"""Session settings and lineage cuts."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, app: str = "pathkin") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    cpus = cpus or os.cpu_count() or 1
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def stage_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    Where none is set, a local session takes one temporary folder and a cluster
    session fails.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="pathkin-"))
        folder = context.getCheckpointDir()
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` stored once as a table in the shared folder, and read back from there.

    Every reader sees the same rows, a lost executor costs no more than its own
    task, and later plans start from a scan that knows its size.
    """
    path = f"{stage_folder(df.sparkSession)}/pathkin-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
