"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


#: Compressed bytes for one task, of shuffled rows and of files: numbers compress so well that an
#: aggregate over them takes some twenty times as much memory.
TASK_BYTES = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20, "spark.sql.files.maxPartitionBytes": 16 << 20}
_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def small_tasks(spark: SparkSession) -> SparkSession:
    """``spark``, told to cut shuffled rows and files into tasks of at most ``TASK_BYTES``.

    By default adaptive execution joins the partitions of a shuffle until tasks hold 64 MB, and a
    scan takes 128 MB of a file, so that the memory of a task grows with the input up to these. A
    smaller setting stays. Spark has these settings by session only.
    """
    for key, most in TASK_BYTES.items():
        held = re.fullmatch(r"\s*([0-9]+)\s*([bkmgtp]?)(?:ib|b)?\s*", spark.conf.get(key, "1p").lower())
        if held is None or int(held[1]) * _UNITS[held[2]] > most:
            spark.conf.set(key, str(most))
    return spark


def local_session(cpus: int | str = "*", app: str = "obsvar", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where that setting is missing a temporary folder is used, in local mode only: on a cluster a
    machine-local folder would be lost with its executor, so this raises instead.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or None
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if folder is None and current is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    if current is None:
        context.setCheckpointDir(folder)
    return folder or current


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path inside the shared folder for a written table."""
    return f"{shared_folder(spark).rstrip('/')}/obsvar-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` as a table in the shared folder, read again, and its path for ``discard``."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Removes scratch tables that nothing reads any more; other paths are refused."""
    for path in paths:
        if not path.rsplit("/", 1)[-1].startswith("obsvar-"):
            raise ValueError(f"not a scratch table: {path}")
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
