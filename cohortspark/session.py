"""Session helpers: a local session for tests, and reliable checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str | int = "*", app: str = "cohortspark") -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder of its own.
    """
    name = "spark.checkpoint.dir"
    folder = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {name} to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set(name, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused folder name below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, folder: str) -> bool:
    """Whether a folder is there, in whatever store its name says."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in store.listStatus(path)] if store.exists(path) else []


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def checkpoint(df: DataFrame, folder: str | None = None, rows_a_file: int = 0) -> DataFrame:
    """Cut the lineage by writing a table to the shared folder and reading it back.

    The rows are computed once, survive the loss of executors, and come back with file
    sizes that later joins can plan with. Tasks read files by their bytes, so many more rows of a table
    that compresses well; with ``rows_a_file`` a file has no more, and as Spark counts 4 MB for opening
    one, a task reads 32 of them at most.
    """
    folder = folder or new_folder(df.sparkSession, "table")
    df.write.option("maxRecordsPerFile", rows_a_file).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
