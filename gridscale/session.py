"""Session defaults and the shared working folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "gridscale", memory: str = "12g",
                  folder: str = "/tmp/gridscale-shared") -> SparkSession:
    """A session for tests and benchmarks on one machine; a cluster brings its own.

    Cells of a run leave the kernel in frame order, so a few open writers per task replace a sort of
    them (``maxConcurrentOutputFileWriters``); a cluster does well to set that too.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.maxConcurrentOutputFileWriters", "32")
        .config("spark.checkpoint.dir", folder)
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """A fresh sub-folder of ``spark.checkpoint.dir``, or of the checkpoint folder set on the context.

    One of them must be set, to a folder that every executor can reach. In local mode, where the
    driver is the only executor, the warehouse folder serves if neither is.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base and context.master.startswith("local["):
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/gridscale-shared"
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{base.rstrip('/')}/gridscale-{uuid.uuid4().hex}"


def folder_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system that Spark reaches; none if it does not exist."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []


def _file_system(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def read_text(spark: SparkSession, path: str) -> str:
    """A small file of any file system that Spark reaches."""
    path, system = _file_system(spark, path)
    stream = system.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_once(spark: SparkSession, text: str, path: str) -> bool:
    """A small file that appears whole, unless there is one of that name already: then False, and nothing changes.

    The text is written under a fresh name first. A rename that finds its target taken fails on HDFS and the file systems that keep to
    its rules; local files are hard-linked, which is exclusive there. On stores where a rename overwrites, callers must
    keep to one writer at a time.
    """
    target, system = _file_system(spark, path)
    draft, _ = _file_system(spark, f"{target.getParent()}/.draft-{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if system.getUri().getScheme() == "file":
            try:
                os.link(draft.toUri().getPath(), target.toUri().getPath())
                return True
            except FileExistsError:
                return False
        return not system.exists(target) and system.rename(draft, target)
    finally:
        system.delete(draft, False)


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For small results that are used against large ones: they are computed once, survive lost
    executors, and their file size tells Spark whether a broadcast is safe. The owner of the folder clears it.
    """
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
