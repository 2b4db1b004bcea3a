"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Windows are aligned to the epoch in UTC and text timestamps carry no zone.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

def build_session(app_name: str = "tidegrid", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {"spark.ui.enabled": "false", **SESSION_CONF, **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings that results depend on to a session made elsewhere."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """Folder that every executor sees: ``spark.checkpoint.dir``, or one below the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_tidegrid"


def new_workspace(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return os.path.join(shared_root(spark), f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Store a frame in the shared folder and read it back.

    For small aggregates that a plan reads more than once. It cuts the lineage in a way that
    survives the loss of executors, and the stored size is what Spark checks against
    ``spark.sql.autoBroadcastJoinThreshold`` before it broadcasts the table.
    """
    path = new_workspace(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to ``path`` has finished."""
    fs, marker = _file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _file_system(spark, path)
    return fs.exists(folder)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files that a path, or a pattern, stands for."""
    fs, pattern = _file_system(spark, path)
    return sum(fs.getContentSummary(found.getPath()).getLength()
               for found in fs.globStatus(pattern) or ())


def data_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(path, time of modification) of the data files below a folder, by path; names that begin with an
    underscore or a dot are no data, as Spark's readers have it."""
    fs, top = _file_system(spark, folder)
    found = []
    if fs.exists(top):
        listing = fs.listFiles(top, True)
        start = len(fs.makeQualified(top).toString())
        while listing.hasNext():
            status = listing.next()
            path = status.getPath().toString()
            if not any(name.startswith(("_", ".")) for name in path[start:].split("/")):
                found.append((path, status.getModificationTime()))
    return sorted(found)


def stamp(spark: SparkSession, path: str, millis: int) -> bool:
    """Set a file's time of modification; tells whether the store has kept it."""
    fs, file = _file_system(spark, path)
    fs.setTimes(file, millis, -1)
    return fs.getFileStatus(file).getModificationTime() == millis


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, file = _file_system(spark, source)
    _, to = _file_system(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(file, to):
        raise OSError(f"could not move {source} to {target}")


def remove(spark: SparkSession, folder: str) -> None:
    """Remove a folder of ours and all that is in it."""
    fs, path = _file_system(spark, folder)
    fs.delete(path, True)
