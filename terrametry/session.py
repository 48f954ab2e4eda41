"""Session settings and the shared scratch location for staged tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for; AQE resizes partitions, converts
# joins and splits skewed ones at run time from measured map output.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """Session with :data:`RECOMMENDED` applied; ``settings`` win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    path = tempfile.mkdtemp(prefix="terrametry-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` decides. Only a local-mode session may fall back
    to a folder of its own; elsewhere a machine-local folder would lose rows.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return _local_scratch()
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def _session_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/terrametry/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below :func:`scratch_root`, never used before."""
    return f"{_session_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    files, location = _hadoop_path(spark, path)
    return files.exists(location)


def leaf_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders below ``path`` that hold files, relative to it; marker files do not count."""
    files, location = _hadoop_path(spark, path)
    top, found = files.makeQualified(location).toString(), set()
    listed = files.listFiles(location, True)
    while listed.hasNext():
        folder, _, name = listed.next().getPath().toString().rpartition("/")
        if not name.startswith(("_", ".")):
            found.add(folder.removeprefix(top).lstrip("/"))
    return sorted(found)


def replace_folder(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``. Broken off at any point, it can be done again."""
    files, new = _hadoop_path(spark, source)
    _, old = _hadoop_path(spark, target)
    files.delete(old, True)
    files.mkdirs(old.getParent())
    if not files.rename(new, old):
        raise OSError(f"cannot move {source} to {target}")


def discard(spark: SparkSession, path: str) -> bool:
    """Delete a staged table once nothing reads it any more."""
    files, location = _hadoop_path(spark, path)
    return files.delete(location, True)


def release_scratch(spark: SparkSession) -> bool:
    """Delete everything this application staged; call it when results are out."""
    return discard(spark, _session_folder(spark))


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts the lineage, survives executor loss, and gives later joins true file
    sizes to choose their strategy from.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
