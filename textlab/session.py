"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Single-machine session for tests and the benchmark; a cluster brings its own settings."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("textlab")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "4096")  # groups are single texts
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        .config("spark.kryoserializer.buffer.max", "512m")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the executors once per application, so that tasks can import it anywhere."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="textlab-code-")  # on the driver only; Spark serves the file
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/textlab", "zip", os.path.dirname(package), os.path.basename(package)))
    _shipped.add(application)


def shared_dir(spark: SparkSession) -> str:
    """Folder named by `spark.checkpoint.dir`. Only a local session may fall back to a scratch folder."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.TemporaryDirectory(prefix="textlab-")
    return _local_dirs[context.applicationId].name


def _session_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/textlab-{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, name: str) -> str:
    """Unused path below the shared folder; two jobs never write to the same one."""
    return f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def clear_staged(spark: SparkSession) -> None:
    """Delete what this session staged. Call it when no result of the session is read any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write once, read many times: cuts the lineage and survives the loss of any executor.

    What the write shuffled is not read again, so its files go when it ends and not when the driver next collects garbage.
    """
    path, conf = new_folder(df.sparkSession, name), df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, "false")
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(SHUFFLE_CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(staged: DataFrame) -> None:
    """Delete what `stage` wrote, or another table below the session's folder; nothing may read it any more."""
    spark = staged.sparkSession
    for name in {file.rsplit("/", 1)[0] for file in staged.inputFiles()}:
        if f"/textlab-{spark.sparkContext.applicationId}/" not in name:
            raise ValueError(f"{name} is not a folder of this session")
        folder = spark._jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
