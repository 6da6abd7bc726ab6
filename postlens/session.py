"""Session settings and the shared scratch folder.

The library never creates a session on import. ``build_session`` is for
scripts, tests and the benchmark; on a cluster the caller passes its own
session, and ``apply_job_conf`` only sets what the job depends on.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results or the plan shape depend on.
JOB_CONF = {
    # year(), month() and dayofmonth() depend on the session time zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffles, split skewed join
    # partitions, and turn a sort-merge join into a broadcast join only when
    # the measured size of the built side is under the threshold below.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
}


def apply_job_conf(spark: SparkSession) -> SparkSession:
    """Settings of the job that the caller has not made. The time zone is
    always set, as results depend on it."""
    given = spark.conf.getAll
    for key, value in JOB_CONF.items():
        if key == "spark.sql.session.timeZone" or key not in given:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "postlens",
) -> SparkSession:
    """Local session for tests and the benchmark."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (the folder a cluster names for this
    purpose). Only when it is unset in a local-mode session, as in tests, a
    folder of our own is made and registered; on a cluster a machine-local
    folder would not be visible to the executors, so that is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not root:
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder for "
                "staged tables (e.g. on HDFS or an object store)"
            )
        root = tempfile.mkdtemp(prefix="postlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def new_scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared scratch root."""
    return f"{scratch_root(spark)}/postlens/{label}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any file system Spark can reach, if it exists."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Renames a folder within one file system; parents are made."""
    fs, old = _file_system(spark, source)
    _, new = _file_system(spark, target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, whole or not at all: written beside and renamed."""
    fs, target = _file_system(spark, f"{path}.part")
    stream = fs.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    move_path(spark, f"{path}.part", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match ``pattern``; bounded by the number of month folders."""
    fs, target = _file_system(spark, pattern)
    return [str(s.getPath()) for s in fs.globStatus(target) or []]


def read_head(spark: SparkSession, path: str, n: int = 65536) -> bytes:
    """The first ``n`` bytes of a file."""
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readNBytes(n))
    finally:
        stream.close()


def input_files(spark: SparkSession, df: DataFrame) -> list[str]:
    """Paths of the files a DataFrame reads; Spark names them as encoded URIs."""
    jvm = spark.sparkContext._jvm
    path, uri = jvm.org.apache.hadoop.fs.Path, jvm.java.net.URI
    return sorted(path(uri(f)).toString() for f in df.inputFiles())
