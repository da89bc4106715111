"""Session helpers (S10) and the shared scratch location for written tables."""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Settings every job of the toolkit relies on. AQE stays on so that joins
# against dimensions whose size is only known at run time can still switch to
# a broadcast, and so that skewed join partitions get split.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(app_name: str = "retailstar", master: str | None = None,
                conf: dict | None = None) -> SparkSession:
    """Return the active session or build one; settings are only applied when
    the session is created here (a session handed in by a cluster wins)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def is_local(master: str) -> bool:
    """One JVM on this machine (``local``, ``local[n]``); ``local-cluster`` has
    executors of their own."""
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster's setting). Where it is
    unset, a session on a single machine gets a fresh temporary folder; any
    other master raises, since executors would each write to their own disk.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not is_local(master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors share (master {master})")
        d = tempfile.mkdtemp(prefix="retailstar-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the checkpoint dir for a written table."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


_TEMPORARY: list[str] = []
#: of the tables that the toolkit writes for itself
COMPRESSION = "zstd"


def temporary_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a table that only the present step needs and read it back; it goes
    with the next ``release_temporary``."""
    path = scratch_path(df.sparkSession, name)
    _TEMPORARY.append(path)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """Write a table that stays and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a written table of this job."""
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def release_temporary(spark: SparkSession) -> None:
    """Delete the temporary tables once what was built from them is written."""
    while _TEMPORARY:
        delete_path(spark, _TEMPORARY.pop())


def at_once(spark: SparkSession, steps: list[Callable[[], T]]) -> list[T]:
    """What steps that do not need each other return, run side by side: the jobs of a
    small table fill the cores that another one leaves idle. The first error is raised
    when all have ended."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]
    return [r.result() for r in running]


def written_bytes(spark: SparkSession, path: str) -> int:
    """Size of a written table (metadata only, no job)."""
    p, fs = _file_system(spark, path)
    return int(fs.getContentSummary(p).getLength())


def table_state(spark: SparkSession, path: str) -> tuple[int, int]:
    """(bytes, newest modification time) of a table's files (metadata only)."""
    p, fs = _file_system(spark, path)
    files = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/*")) or []
    times = [f.getModificationTime() for f in files] + [fs.getFileStatus(p).getModificationTime()]
    return int(fs.getContentSummary(p).getLength()), max(times)


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    p, fs = _file_system(spark, folder)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file of the job, such as a manifest."""
    return spark.read.text(path, wholetext=True).first()[0]


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Put a small text file in place: written beside, then renamed, so that nobody
    reads a part of it; fails if the path exists."""
    p, fs = _file_system(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    beside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
    out = fs.create(beside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(beside, p):
        raise FileExistsError(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


#: input bytes (compressed) to a shuffle partition of a load, shuffled bytes to a task,
#: and the folders of a partitioned table that a task writes side by side
LOAD_BYTES, TASK_BYTES, OPEN_FOLDERS, MOST_PARTITIONS = 8 << 20, 16 << 20, 8, 20_000
#: written bytes that a task of a load reads: the load's own tables take 4 to 10 bytes a
#: row, the rows it shuffles some 100 each until they are sorted
SPLIT_BYTES = 16 << 20


@contextmanager
def sized_for(spark: SparkSession, size: int):
    """Settings of a load of ``size`` input bytes, so that no task sorts more than fits
    its share of memory; the session's own are back afterwards.

    Shuffle partitions follow the input and are put together up to TASK_BYTES only
    (compressed; rows in memory are several times that), files are read in pieces of
    SPLIT_BYTES. Rows for few folders are written as they come, not sorted by folder
    first."""
    partitions = min(MOST_PARTITIONS, math.ceil(size / LOAD_BYTES))
    settings = {"spark.sql.shuffle.partitions": str(max(shuffle_partitions(spark), partitions)),
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{TASK_BYTES}b",
                "spark.sql.files.maxPartitionBytes": f"{SPLIT_BYTES}b",
                "spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FOLDERS)}
    had = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in had.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def local_test_session(cores: int | str = "*", partitions: int = 8) -> SparkSession:
    """Session used by tests and the bench on a single machine."""
    return get_session(
        "retailstar-local", master=f"local[{cores}]",
        conf={"spark.sql.shuffle.partitions": str(partitions),
              "spark.driver.memory": os.environ.get("RETAILSTAR_DRIVER_MEM", "8g")})
