"""Session-level helpers: checkpoint folder and the settings the job relies on."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_RECORDS: list[list[str]] = []


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and job outputs.

    Read from the session (``spark.checkpoint.dir`` or the context's checkpoint dir).
    Only a local master may go without: there a private temporary folder is made. On a
    cluster each executor would write to its own disk, so the lack of a shared one raises.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: only the configuration is visible
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
        configured = tempfile.mkdtemp(prefix="basketspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    for written in _RECORDS:
        written.append(path)
    return path


@contextlib.contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """Collects the scratch folders taken inside the block."""
    written: list[str] = []
    _RECORDS.append(written)
    try:
        yield written
    finally:
        _RECORDS[:] = [r for r in _RECORDS if r is not written]


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def create_exclusive(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a small file that must not exist; False if another one was first.

    On a local disk the file is linked into place, elsewhere it is created without overwriting,
    which shared file systems do for one writer only.
    """
    fs, p = _file_system(spark, path)
    jvm = spark._jvm
    raw = bytearray(text.encode())
    try:
        if p.toUri().getScheme() in (None, "file"):
            files, nio = jvm.java.nio.file.Files, jvm.java.io.File
            target = nio(p.toUri().getPath()).toPath()
            files.createDirectories(target.getParent(), spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
            draft = nio(f"{target.getParent()}/.{uuid.uuid4().hex}").toPath()
            files.write(draft, raw, spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 0))
            try:
                files.createLink(target, draft)  # whole at once, or not at all
            finally:
                files.delete(draft)
            return True
        out = fs.create(p, False)
        out.write(raw)
        out.close()
        return True
    except Py4JJavaError as error:
        if fs.exists(p):
            return False
        raise error


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if the folder does not exist."""
    fs, p = _file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_small(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, p = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def free_shuffles(spark: SparkSession) -> None:
    """Spark deletes the shuffle files of a finished plan once the driver's JVM has collected what
    referred to it. A driver with little to do collects late, and files of a run's steps add up."""
    try:
        jvm = spark._jvm
    except Exception:  # a remote (Connect) session
        return
    jvm.System.gc()


def discard_but(spark: SparkSession, written: list[str], *kept: DataFrame) -> None:
    """Delete those of the folders ``written`` that none of the frames reads."""
    read = [df.inputFiles() for df in kept]
    if all(read):  # a frame without files does not tell its folder
        discard(spark, [path for path in written if not any(f"/{os.path.basename(path)}/" in file for files in read for file in files)])


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete folders that this library wrote."""
    for path in paths:
        fs, p = _file_system(spark, path)
        fs.delete(p, True)


@contextlib.contextmanager
def counted(df: DataFrame, counts: dict[str, int] | None, name: str, rows: Column | None = None) -> Iterator[DataFrame]:
    """The frame with its rows counted while it is written inside the block; the count is in
    ``counts`` afterwards (no counting where that is None). ``rows`` counts by another aggregate."""
    if counts is None:
        yield df
        return
    seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    yield df.observe(seen, (F.count(F.lit(1)) if rows is None else rows).alias("rows"))
    counts[name] = seen.get["rows"]


#: While a frame is written, the shuffled megabytes that make a task (64 leave a wide stage hardly more
#: tasks than cores, so that the last ones run alone).
_WRITING = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m"}

#: Parts that the job's shuffles are dealt to at least; adaptive execution merges the small ones. With
#: the session's number alone, which may not follow the input, tasks grow with it until their sorts spill.
DEALT = 512


def wide(spark: SparkSession) -> dict[str, str]:
    """Settings under which the job's steps run: tasks grow in number with the input, not in size."""
    parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    session = spark.conf.get(parts, None) or spark.conf.get("spark.sql.shuffle.partitions")
    return {parts: str(max(int(session), DEALT))}


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings inside the block, and as they were behind it."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def materialize(
    df: DataFrame, name: str, counts: dict[str, int] | None = None, rows: Column | None = None, conf: dict[str, str] | None = None, dealt: bool = True
) -> DataFrame:
    """Write the frame once as parquet below the shared checkpoint root and read it back.

    Cuts the lineage (a lost executor re-reads files instead of replaying the plan) and
    keeps later plans small. Unlike an eager ``checkpoint()`` the input is computed once. Its shuffle
    files go when it is written, not at the end of the run.
    With ``counts`` the rows (or the aggregate ``rows``) are counted on the way, under the frame's name.
    ``conf`` holds while the frame is written, and so does ``wide`` unless ``dealt`` is off.
    """
    path = scratch_path(df.sparkSession, name)
    held = _WRITING | (wide(df.sparkSession) if dealt else {}) | (conf or {})
    with settings(df.sparkSession, held), counted(df, counts, name, rows) as seen:
        seen.write.parquet(path)
    free_shuffles(df.sparkSession)
    return df.sparkSession.read.parquet(path)


def local_session(app: str = "basketspark", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark (the cluster passes its own)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BASKETSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark
