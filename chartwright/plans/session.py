"""Session settings and the shared scratch folder.

Library operators never touch session state.  The job entry points call
``tune`` once, which sets only optimizer knobs that change plans, never
results; ``arrow_batches`` bounds what tasks hold and puts the limit back.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import weakref
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from chartwright import defaults as D

# Top-k per market is written as ``row_number() <= n``.  Spark inserts a
# partial ``WindowGroupLimit`` below the shuffle only when n is at most its
# threshold (1000 unless set), so an entry point passes the largest n it uses.
DEFAULT_TOP_N = max(D.TOP_N_SME, D.TOP_N_ORCHARD, D.SHORT_VIDEO_TOP_SME, D.SHORT_VIDEO_TOP_ORCHARD, D.PLAYLIST_LENGTH)


def tune(spark: SparkSession, largest_n: int = DEFAULT_TOP_N) -> SparkSession:
    """Plan-only settings for limits up to ``largest_n``; results do not depend on them."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    current = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if current < largest_n:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(largest_n))
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("chartwright")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


class ScratchError(RuntimeError):
    """No folder that driver and executors share is known."""


_local_scratch: dict[str, str] = {}


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables.

    This is whatever ``spark.checkpoint.dir`` names (a file system that the
    driver and all executors reach), or the checkpoint folder set on the
    context.  Where neither is set, a session with a ``local`` master (driver
    and executors are one process, as in tests) gets a folder of its own for
    its lifetime; any other session is refused, because executors would write
    to their own disks.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path:
        return path
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise ScratchError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _local_scratch:
        path = tempfile.mkdtemp(prefix="chartwright-")
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        _local_scratch[sc.applicationId] = path
    return _local_scratch[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the scratch folder."""
    base = scratch_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{uuid.uuid4().hex[:12]}"


_stages: list[list[str]] = []
_stage_of: dict[int, tuple[weakref.ref, str]] = {}


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system holds it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def arrow_batches(spark: SparkSession, size: str = "4m"):
    """Rows go to Python tasks in batches of about ``size`` for what runs inside the block; results do not depend on it.

    Spark's own limit lets a batch of long texts or sets fill 64 MB, which every
    task holds outside the heap, in the executor and in its Python worker.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def stage_scope(spark: SparkSession):
    """Remove the stages that ``materialize`` writes inside the block, when it ends."""
    _stages.append([])
    try:
        yield
    finally:
        for path in _stages.pop():
            remove(spark, path)


def materialize(df: DataFrame, name: str = "stage", *, keep: bool = False, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet into the shared scratch folder and read it back.

    This is the lineage cut used between job stages: one computation (a
    reliable ``checkpoint()`` computes its input twice unless cached), files
    on the shared filesystem survive a lost executor, and the read-back plan
    carries real file sizes, so the next joins are planned from them.
    ``keep``: the stage outlives the enclosing ``stage_scope``; ``compression``: a
    Parquet codec other than the session's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _stages and not keep:
        _stages[-1].append(path)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    staged = spark.read.parquet(path)
    _stage_of[id(staged)] = (weakref.ref(staged), path)
    return staged


def discard(staged: DataFrame) -> None:
    """Delete a stage after its last reader; the frame must be the one that ``materialize`` returned."""
    held, path = _stage_of.pop(id(staged))
    if held() is not staged:
        raise ScratchError("not a stage")
    remove(staged.sparkSession, path)
