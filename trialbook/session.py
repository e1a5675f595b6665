"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
ADVISORY_KEY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, console_progress: bool = True) -> SparkSession:
    """A session for tests and the bench; a cluster supplies its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("trialbook")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", str(console_progress).lower())
        .getOrCreate()
    )


def tune(spark: SparkSession) -> None:
    """Unless the cluster decided: let AQE split a hot join key even when that costs one more shuffle, and let it join
    small partitions up to 16 MB only. Rows of a few numbers are 14 bytes in a shuffle and over 200 where they are sorted,
    joined and told apart, so 64 MB of them would take a task more than 1 GB."""
    for key, value in (("spark.sql.adaptive.forceOptimizeSkewedJoin", "true"), (ADVISORY_KEY, "16m")):
        if spark.sparkContext.getConf().get(key) is None:
            spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a ``local`` master may go without: its executors see the driver's temporary folder. On a
    cluster a missing setting is an error, since each machine would write to its own disk.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="trialbook-")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return folder.rstrip("/")


_STAGED: dict[str, list[str]] = {}


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder, for as long as ``drop_staged`` is not called."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _STAGED.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_staged(spark: SparkSession) -> None:
    """Delete what lies at the paths that ``new_path`` and ``stage`` gave this application, once no frame reads it any more."""
    for path in _STAGED.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def stage(df: DataFrame, label: str, partition_by: Sequence[str] = (), compression: str | None = None) -> DataFrame:
    """Write a frame once and go on from the written table, in a folder per value of ``partition_by``.

    Every later pass then sees the same rows in the same slices, and a lost executor costs a
    re-read rather than a recomputation of the lineage. What was shuffled for the table is deleted when it is written,
    since the disk would hold it until the driver happens to collect its garbage.
    """
    return _staged(df, new_path(df.sparkSession, label), partition_by, compression)


def _staged(df: DataFrame, path: str, partition_by: Sequence[str], compression: str | None) -> DataFrame:
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP_KEY, None)
    conf.set(CLEANUP_KEY, "true")
    try:
        df.write.partitionBy(*partition_by).options(**({"compression": compression} if compression else {})).parquet(path)
    finally:
        if before is None:
            conf.unset(CLEANUP_KEY)
        else:
            conf.set(CLEANUP_KEY, before)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    return written.select(*df.columns) if partition_by else written


@contextmanager
def brief(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """A ``stage`` whose tables are deleted at the end, when no frame reads them any more."""
    paths: list[str] = []

    def put(df: DataFrame, label: str, partition_by: Sequence[str] = (), compression: str | None = None) -> DataFrame:
        paths.append(new_path(spark, label))
        return _staged(df, paths[-1], partition_by, compression)

    try:
        yield put
    finally:
        for path in paths:
            _STAGED[spark.sparkContext.applicationId].remove(path)
            _delete(spark, path)
