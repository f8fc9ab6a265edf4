"""Spark session settings for the report jobs.

The jobs are declarative DataFrame plans; what matters at scale is set here:
adaptive execution (runtime re-planning, partition coalescing, skew-join
splitting), a size-checked broadcast threshold, UTC time and no web UI.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Broadcast joins are chosen by the planner only below this size (bytes), from
# file statistics at planning time and from measured shuffle sizes under AQE.
# Anything larger falls back to a shuffle join. File sizes are of compressed
# columns, so the estimate is scaled up before it is compared.
BROADCAST_LIMIT_BYTES = 10 * 1024 * 1024
FILE_COMPRESSION_FACTOR = 4.0

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small shuffle outputs (aggregated reports) still keep several tasks for
    # their CPU-heavy window stages; large outputs are unaffected
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(128 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_LIMIT_BYTES),
    "spark.sql.sources.fileCompressionFactor": str(FILE_COMPRESSION_FACTOR),
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints (table positions, split ranks) are removed once unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "jobtrend",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster pass ``master=None`` and let spark-submit decide; tests and the
    bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names this folder (shared storage, survives executor loss). Only
    when it is unset and the master is local (tests, a laptop) a fresh folder is
    made and registered; on a cluster an unset folder is an error, since a
    machine-local folder would not be visible to the other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a shared folder: table-scope windows and "
                "split ranks checkpoint there"
            )
        configured = fallback or tempfile.mkdtemp(prefix="jobtrend-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        _remove_at_exit(spark, f"file:{configured}")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_TO_REMOVE: list[tuple] = []


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``; removed when the driver exits, or by ``scratch``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _remove_at_exit(spark, path)
    return path


@contextmanager
def scratch() -> Iterator[None]:
    """Removes the shared folders that were made inside, on leaving: for a driver that runs many queries.

    Their results must have been written or collected by then.
    """
    mark = len(_TO_REMOVE)
    try:
        yield
    finally:
        _remove_folders(mark)


def _remove_at_exit(spark: SparkSession, path: str) -> None:
    if not _TO_REMOVE:
        atexit.register(_remove_folders)
    # the settings outlive a stopped session
    _TO_REMOVE.append((spark._jvm, spark.sparkContext._jsc.hadoopConfiguration(), path))


def _remove_folders(mark: int = 0) -> None:
    while len(_TO_REMOVE) > mark:
        jvm, settings, path = _TO_REMOVE.pop()
        if path.startswith("file:"):
            shutil.rmtree("/" + path.removeprefix("file:").lstrip("/"), ignore_errors=True)
            continue
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(settings).delete(where, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` in the shared folder (one job computes and writes it)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
