"""Session settings the mart relies on.

* UTC session zone: calendar keys are built from zone-less (NTZ) times; a
  zone with daylight saving would shift or drop minutes in its gaps.
* ANSI on: bad money text raises, as a warehouse cast would.
* AQE on, with skew-join splitting and partition coalescing, so the same
  code fits sf0.001 on a laptop and 100 TB on a cluster.
"""

from __future__ import annotations

import os
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the settings the mart's semantics depend on to a live session."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "app")


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared checkpoint folder the cluster names, if any."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not found and sc is not None:
        found = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    return found


def is_local(spark: SparkSession) -> bool:
    """Driver and executor are one process, so a private folder is a shared one."""
    sc = _context(spark)
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, for tables written between jobs.

    It is the one the session names in ``spark.checkpoint.dir``. Where none is
    named, a plain local master gets a private temporary folder; any other
    master raises, since each executor would write to a disk of its own.
    """
    found = checkpoint_dir(spark)
    if found:
        return found.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on this master")
    return use_checkpoint_dir(spark, tempfile.mkdtemp(prefix="martlet-"))


def use_checkpoint_dir(spark: SparkSession, path: str) -> str:
    """Name ``path`` as the session's shared folder unless it has one."""
    found = checkpoint_dir(spark)
    if found:
        return found
    sc = _context(spark)
    if sc is not None:
        sc.setCheckpointDir(path)
    else:
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "martlet",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("MARTLET_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_conf(spark)


def cluster_conf(executor_cores_total: int, input_bytes: int) -> dict[str, str]:
    """Settings for a large cluster, sized from the core count and input size.

    * The initial shuffle partition count targets ~256 MB per reduce task on
      the largest exchange -- estimated as a quarter of the input, since scans
      are column-pruned and the facts are pre-aggregated before they shuffle --
      with at least 3 tasks per core; AQE then coalesces small partitions and
      splits skewed ones at run time.
    * Scan splits of 256 MB keep file tasks long enough to amortize start-up
      without exceeding executor memory.
    * Broadcasts are Spark's own decision, from plan statistics and AQE's
      runtime sizes, with a 64 MB ceiling.
    """
    target = 256 * 1024 * 1024
    wanted = -(-(input_bytes // 4) // target)
    partitions = max(executor_cores_total * 3, wanted)
    return {
        **REQUIRED_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }


def size_session(spark: SparkSession, input_bytes: int) -> dict[str, str]:
    """Apply ``cluster_conf`` for an input of ``input_bytes`` to a live session.

    Cores come from the configured executors (their number under dynamic
    allocation is its maximum, not what happens to be registered by now).
    Settings the user gave are left alone.
    """
    sc = _context(spark)
    given = dict(sc.getConf().getAll()) if sc is not None else {}
    executors = int(given.get("spark.dynamicAllocation.maxExecutors",
                              given.get("spark.executor.instances", "1")))
    cores = executors * int(given.get("spark.executor.cores", "4"))
    wanted = {k: v for k, v in cluster_conf(cores, input_bytes).items() if k not in given}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    return wanted


# Spark's setting (from 4.1) that removes a query's shuffle files when the query ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING_LOCK = threading.Lock()
_CLEANING: dict[int, tuple[int, str | None]] = {}  # session -> blocks open, the setting before them


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries that begin in this block leave no shuffle files behind.

    Else the files of every finished job stay on disk until the driver's garbage collector
    next meets them. Meant for queries that run once, as writes do: run again, they would
    make their shuffles anew. Blocks may be nested and opened by several threads.
    """
    key = id(spark)
    with _CLEANING_LOCK:
        blocks, before = _CLEANING.get(key, (0, None))
        if not blocks:
            before = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _CLEANING[key] = blocks + 1, before
    try:
        yield
    finally:
        with _CLEANING_LOCK:
            blocks, before = _CLEANING.pop(key)
            if blocks > 1:
                _CLEANING[key] = blocks - 1, before
            elif before is None:
                spark.conf.unset(CLEANUP)
            else:
                spark.conf.set(CLEANUP, before)


# Stored bytes of input up to which tables that do not depend on each other are written
# together. A larger one fills the cores alone, and the shuffle files of several would lie
# on disk at once.
TOGETHER_BYTES = 64 << 20

# Stored bytes of input to a map task, and to a reduce task before AQE coalesces them.
MAP_BYTES, REDUCE_BYTES = 16 << 20, 4 << 20


def fit_tasks(spark: SparkSession, size: int) -> None:
    """Let a task's share stay what it is while the input grows to ``size`` bytes.

    A hash aggregate or a sort that outgrows its task's memory is spilled, and the more so the
    larger its share. Splits of a scan get a ceiling, and exchanges begin with partitions
    in proportion to the input; AQE coalesces those that turn out small. Settings the user gave
    are left alone, and the number of partitions is only raised.
    """
    sc = _context(spark)
    given = dict(sc.getConf().getAll()) if sc is not None else {}
    split, first = "spark.sql.files.maxPartitionBytes", \
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if split not in given:
        spark.conf.set(split, str(MAP_BYTES))
    now = spark.conf.get(first, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if first not in given and size // REDUCE_BYTES > int(now):
        spark.conf.set(first, str(size // REDUCE_BYTES))


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes under ``paths`` (folders or files that Hadoop's file systems can list)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        total += p.getFileSystem(conf).getContentSummary(p).getLength()
    return total
