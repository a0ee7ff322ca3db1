"""SparkSession helpers.

Settings that matter at scale are set here once: AQE (runtime broadcast
conversion from measured sizes, partition coalescing, skew-join splitting),
Arrow for pandas UDFs, and a shared checkpoint folder.  The checkpoint folder
is read from ``spark.checkpoint.dir`` when the cluster names one; only when it
is unset (local tests) is a fresh scratch folder created.
"""

from __future__ import annotations

import os
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Spark's setting by which the shuffle files of an execution go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tessera") -> SparkSession:
    """A session with the settings that the plans rely on.

    Settings of one machine (master, driver address and memory, few shuffle
    partitions) are given only for a local master: the one asked for, or
    ``local[8]`` if neither the caller, the environment nor ``spark-submit``
    names any.  On a cluster its own settings hold."""
    from pyspark import SparkConf

    asked = master or os.environ.get("TESSERA_MASTER")
    current = asked or SparkConf().get("spark.master", None) or "local[8]"
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # checkpoint files of RDDs nobody references any more are removed
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.log.level", "ERROR")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.log.structuredLogging.enabled", "false")
    )
    parts = shuffle_partitions or os.environ.get("TESSERA_SHUFFLE_PARTITIONS")
    if current == "local" or current.startswith("local["):
        parts = parts or 8
        builder = (
            builder.config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.bindAddress", "127.0.0.1")
            .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        )
        asked = asked or current
    if asked:
        builder = builder.master(asked)
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir`` when set; otherwise (local
    runs only) creates a scratch folder and registers it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the context
        sc = None
    if not path and sc is not None:
        path = sc.getConf().get("spark.checkpoint.dir", None)
        if not path:  # set programmatically with sc.setCheckpointDir(...)
            current = sc._jsc.sc().getCheckpointDir()
            if not current.isEmpty():
                path = current.get()
    if not path:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that driver and executors share")
        path = tempfile.mkdtemp(prefix="tessera-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for a written table."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside."""
    was = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in was.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shuffles_freed(spark: SparkSession):
    """The shuffle files of a step that is run inside go as soon as it has ended,
    not when the driver happens to collect its garbage.  For steps whose result is
    written to the shared folder: nothing reads their shuffles again."""
    return settings(spark, {SHUFFLE_CLEANUP: "true"})


def reliable_checkpoint(df):
    """Eager, reliable checkpoint of ``df`` into the shared checkpoint folder
    (never ``localCheckpoint``: an executor loss must not lose the data)."""
    checkpoint_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a plan of its own: it takes the setting
