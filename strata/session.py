"""Session and scratch-space helpers.

The library never creates its own ``SparkSession`` inside an operator: callers
pass theirs.  ``local_session`` exists for tests, the bench and examples.

Scratch data (frozen intermediate tables that cut lineage, CSV staging in the
fixture-driven queries) always goes under the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent *and* the master is
local (tests, bench) do we pick a temporary folder ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*",
    shuffle_partitions: int = 8,
    app_name: str = "strata",
    driver_memory: str = "8g",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session tuned like the cluster one: AQE on, UI off, UTC.  Its
    warehouse folder is a fresh temporary folder, not the working directory."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="strata-warehouse-"))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "") or ""
    return master == "local" or master.startswith("local[")  # the executors of local-cluster are other processes


def checkpoint_root(spark: SparkSession) -> str:
    """The shared scratch folder: ``spark.checkpoint.dir`` of the session.

    If the session has none, a local session gets a fresh temporary folder
    (registered as its checkpoint dir, so later calls reuse it); a cluster
    session raises, because a machine-local folder is not visible to the
    executors and does not survive their loss.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # e.g. a remote (Connect) session has no SparkContext
        current = None
    if current:
        # setCheckpointDir appends a per-application UUID folder; use its parent
        return current.rstrip("/").rsplit("/", 1)[0]
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder for "
            "frozen intermediate tables"
        )
    root = tempfile.mkdtemp(prefix="strata-ckpt-")
    try:
        spark.sparkContext.setCheckpointDir(root)
    except Exception:
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unique folder name under the checkpoint root (not created); what is
    written there is removed when the application ends."""
    path = f"{checkpoint_root(spark)}/strata/{label}-{uuid.uuid4().hex[:12]}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path

