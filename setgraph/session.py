"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


# Settings the operators are designed for (also recommended on a cluster):
# AQE re-plans every shuffle stage with measured sizes, splits skewed join
# partitions, and converts a join to broadcast only when the *measured* size of
# one side is below the adaptive threshold.  Static broadcast from planner
# estimates is off: estimates of exploded or checkpointed data can be far too
# small, and a mis-estimated broadcast of a large side would not fit.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # sides laid out by some of the join keys are joined as they are
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "setgraph",
                  checkpoint: str | None = None) -> SparkSession:
    """A local[N] session for tests and the benchmark (no UI, AQE on), with
    ``checkpoint`` as its ``spark.checkpoint.dir``."""
    builder = SparkSession.builder.master(f"local[{cpus}]")
    if checkpoint:
        builder = builder.config("spark.checkpoint.dir", checkpoint)
    for k, v in RECOMMENDED_CONF.items():
        builder = builder.config(k, v)
    return (
        builder
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # remove checkpoint files once their DataFrames are no longer referenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RECOMMENDED_CONF` (runtime SQL settings) to ``spark`` and make
    sure a checkpoint folder is known.  Called by the registered queries; a
    library user may call it once per session."""
    for k, v in RECOMMENDED_CONF.items():
        spark.conf.set(k, v)
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it only when unset.

    The folder comes from ``spark.checkpoint.dir`` (on a cluster a shared file
    system).  Only where a local-mode session leaves it unset is a folder in
    the session's warehouse taken; a cluster session without it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises on some versions
            conf_dir = None
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a shared "
            "checkpoint folder on a cluster")
    sc.setCheckpointDir(spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints")
    return sc.getCheckpointDir()


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the checkpoint folder and cut its lineage.

    Used where one intermediate feeds several branches of a plan (Spark would
    otherwise recompute it per branch) and between rounds of iterations.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def compact_checkpoint(df: DataFrame) -> DataFrame:
    """Like :func:`reliable_checkpoint`, but by a compressed parquet folder beside the
    checkpoints, of which later steps read the columns that they need.  For wide rows; the
    folder is not removed with the DataFrame."""
    folder = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


# The folder that holds the package.
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def share_package(spark: SparkSession) -> None:
    """Add the package's folder to the path of the Python workers, which import it.

    This serves local sessions and shared installations; a cluster without either gets
    the package by ``--py-files``."""
    environment = spark.sparkContext.environment
    path = environment.get("PYTHONPATH", "")
    if ROOT not in path.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(p for p in (ROOT, path) if p)


def in_session(df: DataFrame, session: SparkSession) -> DataFrame:
    """``df`` as a DataFrame of another session of the same application, so that it
    runs under that session's settings."""
    name = f"setgraph_{uuid.uuid4().hex}"
    df.createGlobalTempView(name)
    try:
        return session.table(f"global_temp.{name}")
    finally:
        session.catalog.dropGlobalTempView(name)


def static_session(spark: SparkSession) -> SparkSession:
    """A session of its own with a static (non-adaptive) planner and otherwise the
    settings of :data:`RECOMMENDED_CONF`; ``spark`` and its queries are untouched."""
    own = spark.newSession()
    for k, v in RECOMMENDED_CONF.items():
        own.conf.set(k, v)
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.adaptive.enabled", "false")
    return own


def partitioned_checkpoint(df: DataFrame) -> DataFrame:
    """Like :func:`reliable_checkpoint` for a DataFrame of a :func:`static_session`: the
    result remembers its hash partitioning, so later joins and aggregations on the
    same keys do not shuffle it again (an adaptive plan would hide it).  For plans
    whose skew is already handled (salted keys, one row per key)."""
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        raise ValueError("partitioned_checkpoint needs a DataFrame of a static session")
    return reliable_checkpoint(df)
