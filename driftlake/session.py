"""Sessions, catalogs per layer, and the shared folder for intermediate data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from driftlake.sources import files

SHARED_DIR = "spark.checkpoint.dir"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
STATE_ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def layer_catalogs(layers: dict[str, dict[str, str]]) -> dict[str, str]:
    """Catalog settings for each layer.

    ``{"silver": {"class": "...", "uri": "..."}}`` becomes ``spark.sql.catalog.silver`` and
    ``spark.sql.catalog.silver.uri``.  The implementation class is the one named ``class``.
    """
    settings = {}
    for layer, options in layers.items():
        root = f"spark.sql.catalog.{layer}"
        for name, value in options.items():
            settings[root if name == "class" else f"{root}.{name}"] = value
    return settings


def build_session(
    app: str,
    layers: dict[str, dict[str, str]] | None = None,
    master: str | None = None,
    **settings: str,
) -> SparkSession:
    """A session with one catalog per layer; ``settings`` use ``__`` for dots.

    Streaming state is kept on local disk, with its changelog in the query's checkpoint.
    Recording the Python call site of every column expression is switched off: it costs a
    micro-batch more than building its plan.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config(STATE_STORE, STATE_ON_DISK)
    )
    if master:
        builder = builder.master(master)
    for name, value in layer_catalogs(layers or {}).items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder of this machine.
    """
    root = spark.conf.get(SHARED_DIR, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR} to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="driftlake-"))
    return spark.sparkContext.getCheckpointDir()


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder under the shared one."""
    return f"{shared_dir(spark)}/driftlake/{label}-{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder under the shared one that goes away when the session's process ends."""
    path = work_dir(spark, label)
    fs, handle = files.open_path(spark, path)
    fs.mkdirs(handle)
    fs.deleteOnExit(handle)
    return path
