"""Session construction and the shared scratch location.

Everything that must outlive a task (materialised logs, commit-table
versions, streaming checkpoints) goes under ``spark.checkpoint.dir``: on a
cluster that is a shared folder named by the cluster configuration.  Only
when the setting is absent (tests, local runs) do we pick a local folder.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on for correct results.
REQUIRED_CONF = {
    # Timestamps are interpreted and rendered in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Business events re-encode as metadata merged with the payload where the
    # payload keys win (map_concat with a duplicate key keeps the last one).
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Runtime re-planning: coalesce small shuffles, split skewed partitions,
    # turn a shuffle join into a broadcast once the real side size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition directory values (partition ids such as "0") stay strings.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def get_session(master: str | None = None, app: str = "tidemark",
                shuffle_partitions: int | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session, and
    ship this package to the Python workers."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    checkpoint_root(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tidemark`` importable in Python workers (pandas functions,
    stateful processors), like ``--py-files``: zip the package once per
    SparkContext on the driver and ``addPyFile`` it."""
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tidemark-pkg-"), "tidemark.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(key)


_LOCAL_ROOTS: dict[str, str] = {}


def session_key(spark: SparkSession) -> str:
    """Identity of a live session for per-session caches: the application id
    (unique per SparkContext) plus the session object."""
    return f"{spark.sparkContext.applicationId}/{spark._jsparkSession.hashCode()}"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir``; set a local one only when unset.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:  # noqa: BLE001 - some deployments refuse core keys here
            root = None
    if not root:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder "
                             "that the driver and all executors share")
        key = sc.applicationId
        root = _LOCAL_ROOTS.get(key)
        if root is None:
            root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
            _LOCAL_ROOTS[key] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


@contextmanager
def state_partitions(spark: SparkSession):
    """Queries started inside keep their streaming state in one partition per
    core (never more than ``spark.sql.shuffle.partitions``).  The state here is
    one small row per log partition, while every state partition costs a task,
    a state store and for keyed processors a Python worker's round trip in
    every micro-batch, empty or not.  Spark fixes the number when a checkpoint
    is made; a restarted query keeps its own."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), max(spark.sparkContext.defaultParallelism, 1))))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    return "/".join([checkpoint_root(spark), *parts])


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def ensure_dir(path: str) -> None:
    if is_local_path(path):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
