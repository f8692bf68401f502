"""Spark session defaults and the shared scratch location.

Everything the library writes on its own (rendered dump files, staged parts,
saved tables of the self-checks) goes below the session's checkpoint
directory: on a cluster that is the shared folder named by
``spark.checkpoint.dir``; only where it is unset (local runs, tests) a fresh
temporary folder is set once.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every qalake job relies on. Timestamps in the dump have no zone,
# so the session keeps wall-clock values (NTZ) in UTC.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str = "local[*]", app: str = "qalake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the qalake defaults."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions is not None:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


#: An action's shuffle files go when it ends, not when the driver next collects garbage.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def session_settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs inside."""
    usual = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in usual.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


_LOCAL_FALLBACK: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir, setting a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no context handle
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and sc is not None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:  # unset: a local folder, as in tests
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if "dir" not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK["dir"] = tempfile.mkdtemp(prefix="qalake-ckpt-")
        configured = _LOCAL_FALLBACK["dir"]
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/qalake-scratch/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str | None:
    """Strip a ``file:`` scheme; None when the path is on a remote file system."""
    if path.startswith("file:"):
        return "/" + path[len("file:"):].lstrip("/")
    if "://" in path:
        return None
    return path if os.path.isabs(path) else os.path.abspath(path)
