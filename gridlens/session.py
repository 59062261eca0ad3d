"""Session defaults and the shared folder for materialised tables."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession
from pyspark.sql import types as T

# Settings every job relies on. Timestamps are interpreted in UTC so
# hour/date derivations agree with the values stored in the files.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # delete checkpoint files once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app_name: str = "gridlens", master: str | None = None,
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    Shuffle partitions are left to the cluster (AQE coalesces them) unless
    given; tests pass a small number.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for tables this library materialises (lineage cuts, fixtures).

    Uses the session's checkpoint directory (``spark.checkpoint.dir``),
    which on a cluster is a shared file system every executor can reach.
    Only a local-mode session without one gets a fresh scratch folder; on
    a cluster a missing setting is an error, never a machine-local path.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if d:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="gridlens-ckpt-"))
        d = sc.getCheckpointDir()
    return d.rstrip("/")


def require_utc(spark: SparkSession, ts_type: T.DataType | None) -> None:
    """Days and hours of zoned time stamps follow the session's zone, so the
    jobs run in UTC alone; time stamps without a zone do not care."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if not isinstance(ts_type, T.TimestampNTZType) and zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise RuntimeError(f"set spark.sql.session.timeZone to UTC, not {zone}")


def table_path(spark: SparkSession, *parts: str) -> str:
    """Path of a named table below :func:`shared_dir`."""
    return "/".join([shared_dir(spark), "gridlens", *parts])


DONE_MARKER = "_GRIDLENS_DONE"


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def mark_done(spark: SparkSession, root: str) -> None:
    """Record that the table under ``root`` is complete (a swap of days leaves
    no ``_SUCCESS`` file at the table root)."""
    fs, p = _fs_path(spark, f"{root}/{DONE_MARKER}")
    fs.create(p, True).close()


def is_done(spark: SparkSession, root: str) -> bool:
    fs, p = _fs_path(spark, f"{root}/{DONE_MARKER}")
    return bool(fs.exists(p))
