"""Session helpers: building a session for local runs, and a shared scratch area.

Library code never creates its own session; these helpers exist for jobs,
tests and the bench. Scratch space is taken from ``spark.checkpoint.dir``
(the shared folder a cluster names); a machine-local temporary folder is
used only when that setting is unset and the master is local.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this package assumes. Timestamps without a zone are
# read as UTC wall clock, so the session zone is pinned to UTC.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = "local[*]", app: str = "docexport",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with this package's settings; ``master=None`` keeps spark-submit's."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting one only if unset.

    On a cluster the directory must come from ``spark.checkpoint.dir``; a
    local temporary folder is made only for local masters (tests, bench).
    """
    try:
        sc = spark.sparkContext
    except Exception:  # a remote (Connect) session: the folder comes from the config
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if conf_dir:
            return conf_dir
        raise RuntimeError("spark.checkpoint.dir is unset: name a folder that the cluster shares")
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is unset: name a shared folder for checkpoints "
            "and scratch tables (a machine-local folder does not survive executor loss)")
    local = tempfile.mkdtemp(prefix="docexport-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for files a job writes."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex}")


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder where Spark's own file systems find it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def write_scratch(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A written copy of ``df`` in the shared scratch folder, and its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def scratch_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """A written copy of ``df`` that several jobs share; deleted at the end.

    A lost executor costs the tasks that read it, not the plan that made it.
    """
    copy, path = write_scratch(df, name)
    try:
        yield copy
    finally:
        remove_path(df.sparkSession, path)
