"""Session helpers: a local session for tests/bench and the shared work folder.

On a cluster the work folder comes from ``spark.checkpoint.dir`` (a shared
file system path the cluster names). Only when it is unset - local tests and
the bench - do we create one ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8) -> SparkSession:
    """Local session with AQE on and the UI off (tests and bench)."""
    master = master or "local[8]"
    builder = (
        SparkSession.builder.master(master)
        .appName("babelframe")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BABELFRAME_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints, streaming state and written tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). If
    neither is configured, a local session (tests, bench) gets a fresh local
    folder; a cluster session raises, as its executors share no local disk.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a connect session has no context
        sc = None
    root = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not root:
        if sc is None or not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="babelframe-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared work folder."""
    return f"{work_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def configured(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Settings of the session (``spark.sql.`` left out, ``__`` for a dot) for
    what is planned and run inside; afterwards they are as before."""
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stage(df, name: str, spread: bool = True):
    """Write ``df`` once as parquet under the shared work folder and read it
    back: cuts the lineage (a lost executor never recomputes the upstream
    work) and lets several downstream passes share one computation."""
    from babelframe.sources.tables import spread_rows

    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    return spread_rows(back) if spread else back
