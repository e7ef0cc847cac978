"""Session helpers: a local session for tests/bench, and the shared checkpoint root."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import SparkSession


JIT_HUGE_METHODS = "-XX:-DontCompileHugeMethods"
#: Number of partitions that small stand-in inputs are dealt out to; unset: as scanned.
SPREAD = "spark.gradeflow.spread"


def local_session(cores: str | int = "*", app: str = "gradeflow", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the bench; on a cluster use the cluster's session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # A small file is one scan task: deal its rows out to all local cores.
        .config(SPREAD, str(cores) if str(cores).isdigit() else "")
        .config("spark.driver.memory", os.environ.get("GRADEFLOW_DRIVER_MEMORY", "8g"))
        # Generated scoring code has methods above HotSpot's 8000-byte JIT limit;
        # without this they run interpreted (2x slower). On a cluster set the
        # same flag in spark.executor.extraJavaOptions.
        .config("spark.driver.extraJavaOptions", JIT_HUGE_METHODS)
        .config("spark.executor.extraJavaOptions", JIT_HUGE_METHODS)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    The cluster's setting is used as is.  Only on a local master, where it is
    unset, a scratch folder is created and registered: on a cluster each executor
    would write its part to a disk of its own.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="gradeflow-ckpt-")
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def spread_to(spark: SparkSession) -> int | None:
    """The explicit number of partitions for small inputs, if one is set."""
    return int(spark.conf.get(SPREAD, "") or 0) or None


@contextmanager
def settings(spark: SparkSession, held: Mapping[str, str]) -> Iterator[None]:
    """The session's settings with these in place of its own, which come back at the end."""
    before = {k: spark.conf.get(k, None) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the checkpoint root (never reused across runs)."""
    return "/".join([checkpoint_root(spark), *parts, uuid.uuid4().hex])
