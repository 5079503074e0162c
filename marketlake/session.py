"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that change results; forced on every session the package is given.
SEMANTIC_CONFS = {"spark.sql.session.timeZone": "UTC"}

# Settings that change plans only; kept when the cluster already chose a value.
PLAN_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # keys of a partial aggregate that hash before it falls back to sorting
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "8192",
    # call-site capture costs a stack walk per column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "marketlake", master: str | None = None,
                  confs: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**PLAN_CONFS, **SEMANTIC_CONFS, **(confs or {})}.items():
        builder = builder.config(key, value)
    return ensure_session(builder.getOrCreate())


def ensure_session(spark: SparkSession) -> SparkSession:
    """Pin the time zone on a session somebody else created."""
    for key, value in SEMANTIC_CONFS.items():
        if spark.conf.get(key) != value:
            spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings that hold for what is planned or started within; ``__`` in a name stands for a dot."""
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def is_local(spark: SparkSession) -> bool:
    return spark.conf.get("spark.master", "").startswith("local")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the folder the cluster shares in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting falls back to the machine's
    own temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/marketlake-{purpose}-{uuid.uuid4().hex[:12]}"
