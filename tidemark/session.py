"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from functools import lru_cache

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here expects; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.ui.showConsoleProgress": "false",
        # Building a plan costs less without a stack trace per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder every executor can reach: under ``spark.checkpoint.dir``.

    Only a local session may do without that setting; it then uses a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or _local_dir(spark.sparkContext.master)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


@lru_cache(maxsize=1)
def _local_dir(master: str) -> str:
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return tempfile.mkdtemp(prefix="tidemark-")


@contextmanager
def session_conf(spark: SparkSession, **conf: str):
    """Set SQL settings for the body and put the old values back after it."""
    names = {key.replace("__", "."): value for key, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name, value in names.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
