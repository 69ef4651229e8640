"""Session helpers: settings every job shares, and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "shelfwatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's defaults; keys in ``conf`` use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**_DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder shared by all executors, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own: on a cluster a machine-local
    folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="shelfwatch-")
    spark.conf.set("spark.checkpoint.dir", folder)
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder for one run of ``name``."""
    import uuid

    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
