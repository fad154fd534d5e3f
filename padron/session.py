"""Session settings and the few driver-side helpers every module shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

SHARED = "spark.padron.shared_folder"
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "padron", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the engine's SQL settings; sizing stays with the cluster's own configuration."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that the driver and all executors share.

    The folder is named by ``spark.checkpoint.dir``, or by ``spark.padron.shared_folder`` where that is unset.
    Without either there is no safe place for intermediate tables, so this raises.
    """
    base = _shared_base(spark)
    if not base:
        raise RuntimeError(f"set spark.checkpoint.dir or {SHARED} to a folder that all executors share")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def has_shared_folder(spark: SparkSession) -> bool:
    return bool(_shared_base(spark))


def _shared_base(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(SHARED, None)


def use_local_folder(spark: SparkSession) -> SparkSession:
    """Names a temporary shared folder for a session in one JVM that has none, as in tests and local runs."""
    if not _shared_base(spark) and re.match(r"local(\[|$)", spark.sparkContext.master):
        spark.conf.set(SHARED, f"file://{tempfile.mkdtemp(prefix='padron-')}")
    return spark


def col(name: str) -> Column:
    """Column by its exact name: sheet headers carry dots, slashes, '#' and '%'."""
    return F.col(quoted(name))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
