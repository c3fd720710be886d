"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_ROOT = str(Path(__file__).resolve().parent.parent)

RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def build_session(app_name: str = "tillgrain", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package expects; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RECOMMENDED.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def prepare_workers(df: DataFrame) -> DataFrame:
    """``df``, whose Python workers on this machine can import the package from where it lies.

    On a cluster the package is installed or shipped with ``--py-files``.
    """
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
    return df


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a session whose driver and executors are one process may fall back to a temporary
    folder, which goes when the process ends: on a cluster other machines would not see it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share.")
        folder = tempfile.mkdtemp(prefix="tillgrain-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")
