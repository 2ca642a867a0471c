"""Spark session defaults and the reliable checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # of a repeated key in a JSON record the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tierlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators expect, and this package on its workers; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


def shared_folder(spark: SparkSession) -> str:
    """The reliable folder named by ``spark.checkpoint.dir``.

    Only in local mode, where one machine does all the work, is a temporary folder taken when
    neither the session nor the context names one; elsewhere that is an error, since executors
    would each write to a disk of their own.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not is_local(context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(shared or tempfile.mkdtemp(prefix="tierlake-checkpoint-"))
    return context.getCheckpointDir()


def is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of all executors, once for each context."""
    context = spark.sparkContext
    if getattr(context, "_tierlake_shipped", False):
        return
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="tierlake-package-")  # the driver hands it out until it ends
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    staged = Path(folder) / "staged"
    shutil.copytree(package, staged / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    context.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", staged))
    context._tierlake_shipped = True


def scratch_root(spark: SparkSession) -> str:
    """A new empty lake root inside the shared folder."""
    return f"{shared_folder(spark)}/lake-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, so that a lost executor costs no recompute."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
