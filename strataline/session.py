"""Session helpers: reading tables and naming the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below ``sf_dir``, in the splits that its files give."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def merging(df: DataFrame) -> DataFrame:
    """The frame as a side of joins that are never broadcast.

    The planner takes what comes out of an ``explode`` or a Python stage, and of a checkpoint of these, to be
    about as large as the file it was read from. So a few MB of names whose keys take GB are broadcast through
    the driver, under Spark's own threshold too. A merge join spills instead.
    """
    return df.hint("merge")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``; a temporary folder is made only for a
    local session (tests) that names none.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="strataline-"))
    return context.getCheckpointDir()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per session, so that they need no installed copy.

    The archive is read from the driver; executors that start later fetch it too.
    """
    context = spark.sparkContext
    if getattr(context, "_strataline_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="strataline-")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(folder, "strataline_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for at, folders, files in os.walk(os.path.join(root, "strataline")):
            folders[:] = [d for d in folders if d != "__pycache__"]
            for name in files:
                if name.endswith(".py"):
                    archive.write(os.path.join(at, name), os.path.relpath(os.path.join(at, name), root))
    context.addPyFile(path)
    context._strataline_shipped = True
