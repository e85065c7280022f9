"""Intermediate tables in the shared folder the cluster names."""

from __future__ import annotations

import atexit
import contextlib
import copy
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CONF = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where it is unset on a local master."""
    context = spark.sparkContext
    folder = (
        spark.conf.get(CONF, None)
        or context.getConf().get(CONF, None)
        or context.getCheckpointDir()
    )
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"{CONF} must name a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="wxpipe-")
    spark.conf.set(CONF, folder)
    return folder


class Staging:
    """Parquet tables below one run-private folder.

    A staged table cuts lineage on storage that outlives an executor, is computed once however
    often it is read, and prunes to the columns each reader needs. Frames read from it stay
    valid until :meth:`clear`: use the object as a context manager, or, where the frames are
    handed on and evaluated later, ask for ``until_exit``.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, until_exit: bool = False):
        self.spark = spark
        self.root = f"{(root or shared_folder(spark)).rstrip('/')}/_staged-{uuid.uuid4().hex}"
        # Held here so that clearing still works once the session has been stopped.
        self._folder = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if until_exit:
            atexit.register(self._clear_quietly)

    def within(self, spark: SparkSession) -> Staging:
        """The same folder, read through another session; clearing stays with this object."""
        other = copy.copy(self)
        other.spark = spark
        return other

    def path(self, name: str) -> str:
        return f"{self.root}/{name}".rstrip("/")

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def clear(self) -> None:
        self._files.delete(self._folder, True)

    def _clear_quietly(self) -> None:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            self.clear()

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_exc: object) -> None:
        self.clear()
