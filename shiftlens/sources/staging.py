"""Shared intermediate results as written tables, so that many reports reuse one computation.

A staged frame is a parquet table on the storage that all executors share: it cuts the lineage,
survives the loss of executors and gives Catalyst real sizes for its join choices.
"""

from __future__ import annotations

import functools
import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 200_000


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only for a local session."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return tempfile.mkdtemp(prefix="shiftlens-")


class Stage:
    """Named tables under one run folder; each is computed once."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._root: str | None = None
        self._tables: dict[str, DataFrame] = {}
        self._lock, self._making = threading.RLock(), {}

    @property
    def root(self) -> str:
        with self._lock:
            if self._root is None:
                self._root = f"{shared_folder(self.spark)}/shiftlens-{uuid.uuid4().hex}"
            return self._root

    def get(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The named table; the first call runs the jobs that write it.  Different tables can be made at once."""
        with self._lock:
            own = self._making.setdefault(name, threading.RLock())
        with own:
            if name not in self._tables:
                df = make()
                path = f"{self.root}/{name}"
                df.write.mode("overwrite").parquet(path)
                self._tables[name] = self.spark.read.schema(df.schema).parquet(path)
            return self._tables[name]

    def drop(self) -> None:
        """Delete the run folder with every staged table."""
        if self._root is not None:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self._root)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        self._root, self._tables, self._making = None, {}, {}


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a small, cheap frame after counting it; past the limit leave the join to AQE.

    Beyond the limit the join shuffles both sides and adaptive execution splits skewed keys.
    """
    few = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if few else df


def staged(operator):
    """Keep the result of ``operator(site, *args)`` as a staged table of the site, one for each ``args``."""

    @functools.wraps(operator)
    def wrapper(site, *args):
        name = ".".join([operator.__module__.rsplit(".", 1)[-1], operator.__name__, *map(str, args)])
        return site.stage(name, lambda: operator(site, *args))

    return wrapper
