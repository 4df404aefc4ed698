"""Session helpers: shared scratch folder, lineage cuts, size-checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only if its counted size stays below this.
BROADCAST_LIMIT_BYTES = 48 << 20

_scratch_dirs: list[tuple[SparkSession, str]] = []
_registered = False


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of a data folder (a file or a folder of parts)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Only where the session
    names none (local mode, tests) a temporary folder is made and used instead."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
        if own.isDefined():
            return own.get()
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tracewright-")
        spark.sparkContext.setCheckpointDir(named)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return named


def scratch_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/tracewright/{name}-{uuid.uuid4().hex}"
    global _registered
    if not _registered:
        atexit.register(_clean)
        _registered = True
    _scratch_dirs.append((spark, path))
    return path


def remove_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> int:
    """Deletes the tables staged so far in the session's shared folder; their number. Results
    that still read them must have been written or collected before. A long session calls this
    between queries, so that its disk does not fill; what is left goes at exit."""
    mine = [p for s, p in _scratch_dirs if s is spark]
    for path in mine:
        remove_path(spark, path)
    _scratch_dirs[:] = [(s, p) for s, p in _scratch_dirs if s is not spark]
    return len(mine)


def _clean() -> None:
    for spark, path in _scratch_dirs:
        try:
            remove_path(spark, path)
        except Exception:  # the session may be gone already
            pass


class Staged:
    """A table written to the shared folder: its lineage is cut, a lost executor costs
    nothing but the tasks it ran. ``df`` reads it back; ``drop`` deletes it early."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove_path(self.spark, self.path)


def stage(df: DataFrame, name: str = "step") -> DataFrame:
    return Staged(df, name).df


def broadcast_if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Hint ``df`` for broadcast if its counted rows times ``row_bytes`` stay below the
    limit; otherwise leave the join to a shuffle, which AQE splits where it is skewed.
    ``df`` should be cheap to count (a staged or scanned small table)."""
    return F.broadcast(df) if df.count() * row_bytes < limit else df
