"""Where operators of this subpackage read tables, cut lineage and tidy up.

What an operator writes on the way belongs to the scope that is open, which each thread has for
itself.  ``tidy`` opens one for a run of an operator; ``scope`` does so for a caller, who then has to use up
results inside it.  A folder that belongs to no scope goes when the JVM ends.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession


class Scope:
    """Folders that were written and values that were sent out."""

    def __init__(self):
        self.folders: list[str] = []
        self.values: list[Broadcast] = []

    def close(self, spark: SparkSession) -> None:
        for value in self.values:
            value.destroy()
        remove(spark, *self.folders)


_scope: ContextVar[Scope | None] = ContextVar("corvane scope", default=None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none, one is made up, which only a local master may do.
    """
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="corvane-")
        context.setCheckpointDir(found)
    return found


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def folder(spark: SparkSession, kind: str) -> str:
    """A new folder in the shared one, which goes with the open scope."""
    name = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    path, store = _path(spark, name)
    store.mkdirs(path)
    store.deleteOnExit(path)
    if own := _scope.get():
        own.folders.append(name)
    return name


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared folder, whence later stages read it.

    A table, unlike a checkpoint, is read by the columns that are asked for, and what was known of
    the plan that made it doesn't pile up in loops.
    """
    name = f"{folder(df.sparkSession, 'cut')}/table"
    df.write.parquet(name)
    return df.sparkSession.read.schema(df.schema).parquet(name)


def share(spark: SparkSession, value) -> Broadcast:
    """A value of bounded size for all tasks, given up with the open scope."""
    out = spark.sparkContext.broadcast(value)
    if own := _scope.get():
        own.values.append(out)
    return out


def remove(spark: SparkSession, *folders: str) -> None:
    for name in folders:
        path, store = _path(spark, name)
        store.delete(path, True)
        store.cancelDeleteOnExit(path)


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """Everything that is written or sent out inside goes at the end, or when something is raised."""
    own = Scope()
    before = _scope.set(own)
    try:
        yield own
    finally:
        _scope.reset(before)
        own.close(spark)


def tidy(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Lets an operator write its result and remove all that it wrote on the way, also when it fails."""

    @wraps(operator)
    def run(first: DataFrame | SparkSession, *args, **kwargs) -> DataFrame:
        spark = first if isinstance(first, SparkSession) else first.sparkSession
        outer = _scope.get()
        with scope(spark) as own:
            out = cut(operator(first, *args, **kwargs))
            result = own.folders.pop()
        if outer:
            outer.folders.append(result)
        return out

    return run


def lazily(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For an operator whose result is cheap to make from what it wrote on the way: that stays for the
    scope around it, and the result is not written once more.  It goes when the operator fails."""

    @wraps(operator)
    def run(first: DataFrame | SparkSession, *args, **kwargs) -> DataFrame:
        spark = first if isinstance(first, SparkSession) else first.sparkSession
        outer, own = _scope.get(), Scope()
        before = _scope.set(own)
        try:
            out = operator(first, *args, **kwargs)
        except BaseException:
            own.close(spark)
            raise
        finally:
            _scope.reset(before)
        if outer:
            outer.folders += own.folders
            outer.values += own.values
        return out

    return run


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
