"""A folder on any file system that Spark reaches, with files and tables that change as a whole.

A file is written beside its place and renamed.  A table is a folder of its own for each version, and a
small file that names the version which holds; that file changes last, so whoever reads finds the old
table or the new one, and a job that ends half-way leaves at most a version that nobody names.  The
version before stays, for plans that still read it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


class Taken(FileExistsError):
    """Something is there already that was to be made for the first time."""


class Store:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, str(folder).rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self._root = self._path("")
        self._fs = self._root.getFileSystem(self._conf)
        # local files get no checksum beside them, which would bar whoever edits one by hand from reading it
        self._out = self._fs.getRawFileSystem() if self._fs.getUri().getScheme() == "file" else self._fs

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._path(name))

    def names(self, name: str = "") -> list[str]:
        """What lies in a folder, sorted; nothing if it isn't there."""
        return sorted(x.getPath().getName() for x in self._fs.listStatus(self._path(name))) if self.exists(name) else []

    def make(self, name: str = "") -> None:
        self._fs.mkdirs(self._path(name))

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def size(self, name: str) -> int:
        return self._fs.getFileStatus(self._path(name)).getLen()

    def digest(self, name: str) -> str:
        """SHA-256 of a file, read through a buffer."""
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()

    def text(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, name: str, text: str, new: bool = False) -> None:
        """Writes a small file; with ``new`` there must be none."""
        part = f".{name}.{uuid.uuid4().hex}"
        stream = self._out.create(self._path(part), False)
        stream.write(text.encode())
        stream.close()
        self.rename(part, name, new)

    def rename(self, old: str, name: str, new: bool = False) -> None:
        """Puts a file in the place of another at once; with ``new`` there must be none."""
        options = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename")
        how = self.spark.sparkContext._gateway.new_array(options, 1)
        how[0] = options.NONE if new else options.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf)
        try:
            context.rename(self._fs.makeQualified(self._path(old)), self._fs.makeQualified(self._path(name)), how)
        except Exception as problem:
            if new and self.exists(name):
                self.remove(old)
                raise Taken(f"{self.folder}/{name} is there already") from problem
            raise

    def joined(self, name: str, head: bytes, parts: str) -> None:
        """One file from a head and the part files of a folder, by name, passed on through a buffer."""
        part = f".{name}.{uuid.uuid4().hex}"
        out = self._out.create(self._path(part), False)
        out.write(head)
        for own in self.names(parts):
            if own.startswith("part-"):
                stream = self._fs.open(self._path(f"{parts}/{own}"))
                self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
                stream.close()
        out.close()
        self.rename(part, name)

    # ---- tables

    def has(self, table: str) -> bool:
        return self.exists(f"{table}.table")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/tables/{table}/{self.text(f'{table}.table')}")

    def write(self, table: str, rows: DataFrame, *by: str, new: bool = False) -> DataFrame:
        """A new version of a table, which may be made of the one before; partitioned ``by`` columns."""
        before = self.text(f"{table}.table") if self.has(table) else None
        if new and before:
            raise Taken(f"{self.folder} has {table} already")
        version = uuid.uuid4().hex
        rows.write.partitionBy(*by).parquet(f"{self.folder}/tables/{table}/{version}")
        self.put(f"{table}.table", version, new)
        for old in self.names(f"tables/{table}"):
            if old not in (version, before):
                self.remove(f"tables/{table}/{old}")
        return self.read(table)

    def drop(self, table: str) -> None:
        self.remove(f"{table}.table")
        self.remove(f"tables/{table}")

    # ---- tables that are filled part by part

    def open_part(self, table: str) -> str:
        """Where a table grows: a part of it (a value of its partition column) is there whole or not at all."""
        return f"{self.folder}/open/{table}"

    def fill(self, table: str, rows: DataFrame, by: str) -> None:
        """Writes the parts of which ``rows`` holds any, each in the place of what was in it."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(self.open_part(table))

    def filled(self, table: str, schema: str) -> DataFrame:
        """The parts so far; a table of the schema without rows where there are none."""
        if not any("=" in x for x in self.names(f"open/{table}")):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.open_part(table))


def scratch(spark: SparkSession) -> str:
    """A new folder that goes when the JVM ends, in ``spark.checkpoint.dir``, which all machines share.

    Where the session names none, it is a local one, which only a local master may use.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = "file://" + tempfile.gettempdir()
    store = Store(spark, f"{shared}/corvane-{uuid.uuid4().hex}")
    store.make()
    store._fs.deleteOnExit(store._root)
    return store.folder
