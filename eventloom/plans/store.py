"""Stored events as snapshots: a version becomes the current one by one exclusive create."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.validate import EVENT_SCHEMA, InvalidRecords, validate
from ..sources.readers import EVENT

STORED = "seq long, payload string"


class Conflict(RuntimeError):
    """Another writer has committed since the version that this one began with."""


class EventStore:
    """A folder of snapshots (seq, payload) and numbered version files, each of which names one.

    Readers take the highest version that names a snapshot, and keep reading it whatever is committed meanwhile.
    A writer writes its snapshot first and then creates the next version's file, which fails if it is there: of two
    that began with one version the second has a Conflict, and reads and applies its inputs again. A file system whose
    create is exclusive (HDFS is) makes this safe between machines. A writer that dies leaves a snapshot that no version
    names, or a version file that names none, which readers pass over.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._fs = self._at(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, path: str) -> object:
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _numbers(self) -> list[int]:
        folder = self._at(f"{self.path}/versions")
        return sorted(int(s.getPath().getName()) for s in self._fs.listStatus(folder)) if self._fs.exists(folder) else []

    def _named(self, version: int) -> str:
        stream = self._fs.open(self._at(f"{self.path}/versions/{version:012d}"))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def current(self) -> tuple[int, str | None]:
        """The number of the last version, whether or not it names a snapshot, and the folder of the current snapshot."""
        numbers = self._numbers()
        for n in reversed(numbers):
            if name := self._named(n):
                return numbers[-1], f"{self.path}/snapshots/{name}"
        return numbers[-1] if numbers else 0, None

    def read(self) -> tuple[int, DataFrame]:
        """A version's number, for commit(), and its events(seq, payload)."""
        version, folder = self.current()
        return version, self.spark.read.schema(STORED).parquet(folder) if folder else self.spark.createDataFrame([], STORED)

    def events(self) -> DataFrame:
        """The current events as columns."""
        return self.read()[1].select(F.from_json("payload", EVENT).alias("e")).select("e.*")

    def commit(self, events: DataFrame, base: int, schema: dict = EVENT_SCHEMA) -> int:
        """Make events(seq, payload) the version after `base`, if all are valid; its number."""
        name = uuid.uuid4().hex
        folder = f"{self.path}/snapshots/{name}"
        events.select("seq", "payload").write.parquet(folder)
        try:
            wrong = [f"{r['path']}: {r['message']}" for r in validate(self.spark.read.schema(STORED).parquet(folder), schema).limit(20).collect()]
            if wrong:
                raise InvalidRecords("; ".join(wrong))
            if self.current()[0] != base:
                raise Conflict(f"version {base} is not the last one")
            try:
                out = self._fs.create(self._at(f"{self.path}/versions/{base + 1:012d}"), False)
            except Py4JJavaError as e:
                if "FileAlreadyExists" in str(e):
                    raise Conflict(f"version {base + 1} has been committed") from e
                raise
            out.write(name.encode())
            out.close()
        except BaseException:
            self._fs.delete(self._at(folder), True)
            raise
        return base + 1

    def vacuum(self, keep: int = 3) -> list[int]:
        """Delete the snapshots of all versions but the last `keep`, whose readers should be done; the versions that lost theirs."""
        gone, current = [], self.current()[1]
        for n in self._numbers()[:-keep]:
            if (name := self._named(n)) and f"{self.path}/snapshots/{name}" != current and self._fs.delete(self._at(f"{self.path}/snapshots/{name}"), True):
                gone.append(n)
        return gone
