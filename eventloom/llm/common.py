"""What the operators of this subpackage share: reading, checkpoints, grouping and components."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Whether shuffle files are removed at the end of the query that wrote them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; the path may be in any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; on a local master without one, a temporary folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        own = spark.conf.get("spark.checkpoint.dir", None)
        if own is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            own = tempfile.mkdtemp(prefix="eventloom-")
        sc.setCheckpointDir(own)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def saved(df: DataFrame) -> DataFrame:
    """df written as Parquet in the shared folder and read again: cut() for tables of which later steps read some columns.

    Shuffle files of the write go when it has ended, not when the driver happens to collect its garbage.
    """
    spark, path = df.sparkSession, f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4()}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes the files of saved() tables that nothing reads any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that start like the given ones and are not in df."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without columns of these names, whatever their case."""
    low = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in low])


_HELD: dict[object, object] = {}


def held(key: object, build: Callable[[], object]) -> object:
    """What build() makes, kept in this worker process until something else is held: one operator's tables at a time."""
    if key not in _HELD:
        _HELD.clear()
        gc.collect()
        _HELD[key] = build()
    return _HELD[key]


def let(x: Column, use: Callable[[Column], Column]) -> Column:
    """use(x), with x computed once."""
    return F.transform(F.array(x), use)[0]


def grouped(df: DataFrame, key: str, fn: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Deal df by key and call fn with runs of whole groups.

    fn gets an Arrow table sorted by key and the offsets at which its groups begin (with the end). Unlike
    applyInPandas it is called for many small groups at once. Callers bound the size of a group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        held = 0
        for b in batches:
            if not b.num_rows:
                continue
            rest.append(b)
            held += b.num_rows
            if held < 4096:
                continue
            t = pa.Table.from_batches(rest).combine_chunks()
            k = t[key].to_numpy()
            starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
            if len(starts) > 1:
                yield from fn(t.slice(0, starts[-1]), starts)
                t = t.slice(starts[-1])
            rest, held = t.to_batches(), t.num_rows
        if held:
            t = pa.Table.from_batches(rest).combine_chunks()
            k = t[key].to_numpy()
            yield from fn(t, np.r_[np.flatnonzero(np.r_[True, k[1:] != k[:-1]]), len(k)])

    return df.repartition(F.col(key)).sortWithinPartitions(key).mapInArrow(run, schema)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) of every id in edges, component the smallest id reachable.

    Each round sends every id's label to its neighbours; the messages to an id are a minimum that is combined before
    a round's shuffle of them. The links of one id lie in one task, which streams them and holds no group, but a hub of
    very many links makes that task long. After four rounds, labels also jump to the
    label of their label (a hub's label is looked up once, in parts), so that long chains end soon. edges: two
    long columns; self-links are allowed.
    """
    both = edges.select(F.col(a).alias("id"), F.col(b).alias("to")).union(edges.select(F.col(b).alias("id"), F.col(a).alias("to"))).distinct()
    # A checkpoint passes on estimates whose digits double with each round of joins; a file has its size.
    both = saved(both.repartition("id"))
    labels = saved(both.groupBy("id").agg(F.least("id", F.min("to")).alias("component")))
    turn = 0
    while True:
        turn += 1
        sent = both.join(labels, "id").groupBy(F.col("to").alias("id")).agg(F.min("component").alias("m_"))
        new = labels.join(sent, "id").select("id", F.least("component", "m_").alias("m_"), "component")
        if turn % 4 == 0:
            parts = F.explode(F.sequence(F.lit(0), F.lit(15))).alias("part_")
            roots = new.select(F.col("id").alias("m_"), F.col("m_").alias("mm_")).join(new.select("m_").distinct(), "m_").select("m_", "mm_", parts)
            new = new.withColumn("part_", F.pmod(F.xxhash64("id"), F.lit(16)).cast("int")).join(roots, ["m_", "part_"]).select("id", F.least("m_", "mm_").alias("m_"), "component")
        new = saved(new.select("id", F.col("m_").alias("component"), (F.col("m_") != F.col("component")).alias("moved_")))
        discard(labels)
        labels = new.select("id", "component")
        if not new.filter("moved_").limit(1).count():
            discard(both)
            return labels
