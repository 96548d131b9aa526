"""Checkpoints and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Parts in which a key that many rows have is met.
PARTS = 16


def _folder(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir (on a local master, any)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        own = spark.conf.get("spark.checkpoint.dir", None)
        if own is None and not sc.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(own or tempfile.mkdtemp(prefix="eventloom-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a checkpoint in the shared folder."""
    _folder(df.sparkSession)
    return df.checkpoint()


def saved(df: DataFrame) -> DataFrame:
    """df written as Parquet in the shared folder and read again: cut() for rounds.

    A checkpoint passes on the plan's estimates. A join's is the product of its sides', so over rounds its digits, and the
    driver's time and memory, would double each time; a file's estimate is its size.
    """
    path = f"{_folder(df.sparkSession)}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Deletes the files of saved() tables that nothing reads any more."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
            path = sc._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, component) of all ids in nodes(id): the least id that edges(a, b) reach.

    Labels spread along edges and then jump to the label of their label, so long chains take few rounds. A label that
    many ids share is looked up in PARTS parts, and so are the labels of ids with many edges, so that neither a hub nor
    a component that holds most ids is one task's work; messages to an id are a minimum, combined before the shuffle.
    """
    parts = F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")
    part_of = lambda c: F.pmod(F.xxhash64(c), F.lit(PARTS)).cast("int")
    both = saved(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct())
    labels = saved(nodes.select("id", F.col("id").alias("component")))
    while True:
        told = labels.select(F.col("id").alias("b"), "component", parts)
        near = both.withColumn("part", part_of("a")).join(told.hint("merge"), ["b", "part"]).groupBy(F.col("a").alias("id")).agg(F.min("component").alias("n"))
        low = labels.join(near, "id", "left").select("id", F.least("component", F.coalesce("n", "component")).alias("m"), "component")
        jump = low.select(F.col("id").alias("m"), F.col("m").alias("mm")).join(low.select("m").distinct(), "m").select("m", "mm", parts)
        new = saved(low.withColumn("part", part_of("id")).join(jump.hint("merge"), ["m", "part"]).select("id", F.least("m", "mm").alias("component"), (F.least("m", "mm") != F.col("component")).alias("moved")))
        discard(labels)
        labels = new.select("id", "component")
        if not new.filter("moved").limit(1).count():
            discard(both)
            return labels
