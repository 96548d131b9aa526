"""Sinks, state and the order of a run."""

from __future__ import annotations

import time
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import in_scope, is_past
from ..operators.graph import cut
from ..operators.upsert import upsert
from ..operators.validate import EVENT_SCHEMA, InvalidRecords, validate
from ..sources.readers import exists


def _move(spark: SparkSession, source: str, target: str) -> None:
    jvm = spark.sparkContext._jvm
    src, dst = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = src.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = jvm.org.apache.hadoop.fs.Path(f"{target}.old")
    fs.delete(old, True)
    if fs.exists(dst) and not fs.rename(dst, old) or not fs.rename(src, dst):
        raise OSError(f"cannot move {source} to {target}")
    fs.delete(old, True)


def save_events(events: DataFrame, path: str, schema: dict = EVENT_SCHEMA) -> None:
    """Replace the stored events by events(seq, payload) in seq order, if all are valid; else nothing is written.

    Written beside the old ones first and then moved, so that no reader finds a part of them.
    """
    events = cut(events)
    wrong = [f"{r['path']}: {r['message']}" for r in validate(events, schema).limit(20).collect()]
    if wrong:
        raise InvalidRecords("; ".join(wrong))
    events.orderBy("seq").select("payload").write.mode("overwrite").text(f"{path}.new")
    _move(events.sparkSession, f"{path}.new", path)


def append_seen(keys: DataFrame, path: str, namespace: str) -> None:
    """Add keys(key, ord) to the state of a namespace."""
    keys.select(F.lit(namespace).alias("namespace"), F.col("key"), F.col("ord").cast("long")).write.mode("append").parquet(path)


def record_run(spark: SparkSession, run: dict, path: str) -> None:
    """Add a run's metrics to the log, with the time at which they are recorded: what read_runs() orders by."""
    row = {k: None if v is None else str(v) for k, v in run.items()}
    kinds = ", ".join(f"{k} string" for k in run)
    spark.createDataFrame([row | {"recorded": time.time_ns()}], f"{kinds}, recorded long").coalesce(1).write.mode("append").json(path)


def log_errors(errors: DataFrame, path: str) -> None:
    """Add errors(context, error, details map<string,string>, and trace if there is one) to the dead letters; those of test flyers are left out."""
    quiet = F.exists(F.map_values(F.coalesce("details", F.create_map().cast("map<string,string>"))), lambda v: F.contains(v, F.lit("test-flyers")))
    errors = errors if "trace" in errors.columns else errors.withColumn("trace", F.lit(None).cast("string"))
    errors.filter(~F.coalesce(quiet, F.lit(False))).withColumn("ts", F.current_timestamp()).write.mode("append").parquet(path)


def archive(spark: SparkSession, path: str, target: str) -> str | None:
    """Move a stored table into a dated folder; None if there is none."""
    if not exists(spark, path):
        return None
    to = f"{target}/{datetime.now(timezone.utc):%Y%m%dT%H%M%S}"
    _move(spark, path, to)
    return to


def judged(extracted: DataFrame, today: date) -> DataFrame:
    """Extracted rows with status skipped where the title is out of scope or the event is past."""
    v = F.from_json("payload", "title string, dates struct<start:string,end:string>")
    skip = (F.col("status") == "ok") & (~in_scope(v["title"]) | is_past(v["dates"]["start"], v["dates"]["end"], today))
    return extracted.withColumn("status", F.when(skip, "skipped").otherwise(F.col("status")))


def run_upsert(stored: DataFrame, inputs: DataFrame, at: str, new_id: Callable[[], F.Column] = F.uuid) -> tuple[DataFrame, DataFrame]:
    """(events(seq, payload), outcomes(seq, outcome)) of stored(seq, payload) and judged inputs(seq, kind, payload, phash, flyer, status).

    Input seqs must follow the stored ones. No input: the stored events as they are.
    """
    names = ["seq", "kind", "payload", "phash", "flyer", "status", "new_id", "at"]
    old = stored.select("seq", F.lit("event").alias("kind"), "payload", *[F.lit(None).cast("string").alias(c) for c in ("phash", "flyer")], F.lit("ok").alias("status"), F.lit(None).cast("string").alias("new_id"), F.lit(at).alias("at"))
    if not inputs.limit(1).count():
        return stored.select("seq", "payload"), stored.select("seq", F.lit(None).cast("string").alias("outcome")).limit(0)
    new = inputs.withColumn("new_id", new_id()).withColumn("at", F.lit(at)).select(*names)
    out = cut(upsert(old.select(*names).unionByName(new)))
    return out.filter("payload is not null").select("seq", "payload"), out.filter("outcome is not null").select("seq", "outcome")


def run_items(items: list[dict], step: Callable[[dict], dict], save: Callable[[dict], None], *, only: str | None = None, pause: float = 1.0, sleep: Callable[[float], None] = time.sleep, clock: Callable[[], float] = time.perf_counter) -> list[dict]:
    """Run a step for each item whose name contains `only`, saving after each; a row of metrics an item."""
    out = []
    for item in items:
        if only and only.lower() not in item["name"].lower():
            continue
        start = clock()
        found = step(item)
        save(found)
        out.append({"name": item["name"], "elapsed_seconds": round(clock() - start, 2), **found})
        sleep(pause)
    return out
