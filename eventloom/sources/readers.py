"""Readers of stored records and state, and a fetching source."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions import fixed
from ..functions.text import suffix

EVENT = (
    "id string, title string, event_type string, series string, track struct<id:string,name:string,city:string,state:string>, dates struct<start:string,end:string>,"
    " times struct<gates_open:string,registration_opens:string,race_start:string>, classes array<string>, fees struct<entry:string,spectator:string>,"
    " contact struct<phone:string,email:string,website:string>, confidence double, unclear_fields array<string>, notes string,"
    " flyers array<struct<file:string,phash:string,processed_at:string>>, created_at string, updated_at string"
)
SEEN = "namespace string, key string, ord long"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Stored events; none if the path does not exist.

    A file is a JSON array (or one object) if its first line that is not blank is `[`, or begins with `[` or is no
    whole object; else it holds an event a line. Lines are split over tasks; an array is read by one task, as it is one value.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], EVENT)
    first = spark.read.text(path).filter(F.trim("value") != "").limit(1).collect()
    whole = bool(first) and not _is_object(first[0]["value"])
    return spark.read.schema(EVENT).option("multiLine", whole).json(path)


def _is_object(line: str) -> bool:
    try:
        return isinstance(json.loads(line), dict)
    except json.JSONDecodeError:
        return False


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    """State of earlier runs: keys by namespace; none if the path does not exist."""
    return spark.read.schema(SEEN).parquet(path) if exists(spark, path) else spark.createDataFrame([], SEEN)


def read_runs(spark: SparkSession, path: str, schema: str = "run_id string, started_at string, finished_at string, status string, elapsed_seconds string") -> DataFrame:
    """Run metrics of a JSON Lines log, with `ord`, their order; blank lines are skipped, malformed ones fail.

    Runs are ordered by the `recorded` nanoseconds that record_run() writes, those without it by started_at before
    them; run_id breaks ties. The log has a line a run, so numbering it takes one task.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], f"ord long, {schema}")
    lines = spark.read.text(path).filter(F.trim("value") != "")
    runs = lines.select(F.from_json("value", f"{schema}, recorded long", {"mode": "FAILFAST"}).alias("v")).select("v.*")
    keys = [F.col(c).asc_nulls_first() for c in ("recorded", "started_at", "run_id") if c in runs.columns]
    return runs.select((F.row_number().over(W.orderBy(*keys)) - 1).cast("long").alias("ord"), *[c for c in runs.columns if c != "recorded"])


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Staged images in path order: path, content, length."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.filter(suffix(F.col("path")).isin(fixed.STAGED_IMAGES)).select("path", "content", "length").orderBy("path")


def read_config(path: str, check: Callable[[object], list[dict]]) -> list[dict]:
    """Checked entries of a configuration file on the driver."""
    try:
        return check(json.loads(Path(path).read_text()))
    except json.JSONDecodeError as e:
        raise ValueError(f"Invalid JSON in {path}: {e.msg}") from e


def with_retries(operation: Callable[[], Any], *, attempts: int = 3, delay: float = 1.0, sleep: Callable[[float], None] = time.sleep, again: Callable[[Exception], bool] = lambda e: True) -> tuple[Any, Exception | None, int, float]:
    """Result, last error, attempts made and seconds slept; the pause doubles after each failure."""
    slept = 0.0
    for n in range(1, attempts + 1):
        try:
            return operation(), None, n, slept
        except Exception as e:  # noqa: BLE001 - what the operation raises is the result
            if n == attempts or not again(e):
                return None, e, n, slept
            pause = round(delay * 2 ** (n - 1), 2)
            slept += pause
            sleep(pause)
    raise ValueError("attempts must be positive")


def get_url(url: str, headers: dict[str, str], timeout: float) -> tuple[bytes, str]:
    """Body and content type of an address."""
    from urllib.request import Request, urlopen

    with urlopen(Request(url, headers=headers), timeout=timeout) as r:
        return r.read(), r.headers.get("content-type", "")


FETCHED = "url string, content binary, content_type string, error string, attempts int, slept_seconds double"


def fetch_all(urls: DataFrame, *, headers: dict[str, str] | None = None, attempts: int = 3, delay: float = 1.0, timeout: float = 15, tasks: int = 32) -> DataFrame:
    """FETCHED of each row of urls(url), in up to `tasks` tasks, with retries; what can't be fetched has an error and no content."""
    heads = dict(headers or {})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in FETCHED.split(", ")]
        for f in frames:
            for url in f["url"]:
                got, error, n, slept = with_retries(lambda: get_url(url, heads, timeout), attempts=attempts, delay=delay)  # noqa: B023
                body, kind = got or (None, None)
                yield pd.DataFrame([(url, body, kind, None if error is None else f"{type(error).__name__}: {error}", n, slept)], columns=names)

    return urls.select("url").repartition(tasks).mapInPandas(run, FETCHED)


class Page(InputPartition):
    def __init__(self, url: str) -> None:
        self.url = url


class FetchReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.urls = json.loads(options.get("urls", "[]"))
        self.headers = json.loads(options.get("headers", "{}"))
        self.attempts, self.delay, self.timeout = int(options.get("attempts", 3)), float(options.get("delay", 1.0)), float(options.get("timeout", 15))

    def partitions(self) -> list[Page]:
        return [Page(u) for u in self.urls]

    def read(self, partition: Page) -> Iterator[tuple]:
        got, error, n, slept = with_retries(lambda: get_url(partition.url, self.headers, self.timeout), attempts=self.attempts, delay=self.delay)
        body, kind = got or (None, None)
        yield partition.url, body, kind, None if error is None else f"{type(error).__name__}: {error}", n, slept


class FetchSource(DataSource):
    """spark.read.format("fetch").option("urls", <JSON list>): one partition a URL, with retries.

    Gives url, content, content_type, error (null if it went well), attempts, slept_seconds; images are those whose
    content_type contains `image`. The attempts columns feed operators.aggregates.retry_telemetry().
    """

    @classmethod
    def name(cls) -> str:
        return "fetch"

    def schema(self) -> str:
        return FETCHED

    def reader(self, schema: Any) -> FetchReader:
        return FetchReader(dict(self.options))
