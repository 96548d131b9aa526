"""Parts of a run: what it covers, its record and report, the folder sync, crawled pages and sources, staged files."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator
from pathlib import Path
from urllib.parse import parse_qs, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from ..operators import aggregates as A
from ..operators.graph import cut
from ..sources import html as H
from ..sources.files import FileSink
from ..sources.readers import exists, fetch_all, read_runs
from .workflow import _move, archive, record_run

#: Fetches pages: a list of URLs to (url, html); what could not be fetched has a null html.
Fetch = Callable[[list[str]], DataFrame]


class ConfigError(ValueError):
    """A configuration that cannot be used."""


def selection(*, tracks: bool = False, sources: bool = False, track: str | None = None, source: str | None = None) -> tuple[bool, bool]:
    """Whether tracks and whether sources are run: a flag or a name of the one leaves the other out; both flags leave nothing."""
    return not sources and source is None, not tracks and track is None


def record_and_summarise(spark: SparkSession, run: dict, log: str, summary: str) -> DataFrame:
    """Add a run to the log and replace the summary of all runs; the summary."""
    record_run(spark, run, log)
    out = cut(A.run_summary(read_runs(spark, log)))
    out.coalesce(1).write.mode("overwrite").json(summary)
    return out


def report(runs: DataFrame) -> DataFrame:
    """(ord, line) of a report of runs (ord, status, started_at, elapsed_seconds); one line if there are none."""
    s = A.run_summary(runs)
    last = runs.agg(F.max_by(F.struct("status", "started_at", "elapsed_seconds"), "ord").alias("last"))
    s = s.crossJoin(last)  # one row each
    took = lambda c: T.duration(F.coalesce(F.col(c).try_cast("double"), F.lit(0.0)))
    times = [("average", "average_seconds"), ("median", "median_seconds"), ("min", "min_seconds"), ("max", "max_seconds"), ("p95", "p95_seconds")]
    lines = [
        F.lit("Crawl metrics summary"), F.concat(F.lit("  recorded runs:   "), "recorded_runs"), F.concat(F.lit("  successful runs: "), "successful_runs"),
        *[F.when(F.col(c).isNotNull(), F.concat(F.lit(f"  {f'{n} runtime:':<16} "), took(c))) for n, c in times],
        F.concat(F.lit("  last run:        "), F.coalesce("last.status", F.lit("unknown")), F.lit(" at "), F.coalesce("last.started_at", F.lit("?")), F.lit(" ("), took("last.elapsed_seconds"), F.lit(")")),
    ]
    none = F.array(F.lit("No crawl metrics recorded yet."))
    every = F.when(F.col("recorded_runs") == 0, none).otherwise(F.filter(F.array(*lines), lambda x: x.isNotNull()))
    return s.select(F.posexplode(every).alias("ord", "line"))


# Folder sync


def check_sync_config(config: object, hosts: tuple[str, ...] = fixed.FOLDER_HOSTS) -> dict:
    """A folder configuration with an id in its URL, which must be of one of the hosts."""
    if not isinstance(config, dict):
        raise ConfigError("the folder configuration must be an object")
    url = config.get("google_drive_folder_url")
    if not isinstance(url, str) or not url.strip():
        raise ConfigError("google_drive_folder_url is not configured")
    parts = urlparse(url)
    if parts.netloc.lower() not in hosts:
        raise ConfigError(f"google_drive_folder_url must be of {' or '.join(hosts)}")
    after = parts.path.partition("/folders/")[2].partition("/")[0]
    if not after and not parse_qs(parts.query).get("id"):
        raise ConfigError("google_drive_folder_url has no folder id")
    return config


def read_sync_config(path: str, env: str = "EVENTLOOM_FOLDER_URL") -> dict:
    """The checked folder configuration of a file; an environment variable's URL comes before the file's."""
    try:
        config = json.loads(Path(path).read_text())
    except FileNotFoundError as e:
        raise ConfigError(f"missing folder configuration: {path}") from e
    except json.JSONDecodeError as e:
        raise ConfigError(f"invalid JSON in {path}: {e.msg}") from e
    if os.environ.get(env) and isinstance(config, dict):
        config["google_drive_folder_url"] = os.environ[env]
    return check_sync_config(config)


def read_sync_state(spark: SparkSession, path: str) -> DataFrame:
    """file_id of the files of earlier syncs; none if the state is missing or of another shape."""
    if not exists(spark, path):
        return spark.createDataFrame([], "file_id string")
    whole = spark.read.text(path, wholetext=True).agg(F.first("value").alias("v"))
    ids = F.from_json("v", "downloaded_drive_file_ids array<string>")["downloaded_drive_file_ids"]
    # A value of another kind would be read as its text.
    raw = F.from_json(F.get_json_object("v", "$.downloaded_drive_file_ids"), "array<variant>")
    right = F.forall(raw, lambda x: F.coalesce(F.schema_of_variant(x) == "STRING", F.lit(False)))
    return whole.filter(F.coalesce(right, F.lit(False))).select(F.explode(ids).alias("file_id"))


def save_sync_state(ids: DataFrame, path: str) -> None:
    """Replace the state by the sorted, distinct file_id of ids."""
    state = ids.select("file_id").distinct().agg(F.to_json(F.struct(F.array_sort(F.collect_list("file_id")).alias("downloaded_drive_file_ids"))).alias("value"))
    state.coalesce(1).write.mode("overwrite").text(f"{path}.new")
    _move(ids.sparkSession, f"{path}.new", path)


def sync_folder(listing: DataFrame, state: str, staged: str, download: Callable[[DataFrame], DataFrame]) -> dict[str, int]:
    """Stage the new images of a folder's pages (url, html), save their ids, and count what became of the entries.

    download maps (file_id, path) to (file_id, path, content). Contents are rows of the table `staged`; the state is saved
    after them, so a failed download leaves both as they were for the next run; what is staged is known, so a run that
    ended between the two stages nothing twice.
    """
    spark = listing.sparkSession
    entries = H.parse_pages(listing, H.folder, H.COLUMNS["folder"]).select("ord", "file_id", "title")
    known = read_sync_state(spark, state)
    if exists(spark, staged):  # staged by a run that ended before it saved its state
        known = known.union(spark.read.parquet(staged).select("file_id")).distinct()
    there = spark.read.parquet(staged).select(F.col("path").alias("title")) if exists(spark, staged) else spark.createDataFrame([], "title string")
    plan = cut(A.sync_plan(entries, known, there, fixed.STAGED_IMAGES))
    new = plan.filter("action = 'downloaded'").select("file_id", "path")
    download(new).select("file_id", "path", "content").write.mode("append").parquet(staged)
    save_sync_state(known.union(new.select("file_id")), state)
    counts = {r["action"]: r["count"] for r in plan.groupBy("action").count().collect()}
    return {"listed": sum(counts.values())} | {a: counts.get(a, 0) for a in ("downloaded", "skipped_known", "skipped_non_image")}


def sync_files(spark: SparkSession, url: str, state: str, folder: str, *, view: str = fixed.FOLDER_VIEW, download: str = fixed.FILE_DOWNLOAD, **how: object) -> dict[str, int]:
    """Download the new images of a shared folder as files of a local or mounted folder; counts as sync_folder() gives them.

    The folder's page and the files are fetched with retries (options of fetch_all()); if one can't be, no file is
    added, the state stays, and OSError tells which. Files appear together, then the state is saved; a run that ended
    between the two finds its files under their names and adds none twice under another.
    """
    spark.dataSource.register(FileSink)
    page = cut(fetch_all(spark.createDataFrame([(view.format(folder_id=folder_id(url)),)], "url string"), **how))
    _raise_failed(page)
    html = page.select("url", F.make_valid_utf8(F.col("content").cast("string")).alias("html"))
    entries = H.parse_pages(html, H.folder, H.COLUMNS["folder"]).select("ord", "file_id", "title")
    known = read_sync_state(spark, state)
    there = spark.createDataFrame([], "title string")
    if exists(spark, folder):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        there = files.select(F.substring_index(F.url_decode(F.col("path")), "/", -1).alias("title"))
    plan = cut(A.sync_plan(entries, known, there, fixed.STAGED_IMAGES))
    new = plan.filter("action = 'downloaded'").select("file_id", "path", F.replace(F.lit(download), F.lit("{file_id}"), F.col("file_id")).alias("url"))
    got = cut(fetch_all(new.select("url"), **how))
    _raise_failed(got)
    got.join(new, "url").select("path", "content").write.format("files").option("folder", folder).mode("append").save()
    save_sync_state(known.union(new.select("file_id")), state)
    counts = {r["action"]: r["count"] for r in plan.groupBy("action").count().collect()}
    return {"listed": sum(counts.values())} | {a: counts.get(a, 0) for a in ("downloaded", "skipped_known", "skipped_non_image")}


def folder_id(url: str) -> str:
    """The id in the address of a shared folder; ConfigError without one."""
    parts = urlparse(url)
    check_sync_config({"google_drive_folder_url": url})
    return parts.path.partition("/folders/")[2].partition("/")[0] or parse_qs(parts.query)["id"][0]


def _raise_failed(fetched: DataFrame) -> None:
    wrong = fetched.filter("error IS NOT NULL").select("url", "error").limit(5).collect()
    if wrong:
        raise OSError("; ".join(f"{r['url']}: {r['error']}" for r in wrong))


# Crawling


def new_images(fetched: DataFrame, staged: DataFrame) -> DataFrame:
    """path, content of fetched(url, body, content_type) that are images and whose file name is not staged(path) yet."""
    images = fetched.filter(F.contains(F.coalesce("content_type", F.lit("")), F.lit("image")) & F.col("body").isNotNull())
    named = images.select(T.file_name_of(F.col("url")).alias("path"), F.col("body").alias("content")).dropDuplicates(["path"])
    return named.join(staged.select("path"), "path", "left_anti")


def crawl_track(spark: SparkSession, home: str, fetch: Fetch, seen: DataFrame, *, most: int = fixed.PAGES_PER_TRACK) -> DataFrame:
    """(ord, href) of a track's images not in seen(key): of its home page and of the first event pages that it links to.

    No home page: no images. Images keep the order of their pages and come once.
    """
    first = cut(fetch([home]).filter("html is not null"))
    links = H.parse_pages(first, H.links, H.COLUMNS["links"])
    same = T.url_host(F.col("url")) == T.url_host(F.col("href"))
    more = A.first_of(links.filter(same & (F.col("href") != home) & T.is_event_page(F.col("href"), F.col("text"))), "href", "ord")
    pages = [r["href"] for r in more.orderBy("ord").limit(most - 1).collect()]  # a few URLs
    order = spark.createDataFrame([(n, u) for n, u in enumerate([home, *pages])], "page int, at string")
    every = first.unionByName(fetch(pages).filter("html is not null")) if pages else first
    found = H.parse_pages(every, H.images, H.COLUMNS["images"]).join(F.broadcast(order), F.col("url") == F.col("at"))
    ranked = found.select("href", (F.col("page").cast("long") * (1 << 32) + F.col("ord")).alias("ord"))
    return A.unseen(ranked, "href", "ord", seen.select(F.col("key").alias("href"))).select("ord", "href")


def first_pages(cards: DataFrame, *, page: str = "page", order: str = "ord", key: str = "key") -> DataFrame:
    """Cards of the pages whose keys, in order, no earlier page has; pages without keys are left out.

    A page's keys are few; pages are compared by a digest of them.
    """
    keys = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(key).alias("k")))), lambda x: x["k"])
    pages = cards.filter(F.col(key).isNotNull()).groupBy(F.col(page).alias("page_")).agg(F.sha2(F.to_json(keys).cast("binary"), 256).alias("signature_"))
    kept = pages.groupBy("signature_").agg(F.min("page_").alias("page_")).select("page_")
    return cards.join(kept, cards[page] == kept["page_"], "left_semi")


def calendar_pages(browser: object, url: str) -> Iterator[tuple[int, str]]:
    """(page number, html) of a calendar that a browser pages through.

    The browser is an adapter with open(url), html(), and forward(last_key), which shows the next page and tells whether
    there was one: not if the button is missing, hidden or disabled, or if nothing new shows in time.
    """
    browser.open(url)
    number = 0
    while True:
        html = browser.html()
        yield number, html
        keys = [f"{c['title']}|{c['date_text']}" for c in H.calendar(url, html)]
        try:
            if not browser.forward(keys[-1] if keys else ""):
                return
        except TimeoutError:
            return
        number += 1


def crawl_source(source: dict, strategies: dict[str, tuple[str, Callable[[dict], DataFrame]]], warn: Callable[[str], None] = print) -> tuple[str, DataFrame] | None:
    """(kind, rows) of what a source's strategy collects: kind `images` or `listings`. None, with a warning, if there is no such strategy."""
    name = source.get("strategy")
    if not isinstance(name, str) or name not in strategies:
        warn(f"unknown strategy {name!r} of {source.get('name')!r}")
        return None
    kind, collect = strategies[name]
    return kind, collect(source)


def crawl_calendar(pages: DataFrame, source: dict, seen: DataFrame) -> DataFrame:
    """New listings of a calendar's pages (page, url, html): cards of one key on a page are one, each field the first
    that is not empty; pages shown twice count once; then cards not in seen(key)."""
    numbered = pages.select(F.concat_ws("#", "page", "url").alias("url"), "html", "page")
    cards = H.parse_pages(numbered, H.calendar, H.COLUMNS["calendar"]).withColumn("page", F.substring_index("url", "#", 1).cast("int"))
    cards = cards.withColumn("key", F.concat_ws("|", "title", "date_text"))
    cards = A.first_truthy(cards, ["page", "key"], ["title", "date_text", "time_text", "location_text", "description"], "ord")
    kept = first_pages(cards).withColumn("at", F.col("page").cast("long") * (1 << 32) + F.col("ord"))
    return A.unseen(kept, "key", "at", seen).select("at", "key", "title", "date_text", "time_text", "location_text", "description", F.lit(source["url"]).alias("source_url"), F.lit(source["name"]).alias("source"))


# Files


def remove_staged(spark: SparkSession, paths: list[str], keep: str = "test-flyers") -> list[str]:
    """Delete staged files that are done with, but for those whose path holds `keep`; what is gone."""
    gone = []
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if keep not in path and p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, False):
            gone.append(path)
    return gone


def migrate(spark: SparkSession, old: str, new: str) -> bool:
    """Move a table or file of an old layout to its new place, if it is there and nothing is in the new one."""
    if not exists(spark, old) or exists(spark, new):
        return False
    _move(spark, old, new)
    return True


def reset(spark: SparkSession, events: str, seen: str, target: str) -> list[str]:
    """Archive the stored events and state under target, and begin again with empty ones; where the old ones went."""
    moved = [to for n, path in (("events", events), ("seen", seen)) if (to := archive(spark, path, f"{target}/{n}"))]
    spark.createDataFrame([], "value string").write.mode("overwrite").text(events)
    spark.createDataFrame([], "namespace string, key string, ord long").write.mode("overwrite").parquet(seen)
    return moved


def full_run(steps: list[tuple[str, Callable[[], object]]], record: Callable[[dict], None], clock: Callable[[], float]) -> dict[str, object]:
    """Run steps (sync, crawl, process, validate) in order; the run is recorded whether or not one fails, and its error raised again."""
    start, out, status = clock(), {}, "failed"
    try:
        for name, step in steps:
            out[name] = step()
        status = "success"
        return out
    finally:
        record({"status": status, "elapsed_seconds": round(clock() - start, 2), "steps": ",".join(out)})
