"""What each kind of source collects: listings not met before, or images staged as files."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import aggregates as A
from ..operators.graph import cut
from ..sources import html as H
from ..sources.files import FileSink
from ..sources.paging import ListingSource
from ..sources.readers import fetch_all
from .runs import crawl_calendar, crawl_source

#: Titles of earlier runs that a pager is told beforehand; with more, it may read pages up to max_pages that are then left out.
TOLD_TITLES = 100_000


def _page(spark: SparkSession, url: str, headers: dict | None, **how: object) -> DataFrame:
    """(url, html) of one page; html is null if it can't be fetched."""
    got = fetch_all(spark.createDataFrame([(url,)], "url string"), headers=headers, **how)
    return cut(got.select("url", F.make_valid_utf8(F.col("content").cast("string")).alias("html")))


def racingjunk(spark: SparkSession, source: dict, seen: DataFrame, **how: object) -> DataFrame:
    """title, date_text, location_text, source_url, source of listings with titles not in seen(key), page after page.

    No page is fetched after one without new titles, max_pages, or a failure; page_delay_seconds lie between pages.
    """
    spark.dataSource.register(ListingSource)
    titles = seen.select(F.col("key").alias("title")).distinct()
    told = [r["title"] for r in titles.limit(TOLD_TITLES + 1).collect()]
    base = source.get("drag_racing_url") or source["url"]
    entry = {"source": source.get("name", base), "url": base, "strategy": "racingjunk", "max_pages": source.get("max_pages", 10), "page_delay": source.get("page_delay_seconds", 0.75), "headers": source.get("request_headers"), "seen": told if len(told) <= TOLD_TITLES else []}
    read = spark.read.format("listing_pages").option("listings", json.dumps([entry]))
    for k, v in how.items():
        read = read.option(k, v)
    pages = cut(read.load()).filter("html IS NOT NULL")
    spec = H.CARD_PAGES["racingjunk"]
    # Links are relative to the listing, not to one of its pages; the page stays beside its cards.
    numbered = pages.select(F.concat_ws("#", "page", F.lit(base)).alias("url"), "html")
    found = H.parse_pages(numbered, lambda u, h: H.cards(u.partition("#")[2], h, **spec), "ord int, title string, date_text string, location_text string, source_url string, source string")
    rows = found.select(F.substring_index("url", "#", 1).cast("int").alias("page"), F.lit(entry["source"]).alias("of"), "ord", "title", "date_text", "location_text", "source_url", "source")
    kept = A.take_pages(rows, source="of", seen=titles, max_pages=entry["max_pages"])
    return kept.orderBy("page", "ord").select("title", "date_text", "location_text", "source_url", "source")


def myracepass(spark: SparkSession, source: dict, seen: DataFrame, **how: object) -> DataFrame:
    """title, date_text, event_type_text, source_url, source of the page's listings with titles not in seen(key)."""
    spec = H.CARD_PAGES["myracepass"]
    page = _page(spark, source["url"], source.get("request_headers"), **how)
    rows = H.parse_pages(page, lambda u, h: H.cards(u, h, **spec), "ord int, title string, date_text string, event_type_text string, source_url string, source string")
    return A.unseen(rows, "title", "ord", seen.select(F.col("key").alias("title"))).orderBy("ord").select("title", "date_text", "event_type_text", "source_url", "source")


def rss(spark: SparkSession, source: dict, seen: DataFrame, **how: object) -> DataFrame:
    """title, published, summary, source_url, source of the feed's items with links not in seen(key); all items without a link are one."""
    rows = H.parse_pages(_page(spark, source["url"], source.get("request_headers"), **how), H.feed, H.COLUMNS["feed"])
    new = rows.join(seen.select(F.col("key").alias("source_url")), "source_url", "left_anti")
    return A.first_of(new.drop("url"), "source_url", "ord").orderBy("ord").select("title", "published", "summary", "source_url", F.lit(source["name"]).alias("source"))


def stage_images(urls: DataFrame, folder: str, there: DataFrame, *, headers: dict | None = None, **how: object) -> DataFrame:
    """(url, path, error) of each of urls(ord, url) whose file name is not in there(path): fetched with retries and added to a folder.

    error is null for those that became files: what is no image, or can't be fetched, has one. Of urls with one file name
    the first by ord counts. The files appear together when all are fetched.
    """
    spark = urls.sparkSession
    spark.dataSource.register(FileSink)
    named = A.first_of(urls.select("ord", "url", T.file_name_of(F.col("url")).alias("path")), "path", "ord").join(there.select("path"), "path", "left_anti")
    got = cut(fetch_all(named.select("url"), headers=headers, **how).join(named.select("url", "path"), "url"))
    kind = F.coalesce(F.contains("content_type", F.lit("image")), F.lit(False))
    error = F.when(F.col("error").isNotNull(), F.col("error")).when(~kind, F.concat(F.lit("no image: "), F.coalesce("content_type", F.lit(""))))
    got.filter(error.isNull()).select("path", "content").write.format("files").option("folder", folder).mode("append").save()
    return got.select("url", "path", error.alias("error"))


def bracketraces(spark: SparkSession, source: dict, seen: DataFrame, folder: str, there: DataFrame, **how: object) -> DataFrame:
    """(url, path, error) of the new images of a source's event pages, as stage_images() gives them; seen has their addresses as key.

    Pages are read at once, in as many tasks, so no delay lies between them; a page that can't be fetched has no images.
    """
    base, paths = source["url"], source.get("event_pages") or []
    pages = spark.createDataFrame([(k, base + p) for k, p in enumerate(paths)], "page int, url string")
    html = fetch_all(pages.select("url"), headers=source.get("request_headers"), **how).select("url", F.make_valid_utf8(F.col("content").cast("string")).alias("html"))
    images = H.parse_pages(html, lambda u, h: H.images(u, h, flyer_links=True), H.COLUMNS["images"]).join(F.broadcast(pages), "url")
    ranked = images.filter("href IS NOT NULL").select(F.col("href").alias("url"), (F.col("page").cast("long") * (1 << 32) + F.col("ord")).alias("ord"))
    new = A.unseen(ranked, "url", "ord", seen.select(F.col("key").alias("url")))
    return stage_images(cut(new), folder, there, headers=source.get("request_headers"), **how)


#: Namespaces of the state in which each strategy's keys are kept.
NAMESPACES = {"bracketraces": "seen_urls", "rss": "seen_urls", "racingjunk": "racingjunk_events", "myracepass": "myracepass_events", "tmccc": "tmccc_events"}


def collect(spark: SparkSession, source: dict, seen: DataFrame, folder: str, there: DataFrame, *, browse: Callable[[str], DataFrame] | None = None, warn: Callable[[str], None] = print, **how: object) -> tuple[str, DataFrame] | None:
    """(kind, rows) of what a source collects by its strategy, new with regard to seen(namespace, key): `images` as
    stage_images() gives them, else `listings`. None, with a warning, for an unknown strategy.

    browse gives the pages (page, url, html) of a calendar that needs a browser; without one a calendar has no pages.
    """
    keys = seen.filter(F.col("namespace") == NAMESPACES.get(source.get("strategy"), "")).select("key").distinct()
    none = lambda url: spark.createDataFrame([], "page int, url string, html string")
    listings = {n: ("listings", lambda s, f=f: f(spark, s, keys, **how)) for n, f in (("racingjunk", racingjunk), ("myracepass", myracepass), ("rss", rss))}
    known = listings | {
        "bracketraces": ("images", lambda s: bracketraces(spark, s, keys, folder, there, **how)),
        "tmccc": ("listings", lambda s: crawl_calendar((browse or none)(s["url"]), s, keys)),
    }
    return crawl_source(source, known, warn)
