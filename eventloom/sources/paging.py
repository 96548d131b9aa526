"""A source that pages through listings and fetches no page beyond the one at which paging ends."""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from typing import Any

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .html import CARD_PAGES, cards
from .readers import get_url, with_retries


class Listing(InputPartition):
    def __init__(self, entry: dict) -> None:
        self.entry = entry


class ListingReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.entries = json.loads(options.get("listings", "[]"))
        self.attempts, self.timeout = int(options.get("attempts", 3)), float(options.get("timeout", 15))
        self.retry_delay = float(options.get("delay", 1.0))

    def partitions(self) -> list[Listing]:
        return [Listing(e) for e in self.entries]

    def read(self, partition: Listing) -> Iterator[tuple]:
        e = partition.entry
        met = set(e.get("seen") or ())
        for page in range(1, int(e.get("max_pages", 10)) + 1):
            url = f"{e['url']}?page={page}"
            got, error, attempts, slept = with_retries(lambda: get_url(url, e.get("headers") or {}, self.timeout), attempts=self.attempts, delay=self.retry_delay)  # noqa: B023
            html = got[0].decode("utf-8", "replace") if got else None
            yield e["source"], page, url, html, None if error is None else f"{type(error).__name__}: {error}", attempts, slept
            titles = {c["title"] for c in cards(e["url"], html, **CARD_PAGES[e["strategy"]])} - {""} - met if html is not None else set()
            if not titles:
                return
            met |= titles
            time.sleep(float(e.get("page_delay", 0)))


class ListingSource(DataSource):
    """spark.read.format("listing_pages").option("listings", <JSON list>): one partition a listing.

    A listing has source, url, strategy (a key of CARD_PAGES) and may have max_pages, page_delay (seconds), headers
    and seen (titles of earlier runs). Pages url?page=1, 2, ... are read until one can't be fetched or has no title that is
    new, and that page is the last row. Gives source, page, url, html (null if it failed), error, attempts, slept_seconds.
    """

    @classmethod
    def name(cls) -> str:
        return "listing_pages"

    def schema(self) -> str:
        return "source string, page int, url string, html string, error string, attempts int, slept_seconds double"

    def reader(self, schema: Any) -> ListingReader:
        return ListingReader(dict(self.options))
