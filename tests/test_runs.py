from __future__ import annotations

import json

import pytest

from eventloom.plans import runs as R
from eventloom.sources.readers import read_events, read_seen


def pages_of(spark, table):
    return lambda urls: spark.createDataFrame([(u, table.get(u)) for u in urls], "url string, html string")


@pytest.mark.parametrize("args, want", [({}, (True, True)), ({"tracks": True}, (True, False)), ({"source": "x"}, (False, True)), ({"track": "x"}, (True, False)), ({"tracks": True, "sources": True}, (False, False))])
def test_selection(args, want):
    assert R.selection(**args) == want


def test_report(spark, tmp_path):
    log, summary = str(tmp_path / "log"), str(tmp_path / "summary")
    for n, (status, s) in enumerate([("success", 60.0), ("error", 5), ("success", 3661)]):
        out = R.record_and_summarise(spark, {"run_id": str(n), "started_at": f"t{n}", "finished_at": None, "status": status, "elapsed_seconds": s}, log, summary)
    assert out.first()["successful_runs"] == 2 and spark.read.json(summary).first()["recorded_runs"] == 3
    lines = [r["line"] for r in R.report(R.read_runs(spark, log)).orderBy("ord").collect()]
    assert lines[1:3] == ["  recorded runs:   3", "  successful runs: 2"] and lines[-1] == "  last run:        success at t2 (1h 1m 1s)"
    assert "  max runtime:     1h 1m 1s" in lines and "  average runtime: 31m 0s" in lines
    assert [r["line"] for r in R.report(R.read_runs(spark, str(tmp_path / "none"))).collect()] == ["No crawl metrics recorded yet."]


def test_sync_configuration(tmp_path, monkeypatch):
    path = tmp_path / "c.json"
    with pytest.raises(R.ConfigError, match="missing"):
        R.read_sync_config(str(path))
    for text, said in [("{", "invalid JSON"), ("[]", "object"), ("{}", "not configured"), ('{"google_drive_folder_url": "https://x.example/folders/a"}', "must be of"), ('{"google_drive_folder_url": "https://drive.google.com/"}', "no folder id")]:
        path.write_text(text)
        with pytest.raises(R.ConfigError, match=said):
            R.read_sync_config(str(path))
    monkeypatch.setenv("EVENTLOOM_FOLDER_URL", "https://drive.google.com/drive/folders/A-1")
    path.write_text("{}")
    assert R.read_sync_config(str(path))["google_drive_folder_url"].endswith("A-1")


@pytest.mark.parametrize("text, want", [('{"downloaded_drive_file_ids": ["b", "a"]}', {"a", "b"}), ('{"downloaded_drive_file_ids": [1]}', set()), ('{"downloaded_drive_file_ids": "a"}', set()), ("[]", set()), ("{}", set())])
def test_sync_state_of_any_shape(spark, tmp_path, text, want):
    (tmp_path / "s.json").write_text(text)
    assert {r["file_id"] for r in R.read_sync_state(spark, str(tmp_path / "s.json")).collect()} == want
    assert R.read_sync_state(spark, str(tmp_path / "none")).count() == 0


def test_sync_folder(spark, tmp_path):
    entry = lambda i, t: f'<div class="flip-entry" id="entry-{i}"><a href="v{i}"><div class="flip-entry-title">{t}</div></a></div>'
    state, staged = str(tmp_path / "state"), str(tmp_path / "staged")
    download = lambda new: new.selectExpr("file_id", "path", "cast(concat('bytes of ', file_id) as binary) as content")
    page = spark.createDataFrame([("u", "".join([entry("F1", "a.jpg"), entry("F2", "a.jpg"), entry("F3", "x.pdf")]))], "url string, html string")
    assert R.sync_folder(page, state, staged, download) == {"listed": 3, "downloaded": 2, "skipped_known": 0, "skipped_non_image": 1}
    assert {r["path"] for r in spark.read.parquet(staged).collect()} == {"a.jpg", "a-F2.jpg"}
    assert R.sync_folder(page, state, staged, download) == {"listed": 3, "downloaded": 0, "skipped_known": 2, "skipped_non_image": 1}
    assert json.loads(spark.read.text(state).first()["value"]) == {"downloaded_drive_file_ids": ["F1", "F2"]}

    def broken(new):
        raise OSError("no network")

    more = spark.createDataFrame([("u", entry("F9", "z.png"))], "url string, html string")
    with pytest.raises(OSError):
        R.sync_folder(more, state, staged, broken)
    assert {r["file_id"] for r in R.read_sync_state(spark, state).collect()} == {"F1", "F2"}


def test_crawl_track(spark):
    image = lambda n: f'<img src="/i/{n}.jpg" width="500" height="500">'
    site = {"https://t.example/": image("a") + '<a href="/events">Events</a><a href="/about">About</a><a href="https://o.example/race">Race</a><a href="/events">again</a>', "https://t.example/events": image("b") + image("a"), "https://t.example/about": image("c")}
    seen = spark.createDataFrame([("https://t.example/i/z.jpg",)], "key string")
    got = [r["href"] for r in R.crawl_track(spark, "https://t.example/", pages_of(spark, site), seen).orderBy("ord").collect()]
    assert got == ["https://t.example/i/a.jpg", "https://t.example/i/b.jpg"]
    assert R.crawl_track(spark, "https://gone.example/", pages_of(spark, site), seen).count() == 0


CARD = '<div data-aid="CALENDAR_SMALLER_SCREEN_CONTAINER"><div data-aid="CALENDAR_EVENT_TITLE">%s</div><div data-aid="CALENDAR_EVENT_DATE">%s</div></div>'


class Browser:
    def __init__(self, pages, fails=False):
        self.pages, self.at, self.fails = pages, 0, fails

    def open(self, url):
        self.at = 0

    def html(self):
        return self.pages[self.at]

    def forward(self, last):
        if self.fails:
            raise TimeoutError
        self.at += 1
        return self.at < len(self.pages)


def test_calendar(spark):
    shown = [CARD % ("A", "May 1") + CARD % ("B", "May 2"), CARD % ("A", "May 1") + CARD % ("B", "May 2"), "", CARD % ("C", "May 3") + CARD % ("A", "May 1")]
    pages = list(R.calendar_pages(Browser(shown), "u"))
    assert [n for n, _ in pages] == [0, 1, 2, 3] and len(list(R.calendar_pages(Browser(shown, fails=True), "u"))) == 1
    df = spark.createDataFrame([(n, "u", h) for n, h in pages], "page int, url string, html string")
    got = R.crawl_calendar(df, {"url": "u", "name": "Calendar"}, spark.createDataFrame([("B|May 2",)], "key string")).orderBy("at").collect()
    assert [(r["title"], r["source"]) for r in got] == [("A", "Calendar"), ("C", "Calendar")]


def test_strategies(spark):
    said = []
    known = {"cards": ("listings", lambda s: spark.range(2))}
    kind, rows = R.crawl_source({"name": "n", "strategy": "cards"}, known)
    assert kind == "listings" and rows.count() == 2
    assert R.crawl_source({"name": "n", "strategy": 3}, known, said.append) is None and R.crawl_source({"name": "n", "strategy": "x"}, known, said.append) is None
    assert len(said) == 2


def test_files(spark, tmp_path):
    for n in ("a.jpg", "test-flyers-b.jpg", "old"):
        (tmp_path / n).write_text("x")
    assert R.remove_staged(spark, [str(tmp_path / n) for n in ("a.jpg", "test-flyers-b.jpg", "none")]) == [str(tmp_path / "a.jpg")]
    assert R.migrate(spark, str(tmp_path / "old"), str(tmp_path / "new")) and not R.migrate(spark, str(tmp_path / "old"), str(tmp_path / "new"))
    events, seen = str(tmp_path / "events"), str(tmp_path / "seen")
    assert R.reset(spark, events, seen, str(tmp_path / "archive")) == []
    assert len(R.reset(spark, events, seen, str(tmp_path / "archive"))) == 2 and read_events(spark, events).count() == read_seen(spark, seen).count() == 0


def test_full_run():
    records, ticks = [], iter([0.0, 2.5, 3.0, 4.0])
    assert R.full_run([("sync", lambda: 1), ("crawl", lambda: 2)], records.append, lambda: next(ticks)) == {"sync": 1, "crawl": 2}
    with pytest.raises(ZeroDivisionError):
        R.full_run([("sync", lambda: 1), ("crawl", lambda: 1 / 0)], records.append, lambda: next(ticks))
    assert [(r["status"], r["steps"]) for r in records] == [("success", "sync,crawl"), ("failed", "sync")]


def test_cards_of_one_key_are_completed(spark):
    """Two cards of one key on a page, the second with a description; a broken address elsewhere costs nothing."""
    card = lambda title, more: f'<div data-aid="CALENDAR_BIGGER_SCREEN_CONTAINER"><h4 data-aid="CALENDAR_EVENT_TITLE">{title}</h4><span data-aid="CALENDAR_EVENT_DATE">May 1</span>{more}</div>'
    page = card("A", "") + card("A", '<p data-aid="CALENDAR_DESC_TEXT">Gates at 9</p>') + card("B", "")
    df = spark.createDataFrame([(0, "u", page)], "page int, url string, html string")
    got = R.crawl_calendar(df, {"url": "u", "name": "Calendar"}, spark.createDataFrame([], "key string")).orderBy("at").collect()
    assert [(r["title"], r["description"]) for r in got] == [("A", "Gates at 9"), ("B", None)]


def test_broken_addresses(spark):
    from eventloom.sources import html as H

    page = '<a href="http://[bad">x</a><a href="/y">y</a><img src="http://[bad/z.jpg"><img src="/z.jpg">'
    df = spark.createDataFrame([("https://h.example/", page), ("http://[base", page)], "url string, html string")
    assert [tuple(r) for r in H.parse_pages(df, H.links, H.COLUMNS["links"]).filter("url LIKE 'https%'").orderBy("ord").collect()] == [("https://h.example/", 0, None, "x"), ("https://h.example/", 1, "https://h.example/y", "y")]
    assert [r["href"] for r in H.parse_pages(df, H.images, H.COLUMNS["images"]).filter("url LIKE 'https%'").collect()] == ["https://h.example/z.jpg"]
