import json

import pytest

from eventloom.plans.extract import Replay, extract, prompt_key
from eventloom.plans.workflow import append_seen, archive, judged, log_errors, record_run, run_items, run_upsert, save_events
from eventloom.operators.validate import InvalidRecords
from eventloom.sources import html as H
from eventloom.sources.readers import FetchSource, read_events, read_images, read_runs, read_seen, with_retries
from datetime import date

GOOD = {"title": "Open", "event_type": "bracket", "track": {"name": "T"}, "dates": {"start": "2026-05-10"}, "confidence": 0.5}


def test_images():
    page = '<img src="a.jpg"><img data-src="/b.PNG" width="500" height="500"><img src="c.jpg" width="50" height="50"><img src="d.svg"><img><img src="e.webp" width="auto" height="10"><img src="f.gif"><a href="g.jpg">Flyer</a><a href="h.jpg">x</a>'
    base = "https://x.org/p/"
    got = [r["href"] for r in H.images(base, page)]
    assert got == ["https://x.org/p/a.jpg", "https://x.org/b.PNG", "https://x.org/p/e.webp"]
    assert [r["href"] for r in H.images(base, page, flyer_links=True)] == [*got, "https://x.org/p/g.jpg"]


def test_cards():
    page = '<div class="event-listing"><h3> Finals </h3><span class="Event-Date">May 1</span><p class="venue">Ennis</p><a href="/e/1">go</a></div>'
    (card,) = H.cards("https://x.org/", page, **H.CARD_PAGES["racingjunk"])
    assert card == {"ord": 0, "title": "Finals", "date_text": "May 1", "location_text": "Ennis", "source_url": "https://x.org/e/1", "source": "RacingJunk"}
    (other,) = H.cards("https://x.org/", '<div class="event-card"><h3>A</h3><i class="kind">Pro</i></div>', **H.CARD_PAGES["myracepass"])
    assert (other["title"], other["event_type_text"], other["source_url"]) == ("A", "Pro", "https://x.org/")


def card(size, title, day, inner=""):
    return f'<div data-aid="CALENDAR_{size}_SCREEN_CONTAINER"><p data-aid="CALENDAR_EVENT_DATE">{day}</p><h4 data-aid="CALENDAR_EVENT_TITLE">{title}</h4>{inner}</div>'


def test_calendar():
    time = '<div data-aid="CALENDAR_EVENT_TIME"><h4>9am</h4><h4>-</h4><h4>5pm</h4></div><p>1 Main St, Ennis TX 75119</p><div data-aid="CALENDAR_DESC_TEXT">a<br>b</div>'
    page = card("SMALLER", "Small", "d") + card("BIGGER", "Finals", "May 1", time) + card("BIGGER", "Club Banquet", "May 2")
    (got,) = H.calendar("u", page)
    assert got == {"ord": 1 - 1, "title": "Finals", "date_text": "May 1", "time_text": "9am - 5pm", "location_text": "1 Main St, Ennis TX 75119", "description": "a\nb"}
    assert [r["title"] for r in H.calendar("u", card("SMALLER", "Small", "d"))] == ["Small"]


def test_folder_and_feed(spark):
    page = '<div class="flip-entry" id="entry-F1"><a href="v1"><div class="flip-entry-title">a.jpg</div></a></div><div class="flip-entry" id="x"><a href="v"></a></div>'
    assert list(H.folder("u", page)) == [{"ord": 0, "file_id": "F1", "title": "a.jpg", "view_url": "v1"}]
    xml = "<rss><channel><item><title>T</title><link>https://l</link><pubDate>p</pubDate><description>s</description></item></channel></rss>"
    df = H.parse_pages(spark.createDataFrame([("u", xml), ("v", None), ("w", "<")], "url string, html string"), H.feed, H.COLUMNS["feed"])
    assert [tuple(r) for r in df.collect()] == [("u", 0, "T", "p", "s", "https://l")]


def test_retries():
    calls, slept = [], []

    def twice():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("no")
        return 7

    assert with_retries(twice, sleep=slept.append) == (7, None, 3, 3.0) and slept == [1.0, 2.0]
    got, error, n, _ = with_retries(lambda: 1 / 0, sleep=slept.append, again=lambda e: False)
    assert got is None and isinstance(error, ZeroDivisionError) and n == 1


def test_fetch(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>hi</p>")
    spark.dataSource.register(FetchSource)
    urls = json.dumps([f"file://{tmp_path}/a.html", f"file://{tmp_path}/none.html"])
    rows = spark.read.format("fetch").option("urls", urls).option("delay", "0").load().orderBy("url").collect()
    assert bytes(rows[0]["content"]) == b"<p>hi</p>" and rows[0]["error"] is None
    assert rows[1]["content"] is None and rows[1]["attempts"] == 3 and rows[1]["error"].startswith("URLError")


def test_extract(spark):
    answers = {prompt_key("a"): GOOD, prompt_key("b"): GOOD | {"confidence": 2}, prompt_key("c"): GOOD | {"title": "Banquet"}, prompt_key("d"): GOOD | {"dates": {"start": "2020-01-01"}}}
    df = spark.createDataFrame([(0, "a", None), (1, "b", None), (2, "gone", None), (3, "c", None), (4, "d", None)], "seq long, text string, image binary")
    got = {r["seq"]: (r["status"], r["error"], r["attempts"]) for r in judged(extract(df, Replay(answers), date(2026, 1, 1), delay=0), date(2026, 1, 1)).collect()}
    assert got[0] == ("ok", None, 1) and got[1] == ("error", "$.confidence: must be <= 1", 1) and got[2][0] == "error" and got[2][2] == 3
    assert got[3][0] == got[4][0] == "skipped"


def test_workflow(spark, tmp_path):
    path = str(tmp_path / "events.json")
    assert read_events(spark, path).count() == 0
    none = spark.createDataFrame([], "seq long, payload string")
    inputs = spark.createDataFrame([(0, "text", json.dumps(GOOD), None, "u", "ok"), (1, "text", json.dumps(GOOD | {"notes": "n"}), None, "v", "ok")], "seq long, kind string, payload string, phash string, flyer string, status string")
    events, outcomes = run_upsert(none, inputs, "2026-01-01T00:00:00+00:00")
    assert {r["outcome"] for r in outcomes.collect()} == {"new", "merged"}
    save_events(events, path)
    save_events(events, path)
    (e,) = read_events(spark, path).collect()
    assert (e["title"], e["notes"], len(e["flyers"]), e["track"]["id"]) == ("Open", "n", 2, "t")
    with pytest.raises(InvalidRecords, match="missing required property 'title'"):
        save_events(spark.createDataFrame([(0, "{}")], "seq long, payload string"), path)
    assert read_events(spark, path).count() == 1
    same, nothing = run_upsert(events, inputs.limit(0), "t")
    assert same.count() == 1 and nothing.count() == 0
    assert archive(spark, path, str(tmp_path / "old")) and not archive(spark, path, str(tmp_path / "old"))


def test_events_come_back_whole(spark, tmp_path):
    """Many events over several files, and the same as one array, keep every row."""
    path = str(tmp_path / "events")
    many = spark.createDataFrame([(n, json.dumps(GOOD | {"title": f"Open {n}"})) for n in range(50)], "seq long, payload string").repartition(5)
    save_events(many, path)
    assert sorted(r["title"] for r in read_events(spark, path).collect()) == sorted(f"Open {n}" for n in range(50))
    (tmp_path / "array.json").write_text(json.dumps([GOOD | {"title": f"Open {n}"} for n in range(50)], indent=2))
    (tmp_path / "flat.json").write_text(json.dumps([GOOD] * 3))
    (tmp_path / "one.json").write_text(json.dumps(GOOD, indent=2))
    assert [read_events(spark, str(tmp_path / n)).count() for n in ("array.json", "flat.json", "one.json")] == [50, 3, 1]


def test_runs_come_back_in_order(spark, tmp_path):
    for n in range(8):
        record_run(spark, {"run_id": f"r{n}", "status": "success", "elapsed_seconds": n, "started_at": "2026-01-01", "finished_at": None}, str(tmp_path / "runs"))
    assert [r["run_id"] for r in read_runs(spark, str(tmp_path / "runs")).orderBy("ord").collect()] == [f"r{n}" for n in range(8)]


def test_state_and_logs(spark, tmp_path):
    seen, runs, errors = (str(tmp_path / n) for n in ("seen", "runs", "errors"))
    append_seen(spark.createDataFrame([("a", 0)], "key string, ord long"), seen, "urls")
    append_seen(spark.createDataFrame([("b", 1)], "key string, ord long"), seen, "urls")
    assert {r["key"] for r in read_seen(spark, seen).collect()} == {"a", "b"}
    record_run(spark, {"run_id": "1", "status": "success", "elapsed_seconds": 2.5, "started_at": None, "finished_at": None}, runs)
    assert [r["elapsed_seconds"] for r in read_runs(spark, runs).collect()] == ["2.5"]
    log_errors(spark.createDataFrame([("c", "e", {"p": "x"}), ("c", "e", {"p": "test-flyers/x"}), ("c", "e", None)], "context string, error string, details map<string,string>"), errors)
    assert spark.read.parquet(errors).count() == 2
    folder = tmp_path / "img"
    folder.mkdir()
    for n in ("b.JPG", "a.gif", "c.txt"):
        (folder / n).write_bytes(b"x")
    assert [r["path"][-5:] for r in read_images(spark, str(folder)).collect()] == ["a.gif", "b.JPG"]


def test_items():
    saved, slept = [], []
    got = run_items([{"name": "North"}, {"name": "South"}], lambda i: {"images": 1}, saved.append, only="nor", sleep=slept.append, clock=lambda: 1.0)
    assert got == [{"name": "North", "elapsed_seconds": 0.0, "images": 1}] and len(saved) == len(slept) == 1
