"""Sources that page, fetch and stage, against a server of this process."""

import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from eventloom.plans import strategies as S
from eventloom.sources.files import FileSink, FileWriter, PathConflict, Staged

FAST = {"delay": 0.01, "attempts": 2}


class Site:
    """Answers by path: (content type, body), or a number of failures before one."""

    def __init__(self):
        self.pages, self.asked, self.heads, self.fails = {}, [], [], {}
        site = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self):
                site.asked.append(self.path)
                site.heads.append(dict(self.headers))
                found = site.pages.get(self.path)
                if site.fails.get(self.path, 0) > 0:
                    site.fails[self.path] -= 1
                    found = None
                self.send_response(200 if found else 503)
                self.send_header("content-type", found[0] if found else "text/plain")
                self.end_headers()
                self.wfile.write(found[1] if found else b"")

            def log_message(self, *a):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_port}"


@pytest.fixture
def site():
    s = Site()
    yield s
    s.server.shutdown()


def keys(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "key string")


def listing(*titles):
    return "text/html", "".join(f'<div class="event-listing"><h3>{t}</h3><div class="date">May 1</div><div class="location">Tulsa, OK</div><a href="/events/{t}">more</a></div>' for t in titles).encode()


def source(site, **more):
    return {"name": "rj", "url": site.url, "drag_racing_url": f"{site.url}/drag", "page_delay_seconds": 0, "request_headers": {"X-Test": "true"}} | more


def test_racingjunk_fetches_no_page_beyond_the_stop(spark, site):
    site.pages |= {f"/drag?page={n}": listing(*t) for n, t in {1: ["One", "Two"], 2: ["Two", "Three"], 3: ["One"], 4: ["Four"]}.items()}
    got = S.racingjunk(spark, source(site), keys(spark), **FAST).collect()
    assert [r["title"] for r in got] == ["One", "Two", "Three"] and sorted(set(site.asked)) == [f"/drag?page={n}" for n in (1, 2, 3)] and len(site.asked) == 3
    assert tuple(got[0]) == ("One", "May 1", "Tulsa, OK", f"{site.url}/events/One", "RacingJunk") and all(h["X-Test"] == "true" for h in site.heads)


@pytest.mark.parametrize("pages, seen, most, titles, asked", [({1: ["A"], 2: ["B"], 3: ["C"]}, [], 2, ["A", "B"], 2), ({1: ["A"], 2: ["B"]}, ["A"], 10, [], 1), ({1: []}, [], 10, [], 1), ({1: ["A", ""], 3: ["C"]}, [], 10, ["A"], 2)])
def test_racingjunk_stops(spark, site, pages, seen, most, titles, asked):
    site.pages |= {f"/drag?page={n}": listing(*t) for n, t in pages.items()}
    got = S.racingjunk(spark, source(site, max_pages=most), keys(spark, *seen), delay=0.01, attempts=1).collect()
    assert [r["title"] for r in got] == titles and len(site.asked) == asked


def test_racingjunk_with_many_titles_met(spark, site, monkeypatch):
    """Too many titles to tell the pager: it reads on, and the same listings are kept."""
    monkeypatch.setattr(S, "TOLD_TITLES", 1)
    site.pages |= {f"/drag?page={n}": listing(t) for n, t in {1: "A", 2: "B", 3: "C"}.items()}
    assert [r["title"] for r in S.racingjunk(spark, source(site), keys(spark, "B", "x", "y"), **FAST).collect()] == ["A"]


def test_myracepass(spark, site):
    card = lambda t: f'<div class="event-card"><h3>{t}</h3><div class="date">July 4</div><div class="type">Bracket</div><a href="/e/1">Info</a></div>'
    site.pages["/events"] = ("text/html", (card("Friday") + card("Known") + card("Friday") + card("")).encode())
    got = S.myracepass(spark, {"url": f"{site.url}/events"}, keys(spark, "Known"), **FAST).collect()
    assert [tuple(r) for r in got] == [("Friday", "July 4", "Bracket", f"{site.url}/e/1", "MyRacePass")]
    assert S.myracepass(spark, {"url": f"{site.url}/gone"}, keys(spark), **FAST).count() == 0


def test_rss(spark, site):
    item = lambda t, link: f"<item><title>{t}</title><link>{link}</link><pubDate>d</pubDate><description>s</description></item>"
    site.pages["/feed"] = ("text/xml", f"<rss><channel>{item('A', 'l1')}{item('B', 'l2')}{item('A again', 'l1')}{item('none', '')}</channel></rss>".encode())
    site.fails["/feed"] = 1
    got = S.rss(spark, {"url": f"{site.url}/feed", "name": "Feed"}, keys(spark, "l2"), **FAST).collect()
    assert [tuple(r) for r in got] == [("A", "d", "s", "l1", "Feed"), ("none", "d", "s", "", "Feed")]


def test_bracketraces(spark, site, tmp_path):
    site.pages |= {"/one.php": ("text/html", b'<img src="/a.webp" width="800" height="600"><a href="/b.jpg">Flyer</a><img src="/old.png"><img src="/seen.png">'), "/two.php": ("text/html", b'<img src="/a.webp"><img src="/page.png"><img src="/gone.png">')}
    site.pages |= {"/a.webp": ("image/webp", b"WEBP"), "/b.jpg": ("image/jpeg", b"\xff\xd8\xff"), "/page.png": ("text/html", b"<html>"), "/old.png": ("image/png", b"new"), "/seen.png": ("image/png", b"x")}
    from eventloom.functions.text import file_name_of

    name = {p: spark.range(1).select(file_name_of(F.lit(f"{site.url}/{p}"))).first()[0] for p in ("a.webp", "b.jpg", "old.png")}
    there = spark.createDataFrame([(name["old.png"],)], "path string")
    got = S.bracketraces(spark, {"url": site.url, "event_pages": ["/one.php", "/none.php", "/two.php"]}, keys(spark, f"{site.url}/seen.png"), str(tmp_path / "f"), there, **FAST).collect()
    assert {r["url"].removeprefix(site.url): r["error"] and r["error"].partition(":")[0] for r in got} == {"/a.webp": None, "/b.jpg": None, "/page.png": "no image", "/gone.png": "HTTPError"}
    assert {p.name: p.read_bytes() for p in (tmp_path / "f").iterdir() if p.is_file()} == {name["a.webp"]: b"WEBP", name["b.jpg"]: b"\xff\xd8\xff"}
    assert "/old.png" not in site.asked and "/seen.png" not in site.asked and site.asked.count("/a.webp") == 1


def test_dispatch(spark, site, tmp_path):
    """Each strategy reads its own namespace of the state."""
    site.pages |= {"/drag?page=1": listing("A", "B"), "/events": ("text/html", b'<div class="event-card"><h3>A</h3></div>'), "/feed": ("text/xml", b"<rss><item><title>t</title><link>A</link></item></rss>")}
    seen = spark.createDataFrame([("racingjunk_events", "A"), ("seen_urls", "A")], "namespace string, key string")
    there, said = spark.createDataFrame([], "path string"), []
    go = lambda **e: S.collect(spark, {"name": "n", "page_delay_seconds": 0} | e, seen, str(tmp_path / "f"), there, warn=said.append, **FAST)
    titles = lambda got: (got[0], [r["title"] for r in got[1].collect()])
    assert titles(go(strategy="racingjunk", url=site.url, drag_racing_url=f"{site.url}/drag")) == ("listings", ["B"])
    assert titles(go(strategy="myracepass", url=f"{site.url}/events")) == ("listings", ["A"])
    assert titles(go(strategy="rss", url=f"{site.url}/feed")) == ("listings", [])
    assert titles(go(strategy="tmccc", url=site.url)) == ("listings", [])
    assert go(strategy="other", url="u") is None and "other" in said[0]
    kind, rows = go(strategy="bracketraces", url=site.url, event_pages=["/none"])
    assert kind == "images" and rows.count() == 0


# Files


def put(spark, rows, folder):
    spark.dataSource.register(FileSink)
    spark.createDataFrame(rows, "path string, content binary").repartition(3).write.format("files").option("folder", str(folder)).mode("append").save()


def held(folder: Path):
    return {str(p.relative_to(folder)): p.read_bytes() for p in folder.rglob("*") if p.is_file()}


def test_files_are_added_once(spark, tmp_path):
    rows = [("a.bin", b"1"), ("b/c.bin", b"1"), ("d", b""), ("a.bin", b"1"), (None, b"x"), ("n", None)]
    put(spark, rows, tmp_path)
    assert held(tmp_path) == {"a.bin": b"1", "b/c.bin": b"1", "d": b""}
    put(spark, [("a.bin", b"other"), ("e", b"2")], tmp_path)
    assert held(tmp_path) == {"a.bin": b"1", "b/c.bin": b"1", "d": b"", "e": b"2"}


@pytest.mark.parametrize("rows, said", [([("a", b"1"), ("a", b"2"), ("z", b"3")], "different contents"), ([("../a", b"1"), ("z", b"3")], "relative path"), ([("_staged/x", b"1")], "relative path")])
def test_a_failed_job_leaves_nothing(spark, tmp_path, rows, said):
    with pytest.raises(Exception, match=said):
        put(spark, rows, tmp_path)
    assert held(tmp_path) == {}


def test_commit_can_be_repeated(tmp_path):
    w = FileWriter(str(tmp_path))
    first, again = w.write(iter([{"path": "a", "content": b"1"}])), w.write(iter([{"path": "a", "content": b"1"}]))  # a task that ran twice
    w.commit([first, None])
    w.commit([again])
    assert held(tmp_path) == {"a": b"1"}
    other = FileWriter(str(tmp_path))
    messages = [other.write(iter([{"path": "b", "content": b"1"}])), Staged([("b", "no")])]
    with pytest.raises(PathConflict):
        other.commit(messages)
    assert held(tmp_path) == {"a": b"1"}


# Shared folder


def test_shared_folder(spark, site, tmp_path):
    from eventloom.plans import runs as R

    entry = lambda i, t: f'<div class="flip-entry" id="entry-{i}"><a href="v"><div class="flip-entry-title">{t}</div></a></div>'
    site.pages["/view?id=F-1"] = ("text/html", "".join([entry("id1longer", "a b.jpg"), entry("id2longer", "a b.jpg"), entry("x", "notes.txt"), entry("id1longer", "c.png")]).encode())
    site.pages |= {"/get?id=id1longer": ("image/jpeg", b"one"), "/get?id=id2longer": ("image/jpeg", b"two")}
    folder, state = tmp_path / "flyers", str(tmp_path / "state")
    run = lambda: R.sync_files(spark, "https://drive.google.com/drive/folders/F-1", state, str(folder), view=f"{site.url}/view?id={{folder_id}}", download=f"{site.url}/get?id={{file_id}}", **FAST)
    assert run() == {"listed": 4, "downloaded": 2, "skipped_known": 1, "skipped_non_image": 1}
    assert held(folder) == {"a b.jpg": b"one", "a b-id2longe.jpg": b"two"} and {r["file_id"] for r in R.read_sync_state(spark, state).collect()} == {"id1longer", "id2longer"}
    assert run() == {"listed": 4, "downloaded": 0, "skipped_known": 3, "skipped_non_image": 1} and site.asked.count("/get?id=id1longer") == 1
    site.pages["/view?id=F-1"] = ("text/html", (entry("id3", "d.png") + entry("gone", "e.png")).encode())
    site.pages["/get?id=id3"] = ("image/png", b"three")
    with pytest.raises(OSError, match="gone"):
        run()
    assert len(held(folder)) == 2 and R.read_sync_state(spark, state).count() == 2
    with pytest.raises(R.ConfigError):
        R.folder_id("https://drive.google.com/drive")
