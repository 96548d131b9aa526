"""Perceptual hashes, the versioned store, remembered answers, the log, and a run from images and listings to events."""

import json
import logging
import math
import random
import statistics
import struct
import threading
import zlib
from datetime import date

import numpy as np
import pytest

from eventloom.functions import phash as P
from eventloom.operators.validate import InvalidRecords
from eventloom.plans import logs
from eventloom.plans.extract import answered
from eventloom.plans.process import run_extraction
from eventloom.plans.store import Conflict, EventStore

EVENT = {"title": "Open Finals", "event_type": "bracket", "track": {"name": "Tulsa Raceway", "state": "OK"}, "dates": {"start": "2026-05-10", "end": None}, "confidence": 0.5}
TODAY = date(2026, 1, 1)


# Hashes


def direct_hash(x, size=8):
    """Sums over all pixels, one frequency at a time."""
    n = len(x)
    y = [sum(4 * x[r][c] * math.cos(math.pi * u * (2 * r + 1) / (2 * n)) * math.cos(math.pi * v * (2 * c + 1) / (2 * n)) for r in range(n) for c in range(n)) for u in range(size) for v in range(size)]
    middle = statistics.median(y)
    return f"{int(''.join('1' if a > middle else '0' for a in y), 2):0{size * size // 4}x}"


def test_squares_against_sums(spark):
    rng = random.Random(1)
    rows = [(n, [rng.random() * 255 for _ in range(1024)]) for n in range(6)] + [(10, None), (11, [1.0]), (12, [None] * 1024), (13, [float("nan")] * 1024)]
    got = dict(P.hash_squares(spark.createDataFrame(rows, "n int, lum array<double>"), "lum").select("n", "phash").collect())
    assert got == {n: direct_hash([x[32 * k : 32 * k + 32] for k in range(32)]) if n < 10 else None for n, x in rows}


def png(x, filters):
    """A PNG of an array (height, width, depth), each row by the filter of its turn."""
    h, w, d = x.shape
    body, above = b"", np.zeros((w, d), np.int32)
    for y in range(h):
        row, way = x[y].astype(np.int32), filters[y % len(filters)]
        left, corner = np.vstack([np.zeros((1, d), np.int32), row[:-1]]), np.vstack([np.zeros((1, d), np.int32), above[:-1]])
        p = left + above - corner
        a, b, c = abs(p - left), abs(p - above), abs(p - corner)
        guess = [0, left, above, (left + above) // 2, np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))][way]
        body, above = body + bytes([way]) + ((row - guess) & 255).astype(np.uint8).tobytes(), row
    chunk = lambda k, data: struct.pack(">I", len(data)) + k + data + struct.pack(">I", zlib.crc32(k + data))
    kind = {1: 0, 2: 4, 3: 2, 4: 6}[d]
    packed = zlib.compress(body)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)) + chunk(b"IDAT", packed[:20]) + chunk(b"IDAT", packed[20:]) + chunk(b"IEND", b"")


def ppm(x):
    return b"P6\n# made here\n%d %d\n255\n" % (x.shape[1], x.shape[0]) + x.tobytes()


def bmp(x):
    rows = b"".join((r := line[:, ::-1].tobytes()) + b"\0" * (-len(r) % 4) for line in x[::-1])
    return b"BM" + struct.pack("<IHHI", 54 + len(rows), 0, 0, 54) + struct.pack("<IiiHHIIiiII", 40, x.shape[1], x.shape[0], 1, 24, 0, len(rows), 0, 0, 0, 0) + rows


def picture(seed, w=75, h=50):
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[:h, :w]
    return np.stack([np.clip(128 + 100 * np.sin(x / w * rng.uniform(2, 9) + rng.uniform(0, 6)) * np.cos(y / h * rng.uniform(2, 9)), 0, 255) for _ in range(3)], axis=2).astype(np.uint8)


@pytest.mark.parametrize("filters", [[0], [1], [2], [3], [4], [0, 1, 2, 3, 4]])
def test_decoders_agree(filters):
    x = picture(3)
    lum = P.decode(ppm(x))
    assert (P.decode(png(x, filters)) == lum).all() and (P.decode(bmp(x)) == lum).all()
    grey = lum[:, :, None]
    assert (P.decode(png(grey, filters)) == lum).all() and (P.decode(b"P5 %d %d 255\n" % (75, 50) + lum.tobytes()) == lum).all()
    assert (P.decode(png(np.concatenate([x, grey], axis=2), filters)) == lum).all()


def test_images(spark):
    a, b = picture(1), picture(2)
    small = a[::2, ::2]
    rows = [("a", ppm(a)), ("again", png(a, [4])), ("small", ppm(np.ascontiguousarray(small))), ("b", ppm(b)), ("jpeg", b"\xff\xd8\xff"), ("cut", png(a, [0])[:60]), ("none", None), ("flat", ppm(np.full((40, 40, 3), 9, np.uint8)))]
    got = {r["path"]: r for r in P.hash_images(spark.createDataFrame(rows, "path string, content binary")).collect()}
    bits = lambda x, y: (int(got[x]["phash"], 16) ^ int(got[y]["phash"], 16)).bit_count()
    assert bits("a", "again") == 0 and bits("a", "small") <= 10 < bits("a", "b") and len(got["flat"]["phash"]) == 16
    assert {k for k, r in got.items() if r["problem"]} == {"jpeg", "cut", "none"} == {k for k, r in got.items() if r["phash"] is None}


# Store


def stored(spark, *titles):
    return spark.createDataFrame([(n, json.dumps(EVENT | {"title": t})) for n, t in enumerate(titles)], "seq long, payload string")


def test_versions(spark, tmp_path):
    store = EventStore(spark, str(tmp_path / "events"))
    assert store.read()[1].count() == 0 and store.events().count() == 0
    one, (base, reading) = store.commit(stored(spark, "A"), 0), store.read()
    two = store.commit(stored(spark, "A", "B"), one)
    assert (one, base, two) == (1, 1, 2) and reading.count() == 1  # a reader between the steps keeps its snapshot
    assert sorted(r["title"] for r in store.events().collect()) == ["A", "B"]
    with pytest.raises(Conflict):
        store.commit(stored(spark, "late"), one)
    with pytest.raises(InvalidRecords, match="missing required property 'title'"):
        store.commit(spark.createDataFrame([(0, "{}")], "seq long, payload string"), two)
    assert store.current()[0] == 2 and len(list((tmp_path / "events" / "snapshots").iterdir())) == 2
    # A writer that died while it created its version.
    (tmp_path / "events" / "versions" / f"{3:012d}").write_bytes(b"")
    base, rows = store.read()
    assert base == 3 and rows.count() == 2 and store.commit(stored(spark, "C"), base) == 4
    assert store.vacuum(keep=1) == [1, 2] and [r["title"] for r in store.events().collect()] == ["C"]


def test_two_writers(spark, tmp_path):
    """Of writers that begin with one version, exactly one commits."""
    store, ended = EventStore(spark, str(tmp_path / "e")), []

    def write(n):
        try:
            ended.append(store.commit(stored(spark, f"W{n}"), 0))
        except Conflict:
            ended.append(None)

    threads = [threading.Thread(target=write, args=(n,)) for n in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(map(str, ended)) == ["1", "None", "None", "None"] and store.events().count() == 1


# Answers


def counting(path, answer):
    """An extractor that notes each call as a line of a file, as calls come from several processes."""

    def ask(hint, text, image):
        with open(str(path), "a") as f:
            f.write(f"{text if text is not None else len(image)}\n")
        return answer(text, image)

    return ask


def calls(path):
    return sorted(path.read_text().split("\n")[:-1]) if path.exists() else []


def test_nothing_is_asked_twice(spark, tmp_path):
    def answer(text, image):
        if text == "fails":
            raise OSError("no line")
        return EVENT | {"title": text, "confidence": 2 if text == "bad" else 0.5}

    asked, folder = tmp_path / "calls", str(tmp_path / "answers")
    df = spark.createDataFrame([(0, "a", None), (1, "a", None), (2, "bad", None), (3, "fails", None)], "seq long, text string, image binary")
    out = answered(df, counting(asked, answer), TODAY, folder, attempts=2, delay=0)
    for _ in range(2):  # evaluated again
        got = {r["seq"]: (r["status"], r["error"], r["attempts"], bool(r["trace"])) for r in out.collect()}
        assert got == {0: ("ok", None, 1, False), 1: ("ok", None, 1, False), 2: ("error", "$.confidence: must be <= 1", 1, False), 3: ("error", "no line", 2, True)}
    assert calls(asked) == ["a", "bad", "fails", "fails"]
    assert "OSError: no line" in next(r["trace"] for r in out.collect() if r["trace"])
    again = answered(df.union(spark.createDataFrame([(4, "new", None)], df.schema)), counting(asked, lambda t, i: EVENT | {"title": t}), TODAY, folder, delay=0)
    assert {r["seq"]: r["status"] for r in again.collect()} == {0: "ok", 1: "ok", 2: "error", 3: "ok", 4: "ok"}
    assert calls(asked) == ["a", "bad", "fails", "fails", "fails", "new"]
    answered(df.limit(1), counting(asked, answer), date(2026, 1, 2), folder).collect()
    assert calls(asked).count("a") == 2  # another day is another question


# The run


def test_run(spark, tmp_path, capsys):
    staged = tmp_path / "flyers"
    (staged / "test-flyers").mkdir(parents=True)
    a, b = picture(1), picture(2)
    files = {"1-a.ppm": ppm(a), "2-a-again.png": png(a, [4]), "3-b.ppm": ppm(b), "4-fails.jpg": b"\xff\xd8fails", "5-past.jpg": b"\xff\xd8past", "test-flyers/t.jpg": b"\xff\xd8test"}
    for name, data in files.items():
        (staged / name).write_bytes(data)
    images = spark.createDataFrame([(str(staged / n), d) for n, d in files.items()], "path string, content binary")
    listings = spark.createDataFrame(
        [(0, "Open Finals", "RacingJunk", "l0", "May 10", None, None), (1, "Awards Banquet", "RacingJunk", "l1", None, None, None), (2, "Nationals", "TMCCC", "l2", "June 1", "1 Road, Ennis, TX 75119", "Track Phone: 555\nGates at 9"), (3, "Broken", "RacingJunk", "l3", None, None, None)],
        "ord long, title string, source string, source_url string, date_text string, location_text string, description string",
    )

    def answer(text, image):
        if image is not None:
            if b"fails" in image:
                raise OSError("overloaded")
            start = "2020-01-01" if b"past" in image else "2026-07-04" if image == files["3-b.ppm"] else "2026-09-09" if b"test" in image else "2026-05-10"
            return EVENT | {"dates": {"start": start, "end": None}}
        if "Nationals" in text:
            return EVENT | {"title": "Nationals", "track": {"name": "Motorplex", "city": None, "state": None}, "dates": {"start": "2026-06-01", "end": None}, "contact": {"phone": None, "email": None, "website": None}, "classes": [], "series": None, "notes": None}
        return [] if "Broken" in text else EVENT | {"notes": "listed"}

    store, asked = EventStore(spark, str(tmp_path / "events")), tmp_path / "calls"
    run = lambda i, l: run_extraction(spark, i, l, store, counting(asked, answer), str(tmp_path / "answers"), str(tmp_path / "errors"), TODAY, scratch=str(tmp_path), at="2026-01-01T00:00:00+00:00", delay=0, attempts=2)
    assert {k: v for k, v in run(None, None).items() if v} == {} or run(None, None)["total_events"] == 0
    assert store.current() == (0, None) and not asked.exists()
    got = run(images, listings)
    assert {k: got[k] for k in ("image_flyers", "text_listings", "new", "merged", "duplicate", "skipped", "error", "total_events")} == {"image_flyers": 6, "text_listings": 4, "new": 4, "merged": 1, "duplicate": 1, "skipped": 2, "error": 2, "total_events": 4}
    assert sorted(str(p.relative_to(staged)) for p in staged.rglob("*.*") if p.is_file()) == ["4-fails.jpg", "test-flyers/t.jpg"]
    events = {r["dates"]["start"]: r for r in store.events().collect()}
    assert events["2026-05-10"]["notes"] == "listed" and [f["file"] for f in events["2026-05-10"]["flyers"]] == [str(staged / "1-a.ppm"), "l0"]
    full = events["2026-06-01"]
    assert (full["track"]["city"], full["track"]["state"], full["contact"]["phone"], full["series"], full["notes"]) == ("Ennis", "TX", "555", "TMCCC", "Gates at 9") and full["classes"]
    letters = {r["context"]: r for r in spark.read.parquet(str(tmp_path / "errors")).collect()}
    assert letters["process_flyer"]["error"] == "overloaded" and "OSError" in letters["process_flyer"]["trace"] and letters["extract_from_text"]["details"]["listing_title"] == "Broken"
    assert "4 events: 4 new, 1 merged" in capsys.readouterr().out
    before = len(calls(asked))
    # The same images once more: those near stored ones are known without a question, the failing one is asked again.
    got = run(images.filter("path NOT LIKE '%test-flyers%'"), None)
    assert (got["duplicate"], got["skipped"], got["error"], got["new"]) == (3, 1, 1, 0) and len(calls(asked)) == before + 2 and store.current()[0] == 2


def test_logger(tmp_path, monkeypatch, capsys):
    monkeypatch.setenv(logs.LEVEL, "nonsense")
    monkeypatch.setenv(logs.TO_FILE, "Yes")
    monkeypatch.setenv(logs.FILE, str(tmp_path / "a" / "log.txt"))
    for _ in range(2):
        log = logs.get_logger("eventloom.test")
    log.info("said once")
    log.debug("not said")
    assert capsys.readouterr().out == "said once\n" and (tmp_path / "a" / "log.txt").read_text().count("INFO eventloom.test said once") == 1
    monkeypatch.setenv(logs.LEVEL, "error")
    assert logs.get_logger("eventloom.test").level == logging.ERROR and not log.propagate


def test_check(spark, tmp_path):
    from eventloom.plans.check import check

    good, bad = EVENT, EVENT | {"confidence": 2, "event_type": "x"}
    (tmp_path / "good.json").write_text(json.dumps([good] * 3, indent=2))
    (tmp_path / "bad.json").write_text(json.dumps([good, bad], indent=2))
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, [good, bad, bad])))
    (tmp_path / "cut.json").write_text("[{")
    (tmp_path / "none.json").write_text("[]")
    at = lambda n: str(tmp_path / f"{n}.json")
    assert check(spark, at("good")) == (0, [f"Schema validation passed for {at('good')}"]) and check(spark, at("none"))[0] == 0
    code, lines = check(spark, at("bad"))
    assert code == 1 and lines[0] == f"Schema validation failed for {at('bad')}:" and lines[1] == "  - $[1].confidence: must be <= 1" and lines[2].startswith("  - $[1].event_type: expected one of") and len(lines) == 3
    assert len(check(spark, at("lines"))[1]) == 5 and check(spark, at("lines"), most=1)[1][-1] == "  and 3 more"
    assert check(spark, at("cut")) == (1, [f"Schema validation failed for {at('cut')}:", "  - $[0]: invalid JSON"]) and check(spark, at("missing"))[0] == 1


def test_tool_calls():
    from eventloom.plans.extract import NoAnswer, ToolCall, media_type_of

    sent = []
    blocks = [{"type": "text", "text": "so"}, {"type": "tool_use", "name": "other", "input": {}}, {"type": "tool_use", "name": "store_event", "input": EVENT}, {"type": "tool_use", "name": "store_event", "input": {}}]
    ask = ToolCall(lambda r: (sent.append(r), blocks)[1])
    assert ask("hint", "title: A", None) == EVENT and sent[0]["content"] == [{"type": "text", "text": "hint\n\ntitle: A"}] and sent[0]["tool"]["name"] == "store_event"
    assert ask("hint", None, b"GIF89a") == EVENT and sent[1]["content"][0]["source"] == {"type": "base64", "media_type": "image/gif", "data": "R0lGODlh"}
    with pytest.raises(NoAnswer, match="did not call store_event for listing: A$"):
        ToolCall(lambda r: blocks[:2])("hint", "source_url: u\ntitle: A", None)
    with pytest.raises(NoAnswer, match="did not call store_event$"):
        ToolCall(lambda r: [])("hint", None, b"x")
    assert [media_type_of(x) for x in (b"\x89PNG..", b"RIFF....WEBP", b"RIFF....WAVE", b"")] == ["image/png", "image/webp", "image/jpeg", "image/jpeg"]
