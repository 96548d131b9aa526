from datetime import date

import pytest
from pyspark.sql import functions as F

from eventloom.functions import matching as M
from eventloom.functions import text as T


@pytest.fixture
def one(spark):
    """The value of a Column over given strings."""

    def value(make, *args):
        row = spark.createDataFrame([tuple(args)], ", ".join(f"c{i} string" for i in range(len(args))))
        return row.select(make(*[F.col(f"c{i}") for i in range(len(args))]).alias("v")).first()["v"]

    return value


@pytest.mark.parametrize("title, key", [("The 25th Annual Spring Bracket Classic!", "25th spring classic"), ("Race at the Park", ""), ("", "")])
def test_title(one, title, key):
    assert one(T.normal_title, title) == key


@pytest.mark.parametrize(
    "name, state, slug",
    [("Texas Motorplex", "TX", "texas-motorplex-tx"), ("Little River Dragway", None, "little-river-dragway"), (None, "TX", None), ("Thunder Valley Raceway Park", "OK", "thunder-valley-ok"), ("The Raceway", "TX", "-tx"), ("The Raceway", None, None)],
)
def test_slug(one, name, state, slug):
    assert one(T.track_slug, name, state) == slug


@pytest.mark.parametrize("name, canonical", [("xrp", "Xtreme Raceway Park"), ("Ennis Raceway / Texas Motorplex", "Texas Motorplex"), ("at MIR today", "at MIR today"), ("Elsewhere", "Elsewhere")])
def test_canonical(one, name, canonical):
    assert one(T.canonical_track, name) == canonical


@pytest.mark.parametrize("text, ok", [("2026-05-10", True), ("2026-5-1", False), ("2026", False), (" 2026-05-10", False), ("2026-05-10T00:00", False), ("2026-02-30", False), ("2026-05-10\n", False), (None, False)])
def test_iso_date(one, text, ok):
    assert (one(T.iso_date, text) is not None) == ok


@pytest.mark.parametrize("start, end, past", [("2026-03-01", "2026-03-03", True), ("2026-03-01", "2026-03-04", False), (None, None, False), ("not-a-date", None, False), ("2026-03-01", "bad", True)])
def test_past(one, start, end, past):
    assert one(lambda s, e: T.is_past(s, e, date(2026, 3, 4)), start, end) == past


@pytest.mark.parametrize("title, ok", [("2026 BANQUET night", False), (None, True), ("", True), ("Finals", True)])
def test_scope(one, title, ok):
    assert one(T.in_scope, title) == ok


@pytest.mark.parametrize(
    "a, sa, b, sb, match",
    [("Tulsa Raceway Park", None, "Tulsa Raceway", None, True), ("Gainesville Raceway", None, "Gainesville Regional Raceway Park", None, True), ("Dallas Motorplex Racing", None, "Dallas Motorplex", None, True),
     ("Texas Motorplex", None, "Tulsa Raceway Park", None, False), ("", None, "Texas Motorplex", None, False), ("Dallas Motorplex Racing", "TX", "Dallas Motorplex Racing", "CA", False), ("XRP", "TX", "Xtreme Raceway Park", "TX", True)],
)
def test_tracks(one, a, sa, b, sb, match):
    key = lambda n: T.normal_track(T.canonical_track(n))
    assert one(lambda x, s, y, t: M.tracks_match(key(x), s, key(y), t), a, sa, b, sb) == match


@pytest.mark.parametrize("a, b, n", [("0" * 16, "f" * 16, 64), ("aabbccdd00112233", "aabbccdd00112233", 0), ("0" * 16, "8" + "0" * 14 + "1", 2)])
def test_hash_distance(one, a, b, n):
    assert one(T.hash_distance, a, b) == n


@pytest.mark.parametrize("location, got", [("633 FM 369 , Iowa Park TX 76367", ("Iowa Park", "TX")), ("not a location", (None, None)), (None, (None, None))])
def test_city_state(one, location, got):
    assert tuple(one(T.city_state, location)) == got


def test_details(one):
    d = one(T.details, " * Gates 8am * \nTrack Phone: 1\ntrack phone: 940-1 \nWebsite:\n\nBYO")
    assert (d["phone"], d["website"], d["notes"]) == ("940-1", None, ["Gates 8am", "BYO"])


@pytest.mark.parametrize("seconds, text", [("12", "12s"), ("75", "1m 15s"), ("3661", "1h 1m 1s"), ("-3", "0s"), ("0.5", "0s"), ("1.5", "2s")])
def test_duration(one, seconds, text):
    assert one(lambda s: T.duration(s.cast("double")), seconds) == text


@pytest.mark.parametrize("site, got", [("streetcartakeover.com", "https://streetcartakeover.com"), ("http://a.b", "http://a.b"), ("", ""), (None, None), ("nodots", "nodots"), ("host.example:80", "host.example:80")])
def test_website(one, site, got):
    assert one(T.website, site) == got


@pytest.mark.parametrize("url, start, end", [("https://x.org/a/Flyer One.PNG?w=1", "Flyer-One-", ".png"), ("https://x.org/", "-", ".jpg"), ("https://x.org/é.b.webp", "é-b-", ".webp")])
def test_file_name(one, url, start, end):
    name = one(T.file_name_of, url)
    assert name.startswith(start) and name.endswith(end) and len(name) == len(start) + 8 + len(end)


@pytest.mark.parametrize("url, got", [("https://drive.example/drive/folders/a-B_1?x", "a-B_1"), ("https://drive.example/open?id=Q7", "Q7"), ("https://drive.example/", None)])
def test_folder_id(one, url, got):
    assert one(T.folder_id, url) == got
