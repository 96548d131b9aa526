import json
import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from eventloom.operators import aggregates as A
from eventloom.operators.graph import components
from eventloom.operators.joins import hash_join, overlap_join
from eventloom.operators.lookup import alias_table, backfill, catalog_table, resolve
from eventloom.functions import fixed
from eventloom.operators.upsert import INPUT, Fold, bits, fold, merged, upsert
from eventloom.operators.validate import EVENT_SCHEMA, ConfigError, check_sources, check_tracks, problems, validate


def test_overlap_is_the_formula(spark):
    rng, base = random.Random(1), date(2026, 1, 1)
    rows = [(n, base + timedelta(rng.randrange(60)), rng.choice([None, base + timedelta(rng.randrange(60))])) for n in range(80)] + [(90, None, base)]
    df = spark.createDataFrame(rows, "k int, start date, end date")
    got = sorted((r["l_k"], r["r_k"]) for r in overlap_join(df, df).collect())
    want = sorted((a, c) for a, s, e in rows for c, t, f in rows if s and t and s <= (f or t) and t <= (e or s))
    assert got == want


@pytest.mark.parametrize("distance", [0, 3, 10, 20])
def test_hash_join_is_exact(spark, distance):
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(20)]
    hashes = base + [b ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(24))) for b in base for _ in range(3)]
    rows = [(n, f"{h:016x}") for n, h in enumerate(hashes)] + [(999, None)]
    df = spark.createDataFrame(rows, "k int, phash string")
    got = sorted((r["l_k"], r["r_k"]) for r in hash_join(df, df, distance=distance, condition=F.col("l_k") < F.col("r_k")).collect())
    assert got == sorted((a, b) for a, x in rows[:-1] for b, y in rows[:-1] if a < b and bits(x, y) <= distance)


def test_components(spark):
    edges = spark.createDataFrame([(n, n + 1) for n in range(1, 40) if n % 10] + [(100, 101), (101, 100)], "a long, b long")
    got = dict(components(spark.createDataFrame([(n,) for n in [*range(1, 41), 100, 101, 200]], "id long"), edges).collect())
    assert got == {n: (n - 1) // 10 * 10 + 1 for n in range(1, 41)} | {100: 100, 101: 100, 200: 200}


def event(title="Open Finals", name="Texas Motorplex", start="2026-05-10", end=None, state="TX", **more):
    return {"title": title, "event_type": "bracket", "track": {"name": name, "state": state}, "dates": {"start": start, "end": end}, "confidence": 0.5} | more


def inputs(spark, rows):
    return spark.createDataFrame([(n, r.get("kind", "text"), json.dumps(r["e"]), r.get("phash"), f"f{n}", r.get("status", "ok"), f"id{n}", "t") for n, r in enumerate(rows)], INPUT)


def test_merge_rules():
    old = event("Old", notes="keep", classes=["Super Pro"], id="1", created_at="c", flyers=[{"file": "a"}], contact={"phone": "1", "website": ""}, dates={"start": "2026-05-10", "end": "2026-05-11"})
    new = event("", name="XRP", series="S", classes=["Pro"], contact={"phone": "", "email": "e"}, dates={"start": "", "end": "2026-06-01"}) | {"confidence": 0.9}
    m = merged(old, new, {"file": "b"}, "now")
    assert (m["title"], m["notes"], m["series"], m["id"], m["created_at"], m["updated_at"]) == ("Old", "keep", "S", "1", "c", "now")
    assert m["track"]["name"] == "Xtreme Raceway Park" and m["track"]["id"] == "xtreme-tx"
    assert m["dates"] == {"start": "2026-05-10", "end": "2026-05-11"} and m["classes"] == ["Pro", "Super Pro"] and m["confidence"] == 0.9
    assert m["contact"] == {"phone": "1", "email": "e", "website": ""} and [f["file"] for f in m["flyers"]] == ["a", "b"]


def test_outcomes(spark):
    rows = [{"kind": "event", "e": event(id="x", flyers=[{"phash": "0" * 16}])}, {"kind": "image", "e": {}, "phash": "0" * 15 + "7", "status": "error"}, {"e": event(start="2026-05-10")}, {"e": event(start="2026-06-10")}, {"e": event(), "status": "skipped"}, {"e": {"title": None, "track": None, "dates": None}}]
    got = {r["seq"]: r["outcome"] for r in upsert(inputs(spark, rows)).collect()}
    assert got == {0: None, 1: "duplicate", 2: "merged", 3: "new", 4: "skipped", 5: "new"}


def test_components_fold_like_the_whole_list(spark, monkeypatch):
    rng = random.Random(7)
    names, titles = ["Tulsa Raceway", "XRP", "Xtreme Raceway Park", "Bay North Strip", "North Bay", "", "Bay"], ["Spring Open Finals", "Open", "Finals Spring", "Winter", ""]
    rows = []
    for _ in range(150):
        d = date(2026, 1, 1) + timedelta(rng.randrange(40))
        r = {"e": event(rng.choice(titles), rng.choice(names), rng.choice([str(d), str(d), "bad", None]), rng.choice([None, str(d + timedelta(rng.randrange(-2, 4)))]), rng.choice(["TX", "OK", None, ""])), "status": rng.choice(["ok"] * 6 + ["skipped", "error"])}
        if rng.random() < 0.4:
            r |= {"kind": "image", "phash": f"{(0xABCDEF << rng.randrange(3) * 16) ^ rng.getrandbits(8):016x}"}
        rows.append(r)
    df = inputs(spark, rows)
    got = {(r["seq"], r["outcome"], r["payload"]) for r in upsert(df).collect()}
    # In waves of 25 rows of a component, a task sees a part of the records only.
    assert got == {(r["seq"], r["outcome"], r["payload"]) for r in upsert(df, wave=25).collect()}
    want: dict[int, dict] = {}
    for x in fold([r.asDict() for r in df.collect()]):
        want.setdefault(x["seq"], {}).update(x)
    assert got == {(k, v.get("outcome"), v.get("payload")) for k, v in want.items()}
    # The same, each input held against every record before it.
    monkeypatch.setattr(Fold, "_first", lambda self, mark: next((n for n, m in enumerate(self.marks) if mark.same(m)), None))
    plain: dict[int, dict] = {}
    for x in fold([r.asDict() for r in df.collect()]):
        plain.setdefault(x["seq"], {}).update(x)
    assert plain == want


def test_names_with_white_space_of_any_kind_meet(spark):
    rows = [{"e": event(name="Xtreme Raceway Park")}, {"e": event(name="XRP\n")}, {"e": event(name="\u3000xrp\xa0")}]
    assert [r["outcome"] for r in upsert(inputs(spark, rows)).orderBy("seq").collect()] == ["new", "merged", "merged"]


def test_hashes_that_are_none_match_nothing(spark):
    rows = [{"kind": "event", "e": event(id="x", flyers=[{"phash": "zz"}, {"phash": None}])}, {"kind": "image", "e": event(), "phash": "zz"}, {"kind": "image", "e": event(), "phash": "0" * 16}, {"kind": "image", "e": event(), "phash": "0" * 16}]
    assert [r["outcome"] for r in upsert(inputs(spark, rows)).orderBy("seq").collect()] == [None, "merged", "merged", "duplicate"]


def test_images_are_completed_from_the_catalog(spark):
    e = event(name="XRP", contact={"phone": "", "email": None, "website": " own.example "}) | {"track": {"name": "XRP", "state": None}}
    rows = [{"kind": "image", "e": e, "phash": "0" * 16}, {"kind": "text", "e": e | {"dates": {"start": "2026-09-01"}}}]
    image, text = (json.loads(r["payload"]) for r in upsert(inputs(spark, rows)).orderBy("seq").collect())
    known = next(t for t in fixed.TRACK_CATALOG if t[0] == "xtreme-tx")
    assert image["track"] == {"id": "xtreme-tx", "name": "XRP", "city": known[2], "state": known[3]}
    assert image["contact"] == {"phone": known[4], "email": known[5], "website": "https://own.example"}
    assert text["track"] == {"id": "xtreme", "name": "XRP", "city": None, "state": None} and text["contact"] == e["contact"]


def test_upsert_of_nothing(spark):
    assert upsert(spark.createDataFrame([], INPUT)).count() == 0


def test_problems():
    assert list(problems(event(), EVENT_SCHEMA)) == []
    bad = event() | {"confidence": True, "event_type": "x", "classes": [1], "series": 3}
    del bad["title"]
    assert sorted(problems(bad, EVENT_SCHEMA)) == sorted([("$", "missing required property 'title'"), ("$.event_type", f"expected one of {EVENT_SCHEMA['properties']['event_type']['enum']}, got 'x'"), ("$.confidence", "expected number, got bool"), ("$.classes[0]", "expected string, got int"), ("$.series", "expected string or null, got int")])
    formats = {"properties": {f: {"type": "string", "format": f} for f in ("date", "date-time", "uuid", "uri", "email", "other")}, "additionalProperties": False}
    good = {"date": "2026-5-1", "date-time": "2026-05-01T00:00:00Z", "uuid": "{12345678123456781234567812345678}", "uri": "https://a", "email": "a@b.c", "other": "?"}
    assert list(problems(good, formats)) == []
    assert [m for _, m in problems({k: "no" for k in good} | {"more": 1}, formats)] == ["unexpected property 'more'", *[f"expected {k} string" for k in ("date", "date-time", "uuid", "uri", "email")]]
    assert list(problems(1, {"$ref": "#/a/b"})) == [("$", "unresolved ref '#/a/b'")]
    assert list(problems(1, {"$ref": "http://x"})) == [("$", "unsupported ref 'http://x'")]
    assert list(problems("ab", {"pattern": "a"})) == [("$", "must match pattern 'a'")]
    assert list(problems(float("nan"), {"type": "number", "minimum": 0})) == []


def test_validate(spark):
    df = spark.createDataFrame([(0, json.dumps(event())), (1, "{"), (2, None)], "seq long, payload string")
    assert [(r["seq"], r["path"]) for r in validate(df, EVENT_SCHEMA).orderBy("seq").collect()] == [(1, "$[1]"), (2, "$[2]")]


def held_against_problems(spark, schema, values):
    """The compiled schema gives what problems() does, and runs no Python."""
    rows = [(n, json.dumps(v)) for n, v in enumerate(values)]
    out = validate(spark.createDataFrame(rows, "seq long, payload string"), schema)
    assert not any(w in out._jdf.queryExecution().executedPlan().toString() for w in ("Arrow", "Python", "Pandas"))
    assert sorted(map(tuple, out.collect())) == sorted((n, p, m) for n, v in enumerate(values) for p, m in problems(v, schema, f"$[{n}]"))


def test_compiled_events(spark):
    bad = event() | {"confidence": True, "event_type": "x'y", "classes": [1, "a", None], "series": 3, "track": {"city": 5}, "dates": [], "times": None, "notes": {"a": 1}}
    del bad["title"]
    held_against_problems(spark, EVENT_SCHEMA, [event(), bad, {}, [], None, "x", 1, 1.5, True, event() | {"confidence": 7}, event() | {"confidence": -0.5, "fees": {"entry": 3}}, event() | {"event_type": 4}])


def test_compiled_formats(spark):
    texts = {
        "date": ["2026-05-01", "2026-5-1", "2026-02-30", "0000-01-01", "2026-13-01", " 2026-05-01", "2026-05-01\n", "26-05-01"],
        "date-time": ["2026-05-01T00:00:00Z", "2026-05-01", "20260501T101112", "2026-05-01 10:11", "2026-05-01T10:11:12.5+02:00", "2026-05-01T25:00", "2026-02-30T10:00", "2026-W20-3", "2026-05-01T10:00:00+0200", "x", "", "Z"],
        "uuid": ["{12345678123456781234567812345678}", "urn:uuid:12345678-1234-5678-1234-567812345678", "12345678-1234-5678-1234-56781234567", "g" * 32],
        "uri": ["https://a", "http://[bad", "http://[::1]:80/x", "a:b", "//a", "https://", "HTTP://A/b?c#d", " https://a", "x+y.z-1://h/[q]"],
        "email": ["a@b.c", "a@b", "a b@c.d", "a@b@c.d", "a@b.c\n", "\u3000a@b.c"],
        "other": ["anything"],
    }
    for name, values in texts.items():
        held_against_problems(spark, {"type": "string", "format": name}, values)
    held_against_problems(spark, {"pattern": "a|ab"}, ["a", "ab", "abc", "a\n", 5])


def test_compiled_rules(spark):
    schema = {
        "definitions": {"n": {"type": ["integer", "null"], "minimum": 0, "maximum": 10}},
        "properties": {"a": {"$ref": "#/definitions/n"}, "b": {"items": {"$ref": "#/definitions/n"}}, "c": {"enum": [1, "x", None, True]}, "d": {"$ref": "#/no"}, "e": {"$ref": "http://x"}, "f": {"items": {"items": {"type": "boolean"}}}},
        "additionalProperties": False, "required": ["a", "it's"],
    }
    values = [{"a": a} for a in (0, 10, 11, -1, None, 1.0, 2.5, "1", True, [], {}, 12345678901234567890)] + [{"b": [1, "x", 2.5, None, [1]]}, {"c": 1}, {"c": 1.0}, {"c": "x"}, {"c": "y\n'"}, {"c": "it\"'s"}, {"c": None}, {"c": False}, {"c": 2.5}, {"d": 1, "e": 1}, {"f": [[True], [0, "x"], 5]}, {"z'": 1, "y": 2, "it's": 3}]
    held_against_problems(spark, schema, values)


def test_texts_that_are_no_json(spark):
    texts = ["", " ", "{", "x", "1 2", "1,2", "1] [2", "1} x", "{} x", '{"a":1,"a":2}', "NaN", "nul"]
    got = validate(spark.createDataFrame(list(enumerate(texts)), "seq long, payload string"), {"type": "integer"}).collect()
    assert sorted(map(tuple, got)) == [(n, f"$[{n}]", "invalid JSON") for n in range(len(texts))]
    good = [" 1 ", "\t2\n"]
    assert validate(spark.createDataFrame(list(enumerate(good)), "seq long, payload string"), {"type": "integer"}).count() == 0


def test_schema_of_itself(spark):
    schema = {"properties": {"next": {"$ref": "#"}, "v": {"type": "integer"}}, "definitions": {}}
    tree = {"definitions": {"t": {"properties": {"next": {"$ref": "#/definitions/t"}, "v": {"type": "integer"}}}}, "$ref": "#/definitions/t"}
    rows = [(0, json.dumps({"v": 1, "next": {"v": 2, "next": {"v": "x"}}})), (1, "{")]
    got = validate(spark.createDataFrame(rows, "seq long, payload string"), tree).orderBy("seq").collect()
    assert [r["path"] for r in got] == ["$[0].next.next.v", "$[1]"] and "unsupported" in next(problems({"next": 1}, schema))[1]


@pytest.mark.parametrize(
    "entry, field",
    [({"name": " "}, "name"), ({"url": "ftp://x"}, "url"), ({"enabled": "yes"}, "enabled"), ({"strategy": "x"}, "strategy"), ({"max_pages": True}, "max_pages"), ({"max_pages": 0}, "max_pages"), ({"page_delay_seconds": -1}, "page_delay_seconds"), ({"request_headers": {"a": 1}}, "request_headers"), ({"strategy": "bracketraces"}, "event_pages"), ({"strategy": "bracketraces", "event_pages": ["a"]}, "event_pages"), ({"drag_racing_url": "x", "strategy": "racingjunk"}, "drag_racing_url")],
)
def test_sources_config(entry, field):
    good = {"name": "n", "url": "https://x", "strategy": "rss"}
    assert check_sources([good, good | {"enabled": False}]) == [good]
    with pytest.raises(ConfigError, match=rf"sources\[0\]\.{field} "):
        check_sources([good | entry])


def test_tracks_config():
    good = {"name": "n", "url": "https://x", "state": "TX"}
    assert check_tracks([good]) == [good]
    for bad in ({}, [1], [good | {"state": "Tx"}]):
        with pytest.raises(ConfigError):
            check_tracks(bad)


def test_run_summary(spark):
    runs = spark.createDataFrame([(0, "success", "10"), (1, "error", "999"), (2, "success", "20"), (3, "success", "?")], "ord long, status string, elapsed_seconds string")
    r = A.run_summary(runs).first()
    assert (r["recorded_runs"], r["successful_runs"], r["average_seconds"], r["median_seconds"], r["min_seconds"], r["max_seconds"], r["p95_seconds"], r["last_status"]) == (4, 3, 15, 15, 10, 20, 20, "success")
    short = A.run_summary(runs.filter("status = 'error'")).first()
    assert short["recorded_runs"] == 1 and short["average_seconds"] is None


def test_paging_stops(spark):
    cards = spark.createDataFrame([("s", 1, "a", 0), ("s", 1, "", 1), ("s", 2, "b", 2), ("s", 2, "a", 3), ("s", 3, "a", 4), ("s", 4, "c", 5), ("t", 1, "old", 6), ("t", 2, "z", 7), ("u", 1, "x", 8), ("u", 3, "y", 9)], "source string, page long, title string, ord long")
    got = A.take_pages(cards, seen=spark.createDataFrame([("old",)], "title string")).orderBy("ord").collect()
    assert [r["title"] for r in got] == ["a", "b", "x"]


def test_unseen(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("a", 0), ("", 3), (None, 4)], "key string, ord int")
    assert {tuple(r) for r in A.unseen(df, "key", "ord", spark.createDataFrame([("b",)], "key string")).collect()} == {("a", 0)}


def test_sync_plan(spark):
    e = spark.createDataFrame([(0, "id1longer", "a.jpg"), (1, "id2longer", "a.jpg"), (2, "id3", "b.txt"), (3, "id4", "c.PNG"), (4, "id1longer", "d.png")], "ord int, file_id string, title string")
    got = A.sync_plan(e, spark.createDataFrame([("id4",)], "file_id string"), e.limit(0), [".jpg", ".png"]).orderBy("ord").collect()
    assert [(r["action"], r["path"]) for r in got] == [("downloaded", "a.jpg"), ("downloaded", "a-id2longe.jpg"), ("skipped_non_image", None), ("skipped_known", None), ("skipped_known", None)]


def test_lookup(spark):
    df = spark.createDataFrame([("xrp",), ("Big Kil Kare Night",), (None,), ("x-the strip.",), ("mirth",)], "name string")
    assert {r["name"]: r["canonical"] for r in resolve(df, "name", alias_table(spark)).collect()} == {"xrp": "Xtreme Raceway Park", "Big Kil Kare Night": "Kil-Kare Raceway", None: None, "x-the strip.": "The Strip at Las Vegas Motor Speedway", "mirth": "mirth"}
    assert {r["name"]: r["canonical"] for r in resolve(df, "name", alias_table(spark), most=3).collect()} == {r["name"]: r["canonical"] for r in resolve(df, "name", alias_table(spark)).collect()}
    t = spark.createDataFrame([(("xtreme", "", None, "OK"), ("", None, "w")), (("no", "n", None, None), None)], "track struct<id:string,name:string,city:string,state:string>, contact struct<phone:string,email:string,website:string>")
    a, b = backfill(t, catalog_table(spark)).orderBy("track.id").collect()
    assert tuple(a["track"]) == ("no", "n", None, None) and a["contact"] is None
    assert tuple(b["track"]) == ("xtreme-tx", "Xtreme Raceway Park", "Ferris", "OK") and tuple(b["contact"]) == ("972-544-3724", None, "w")


def test_many_aliases(spark):
    """Ten thousand aliases in one automaton, against each alias' own pattern."""
    rng = random.Random(2)
    letters = "ab1 -é."
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.choice([2, 3, 4, 5, 6, 7]))).strip() for _ in range(14_000)} - {""})
    rng.shuffle(words)
    aliases = [(n, w, f"C{n % 700}") for n, w in enumerate(words[:10_000])]
    names = ["".join(rng.choice(letters) for _ in range(rng.choice([3, 8, 15]))) for _ in range(60)] + words[:5] + ["", "ZZ", None]
    table = spark.createDataFrame(aliases, "ord int, alias string, canonical string")

    def plain(name):
        if name is None:
            return None
        text = name.strip().lower()
        if (c := {a: c for _, a, c in aliases}.get(text)) is not None:
            return c
        return next((c for _, a, c in aliases if len(a) >= 4 and a in text and re.search(rf"(^|[^a-z0-9]){re.escape(a)}([^a-z0-9]|$)", text)), name)

    df = spark.createDataFrame(list(enumerate(names)), "n int, name string")
    want = {n: plain(x) for n, x in enumerate(names)}
    assert dict(resolve(df, "name", table).select("n", "canonical").collect()) == want
    assert dict(resolve(df.withColumnRenamed("name", "canonical"), "canonical", table).select("n", "canonical").collect()) == want


def test_copies_of_a_hash_are_matched_once(spark):
    df = spark.createDataFrame([(n, "0" * 16 if n < 300 else "f" * 16) for n in range(320)], "k int, phash string")
    out = hash_join(df, df.filter("k >= 290"), distance=5)
    assert out.count() == 300 * 10 + 20 * 20 and out.columns == ["l_k", "l_phash", "r_k", "r_phash"]
