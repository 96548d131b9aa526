"""Ranges that overlap, names that are alike, the first same event, and the two forms of the merge, against plain versions."""

import json
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from eventloom.operators import joins as J
from eventloom.operators.upsert import Hashes, bits, merge_columns, merged, upsert
from eventloom.sources.readers import EVENT
from test_operators import event, inputs


def ranges(spark, rows):
    return spark.createDataFrame(rows, "k int, start date, end date, g int")


def test_wide_ranges(spark):
    rng = random.Random(3)
    days = [date(1, 1, 1), date(9999, 12, 31), date(1970, 1, 1), date(2026, 1, 1)] + [date(2026, 1, 1) + timedelta(rng.randrange(-400, 400)) for _ in range(60)] + [date(1900, 1, 1) + timedelta(rng.randrange(80_000)) for _ in range(20)]
    rows = [(n, rng.choice(days), rng.choice([None, *days]), n % 3) for n in range(120)] + [(500, date(1, 1, 1), date(9999, 12, 31), 1), (501, None, days[0], 1), (502, date(2026, 1, 5), date(2026, 1, 1), 1)]
    df = ranges(spark, rows)
    plain = lambda ok: sorted((a[0], b[0]) for a in rows for b in rows if a[1] and b[1] and a[1] <= (b[2] or b[1]) and b[1] <= (a[2] or a[1]) and ok(a, b))
    assert sorted((r["l_k"], r["r_k"]) for r in J.overlap_join(df, df).collect()) == plain(lambda a, b: True)
    assert sorted((r["l_k"], r["r_k"]) for r in J.overlap_join(df.filter("k % 2 = 0"), df, on=["g"]).collect()) == plain(lambda a, b: a[0] % 2 == 0 and a[3] == b[3])


def test_copies_of_a_range_are_few(spark):
    rng = random.Random(5)
    rows = [(n, *sorted((rng.randrange(1 << J.LEVELS), rng.randrange(1 << J.LEVELS)))) for n in range(200)] + [(200, 0, (1 << J.LEVELS) - 1), (201, 1, (1 << J.LEVELS) - 2), (202, 7, 7)]
    nodes = {}
    for r in J._nodes(spark.createDataFrame(rows, "k int, a int, b int"), "a", "b").collect():
        nodes.setdefault((r["k"], r["a"], r["b"]), []).append(r)
    assert len(nodes) == len(rows)
    for (_, a, b), all_ in nodes.items():
        spans = sorted((x << n["level_"], (x + 1 << n["level_"]) - 1, n["whole_"]) for n in all_ for x in [n["k_"] - (1 << (J.LEVELS - n["level_"]))])
        whole = [(p, q) for p, q, w in spans if w]
        assert whole[0][0] == a and whole[-1][1] == b and all(p[1] + 1 == q[0] for p, q in zip(whole, whole[1:]))
        assert all(p <= b and q >= a and (p < a or q > b) for p, q, w in spans if not w)
        assert len(whole) <= 2 * J.LEVELS and len(set(spans)) == len(spans) <= 4 * (J.LEVELS + 1)


def is_alike(a, b):
    return bool(a and b) and (a in b or b in a or len(set(a.split()) & set(b.split())) >= 2)


@pytest.mark.parametrize("common", [1, 64])
def test_alike_names(spark, monkeypatch, common):
    monkeypatch.setattr(J, "COMMON", common)
    rng = random.Random(common)
    words = ["park", "drag", "strip", "dragstrip", "a", "ab", "raceway", "bay", "é", "north"]
    draw = lambda n: sorted({" ".join(rng.choices(words, k=rng.choice([1, 1, 2, 3, 4]))) for _ in range(n)} | {"a", "é", "ab", "park park"})
    left, right = draw(120), draw(90)
    got = J.alike_names(*(spark.createDataFrame([(x,) for x in side], "name string") for side in (left, right))).collect()
    assert sorted(map(tuple, got)) == sorted((a, b) for a in left for b in right if is_alike(a, b))


@pytest.mark.parametrize("crowded", [2, 256])
def test_find_same_event(spark, monkeypatch, crowded):
    monkeypatch.setattr(J, "CROWDED", crowded)
    rng = random.Random(crowded)
    tracks, titles = ["tulsa", "tulsa raceway", "bay north strip", "north bay", "bay", "", None, "xtreme"], ["spring open finals", "open", "finals spring", "winter", "open finals", "", None]
    record = lambda n: (n, rng.choice(tracks), rng.choice(["TX", "tx", "OK", "", None]), rng.choice(titles), d := rng.choice([None, *[date(2026, 1, 1) + timedelta(rng.randrange(30))] * 9]), rng.choice([None, d and d + timedelta(rng.randrange(-1, 400))]))
    new, known = [record(n) for n in range(150)], [record(n) for n in range(1000, 1150)] + [(2000 + n, "tulsa", "TX", "open", date(2026, 1, 3), None) for n in range(300)]
    schema = "id int, track_key string, state string, title_key string, start date, end date"

    def same(a, b):
        up = lambda s: (s or "").upper()
        return not (up(a[2]) and up(b[2]) and up(a[2]) != up(b[2])) and a[4] and b[4] and a[4] <= (b[5] or b[4]) and b[4] <= (a[5] or a[4]) and is_alike(a[1], b[1]) and is_alike(a[3], b[3])

    got = J.find_same_event(spark.createDataFrame(new, schema), spark.createDataFrame(known, schema).withColumnRenamed("id", "ord")).collect()
    want = {a[0]: next((b[0] for b in known if same(a, b)), None) for a in new}
    assert sorted(map(tuple, got)) == sorted((k, v) for k, v in want.items() if v is not None)
    empty = spark.createDataFrame([], schema)
    assert J.find_same_event(empty, empty, order="id").count() == 0


def test_copies_are_one_class(spark):
    """Ten thousand copies of a record make one class, and no pair with each other."""
    rows = [(n, "tulsa", "", "open", date(2026, 1, 3), None) for n in range(10_000)] + [(20_000, "tulsa raceway", "", "open", date(2026, 1, 3), None)]
    members, pairs = J.event_classes(spark.createDataFrame(rows, "id long, track_key string, state string, title_key string, start date, end date"))
    assert members.select("cid").distinct().count() == 2 and [tuple(r) for r in pairs.collect()] == [(0, 20_000)]


def test_a_chain_in_waves(spark):
    """Each record meets the one before it only; a wave's task reads its own rows and the records that they can meet."""
    import eventloom.operators.upsert as U

    rows = [{"e": event(start=str(date(2026, 1, 1) + timedelta(2 * n)), end=str(date(2026, 1, 1) + timedelta(2 * n + 2)))} for n in range(300)]
    seen, plain = [], U._wave
    U._wave = lambda df, distance: (seen.append(df.count()), plain(df, distance))[1]
    try:
        got = {r["seq"]: r for r in upsert(inputs(spark, rows), wave=50).collect()}
    finally:
        U._wave = plain
    assert [got[n]["outcome"] for n in range(300)] == ["new"] + ["merged"] * 299
    assert len(json.loads(got[0]["payload"])["flyers"]) == 300 and seen == [50] + [51] * 5


def test_bad_inputs_are_errors(spark):
    df = inputs(spark, [{"kind": "event", "e": event(id="x")}, {"e": event()}, {"e": event()}, {"e": event()}, {"e": event()}])
    bad = {1: "no json", 2: "[1]", 3: json.dumps({"track": "Tulsa", "title": 5, "dates": []}), 4: '{"title": '}
    df = df.withColumn("payload", F.coalesce(F.create_map(*[x for k, v in bad.items() for x in (F.lit(k).cast("long"), F.lit(v))])[F.col("seq")], "payload"))
    assert {r["seq"]: r["outcome"] for r in upsert(df).collect()} == {0: None, 1: "error", 2: "error", 3: "error", 4: "error"}
    unread = upsert(df.withColumn("kind", F.lit("event"))).collect()
    assert {r["seq"]: r["payload"] for r in unread if r["seq"] in (1, 4)} == {1: "no json", 4: '{"title": '}


@pytest.mark.parametrize("distance", [0, 3, 10, 20])
def test_hashes(distance):
    rng = random.Random(distance)
    known = Hashes(distance)
    texts = [f"{rng.getrandbits(64):016x}" for _ in range(3000)]
    for t in texts:
        known.add(t)
    for _ in range(60):
        t = f"{int(rng.choice(texts), 16) ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(30))):016x}"
        assert known.near(t) == any(bits(t, x) <= distance for x in texts)


def test_both_merges_agree(spark):
    """merge_columns() gives what merged() does, whatever is missing or empty."""
    rng = random.Random(11)
    some = lambda *x: rng.choice([None, "", *x])
    names = ("XRP", "xrp at night", " Tulsa Raceway Park ", "Bay", "The Dragstrip")

    def record(n):
        part = lambda *keys: {k: some(f"{k}{n}") for k in keys}
        return {
            "id": f"i{n}", "title": some("T", "U"), "event_type": some("bracket"), "series": some("S"), "notes": some("n"), "track": {"id": None, "name": some(*names), "city": some("C"), "state": some("TX", "ok")},
            "dates": {"start": some("2026-01-01"), "end": some("2026-01-02")}, "times": part("gates_open", "registration_opens", "race_start"), "fees": part("entry", "spectator"), "contact": part("phone", "email", "website"),
            "classes": rng.choice([None, [], ["Pro"], ["Super", "Pro"]]), "confidence": rng.choice([None, 0.0, 0.5, 0.9]), "unclear_fields": None, "flyers": rng.choice([None, [{"file": "a", "phash": None, "processed_at": "t"}]]), "created_at": "c", "updated_at": "u",
        }

    pairs = [(record(n), record(-n)) for n in range(1, 80)]
    flyer = {"file": "f", "phash": None, "processed_at": "now"}
    df = spark.createDataFrame([(n, *map(json.dumps, p)) for n, p in enumerate(pairs)], "n int, a string, b string").select("n", F.from_json("a", EVENT).alias("a"), F.from_json("b", EVENT).alias("b"))
    out = df.select("n", F.to_json(merge_columns(F.col("a"), F.col("b"), F.struct(F.lit("f").alias("file"), F.lit(None).cast("string").alias("phash"), F.lit("now").alias("processed_at")), F.lit("now")), {"ignoreNullFields": "false"}).alias("m"))
    for r in out.collect():
        got, want = json.loads(r["m"]), merged(*pairs[r["n"]], flyer, "now")
        assert {k: got[k] or None for k in got} == {k: want[k] or None for k in got}
