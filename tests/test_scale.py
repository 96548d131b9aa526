"""Joins whose sides are spread to many rows: what Spark takes to be small is not broadcast."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import duckdb
from pyspark.sql import functions as F

from eventloom.operators import joins as J
from eventloom.operators.graph import components


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_spread_ranges_are_not_broadcast(spark):
    df = spark.range(50).select(F.col("id").alias("k"), F.date_add(F.lit(date(2026, 1, 1)), F.col("id").cast("int")).alias("start")).withColumn("end", F.date_add("start", 400))
    out = J.overlap_join(df, df)
    assert "SortMergeJoin [k_#" in plan(out)
    assert out.count() == 50 * 50


def test_distant_hashes_meet_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(J, "TILE", 16)
    rng = random.Random(7)
    base = [rng.getrandbits(64) for _ in range(15)]
    hashes = base + [b ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(30))) for b in base for _ in range(5)]
    rows = [(n, f"{h:016x}") for n, h in enumerate(hashes)] + [(900, f"{hashes[0]:016X}"), (999, None)]
    df = spark.createDataFrame(rows, "k int, phash string")
    out = J.hash_join(df, df, distance=20)
    assert "SortMergeJoin [i_#" in plan(out)
    got = sorted((r["l_k"], r["r_k"]) for r in out.collect())
    assert got == sorted((a, b) for a, x in rows[:-1] for b, y in rows[:-1] if (int(x, 16) ^ int(y, 16)).bit_count() <= 20)


def test_near_hashes_are_not_broadcast(spark):
    rows = [(n, f"{n * 0x9E3779B97F4A7C15 % (1 << 64):016x}") for n in range(30)]
    df = spark.createDataFrame(rows, "k int, phash string")
    out = J.hash_join(df, df, distance=10)
    assert "SortMergeJoin [k_#" in plan(out)
    assert {(a, a) for a, _ in rows} <= {(r["l_k"], r["r_k"]) for r in out.collect()}


def test_estimates_stay_small_over_rounds(spark):
    chain = spark.range(1, 60).select((F.col("id") * 37 % 60).alias("a"), ((F.col("id") + 1) * 37 % 60).alias("b")).filter("b <> 0")
    labels = components(spark.range(60).toDF("id"), chain)
    assert int(str(labels._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 1 << 30
    assert {r["component"] for r in labels.filter("id > 0").collect()} == {1}


def test_short_and_long_ranges_overlap_without_their_units_in_the_shuffle(spark):
    rng, base = random.Random(3), date(2020, 1, 1)
    rows = [(n, s := base + timedelta(rng.randrange(900)), s + timedelta(rng.choice([-9, 0, 3, 30, 100, 700]))) for n in range(60)]
    df = spark.createDataFrame(rows, "k int, start date, end date")
    for left, right in ((df.filter("datediff(end, start) <= 3"), df), (df, df.filter("datediff(end, start) <= 30"))):
        out = J.overlap_join(left, right)
        assert not any("l_a_#" in line for line in plan(out).splitlines() if "SortMergeJoin" in line)
        sides = [{r["k"]: (r["start"], r["end"]) for r in x.collect()} for x in (left, right)]
        want = sorted((a, b) for a, (s, e) in sides[0].items() for b, (t, f) in sides[1].items() if s <= f and t <= e)
        assert sorted((r["l_k"], r["r_k"]) for r in out.collect()) == want


def test_least_same_event_makes_no_pairs(spark, monkeypatch):
    """F8: on a crowded track each node keeps the least known record, so the rows met don't grow with the square of its records."""
    monkeypatch.setattr(J, "CROWDED", 16)
    rng, base = random.Random(4), date(2020, 1, 1)
    rows = [(n, "tulsa", rng.choice(["", "TX", "OK"]), rng.choice(["spring open", "open spring finals", "finals"]), s := base + timedelta(rng.randrange(40)), s + timedelta(rng.choice([0, 2, 9, 70]))) for n in range(400)]
    df = spark.createDataFrame(rows, "id int, track_key string, state string, title_key string, start date, end date")
    new, known = df.filter("id % 2 = 0"), df.filter("id % 2 = 1")
    pairs, plain = [], J.overlap_join
    monkeypatch.setattr(J, "overlap_join", lambda *a, **b: pairs.append(plain(*a, **b)) or pairs[-1])
    got = {r["id"]: r["match"] for r in J.find_same_event(new, known, order="id").collect()}
    alike = lambda a, b: a in b or b in a or len(set(a.split()) & set(b.split())) > 1
    want = {a[0]: min((b[0] for b in rows if b[0] % 2 and alike(a[3], b[3]) and not (a[2] and b[2] and a[2] != b[2]) and a[4] <= b[5] and b[4] <= a[5]), default=None) for a in rows if a[0] % 2 == 0}
    assert got == {k: v for k, v in want.items() if v is not None}
    assert sum(p.count() for p in pairs) == 0


def test_totals_of_overlaps_make_no_pairs(spark, monkeypatch):
    """sums over overlapping ranges are running sums by day; only ranges that end before they start are joined."""
    monkeypatch.setattr(J, "BLOCK", 4)
    rng, base = random.Random(5), date(1969, 6, 1)
    day = lambda: base + timedelta(rng.randrange(900))
    rows = [(n, s := day(), rng.choice([None, s + timedelta(rng.choice([0, 3, 90, 4000]))]), rng.randrange(-1, 4)) for n in range(120)] + [(n, None, day(), 1) for n in (900, 901)] + [(950, date(1, 1, 1), date(9999, 12, 31), 2)]
    back = [(n, s := day(), s - timedelta(rng.choice([1, 9, 200])), 1) for n in range(200, 220)]
    frame = lambda x: spark.createDataFrame(x, "k int, start date, end date, v int")
    pairs, plain = [], J.overlap_join
    monkeypatch.setattr(J, "overlap_join", lambda *a, **b: pairs.append(1) or plain(*a, **b))
    for left, right in ((rows, rows), (rows + back, rows), (rows, rows + back), (rows + rows[:3] + back, rows + back)):
        met = lambda a, b: a[1] and b[1] and a[1] <= (b[2] or b[1]) and b[1] <= (a[2] or a[1])
        want = sorted((a[0], sum(b[3] for b in right if met(a, b))) for a in left if any(met(a, b) for b in right))
        assert sorted((r["k"], r["total"]) for r in J.overlap_totals(frame(left).drop("v"), frame(right), "v").collect()) == want
        assert bool(pairs) == (len(left) + len(right) > 2 * len(rows))


def test_wide_ranges_are_not_joined_with_orders(spark, tmp_path, monkeypatch):
    """q06c makes no pairs of customers and orders, and gives its SQL's rows where a customer stands twice and days are missing."""
    from eventloom.plans import catalogue

    base = datetime(1996, 3, 1)
    spark.createDataFrame([(n % 40, float(n * 37 % 900) if n % 7 else None) for n in range(60)] + [(None, 5.0)], "c_custkey long, c_acctbal double").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(n if n % 9 else None, base + timedelta(n * 13 % 700) if n % 11 else None) for n in range(1, 200)], "o_orderkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    joined, plain = [], J.overlap_join
    for module in (J, catalogue):
        monkeypatch.setattr(module, "overlap_join", lambda *a, **b: joined.append(1) or plain(*a, **b))
    got = sorted(map(tuple, catalogue.q06c(spark, str(tmp_path)).collect()))
    con = duckdb.connect()
    for name in ("customer", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert got == sorted(con.execute(catalogue.ORACLE_SQL["q06c_wide_ranges"]).fetchall()) and got and not joined
