"""Resampling, spelling groups and exact top-k against plain versions, SQL, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventloom.llm import resample, spelling, topk
from eventloom.llm.registry import ORACLE_SQL, QUERIES

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.mark.parametrize("name", ["op11_resampling", "op12_spelling", "op13_topk"])
def test_sql(name, same_rows):
    same_rows(QUERIES[name], ORACLE_SQL[name])


# Resampling


def plain_scores(docs, target, percent=25, least=20):
    """(doc_id, n_features, weight, score, rank) of each (doc_id, text), without Spark."""

    def features(text):
        w = WORD.findall((text or "").translate(LOW))
        return [zlib.crc32(f.encode()) % 10_000 for f in [*w, *map(" ".join, zip(w, w[1:]))]], len(w)

    own, goal = [features(t) for _, t in docs], Counter(g for t in target for g in features(t)[0])
    raw = Counter(g for f, _ in own for g in f)
    s, t = sum(raw.values()), sum(goal.values())
    gain = lambda g: math.floor(1000 * math.log((goal[g] + 1) * (s + 10_000) / ((raw[g] + 1) * (t + 10_000))))
    rows = []
    for (i, _), (f, n) in zip(docs, own):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= least])
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k + 1 for k, r in enumerate(order[: len(order) * percent // 100])}
    return [(*r[:4], rank.get(id(r))) for r in rows]


def test_resampling_odd_rows(spark):
    rng = random.Random(1)
    words = ["Été", "the", "x1", "ÀB", "über", "ß", "of", "İ", "😀", "ab"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "\n", "-", ".. ", "_", "\x00", "\x7f"]) for _ in range(n))
    docs = [(k, text(rng.choice([0, 1, 2, 19, 20, 21, 60, 400]))) for k in range(120)] + [(200, None), (201, ""), (202, " \t.."), (203, "one"), (None, text(30)), (None, None), (204, text(60_000)), (205, "a" * 300_000), (-7, text(25))]
    docs += [(300, "same words " * 15)] * 4
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("?") for c in ("rid", "w", "pos", "g1", "weight", "rank", "doc_", "n")})
    goal = spark.createDataFrame([("the of Été über",), (None,), ("x1 x1 x1 of",)], "text string")
    got = resample.resample_scores(df.repartition(5), goal).collect()
    assert Counter(map(tuple, got)) == Counter(plain_scores(docs, ["the of Été über", None, "x1 x1 x1 of"]))
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, sum(r["rank"] is not None for r in got) + 1))


def test_resampling_empty_and_kept_columns(spark):
    docs = spark.createDataFrame([(k, f"alpha beta {k} " * 10, "s", "?") for k in range(40)], "doc_id long, text string, source string, Score string")
    goal = docs.select("text").limit(0)
    assert resample.resample_scores(docs.limit(0), goal).count() == 0
    assert Counter(map(tuple, resample.resample_scores(docs, goal).collect())) == Counter(plain_scores([(r.doc_id, r.text) for r in docs.collect()], []))
    drawn = resample.resample(docs, docs.filter("doc_id = 3").select("text"))
    assert drawn.columns == ["doc_id", "text", "source", "weight", "score", "rank"] and drawn.count() == 10
    assert resample.resample_scores(docs, goal, orders=3).agg(F.min("n_features")).first()[0] == 30 + 29 + 28


# Spelling


def plain_near(words):
    """Pairs of distinct words at one edit, each once."""
    out, known = set(), set(words)
    for w in words:
        for i in range(len(w)):
            less = w[:i] + w[i + 1 :]
            if less in known:
                out.add(tuple(sorted((w, less))))
    by = {}
    for w in words:
        for i in range(len(w)):
            by.setdefault((i, len(w), w[:i] + w[i + 1 :]), []).append(w)
    for same in by.values():
        out |= {tuple(sorted((a, b))) for a in same for b in same if a != b}
    return out


def as_words(spark, words):
    return spark.createDataFrame([(k, w, 5, len(w)) for k, w in enumerate(words)], "wid long, w string, n long, len int")


@pytest.mark.parametrize("letters", ["ab", "abcdéÿ"])
def test_near_pairs(spark, letters):
    rng = random.Random(letters)
    words = sorted({"".join(rng.choice(letters) for _ in range(rng.choice([7, 8, 9]))) for _ in range(500)} | {"a" * n for n in range(7, 40)} | {"a" * 8 + c for c in letters} | {"a" * 3000, "a" * 3001, "a" * 1500 + "b" + "a" * 1500, "b" + "a" * 2999})
    got = [tuple(sorted((words[a], words[b]))) for a, b in spelling.near_pairs(as_words(spark, words)).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_near(words)


def test_very_long_words(spark):
    words = ["x" * 60_000, "x" * 60_001, "x" * 30_000 + "y" + "x" * 29_999, "z" + "x" * 60_000, "x" * 30_000]
    got = {(a, b) for a, b in spelling.near_pairs(as_words(spark, words)).collect()}
    assert {tuple(sorted(p)) for p in got} == {(0, 1), (0, 2), (0, 3), (1, 3)}


def test_spelling_without_told_children(spark, monkeypatch):
    """Small bounds for what is broadcast change nothing."""
    words = sorted({"".join(p) for p in zip("abcdefghij" * 30, "klmnopq" * 50, "x" * 300, "yz" * 150, "uvw" * 100, "s" * 300, "t" * 300)})
    monkeypatch.setattr(spelling, "HOT", 2)
    monkeypatch.setattr(spelling, "TOLD", -10)
    got = {tuple(sorted((words[a], words[b]))) for a, b in spelling.near_pairs(as_words(spark, words)).collect()}
    assert got == plain_near(words)


def test_trie_edges_are_few(spark):
    """A word puts at most log2(words) light edges into the merged tries, whatever the alphabet."""
    words = sorted({"".join(random.Random(k).choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for k in range(2000)})
    path = spelling.edges(as_words(spark, words)).toPandas()
    size = path.groupby(["node", "c"]).size().reset_index(name="n")
    heavy = size[size.c != 0].sort_values(["n", "c"], ascending=[False, True]).drop_duplicates("node")[["node", "c"]].rename(columns={"c": "h"})
    light = path.merge(heavy, on="node").query("c != h").groupby("wid").size()
    assert light.max() <= math.log2(len(words)) + 1


def test_spelling_odd_rows(spark):
    def plain(docs):
        n = Counter()
        for i, t in docs:
            for run in re.findall(r"[A-Za-zÀ-ÿ]+", t or ""):
                run = run.translate(LOW)
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                n[run] += 1
        n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}
        near = {w: [] for w in n}
        for a, b in plain_near(list(n)):
            near[a].append(b)
            near[b].append(a)
        form = {}
        for w, others in near.items():
            best = min(others, key=lambda o: (-n[o], o), default=None)
            if best and n[best] >= 10 * n[w]:
                form[w] = best
        out = []
        for w in n:
            root = w
            while root in form:
                root = form[root]
            out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
        return Counter(out)

    chain = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij"]
    text = " ".join(w for k, w in enumerate(chain) for _ in range(2 * 11**k // 2 + 2)) + " "
    docs = [(1, text), (None, "abcdefz ABCDEFZ abcdefz."), (2, None), (3, ""), (4, "x" * 1000 + " " + "x" * 999), (5, "x" * 1000 + "-" + "x" * 999), (6, "Éabcdef÷ éabcdef÷ Éabcdef÷ Ōabcdefgh"), (6, "Éabcdef÷ éabcdef÷ Éabcdef÷ Ōabcdefgh"), (7, "straße straßen straßer Straße straßen straßer " * 3)]
    docs += [(k, "company Company companny compamy " * 5) for k in range(10, 60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("?") for c in ("w", "n", "wid", "len", "word", "id_", "key")})
    assert Counter(map(tuple, spelling.spelling_groups(df.repartition(3)).collect())) == plain(docs)
    assert spelling.spelling_groups(df.limit(0)).count() == 0


# Top-k


def plain_top(rows, k):
    """(query_id, rank, vec_id, score) by comparing each query with all rows."""
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in ok]
    out = []
    for q in sorted({i for i, _ in whole if i % 100 == 0}):
        s = sorted((-min(max(sum(a * b for a, b in zip(v, w)), -(1 << 63)), (1 << 63) - 1), j) for i, v in whole if i == q for j, w in whole if j != q and len(v) == len(w))
        out += [(q, n + 1, j, -x) for n, (x, j) in enumerate(s[:k])]
    return out


def test_topk_over_shards(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 7)).astype(np.float32)
    x[200:500] = x[7]  # a group of equal vectors
    x[500:540] = -x[7]
    rows = [(k, [float(v) for v in x[k]]) for k in range(900)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = topk.top_k(df, df.filter("vec_id % 100 = 0"), k=10, shard_rows=100, query_block=3, leaf=4)
    assert sorted(map(tuple, got.collect())) == plain_top(rows, 10)


def test_topk_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.0]), (100, [0.0, 0.0]), (1, [1.0, -2.0]), (2, [1.0, -2.0]), (2, [1.0, -2.0]), (3, None), (4, []), (200, []), (5, [nan, 1.0]), (6, [None, 1.0]), (7, [inf, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (9, [-0.0004, 0.0004]), (300, [5.0]), (10, [0.5, 0.5]), (10, [2.0, 0.25]), (400, [2.0, 0.5]), (400, [-3.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("?") for c in ("id", "x", "query", "tile", "rank", "score", "least")})
    for shard_rows in (1000, 2):
        got = topk.top_k(df, df.filter("vec_id % 100 = 0"), k=3, shard_rows=shard_rows)
        assert sorted(map(tuple, got.collect())) == plain_top(rows, 3)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0
    assert topk.top_k(df, df.limit(0)).count() == 0


def test_topk_large_components(spark):
    rows = [(0, [3e9, 1e9]), (1, [1e9, 1e9]), (2, [1e9, 1.0000000001e9]), (3, [-1e9, 5.0]), (4, [1e30, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.filter("vec_id = 0"), k=4).collect()
    assert sorted(map(tuple, got)) == plain_top(rows, 4)


def test_best_first_visits_little():
    """The boxes cut the search short where vectors lie in clusters, and a floor from elsewhere shortens it further."""
    rng = np.random.default_rng(5)
    x = np.floor(1024 * (np.repeat(rng.normal(size=(64, 6)) * 4, 64, axis=0) + rng.normal(size=(4096, 6)) * 0.05))
    tree, q = topk.Tree(x, 64), np.floor(1024 * rng.normal(size=(20, 6)) * 4)
    seen = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            out = np.ndarray.__getitem__(self, at)
            if isinstance(at, slice):
                seen.append(at)
            return out.view(np.ndarray) if isinstance(out, np.ndarray) else out

    tree.x = tree.x.view(Counted)
    ids = np.arange(4096)[tree.rows]
    got = list(topk.search(tree, ids, np.full(20, -1), q, [None] * 20, 10))
    for (_, i, s), v in zip(got, q):
        exact = x @ v
        order = np.lexsort((np.arange(4096), -exact))[:10]
        assert i == order.tolist() and s == exact[order].astype(int).tolist()
    first = len(seen)
    assert first < 20 * 16  # of 20 * 64 leaves
    again = list(topk.search(tree, ids, np.full(20, -1), q, [g[2][-1] for g in got], 10))
    assert again == got and len(seen) - first <= first
