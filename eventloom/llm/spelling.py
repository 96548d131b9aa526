"""Spelling variants one edit apart, by an errata trie whose light subtrees are merged with one letter skipped or replaced."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, table
from .resample import CRC32, UPPER, ascii_lower, crc32_sql

#: Base of the path hashes, and the code that stands for any letter; letters are code points.
BASE, ANY = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x7FFFFFFF)
#: A child that holds this part of all words is told to the tasks beforehand.
HOT = 1000
#: Hot heavy children are told only if they are no more than this.
TOLD = 100_000


def powers(n: int) -> np.ndarray:
    """BASE to the powers 0..n, modulo 2^64."""
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, BASE, np.uint64), dtype=np.uint64)])


def edges(words: DataFrame) -> DataFrame:
    """A row for each node that a word passes: the path so far as a hash, the next letter (0 at the word's end) and the one after.

    A path's hash is a polynomial modulo 2^64; two paths with one hash would only share their choice of a heavy
    child, which changes what is searched from which side and no result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            chars = np.cumsum(whole["len"].to_numpy())
            for part in np.split(np.arange(whole.num_rows), np.searchsorted(chars, np.arange(1 << 17, int(chars[-1]) if len(chars) else 0, 1 << 17))):
                if not len(part):
                    continue
                b = whole.slice(int(part[0]), len(part))
                length = b["len"].to_numpy().astype(np.int64)
                codes = np.frombuffer("".join(b["w"].to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int32)
                first = np.r_[0, np.cumsum(length)[:-1]]
                most = int(length.max())
                # A word has length + 1 nodes; node i of word k stands at at[k] + i.
                at = first + np.arange(len(length))
                node = np.empty(int(length.sum()) + len(length), np.uint64)
                now, order = np.ones(len(length), np.uint64), np.argsort(-length, kind="stable")
                live = np.searchsorted(-length[order], -np.arange(most + 1), side="right")
                for i in range(most + 1):
                    k = order[: live[i]]
                    node[at[k] + i] = now[k]
                    k = k[length[k] > i]
                    now[k] = now[k] * BASE + codes[first[k] + i].astype(np.uint64)
                word = np.repeat(np.arange(len(length)), length + 1)
                i = np.arange(len(node)) - at[word]
                ahead = lambda step: np.where(i + step < length[word], codes[np.minimum(first[word] + i + step, len(codes) - 1)], 0)  # noqa: B023, E731
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node.view(np.int64)), pa.array(ahead(0).astype(np.int32)), pa.array(ahead(1).astype(np.int32)), pa.array(b["wid"].to_numpy()[word]), pa.array(length[word].astype(np.int32)), pa.array(i.astype(np.int32)), pa.array(now[word].view(np.int64))],
                    ["node", "c", "c2", "wid", "len", "i", "hash"],
                )

    return words.select("wid", "w", "len").mapInArrow(run, "node long, c int, c2 int, wid long, len int, i int, hash long")


def errata(light: DataFrame, least: int) -> DataFrame:
    """What light edges put into the merged tries: (key, wid, merged), key a hash of a whole spelling.

    For a word with a light child c at a node whose heavy child is h: the word without c (unless c is doubled, so
    that a run of one letter is shortened at its end only), with h for c, with h before c; and, merged, with any
    letter for c, where the words of other light children coincide with it. At a word's end: the word with h added.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pw = powers(64)
        for b in batches:
            if not b.num_rows:
                continue
            node, h, whole = (b[c].to_numpy().view(np.uint64) for c in ("node", "h", "hash"))
            c, c2, wid, length, i = (b[x].to_numpy() for x in ("c", "c2", "wid", "len", "i"))
            rest = length.astype(np.int64) - i
            if rest.max() + 2 > len(pw):
                pw = powers(int(rest.max()) + 2)
            ends, uc = c == 0, c.astype(np.uint64)
            below = pw[np.maximum(rest - 1, 0)]
            suffix = whole - node * pw[rest] - uc * below
            out = [
                (node * below + suffix, ~ends & (c2 != c) & (length > least), False),
                (node * pw[rest] + h * below + suffix, ~ends, False),
                (node * pw[rest + 1] + h * pw[rest] + (whole - node * pw[rest]), np.ones(len(c), bool), False),
                (node * pw[rest] + ANY * below + suffix, ~ends, True),
            ]
            for key, which, merged in out:
                n = int(which.sum())
                if n:
                    yield pa.RecordBatch.from_arrays([pa.array(key[which].view(np.int64)), pa.array(wid[which]), pa.array(np.full(n, merged))], ["key", "wid", "merged"])

    return light.select("node", "c", "c2", "wid", "len", "i", "hash", F.col("h").cast("long").alias("h")).mapInArrow(run, "key long, wid long, merged boolean")


def near_pairs(words: DataFrame, *, least: int = 7) -> DataFrame:
    """(a, b) of all words (wid, w, len, all distinct) that differ by exactly one inserted, deleted or replaced code point, each pair once.

    Words are the leaves of a trie of which every node's child with the most words is heavy. Two words part at one
    node, and one of them at least goes to a light child there; it is sought in the heavy subtree with one letter
    skipped, replaced or added, and meets the other light subtrees with the letter left open. A word has at most
    log2(words) light edges, so this makes at most four log2 spellings a word, whatever its length and the
    alphabet. Candidates are confirmed on the words themselves.

    No group is large: a spelling with an open letter has one word for each letter, and light children with over
    1/1000 of all words (at most 1000 log2 of them, by the same bound) are broadcast, so no key of the join has more.
    """
    n = words.count()
    path = saved(edges(words))
    size = path.groupBy("node", "c").agg(F.count("*").alias("n_"))
    # A node has as many children as there are letters, and an end.
    heavy = F.max(F.when(F.col("c") != 0, F.struct("n_", (-F.col("c")).alias("neg_"), "c")))
    nodes = size.groupBy("node").agg(heavy.alias("heavy_"), F.collect_list(F.struct("c", "n_")).alias("children_")).filter("size(children_) > 1")
    children = saved(nodes.select("node", F.col("heavy_.c").alias("h"), F.explode("children_").alias("x")).select("node", "h", F.col("x.c").alias("c"), F.col("x.n_").alias("n_")))
    hot = children.filter(F.col("n_") * HOT >= n)
    if hot.count() > TOLD + HOT * (math.log2(max(n, 2)) + 1):
        hot = hot.filter("c <> h")
    told = path.join(F.broadcast(hot.select("node", "c", F.col("h").alias("hot_"))), ["node", "c"], "left").filter("hot_ IS NULL OR hot_ <> c")
    # Edges that are known need no partner: they go by their own words, so that they spread.
    told = told.withColumns({"k1": F.when(F.col("hot_").isNull(), F.col("node")).otherwise(F.col("wid")), "k2": F.when(F.col("hot_").isNull(), F.col("c")).otherwise(F.lit(-1))})
    others = children.filter("c <> h").filter(F.col("n_") * HOT < n).select(F.col("node").alias("k1"), F.col("c").alias("k2"), "h")
    light = told.join(others, ["k1", "k2"], "left").withColumn("h", F.coalesce("hot_", "h")).filter("h IS NOT NULL")
    keys = saved(errata(light, least))

    met = keys.filter("merged").groupBy("key").agg(F.collect_list("wid").alias("all_")).filter("size(all_) > 1")
    among = met.select(F.explode(F.expr("flatten(transform(all_, (x, i) -> transform(slice(all_, i + 2, size(all_)), y -> struct(x AS a, y AS b))))")).alias("p")).select("p.a", "p.b")
    by_hash = path.filter("c = 0").select(F.col("hash").alias("key"), F.col("wid").alias("b"))
    found = keys.filter("NOT merged").join(by_hash, "key").select(F.col("wid").alias("a"), "b")
    pairs = among.union(found).filter("a <> b")
    spelled = lambda s: words.select(F.col("wid").alias(s), F.col("w").alias(f"w_{s}"))
    return pairs.join(spelled("a"), "a").join(spelled("b"), "b").filter(F.levenshtein("w_a", "w_b", 1) == 1).select("a", "b")


def mixed_words(docs: DataFrame, *, id: str = "doc_id", text: str = "text", letters: str = r"A-Za-zÀ-ÿ", least: int = 7, least_n: int = 2, every: int = 31) -> DataFrame:
    """(w, n): words of at least `least` code points that occur at least least_n times over all texts.

    A word is a maximal run of letters with A-Z lower-cased. If the CRC-32 of `<id>:<run>` is divisible by `every`,
    the code point at that number modulo the run's length is deleted first. Runs shorter than `least` can't become
    words and are not taken from the text.
    """
    runs = docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")).alias("id_"), F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[{letters}]{{{least},}}"), F.lit(0))).alias("run_"))
    runs = runs.select("id_", ascii_lower(F.col("run_")).alias("run_"))
    h = F.crc32(F.concat("id_", F.lit(":"), "run_").cast("binary"))
    runs = runs.select("run_", h.alias("h_"), F.char_length("run_").alias("len_"))
    at = (F.col("h_") % F.col("len_")).cast("int")
    less = F.concat(F.substring("run_", F.lit(1), at), F.substring("run_", at + 2, F.col("len_")))
    words = runs.select(F.when(F.col("h_") % every == 0, less).otherwise(F.col("run_")).alias("w"))
    return words.groupBy("w").agg(F.count("*").alias("n")).filter((F.char_length("w") >= least) & (F.col("n") >= least_n))


def spelling_groups(docs: DataFrame, *, id: str = "doc_id", text: str = "text", least: int = 7, least_n: int = 2, ratio: int = 10, **how: object) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of mixed_words().

    Near words are those of near_pairs(). A word's form is its near word with the largest n, ties to the smallest in
    code-point order, if it has at least `ratio` times the word's n; root follows forms to the last word. Forms grow
    at least `ratio`-fold a step, so chains are short and roots are found by doubling in a few rounds.

    Null texts hold no words; a null id is taken as empty; repeated rows count each. No words: no rows. Other
    columns, whatever their names, are not read.
    """
    counted = mixed_words(docs, id=id, text=text, least=least, least_n=least_n, **how)
    words = saved(counted.select(F.monotonically_increasing_id().alias("wid"), "w", "n", F.char_length("w").alias("len")))
    words = saved(words.repartition("wid"))
    pairs = saved(near_pairs(words, least=least))
    ends = pairs.union(pairs.select(F.col("b"), F.col("a"))).toDF("wid", "b")
    near = ends.join(words.select(F.col("wid").alias("b"), F.col("w").alias("w_b"), F.col("n").alias("n_b")), "b")
    best = near.groupBy("wid").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("neg"), "w_b", "b")).alias("best"))
    rows = words.join(best, "wid", "left")
    good = F.coalesce(-F.col("best.neg") >= ratio * F.col("n"), F.lit(False))
    kept = {"form": F.col("best.w_b"), "form_n": -F.col("best.neg"), "to": F.col("best.b")}
    rows = saved(rows.select("wid", "w", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), *[F.when(good, c).alias(a) for a, c in kept.items()]))
    links = saved(rows.filter("to IS NOT NULL").select("wid", "to"))
    while True:  # links lead twice as far after each round
        ahead = links.select(F.col("wid").alias("to"), F.col("to").alias("on"))
        nxt = saved(links.join(ahead, "to", "left").select("wid", F.coalesce("on", "to").alias("to"), F.col("on").isNotNull().alias("moved")))
        links = nxt.select("wid", "to")
        if not nxt.filter("moved").limit(1).count():
            break
    last = links.join(words.select(F.col("wid").alias("to"), F.col("w").alias("root_")), "to").select("wid", "root_")
    out = rows.drop("to").join(last, "wid", "left")
    return out.select(F.col("w").alias("word"), "form", F.coalesce("root_", "w").alias("root"), "n", "n_near", F.col("form_n").cast("long").alias("form_n"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of documents with the form and the root that its near words give."""
    return spelling_groups(table(spark, sf_dir, "documents"))


SQL = f"""
WITH RECURSIVE {CRC32},
runs AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
long_runs AS (SELECT id || ':' || run AS k, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, n, crc FROM long_runs JOIN {crc32_sql("long_runs", "k")} ON k = v),
results AS (SELECT CASE WHEN crc % 31 = 0 THEN substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS w, n FROM hashed),
words AS (SELECT w, CAST(sum(n) AS BIGINT) AS n FROM results WHERE length(w) >= 7 GROUP BY w HAVING sum(n) >= 2),
less AS (SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) AS v FROM (SELECT w, n, CAST(unnest(range(1, length(w) + 1)) AS BIGINT) AS i FROM words)),
near AS (
  SELECT a.w, b.w AS o, b.n FROM less a JOIN less b ON a.i = b.i AND a.v = b.v AND a.w <> b.w AND length(a.w) = length(b.w)
  UNION SELECT a.w, b.w, b.n FROM less a JOIN words b ON a.v = b.w
  UNION SELECT b.w, a.w, a.n FROM less a JOIN words b ON a.v = b.w),
ranked AS (SELECT w, o, n, row_number() OVER (PARTITION BY w ORDER BY n DESC, o) AS r, count(*) OVER (PARTITION BY w) AS n_near FROM near),
forms AS (SELECT words.w, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN ranked.n >= 10 * words.n THEN o END AS form, CASE WHEN ranked.n >= 10 * words.n THEN ranked.n END AS form_n
  FROM words LEFT JOIN ranked ON ranked.w = words.w AND r = 1),
steps AS (SELECT w, w AS last, 0 AS d FROM forms UNION ALL SELECT steps.w, forms.form, d + 1 FROM steps JOIN forms ON steps.last = forms.w AND forms.form IS NOT NULL),
roots AS (SELECT w, arg_max(last, d) AS root FROM steps GROUP BY w)
SELECT w AS word, form, root, n, n_near, form_n FROM forms JOIN roots USING (w)
"""
