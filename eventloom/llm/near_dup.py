"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation on shingle sets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, cut, grouped, held, table

HASHES, ROWS, BATCH = 128, 4, 32
BANDS = HASHES // ROWS
#: Members of a tile of a large bucket; members of a hot class or digest are matched in SALT parts.
CHUNK, SALT = 256, 32
#: Ids that a broadcast join may hold: 8 MB or so. Above it the join shuffles.
BROADCAST_IDS = 1_000_000
_rng = np.random.Generator(np.random.PCG64(20240101))
MULTIPLY = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _rng.integers(0, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2)
MIX = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            if len(self) > 150_000:
                self.clear()
            self[word] = h
        return h


def words_of(text: str | None) -> list[bytes]:
    """Words of a text: A-Z in lower case, split at space and \\x09 to \\x0D."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of k words; of fewer words, one for the whole sequence."""
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(held("words", WordHashes).__getitem__, words), np.uint64, len(words))
    n = max(1, len(w) - k + 1)
    h = np.full(n, min(len(w), k), np.uint64)
    for i in range(min(k, len(w))):
        h = mix(h * MIX + w[i : i + n])
    return np.unique(h)


def signature(s: np.ndarray) -> np.ndarray:
    """Minima of a set under each hash function."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(s), 4096):
        x = np.multiply.outer(MULTIPLY, s[a : a + 4096])
        x += ADD[:, None]
        np.minimum(least, x.min(axis=1), out=least)
    return least


def cutoffs(threshold: float, miss: float) -> list[int]:
    """For each batch, the matches so far that a pair needs to stay.

    With a uniform prior of the similarity, m matches of n give it a Beta(m + 1, n - m + 1) posterior, which is at
    least the threshold with the probability that Binomial(n + 1, threshold) is at most m. A pair goes as soon as
    that is below `miss`.
    """
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        below, m = 0.0, 0
        while (below := below + math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)) < miss:
            m += 1
        out.append(m)
    return out


def surviving(sig: np.ndarray, i: np.ndarray, j: np.ndarray, cut_at: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the pairs that sequential verification keeps, and their matches."""
    alive, matches = np.arange(len(i)), np.zeros(len(i), np.int64)
    for b, least in enumerate(cut_at):
        part = slice(b * BATCH, (b + 1) * BATCH)
        for a in range(0, len(alive), 100_000):
            x = alive[a : a + 100_000]
            matches[x] += (sig[i[x], part] == sig[j[x], part]).sum(axis=1)
        alive = alive[matches[alive] >= least]
    return alive, matches[alive]


def _bytes(column: pa.ChunkedArray | pa.Array, width: int, kind: type = np.uint8) -> np.ndarray:
    """A binary column whose values have `width` bytes each as a matrix."""
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = np.frombuffer(c.buffers()[1], np.int32, len(c) + 1, c.offset * 4)
    return np.frombuffer(c.buffers()[2], np.uint8)[at[0] : at[-1]].reshape(len(c), width).view(kind)


def _forest(n: int, i: np.ndarray, j: np.ndarray, label: np.ndarray | None = None) -> list[int]:
    """Positions of the pairs, in their order, that join two trees; nodes with equal labels start joined."""
    root = list(range(n)) if label is None else np.unique(label, return_inverse=True)[1].tolist()
    node = list(range(n)) if label is None else root
    top = list(range(n))

    def find(x: int) -> int:
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    out = []
    for p, (x, y) in enumerate(zip(i.tolist(), j.tolist())):
        x, y = find(node[x]), find(node[y])
        if x != y:
            top[y] = x
            out.append(p)
    return out


def _pairs_batch(a: list, b: list) -> pa.RecordBatch:
    x, y = (np.concatenate([*v, np.empty(0, np.int64)]).astype(np.int64) for v in (a, b))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])


def _sketch(docs: DataFrame, k: int) -> DataFrame:
    """id, k1, k2 (digest of the word sequence), n_shingles, sig (a byte a hash), keys (64 bits a band) and marks (the lower 32 of each); the last three null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = np.arange(BANDS, dtype=np.uint64) * MIX
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                digests, counts, sigs, keys, marks = [], [], [], [], []
                for t in part["text"].to_pylist():
                    words = words_of(t)
                    s = shingle_set(words, k)
                    digests.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
                    counts.append(len(s))
                    if not len(s):
                        sigs.append(None)
                        keys.append(None)
                        marks.append(None)
                        continue
                    m = signature(s)
                    sigs.append(((m * MIX) >> np.uint64(56)).astype(np.uint8).tobytes())
                    key = salt
                    for r in range(ROWS):
                        key = mix(key + m[r::ROWS])
                    keys.append(key.tobytes())
                    marks.append(key.astype(np.uint32).tobytes())
                d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([part["id"], pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(counts, pa.int64()), pa.array(sigs, pa.binary()), pa.array(keys, pa.binary()), pa.array(marks, pa.binary())], ["id", "k1", "k2", "n_shingles", "sig", "keys", "marks"])

    return docs.mapInArrow(run, "id long, k1 long, k2 long, n_shingles long, sig binary, keys binary, marks binary")


def _band_rows(reps: DataFrame) -> DataFrame:
    """bucket, id of every band of every representative."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                keys = _bytes(b["keys"], 8 * BANDS, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(b["id"].to_numpy(), BANDS))], ["bucket", "id"])

    return reps.select("id", "keys").mapInArrow(run, "bucket long, id long")


def _provisional(members: DataFrame, cut_at: list[int]) -> DataFrame:
    """Most similar surviving pairs (a, b) that span each tile, by signatures alone."""

    def run(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, sig = t["id"].to_numpy(), _bytes(t["sig"], HASHES)
        size = np.diff(starts)
        two = starts[:-1][size == 2]
        alive, _ = surviving(sig, two, two + 1, cut_at)
        a, b = [ids[two[alive]]], [ids[two[alive] + 1]]
        for s, n in zip(starts[:-1][size > 2], size[size > 2]):
            i, j = np.triu_indices(n, 1)
            alive, m = surviving(sig[s : s + n], i, j, cut_at)
            alive = alive[np.argsort(-m, kind="stable")]
            keep = alive[_forest(n, i[alive], j[alive])]
            a.append(ids[s + i[keep]])
            b.append(ids[s + j[keep]])
        yield _pairs_batch(a, b)

    return grouped(members, "tile", run, "a long, b long").filter("a < b").distinct()


def similar(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union of two sorted sets."""
    if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= percent * (len(x) + len(y) - both)


def _confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The edges whose full sets reach the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [similar(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(b["x"].to_pylist(), b["y"].to_pylist())]
            yield pa.RecordBatch.from_arrays([b["a"], b["b"]], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = edges.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs of a tile's sets, a block of shared elements at a time."""
    which = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, element, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    number = np.cumsum(shared) - 1
    keep = shared[element]
    which, element = which[keep], number[element[keep]]
    order = np.argsort(element, kind="stable")
    which, element = which[order], element[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for a in range(0, int(shared.sum()), 8192):
        lo, hi = np.searchsorted(element, [a, a + 8192])
        x = np.zeros((len(sets), 8192), np.float32)
        x[which[lo:hi], element[lo:hi] - a] = 1
        out += x @ x.T
    return out


def _open_pairs(t: pa.Table, s: int, e: int, sig: np.ndarray, marks: np.ndarray, label: np.ndarray, cut_at: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of the tile [s, e) of pairs between components that verification keeps, most similar first.

    A pair that shares several buckets is given in that of its first common band only.
    """
    i, j = np.triu_indices(e - s, 1)
    i, j = i + s, j + s
    cross = label[i] != label[j]
    i, j = i[cross], j[cross]
    alive, m = surviving(sig, i, j, cut_at)
    alive = alive[np.argsort(-m, kind="stable")]
    i, j = i[alive], j[alive]
    if len(i):
        first = (marks[i] == marks[j]).argmax(axis=1)
        own = marks[i, first] == np.uint32(int(t["bucket"][s].as_py()) & 0xFFFFFFFF)
        i, j = i[own], j[own]
    return i, j


def _open(members: DataFrame, cut_at: list[int]) -> DataFrame:
    """tile, id of the members with an open pair in their tile: those whose sets are worth reading."""

    def run(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, tile, label = t["id"].to_numpy(), t["tile"].to_numpy(), t["component"].to_numpy()
        sig, marks = _bytes(t["sig"], HASHES), _bytes(t["marks"], 4 * BANDS, np.uint32)
        rows = [np.unique(np.concatenate(_open_pairs(t, s, e, sig, marks, label, cut_at))) for s, e in zip(starts[:-1].tolist(), starts[1:].tolist())]
        rows = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(tile[rows]), pa.array(t["bucket"].to_numpy()[rows]), pa.array(ids[rows]), pa.array(label[rows])], ["tile", "bucket", "id", "component"])

    return grouped(members, "tile", run, "tile long, bucket long, id long, component long")


def _links(members: DataFrame, cut_at: list[int], percent: int) -> DataFrame:
    """Confirmed links (a, b) that span each tile, between members of different components only."""

    def run(t: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids, label = t["id"].to_numpy(), t["component"].to_numpy()
        sig, marks = _bytes(t["sig"], HASHES), _bytes(t["marks"], 4 * BANDS, np.uint32)
        sets = t["set"].combine_chunks()
        a, b = [], []
        for s, e in zip(starts[:-1].tolist(), starts[1:].tolist()):
            i, j = _open_pairs(t, s, e, sig, marks, label, cut_at)
            if not len(i):
                continue
            mine = {x: np.frombuffer(sets[int(x)].as_py(), np.uint64) for x in np.unique(np.r_[i, j])}
            if len(i) > 4 * (e - s):
                at = {x: p for p, x in enumerate(mine)}
                length = np.array([len(x) for x in mine.values()])
                overlap = _overlaps(list(mine.values()))
                x, y = (np.array([at[v] for v in w], np.int64) for w in (i, j))
                both = overlap[x, y].astype(np.int64)
                ok = 100 * both >= percent * (length[x] + length[y] - both)
            else:
                ok = np.array([similar(mine[x], mine[y], percent) for x, y in zip(i, j)], bool)
            i, j = i[ok], j[ok]
            keep = _forest(e - s, i - s, j - s, label[s:e])
            a.append(ids[i[keep]])
            b.append(ids[j[keep]])
        yield _pairs_batch(a, b)

    return grouped(members, "tile", run, "a long, b long").filter("a < b").distinct()


def near_duplicates(docs: DataFrame, *, id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row: groups of documents linked by similar shingle sets.

    A document's set holds its distinct shingles of `words` words (A-Z in lower case; fewer words: the whole
    sequence; no words or a null text: empty, linked with nothing). Two documents are linked if 100 * intersection
    >= percent * union; component_id is the smallest id reachable and kept says whether it is the row's own.

    Copies of a word sequence become one class. Classes that agree in one of 32 bands of 4 MinHash values are
    candidates (a pair at similarity 0.8 shares none with probability 5e-8). First, in each bucket, the most similar
    candidates that sequential Bayesian verification keeps are joined to a spanning forest, confirmed on full sets
    and closed to components. Then every candidate pair still in two components goes the same way: Bayesian
    pruning (posterior of the threshold below `miss`), then full sets. So no pair within a component need be
    compared, and no link between components is lost to anything but the two miss probabilities.

    Large buckets are dealt as tiles of CHUNK members: in the first step a tile is one chunk, in the second every
    chunk of a bucket's lesser components meets every other chunk. A row with a null id is compared with nothing: its
    component_id is null and it is kept. Rows of the same id are one document as far as links go. An empty
    table gives no rows; further columns are left out.
    """
    cut_at = cutoffs(percent / 100, miss)
    docs = docs.select(F.col(id).cast("long").alias("id"), F.col(text).alias("text"))
    base = cut(_sketch(docs, words))
    classes = base.filter("id is not null and n_shingles > 0").groupBy("k1", "k2").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    classes = cut(classes)
    # Dealt by id alone, for the next step: hence no equality of the digests.
    own = classes.select(F.col("id").alias("of"), F.col("k1").alias("c1"), F.col("k2").alias("c2"))
    reps = base.join(own, (F.col("id") == F.col("of")) & (F.col("k1").bitwiseXOR(F.col("c1")).bitwiseOR(F.col("k2").bitwiseXOR(F.col("c2"))) == 0))
    reps = cut(reps.select("id", "sig", "keys", "marks").dropDuplicates(["id"]))

    bands = _band_rows(reps)
    shared = bands.groupBy("bucket").agg(F.count("*").alias("m")).filter("m > 1")
    members = cut(bands.join(shared, "bucket"))
    chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("m") / CHUNK)).cast("long")
    tiles = members.withColumn("tile", F.when(F.col("m") > CHUNK, F.xxhash64("bucket", chunk)).otherwise(F.col("bucket")))
    edges = cut(_provisional(tiles.select("tile", "id").join(reps.select("id", "sig"), "id"), cut_at))

    # Shingle sets of the members of shared buckets only.
    alive = members.select("id").distinct()
    alive = cut(alive)
    some = F.broadcast(alive) if alive.count() <= BROADCAST_IDS else alive
    texts = docs.join(some, "id", "left_semi")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                got = [shingle_set(words_of(t), words).tobytes() for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([part["id"], pa.array(got, pa.binary())], ["id", "set"])

    sets = cut(texts.mapInArrow(sets_of, "id long, set binary").dropDuplicates(["id"]))
    first = cut(_confirmed(edges, sets, percent))
    labels = cut(components(first))

    left = members.join(labels, "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    parts = left.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    many = parts.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("top"), F.sum("n").alias("all")).filter("top.n < all")
    many = many.select("bucket", F.col("top.component").alias("main"), F.ceil(F.col("top.n") / CHUNK).cast("int").alias("major"), F.ceil((F.col("all") - F.col("top.n")) / CHUNK).cast("int").alias("minor"))
    left = cut(left.join(many, "bucket"))
    own = F.expr(f"cast(pmod(xxhash64(id), if(component = main, major, minor)) as int)")
    left = left.withColumn("own", own)
    tile = F.expr(
        "if(component = main, transform(sequence(0, minor - 1), p -> xxhash64(bucket, 1, p, own)),"
        " concat(transform(sequence(0, minor - 1), q -> xxhash64(bucket, 0, least(own, q), greatest(own, q))), transform(sequence(0, major - 1), q -> xxhash64(bucket, 1, own, q))))"
    )
    marked = reps.select("id", "sig", "marks")
    rest = cut(_open(left.select("bucket", "id", "component", F.explode(tile).alias("tile")).join(marked, "id"), cut_at))
    links = cut(_links(rest.join(marked, "id").join(sets, "id"), cut_at, percent))
    final = cut(components(first.union(links))) if links.count() else labels

    # Classes whose component is not simply the row's own id; few rows a class, but hot classes are matched in parts.
    out = classes.join(final, "id", "left").select("k1", "k2", F.coalesce("component", "id").alias("component_id"), "copies", "id")
    out = out.filter("copies > 1 or component_id <> id").select("k1", "k2", "component_id", F.explode(F.when(F.col("copies") > 1000, F.sequence(F.lit(0), F.lit(SALT - 1))).otherwise(F.array(F.lit(-1)))).alias("salt"), (F.col("copies") > 1000).alias("hot"))
    hot = out.filter("hot").drop("hot")
    plain = out.filter("not hot").drop("hot", "salt")
    rows = base.select("id", "k1", "k2", "n_shingles")
    linked = F.expr("id is not null and n_shingles > 0")
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALT)).cast("int"))
    rows = rows.join(hot.withColumnRenamed("component_id", "c1"), ["k1", "k2", "salt"], "left").join(plain.withColumnRenamed("component_id", "c2"), ["k1", "k2"], "left")
    component = F.when(linked, F.coalesce("c1", "c2", "id")).otherwise(F.col("id"))
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"))


def op3_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of near-duplicate documents: shingles of four words, similarity 0.8."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=4)


def stage_near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    gone = near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
