"""Benchmark decontamination by q-gram lemma filtering in overlapping diagonal bands and banded alignment."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held, table, without

BASE = np.uint64(0x9E3779B97F4A7C15)
BITS = 20


def normalise(text: str | None) -> str:
    """Lower case, with each stretch of white space one space."""
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def grams(c: np.ndarray, q: int) -> np.ndarray:
    """Hashes of all q-grams of a code sequence, by doubling."""
    if len(c) < q:
        return np.empty(0, np.uint64)
    out, have = None, 0
    piece, size, base = c + np.uint64(1), 1, int(BASE)
    left = q
    while left:
        if left & 1:
            n = len(c) - have - size + 1
            p = np.uint64(pow(int(BASE), have, 1 << 64))
            tail = piece[have : have + n] * p if have else piece[:n]
            out = tail if out is None else out[:n] + tail
            have += size
        left >>= 1
        if left:
            piece = piece[: len(piece) - size] + piece[size:] * np.uint64(base)
            base = base * base % (1 << 64)
            size *= 2
    return out * np.uint64(0xD6E8FEB86659FD93)


def edits(patterns: np.ndarray, text: np.ndarray, at: np.ndarray, budget: int) -> np.ndarray:
    """For each row of patterns, the least edits that turn it into a stretch of text that starts near `at`, or budget + 1 if more.

    Banded alignments of all rows at once, as codes: cells more than 2 * budget away from the diagonal of `at` are left
    out; the stretch may start and end anywhere in the band.
    """
    width, over = 2 * budget, budget + 1
    step = np.arange(2 * width + 1)
    place = at[:, None] - width + step  # text position of each cell, less the pattern's
    row = np.where((place >= 0) & (place <= len(text)), 0, over)
    for i in range(1, patterns.shape[1] + 1):
        j = place + i
        c = text[np.clip(j - 1, 0, len(text) - 1)]
        new = np.where(j > 0, row + (c != patterns[:, i - 1 : i]), over)
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)
        new = np.where((j >= 0) & (j <= len(text)), new, over)
        row = np.minimum(np.minimum.accumulate(new - step, axis=1) + step, over)  # and from the left
        row = np.where((j >= 0) & (j <= len(text)), row, over)
    return row.min(axis=1)


class Index:
    """Benchmark items and the postings of their q-grams. Every stretch of `window` characters of an item is a window."""

    def __init__(self, items: list[tuple[int, str]], q: int, window: int, rate: float) -> None:
        self.q = q
        self.items = [(i, t) for i, t in ((i, normalise(t)) for i, t in items) if t]
        self.codes = [codes(t) for _, t in self.items]
        size = np.array([len(t) for _, t in self.items], np.int64)
        self.size = np.minimum(size, window)  # of the windows
        self.last = size - self.size  # start of the last window
        self.budget = np.where(self.size >= q, np.minimum((rate * self.size).astype(np.int64), (self.size - q) // q), 0)
        # The lemma: windows within e edits share at least size - q + 1 - q * e of their q-grams with the text.
        self.need = np.maximum(1, self.size - q + 1 - q * self.budget)
        self.half = np.maximum(self.budget, 4)  # of the width of a band
        # Windows of equal text have one name, by their hash; the n-th item's begin at names_at[n].
        names = [grams(c, int(k)) + np.uint64(k) for c, k in zip(self.codes, self.size)]
        self.names = np.concatenate([*names, np.empty(0, np.uint64)])
        self.names_at = np.cumsum([0, *[len(x) for x in names]])
        self.short = np.flatnonzero(self.size < q).tolist()
        hashes = [grams(c, q) for c in self.codes]
        h = np.concatenate([*hashes, np.empty(0, np.uint64)])
        of = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes]).astype(np.int64)
        off = np.concatenate([*[np.arange(len(x)) for x in hashes], np.empty(0, np.int64)]).astype(np.int64)
        order = np.argsort(h, kind="stable")
        self.hash, self.of, self.off = h[order], of[order], off[order]
        self.bits = np.zeros(1 << BITS, bool)
        self.bits[self.hash >> np.uint64(64 - BITS)] = True
        self.least = int(self.need[self.size >= q].min()) if (self.size >= q).any() else 0
        self.reach = int((self.size + 2 * self.budget).max()) if len(size) else 0

    def find(self, text: str, c: np.ndarray, starts: list[int]) -> set[tuple[int, int]]:
        """(part, item) of the items of which a window stands in a part of text, whose parts begin at starts."""
        found: set[tuple[int, int]] = set()
        g = grams(c, self.q)
        if len(g) and len(self.hash):
            pos = np.flatnonzero(self.bits[g >> np.uint64(64 - BITS)])
            left = np.searchsorted(self.hash, g[pos])
            ok = self.hash[np.minimum(left, len(self.hash) - 1)] == g[pos]
            pos, left = pos[ok], left[ok]
            # Only where a stretch as long as the longest region holds as many hits as the least need.
            if len(pos) >= self.least:
                n = self.least - 1
                close = np.flatnonzero(pos[n:] - pos[: len(pos) - n] <= self.reach)
                edge = np.zeros(len(pos) + 1, np.int64)
                np.add.at(edge, close, 1)
                np.add.at(edge, close + n + 1, -1)
                ok = np.cumsum(edge[:-1]) > 0
                pos, left = pos[ok], left[ok]
                count = np.searchsorted(self.hash, g[pos], side="right") - left
                for a, b in pieces(pos, count, 2_000_000, 2 * self.reach):
                    self._regions(text, c, np.array(starts), pos[a:b], left[a:b], count[a:b], found)
        for n in self.short:
            item, w = self.items[n]
            at = -1
            while (at := text.find(w, at + 1)) >= 0:
                found.add((int(np.searchsorted(starts, at, side="right")) - 1, item))
        return found

    def _regions(self, text: str, c: np.ndarray, starts: np.ndarray, pos: np.ndarray, left: np.ndarray, count: np.ndarray, found: set[tuple[int, int]]) -> None:
        """Count hits in bands of diagonals, and verify the windows of an item that have as many as they need."""
        at = np.repeat(left - np.cumsum(count) + count, count) + np.arange(count.sum())
        of, off = self.of[at], self.off[at]
        diagonal = np.repeat(pos, count) - off
        band = np.floor_divide(diagonal, self.half[of])
        # Each diagonal lies in two bands that overlap by half.
        of, off, band = np.r_[of, of], np.r_[off, off], np.r_[band, band - 1]
        order = np.lexsort((off, band, of))
        of, off, band = of[order], off[order], band[order]
        here = np.arange(len(of))
        to = here + self.need[of] - 1
        ok = to < len(of)
        here, to = here[ok], to[ok]
        ok = (of[to] == of[here]) & (band[to] == band[here]) & (off[to] - off[here] <= self.size[of[here]] - self.q)
        here, to = here[ok], to[ok]
        if not len(here):
            return
        # Windows that hold the hits from `here` to `to`, by item and band, each once: their starts and ends grow within a band.
        n, low = of[here], band[here]
        first = np.maximum(0, off[to] - (self.size[n] - self.q))
        last = np.minimum(off[here], self.last[n])
        again = np.r_[False, (n[1:] == n[:-1]) & (low[1:] == low[:-1])]
        first = np.where(again, np.maximum(first, np.r_[0, last[:-1]] + 1), first)
        windows = np.maximum(last - first + 1, 0)
        start = np.repeat(first - np.cumsum(windows) + windows, windows) + np.arange(windows.sum())
        n, low = np.repeat(n, windows), np.repeat(low, windows)
        low = low * self.half[n]
        middle = low + self.half[n] + start
        part = np.searchsorted(starts, np.clip(middle + self.size[n] // 2, 0, len(c) - 1), side="right") - 1
        # Equal windows at one place of the text are one case, however many items have them.
        name = np.unique(self.names[self.names_at[n] + start], return_inverse=True)[1]
        _, case_of, case = np.unique(name * (len(c) + 4 * self.reach + 1) + middle + 2 * self.reach, return_index=True, return_inverse=True)
        pair_of, pair = np.unique(part * len(self.items) + n, return_inverse=True)
        done = np.array([(p // len(self.items), self.items[p % len(self.items)][0]) in found for p in pair_of.tolist()], bool)
        good = np.zeros(len(case_of), bool)
        # The first window of each band as it is; then the cases of the items not yet found, by alignment.
        heads = np.flatnonzero(np.r_[True, (n[1:] != n[:-1]) | (low[1:] != low[:-1])])
        for k in np.unique(case[heads[~done[pair[heads]]]]).tolist():
            w = case_of[k]
            s, size, half = int(start[w]), int(self.size[n[w]]), int(self.half[n[w]])
            x = max(0, int(low[w]) + s)
            good[k] = text.find(self.items[n[w]][1][s : s + size], x, x + 2 * half + size) >= 0
        done[pair[good[case]]] = True
        tried = good.copy()
        sizes = self.size[n[case_of]]
        for size in np.unique(sizes).tolist():
            mine = np.flatnonzero(sizes == size)
            budget = int(self.budget[n[case_of[mine[0]]]])
            while True:
                # Each pair's first cases that are left, so that most pairs are found before all of theirs are aligned.
                open_ = np.zeros(len(case_of), bool)
                open_[case[~done[pair]]] = True
                k = mine[open_[mine] & ~tried[mine]][:1024]
                if not len(k):
                    break
                tried[k] = True
                patterns = np.stack([self.codes[x][s : s + size] for x, s in zip(n[case_of[k]].tolist(), start[case_of[k]].tolist())])
                good[k] = edits(patterns, c, middle[case_of[k]], budget) <= budget
                done[pair[good[case]]] = True
        found |= {(p // len(self.items), self.items[p % len(self.items)][0]) for p in pair_of[done].tolist()}


def pieces(pos: np.ndarray, count: np.ndarray, most: int, reach: int) -> Iterator[tuple[int, int]]:
    """Slices of hits with about `most` postings; a slice begins `reach` characters before the last one's end, so that no region is cut."""
    total = np.cumsum(count)
    a = 0
    while a < len(pos):
        b = int(np.searchsorted(total, (total[a - 1] if a else 0) + most, side="right"))
        b = max(b, int(np.searchsorted(pos, pos[a] + 2 * reach, side="right")))  # so that slices go on
        yield a, b
        if b >= len(pos):
            return
        a = int(np.searchsorted(pos, pos[b] - reach))


def _parts(benchmark: DataFrame, id: str, text: str, part_chars: int) -> list[list[tuple[int, str]]]:
    """Benchmark items in parts of about part_chars characters."""
    items = benchmark.filter(F.col(id).isNotNull() & (F.length(F.trim(F.coalesce(F.col(text), F.lit("")))) > 0)).select(F.col(id).cast("long").alias("i"), F.col(text).alias("t"))
    chars = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, -(-chars // part_chars))
    for k in range(n):
        yield [(r["i"], r["t"]) for r in items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k).collect()]


def contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", out: str = "item_ids", q: int = 8, window: int = 80, rate: float = 0.075, part_chars: int = 2_000_000) -> DataFrame:
    """docs with `out`, the sorted ids of the benchmark items of which a window stands in the text (none: empty).

    Texts are compared in lower case with single spaces. Each stretch of `window` characters of an item is a window (a
    shorter item is one). A window stands in a text if a stretch of it is within min(rate * length, (length - q) / q)
    edits, which is rate * length from 20 characters on, and none for less. q-grams of the text that the benchmark has
    are joined with their postings; hits are counted in bands of diagonals, each overlapping the next by half; windows
    with fewer than length - q + 1 - q * edits hits in a band are left out, and what remains is verified by banded
    alignment.

    Items go to the workers in parts of about part_chars characters, one pass over docs for each part, so what is
    broadcast stays bounded however large the benchmark is. Null or empty texts contain nothing; null or empty items
    are left out; repeated rows give repeated rows; texts are searched whole, in stretches of bounded memory that
    overlap by a region. All other columns pass through; a column named `out` is replaced. No shuffle.
    """
    docs = without(docs, out)
    spark, names, result, first = docs.sparkSession, docs.columns, docs, True
    for items in _parts(benchmark, item_id, item_text, part_chars):
        if first or items:
            result = _pass(spark, result, items, names, text, out, first, q, window, rate)
            first = False
    return result


def _pass(spark: SparkSession, docs: DataFrame, items: list[tuple[int, str]], names: list[str], text: str, out: str, first: bool, q: int, window: int, rate: float) -> DataFrame:
    shared, token = spark.sparkContext.broadcast(items), uuid.uuid4().hex
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = held(("decontaminate", token), lambda: Index(shared.value, q, window, rate))
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                got = search(index, [normalise(t) for t in part[text].to_pylist()])
                if not first:
                    got = [sorted({*a, *b}) for a, b in zip(part[out].to_pylist(), got)]
                arrays = [part[n] for n in names] + [pa.array(got, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, [*names, out])

    return docs.mapInArrow(run, f"{columns}, `{out}` array<long>")


def search(index: Index, texts: list[str], stretch: int = 1_000_000) -> list[list[int]]:
    """Sorted item ids of each normalised text; texts are searched together, a stretch at a time."""
    found: list[set[int]] = [set() for _ in texts]

    def look(joined: str, starts: list[int], of: list[int]) -> None:
        # A region that a separator splits is no region: alignment can't cross it within the budget.
        for part, item in index.find(joined, codes(joined), starts):
            found[of[part]].add(item)

    gap = "\x00" * (index.reach + 1)
    parts, starts, of, held = [], [], [], 0
    for i, t in enumerate(texts):
        for a in range(0, max(1, len(t)), stretch):
            piece = t[a : a + stretch + 2 * index.reach]
            if held and held + len(piece) > stretch:
                look("".join(parts), starts, of)
                parts, starts, of, held = [], [], [], 0
            starts.append(held)
            of.append(i)
            parts += [piece, gap]
            held += len(piece) + len(gap)
    if parts:
        look("".join(parts), starts, of)
    return [sorted(f) for f in found]


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document, with the benchmark items that leaked into it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "item_ids")


def stage_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return contaminated(docs, table(spark, sf_dir, "benchmark"), out="item_ids_").filter(F.size("item_ids_") == 0).select(*docs.columns)
