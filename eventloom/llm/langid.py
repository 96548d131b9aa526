"""Language identification by cross-parsing entropy against suffix automata of labelled text."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import SuffixAutomaton
from .common import held, table, without

UNKNOWN = "und"
BETWEEN = re.compile(r"[\W\d_]+")
#: Bytes of a text that are parsed from a fresh phrase, and of the texts whose stretches are parsed side by side.
STRETCH, TOGETHER = 512, 1 << 22


def running(text: str) -> bytes:
    """Lower case, each run of other characters than letters one space, a space at both ends; in UTF-8."""
    return f" {BETWEEN.sub(' ', text.lower()).strip()} ".encode()


def train(labelled: DataFrame, *, text: str = "text", lang: str = "lang", docs_per_language: int = 200, doc_chars: int = 600, bytes_per_language: int = 60_000, model_bytes: int = 240_000, languages: int = 2_000) -> dict[str, list[bytes]]:
    """Running text of each language from a bounded sample of labelled rows: the model.

    Takes about docs_per_language rows of each language (those with the least hashes of their text, equal texts once)
    and of each a stretch of doc_chars characters from a place that the hash gives, up to bytes_per_language bytes of
    a language; with many languages as much less as keeps the whole model within model_bytes. Rows with a null
    text or label are left out, and languages whose sample has no letter. More labels than `languages` raise ValueError.
    """
    rows = labelled.filter(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    found = rows.groupBy("lang").agg(F.approx_count_distinct(F.xxhash64("text")).alias("n")).limit(languages + 1).collect()
    if len(found) > languages:
        raise ValueError(f"more than {languages} labels")
    if not found:
        return {}
    counts = {r["lang"]: max(1, r["n"]) for r in found}
    share = max(1, min(bytes_per_language, model_bytes // len(counts)))
    most = min(docs_per_language, -(-2 * share // doc_chars))
    # A row is taken if its hash falls in its language's share; over twice the share, of which the least hashes stay.
    shares = F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, (2.0 * most + 10) / n)))])
    h = F.shiftrightunsigned(F.xxhash64("text"), 11) / float(1 << 53)
    start = F.pmod(F.xxhash64(F.lit(1), "text"), F.greatest(F.lit(1), F.length("text") - doc_chars + 1)).cast("int") + 1
    picked = rows.withColumn("h", h).filter(F.col("h") < shares[F.col("lang")]).select("lang", "h", F.substring("text", start, F.lit(doc_chars)).alias("text"))
    parts: dict[str, list[bytes]] = {k: [] for k in sorted(counts)}
    for r in sorted(picked.dropDuplicates(["lang", "h"]).collect(), key=lambda r: (r["lang"], r["h"], r["text"])):
        taken = parts[r["lang"]]
        part = running(r["text"])[: share - sum(map(len, taken))]
        if len(taken) < most and part.strip():
            taken.append(part)
    return {k: taken for k, taken in parts.items() if taken}


class Parser:
    """Counts phrases of texts in each language's automaton.

    A phrase is the longest stretch from its start that occurs in the language's text, or one byte that occurs
    nowhere in it. As the next phrase begins where one ends, the automaton's moves, missing ones included, are a table: a
    move's value holds the row it leads to and how many phrases it ends. Many stretches move at once.
    """

    def __init__(self, model: dict[str, list[bytes]]) -> None:
        self.languages = sorted(model)
        known = sorted({c for parts in model.values() for p in parts for c in p})
        self.kinds = np.zeros(256, np.int32)
        self.kinds[known] = np.arange(1, len(known) + 1)
        self.width = len(known) + 1
        self.moves = [self._moves(model[k]) for k in self.languages]
        # Phrases of a longer text are longer, as its logarithm.
        self.cost = np.array([np.log2(1 + sum(map(len, model[k]))) for k in self.languages])

    def _moves(self, parts: list[bytes]) -> np.ndarray:
        tree = SuffixAutomaton()
        for p in parts:
            tree.add(p)
        first = np.full(self.width, 1, np.int32)
        for c, to in tree.next[0].items():
            first[self.kinds[c]] = to * self.width << 2
        moves = np.tile(first + 1, (len(tree.next), 1))
        moves[0] = first
        found = np.array([(v, c, to) for v, nxt in enumerate(tree.next) for c, to in nxt.items()], np.int64).reshape(-1, 3)
        moves[found[:, 0], self.kinds[found[:, 1]]] = found[:, 2] * self.width << 2
        return moves.ravel()

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text (row) in each language (column); a phrase ends where a stretch of STRETCH bytes ends."""
        sizes = np.array([len(t) for t in texts], np.int64)
        data = self.kinds[np.frombuffer(b"".join(texts), np.uint8)]
        each = -(-sizes // STRETCH)
        of = np.repeat(np.arange(len(texts)), each)
        at = (np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)) * STRETCH
        length = np.minimum(STRETCH, sizes[of] - at)
        # The longest first: those still under way are always the first ones.
        order = np.argsort(-length, kind="stable")
        of, begin, length = of[order], ((np.cumsum(sizes) - sizes)[of] + at)[order], length[order]
        active = len(length) - np.searchsorted(length[::-1], np.arange(STRETCH), "right")
        state, ended = (np.zeros((len(self.languages), len(of)), np.int32) for _ in range(2))
        for j, m in enumerate(active):
            if not m:
                break
            c = data[begin[:m] + j]
            for s, n, moves in zip(state, ended, self.moves):
                x = moves.take(s[:m] + c)
                n[:m] += x & 3
                np.right_shift(x, 2, out=s[:m])
        ended += state > 0
        return np.stack([np.bincount(of, weights=n, minlength=len(texts)) for n in ended], axis=1).astype(np.int64)

    def _scored(self, texts: list[bytes | None]) -> Iterator[tuple[str, float]]:
        has = [k for k, t in enumerate(texts) if t is not None]
        out = [(UNKNOWN, 0.0)] * len(texts)
        if has and self.languages:
            rates = self.phrases([texts[k] for k in has]) * self.cost
            for k, row in zip(has, rates):
                best = np.argsort(row, kind="stable")[:2]
                out[k] = (self.languages[best[0]], float(1 - row[best[0]] / row[best[1]]) if len(best) > 1 else 1.0)
        yield from out

    def predict(self, texts: Iterable[str | None]) -> Iterator[tuple[str, float]]:
        """Language and score of each text, in order."""
        waiting, size = [], 0
        for t in texts:
            waiting.append(running(t) if t and any(map(str.isalpha, t)) else None)
            size += len(waiting[-1] or b"")
            if size >= TOGETHER:
                yield from self._scored(waiting)
                waiting, size = [], 0
        yield from self._scored(waiting)


def identify(docs: DataFrame, model: dict[str, list[bytes]], *, text: str = "text", lang_out: str = "lang_pred", score_out: str = "score") -> DataFrame:
    """docs with the predicted language and a score (0 to 1: how much less the language costs than the next one).

    A text is parsed whole, across words, in stretches of STRETCH bytes of its running() form: the language whose
    labelled text gives the fewest phrases, times the logarithm of that text's length, wins; of equal ones the first by name. `und`
    with score 0 if the text is null, has no letter, or the model is empty. All other columns pass through;
    columns of the two new names are replaced. No shuffle. The model is bounded by train() and goes to the workers as a
    broadcast value.
    """
    docs = without(docs, lang_out, score_out)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    token = uuid.uuid4().hex
    names = docs.columns
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = held(("langid", token), lambda: Parser(shared.value))
        for b in batches:
            got = list(parser.predict(t.as_py() for t in b[text]))
            out = [*b.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]
            yield pa.RecordBatch.from_arrays(out, [*names, lang_out, score_out])

    return docs.mapInArrow(run, f"{columns}, `{lang_out}` string, `{score_out}` double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(~held_out()))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def stage_langid(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: those without any letter go."""
    columns = docs.columns
    model = train(docs.filter(~held_out()))
    return identify(docs, model, lang_out="lang_pred_", score_out="score_").filter(F.col("lang_pred_") != UNKNOWN).select(*columns)
