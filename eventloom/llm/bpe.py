"""Byte-pair encoding and decoding by dynamic programming over the prefixes of a word.

For every prefix of a word exactly one token can come last in its encoding. A suffix automaton of the vocabulary
finds the tokens that end at each position; a token is the last one if it is compatible with the last token of the
prefix before it, that is, if no merge would ever have crossed their border. Back-pointers then give the ids.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import held, table

END = "</w>"
#: Stretches and words that a worker remembers: some 100 MB each.
CHUNKS, WORDS = 500_000, 200_000


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    spare = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(spare)}


class SuffixAutomaton:
    """Suffix automaton of a set of strings; mark[v] is the mark of the string that is v's longest, or -1."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.len, self.mark, self.up = [-1], [0], [-1], [-1]

    def _state(self, length: int, to: dict[str, int], link: int) -> int:
        self.next.append(to)
        self.link.append(link)
        self.len.append(length)
        self.mark.append(-1)
        return len(self.len) - 1

    def _step(self, last: int, c: str) -> int:
        nxt, link, length = self.next, self.link, self.len
        if (q := nxt[last].get(c)) is not None:
            return q if length[q] == length[last] + 1 else self._split(last, c, q)
        cur = self._state(length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
        return cur

    def _split(self, p: int, c: str, q: int) -> int:
        copy = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def add(self, text: str, mark: int = -1) -> None:
        v = 0
        for c in text:
            v = self._step(v, c)
        if mark >= 0:
            self.mark[v] = mark

    def finish(self) -> None:
        """Let up[v] be the nearest marked state above v on the suffix links, -1 if none."""
        self.up = [-1] * len(self.len)
        for v in sorted(range(1, len(self.len)), key=self.len.__getitem__):
            above = self.link[v]
            self.up[v] = above if self.mark[above] >= 0 else self.up[above]


class BpeCoder:
    """Encoder of a tokenizer file with word-end suffixes; see encode()."""

    def __init__(self, spec: str) -> None:
        d = json.loads(spec)
        letters = byte_letters()
        back = {c: chr(b) for b, c in letters.items()}
        vocab = d["model"]["vocab"]
        if d["model"].get("end_of_word_suffix") != END:
            raise ValueError("the vocabulary must mark word ends with </w>")

        def symbols(token: str) -> str:  # a byte is one character; the last of a word is 256 above its byte
            ends = token.endswith(END)
            s = "".join(back[c] for c in (token[: -len(END)] if ends else token))
            return s[:-1] + chr(ord(s[-1]) + 256) if ends else s

        self.special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.at_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        # Merge number of a token (-1 for a single symbol), its two parts, and the token that a pair makes.
        self.born = {i: -1 for i in vocab.values()}
        self.parts: dict[int, tuple[int, int]] = {}
        self.made: dict[tuple[int, int], int] = {}
        for n, (a, b) in enumerate(x if isinstance(x, list) else x.split(" ") for x in d["model"]["merges"]):
            t = vocab[a + b]
            self.born[t] = n
            self.parts[t] = (vocab[a], vocab[b])
            self.made[vocab[a], vocab[b]] = n
        self.fits_memo: dict[int, bool] = {}
        self.ends: dict[int, tuple[tuple[int, int], ...]] = {}
        self.size: dict[int, int] = {}
        self.tree = SuffixAutomaton()
        # Shortest first, and only tokens that are the encoding of their own text.
        for t in sorted(self.born, key=lambda i: len(self.names[i])):
            if t in self.parts and not self._own(*self.parts[t]):
                continue
            s = symbols(self.names[t])
            self.size[t] = len(s)
            self.tree.add(s, t)
        self.tree.finish()
        self.spelling = np.array([self.names.get(i, "") for i in range(max(self.names) + 1)], object)
        self.words: dict[str, tuple[int, ...]] = {}
        self.older_words: dict[str, tuple[int, ...]] = {}
        self.numbers: dict[str, int] = {}
        self.ids, self.starts = array("I"), array("q", [0])

    def _own(self, a: int, b: int) -> bool:
        """Whether merging makes the token of parts a and b from its own symbols: up to its merge the border holds."""
        return a in self.size and b in self.size and self._holds(a, b, self.made[a, b])

    def fits(self, a: int, b: int) -> bool:
        """Whether token b can stand after token a: no merge crosses their border at any time."""
        if (known := self.fits_memo.get(a << 32 | b)) is None:
            if len(self.fits_memo) > 200_000:
                self.fits_memo.clear()
            known = self.fits_memo[a << 32 | b] = self._holds(a, b, None)
        return known

    def _ends(self, v: int) -> tuple[tuple[int, int], ...]:
        """(token, symbols) of each token that ends the longest string of state v, longest first."""
        tree, out = self.tree, []
        u = v if tree.mark[v] >= 0 else tree.up[v]
        while u > 0:
            out.append((tree.mark[u], self.size[tree.mark[u]]))
            u = tree.up[u]
        self.ends[v] = tuple(out)
        return self.ends[v]

    def _holds(self, a: int, b: int, until: int | None) -> bool:
        """Go back in time from the finished tokens at a border and look for a merge across it.

        The tokens at the border, x and y, meet until the merge numbered `until`, at which one of them was joined to
        its far neighbour (None: they are the finished ones). The pair (x, y) would have been merged first if its
        number is lower, or equal and the border lies to the left of the join, as merging goes from left to right.
        """
        born, made, parts = self.born, self.made, self.parts
        x, y, right = a, b, False
        exact = until is not None
        while True:
            m = made.get((x, y))
            if m is not None and not (exact and x == a and y == b) and (until is None or m < until or m == until and right):
                return False
            bx, by = born[x], born[y]
            if bx < 0 and by < 0:
                return True
            # The later merge is undone first; at equal numbers the right one came last.
            if bx > by:
                until, x, right = bx, parts[x][1], False
            else:
                until, y, right = by, parts[y][0], True

    def word(self, text: str) -> list[int]:
        """Ids of one pre-token."""
        raw = text.encode("utf-8").decode("latin-1")
        s = raw[:-1] + chr(ord(raw[-1]) + 256)
        nxt, link, length, ends = self.tree.next, self.tree.link, self.tree.len, self.ends
        known, fits = self.fits_memo.get, self.fits
        last = [0] * (len(s) + 1)
        v = m = 0
        for i, c in enumerate(s, 1):
            while (to := nxt[v].get(c)) is None and v:
                v = link[v]
                m = length[v]
            if to is None:
                v = m = 0
                continue
            v = to
            m += 1
            for t, n in ends.get(v) or self._ends(v):
                if n > m:
                    continue
                if n != i:
                    before = last[i - n]
                    ok = known(before << 32 | t)
                    if not (fits(before, t) if ok is None else ok):
                        continue
                last[i] = t
                break
        out, i = [], len(s)
        while i:
            out.append(last[i])
            i -= self.size[last[i]]
        return out[::-1]

    # Letters and digits that the regex module knows and the library's Unicode tables (of version 16) don't.
    NEWER = (
        "\U00000558\U0000058b-\U0000058c\U0000088f\U00000c5c\U00000cdc\U0000208f\U0000209d-\U0000209f\U0000a7ce-\U0000a7cf"
        "\U0000a7d2\U0000a7d4\U0000a7dd\U0000a7e2\U0000a7f1\U0000ab6c-\U0000ab6d\U000107bb-\U000107bf\U00010940-\U00010959"
        "\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb\U00011df1\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff3"
        "\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168"
        "\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5"
        "\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f"
    )
    # Capitals of Unicode 16 and 17, which Python may not lower yet, and a sigma that the library never takes for the end of a word.
    LOWER = {0xA7CB: 0x264, 0xA7CC: 0xA7CD, 0xA7CE: 0xA7CF, 0xA7D2: 0xA7D3, 0xA7D4: 0xA7D5, 0xA7DA: 0xA7DB, 0xA7DC: 0x19B, 0x1C89: 0x1C8A, ord("Σ"): ord("σ")} | {c: c + 32 for c in range(0x10D50, 0x10D66)} | {c: c + 27 for c in range(0x16EA0, 0x16EB9)}
    # The pre-token pattern of the vocabulary file.
    PRE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}--[%s]]+|[\p{N}--[%s]]|(?:[^\s\p{L}\p{N}]|[%s]|[\x1c-\x1f])+" % (NEWER, NEWER, NEWER), regex.V1)
    # Four control characters that Python takes for white space and the pattern does not.
    ODD = regex.compile("[\x1c-\x1f]")
    SPACE = regex.compile(r"(?:(?![\x1c-\x1f])\s)+")

    def _chunk(self, chunk: str) -> list[int]:
        """Ids of a stretch without white space."""
        out: list[int] = []
        for part in self.at_special.split(chunk) if self.at_special and "<" in chunk else [chunk]:
            if part in self.special:
                out.append(self.special[part])
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part).translate(self.LOWER)
            part = part.lower()
            for w in [part] if part.isalpha() else self.PRE.findall(part):
                if (known := self.words.get(w) or self.older_words.get(w)) is None:
                    known = tuple(self.word(w))
                if len(w) <= 64:
                    if len(self.words) > WORDS:
                        self.older_words, self.words = self.words, {}
                    self.words[w] = known
                out += known
        return out

    def _split(self, text: str) -> list[str]:
        return [c for c in self.SPACE.split(text) if c] if self.ODD.search(text) else text.split()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin (with the end).

        Each different stretch is encoded once and numbered; what is repeated is looked up, and ids are put in place
        for all stretches of the texts at once.
        """
        if len(self.numbers) > CHUNKS:
            self.numbers, self.ids, self.starts = {}, array("I"), array("q", [0])
        numbers, ids, starts = self.numbers, self.ids, self.starts
        at, counts, passing = array("q"), [], {}
        for text in texts:
            got = self._split(text)
            counts.append(len(got))
            for c in got:
                if (n := numbers.get(c)) is None:
                    if len(c) > 64 and (n := passing.get(c)) is None or len(c) <= 64:
                        ids.extend(self._chunk(c))
                        n = len(starts) - 1
                        starts.append(len(ids))
                        (numbers if len(c) <= 64 else passing)[c] = n
                at.append(n)
        which, first = np.frombuffer(at, np.int64), np.frombuffer(starts, np.int64).copy()
        size = (first[1:] - first[:-1])[which] if len(which) else np.empty(0, np.int64)
        ends = np.cumsum(size)
        take = np.repeat(first[:-1][which] - (ends - size), size) + np.arange(size.sum()) if len(which) else np.empty(0, np.int64)
        edge = np.r_[0, ends][np.r_[0, np.cumsum(counts)].astype(np.int64)]
        return np.frombuffer(ids, np.uint32)[take] if len(take) else np.empty(0, np.uint32), edge

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids, as the library's decode(ids, skip_special_tokens=False): tokens with a space between."""
        return " ".join(self.spelling[ids])


def coder(spec: str) -> BpeCoder:
    """The coder of a tokenizer file's text, built once in a worker process."""
    return held(("bpe", hashlib.sha256(spec.encode()).hexdigest()), lambda: BpeCoder(spec))


def bpe(df: DataFrame, spec: str, *, text: str = "text", keep: tuple[str, ...] = ("doc_id",), ids: bool = False, decoded: bool = False, digests: bool = True) -> DataFrame:
    """Encode and decode a text column: `keep`, n_tokens, and on demand the ids (binary, little-endian 32-bit), the decoded text and SHA-256 digests of both.

    spec is the JSON text of a tokenizer file, 2 MB or so whatever the table; it goes to the workers as a broadcast
    value, so they need no file. Null is encoded as the empty text (no tokens, digest of nothing); repeated rows
    give repeated rows; any other columns are left out. Each text is encoded whole; words are remembered in caches
    of bounded size. No shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(spec)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    more = [("ids", "binary", ids), ("decoded", "string", decoded), ("ids_sha256", "string", digests), ("decoded_sha256", "string", digests)]
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in keep], "n_tokens long", *[f"{n} {k}" for n, k, on in more if on]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(shared.value)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                all_ids, edge = c.encode([t or "" for t in part[text].to_pylist()])
                raw = all_ids.astype("<u4", copy=False)
                got = [raw[x:y] for x, y in zip(edge[:-1].tolist(), edge[1:].tolist())]
                out = [part[k] for k in keep] + [pa.array(np.diff(edge), pa.int64())]
                texts = [c.decode(x) for x in got] if decoded or digests else []
                if ids:
                    out.append(pa.array([x.tobytes() for x in got], pa.binary()))
                if decoded:
                    out.append(pa.array(texts, pa.string()))
                if digests:
                    out.append(pa.array([hashlib.sha256(x).hexdigest() for x in got], pa.string()))
                    out.append(pa.array([hashlib.sha256(x.encode("utf-8")).hexdigest() for x in texts], pa.string()))
                yield pa.RecordBatch.from_arrays(out, [*keep, "n_tokens", *[n for n, _, on in more if on]])

    return df.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Text of a public tokenizer file, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents, encoded and decoded."""
    return bpe(table(spark, sf_dir, "documents"), vocabulary())


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left, with digests of the ids and of the decoded text."""
    return bpe(docs, vocabulary(), keep=("doc_id", "lang", "source"), ids=True)
