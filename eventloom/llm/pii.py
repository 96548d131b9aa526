"""Personal data by weak supervision, with DataFrame functions only.

Regex, gazetteer and context labelers vote on candidate spans; expectation-maximisation estimates how reliable each
is; the posteriors train a naive Bayes classifier of span features, whose spans join those of the base patterns.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, let, table, without

KINDS = ["email", "ip", "card", "phone"]
# The base patterns. Possessive repeats and a look at the character before only spare backtracking: a
# later start in the same run of characters fails like the first, unless a match has just ended there (\G).
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Stretches without white space that hold a digit or an @: the candidates of the labelers.
CANDIDATE = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
# The gazetteers.
PRIVATE_WORDS = ["password", "passwd", "pwd", "passcode", "pin", "secret", "token", "api_key", "apikey", "key", "bearer", "auth", "credential", "login", "ssn", "iban", "account", "phone", "tel", "mobile", "fax", "mail", "email", "e-mail", "ip", "card", "visa", "contact"]
PLAIN_WORDS = ["version", "license", "licence", "page", "pages", "chapter", "section", "article", "volume", "vol", "no", "nr", "year", "cc", "by", "by-nc", "by-sa", "release", "figure", "table", "step"]
LABELERS = 6
#: Kind of a candidate that is never added: a number as long as a card's that fails the Luhn test.
NOTHING = -1
#: Matches are placed in blocks of so many, so that arrays are not copied once a match.
BLOCK = 128


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    back = F.split(F.reverse(digits), "")
    value = lambda d, i: let(d.cast("int") * (1 + i % 2), lambda x: F.when(x > 9, x - 9).otherwise(x))
    return F.aggregate(F.transform(F.filter(back, lambda d: d != ""), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _ip(m: Column) -> Column:
    part = lambda p: let(F.regexp_replace(p, "^0+", ""), lambda q: (F.length(q) <= 3) & (F.coalesce(q.try_cast("int"), F.lit(0)) <= 255))
    return F.forall(F.split(m, r"\."), part)


CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True),
    "ip": _ip,
    "card": lambda m: let(_digits(m), lambda d: F.length(d).between(12, 19) & luhn(d)),
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
}


def placed(text: Column, pattern: str) -> Column:
    """array<struct<start, m, before>>: each match, its place in code points, and the 48 characters before it.

    Split leaves what lies between the matches, so places are running sums of lengths; sums run inside blocks of
    matches first and then over blocks.
    """
    kind = "array<struct<start:int,m:string,before:string>>"

    def inside(zipped: Column) -> Column:  # struct<at, out> of one block, from 0
        step = lambda a, z: F.struct(
            (a["at"] + F.length(z["g"]) + F.length(z["m"])).alias("at"),
            F.array_append(a["out"], F.struct((a["at"] + F.length(z["g"])).alias("start"), z["m"].alias("m"), F.substring(z["g"], -48, 48).alias("before"))).alias("out"),
        )
        return F.aggregate(zipped, F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")), step)

    def over(s: Column) -> Column:
        zipped = F.arrays_zip(F.slice(s["g"], F.lit(1), F.size(s["m"])).alias("g"), s["m"].alias("m"))
        starts = F.sequence(F.lit(1), F.size(s["m"]), F.lit(BLOCK))
        blocks = let(zipped, lambda z: F.transform(starts, lambda i: inside(F.slice(z, i, F.lit(BLOCK)))))
        shift = lambda out, by: F.transform(out, lambda x: F.struct((x["start"] + by).alias("start"), x["m"].alias("m"), x["before"].alias("before")))
        step = lambda a, b: F.struct((a["at"] + b["at"]).alias("at"), F.concat(a["out"], shift(b["out"], a["at"])).alias("out"))
        return F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out")), step)["out"]

    both = F.struct(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    return let(both, lambda s: F.when(F.size(s["m"]) > 0, over(s)).otherwise(F.array().cast(kind)))


def base_spans(text: Column) -> Column:
    """array<struct<start, kind, end>> of the base patterns, by start and kind."""
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    sign = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}

    def of(n: int, kind: str) -> Column:
        ok = F.filter(placed(text, PATTERNS[kind]), lambda x: CHECKS[kind](x["m"]))
        spans = F.transform(ok, lambda x: F.struct(x["start"].alias("start"), F.lit(n).alias("kind"), (x["start"] + F.length(x["m"])).alias("end")))
        return F.when(sign.get(kind, F.lit(True)), spans).otherwise(empty)

    found = [of(n, kind) for n, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*found))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, "+").when(no, "-").otherwise("0")


def candidates(text: Column, base: Column) -> Column:
    """array<struct<start, end, kind, base, votes, f>> of the candidate spans: votes of the labelers, and features f."""
    head = r"^[^\p{L}\p{N}@+]*(?:[A-Za-z_]+[=:][\"']?)?"
    tail = r"[^\p{L}\p{N}]+$"

    def one(x: Column) -> Column:
        lead = F.regexp_extract(x["m"], head, 0)
        core = F.regexp_replace(F.substring(x["m"], F.length(lead) + 1, F.length(x["m"])), tail, "")
        name = F.lower(F.regexp_extract(lead, r"([A-Za-z_]+)[=:][\"']?$", 1))
        before = F.lower(F.regexp_extract(x["before"], r"([\p{L}_-]+)[^\p{L}]*$", 1))
        return let(F.struct(x["start"].alias("at"), F.length(lead).alias("lead"), core.alias("v"), name.alias("name"), before.alias("word"), x["before"].alias("before")), judged)

    def judged(s: Column) -> Column:
        v, start = s["v"], s["at"] + s["lead"]
        end = start + F.length(v)
        digits, size = F.length(_digits(v)), F.length(v)
        letters = F.length(F.regexp_replace(v, r"[^\p{L}]", ""))
        distinct = F.size(F.array_distinct(F.split(F.substring(v, 1, 64), "")))
        assigned = (s["name"] != "") | s["before"].rlike(r"[=:]\s*[\"']?\s*$")
        hit = F.exists(base, lambda b: (b["start"] < end) & (b["end"] > start))
        private, plain = F.array(*map(F.lit, PRIVATE_WORDS)), F.array(*map(F.lit, PLAIN_WORDS))
        votes = F.concat(
            _vote(hit, F.lit(False)),
            _vote(v.rlike(r"^(?:(?:AKIA|ASIA)[0-9A-Z]{16}|[0-9a-f]{16,}|(?:sk|ghp|xox[a-z])[-_][A-Za-z0-9_-]{10,}|eyJ[A-Za-z0-9._-]{20,})$"), v.rlike("^[0-9]{1,4}$")),
            _vote(F.array_contains(private, s["name"]) | F.array_contains(private, s["word"]), F.array_contains(plain, s["word"])),
            _vote(assigned, F.lit(False)),
            _vote((digits >= 9) | ((size >= 12) & (digits > 0) & (letters > 0)) | (F.contains(v, F.lit("@")) & (size >= 5)), v.rlike(r"^v?[0-9]{1,3}(?:\.[0-9]{1,3}){0,2}$")),
            _vote((distinct >= 8) & (size >= 12), size <= 5),
        )
        has = lambda p: v.rlike(p).cast("int")
        mask = has("[a-z]") + 2 * has("[A-Z]") + 4 * has("[0-9]") + 8 * has(r"\.") + 16 * has("@") + 32 * has("[-_+()]") + 64 * has(r"[^A-Za-z0-9.@_+()-]")
        length = F.least(F.floor(F.log2(F.greatest(size, F.lit(1)).cast("double"))), F.lit(7)).cast("int")
        share = F.floor(4.0 * digits / F.greatest(size, F.lit(1))).cast("int")
        ahead = F.when(assigned, 2).when(s["word"] == "", 0).otherwise(1)
        kind = F.when(F.contains(v, F.lit("@")), 0).when(v.rlike("^[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}$"), 1).when(v.rlike("^[0-9]{12,19}$"), F.when(luhn(v), 2).otherwise(NOTHING)).when(v.rlike(r"^[+(]?[0-9][0-9().-]{7,}$"), 3).otherwise(4)
        return F.struct(start.alias("start"), end.alias("end"), kind.cast("int").alias("kind"), hit.alias("base"), votes.alias("votes"), F.array(mask, length, share, ahead).alias("f"))

    return F.filter(F.transform(placed(text, CANDIDATE), one), lambda c: c["end"] > c["start"])


def reliabilities(counts: dict[str, int], rounds: int = 60) -> dict[str, float]:
    """Probability that a span of each vote pattern is private, by expectation-maximisation over pattern counts.

    Each labeler has a table of how often it says +, 0 or - of private and of plain spans, given which the votes are
    independent. It starts from the majority of the votes.
    """
    posterior = {}
    for p in counts:
        lean = p.count("+") - p.count("-")
        posterior[p] = 1 / (1 + math.exp(-2 * lean)) if lean else 0.3
    for _ in range(rounds):
        weight = {y: sum(n * (posterior[p] if y else 1 - posterior[p]) for p, n in counts.items()) for y in (0, 1)}
        said = {(y, k, v): 0.5 for y in (0, 1) for k in range(LABELERS) for v in "+0-"}
        for p, n in counts.items():
            for y in (0, 1):
                for k, v in enumerate(p):
                    said[y, k, v] += n * (posterior[p] if y else 1 - posterior[p])
        for p in counts:
            odds = math.log((weight[1] + 1) / (weight[0] + 1))
            odds += sum(math.log(said[1, k, v] / (weight[1] + 1.5)) - math.log(said[0, k, v] / (weight[0] + 1.5)) for k, v in enumerate(p))
            posterior[p] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
    return posterior


def find_pii(docs: DataFrame, *, text: str = "text", spans: str = "pii", threshold: float = 0.5) -> DataFrame:
    """docs without its text, with `spans`: array<struct<start, kind, end, base>>, by start and kind.

    start and end (exclusive) count code points. Kinds are those of KINDS and 4, a secret. Spans of the base
    patterns (base true) are always there. Candidates are stretches without white space with a digit or an @,
    without the quotes, marks and name= around them; the classifier adds those that it finds private and that
    overlap no base span.

    Votes and features are kept in a checkpoint without the texts. What reaches the driver are counts of vote
    patterns (3^6 at most) and of feature values (under 200); both are sums over all rows. Null or empty texts have
    no spans; repeated rows give repeated rows; all other columns pass through, but one named `spans` is replaced. Nothing is shuffled but counts.
    """
    docs = without(docs, spans)
    names = [c for c in docs.columns if c != text]
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    some = docs.select(*[F.col(f"`{c}`").alias(f"in_{k}") for k, c in enumerate(names)], F.when(t.rlike("[0-9@]"), t).alias("t_"))
    none = "array<struct<start:int,kind:int,end:int>>"
    some = some.withColumn("b_", F.when(F.col("t_").isNotNull(), base_spans(F.col("t_"))).otherwise(F.array().cast(none)))
    some = some.withColumn("c_", F.when(F.col("t_").isNotNull(), candidates(F.col("t_"), F.col("b_"))))
    found = cut(some.drop("t_"))
    each = found.select(F.explode("c_").alias("c")).select("c.*")
    counts = {r["votes"]: r["n"] for r in each.groupBy("votes").agg(F.count("*").alias("n")).collect()}
    posterior = reliabilities(counts) if counts else {}
    private = F.create_map(*[x for p, q in posterior.items() for x in (F.lit(p), F.lit(q))])[F.col("votes")] if posterior else F.lit(0.0)
    sums = each.select(F.posexplode("f").alias("k", "v"), private.alias("q")).groupBy("k", "v").agg(F.sum("q").alias("yes"), F.sum(1 - F.col("q")).alias("no")).collect()
    total = {y: sum(r[y] for r in sums if r["k"] == 0) for y in ("yes", "no")}
    odds: dict[tuple[int, int], float] = {}
    for r in sums:
        values = sum(1 for x in sums if x["k"] == r["k"])
        odds[r["k"], r["v"]] = math.log((r["yes"] + 1) / (total["yes"] + values)) - math.log((r["no"] + 1) / (total["no"] + values))
    prior = math.log((total["yes"] + 1) / (total["no"] + 1)) if sums else 0.0
    table_of = F.create_map(*[x for (k, v), w in odds.items() for x in (F.lit(k * 1000 + v), F.lit(w))]) if odds else F.create_map(F.lit(0), F.lit(0.0))

    def weight(c: Column) -> Column:
        return F.aggregate(F.transform(c["f"], lambda v, k: F.coalesce(table_of[k * 1000 + v], F.lit(0.0))), F.lit(prior), lambda a, x: a + x)

    least = math.log(threshold / (1 - threshold))
    own = F.transform("b_", lambda b: F.struct(b["start"].alias("start"), b["kind"].alias("kind"), b["end"].alias("end"), F.lit(True).alias("base")))
    added = F.filter(F.coalesce(F.col("c_"), F.array()), lambda c: ~c["base"] & (c["kind"] != NOTHING) & (weight(c) >= least))
    added = F.transform(added, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), F.lit(False).alias("base")))
    return found.select(*[F.col(f"in_{k}").alias(c) for k, c in enumerate(names)], F.array_sort(F.concat(own, added)).alias(spans))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document."""
    out = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    names = F.array(*map(F.lit, [*KINDS, "secret"]))
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("pii", lambda s: s["base"])
    count = lambda n: F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == n))).cast("long")
    added = lambda n: F.size(F.filter("pii", lambda s: ~s["base"] & (s["kind"] == n))).cast("long")
    more = [added(n).alias(f"n_added_{k}") for n, k in enumerate([*KINDS, "secret"])]
    return out.select("doc_id", *[count(n).alias(f"n_{k}") for n, k in enumerate(KINDS)], *more, F.size("pii").cast("long").alias("n_spans"), F.sha2(said(base).cast("binary"), 256).alias("base_sha256"), said(F.col("pii")).alias("spans"))
