"""Lookups in small dimension tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import or_else, stripped

#: Rows up to which a dimension may be broadcast.
BROADCAST_ROWS = 100_000


def sized(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df for a broadcast if it has at most `most` rows, which is checked; else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def alias_table(spark: SparkSession, aliases: list[tuple[str, list[str]]] = fixed.TRACK_ALIASES) -> DataFrame:
    """ord, alias (lower-case), canonical; a repeated alias keeps its first place and takes its last name."""
    known: dict[str, str] = {}
    for canonical, names in aliases:
        for alias in names:
            known[alias.lower()] = canonical
    return spark.createDataFrame([(n, a, c) for n, (a, c) in enumerate(known.items())], "ord int, alias string, canonical string")


#: Automata that this worker has built, by the aliases that they hold; one at a time.
_AUTOMATA: dict[bytes, object] = {}


def _automaton(aliases: tuple[tuple[str, str], ...]) -> object:
    """An Aho-Corasick automaton of the aliases of four letters or more; a match gives the alias' place and length."""
    import ahocorasick

    key = hashlib.sha256(repr(aliases).encode()).digest()
    if key not in _AUTOMATA:
        _AUTOMATA.clear()
        a = ahocorasick.Automaton()
        for place, (alias, _) in enumerate(aliases):
            if len(alias) >= 4:
                a.add_word(alias, (place, len(alias)))
        a.make_automaton()
        _AUTOMATA[key] = a
    return _AUTOMATA[key]


_PLAIN = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


def first_alias(automaton: object, text: str) -> int | None:
    """The first place of the aliases that stand in a text, with no letter or digit of ASCII at either end."""
    best = None
    for end, (place, length) in automaton.iter(text) if len(automaton) else ():
        if (best is None or place < best) and (end + 1 == len(text) or text[end + 1] not in _PLAIN) and (end < length or text[end - length] not in _PLAIN):
            best = place
    return best


def resolve(df: DataFrame, name: str, aliases: DataFrame, out: str = "canonical", *, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with the canonical name of column `name`: of an equal alias, else of the first of four letters or more that
    stands in the name between characters other than letters and digits; else the name itself.

    aliases(ord, alias, canonical), lower-case and distinct, become one automaton for all names, each of which is read
    once, in Arrow batches and where it is: no shuffle. Beyond `most` aliases the same comes from resolve_by_join().
    """
    if aliases.limit(most + 1).count() > most:
        return resolve_by_join(df, name, aliases, out)
    known = tuple((r["alias"], r["canonical"]) for r in aliases.orderBy("ord").collect())
    equal = dict(known)
    kept = [c for c in df.columns if c != out]
    plain = F.lower(stripped(F.col(name)))
    schema = df.select(*kept).schema.add(out, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(known)
        memo: dict[str, str | None] = {}
        for b in batches:
            found = []
            for text, own in zip(b["plain_"].to_pylist(), b["own_"].to_pylist()):
                if text is not None and text not in memo:
                    if len(memo) > 100_000:
                        memo.clear()
                    place = first_alias(automaton, text)
                    memo[text] = equal.get(text, known[place][1] if place is not None else None)
                found.append(own if text is None or memo[text] is None else memo[text])
            yield pa.RecordBatch.from_arrays([*[b[c] for c in kept], pa.array(found, pa.string())], [*kept, out])

    return df.select(*kept, plain.alias("plain_"), F.col(name).alias("own_")).mapInArrow(run, schema)


def resolve_by_join(df: DataFrame, name: str, aliases: DataFrame, out: str = "canonical") -> DataFrame:
    """resolve() for alias tables of any size, by joins.

    Equal aliases are an equi-join. For the others the name's stretches of words are equi-joined with the aliases,
    which is the same as standing between characters other than letters and digits; the first alias of four letters
    or more wins. Names are resolved once each, however often they come.
    """
    plain = F.lower(stripped(F.col(name)))
    names = df.select(F.col(name).alias("n_")).filter("n_ is not null").distinct()
    edge = r"(?<=[a-z0-9])(?=[^a-z0-9])|(?<=[^a-z0-9])(?=[a-z0-9])"
    words = F.filter(F.split(F.lower(stripped(F.col("n_"))), edge), lambda w: w != "")
    longest = aliases.agg(F.max(F.size(F.split("alias", edge)))).first()[0] or 0
    spans = F.flatten(F.transform(F.sequence(F.lit(0), F.size("w_") - 1), lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(max(longest, 1)), F.size("w_") - i)), lambda n: F.array_join(F.slice("w_", i + 1, n), ""))))
    parts = names.withColumn("w_", words).filter(F.size("w_") > 0).withColumn("s_", F.explode(F.array_distinct(spans)))
    inside = parts.join(sized(aliases.filter(F.length("alias") >= 4)), F.col("s_") == F.col("alias")).groupBy("n_").agg(F.min_by("canonical", "ord").alias("in_"))
    exact = aliases.select(F.col("alias").alias("a_"), F.col("canonical").alias("ex_"))
    found = names.join(inside, "n_", "left").join(sized(exact), F.lower(stripped(F.col("n_"))) == F.col("a_"), "left").select("n_", F.coalesce("ex_", "in_").alias("c_")).filter("c_ is not null")
    return df.join(found, df[name] == found["n_"], "left").withColumn(out, F.coalesce("c_", F.col(name))).drop("n_", "c_")


def catalog_table(spark: SparkSession) -> DataFrame:
    """id, name, city, state, contact of the known tracks."""
    rows = [(i, n, c, s, (p, e, w)) for i, n, c, s, p, e, w in fixed.TRACK_CATALOG]
    return spark.createDataFrame(rows, "id string, name string, city string, state string, contact struct<phone:string,email:string,website:string>")


def backfill(df: DataFrame, catalog: DataFrame, slugs: dict[str, str] = fixed.SLUG_ALIASES, *, track: str = "track", contact: str | None = "contact") -> DataFrame:
    """df with missing fields of its track (and of a contact that is not null) taken from the catalog.

    A track is found by its id or the id that a slug alias stands for; one that is not found stays as it is.
    """
    key = F.coalesce(F.create_map(*[F.lit(x) for kv in slugs.items() for x in kv])[F.col(track)["id"]], F.col(track)["id"]) if slugs else F.col(track)["id"]
    known = catalog.select(F.col("id").alias("k_"), F.struct(*catalog.columns).alias("c_"))
    out = df.withColumn("key_", key).join(sized(known), F.col("key_") == F.col("k_"), "left")
    hit = F.col("k_").isNotNull()
    filled = F.struct(F.col("c_.id").alias("id"), *[or_else(F.col(track)[f], F.col(f"c_.{f}")).alias(f) for f in ("name", "city", "state")])
    out = out.withColumn(track, F.when(hit, filled).otherwise(F.col(track)))
    if contact:
        full = F.struct(*[or_else(F.col(contact)[f], F.col("c_.contact")[f]).alias(f) for f in ("phone", "email", "website")])
        out = out.withColumn(contact, F.when(hit & F.col(contact).isNotNull(), full).otherwise(F.col(contact)))
    return out.drop("key_", "k_", "c_")


def enrich_calendar(df: DataFrame, *, location: Column, details: Column, place: Column) -> DataFrame:
    """Extracted calendar events completed from their listing: place, contact, series, classes and notes.

    details is functions.text.details() of the description, place functions.text.city_state() of the location.
    """
    track, contact = F.col("track"), F.col("contact")
    existing = F.trim(F.coalesce("notes", F.lit("")))
    notes = F.array_distinct(F.concat(F.when(existing != "", F.array(existing)).otherwise(F.array().cast("array<string>")), details["notes"]))
    return df.withColumns({
        "track": F.struct(track["id"].alias("id"), track["name"].alias("name"), or_else(track["city"], place["city"]).alias("city"), or_else(track["state"], place["state"]).alias("state")),
        "contact": F.struct(or_else(contact["phone"], details["phone"]).alias("phone"), contact["email"].alias("email"), or_else(contact["website"], details["website"]).alias("website")),
        "series": or_else(F.col("series"), F.lit(fixed.CALENDAR_SERIES)),
        "classes": F.when(F.coalesce(F.size("classes"), F.lit(0)) > 0, F.col("classes")).otherwise(F.array(*map(F.lit, fixed.CALENDAR_CLASSES))),
        "notes": F.nullif(F.array_join(notes, "\n"), F.lit("")),
    })
