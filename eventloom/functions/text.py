"""Text, date and URL functions. All take and return Columns and stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed


#: Characters that a name is stripped of: white space as Python knows it.
SPACE = r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once and its expression written once in the plan."""
    return F.transform(F.array(value), use)[0]


def stripped(text: Column) -> Column:
    """Text without white space of any kind at its ends."""
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def words_but(words: Column, stopwords: list[str]) -> Column:
    """Non-empty words that are not stopwords, joined by spaces."""
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(stopwords)), " ")


def normal_title(title: Column, stopwords: list[str] = fixed.TITLE_STOPWORDS) -> Column:
    """Lower-case letters and digits of a title without its stopwords."""
    return words_but(F.split(F.lower(title), "[^a-z0-9]+"), stopwords)


def normal_track(name: Column, stopwords: list[str] = fixed.TRACK_STOPWORDS) -> Column:
    """Lower-case words of a track name without its stopwords; punctuation stays on its word."""
    return words_but(F.split(F.lower(name), rf"{SPACE}+"), stopwords)


def canonical_track(name: Column, aliases: list[tuple[str, list[str]]] = fixed.TRACK_ALIASES) -> Column:
    """The canonical name of an alias: of an equal one, else of the first of four letters or more that stands in the name; else the name itself.

    For alias lists of a few hundred; each alias is one compiled pattern. operators.lookup has a join for longer ones.
    """
    known: dict[str, str] = {}
    for canonical, names in aliases:
        for alias in names:
            known[alias.lower()] = canonical
    longer = [(a, c) for a, c in known.items() if len(a) >= 4]

    def of(n: Column) -> Column:
        hits = None
        for alias, canonical in longer:
            hit = n["plain"].rlike(rf"(^|[^a-z0-9]){re.escape(alias)}([^a-z0-9]|$)")
            hits = F.when(hit, canonical) if hits is None else hits.when(hit, canonical)
        exact = F.create_map(*[x for kv in known.items() for x in map(F.lit, kv)])[n["plain"]] if known else F.lit(None)
        return F.coalesce(exact, hits if hits is not None else F.lit(None), n["name"])

    return let(F.struct(F.lower(stripped(name)).alias("plain"), name.alias("name")), of)


def track_slug(name: Column, state: Column) -> Column:
    """URL-safe id of a track; null without a name. The state follows after a hyphen if it is not empty."""
    stem = F.regexp_replace(F.regexp_replace(normal_track(canonical_track(name)), "[^a-z0-9]+", "-"), "^-+|-+$", "")

    def of(n: Column) -> Column:
        slug = F.when(F.coalesce(n["state"], F.lit("")) != "", F.concat(n["stem"], F.lit("-"), F.lower(n["state"]))).otherwise(n["stem"])
        return F.when(F.coalesce(n["name"], F.lit("")) != "", F.nullif(slug, F.lit("")))

    return let(F.struct(stem.alias("stem"), name.alias("name"), state.alias("state")), of)


def track_with_id(name: Column, city: Column, state: Column) -> Column:
    """A track struct with its id."""
    return F.struct(track_slug(name, state).alias("id"), name.alias("name"), city.alias("city"), state.alias("state"))


def iso_date(text: Column) -> Column:
    """The date of a text that is exactly YYYY-MM-DD; else null."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), text.try_cast("date"))


def in_scope(title: Column, keywords: list[str] = fixed.OUT_OF_SCOPE) -> Column:
    """Whether no out-of-scope word is in the title; a null or empty title is in scope."""
    found = F.lit(False)
    for k in keywords:
        found = found | F.contains(F.lower(title), F.lit(k))
    return ~F.coalesce(found, F.lit(False))


def is_past(start: Column, end: Column, today: date) -> Column:
    """Whether the end (or else the start) is a date before today; no date is not past."""
    return F.coalesce(F.coalesce(iso_date(end), iso_date(start)) < F.lit(today), F.lit(False))


def or_else(new: Column, old: Column) -> Column:
    """new if it is neither null nor empty, else old."""
    return F.when(F.coalesce(new, F.lit("")) != "", new).otherwise(old)


def url_path(url: Column) -> Column:
    """Path of a URL, without parameters, query and fragment."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_host(url: Column) -> Column:
    """Host and port of a URL, as written."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def suffix(path: Column) -> Column:
    """Lower-case suffix of the last part of a path, with its dot; '' if it has none or only begins or ends with a dot."""
    last = F.regexp_extract(F.regexp_replace(path, "/+$", ""), "([^/]*)$", 1)
    return F.lower(F.regexp_extract(last, r"^.+(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    """Last part of a path without its suffix."""
    last = F.regexp_extract(F.regexp_replace(path, "/+$", ""), "([^/]*)$", 1)
    return F.regexp_replace(last, r"^(.+)\.[^.]+$", "$1")


def file_name_of(url: Column) -> Column:
    """A file name for a URL's image: 40 characters of its stem, 8 of its MD5, and its suffix or .jpg."""
    path = url_path(url)
    slug = F.substring(F.regexp_replace(stem(path), r"[^\p{L}\p{N}_]", "-"), 1, 40)
    return F.concat(slug, F.lit("-"), F.substring(F.md5(url.cast("binary")), 1, 8), or_else(suffix(path), F.lit(".jpg")))


def website(text: Column) -> Column:
    """A website with https:// before it if it has a dot and no scheme; blank or null stays as it is."""
    plain = F.trim(text)
    bare = ~plain.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") & F.contains(plain, F.lit("."))
    return F.when(F.coalesce(plain, F.lit("")) == "", text).when(bare, F.concat(F.lit("https://"), plain)).otherwise(plain)


def details(description: Column) -> Column:
    """struct<phone, website, notes> of labelled lines; of repeated labels the last counts; other lines are notes."""
    lines = F.filter(F.transform(F.split(F.coalesce(description, F.lit("")), "\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85  ]"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", "")), lambda x: x != "")
    labelled = lambda x, label: F.startswith(F.lower(x), F.lit(label))

    def last(label: str) -> Column:
        values = F.filter(lines, lambda x: labelled(x, label))
        return F.nullif(F.trim(F.substring(F.try_element_at(values, F.lit(-1)), len(label) + 1, 1 << 30)), F.lit(""))

    notes = F.filter(lines, lambda x: ~labelled(x, "track phone:") & ~labelled(x, "website:"))
    notes = F.filter(F.transform(notes, lambda x: F.trim(F.regexp_replace(x, "^[* ]+|[* ]+$", ""))), lambda x: x != "")
    return F.struct(last("track phone:").alias("phone"), last("website:").alias("website"), notes.alias("notes"))


def city_state(location: Column) -> Column:
    """struct<city, state> of an address line that ends in state and ZIP code; nulls if it does not."""
    compact = F.trim(F.regexp_replace(location, r"(?U)\s+", " "))
    part = lambda n: F.nullif(F.trim(F.regexp_extract(compact, fixed.CITY_STATE, n)), F.lit(""))
    return F.struct(part(1).alias("city"), part(2).alias("state"))


def listing_key(title: Column, date_text: Column) -> Column:
    """Key of a calendar listing."""
    return F.concat(title, F.lit("|"), date_text)


def prompt_text(fields: dict[str, Column], leave_out: tuple[str, ...] = ("source",)) -> Column:
    """Lines `name: value` of the fields that are neither null nor empty, in the order given."""
    lines = [F.when(F.coalesce(c.cast("string"), F.lit("")) != "", F.concat(F.lit(f"{k}: "), c.cast("string"))) for k, c in fields.items() if k not in leave_out]
    return F.concat_ws("\n", *lines)


def date_hint(subject: str, today: date) -> str:
    """What a prompt says about missing years."""
    return fixed.DATE_HINT.format(day=today.isoformat(), year=today.year, subject=subject)


def media_type(path: Column) -> Column:
    """Media type by suffix, image/jpeg by default."""
    return F.coalesce(F.create_map(*[F.lit(x) for kv in fixed.MEDIA_TYPES.items() for x in kv])[suffix(path)], F.lit("image/jpeg"))


def duration(seconds: Column) -> Column:
    """Seconds as `1h 2m 3s`, rounded half to even, at least 0."""
    s = F.greatest(F.bround(seconds, 0).cast("long"), F.lit(0))
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, m, r)).when(m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))


def folder_id(url: Column) -> Column:
    """Id of a shared folder's URL: after /folders/, else the id parameter."""
    direct = F.regexp_extract(url_path(url), "/folders/([A-Za-z0-9_-]+)", 1)
    return F.nullif(or_else(direct, F.regexp_extract(url, r"[?&]id=([^&#]+)", 1)), F.lit(""))


def is_event_page(url: Column, text: Column, words: list[str] = fixed.EVENT_PAGE_WORDS) -> Column:
    """Whether a link's address or text has one of the words."""
    return F.lower(F.concat(url, F.lit(" "), text)).rlike("|".join(map(re.escape, words)))


def hash_distance(a: Column, b: Column) -> Column:
    """Differing bits of two hashes of 16 hexadecimal digits."""
    half = lambda h, at: F.conv(F.substring(h, at, 8), 16, 10).cast("long")
    return F.bit_count(half(a, 1).bitwiseXOR(half(b, 1))) + F.bit_count(half(a, 9).bitwiseXOR(half(b, 9)))


def headers(own: Column, base: dict[str, str]) -> Column:
    """Request headers: the base ones, replaced by a source's own."""
    start = F.create_map(*[F.lit(x) for kv in base.items() for x in kv])
    own = F.coalesce(own, F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(start, lambda k, _: ~F.map_contains_key(own, k)), own)


def by_strategy(own: Column, strategy: Column, defaults: dict[str, float], default: float) -> Column:
    """A source's own value, or else its strategy's, or else the default."""
    known = F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv])
    return F.coalesce(own, known[strategy], F.lit(default))
