"""Upsert of extracted records into the event table, in input order.

A match is not transitive and a merge changes what later inputs meet, so order counts. Records that could ever meet
are joined first (raw features, by class); within a connected component the inputs are then applied in order, a wave
of a bounded number of them at a time. An input merges only if its own names and dates count, and the merged record
carries just those, so an input meets only records whose last input is of a class like its own: a task needs these
of the records, and the hashes near its inputs' own, not the component.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from datetime import date
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import canonical_track, iso_date, let, normal_title, normal_track, or_else, track_slug
from .graph import components, discard, saved
from .joins import event_classes, hash_join

_ALIASES = {alias.lower(): canonical for canonical, names in fixed.TRACK_ALIASES for alias in names}
_INSIDE = [(re.compile(rf"(^|[^a-z0-9]){re.escape(a)}([^a-z0-9]|$)"), c) for a, c in _ALIASES.items() if len(a) >= 4]
ISO = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")
HASH = re.compile("[0-9a-fA-F]{16}")
INPUT = "seq long, kind string, payload string, phash string, flyer string, status string, new_id string, at string"


def canonical(name: str) -> str:
    plain = name.strip().lower()
    return _ALIASES.get(plain) or next((c for p, c in _INSIDE if p.search(plain)), name)


def track_key(name: str) -> str:
    return " ".join(w for w in canonical(name).lower().split() if w not in fixed.TRACK_STOPWORDS)


def title_key(title: str) -> str:
    return " ".join(w for w in re.findall("[a-z0-9]+", title.lower()) if w not in fixed.TITLE_STOPWORDS)


def slug(name: str | None, state: str | None) -> str | None:
    if not name:
        return None
    out = re.sub("[^a-z0-9]+", "-", track_key(name)).strip("-") + (f"-{state.lower()}" if state else "")
    return out or None


def day(text: str | None) -> date | None:
    if not text or not ISO.fullmatch(text):
        return None
    try:
        return date.fromisoformat(text)
    except ValueError:
        return None


def _alike(a: str, b: str) -> bool:
    return bool(a and b) and (a in b or b in a or len(set(a.split()) & set(b.split())) >= 2)


class Features:
    """What matching looks at in a record, computed once."""

    def __init__(self, record: dict) -> None:
        track, dates = record.get("track") or {}, record.get("dates") or {}
        self.track, self.title = track_key(track.get("name") or ""), title_key(record.get("title") or "")
        self.state = (track.get("state") or "").upper()
        self.start = day(dates.get("start"))
        self.end = day(dates.get("end")) or self.start

    def same(self, other: Features) -> bool:
        if self.state and other.state and self.state != other.state or not self.start or not other.start:
            return False
        return _alike(self.track, other.track) and self.start <= other.end and other.start <= self.end and _alike(self.title, other.title)


def fields(new: dict | None, old: dict | None, names: list[str]) -> dict:
    return {n: (new or {}).get(n) or (old or {}).get(n) for n in names}


def merged(old: dict, new: dict, flyer: dict, at: str) -> dict:
    """The old record with what the new one says: its values where they are not empty, classes of both, the greater confidence, one flyer more."""
    out = old | {f: new[f] for f in ("title", "event_type", "series", "notes") if new.get(f)}
    track = fields(new.get("track"), old.get("track"), ["name", "city", "state"])
    name = canonical(track["name"]) if track["name"] else track["name"]
    dates = new.get("dates") or {}
    return out | {
        "track": {"id": slug(name, track["state"]), "name": name, "city": track["city"], "state": track["state"]},
        "dates": dates if dates.get("start") else old.get("dates") or {},
        "times": fields(new.get("times"), old.get("times"), ["gates_open", "registration_opens", "race_start"]),
        "fees": fields(new.get("fees"), old.get("fees"), ["entry", "spectator"]),
        "contact": fields(new.get("contact"), old.get("contact"), ["phone", "email", "website"]),
        "classes": sorted({*(old.get("classes") or []), *(new.get("classes") or [])}),
        "confidence": max(old.get("confidence") or 0, new.get("confidence") or 0),
        "flyers": [*(old.get("flyers") or []), flyer],
        "updated_at": at,
    }


def merge_columns(old: Column, new: Column, flyer: Column, at: Column) -> Column:
    """merged() as an expression on two structs of EVENT, for tables of pairs that are known to match."""
    part = lambda of, names: F.struct(*[or_else(new[of][n], old[of][n]).alias(n) for n in names]).alias(of)
    track = {n: or_else(new["track"][n], old["track"][n]) for n in ("name", "city", "state")}
    name = F.when(F.coalesce(track["name"], F.lit("")) != "", canonical_track(track["name"])).otherwise(track["name"])
    none = F.array().cast("array<string>")
    whole = F.struct(name.alias("name"), track["city"].alias("city"), track["state"].alias("state"))
    return let(whole, lambda t: F.struct(
        old["id"].alias("id"), *[or_else(new[n], old[n]).alias(n) for n in ("title", "event_type", "series", "notes")],
        F.struct(track_slug(t["name"], t["state"]).alias("id"), t["name"].alias("name"), t["city"].alias("city"), t["state"].alias("state")).alias("track"),
        F.when(F.coalesce(new["dates"]["start"], F.lit("")) != "", new["dates"]).otherwise(old["dates"]).alias("dates"),
        part("times", ["gates_open", "registration_opens", "race_start"]), part("fees", ["entry", "spectator"]), part("contact", ["phone", "email", "website"]),
        F.array_sort(F.array_union(F.coalesce(old["classes"], none), F.coalesce(new["classes"], none))).alias("classes"),
        F.greatest(F.coalesce(old["confidence"], F.lit(0.0)), F.coalesce(new["confidence"], F.lit(0.0))).alias("confidence"),
        F.concat(F.coalesce(old["flyers"], F.array().cast("array<struct<file:string,phash:string,processed_at:string>>")), F.array(flyer)).alias("flyers"),
        old["created_at"].alias("created_at"), at.alias("updated_at"),
    ))


def bits(a: str, b: str) -> int:
    """Bits in which two hashes differ; more than any if one is no hash of 16 hexadecimal digits."""
    if not HASH.fullmatch(a) or not HASH.fullmatch(b):
        return 65
    return (int(a, 16) ^ int(b, 16)).bit_count()


_CATALOG = {i: {"id": i, "name": n, "city": c, "state": s, "contact": {"phone": p, "email": e, "website": w}} for i, n, c, s, p, e, w in fixed.TRACK_CATALOG}
SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*:")


def repaired(record: dict) -> dict:
    """A record read from an image, its website stripped and with https:// before it if it has a dot and no scheme."""
    contact = record.get("contact")
    site = (contact.get("website") or "").strip() if isinstance(contact, dict) else ""
    if not site:
        return record
    return record | {"contact": contact | {"website": f"https://{site}" if "." in site and not SCHEME.match(site) else site}}


def built(record: dict, kind: str) -> dict:
    """What a new event takes from a record: its track with an id; for an image, what the catalog knows of track and contact too."""
    track, contact = record.get("track") or {}, record.get("contact")
    track = {"id": slug(track.get("name"), track.get("state")), "name": track.get("name"), "city": track.get("city"), "state": track.get("state")}
    known = _CATALOG.get(fixed.SLUG_ALIASES.get(track["id"], track["id"])) if kind == "image" else None
    out = {"track": track}
    if known:
        out["track"] = {"id": known["id"]} | {f: track[f] or known[f] for f in ("name", "city", "state")}
        if contact is not None:
            out["contact"] = contact | {f: contact.get(f) or known["contact"][f] for f in ("phone", "email", "website")}
    return out


class Hashes:
    """Hashes seen so far, found by the blocks in which two that are near differ in few bits."""

    BLOCKS, BITS = 4, 16

    def __init__(self, distance: int) -> None:
        self.distance, self.known = distance, set()
        self.blocks: list[dict[int, list[int]]] = [{} for _ in range(self.BLOCKS)]
        self.masks = [sum(1 << b for b in c) for n in range(min(distance // self.BLOCKS, 2) + 1) for c in combinations(range(self.BITS), n)] if distance // self.BLOCKS <= 2 else []

    def add(self, text: str) -> None:
        if HASH.fullmatch(text) and (h := int(text, 16)) not in self.known:
            self.known.add(h)
            for k, block in enumerate(self.blocks):
                block.setdefault(h >> self.BITS * k & 0xFFFF, []).append(h)

    def near(self, text: str) -> bool:
        if not HASH.fullmatch(text):
            return False
        h = int(text, 16)
        if not self.masks or len(self.known) < self.BLOCKS * len(self.masks):
            return any((h ^ x).bit_count() <= self.distance for x in self.known)
        return any((h ^ x).bit_count() <= self.distance for k, block in enumerate(self.blocks) for m in self.masks for x in block.get(h >> self.BITS * k & 0xFFFF ^ m, ()))


def _read(payload: str | None) -> dict | None:
    """The record of a text; None if the text is no JSON object."""
    try:
        record = json.loads(payload) if payload else {}
    except ValueError:
        return None
    return record if isinstance(record, dict) else None


class Fold:
    """Applies rows of INPUT in seq order to the records before them.

    Existing records have the kind `event`, those that earlier waves made the kind `record`, and a row of the kind
    `hash` tells a hash that they saw. apply() gives the outcome of an input (duplicate, skipped, error, merged, new;
    None for other kinds), and finish() the records. Records are kept as text and as what matching looks at, and found
    by the weeks of their dates (those of over a year are always looked at). An input whose payload is no record, or
    has other types than a record's, has the outcome `error`; an existing one stays as it is and matches nothing.
    """

    def __init__(self, distance: int = fixed.HASH_DISTANCE) -> None:
        self.seqs: list[int] = []
        self.texts: list[str | None] = []
        self.marks: list[Features] = []
        self.last: list[int | None] = []
        self.hashes = Hashes(distance)
        self.weeks: dict[int, list[int]] = {}
        self.long: list[int] = []

    @staticmethod
    def _weeks(mark: Features) -> range:
        return range(mark.start.toordinal() // 7, mark.end.toordinal() // 7 + 1) if mark.start else range(0)

    def _put(self, at: int, text: str | None, mark: Features, last: int | None) -> None:
        self.texts[at], self.marks[at], self.last[at] = text, mark, last
        weeks = self._weeks(mark)
        for of in [self.long] if len(weeks) > 53 else [self.weeks.setdefault(w, []) for w in weeks]:
            if not of or of[-1] != at:
                of.append(at)

    def _add(self, seq: int, text: str | None, mark: Features, last: int | None) -> None:
        for column in (self.seqs, self.texts, self.marks, self.last):
            column.append(None)
        self.seqs[-1] = seq
        self._put(len(self.seqs) - 1, text, mark, last)

    def _first(self, mark: Features) -> int | None:
        weeks = self._weeks(mark)
        near = range(len(self.seqs)) if len(weeks) > 53 else sorted({n for w in weeks for n in self.weeks.get(w, ())} | set(self.long))
        return next((n for n in near if mark.same(self.marks[n])), None)

    def _keep(self, r: dict) -> None:
        record = _read(r["payload"])
        try:
            text, mark = json.dumps(record, ensure_ascii=False, sort_keys=True), Features(record or {})
            seen = [f["phash"] for f in (record or {}).get("flyers") or [] if f.get("phash")]
        except (AttributeError, KeyError, TypeError):
            record = None
        if record is None:
            text, mark, seen = r["payload"], Features({}), []
        self._add(r["seq"], text, mark, r["seq"] if r["kind"] == "event" else r["last"])
        for h in seen:
            self.hashes.add(h)

    def apply(self, r: dict) -> str | None:
        if r["kind"] == "hash":
            self.hashes.add(r["phash"])
            return None
        if r["kind"] in ("event", "record"):
            self._keep(r)
            return None
        if r["kind"] == "image" and r["phash"] and self.hashes.near(r["phash"]):
            return "duplicate"
        if r["status"] != "ok":
            return r["status"]
        if (record := _read(r["payload"])) is None:
            return "error"
        flyer = {"file": r["flyer"], "phash": r["phash"] or None, "processed_at": r["at"]}
        dumped = lambda x: json.dumps(x, ensure_ascii=False, sort_keys=True)
        try:
            if r["kind"] == "image":
                record = repaired(record)
            at = self._first(Features(record))
            if at is not None:
                out = merged(json.loads(self.texts[at]), record, flyer, r["at"])
            else:
                out = {"id": r["new_id"]} | record | built(record, r["kind"]) | {"flyers": [flyer], "created_at": r["at"], "updated_at": r["at"]}
            text, mark = dumped(out), Features(out)
        except (AttributeError, KeyError, TypeError):
            return "error"
        if flyer["phash"]:
            self.hashes.add(flyer["phash"])
        if at is not None:
            self._put(at, text, mark, r["seq"])
            return "merged"
        self._add(r["seq"], text, mark, r["seq"])
        return "new"

    def finish(self) -> Iterator[tuple[int, str, int]]:
        yield from zip(self.seqs, self.texts, self.last)


def fold(rows: list[dict], distance: int = fixed.HASH_DISTANCE) -> Iterator[dict]:
    """Fold over rows in seq order: a row for every input (seq, outcome) and then for every record (seq, payload)."""
    f = Fold(distance)
    for r in sorted(rows, key=lambda r: r["seq"]):
        if (outcome := f.apply(r)) is not None:
            yield {"seq": r["seq"], "outcome": outcome}
    for seq, text, _ in f.finish():
        yield {"seq": seq, "payload": text}


def _wave(rows: DataFrame, distance: int) -> DataFrame:
    """(seq, outcome, payload, last) of a wave's inputs and records: each component's rows in one task, as a sorted stream."""
    schema = "seq long, outcome string, payload string, last long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, f = None, Fold(distance)
        held: list[tuple[int, str | None, str | None, int | None]] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*held)) or [(), (), (), ()]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.int64()))], ["seq", "outcome", "payload", "last"])

        for b in batches:
            for r in b.to_pylist():
                if r["component"] != now:
                    held += [(seq, None, text, last) for seq, text, last in f.finish()]
                    now, f = r["component"], Fold(distance)
                if (outcome := f.apply(r)) is not None:
                    held.append((r["seq"], outcome, None, None))
                if len(held) >= 2000:
                    yield out()
        held += [(seq, None, text, last) for seq, text, last in f.finish()]
        yield out()

    each = rows.repartition("component").sortWithinPartitions("component", F.asc_nulls_first("seq")).mapInArrow(run, schema)
    return each.groupBy("seq").agg(F.max("outcome").alias("outcome"), F.max("payload").alias("payload"), F.max("last").alias("last"))


def _waves(rows: DataFrame, most: int) -> DataFrame:
    """rows(component, seq, ...) with wave: 0 for the first `most` rows of a component in seq order, and so on.

    Ranks are local ranks in ranges of the sorted rows plus the counts of earlier ranges, so that no task ranks a component.
    """
    ranged = saved(rows.select("component", "seq").repartitionByRange(F.col("component"), F.col("seq")).withColumn("part", F.spark_partition_id()))
    before = ranged.groupBy("component", "part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy("component").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    local = F.row_number().over(W.partitionBy("component", "part").orderBy("seq"))
    ranks = ranged.withColumn("r", local).join(before.select("component", "part", "before"), ["component", "part"])
    return rows.join(ranks.select("seq", F.floor((F.col("before") + F.col("r") - 1) / most).cast("int").alias("wave")), "seq")


def upsert(rows: DataFrame, *, distance: int = fixed.HASH_DISTANCE, wave: int = 5000) -> DataFrame:
    """seq, outcome, payload: the outcome of each input and the record at each place in the list that has one.

    rows are INPUT, existing records first in seq, which is unique. Components of at most `wave` rows are folded in
    one go. Of a larger one, a wave applies the next `wave` rows: its task reads them, the records whose last input's
    class is like one of theirs, and the hashes near theirs that earlier waves saw; what it changes is written to
    the shared folder before the next wave. So no task holds a component; the waves of one follow each other, as its
    inputs do. Null names, titles or dates match nothing, nor does a hash that is not 16 hexadecimal digits; an input
    with a payload that is no record has the outcome `error`.
    """
    rows = saved(rows)
    raw = rows.withColumn("v", F.from_json("payload", "title string, track struct<name:string,state:string>, dates struct<start:string,end:string>, flyers array<struct<phash:string>>"))
    start = iso_date(F.col("v.dates.start"))
    ok = raw.filter("status = 'ok'").select(F.col("seq").alias("id"), normal_track(canonical_track(F.col("v.track.name"))).alias("track_key"), F.col("v.track.state").alias("state"), normal_title(F.col("v.title")).alias("title_key"), start.alias("start"), F.coalesce(iso_date(F.col("v.dates.end")), start).alias("end"))
    members, pairs = map(saved, event_classes(ok))
    own = F.transform(F.filter(F.coalesce("v.flyers", F.array()), lambda f: (F.col("kind") == "event") & f["phash"].isNotNull()), lambda f: f["phash"])
    hashes = raw.select("seq", F.explode(F.array_distinct(F.concat(F.array("phash"), F.coalesce(own, F.array().cast("array<string>"))))).alias("h")).filter("h rlike '^[0-9a-fA-F]{16}$'").select("seq", F.lower("h").alias("h"))
    hashes = saved(hashes)
    distinct = saved(hashes.groupBy("h").agg(F.min("seq").alias("first")))
    near = saved(hash_join(distinct.select(F.col("h").alias("phash"), "first"), distinct.select(F.col("h").alias("phash"), "first"), distance=distance, condition=F.col("l_first") <= F.col("r_first")))
    links = members.select(F.col("cid").alias("a"), F.col("id").alias("b")).union(pairs)
    links = links.union(hashes.join(distinct, "h").select("first", "seq")).union(near.select("l_first", "r_first"))
    labels = components(rows.select(F.col("seq").alias("id")), links.filter("a <> b"))
    joined = rows.join(labels.withColumnRenamed("id", "seq"), "seq").withColumn("last", F.lit(None).cast("long"))
    parts = saved(_waves(joined, wave))
    done = saved(_wave(parts.filter("wave = 0").drop("wave"), distance))
    count = parts.agg(F.max("wave")).first()[0] or 0
    if not count:
        return done.select("seq", "outcome", "payload")

    either = saved(pairs.union(pairs.select("b", "a")).union(members.select("cid", "cid").distinct().toDF("a", "b")).toDF("cid", "like"))
    alike_hashes = saved(near.select(F.col("l_phash").alias("h"), F.col("r_phash").alias("seen")).union(near.select("r_phash", "l_phash")).distinct())
    applied = lambda out: out.filter("outcome IN ('new', 'merged')").select("seq")
    columns = joined.columns
    large = parts.filter("wave = 1").select("component").distinct()
    place = saved(parts.select("seq", "component").join(large, "component"))
    state = saved(done.filter("payload IS NOT NULL").select("seq", "payload", "last").join(place, "seq"))
    outs = [done]
    events = parts.filter("kind = 'event'").select("seq", "wave")
    seen = saved(hashes.join(applied(done).union(events.filter("wave = 0").select("seq")), "seq").select("h").distinct())
    for k in range(1, count + 1):
        inputs = parts.filter(F.col("wave") == k).drop("wave")
        of = inputs.select("seq", "component").join(members.withColumnRenamed("id", "seq"), "seq").select("component", "cid").distinct()
        asked = of.join(either, "cid").select("component", F.col("like").alias("cid")).distinct()
        held = state.join(members.withColumnRenamed("id", "last"), "last", "left")
        needed = held.join(asked, ["component", "cid"], "left_semi")
        blank = {c: F.lit(None).cast(dict(joined.dtypes)[c]) for c in columns}
        records = needed.select(*[F.lit("record").alias(c) if c == "kind" else F.col(c) if c in ("seq", "component", "payload", "last") else blank[c].alias(c) for c in columns])
        heard = inputs.select("seq", "component").join(hashes, "seq").join(alike_hashes, "h").select("component", F.col("seen").alias("h")).distinct().join(seen, "h", "left_semi")
        told = heard.select(*[F.lit("hash").alias(c) if c == "kind" else F.col("h").alias(c) if c == "phash" else F.col(c) if c == "component" else blank[c].alias(c) for c in columns])
        out = saved(_wave(inputs.select(*columns).unionByName(records).unionByName(told), distance))
        outs.append(out)
        changed = out.filter("payload IS NOT NULL").select("seq", "payload", "last").join(place, "seq")
        before = state, seen
        state = saved(state.join(changed.select("seq"), "seq", "left_anti").unionByName(changed))
        seen = saved(seen.union(hashes.join(applied(out).union(events.filter(F.col("wave") == k).select("seq")), "seq").select("h")).distinct())
        discard(*before)
    # One scan of all waves' files, however many they are.
    told = rows.sparkSession.read.schema(done.schema).parquet(*[f for out in outs for f in out.inputFiles()]).filter("outcome IS NOT NULL").select("seq", "outcome")
    small = done.filter("payload IS NOT NULL").join(place.select("seq"), "seq", "left_anti").select("seq", "payload")
    payloads = small.unionByName(state.select("seq", "payload"))
    return rows.select("seq").join(told, "seq", "left").join(payloads, "seq", "left").filter("outcome IS NOT NULL OR payload IS NOT NULL").select("seq", "outcome", "payload")
