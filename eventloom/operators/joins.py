"""Similarity and range joins as equi-joins on keys with the exact rule as the rest."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.matching import alike, ranges_overlap, states_match
from .graph import cut, saved
from .lookup import sized

#: Days are numbered from 0001-01-01 in units of 8, of which there are 2^19; days beyond count as the first or last.
LEVELS, UNIT, DAY_ONE = 19, 8, 719_162
#: Nodes of this level and above are so few (2^15 at most) that the set of those in use is broadcast.
WIDE = 5
#: A word that stands in more distinct names than this is met in pairs of words only.
COMMON = 64
#: A track with more known classes than this in a year is met by title, too.
CROWDED = 256
#: Bits of a node's key that hold its level.
LEVEL_BITS = 5
#: Levels of nodes of whole days, numbered from 0001-01-01; 2^22 days reach beyond the year 9999.
DAY_LEVELS = 22
#: Days of a block of running sums, as a power of 2.
BLOCK = 10
#: Distinct hashes of a tile, on average; tasks that tiles are dealt to at most.
TILE, TILE_TASKS = 2048, 4096


def _nodes(df: DataFrame, a: str, b: str, least: int = 0, most: int | None = None, levels: int = LEVELS) -> DataFrame:
    """df with level_, k_, whole_: a row for each dyadic node of level `least` to `most` that the units a..b are made up of
    (whole_), or that reaches over one of their ends.

    Node x of a level holds the units x * 2^level and on; k_ numbers all nodes. A range is made up of two nodes a level
    at most, and two a level reach over its ends, so a range has at most 4 * 20 rows whatever its length. A level is a
    row before its nodes are, so that all of this is compiled arithmetic.
    """
    level = F.col("level_")
    right = lambda x: F.call_function("shiftright", x, level)
    first, last = right(F.col(a) + F.call_function("shiftleft", F.lit(1), level) - 1), right(F.col(b) + 1) - 1
    at_a, at_b = right(F.col(a)), right(F.col(b))
    outside = lambda x: (x < F.col("first_")) | (x > F.col("last_"))
    base = F.call_function("shiftleft", F.lit(1), F.lit(levels) - level)
    rows = df.withColumn("level_", F.explode(F.sequence(F.lit(least), F.lit(levels if most is None else most)))).withColumns({"first_": first, "last_": last})
    some = F.col("first_") <= F.col("last_")
    code = lambda x, whole: (base + x) * 2 + int(whole)
    codes = F.array(
        F.when(some & (F.col("first_") % 2 == 1), code(F.col("first_"), True)), F.when(some & (F.col("last_") % 2 == 0), code(F.col("last_"), True)),
        F.when(outside(at_a), code(at_a, False)), F.when((at_a != at_b) & outside(at_b), code(at_b, False)),
    )
    rows = rows.withColumn("code_", F.explode(codes)).filter("code_ IS NOT NULL")
    return rows.select(*df.columns, "level_", F.call_function("shiftright", "code_", F.lit(1)).alias("k_"), (F.col("code_") % 2 == 1).alias("whole_"))


def _keyed(df: DataFrame, a: str, b: str, least: int = 0, most: int | None = None, levels: int = LEVELS) -> DataFrame:
    """_nodes() with the level in the lowest bits of k_."""
    k = F.call_function("shiftleft", "k_", F.lit(LEVEL_BITS)) + F.col("level_")
    return _nodes(df, a, b, least, most, levels).select(*df.columns, k.alias("k_"), "whole_")


def _level(k: Column) -> Column:
    return k.bitwiseAND(F.lit((1 << LEVEL_BITS) - 1))


def _day(date: Column) -> Column:
    """The unit that a day is in."""
    return F.least(F.greatest(F.floor((F.unix_date(date) + DAY_ONE) / UNIT), F.lit(0)), F.lit((1 << LEVELS) - 1)).cast("int")


def overlap_join(left: DataFrame, right: DataFrame, condition: Column | None = None, *, start: str = "start", end: str = "end", on: list[str] | None = None) -> DataFrame:
    """Pairs (columns of left as l_*, of right as r_*) whose date ranges overlap.

    Ranges are widened to units of days and cut into dyadic nodes, and two that overlap meet at the node of one that is a node of the other or
    holds one of its nodes: the one that has the later of the two starts, so that no pair comes twice and no cross
    product is made. Short ranges have a few rows below WIDE levels; wider nodes are copied only if the other side
    is made up of them, which a broadcast set of at most 2^15 numbers tells, and narrower ones if the other side has a
    range as long. A range of thousands of years has 80 rows
    at most. Rows are many more than Spark's estimate of them, so neither side is broadcast. One that ends before it starts is taken as the days between; the rule of ranges_overlap() decides.
    A missing end is the start; a missing start pairs with nothing. `on` names further columns that must be equal.
    """

    def days(side: str) -> tuple[Column, Column]:
        a, b = _day(F.col(f"{side}_{start}")), _day(F.coalesce(f"{side}_{end}", f"{side}_{start}"))
        return F.least(a, b), F.greatest(a, b)

    def ranges(df: DataFrame, side: str) -> DataFrame:
        out = df.select(*[F.col(c).alias(f"{side}_{c}") for c in df.columns]).filter(F.col(f"{side}_{start}").isNotNull())
        a, b = days(side)
        return out.withColumns({f"{side}_a_": a, f"{side}_b_": b})

    def used(df: DataFrame, side: str) -> DataFrame:
        """The wide nodes that df is made up of, and -1 - level for each lower level that its longest range allows."""
        a, b = f"{side}_a_", f"{side}_b_"
        long = df.select(a, b).filter(F.col(b) - F.col(a) >= (1 << WIDE) - 1)
        wide = _keyed(long, a, b, WIDE).filter("whole_").select(F.col("k_").alias("used_")).distinct()
        low = F.filter(F.sequence(F.lit(0), F.lit(WIDE - 1)), lambda x: F.call_function("shiftleft", F.lit(1), x) <= F.col("units_"))
        return wide.union(df.agg(F.max(F.col(b) - F.col(a) + 1).alias("units_")).select(F.explode(low).alias("x")).select(-1 - F.col("x")))

    def spread(df: DataFrame, side: str, others: DataFrame) -> DataFrame:
        out = _keyed(df, f"{side}_a_", f"{side}_b_").drop(f"{side}_a_", f"{side}_b_")
        level = _level(F.col("k_"))
        asked = F.when(~F.col("whole_"), F.when(level >= WIDE, F.col("k_")).otherwise(-1 - level))
        return out.join(F.broadcast(others), asked == F.col("used_"), "left").filter(F.col("whole_") | F.col("used_").isNotNull()).drop("used_")

    l, r = ranges(left, "l"), ranges(right, "r")
    l, r = spread(l, "l", used(r, "r")), spread(r, "r", used(l, "l"))
    keys = F.col("l.k_") == F.col("r.k_")
    for c in on or []:
        keys = keys & (F.col(f"l_{c}") == F.col(f"r_{c}"))
    rule = ranges_overlap(F.col(f"l_{start}"), F.col(f"l_{end}"), F.col(f"r_{start}"), F.col(f"r_{end}"))
    level = _level(F.col("l.k_"))
    meeting = F.call_function("shiftright", F.greatest(days("l")[0], days("r")[0]) + (1 << LEVELS), level) == F.call_function("shiftright", "l.k_", F.lit(LEVEL_BITS))
    once = (F.col("l.whole_") | F.col("r.whole_")) & meeting
    out = l.alias("l").hint("merge").join(r.alias("r").hint("merge"), keys & once & rule & (condition if condition is not None else F.lit(True)))
    return out.drop("k_", "whole_")


def overlap_totals(left: DataFrame, right: DataFrame, value: str, *, start: str = "start", end: str = "end", out: str = "total") -> DataFrame:
    """Rows of left whose date range any of right's overlaps, with `out`, the sum of `value` (whole numbers) over those of right.

    No pairs are made: of right's ranges, those that have begun by a range's end, less those that have ended before its
    start, overlap it. Both sums are running ones over days, in blocks of 2^BLOCK days and over the blocks (4,000 of
    them to the year 9999). Pairs with a range that ends before it starts are joined, by overlap_join(). Missing days
    are taken as there.
    """
    day = lambda c: F.unix_date(c).cast("long")
    ranges = lambda df: df.filter(F.col(start).isNotNull()).withColumns({"a_": day(F.col(start)), "b_": day(F.coalesce(end, start))})
    l, r = ranges(left), saved(ranges(right).select("a_", "b_", F.coalesce(value, F.lit(0)).cast("long").alias("v_")))
    odd, none, one = F.col("b_") < F.col("a_"), F.lit(0).cast("long"), F.lit(1).cast("long")
    sums = ["begun_", "begun_n_", "ended_", "ended_n_"]
    at_day = lambda *cols: F.struct(*[c.alias(n) for c, n in zip(cols, ("day_", *sums), strict=True)])
    ends = F.array(at_day(F.col("a_"), F.col("v_"), one, none, none), at_day(F.col("b_") + 1, none, none, F.col("v_"), one))
    days = r.filter(~odd).select(F.explode(ends).alias("x")).select("x.*")
    asked = l.select(F.explode(F.array("a_", "b_")).alias("day_")).distinct().select("day_", *[none.alias(c) for c in sums])
    days = saved(days.union(asked).groupBy("day_").agg(*[F.sum(c).alias(c) for c in sums]).withColumn("block_", F.shiftright("day_", BLOCK)))
    before = Window.orderBy("block_").rowsBetween(Window.unboundedPreceding, -1)
    blocks = days.groupBy("block_").agg(*[F.sum(c).alias(c) for c in sums]).select(F.col("block_").alias("of_"), *[F.coalesce(F.sum(c).over(before), none).alias(f"{c}0") for c in sums])
    within = Window.partitionBy("block_").orderBy("day_").rowsBetween(Window.unboundedPreceding, 0)
    running = days.select("day_", "block_", *[F.sum(c).over(within).alias(c) for c in sums]).join(blocks, F.col("block_") == F.col("of_"))
    running = saved(running.select("day_", *[(F.col(c) + F.col(f"{c}0")).alias(c) for c in sums]))
    at = lambda c, names: sized(running.select(F.col("day_").alias(c), *names))
    found = l.join(at("b_", sums[:2]), "b_").join(at("a_", sums[2:]), "a_")
    found = found.withColumns({"v_": F.when(odd, none).otherwise(F.col("begun_") - F.col("ended_")), "n_": F.when(odd, none).otherwise(F.col("begun_n_") - F.col("ended_n_"))})
    odd_left, odd_right = l.filter(odd), r.filter(odd)
    if not (odd_left.isEmpty() and odd_right.isEmpty()):
        dates = lambda df, *more: df.select(F.date_from_unix_date(F.col("a_").cast("int")).alias("start"), F.date_from_unix_date(F.col("b_").cast("int")).alias("end"), *more)
        pairs = overlap_join(dates(odd_left).distinct(), dates(r, "v_")).union(overlap_join(dates(l.filter(~odd)).distinct(), dates(odd_right, "v_")))
        more = pairs.groupBy(day(F.col("l_start")).alias("a_"), day(F.col("l_end")).alias("b_")).agg(F.sum("r_v_").alias("more_"), F.count("*").alias("more_n_"))
        found = found.join(more, ["a_", "b_"], "left").withColumns({"v_": F.col("v_") + F.coalesce("more_", none), "n_": F.col("n_") + F.coalesce("more_n_", none)})
    return found.filter("n_ > 0").select(*left.columns, F.col("v_").alias(out))


def alike_names(left: DataFrame, right: DataFrame) -> DataFrame:
    """(l, r) of all names of left(name) and right(name) that are alike(), each pair once. Names are distinct and not empty.

    Two names that share two words share a word that stands in COMMON names at most, or two words that stand in
    more: the index has the first words alone and pairs of the others, so no key is both common and idle. A name
    inside another shares its rarest three letters with it (a shorter one, itself).
    """
    both = left.select("name").union(right.select("name"))
    words = lambda df: df.select("name", F.explode(F.array_distinct(F.split("name", " "))).alias("w"))
    often = words(both.distinct()).groupBy("w").agg((F.count("*") > COMMON).alias("often"))

    def by_words(df: DataFrame) -> DataFrame:
        each = words(df).join(often, "w").groupBy("name").agg(F.collect_list(F.when(~F.col("often"), F.col("w"))).alias("few"), F.array_sort(F.collect_list(F.when(F.col("often"), F.col("w")))).alias("many"))
        two = F.flatten(F.transform("many", lambda x, i: F.transform(F.slice("many", i + 2, F.size("many")), lambda y: F.concat_ws(" ", x, y))))
        return each.select("name", F.explode(F.concat("few", two)).alias("key"))

    def gram(x: Column, size: int) -> Column:
        return F.when(F.length(x) >= size, F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(x) - size + 1), lambda i: F.substring(x, i, F.lit(size)))))

    def inside(short: DataFrame, long: DataFrame) -> DataFrame:
        """(short, long) with the first in the second."""
        n = F.col("name")
        held = long.select(n.alias("long"), F.explode(F.concat(*[F.coalesce(gram(n, k), F.array().cast("array<string>")) for k in (1, 2, 3)])).alias("g"))
        held = cut(held)
        rare = held.groupBy("g").agg(F.count("*").alias("n"))
        asked = short.select(n.alias("short"), F.explode(F.when(F.length(n) >= 3, gram(n, 3)).otherwise(F.array(n))).alias("g"))
        # A gram that no long name holds rules its name out.
        best = asked.join(rare, "g", "left").groupBy("short").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g")).alias("m")).filter("m.n > 0")
        return best.select("short", F.col("m.g").alias("g")).join(held.hint("merge"), "g").filter(F.contains("long", "short")).select("short", "long")

    shared = by_words(left).withColumnRenamed("name", "l").hint("merge").join(by_words(right).withColumnRenamed("name", "r").hint("merge"), "key").select("l", "r")
    pairs = shared.union(inside(left, right).toDF("l", "r")).union(inside(right, left).select(F.col("long").alias("l"), F.col("short").alias("r")))
    return pairs.distinct().filter(alike(F.col("l"), F.col("r")))


RECORD = ["track_key", "state", "title_key", "start", "end"]


def classes(records: DataFrame, value: Column, name: str) -> DataFrame:
    """Records that no rule can tell apart, once, with the least value; those that can match nothing are left out."""
    end = F.coalesce("end", "start")
    same = records.select("track_key", F.upper(F.coalesce("state", F.lit(""))).alias("state"), "title_key", "start", end.alias("end"), value.alias(name))
    return same.filter("track_key <> '' AND title_key <> '' AND start IS NOT NULL").groupBy(*RECORD).agg(F.min(name).alias(name))


def _alike_of(new: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of two sides' classes(): pairs (l, r) of tracks that are alike, those of titles, and the known tracks that have more than CROWDED classes in a year."""
    names = lambda df, c: df.select(F.col(c).alias("name")).distinct()
    tracks = saved(alike_names(names(new, "track_key"), names(known, "track_key")))
    titles = saved(alike_names(names(new, "title_key"), names(known, "title_key")))
    crowded = known.groupBy("track_key", F.year("start").alias("y_")).agg(F.count("*").alias("n_")).filter(F.col("n_") > CROWDED).select("track_key").distinct()
    return tracks, titles, saved(crowded)


def _calm(new: DataFrame, known: DataFrame, tracks: DataFrame, crowded: DataFrame, rest: Column) -> DataFrame:
    """Pairs of classes whose known track is not crowded."""
    new = new.join(tracks.toDF("track_key", "track_"), "track_key").join(crowded.toDF("track_"), "track_", "left_anti")
    known = known.join(crowded, "track_key", "left_anti").withColumn("track_", F.col("track_key"))
    return overlap_join(new, known, rest & alike(F.col("l_title_key"), F.col("r_title_key")), on=["track_"]).drop("l_track_", "r_track_")


def _busy(new: DataFrame, known: DataFrame, tracks: DataFrame, titles: DataFrame, crowded: DataFrame, rest: Column) -> DataFrame:
    """Pairs of classes whose known track is crowded; the title is in the key, too."""
    new = new.join(tracks.toDF("track_key", "track_"), "track_key").join(crowded.toDF("track_"), "track_", "left_semi").join(titles.toDF("title_key", "title_"), "title_key")
    known = known.join(crowded, "track_key", "left_semi").withColumns({"track_": F.col("track_key"), "title_": F.col("title_key")})
    return overlap_join(new, known, rest, on=["track_", "title_"]).drop("l_track_", "r_track_", "l_title_", "r_title_")


def same_event_classes(new: DataFrame, known: DataFrame, condition: Column | None = None) -> DataFrame:
    """Pairs of classes() (columns of new as l_*, of known as r_*) that are one event: tracks and titles alike, no two states, dates that overlap.

    Names are matched once each, as distinct names: a class of new goes to the tracks that its own is like, and meets
    the classes of such a track at the nodes of their dates. Where a track has more than CROWDED classes in a
    year, the title is in the key, too, so that all known classes of a key match but for their dates' ends and states.
    """
    tracks, titles, crowded = _alike_of(new, known)
    rest = states_match(F.col("l_state"), F.col("r_state"))
    rest = rest if condition is None else rest & condition
    return _calm(new, known, tracks, crowded, rest).unionByName(_busy(new, known, tracks, titles, crowded, rest))


def _same_sets(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(l, rep) and (rep, r): names l that are like the same names r have one rep, told by number and two 64-bit sums of hashes."""
    marks = pairs.groupBy("l").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("r")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "r")).alias("y"))
    reps = saved(marks.join(marks.groupBy("n", "x", "y").agg(F.min("l").alias("rep")), ["n", "x", "y"]).select("l", "rep"))
    return reps, saved(pairs.join(reps.filter("l = rep"), "l").select("rep", "r"))


def _least_busy(new: DataFrame, known: DataFrame, tracks: DataFrame, titles: DataFrame, crowded: DataFrame) -> DataFrame:
    """RECORD, match: for classes of new the least ord_ of the classes of known on crowded tracks that are the same event.

    No pairs are made: for each track, title, state and dyadic node of days, of the known classes that hold it whole, and of
    those that reach into it, only the least ord_ is kept. Two ranges overlap if a node of one is a node of the other, or holds
    one of its nodes. Names that are like the same names are one. Ranges that end before they start, or that leave
    the numbered days, are joined by _busy().
    """
    odd = (F.col("end") < F.col("start")) | (F.unix_date("start") < -DAY_ONE) | (F.unix_date("end") >= (1 << DAY_LEVELS) - DAY_ONE)
    number = lambda c: F.unix_date(c) + F.lit(DAY_ONE)
    days = lambda df: df.withColumns({"a_": number("start"), "b_": number("end")})
    (track_of, track_to), (title_of, title_to) = _same_sets(tracks.join(crowded.toDF("r"), "r", "left_semi")), _same_sets(titles)
    l = new.filter(~odd).join(track_of.toDF("track_key", "track_"), "track_key").join(title_of.toDF("title_key", "title_"), "title_key")
    l = saved(days(l.withColumn("c_", F.monotonically_increasing_id())))
    r = saved(days(known.filter(~odd).join(crowded, "track_key", "left_semi")).select("track_key", "title_key", "state", "a_", "b_", "ord_"))
    top = [max(0, (df.agg(F.max(F.col("b_") - F.col("a_") + 1).alias("n")).first()["n"] or 1).bit_length() - 1) for df in (l, r)]
    level = _level(F.col("k_"))
    spread = lambda df, other: _keyed(df, "a_", "b_", 0, max(top), DAY_LEVELS).drop("a_", "b_").filter(F.col("whole_") | (level <= other))
    cells = spread(r, top[0]).groupBy("track_key", "title_key", "state", "k_", "whole_").agg(F.min("ord_").alias("ord_"))
    cells = cells.join(track_to.toDF("track_", "track_key"), "track_key").join(title_to.toDF("title_", "title_key"), "title_key")
    cells = cells.groupBy("track_", "title_", "state", "k_", "whole_").agg(F.min("ord_").alias("ord_"))
    asked = spread(l.select("c_", "track_", "title_", "state", "a_", "b_"), top[1])
    x, y = asked.alias("x").hint("merge"), cells.alias("y").hint("merge")
    same = [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("track_", "title_", "k_")]
    met = x.join(y, same[0] & same[1] & same[2] & (F.col("x.whole_") | F.col("y.whole_")) & states_match(F.col("x.state"), F.col("y.state")))
    found = l.select("c_", *RECORD).join(met.groupBy("c_").agg(F.min("ord_").alias("match")), "c_").select(*RECORD, "match")
    if new.filter(odd).isEmpty() and known.filter(odd).isEmpty():
        return found
    rest = states_match(F.col("l_state"), F.col("r_state"))
    pairs = _busy(new.filter(odd), known, tracks, titles, crowded, rest).unionByName(_busy(new.filter(~odd), known.filter(odd), tracks, titles, crowded, rest))
    return found.union(pairs.select(*[f"l_{c}" for c in RECORD], "r_ord_"))


def find_same_event(new: DataFrame, known: DataFrame, *, id: str = "id", order: str = "ord") -> DataFrame:
    """(id, match): for each record of new that has one, the least `order` of the records of known that are the same event.

    Both have track_key, title_key (normalised), state, and start, end as dates. Records that no rule can tell apart
    are matched once, so a thousand copies cost what one does. A null or empty name and a missing start match nothing;
    a missing end is the start; a missing or empty state fits any. Repeated ids of new are one row each id and match.
    """
    end = F.coalesce("end", "start")
    of = new.select(F.col(id).alias("id_"), "track_key", F.upper(F.coalesce("state", F.lit(""))).alias("state"), "title_key", "start", end.alias("end"))
    new, known = saved(classes(new, F.lit(0), "none_").select(*RECORD)), saved(classes(known, F.col(order), "ord_"))
    tracks, titles, crowded = _alike_of(new, known)
    calm = _calm(new, known, tracks, crowded, states_match(F.col("l_state"), F.col("r_state"))).select(*[f"l_{c}" for c in RECORD], "r_ord_")
    best = calm.union(_least_busy(new, known, tracks, titles, crowded)).toDF(*RECORD, "match").groupBy(*RECORD).agg(F.min("match").alias("match"))
    return of.join(best, RECORD).select(F.col("id_").alias(id), "match").distinct()


def event_classes(records: DataFrame, *, id: str = "id") -> tuple[DataFrame, DataFrame]:
    """(id, cid) of the records that can match something, cid the least id of those that no rule can tell apart; and
    (a, b), a < b, the cids of classes that are one event. Records match as their classes do, each class itself."""
    end = F.coalesce("end", "start")
    mine = records.select(F.col(id).alias("id"), "track_key", F.upper(F.coalesce("state", F.lit(""))).alias("state"), "title_key", "start", end.alias("end"))
    each = cut(classes(records, F.col(id), "cid"))
    pairs = same_event_classes(each, each, F.col("l_cid") < F.col("r_cid"))
    return mine.join(each, RECORD).select("id", "cid"), pairs.select(F.col("l_cid").alias("a"), F.col("r_cid").alias("b"))


def hash_join(left: DataFrame, right: DataFrame, *, distance: int = 10, column: str = "phash", condition: Column | None = None) -> DataFrame:
    """Pairs (columns of left as l_*, of right as r_*) of 16-digit hashes that differ in `distance` bits at most.

    Hashes are cut into four blocks, so that some block of a pair differs in two bits at most; the left side goes to all
    values that near, and pairs meet in the first such block only. Beyond distance 11 blocks are no filter, as most
    of their values are near: then tiles of TILE hashes of each side meet, every pair of tiles in one task. That job
    is quadratic, but no task holds more than tiles. Neither side is broadcast, as its rows are many more than Spark's
    estimate of them. Hashes are compared as numbers, and null or shorter ones pair with nothing.
    """
    half = lambda h, at: F.conv(F.substring(h, at, 8), 16, 10).cast("long")
    number = lambda h: F.call_function("shiftleft", half(h, 1), F.lit(32)).bitwiseOR(half(h, 9))
    rows = {s: df.select(*[F.col(c).alias(f"{s}_{c}") for c in df.columns], number(F.col(column)).alias(f"{s}_v_")).filter(F.col(f"{s}_v_").isNotNull()) for s, df in (("l", left), ("r", right))}
    # Hashes are matched once each, however many rows have them, and without the rows' other columns.
    l, r = (rows[s].select(F.col(f"{s}_v_").alias(s)).distinct() for s in ("l", "r"))
    a, b = F.col("l"), F.col("r")
    near = F.bit_count(a.bitwiseXOR(b)) <= distance
    if distance // 4 <= 2:
        value = lambda h, k: F.call_function("shiftright", h, F.lit(48 - 16 * k)).bitwiseAND(F.lit(0xFFFF))
        masks = sorted(sum(1 << b for b in c) for n in range(distance // 4 + 1) for c in combinations(range(16), n))
        blocked = lambda h: F.array(*[F.struct(F.lit(k).alias("k"), value(F.col(h), k).alias("v")) for k in range(4)])
        l = l.withColumn("b_", F.explode(blocked("l"))).withColumn("m_", F.explode(F.array(*map(F.lit, masks)))).select("l", F.col("b_.k").alias("k_"), F.col("b_.v").bitwiseXOR(F.col("m_")).alias("v_"))
        r = r.withColumn("b_", F.explode(blocked("r"))).select("r", F.col("b_.k").alias("k_"), F.col("b_.v").alias("v_"))
        for k in range(3):
            near = near & ((F.col("k_") <= k) | (F.bit_count(value(a, k).bitwiseXOR(value(b, k))) > distance // 4))
        met = l.hint("merge").join(r.hint("merge"), ["k_", "v_"])
    else:
        l, r = cut(l), cut(r)
        tiles = [max(1, -(-df.count() // TILE)) for df in (l, r)]
        tasks = min(tiles[0] * tiles[1], TILE_TASKS)
        of = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        l, r = l.select("l", of("l", tiles[0]).alias("i_"), each(tiles[1]).alias("j_")), r.select("r", each(tiles[0]).alias("i_"), of("r", tiles[1]).alias("j_"))
        met = l.repartition(tasks, "i_", "j_").hint("merge").join(r.repartition(tasks, "i_", "j_").hint("merge"), ["i_", "j_"])
    out = met.filter(near).select("l", "r").join(rows["l"], a == F.col("l_v_")).join(rows["r"], b == F.col("r_v_")).drop("l", "r", "l_v_", "r_v_")
    return out if condition is None else out.filter(condition)


def first_match(pairs: DataFrame, key: str, order: str) -> DataFrame:
    """Of each key's pairs the one with the least order: a grouped minimum, combined before the shuffle."""
    rest = [c for c in pairs.columns if c not in (key, order)]
    return pairs.groupBy(key).agg(F.min(F.struct(order, *rest)).alias("m_")).select(key, f"m_.{order}", *[f"m_.{c}" for c in rest])
