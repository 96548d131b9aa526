"""Every operator as a query over the standard tables, with DuckDB SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from ..functions.matching import alike, tracks_match
from ..functions.phash import hash_squares
from ..operators import aggregates as A
from ..operators.graph import cut
from ..operators.joins import find_same_event, first_match, hash_join, overlap_join, overlap_totals
from ..operators.lookup import alias_table, backfill, catalog_table, enrich_calendar, resolve
from ..operators.upsert import merge_columns, upsert
from ..operators.validate import validate
from ..sources import html as H
from . import runs as R
from ..streaming.seen import collect_unseen

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
TODAY = date(1997, 1, 1)
# Parameters of the queries: stopwords, aliases and keywords that occur in the tables.
PART_STOPWORDS = ["small", "red", "ring"]
PART_ALIASES = [("Ring Company", ["small ring", "ring"]), ("Widget Works", ["WIDGET", "blue"]), ("Bolts", ["bolt", "red widget"])]
SCOPE_WORDS = ["ing th", "banquet"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def listed(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def words_sql(words: str, stop: list[str]) -> str:
    return f"array_to_string(list_filter({words}, lambda w: w <> '' AND NOT list_contains({listed(stop)}, w)), ' ')"


TITLE_SQL = lambda s: words_sql(f"regexp_split_to_array(lower({s}), '[^a-z0-9]+')", fixed.TITLE_STOPWORDS)
PATH_SQL = lambda u: f"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"
HOST_SQL = lambda u: f"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"


@query("q01_normal_title", f"SELECT doc_id, {TITLE_SQL('split_part(text, chr(10), 1)')} AS title_key FROM documents")
def q01(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", T.normal_title(F.substring_index("text", "\n", 1)).alias("title_key"))


TRACK_SQL = lambda s, stop: words_sql(f"regexp_split_to_array(lower({s}), '\\s+')", stop)


@query("q02_normal_track", f"SELECT p_partkey, {TRACK_SQL('p_name', PART_STOPWORDS)} AS track_key FROM part")
def q02(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select("p_partkey", T.normal_track(F.col("p_name"), PART_STOPWORDS).alias("track_key"))


_ALIAS_ROWS = ", ".join(f"({n}, '{a}', '{c}')" for n, (a, c) in enumerate((a.lower(), c) for c, names in PART_ALIASES for a in names))


@query("q03_canonical", f"""WITH alias(ord, alias, canonical) AS (VALUES {_ALIAS_ROWS}),
n AS (SELECT DISTINCT p_name, lower(trim(p_name)) AS p FROM part),
hit AS (SELECT p_name, arg_min(canonical, struct_pack(a := CASE WHEN p = alias THEN 0 ELSE 1 END, b := ord)) AS c FROM n JOIN alias ON p = alias OR (length(alias) >= 4 AND regexp_matches(p, '(^|[^a-z0-9])' || alias || '([^a-z0-9]|$)')) GROUP BY p_name)
SELECT p_partkey, coalesce(c, part.p_name) AS canonical FROM part LEFT JOIN hit USING (p_name)""")
def q03(spark: SparkSession, sf: str) -> DataFrame:
    return resolve(table(spark, sf, "part").select("p_partkey", "p_name"), "p_name", alias_table(spark, PART_ALIASES)).select("p_partkey", "canonical")


_STATE = "CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'TX' END"


@query("q04_track_slug", f"""WITH s AS (SELECT s_suppkey, s_name || ' Raceway Park' AS name, n_name AS city, {_STATE} AS state FROM supplier JOIN nation ON s_nationkey = n_nationkey),
k AS (SELECT *, trim(regexp_replace({words_sql("string_split(lower(name), ' ')", fixed.TRACK_STOPWORDS)}, '[^a-z0-9]+', '-', 'g'), '-') AS stem FROM s)
SELECT s_suppkey, CASE WHEN coalesce(state, '') <> '' THEN stem || '-' || lower(state) ELSE stem END AS id, name, city, state FROM k""")
def q04(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select("s_suppkey", T.track_with_id(F.concat("s_name", F.lit(" Raceway Park")), F.col("n_name"), F.expr(_STATE)).alias("t")).select("s_suppkey", "t.*")


_OUT = " OR ".join(f"contains(lower(coalesce(text, '')), '{w}')" for w in SCOPE_WORDS)


@query("q05_in_scope", f"SELECT doc_id, NOT ({_OUT}) AS in_scope FROM documents")
def q05(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", T.in_scope(F.col("text"), SCOPE_WORDS).alias("in_scope"))


_DAY = "CASE o_orderkey % 5 WHEN 0 THEN {d} WHEN 1 THEN substr({d}, 1, 4) WHEN 2 THEN NULL WHEN 3 THEN ' ' || {d} ELSE '1996-02-30' END"


@query("q06_past", f"""WITH o AS (SELECT o_orderkey, {_DAY.format(d="strftime(o_orderdate, '%Y-%m-%d')")} AS e, strftime(o_orderdate, '%Y-%m-%d') AS s FROM orders),
d AS (SELECT o_orderkey, CASE WHEN regexp_full_match(e, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_cast(e AS DATE) END AS de, CASE WHEN regexp_full_match(s, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_cast(s AS DATE) END AS ds FROM o)
SELECT o_orderkey, coalesce(coalesce(de, ds) < DATE '1997-01-01', false) AS past FROM d""")
def q06(spark: SparkSession, sf: str) -> DataFrame:
    day = "date_format(o_orderdate, 'yyyy-MM-dd')"
    return table(spark, sf, "orders").select("o_orderkey", T.is_past(F.expr(day), F.expr(_DAY.format(d=day)), TODAY).alias("past"))


@query("q06b_overlap", """WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 - 3 AS INTEGER) AS e FROM orders)
SELECT a.k AS left_key, b.k AS right_key FROM o a JOIN o b ON a.c = b.c AND a.k < b.k AND a.s <= b.e AND b.s <= a.e""")
def q06b(spark: SparkSession, sf: str) -> DataFrame:
    start = F.col("o_orderdate").cast("date")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("c"), start.alias("start"), F.date_add(start, (F.col("o_orderkey") % 40 - 3).cast("int")).alias("end"))
    return overlap_join(o, o, F.col("l_k") < F.col("r_k"), on=["c"]).select(F.col("l_k").alias("left_key"), F.col("r_k").alias("right_key"))


@query("q06c_wide_ranges", """WITH c AS (SELECT c_custkey, DATE '1995-01-01' + CAST(c_custkey % 2000 AS INTEGER) AS s, DATE '1995-01-01' + CAST(c_custkey % 2000 + floor(abs(c_acctbal) * 7.3) AS INTEGER) AS e FROM customer),
o AS (SELECT CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 AS INTEGER) AS e, count(*) AS n FROM orders GROUP BY ALL)
SELECT c_custkey, CAST(sum(n) AS BIGINT) AS orders FROM c JOIN o ON c.s <= o.e AND o.s <= c.e GROUP BY c_custkey""")
def q06c(spark: SparkSession, sf: str) -> DataFrame:
    """Orders open during each customer's time, which is up to 200 years long."""
    since = F.date_add(F.lit(date(1995, 1, 1)), (F.col("c_custkey") % 2000).cast("int"))
    c = table(spark, sf, "customer").select("c_custkey", since.alias("start"), F.date_add(since, F.floor(F.abs("c_acctbal") * 7.3).cast("int")).alias("end"))
    day = F.col("o_orderdate").cast("date")
    o = table(spark, sf, "orders").groupBy(day.alias("start"), F.date_add(day, (F.col("o_orderkey") % 9).cast("int")).alias("end")).agg(F.count("*").alias("n"))
    whole = lambda df: df.dropna(subset=["start", "end"])
    return overlap_totals(whole(c), whole(o), "n", out="orders").groupBy("c_custkey").agg(F.sum("orders").alias("orders"))


@query("q07_alike", """WITH p AS (SELECT p_brand, lower(p_name) || CASE WHEN p_size % 2 = 0 THEN ' large' ELSE '' END AS n, CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN 'TX' ELSE 'ok' END AS s, count(*) AS c FROM part GROUP BY ALL)
SELECT a.p_brand AS brand, a.n AS name_a, a.s AS state_a, b.n AS name_b, b.s AS state_b, a.c * b.c AS pairs FROM p a JOIN p b ON a.p_brand = b.p_brand AND (a.n, a.s) < (b.n, b.s)
WHERE NOT (a.s <> '' AND b.s <> '' AND upper(a.s) <> upper(b.s)) AND (contains(a.n, b.n) OR contains(b.n, a.n) OR len(list_intersect(list_distinct(string_split(a.n, ' ')), list_distinct(string_split(b.n, ' ')))) >= 2)""")
def q07(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat(F.lower("p_name"), F.when(F.col("p_size") % 2 == 0, " large").otherwise(""))
    state = F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, "TX").otherwise("ok")
    p = table(spark, sf, "part").groupBy(F.col("p_brand").alias("brand"), name.alias("n"), state.alias("s")).agg(F.count("*").alias("c"))
    a, b = p.alias("a"), p.alias("b")
    order = F.struct("a.n", "a.s") < F.struct("b.n", "b.s")
    rule = tracks_match(F.col("a.n"), F.col("a.s"), F.col("b.n"), F.col("b.s")) & alike(F.col("a.n"), F.col("b.n"))
    return a.join(b, (F.col("a.brand") == F.col("b.brand")) & order & rule).select(F.col("a.brand").alias("brand"), F.col("a.n").alias("name_a"), F.col("a.s").alias("state_a"), F.col("b.n").alias("name_b"), F.col("b.s").alias("state_b"), (F.col("a.c") * F.col("b.c")).alias("pairs"))


def _hashes(spark: SparkSession, sf: str) -> DataFrame:
    digit = lambda n: sum((F.when(F.col("embedding")[4 * n + b] > 0, 8 >> b).otherwise(0) for b in range(1, 4)), F.when(F.col("embedding")[4 * n] > 0, 8).otherwise(0))
    code = F.concat(*[F.substring(F.lit("0123456789abcdef"), digit(n) + 1, F.lit(1)) for n in range(16)])
    return table(spark, sf, "embeddings").select("vec_id", code.alias("phash"))


_DIST = "list_sum(list_transform(range(1, 65), lambda i: CASE WHEN (a.embedding[i] > 0) <> (b.embedding[i] > 0) THEN 1 ELSE 0 END))"


@query("q08_hash_join", f"SELECT a.vec_id AS left_id, b.vec_id AS right_id, CAST({_DIST} AS INTEGER) AS distance FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE {_DIST} <= 20")
def q08(spark: SparkSession, sf: str) -> DataFrame:
    h = _hashes(spark, sf)
    pairs = hash_join(h, h, distance=20, condition=F.col("l_vec_id") < F.col("r_vec_id"))
    return pairs.select(F.col("l_vec_id").alias("left_id"), F.col("r_vec_id").alias("right_id"), T.hash_distance(F.col("l_phash"), F.col("r_phash")).cast("int").alias("distance"))


@query("q09_first_match", f"SELECT b.vec_id AS vec_id, min(a.vec_id) AS duplicate_of FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE {_DIST} <= 20 GROUP BY b.vec_id")
def q09(spark: SparkSession, sf: str) -> DataFrame:
    h = _hashes(spark, sf)
    pairs = hash_join(h, h, distance=20, condition=F.col("l_vec_id") < F.col("r_vec_id")).select(F.col("r_vec_id").alias("vec_id"), F.col("l_vec_id").alias("duplicate_of"))
    return first_match(pairs, "vec_id", "duplicate_of")


_STATES = "CASE c_nationkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'TX' ELSE 'ok' END"


@query("q09b_same_event", f"""WITH e AS (SELECT o_orderkey AS k, o_orderstatus AS kind, p_name AS track, {_STATES} AS state, trim(regexp_replace(lower(o_orderpriority), '[^a-z]+', ' ', 'g')) || ' ' || lower(p_brand) AS title,
  CAST(o_orderdate AS DATE) AS s, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 6 AS INTEGER) AS e FROM orders JOIN customer ON o_custkey = c_custkey JOIN part ON p_partkey = o_custkey),
like_(a, b) AS (SELECT a.n, b.n FROM (SELECT DISTINCT track AS n FROM e UNION SELECT DISTINCT title FROM e) a, (SELECT DISTINCT track AS n FROM e UNION SELECT DISTINCT title FROM e) b
  WHERE contains(a.n, b.n) OR contains(b.n, a.n) OR len(list_intersect(string_split(a.n, ' '), string_split(b.n, ' '))) >= 2)
SELECT n.k AS id, min(o.k) AS match FROM e n JOIN like_ t ON t.a = n.track JOIN e o ON o.track = t.b AND n.s <= o.e AND o.s <= n.e JOIN like_ l ON l.a = n.title AND l.b = o.title
WHERE n.kind <> 'F' AND o.kind = 'F' AND NOT (n.state <> '' AND o.state <> '' AND upper(n.state) <> upper(o.state)) GROUP BY n.k""")
def q09b(spark: SparkSession, sf: str) -> DataFrame:
    """For each order that is not finished the first finished one that is the same event by parts' names, states, titles and days."""
    day = F.col("o_orderdate").cast("date")
    e = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(table(spark, sf, "part"), F.col("o_custkey") == F.col("p_partkey"))
    title = F.concat(F.trim(F.regexp_replace(F.lower("o_orderpriority"), "[^a-z]+", " ")), F.lit(" "), F.lower("p_brand"))
    e = e.select(F.col("o_orderkey").alias("id"), "o_orderstatus", F.col("p_name").alias("track_key"), F.expr(_STATES).alias("state"), title.alias("title_key"), day.alias("start"), F.date_add(day, (F.col("o_orderkey") % 6).cast("int")).alias("end"))
    return find_same_event(e.filter("o_orderstatus <> 'F'"), e.filter("o_orderstatus = 'F'"), order="id")


@query("q10_merge", """WITH p AS (SELECT *, 'N' || s_nationkey || ' Alpha' AS own FROM supplier JOIN customer ON c_custkey = s_suppkey)
SELECT s_suppkey, CASE WHEN c_custkey % 3 = 0 THEN s_name ELSE c_mktsegment END AS title, CASE WHEN s_suppkey % 2 = 0 THEN 'old' END AS series, CASE WHEN c_custkey % 4 = 0 THEN 'Xtreme Raceway Park' ELSE own END AS track,
CASE WHEN c_custkey % 4 = 0 THEN 'xtreme-tx' ELSE 'n' || s_nationkey || '-alpha-tx' END AS track_id, CASE WHEN c_custkey % 5 = 0 THEN 'Own' ELSE 'Old' END AS city, CASE WHEN c_custkey % 7 = 0 THEN '1996-02-03' ELSE '1995-01-01' END AS day, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE '1995-01-02' END AS last,
array_to_string(list_sort(list_distinct(['Pro', 'Super', c_mktsegment])), ',') AS classes, greatest(s_suppkey % 10 / 16, c_custkey % 7 / 8) AS confidence, 2 AS flyers FROM p""")
def q10(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as stored events, customers of the same number as what is merged into them."""
    no, when = F.lit(None).cast("string"), lambda n, x, y=None: F.when(F.col("c_custkey") % n == 0, x).otherwise(y)
    both = lambda *names: F.struct(*[no.alias(n) for n in names])
    rest = [both("gates_open", "registration_opens", "race_start").alias("times"), both("entry", "spectator").alias("fees"), both("phone", "email", "website").alias("contact")]
    flyer = lambda name: F.struct(name.alias("file"), no.alias("phash"), no.alias("processed_at"))
    old = F.struct(
        F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("title"), no.alias("event_type"), F.when(F.col("s_suppkey") % 2 == 0, "old").alias("series"), no.alias("notes"),
        F.struct(no.alias("id"), F.concat(F.lit("N"), "s_nationkey", F.lit(" Alpha")).alias("name"), F.lit("Old").alias("city"), F.lit("TX").alias("state")).alias("track"),
        F.struct(F.lit("1995-01-01").alias("start"), F.lit("1995-01-02").alias("end")).alias("dates"), F.array(F.lit("Pro"), F.lit("Super")).alias("classes"), (F.col("s_suppkey") % 10 / 16).alias("confidence"), F.array(flyer(F.lit("a"))).alias("flyers"), no.alias("created_at"), *rest,
    )
    new = F.struct(
        when(3, "", F.col("c_mktsegment")).alias("title"), no.alias("event_type"), no.alias("series"), no.alias("notes"), F.struct(when(4, "XRP", "").alias("name"), when(5, "Own").alias("city"), no.alias("state")).alias("track"),
        F.struct(when(7, "1996-02-03", "").alias("start"), no.alias("end")).alias("dates"), F.array("c_mktsegment").alias("classes"), (F.col("c_custkey") % 7 / 8).alias("confidence"), *rest,
    )
    pairs = table(spark, sf, "supplier").join(table(spark, sf, "customer"), F.col("s_suppkey") == F.col("c_custkey")).select("s_suppkey", old.alias("old"), new.alias("new"))
    m = pairs.select("s_suppkey", merge_columns(F.col("old"), F.col("new"), flyer(F.lit("b")), F.lit("now")).alias("m"))
    return m.select("s_suppkey", "m.title", "m.series", F.col("m.track.name").alias("track"), F.col("m.track.id").alias("track_id"), "m.track.city", F.col("m.dates.start").alias("day"), F.col("m.dates.end").alias("last"), F.array_join("m.classes", ",").alias("classes"), "m.confidence", F.size("m.flyers").alias("flyers"))


def _fold_sql(inputs: str) -> str:
    """In order, each of inputs(seq, track, day, k) is merged into the first event whose track (one in the other) and days, those last merged, meet its own; else it is a new one."""
    return f"""WITH RECURSIVE s AS ({inputs}),
f AS (SELECT CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS outcome, list_filter([{{'seq': CAST(0 AS BIGINT), 'track': '', 'day': CAST(0 AS BIGINT), 'flyers': CAST(0 AS BIGINT)}}], lambda e: e.flyers > 0) AS events
UNION ALL SELECT k, seq, CASE WHEN hit IS NULL THEN 'new' ELSE 'merged' END, CASE WHEN hit IS NULL THEN list_append(events, {{'seq': seq, 'track': track, 'day': day, 'flyers': CAST(1 AS BIGINT)}}) ELSE list_transform(events, lambda e: CASE WHEN e.seq = hit THEN {{'seq': e.seq, 'track': track, 'day': day, 'flyers': e.flyers + 1}} ELSE e END) END
FROM (SELECT s.k, CAST(s.seq AS BIGINT) AS seq, s.track, CAST(s.day AS BIGINT) AS day, f.events, list_filter(f.events, lambda e: abs(e.day - s.day) <= 2 AND (contains(e.track, s.track) OR contains(s.track, e.track)))[1].seq AS hit FROM f JOIN s ON s.k = f.k + 1)),
e AS (SELECT unnest(events) AS e FROM (SELECT arg_max(events, k) AS events FROM f))
SELECT f.seq, f.outcome, e.e.flyers AS flyers FROM f LEFT JOIN e ON e.e.seq = f.seq WHERE f.k > 0"""


def _folded(df: DataFrame, seq: str, track: Column, day: Column, name: str, **how: int) -> DataFrame:
    start = F.date_add(F.lit(date(2024, 1, 1)), day.cast("int"))
    payload = F.to_json(F.struct(
        F.lit("Open Finals").alias("title"), F.lit("bracket").alias("event_type"), F.struct(track.alias("name"), F.lit("TX").alias("state")).alias("track"),
        F.struct(start.cast("string").alias("start"), F.date_add(start, 2).cast("string").alias("end")).alias("dates"), F.array(F.col(name)).alias("classes"), F.lit(0.5).alias("confidence"),
    ))
    rows = df.select(F.col(seq).alias("seq"), F.lit("text").alias("kind"), payload.alias("payload"), F.lit(None).cast("string").alias("phash"), F.col(name).alias("flyer"), F.lit("ok").alias("status"), F.concat(F.lit("e"), F.col(seq)).alias("new_id"), F.lit("2024-01-01T00:00:00+00:00").alias("at"))
    flyers = F.from_json("payload", "flyers array<struct<file:string>>")["flyers"]
    return upsert(rows, **how).select("seq", "outcome", F.when(F.col("payload").isNotNull(), F.size(flyers).cast("long")).alias("flyers"))


@query("q10b_upsert", _fold_sql("SELECT s_suppkey AS seq, 'n' || s_nationkey AS track, s_suppkey * 7 % 300 AS day, row_number() OVER (ORDER BY s_suppkey) AS k FROM supplier"))
def q10b(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers as inputs in order: short ranges of days at tracks named by nation; matches chain and are not transitive."""
    return _folded(table(spark, sf, "supplier"), "s_suppkey", F.concat(F.lit("N"), F.col("s_nationkey")), F.col("s_suppkey") * 7 % 300, "s_name")


@query("q10c_chain", _fold_sql("SELECT c_custkey AS seq, 'n' || c_nationkey % 2 AS track, c_custkey // 2 * 5 // 4 AS day, row_number() OVER (ORDER BY c_custkey) AS k FROM customer"))
def q10c(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as inputs in order: two chains of days that hold them all, folded in waves of 400."""
    return _folded(table(spark, sf, "customer"), "c_custkey", F.concat(F.lit("N"), F.col("c_nationkey") % 2), F.floor(F.floor(F.col("c_custkey") / 2) * 5 / 4), "c_name", wave=400)


@query("q11_first", "SELECT min(doc_id) AS doc_id FROM documents GROUP BY text")
def q11(spark: SparkSession, sf: str) -> DataFrame:
    return A.first_of(table(spark, sf, "documents").select("doc_id", "text"), "text", "doc_id").select("doc_id")


@query("q11b_first_truthy", "SELECT conv_id, role, arg_min(text, turn) FILTER (WHERE coalesce(text, '') <> '') AS text, min(turn) AS turn FROM conversations GROUP BY conv_id, role")
def q11b(spark: SparkSession, sf: str) -> DataFrame:
    return A.first_truthy(table(spark, sf, "conversations"), ["conv_id", "role"], ["text"], "turn")


@query("q12_unseen", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q12(spark: SparkSession, sf: str) -> DataFrame:
    return A.unseen(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", table(spark, sf, "labels")).select("doc_id")


_LINKS = """l AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>', 1)) AS h, unnest(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1)) AS t FROM pages),
m AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || replace(h, '&amp;', '&') AS href, replace(t, '&amp;', '&') AS t FROM l)"""


@query("q13_links", f"WITH {_LINKS} SELECT url, href, t AS text, count(*) AS n FROM m GROUP BY ALL")
def q13(spark: SparkSession, sf: str) -> DataFrame:
    return H.parse_pages(table(spark, sf, "pages"), H.links, H.COLUMNS["links"]).groupBy("url", "href", "text").agg(F.count("*").alias("n"))


@query("q14_event_pages", f"WITH {_LINKS} SELECT DISTINCT url, href FROM m WHERE {HOST_SQL('url')} = {HOST_SQL('href')} AND regexp_matches(lower(href || ' ' || t), 'event|schedule|race|er|ung')")
def q14(spark: SparkSession, sf: str) -> DataFrame:
    links = H.parse_pages(table(spark, sf, "pages"), H.links, H.COLUMNS["links"])
    same = T.url_host(F.col("url")) == T.url_host(F.col("href"))
    return A.first_of(links.filter(same & T.is_event_page(F.col("href"), F.col("text"), ["event", "schedule", "race", "er", "ung"])), ["url", "href"], "ord").select("url", "href")


_LAST = f"regexp_extract(regexp_replace({PATH_SQL('url')}, '/+$', ''), '([^/]*)$', 1)"


@query("q15_file_name", f"""SELECT page_id, substr(regexp_replace(regexp_replace({_LAST}, '^(.+)\\.[^.]+$', '\\1'), '[^\\p{{L}}\\p{{N}}_]', '-', 'g'), 1, 40) || '-' || substr(md5(url), 1, 8)
|| CASE WHEN regexp_extract({_LAST}, '^.+(\\.[^.]+)$', 1) <> '' THEN lower(regexp_extract({_LAST}, '^.+(\\.[^.]+)$', 1)) ELSE '.jpg' END AS file_name FROM pages""")
def q15(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", T.file_name_of(F.col("url")).alias("file_name"))


def _ads(url: str, html: str):
    return ({"ord": n, "text": x.text()} for n, x in enumerate(H.parse(html).all(H.has_class("^ad$"))))


@query("q16_class_text", """SELECT url, replace(replace(trim(regexp_extract(html, '<div class="ad">([^<]*)</div>', 1)), '&quot;', '"'), '&amp;', '&') AS text, count(*) AS n FROM pages GROUP BY ALL""")
def q16(spark: SparkSession, sf: str) -> DataFrame:
    return H.parse_pages(table(spark, sf, "pages"), _ads, "ord int, text string").groupBy("url", "text").agg(F.count("*").alias("n"))


@query("q17_run_summary", """WITH r AS (SELECT event_type, event_id, CASE WHEN event_id % 7 = 0 THEN 'error' ELSE 'success' END AS s, value AS v FROM events), ok AS (SELECT *, CASE WHEN s = 'success' THEN v END AS e FROM r)
SELECT event_type, count(*) AS recorded_runs, count(*) FILTER (WHERE s = 'success') AS successful_runs, round(avg(e), 4) AS average_seconds, median(e) AS median_seconds, min(e) AS min_seconds, max(e) AS max_seconds,
CASE WHEN count(e) >= 2 THEN quantile_disc(e, 0.95) END AS p95_seconds, arg_max(s, event_id) AS last_status FROM ok GROUP BY event_type""")
def q17(spark: SparkSession, sf: str) -> DataFrame:
    runs = table(spark, sf, "events").select("event_type", F.col("event_id").alias("ord"), F.when(F.col("event_id") % 7 == 0, "error").otherwise("success").alias("status"), F.col("value").alias("elapsed_seconds"))
    return A.run_summary(runs, by=["event_type"]).withColumn("average_seconds", F.round("average_seconds", 4))


_TYPES = ["click", "view", "error", "purchase", "signup"]


@query("q18_outcomes", "SELECT user_id, " + ", ".join(f"count(*) FILTER (WHERE event_type = '{t}') AS {t}" for t in _TYPES) + " FROM events GROUP BY user_id")
def q18(spark: SparkSession, sf: str) -> DataFrame:
    return A.outcome_counts(table(spark, sf, "events"), _TYPES, by=["user_id"], outcome="event_type")


@query("q19_retries", """WITH a AS (SELECT event_type AS category, event_id % 4 + 1 AS attempts, event_id % 5 <> 0 AS success, CAST(event_id % 4 AS DOUBLE) AS slept FROM events)
SELECT category, count(*) AS operations, CAST(sum(attempts) AS BIGINT) AS attempts, CAST(sum(greatest(attempts - 1, 0)) AS BIGINT) AS retries, count(*) FILTER (WHERE success AND attempts > 1) AS successful_retries, count(*) FILTER (WHERE NOT success) AS failed_operations, sum(slept) AS slept_seconds FROM a GROUP BY category""")
def q19(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    return A.retry_telemetry(e.select(F.col("event_type").alias("category"), (F.col("event_id") % 4 + 1).alias("attempts"), (F.col("event_id") % 5 != 0).alias("success"), (F.col("event_id") % 4).cast("double").alias("slept_seconds")))


@query("q20_paging", """WITH c AS (SELECT source, doc_id, doc_id // 20 + 1 AS page, split_part(text, chr(10), 1) AS title FROM documents),
f AS (SELECT source, title, arg_min(doc_id, struct_pack(a := page, b := doc_id)) AS doc_id, min(page) AS page FROM c WHERE title <> '' GROUP BY source, title),
p AS (SELECT source, page, row_number() OVER (PARTITION BY source ORDER BY page) AS n FROM (SELECT DISTINCT source, page FROM c)),
s AS (SELECT p.source, p.page, max(CASE WHEN x.page IS NULL OR n <> p.page THEN 1 ELSE 0 END) OVER (PARTITION BY p.source ORDER BY p.page) AS stopped FROM p LEFT JOIN (SELECT DISTINCT source, page FROM f) x ON p.source = x.source AND p.page = x.page)
SELECT f.source, f.page, f.title, f.doc_id FROM f JOIN s ON f.source = s.source AND f.page = s.page AND stopped = 0""")
def q20(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "documents").select("source", F.expr("doc_id div 20 + 1").alias("page"), F.substring_index("text", "\n", 1).alias("title"), F.col("doc_id").alias("ord"))
    return A.take_pages(c, max_pages=1 << 40).select("source", "page", "title", F.col("ord").alias("doc_id"))


_PLACE = "CASE WHEN c_custkey % 3 = 0 THEN 'not a location' ELSE concat(c_custkey, ' Farm  Rd ', ', ', c_mktsegment, ' Park TX ', lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')) END"
_PLACE_RE = "([A-Za-z][A-Za-z .''-]+?)\\s*,?\\s+([A-Z]{2})\\s+\\d{5}(?:-\\d{4})?$"


@query("q21_city_state", f"WITH c AS (SELECT c_custkey, regexp_replace({_PLACE}, '\\s+', ' ', 'g') AS p FROM customer) SELECT c_custkey, nullif(trim(regexp_extract(p, '{_PLACE_RE}', 1)), '') AS city, nullif(trim(regexp_extract(p, '{_PLACE_RE}', 2)), '') AS state FROM c")
def q21(spark: SparkSession, sf: str) -> DataFrame:
    place = F.expr(_PLACE.replace("VARCHAR", "STRING"))
    return table(spark, sf, "customer").select("c_custkey", T.city_state(place).alias("p")).select("c_custkey", "p.*")


_LINES = "concat('Track Phone: ', s_name, chr(10), ' ** bring ', n_name, ' *', chr(10), chr(10), 'WEBSITE:', CASE WHEN s_suppkey % 2 = 0 THEN ' www.n.example' ELSE '' END, chr(10), 'gates open', chr(10), 'track phone: ', s_suppkey)"


@query("q22_details", "SELECT s_suppkey, CAST(s_suppkey AS VARCHAR) AS phone, CASE WHEN s_suppkey % 2 = 0 THEN 'www.n.example' END AS website, 'bring ' || n_name || '|gates open' AS notes FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def q22(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select("s_suppkey", T.details(F.expr(_LINES)).alias("d")).select("s_suppkey", "d.phone", "d.website", F.array_join("d.notes", "|").alias("notes"))


@query("q23_prompt", "SELECT p_partkey, concat_ws(chr(10), CASE WHEN p_name <> '' THEN 'title: ' || p_name END, CASE WHEN p_size % 3 <> 0 THEN 'date_text: ' || p_brand END, 'size: ' || p_size) AS prompt FROM part")
def q23(spark: SparkSession, sf: str) -> DataFrame:
    fields = {"title": F.col("p_name"), "date_text": F.when(F.col("p_size") % 3 != 0, F.col("p_brand")).otherwise(""), "source": F.col("p_type"), "size": F.col("p_size")}
    return table(spark, sf, "part").select("p_partkey", T.prompt_text(fields).alias("prompt"))


_ENTRY = "SELECT page_id AS ord, md5(url) AS file_id, concat('flyer', page_id % 50, CASE page_id % 4 WHEN 0 THEN '.JPG' WHEN 1 THEN '.html' WHEN 2 THEN '.gif' ELSE '' END) AS title FROM pages"


@query("q24_sync", f"""WITH e AS ({_ENTRY}), c AS (SELECT *, regexp_extract(lower(title), '(\\.[^.]+)$', 1) IN ('.jpg', '.jpeg', '.png', '.webp', '.gif') AS image FROM e),
a AS (SELECT *, CASE WHEN NOT image THEN 'skipped_non_image' WHEN ord % 10 = 0 OR file_id IN (SELECT file_id FROM e WHERE ord % 10 = 0) OR row_number() OVER (PARTITION BY file_id, image ORDER BY ord) > 1 THEN 'skipped_known' ELSE 'downloaded' END AS action FROM c),
p AS (SELECT *, title IN (SELECT title FROM e WHERE ord % 7 = 0) OR row_number() OVER (PARTITION BY title, action ORDER BY ord) > 1 AS clash FROM a)
SELECT ord, file_id, title, action, CASE WHEN action = 'downloaded' THEN CASE WHEN clash THEN regexp_replace(title, '\\.[^.]+$', '') || '-' || substr(file_id, 1, 8) || regexp_extract(title, '(\\.[^.]+)$', 1) ELSE title END END AS path,
CASE WHEN title LIKE '%.gif' THEN 'image/gif' ELSE 'image/jpeg' END AS media_type FROM p""")
def q24(spark: SparkSession, sf: str) -> DataFrame:
    entries = table(spark, sf, "pages").select(F.col("page_id").alias("ord"), F.md5(F.col("url").cast("binary")).alias("file_id"), F.concat(F.lit("flyer"), F.col("page_id") % 50, F.expr("CASE page_id % 4 WHEN 0 THEN '.JPG' WHEN 1 THEN '.html' WHEN 2 THEN '.gif' ELSE '' END")).alias("title"))
    plan = A.sync_plan(entries, entries.filter("ord % 10 = 0"), entries.filter("ord % 7 = 0"), fixed.STAGED_IMAGES)
    return plan.withColumn("media_type", T.media_type(F.col("title")))


@query("q25_enrich", f"""WITH c AS (SELECT c_custkey, c_mktsegment, regexp_replace({_PLACE}, '\\s+', ' ', 'g') AS p FROM customer)
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'Waco' ELSE nullif(trim(regexp_extract(p, '{_PLACE_RE}', 1)), '') END AS city, nullif(trim(regexp_extract(p, '{_PLACE_RE}', 2)), '') AS state, CAST(c_custkey AS VARCHAR) AS phone,
CASE WHEN c_custkey % 2 = 0 THEN 'NHRA' ELSE '{fixed.CALENDAR_SERIES}' END AS series, '{", ".join(fixed.CALENDAR_CLASSES)}' AS classes, CASE WHEN c_custkey % 5 = 0 THEN 'gates open' ELSE 'rain date' || chr(10) || 'gates open' END AS notes FROM c""")
def q25(spark: SparkSession, sf: str) -> DataFrame:
    k, no = F.col("c_custkey"), F.lit(None).cast("string")
    c = table(spark, sf, "customer").select(
        "c_custkey", F.struct(no.alias("id"), F.col("c_name").alias("name"), F.when(k % 4 == 0, "Waco").otherwise("").alias("city"), no.alias("state")).alias("track"), F.struct(no.alias("phone"), no.alias("email"), no.alias("website")).alias("contact"),
        F.when(k % 2 == 0, "NHRA").alias("series"), F.array().cast("array<string>").alias("classes"), F.when(k % 5 == 0, " gates open ").otherwise("rain date").alias("notes"), F.concat(F.lit("track phone:"), k, F.lit("\n* gates open")).alias("d"), F.expr(_PLACE.replace("VARCHAR", "STRING")).alias("p"),
    )
    c = enrich_calendar(c, location=F.col("p"), details=T.details(F.col("d")), place=T.city_state(F.col("p")))
    return c.select("c_custkey", "track.city", "track.state", "contact.phone", "series", F.array_join("classes", ", ").alias("classes"), "notes")


_CATALOG = ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in row) + ")" for row in fixed.TRACK_CATALOG)
_TRACK_ID = "CASE s_suppkey % 4 WHEN 0 THEN 'xtreme' WHEN 1 THEN 'texas-motorplex-tx' WHEN 2 THEN 'houston-tx' ELSE 'nowhere' END"


@query("q26_backfill", f"""WITH k(id, name, city, state, phone, email, website) AS (VALUES {_CATALOG}), s AS (SELECT s_suppkey, {_TRACK_ID} AS id, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END AS name, s_suppkey % 5 = 0 AS bare, CASE WHEN s_suppkey % 2 = 0 THEN ' www.own.example ' ELSE '' END AS site FROM supplier)
SELECT s_suppkey, coalesce(k.id, s.id) AS id, CASE WHEN k.id IS NOT NULL AND s.name = '' THEN k.name ELSE s.name END AS name, k.city AS city, k.state AS state, CASE WHEN NOT bare THEN k.email END AS email,
CASE WHEN NOT bare THEN CASE WHEN s.site <> '' THEN 'https://' || trim(s.site) WHEN k.id IS NOT NULL THEN k.website ELSE s.site END END AS website FROM s LEFT JOIN k ON k.id = CASE WHEN s.id = 'xtreme' THEN 'xtreme-tx' ELSE s.id END""")
def q26(spark: SparkSession, sf: str) -> DataFrame:
    no = F.lit(None).cast("string")
    site = T.website(F.when(F.col("s_suppkey") % 2 == 0, " www.own.example ").otherwise(""))
    s = table(spark, sf, "supplier").select(
        "s_suppkey", F.struct(F.expr(_TRACK_ID).alias("id"), F.when(F.col("s_suppkey") % 3 == 0, "").otherwise(F.col("s_name")).alias("name"), no.alias("city"), no.alias("state")).alias("track"),
        F.when(F.col("s_suppkey") % 5 != 0, F.struct(no.alias("phone"), no.alias("email"), site.alias("website"))).alias("contact"),
    )
    return backfill(s, catalog_table(spark)).select("s_suppkey", "track.id", "track.name", "track.city", "track.state", "contact.email", "contact.website")


@query("q27_duration", """WITH s AS (SELECT event_id, CAST(greatest(round_even(value * 37.3, 0), 0) AS BIGINT) AS s FROM events)
SELECT event_id, CASE WHEN s >= 3600 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm ' || (s % 60) || 's' WHEN s >= 60 THEN (s // 60) || 'm ' || (s % 60) || 's' ELSE s || 's' END AS text FROM s""")
def q27(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", T.duration(F.col("value") * 37.3).alias("text"))


_SOURCES = [("Nation One", "bracketraces", None, None, None), ("nation two", "racingjunk", True, 2.5, None), ("Other", "rss", False, None, 3), ("National", "racingjunk", True, None, None), ("Elsewhere", "tmccc", True, None, None)]


@query("q28_config", """WITH c(name, strategy, enabled, delay, max_pages) AS (VALUES ('Nation One', 'bracketraces', NULL, NULL, NULL), ('nation two', 'racingjunk', true, 2.5, NULL), ('Other', 'rss', false, NULL, 3), ('National', 'racingjunk', true, NULL, NULL), ('Elsewhere', 'tmccc', true, NULL, NULL))
SELECT n_nationkey, name, CAST(coalesce(delay, CASE strategy WHEN 'bracketraces' THEN 0.5 WHEN 'racingjunk' THEN 0.75 ELSE 0 END) AS DOUBLE) AS delay, CAST(coalesce(max_pages, CASE strategy WHEN 'racingjunk' THEN 10 ELSE 1 END) AS INTEGER) AS max_pages FROM c JOIN nation ON n_regionkey = length(name) % 5 WHERE coalesce(enabled, true) AND contains(lower(name), 'nation')""")
def q28(spark: SparkSession, sf: str) -> DataFrame:
    c = spark.createDataFrame(_SOURCES, "name string, strategy string, enabled boolean, delay double, max_pages int")
    c = c.filter(F.coalesce("enabled", F.lit(True)) & F.contains(F.lower("name"), F.lit("nation")))
    c = c.select("name", T.by_strategy(F.col("delay"), F.col("strategy"), fixed.DELAYS, 0.0).alias("delay"), T.by_strategy(F.col("max_pages"), F.col("strategy"), fixed.MAX_PAGES, 1).cast("int").alias("max_pages"))
    return table(spark, sf, "nation").join(c, F.col("n_regionkey") == F.length("name") % 5).select("n_nationkey", "name", "delay", "max_pages")


@query("q29_top_pages", f"SELECT page_id, host, CAST(rank AS INTEGER) AS rank FROM (SELECT page_id, {HOST_SQL('url')} AS host, row_number() OVER (PARTITION BY {HOST_SQL('url')} ORDER BY page_id) AS rank FROM pages) WHERE rank <= {fixed.PAGES_PER_TRACK}")
def q29(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages").select("page_id", T.url_host(F.col("url")).alias("host"))
    return A.top_k(p, "host", ["page_id"], fixed.PAGES_PER_TRACK)


SCHEMA = {
    "type": "object", "required": ["id", "kind", "at", "value"], "additionalProperties": False,
    "properties": {"id": {"type": "integer", "minimum": 0}, "kind": {"type": "string", "enum": _TYPES}, "at": {"type": "string", "format": "date"}, "value": {"type": ["number", "null"], "maximum": 100}, "mail": {"type": "string", "format": "email"}},
}


@query("q30_validate", """WITH f AS (SELECT event_id, CASE WHEN event_type NOT IN ('click', 'view', 'error', 'purchase', 'signup') THEN 1 ELSE 0 END AS e1, CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS e2, CASE WHEN event_id % 7 = 0 THEN 1 WHEN value > 100 THEN 1 ELSE 0 END AS e3, CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END AS e4, CASE WHEN event_id % 17 = 0 THEN 1 ELSE 0 END AS e5 FROM events)
SELECT event_id, CAST(e1 + e2 + e3 + e4 + e5 AS BIGINT) AS n_errors FROM f WHERE e1 + e2 + e3 + e4 + e5 > 0""")
def q30(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("event_id")
    value = F.when(k % 7 == 0, F.lit('"many"')).otherwise(F.col("value").cast("string"))
    day = F.when(k % 11 == 0, "2024-13-01").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    more = F.concat(F.when(k % 13 == 0, ', "extra": 1').otherwise(""), F.when(k % 17 == 0, ', "mail": "a@b"').otherwise(""))
    payload = F.concat(F.lit('{"id": '), k, F.lit(', "kind": "'), F.col("event_type"), F.lit('", "at": "'), day, F.lit('", "value": '), value, more, F.lit("}"))
    return validate(table(spark, sf, "events").select("event_id", payload.alias("payload")), SCHEMA, id="event_id").groupBy("event_id").agg(F.count("*").alias("n_errors"))


@query("q31_stream_seen", "SELECT concat(user_id, ':', event_type) AS key, min(event_id) AS event_id FROM events GROUP BY user_id, event_type")
def q31(spark: SparkSession, sf: str) -> DataFrame:
    cut(spark.range(1))  # makes sure of the shared folder
    folder = f"{spark.sparkContext.getCheckpointDir()}/seen-{uuid.uuid4()}"
    schema = table(spark, sf, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    keyed = stream.select(F.concat("user_id", F.lit(":"), "event_type").alias("key"), "event_id")
    collect_unseen(keyed, "key", "event_id", f"{folder}/table", f"{folder}/log")
    return spark.read.parquet(f"{folder}/table").select("key", "event_id")


@query("q32_first_pages", "WITH p AS (SELECT l_orderkey AS page, list(l_returnflag || l_linestatus ORDER BY l_linenumber, l_returnflag || l_linestatus) AS s FROM lineitem GROUP BY l_orderkey) SELECT min(page) AS page FROM p GROUP BY s")
def q32(spark: SparkSession, sf: str) -> DataFrame:
    cards = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("ord"), F.concat("l_returnflag", "l_linestatus").alias("key"))
    return R.first_pages(cards).select("page").distinct()


_FILE = f"""substr(regexp_replace(regexp_replace({_LAST}, '^(.+)\\.[^.]+$', '\\1'), '[^\\p{{L}}\\p{{N}}_]', '-', 'g'), 1, 40) || '-' || substr(md5(url), 1, 8)
|| CASE WHEN regexp_extract({_LAST}, '^.+(\\.[^.]+)$', 1) <> '' THEN lower(regexp_extract({_LAST}, '^.+(\\.[^.]+)$', 1)) ELSE '.jpg' END"""


@query("q33_new_images", f"""WITH f AS (SELECT {_FILE} AS path FROM pages WHERE page_id % 3 = 0) SELECT DISTINCT path FROM f WHERE path NOT IN (SELECT {_FILE} FROM pages WHERE page_id % 4 = 0)""")
def q33(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    fetched = pages.select("url", F.col("html").alias("body"), F.when(F.col("page_id") % 3 == 0, "image/png").otherwise("text/html").alias("content_type"))
    staged = pages.filter("page_id % 4 = 0").select(T.file_name_of(F.col("url")).alias("path")).distinct()
    return R.new_images(fetched, staged).select("path")


# The lowest 4 x 4 frequencies of vectors taken as squares of 8 x 8 luminances.
@query("q34_phash", """WITH f AS (SELECT vec_id, u, v, sum(embedding[r * 8 + c + 1]::DOUBLE * cos(pi() * u * (2 * r + 1) / 16) * cos(pi() * v * (2 * c + 1) / 16)) AS y
  FROM embeddings, range(4) a(u), range(4) b(v), range(8) d(r), range(8) e(c) WHERE len(embedding) = 64 GROUP BY vec_id, u, v),
m AS (SELECT *, median(y) OVER (PARTITION BY vec_id) AS middle FROM f)
SELECT vec_id, printf('%04x', CAST(sum(CASE WHEN y > middle THEN 1 << CAST(15 - 4 * u - v AS INTEGER) ELSE 0 END) AS INTEGER)) AS phash FROM m GROUP BY vec_id""")
def q34(spark: SparkSession, sf: str) -> DataFrame:
    return hash_squares(table(spark, sf, "embeddings").select("vec_id", "embedding"), "embedding", side=8, size=4).select("vec_id", "phash")
