"""Target-distribution importance resampling over word n-grams, from a table of word positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import fresh, saved, table, without

#: What stands between words: ASCII but letters and digits.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(word: Column) -> Column:
    """word with only A-Z lower-cased: lower() where all is ASCII, letter by letter else."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(F.translate(word, UPPER, UPPER.lower()))


def ngram_buckets(df: DataFrame, *, keep: list[str], text: str = "text", orders: int = 2, buckets: int = 10_000) -> DataFrame:
    """One row a word position: rid (a number for each row of df), the columns of keep, g1..g<orders>.

    g<k> is the bucket of the run of k words that begins here: the unsigned CRC-32 of its UTF-8 bytes, joined by one
    space, modulo buckets; null where fewer than k words follow. A row without words has one row with nulls only.
    Texts are dealt by row, so words are put in order within a task and are not shuffled themselves; a window holds
    one document's words and spills. Call it once and save the result: rid is not the same in another run.
    """
    rid, w, pos = fresh(df, "rid", "w", "pos")
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), BETWEEN), "")
    dealt = df.select(F.monotonically_increasing_id().alias(rid), *keep, F.col(text).alias(text)).repartition(rid)
    rows = dealt.select(rid, *keep, F.posexplode_outer(words).alias(pos, w)).withColumn(w, ascii_lower(F.col(w)))
    one = W.partitionBy(rid).orderBy(pos)
    follow = [F.lead(w, k).over(one).alias(f"{w}{k}") for k in range(1, orders)]
    rows = rows.select(rid, *keep, w, *follow)
    runs, out = F.col(w), []
    for k in range(1, orders + 1):
        if k > 1:
            runs = F.concat(runs, F.lit(" "), F.col(f"{w}{k - 1}"))
        out.append((F.crc32(runs.cast("binary")) % buckets).cast("int").alias(f"g{k}"))
    return rows.select(F.col(rid).alias("rid"), *keep, *out)


def bucket_counts(rows: DataFrame, orders: int) -> DataFrame:
    """(g, n): features in each bucket; one row a bucket at most, counted before the shuffle."""
    each = rows.select(F.explode(F.array(*[f"g{k}" for k in range(1, orders + 1)])).alias("g"))
    return each.filter("g IS NOT NULL").groupBy("g").agg(F.count("*").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(g, gain) for every bucket: floor(1000 ln of the target's add-one share over the raw one's), in doubles."""
    spark = raw.sparkSession
    every = spark.range(buckets).select(F.col("id").cast("int").alias("g"))
    both = every.join(raw.withColumnRenamed("n", "s"), "g", "left").join(target.withColumnRenamed("n", "t"), "g", "left").fillna(0, ["s", "t"])
    sums = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    d = {c: F.col(c).cast("double") for c in ("s", "t", "all_s", "all_t")}
    share = ((d["t"] + 1) * (d["all_s"] + buckets)) / ((d["s"] + 1) * (d["all_t"] + buckets))
    return both.crossJoin(F.broadcast(sums)).select("g", F.floor(1000 * F.log(share)).cast("long").alias("gain"))  # one row of sums


def floor_mean(total: Column, n: Column) -> Column:
    """total / n rounded down, in integers; 0 where n is 0."""
    low = F.when(total < 0, total - n + 1).otherwise(total)
    return F.when(n == 0, F.lit(0)).otherwise(F.try_divide(low - low % n, n).cast("long")).cast("long")


def resample_scores(docs: DataFrame, target: DataFrame, *, id: str = "doc_id", text: str = "text", orders: int = 2, buckets: int = 10_000, seed: int = 7, percent: int = 25, least_words: int = 20) -> DataFrame:
    """id, n_features, weight, score and rank of every row of docs, drawn towards the texts of target.

    weight is the floored mean over a document's features (repeats counted) of their buckets' gains; score adds
    Gumbel noise from a SHA-256 of `<seed>:<id>`, so that the highest percent % of the documents with at least
    least_words words (rounded down) are a draw without replacement; rank is 1, 2, 3... among the drawn, else null.
    Counts run over all texts; each text is split once, and its buckets are saved as two bytes each.

    Null and empty texts and texts without words have no features and weight 0. A null id is hashed as an empty
    one and comes last among ties. Rows of equal ids and texts are rows of their own; which of them has which rank
    is arbitrary. An empty target leaves the raw counts alone to decide; an empty table gives no rows. Other
    columns, whatever their names, are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id).alias("doc_"), F.col(text).alias("text_"))
    rows = saved(ngram_buckets(docs, keep=["doc_"], text="text_", orders=orders, buckets=buckets))
    goal = ngram_buckets(target.select(F.col(text).alias("text_")), keep=[], text="text_", orders=orders, buckets=buckets)
    gain = saved(gains(bucket_counts(rows, orders), bucket_counts(goal, orders), buckets))

    # Gains of a position's runs, looked up in at most `buckets` rows, are summed before the one shuffle by row.
    sums, counts = F.lit(0).cast("long"), F.lit(0).cast("long")
    for k in range(1, orders + 1):
        rows = rows.join(F.broadcast(gain.select(F.col("g").alias(f"g{k}"), F.col("gain").alias(f"gain{k}"))), f"g{k}", "left")
        sums, counts = sums + F.coalesce(f"gain{k}", F.lit(0)), counts + F.col(f"g{k}").isNotNull().cast("long")
    each = rows.groupBy("rid", "doc_").agg(F.sum(sums).alias("total_"), F.sum(counts).alias("n_features"), F.count("g1").alias("words_"))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    each = each.select("doc_", "n_features", floor_mean(F.col("total_"), F.col("n_features")).alias("weight"), noise.alias("noise_"), (F.col("words_") >= least_words).alias("in_"))
    each = saved(each.select("doc_", "n_features", "weight", (F.col("weight") + F.col("noise_")).alias("score"), "in_"))

    # A global order by ranges: place in the sorted part plus the rows of the parts before it.
    order = [F.desc("in_"), F.desc("score"), F.asc_nulls_last("doc_")]
    parts = max(1, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    salt = F.xxhash64("doc_", "n_features", F.monotonically_increasing_id())  # splits rows that are equal in all else
    ranged = each.withColumn("salt_", salt).repartitionByRange(parts, *order, "salt_").sortWithinPartitions(*order, "salt_")
    ranged = saved(ranged.select("doc_", "n_features", "weight", "score", "in_", F.monotonically_increasing_id().alias("at_")))
    part = F.shiftright("at_", 33).alias("part_")
    sizes = ranged.groupBy(part).agg(F.count("*").alias("n_"), F.count_if("in_").alias("in_n_"))
    whole = W.orderBy("part_").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select("part_", F.coalesce(F.sum("n_").over(whole), F.lit(0)).alias("before_"), F.sum("in_n_").over(W.partitionBy()).alias("all_"))  # a row a part
    place = F.col("before_") + F.col("at_").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    drawn = F.col("in_") & (place <= F.floor(F.col("all_") * percent / 100))
    out = ranged.withColumn("part_", part).join(F.broadcast(sizes), "part_")
    return out.select(F.col("doc_").alias(id), "n_features", "weight", "score", F.when(drawn, place).cast("long").alias("rank"))


def resample(docs: DataFrame, target: DataFrame, *, id: str = "doc_id", **how: object) -> DataFrame:
    """The rows of docs whose ids are drawn, all their columns kept, with `weight`, `score` and `rank` (others of these names go).

    For ids that are unique; a repeated id gives each of its rows for each of its ranks. Options as for resample_scores().
    """
    drawn = resample_scores(docs, target, id=id, **how).filter("rank IS NOT NULL").select(F.col(id), "weight", "score", "rank")
    return without(docs, "weight", "score", "rank").join(drawn, id)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document, drawn towards the texts of benchmark."""
    return resample_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: CRC-32 of the UTF-8 bytes of a string: DuckDB has none, so its table is made and its bytes are folded here.
CRC32 = """
crc_table AS (SELECT list(list_reduce(list_prepend(i, [1, 2, 3, 4, 5, 6, 7, 8]), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT CAST(range AS BIGINT) AS i FROM range(256)))
"""


def crc32_sql(relation: str, column: str) -> str:
    """Rows (v, crc) of the distinct values of a column; stands after crc_table in a WITH list."""
    return f"""(SELECT v, xor(4294967295, list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1]))) AS crc
  FROM (SELECT v, list_transform(range(0, octet_length(encode(v))), lambda i: CAST('0x' || substr(hex(encode(v)), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)) AS bytes
    FROM (SELECT DISTINCT {column} AS v FROM {relation} WHERE {column} IS NOT NULL)), crc_table)"""


SQL = f"""
WITH {CRC32},
texts AS (SELECT 'd' AS side, row_number() OVER () AS rid, doc_id, text FROM documents UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
words AS (SELECT side, rid, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM texts),
spots AS (SELECT side, rid, w, unnest(range(1, len(w) + 1)) AS i FROM words),
feats AS (SELECT side, rid, w[i] AS f FROM spots UNION ALL SELECT side, rid, w[i] || ' ' || w[i + 1] FROM spots WHERE i < len(w)),
crcs AS (SELECT v, crc % 10000 AS g FROM {crc32_sql("feats", "f")}),
hits AS (SELECT side, rid, g FROM feats JOIN crcs ON f = v),
counts AS (SELECT g, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM hits GROUP BY g),
sums AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM counts),
gain AS (SELECT g, CAST(floor(1000 * ln((t + 1.0::DOUBLE) * (all_s + 10000.0::DOUBLE) / ((s + 1.0::DOUBLE) * (all_t + 10000.0::DOUBLE)))) AS BIGINT) AS gain FROM counts, sums),
weights AS (SELECT rid, count(*) AS n, CAST(sum(gain) AS BIGINT) AS total FROM hits JOIN gain USING (g) WHERE side = 'd' GROUP BY rid),
scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, CASE WHEN n IS NULL THEN 0 ELSE (total - ((total % n) + n) % n) // n END AS weight, len(w) >= 20 AS ok,
  CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS noise
  FROM texts JOIN words USING (side, rid) LEFT JOIN weights ON weights.rid = texts.rid WHERE side = 'd'),
ranked AS (SELECT *, weight + noise AS score, row_number() OVER (PARTITION BY ok ORDER BY weight + noise DESC, doc_id) AS r, count(*) OVER (PARTITION BY ok) AS all_n FROM scored)
SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight, score, CASE WHEN ok AND r <= all_n * 25 // 100 THEN r END AS rank FROM ranked
"""
