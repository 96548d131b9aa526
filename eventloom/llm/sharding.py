"""Sharding by proportional stratified interleaving, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, table, without


def interleave(df: DataFrame, *, shards: int = 24, seed: int = 7, source: str = "source", tie: tuple[str, ...] = ("doc_id",), bucket_rows: int = 8192) -> DataFrame:
    """df with `shard` and `slot` (gapless from 0 in each shard) so that each shard matches the mixture of sources.

    Rows are shuffled within their source by an MD5 of the seed and the tie columns, ranked r = 1..n, and sorted by
    the fraction (2r - 1) / 2n; the sorted sequence is cut into shards whose row counts differ by one at most.

    No window holds a whole source or the whole table: ranks are local ranks in buckets of about bucket_rows rows
    (of the shuffle hash, then of the fraction) plus offsets from bucket counts, so a source with a third of all
    rows is dealt like any other. A null source is a source of its own; null tie columns sort first; rows equal in
    all tie columns keep an arbitrary order among themselves; an empty table gives no rows. Columns named `shard`
    and `slot` are replaced.
    """
    df = without(df, "shard", "slot")
    plain, n = df.columns, df.count()
    buckets = min(65536, max(1, -(-n // bucket_rows)))
    at = {c: F.col(f"in_{i}") for i, c in enumerate(plain)}
    base = df.toDF(*[f"in_{i}" for i in range(len(plain))])
    mix = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(at[c].cast("string"), F.lit("")) for c in tie]))
    base = base.withColumns({"mix_": mix, "known_": at[source].isNotNull(), "s_": F.coalesce(at[source].cast("string"), F.lit(""))})
    base = base.withColumn("b_", F.floor(F.conv(F.substring("mix_", 1, 4), 16, 10).cast("long") * buckets / 65536).cast("int"))
    strata, order = ["s_", "known_"], [F.col("mix_"), *[at[c] for c in tie]]

    # Exact ranks within a source: local rank in a bucket of the shuffle hash, plus the rows in earlier buckets.
    by_source = W.partitionBy(*strata)
    counts = base.groupBy(*strata, "b_").agg(F.count("*").alias("n_"))
    counts = counts.select(*strata, "b_", (F.sum("n_").over(by_source.orderBy("b_")) - F.col("n_")).alias("before_"), F.sum("n_").over(by_source).alias("all_"))
    local = F.row_number().over(W.partitionBy(*strata, "b_").orderBy(*order))
    ranked = base.withColumn("r_", local).join(counts, [*strata, "b_"]).withColumn("r_", F.col("r_") + F.col("before_"))
    ranked = ranked.withColumn("f_", (2 * F.col("r_") - 1) / (2.0 * F.col("all_")))
    ranked = cut(ranked.withColumn("g_", F.least(F.floor(F.col("f_") * buckets), F.lit(buckets - 1)).cast("int")).drop("b_", "r_", "before_", "all_"))

    # Exact positions in the order of fractions, in the same way; `starts` has one row a bucket, 65536 at most.
    starts = ranked.groupBy("g_").agg(F.count("*").alias("n_"))
    starts = starts.select("g_", (F.sum("n_").over(W.orderBy("g_")) - F.col("n_")).alias("start_"))
    local = F.row_number().over(W.partitionBy("g_").orderBy("f_", *strata, *order))
    out = ranked.withColumn("p_", local).join(starts, "g_").withColumn("p_", (F.col("start_") + F.col("p_") - 1).cast("long"))
    out = out.withColumn("shard_", F.expr(f"cast((p_ * {shards}L) div {max(n, 1)}L as int)"))
    first = F.expr(f"(cast(shard_ as bigint) * {max(n, 1)}L + {shards - 1}L) div {shards}L")
    return out.select(*[at[c].alias(c) for c in plain], F.col("shard_").alias("shard"), (F.col("p_") - first).alias("slot"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 under the law `rows`: counts differ by one at most."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    out = interleave(docs, tie=("doc_id", "text_crc32", "size"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
