"""Run metrics, outcome counts, order-preserving distinct, paging and top-k."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_of(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """The first row of each key by order, as a grouped minimum; rows with a null key are one group."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in keys and c != order]
    return df.groupBy(*keys).agg(F.min(F.struct(order, *rest)).alias("m_")).select(*keys, f"m_.{order}", *[f"m_.{c}" for c in rest])


def unseen(df: DataFrame, key: str, order: str, seen: DataFrame) -> DataFrame:
    """First rows of the keys that are not null, not empty and not in seen(key)."""
    new = df.filter(F.coalesce(F.col(key).cast("string"), F.lit("")) != "").join(seen.select(key), key, "left_anti")
    return first_of(new, key, order)


def first_truthy(df: DataFrame, keys: list[str], fields: list[str], order: str) -> DataFrame:
    """For each key the first value of each field that is neither null nor empty, and the least order."""
    value = lambda c: F.min_by(c, F.when(F.coalesce(F.col(c).cast("string"), F.lit("")) != "", F.col(order)))
    return df.groupBy(*keys).agg(*[value(c).alias(c) for c in fields], F.min(order).alias(order))


def run_summary(runs: DataFrame, *, by: list[str] | None = None, status: str = "status", elapsed: str = "elapsed_seconds", order: str = "ord") -> DataFrame:
    """Counts of runs and average, median, least, greatest and (of two runs or more) nearest-rank 95th percentile of the successful ones' seconds."""
    ok = F.col(status) == "success"
    seconds = F.when(ok, F.col(elapsed).try_cast("double"))
    n = F.count(seconds)
    return runs.groupBy(*(by or [])).agg(
        F.count("*").alias("recorded_runs"), F.count_if(ok).alias("successful_runs"), F.avg(seconds).alias("average_seconds"), F.median(seconds).alias("median_seconds"),
        F.min(seconds).alias("min_seconds"), F.max(seconds).alias("max_seconds"), F.when(n >= 2, F.expr(f"percentile_disc(0.95) WITHIN GROUP (ORDER BY if({status} = 'success', try_cast({elapsed} as double), null))")).alias("p95_seconds"),
        F.max_by(status, order).alias("last_status"),
    )


def outcome_counts(df: DataFrame, outcomes: list[str], *, by: list[str] | None = None, outcome: str = "outcome") -> DataFrame:
    """A count for each outcome."""
    return df.groupBy(*(by or [])).agg(*[F.count_if(F.col(outcome) == o).alias(o) for o in outcomes])


def retry_telemetry(attempts: DataFrame) -> DataFrame:
    """By category: operations, attempts, retries, successful retries, failed operations and seconds slept."""
    more = F.col("attempts") > 1
    return attempts.groupBy("category").agg(
        F.count("*").alias("operations"), F.sum("attempts").alias("attempts"), F.sum(F.greatest(F.col("attempts") - 1, F.lit(0))).alias("retries"),
        F.count_if(F.col("success") & more).alias("successful_retries"), F.count_if(~F.col("success")).alias("failed_operations"), F.sum("slept_seconds").alias("slept_seconds"),
    )


def take_pages(cards: DataFrame, *, source: str = "source", page: str = "page", title: str = "title", order: str = "ord", seen: DataFrame | None = None, max_pages: int | Column = 10) -> DataFrame:
    """Cards that a pager would have collected: it stops at the first page without a title not met before.

    Titles met are those of seen(title) and of earlier pages; a page that is missing ends the paging too. Gives the
    first card of each new title on the pages read. Windows run over one row a page.
    """
    named = cards.filter(F.coalesce(F.col(title), F.lit("")) != "")
    if seen is not None:
        named = named.join(seen.select(title), title, "left_anti")
    rest = [c for c in cards.columns if c not in (source, title, page, order)]
    firsts = named.groupBy(source, title).agg(F.min(F.struct(page, order, *rest)).alias("m_")).select(source, title, "m_.*")
    pages = cards.select(source, page).distinct().join(firsts.select(source, page).distinct().withColumn("new_", F.lit(True)), [source, page], "left")
    w = W.partitionBy(source).orderBy(page)
    pages = pages.withColumn("stop_", F.col("new_").isNull() | (F.row_number().over(w) != F.col(page)) | (F.col(page) > max_pages))
    pages = pages.withColumn("ended_", F.max("stop_").over(w)).filter(~F.col("ended_")).select(source, page)
    return firsts.join(pages, [source, page], "left_semi").select(*cards.columns)


def top_k(df: DataFrame, key: str, order: list[Column | str], k: int, out: str = "rank") -> DataFrame:
    """The first k rows of each key; Spark limits groups before the shuffle."""
    return df.withColumn(out, F.row_number().over(W.partitionBy(key).orderBy(*order))).filter(F.col(out) <= k)


def sync_plan(entries: DataFrame, known: DataFrame, existing: DataFrame, images: list[str]) -> DataFrame:
    """entries (ord, file_id, title) with what becomes of each, and the path of those to be downloaded.

    Not an image; else known already (in known(file_id), or earlier in the list); else downloaded, under its title,
    or with 8 characters of its id after the stem if a file of that title exists (in existing(title)) or comes earlier.
    """
    from ..functions.text import stem, suffix

    image = suffix(F.col("title")).isin(images)
    out = entries.join(known.select("file_id").distinct().withColumn("known_", F.lit(True)), "file_id", "left")
    out = out.withColumn("image_", image)
    dup = F.row_number().over(W.partitionBy("file_id", "image_").orderBy("ord")) > 1
    out = out.withColumn("action", F.when(~F.col("image_"), "skipped_non_image").when(F.col("known_").isNotNull() | dup, "skipped_known").otherwise("downloaded"))
    out = out.join(existing.select("title").distinct().withColumn("there_", F.lit(True)), "title", "left")
    nth = F.row_number().over(W.partitionBy("title", "action").orderBy("ord"))
    clash = F.col("there_").isNotNull() | (nth > 1)
    own = F.concat(stem(F.col("title")), F.lit("-"), F.substring("file_id", 1, 8), F.regexp_extract("title", r"(?<=.)(\.[^.]+)$", 1))
    return out.withColumn("path", F.when(F.col("action") == "downloaded", F.when(clash, own).otherwise(F.col("title")))).select("ord", "file_id", "title", "action", "path")
