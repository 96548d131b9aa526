"""A run over staged images and text listings: what is new is extracted, judged, merged into the stored events, and counted."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions import text as T
from ..functions.phash import hash_images
from ..operators.graph import cut
from ..operators.joins import hash_join
from ..operators.lookup import enrich_calendar
from ..sources.readers import EVENT
from .extract import Extractor, answered
from .logs import get_logger
from .runs import remove_staged
from .store import EventStore
from .workflow import judged, log_errors, run_upsert

OUTCOMES = ["new", "merged", "duplicate", "skipped", "error"]
IMAGES, LISTINGS = "path string, content binary", "ord long, title string, source string, source_url string"


def _numbered(df: DataFrame, order: str, seq: int) -> DataFrame:
    """df with seq from a number on, in an order; a sorted row's number grows from part to part, so no task counts them all."""
    return df.orderBy(order).withColumn("seq", F.monotonically_increasing_id() + seq)


def _completed(extracted: DataFrame, listings: DataFrame) -> DataFrame:
    """Payloads of calendar listings completed from what the calendar says; others as they are."""
    of = listings.filter(F.col("source") == fixed.CALENDAR_SERIES)
    both = extracted.filter("status = 'ok'").join(of.select("seq", *[(F.col(c) if c in of.columns else F.lit(None).cast("string")).alias(f"{c}_") for c in ("location_text", "description")]), "seq")
    event = both.select("seq", "location_text_", "description_", F.from_json("payload", EVENT).alias("e"), "payload")
    event = event.select("seq", "location_text_", "description_", "payload", "e.track", "e.contact", "e.series", "e.classes", "e.notes")
    done = enrich_calendar(event, location=F.col("location_text_"), details=T.details(F.col("description_")), place=T.city_state(F.col("location_text_")))
    # The other fields stay as the text has them.
    whole = F.from_json("payload", "map<string,variant>")
    parts = {c: F.to_variant_object(F.col(c)) if c in ("track", "contact", "classes") else F.col(c).cast("variant") for c in ("track", "contact", "series", "classes", "notes")}
    new = F.map_from_arrays(F.array(*map(F.lit, parts)), F.array(*parts.values()))
    merged = F.map_concat(F.map_filter(whole, lambda k, v: ~k.isin(list(parts))), new)
    filled = done.select("seq", F.to_json(merged, {"ignoreNullFields": "false"}).alias("filled_"))
    return extracted.join(filled, "seq", "left").withColumn("payload", F.coalesce("filled_", "payload")).drop("filled_")


def run_extraction(
    spark: SparkSession, images: DataFrame | None, listings: DataFrame | None, store: EventStore, extractor: Extractor, answers: str, errors: str, today: date, *,
    scratch: str, at: str | None = None, new_id: Callable[[], F.Column] = F.uuid, clock: Callable[[], float] = time.perf_counter, **how: object,
) -> dict:
    """Metrics of a run over images(path, content) and listings(ord, title, source, source_url and more texts).

    Images come first, by path, then listings, by ord. An image near one that is stored is a duplicate and a listing
    out of scope is skipped, and neither is asked about; what is extracted out of scope or past is skipped. Answers are
    kept in the folder `answers`; calendar listings are completed from their calendar. All outcomes are written to a
    folder of their own under `scratch`, the events become the store's next version (Conflict if another run came
    first), then images that came to no error are deleted, but for test flyers, and errors go to the dead letters. No
    input: nothing is read or written. Images that can't be read have no hash, and are asked about.
    """
    log, start = get_logger("eventloom.process"), clock()
    at = at or datetime.now(timezone.utc).isoformat()
    images = images if images is not None else spark.createDataFrame([], IMAGES)
    listings = listings if listings is not None else spark.createDataFrame([], LISTINGS)
    n_images, n_listings = images.count(), listings.count()
    metrics = {"image_flyers": n_images, "text_listings": n_listings, **dict.fromkeys(OUTCOMES, 0), "total_events": 0, "attempts": 0}
    if not n_images and not n_listings:
        return {"elapsed_seconds": round(clock() - start, 2), **metrics}

    own = f"{scratch}/run-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{own}/{name}")
        return spark.read.schema(df.schema).parquet(f"{own}/{name}")

    base, stored = store.read()
    stored = cut(stored)
    first = (stored.agg(F.max("seq")).first()[0] or 0) + 1
    hashes = hash_images(images)
    of_images = kept(_numbered(hashes, "path", first), "images")
    after = (of_images.agg(F.max("seq")).first()[0] or first) + 1
    of_listings = kept(_numbered(listings, "ord", after), "listings")

    flyers = stored.select(F.explode(F.from_json("payload", EVENT)["flyers"]).alias("f")).select(F.col("f.phash").alias("phash")).filter("phash IS NOT NULL").distinct()
    near = hash_join(of_images.select("seq", "phash"), flyers, distance=fixed.HASH_DISTANCE).select(F.col("l_seq").alias("seq")).distinct()
    wanted = of_images.join(near, "seq", "left_anti")
    fields = {c: F.col(c) for c in listings.columns if c != "ord"}
    in_scope = of_listings.filter(T.in_scope(F.col("title")))
    asked = wanted.join(images, "path").select("seq", F.lit(None).cast("string").alias("text"), F.col("content").alias("image"))
    asked = asked.unionByName(in_scope.select("seq", T.prompt_text(fields).alias("text"), F.lit(None).cast("binary").alias("image")))
    got = kept(judged(_completed(answered(asked, extractor, today, answers, **how), of_listings), today), "extracted")

    rest = got.select("seq", "payload", "status")
    inputs = of_images.select("seq", F.lit("image").alias("kind"), "phash", F.col("path").alias("flyer")).unionByName(of_listings.select("seq", F.lit("text").alias("kind"), F.lit(None).cast("string").alias("phash"), F.coalesce("source_url", F.lit("")).alias("flyer")))
    inputs = kept(inputs.join(rest, "seq", "left").select("seq", "kind", "payload", "phash", "flyer", F.coalesce("status", F.lit("skipped")).alias("status")), "inputs")
    events, outcomes = run_upsert(stored, inputs, at, new_id)
    outcomes = kept(outcomes, "outcomes")
    store.commit(events, base)

    failed = outcomes.filter("outcome = 'error'").join(got.select("seq", "error", "trace"), "seq", "left")
    told = failed.join(of_images.select("seq", F.lit("process_flyer").alias("context"), F.create_map(F.lit("flyer_path"), F.col("path")).alias("details")).unionByName(of_listings.select("seq", F.lit("extract_from_text"), F.create_map(F.lit("listing_title"), F.col("title"), F.lit("source_url"), F.col("source_url"))).toDF("seq", "context", "details")), "seq")
    log_errors(told.select("context", F.coalesce("error", F.lit("the answer is no event")).alias("error"), "details", "trace"), errors)
    done = of_images.join(outcomes.filter("outcome <> 'error'"), "seq").select("path")
    remove_staged(spark, [r["path"] for r in done.toLocalIterator()])
    counts = {r["outcome"]: r["count"] for r in outcomes.groupBy("outcome").count().collect()}
    metrics |= {o: counts.get(o, 0) for o in OUTCOMES} | {"total_events": store.read()[1].count(), "attempts": got.agg(F.sum("attempts")).first()[0] or 0}
    log.info(f"{metrics['total_events']} events: " + ", ".join(f"{metrics[o]} {o}" for o in OUTCOMES))
    return {"elapsed_seconds": round(clock() - start, 2), **metrics}
