"""Validation of a file of events from the command line: python -m eventloom.plans.check EVENTS [SCHEMA]."""

from __future__ import annotations

import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed
from ..operators.validate import EVENT_SCHEMA, validate
from ..sources.readers import exists


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """(seq, payload) of a file or folder of events: a JSON array, in its order, or an event a line, numbered in no certain order."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    first = lines.limit(1).collect()
    if first and first[0]["value"].lstrip().startswith("["):
        whole = spark.read.text(path, wholetext=True)
        items = F.try_parse_json("value").try_cast("array<variant>")
        # A text that is no array is one payload, whose error says so.
        return whole.select(F.posexplode(F.coalesce(F.transform(items, lambda v: F.to_json(v)), F.array("value"))).alias("seq", "payload"))
    return lines.select(F.monotonically_increasing_id().alias("seq"), F.col("value").alias("payload"))


def check(spark: SparkSession, path: str, schema: dict = EVENT_SCHEMA, *, most: int = 1000) -> tuple[int, list[str]]:
    """(exit code, lines): 0 and one line if all events are valid, else 1 and a line for each error, `most` at most, and how many more there are."""
    if not exists(spark, path):
        return 1, [f"No such file: {path}"]
    wrong = validate(payloads(spark, path), schema).orderBy("seq", "path", "message")
    rows = wrong.limit(most + 1).collect()
    if not rows:
        return 0, [fixed.CHECK_PASSED.format(path=path)]
    lines = [fixed.CHECK_FAILED.format(path=path), *[fixed.CHECK_ERROR.format(**r.asDict()) for r in rows[:most]]]
    return 1, lines + ([f"  and {wrong.count() - most} more"] if len(rows) > most else [])


def main(args: list[str]) -> int:
    if not args:
        print(__doc__)
        return 2
    schema = json.loads(Path(args[1]).read_text()) if len(args) > 1 else EVENT_SCHEMA
    code, lines = check(SparkSession.builder.getOrCreate(), args[0], schema)
    print("\n".join(lines))
    return code


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
