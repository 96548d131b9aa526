"""Structured extraction by an outside model, behind a function; recorded answers by default."""

from __future__ import annotations

import base64
import hashlib
import json
import traceback
import uuid
from collections.abc import Callable, Iterator
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import date_hint
from ..operators.validate import EVENT_SCHEMA, problems
from ..sources.readers import exists, with_retries

#: Takes (instructions, prompt text or None, image bytes or None) and returns the record.
Extractor = Callable[[str, str | None, bytes | None], dict]


def prompt_key(text: str | None, image: bytes | None = None) -> str:
    return hashlib.sha256((text or "").encode() + b"\0" + (image or b"")).hexdigest()


class Replay:
    """An extractor that answers from recorded answers by prompt_key()."""

    def __init__(self, answers: dict[str, dict]) -> None:
        self.answers = answers

    def __call__(self, instructions: str, text: str | None, image: bytes | None) -> dict:
        return self.answers[prompt_key(text, image)]


class NoAnswer(ValueError):
    """The model answered without calling the tool."""


class ToolCall:
    """An extractor over a client that answers with blocks: the record is the input of the tool's first call among them.

    send takes a request (kind, tool, instructions, content) and returns blocks with type, name and input. Images go in
    Base64 with their media type, by their first bytes; a text follows the instructions.
    """

    TOOL = fixed.ANSWER_TOOL

    def __init__(self, send: Callable[[dict], list[dict]], schema: dict = EVENT_SCHEMA) -> None:
        self.send, self.schema = send, schema

    def request(self, instructions: str, text: str | None, image: bytes | None) -> dict:
        tool = {"name": self.TOOL, "input_schema": self.schema}
        if image is None:
            return {"kind": "text", "tool": tool, "content": [{"type": "text", "text": f"{instructions}\n\n{text or ''}"}]}
        source = {"type": "base64", "media_type": media_type_of(image), "data": base64.standard_b64encode(image).decode()}
        return {"kind": "image", "tool": tool, "content": [{"type": "image", "source": source}, {"type": "text", "text": instructions}]}

    def __call__(self, instructions: str, text: str | None, image: bytes | None) -> dict:
        for block in self.send(self.request(instructions, text, image)):
            if block.get("type") == "tool_use" and block.get("name") == self.TOOL:
                return block["input"]
        title = next((x[7:] for x in (text or "").split("\n") if x.startswith("title: ")), None)
        raise NoAnswer(f"the model did not call {self.TOOL}" + (f" for listing: {title}" if title else ""))


def media_type_of(image: bytes) -> str:
    """Media type by an image's first bytes, image/jpeg by default."""
    heads = [(b"\x89PNG", "image/png"), (b"GIF8", "image/gif")]
    return "image/webp" if image[:4] == b"RIFF" and image[8:12] == b"WEBP" else next((kind for head, kind in heads if image.startswith(head)), "image/jpeg")


def extract(inputs: DataFrame, extractor: Extractor, today: date, *, attempts: int = 3, delay: float = 1.0, schema: dict = EVENT_SCHEMA) -> DataFrame:
    """seq, payload, status (ok, error), error, attempts, slept_seconds, trace for inputs(seq, text, image).

    A failing call is tried again, and if it fails to the end, trace tells where; an answer that breaks the schema is an
    error at once. Each evaluation asks the model again: answered() remembers.
    """
    kind = inputs.schema["seq"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hint = date_hint("the flyer or listing", today)
        for f in frames:
            out = []
            for seq, text, image in zip(f["seq"], f["text"], f["image"]):
                got, error, n, slept = with_retries(lambda t=text, i=image: extractor(hint, t, i), attempts=attempts, delay=delay)
                wrong = "; ".join(f"{p}: {m}" for p, m in problems(got, schema)) if error is None else str(error)
                trace = None if error is None else "".join(traceback.format_exception(error))
                out.append((seq, None if wrong else json.dumps(got, ensure_ascii=False), "error" if wrong else "ok", wrong or None, n, slept, trace))
            yield pd.DataFrame(out, columns=["seq", "payload", "status", "error", "attempts", "slept_seconds", "trace"])

    return inputs.select("seq", "text", "image").mapInPandas(run, f"seq {kind}, payload string, status string, error string, attempts int, slept_seconds double, trace string")


ANSWERS = "key string, payload string, status string, error string, attempts int, slept_seconds double, trace string"


def answered(inputs: DataFrame, extractor: Extractor, today: date, folder: str, *, tasks: int = 32, **how: object) -> DataFrame:
    """extract(), with answers kept in a folder by what was asked, so that nothing is asked twice.

    Inputs of one text and image, on one day, are one question. Questions without an answer are asked in one job that
    writes the answers, and the result is read from them, so evaluating it again, or a run that begins anew, asks
    nothing; a task that is lost asks its own questions again, a part of 1/tasks. Answers that break the schema are kept
    as errors; calls that failed are asked again by the next run.
    """
    spark = inputs.sparkSession
    hint = F.lit(date_hint("the flyer or listing", today))
    key = F.sha2(F.concat(F.sha2(hint.cast("binary"), 256), F.lit(":"), F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("")), F.lit(":"), F.coalesce(F.sha2("image", 256), F.lit(""))).cast("binary"), 256)
    asked = inputs.select("seq", key.alias("key"))
    known = spark.read.schema(ANSWERS).option("recursiveFileLookup", True).parquet(folder).filter("trace IS NULL") if exists(spark, folder) else spark.createDataFrame([], ANSWERS)
    new = asked.join(known.select("key"), "key", "left_anti").groupBy("key").agg(F.min("seq").alias("seq"))
    questions = inputs.join(new, "seq").select(F.col("key").alias("seq"), "text", "image").repartition(tasks, "seq")
    batch = f"{folder}/{uuid.uuid4().hex}"
    extract(questions, extractor, today, **how).withColumnRenamed("seq", "key").write.parquet(batch)
    fresh = spark.read.schema(ANSWERS).parquet(batch)
    # Of a key that two runs have asked at once, one answer counts.
    one = known.unionByName(fresh).groupBy("key").agg(F.min(F.struct(*[c.split()[0] for c in ANSWERS.split(", ")[1:]])).alias("a"))
    return asked.join(one, "key").select("seq", "a.*")
