"""Queries of the training-data operators and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, html_text, langid, line_dedup, near_dup, neighbours, pii, resample, sharding, spelling, topk, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_neighbours": neighbours.op1_neighbours,
    "op2_bpe": bpe.op2_bpe,
    "op3_near_dup": near_dup.op3_near_dup,
    "op4_pii": pii.op4_pii,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_sharding": sharding.op6_sharding,
    "op7_langid": langid.op7_langid,
    "op8_line_dedup": line_dedup.op8_line_dedup,
    "op9_html_text": html_text.op9_html_text,
    "op10_warc": warc.op10_warc,
    "op11_resampling": resample.op11_resampling,
    "op12_spelling": spelling.op12_spelling,
    "op13_topk": topk.op13_topk,
}

ORACLE_SQL: dict[str, str] = {"op1_neighbours": neighbours.SQL, "op10_warc": warc.SQL, "op11_resampling": resample.SQL, "op12_spelling": spelling.SQL, "op13_topk": topk.SQL}
