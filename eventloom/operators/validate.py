"""Validation of JSON records against a subset of JSON Schema, with the path of each error."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime
from urllib.parse import urlparse

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed
from ..functions.text import SPACE, let

TEXT_OR_NULL = {"type": ["string", "null"]}
#: The schema of an extracted event.
EVENT_SCHEMA: dict = {
    "type": "object",
    "properties": {
        "title": {"type": "string"},
        "event_type": {"type": "string", "enum": fixed.EVENT_TYPES},
        "series": TEXT_OR_NULL,
        "track": {"type": "object", "properties": {"name": {"type": "string"}, "city": TEXT_OR_NULL, "state": TEXT_OR_NULL}, "required": ["name"]},
        "dates": {"type": "object", "properties": {"start": {"type": "string"}, "end": TEXT_OR_NULL}, "required": ["start"]},
        "times": {"type": "object", "properties": {"gates_open": TEXT_OR_NULL, "registration_opens": TEXT_OR_NULL, "race_start": TEXT_OR_NULL}},
        "classes": {"type": "array", "items": {"type": "string"}},
        "fees": {"type": "object", "properties": {"entry": TEXT_OR_NULL, "spectator": TEXT_OR_NULL}},
        "contact": {"type": "object", "properties": {"phone": TEXT_OR_NULL, "email": TEXT_OR_NULL, "website": TEXT_OR_NULL}},
        "confidence": {"type": "number", "minimum": 0, "maximum": 1},
        "unclear_fields": {"type": "array", "items": {"type": "string"}},
        "notes": TEXT_OR_NULL,
    },
    "required": ["title", "event_type", "track", "dates", "confidence"],
}


class InvalidRecords(ValueError):
    """Raised by a sink if a record breaks its schema."""


def _number(x: object) -> bool:
    return isinstance(x, int | float) and not isinstance(x, bool)


TYPES: dict[str, Callable[[object], bool]] = {
    "array": lambda x: isinstance(x, list), "object": lambda x: isinstance(x, dict), "string": lambda x: isinstance(x, str), "number": _number,
    "null": lambda x: x is None, "boolean": lambda x: isinstance(x, bool), "integer": lambda x: _number(x) and isinstance(x, int),
}


def _parses(read: Callable[[str], object]) -> Callable[[str], bool]:
    def ok(text: str) -> bool:
        try:
            read(text)
        except ValueError:
            return False
        return True

    return ok


def _is_uri(text: str) -> bool:
    try:
        parts = urlparse(text)
    except ValueError:
        return False
    return bool(parts.scheme and parts.netloc)


FORMATS: dict[str, Callable[[str], bool]] = {
    "date": _parses(lambda s: datetime.strptime(s, "%Y-%m-%d")),
    "date-time": _parses(lambda s: datetime.fromisoformat(s[:-1] + "+00:00" if s.endswith("Z") else s)),
    "uuid": _parses(uuid.UUID),
    "uri": _is_uri,
    "email": lambda s: re.fullmatch(r"[^@\s]+@[^@\s]+\.[^@\s]+", s) is not None,
}


def problems(value: object, schema: dict, path: str = "$", root: dict | None = None) -> Iterator[tuple[str, str]]:
    """(path, message) of each break of the schema, depth first. A value of a wrong type is not looked into."""
    root = schema if root is None else root
    if ref := schema.get("$ref"):
        target: object = root
        if not ref.startswith("#/"):
            yield path, f"unsupported ref {ref!r}"
            return
        for step in ref[2:].split("/"):
            target = target.get(step) if isinstance(target, dict) else None
        if target is None:
            yield path, f"unresolved ref {ref!r}"
            return
        yield from problems(value, target, path, root)
        return
    if (kinds := schema.get("type")) is not None:
        kinds = kinds if isinstance(kinds, list) else [kinds]
        if not any(k in TYPES and TYPES[k](value) for k in kinds):
            yield path, f"expected {' or '.join(kinds)}, got {type(value).__name__}"
            return
    if "enum" in schema and value not in schema["enum"]:
        yield path, f"expected one of {schema['enum']}, got {value!r}"
    if _number(value):
        for name, sign, breaks in (("minimum", ">=", lambda a, b: a < b), ("maximum", "<=", lambda a, b: a > b)):
            if schema.get(name) is not None and breaks(value, schema[name]):
                yield path, f"must be {sign} {schema[name]}"
    elif isinstance(value, str):
        kind, pattern = schema.get("format"), schema.get("pattern")
        if kind in FORMATS and not FORMATS[kind](value):
            yield path, f"expected {kind} string"
        if pattern and not re.fullmatch(pattern, value):
            yield path, f"must match pattern {pattern!r}"
    elif isinstance(value, list):
        if isinstance(schema.get("items"), dict):
            for n, x in enumerate(value):
                yield from problems(x, schema["items"], f"{path}[{n}]", root)
    elif isinstance(value, dict):
        known = schema.get("properties", {})
        for key in schema.get("required", []):
            if key not in value:
                yield path, f"missing required property {key!r}"
        if schema.get("additionalProperties") is False:
            for key in sorted(value.keys() - known.keys()):
                yield path, f"unexpected property {key!r}"
        for key, x in value.items():
            if isinstance(known.get(key), dict):
                yield from problems(x, known[key], f"{path}.{key}", root)


def _interpreted(df: DataFrame, schema: dict, *, id: str, payload: str) -> DataFrame:
    """validate() by problems(), a row at a time."""
    kind = df.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple[object, str, str]] = []
            for i, text in zip(b[id].to_pylist(), b[payload].to_pylist()):
                at = f"$[{i}]"
                try:
                    out += [(i, p, m) for p, m in problems(None if text is None else json.loads(text), schema, at)]
                except json.JSONDecodeError as e:
                    out.append((i, at, f"invalid JSON: {e.msg}"))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], b[id].type), pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.string())], [id, "path", "message"])

    return df.select(id, payload).mapInArrow(run, f"`{id}` {kind}, path string, message string")


class Recursive(ValueError):
    """A schema that refers to itself, which no expression of finite size can hold."""


ERROR = "array<struct<path:string,message:string>>"
#: Java's forms of the formats; dates also have to be days of the calendar.
_DAY = r"(\d{4})-(\d{1,2})-(\d{1,2})"
_CLOCK = r"([01]\d|2[0-3])(:[0-5]\d(:[0-5]\d([.,]\d+)?)?|[0-5]\d([0-5]\d([.,]\d+)?)?)?"
_ZONE = r"(Z|[+-]([01]\d|2[0-3])(:?[0-5]\d(:?[0-5]\d([.]\d+)?)?)?)?"
_MOMENT = rf"(?s)(\d{{4}}-\d{{2}}-\d{{2}}|\d{{8}}|\d{{4}}-?W(0[1-9]|[1-4]\d|5[0-3])(-?[1-7])?)(.{_CLOCK}{_ZONE})?"
_URI = r"[A-Za-z][A-Za-z0-9+.-]*://([^/?#\[\]]+|[^/?#\[\]@]*@?\[([0-9A-Fa-f:.]+|v[0-9A-Fa-f]+\.[^/?#\[\]]+)\](:\d*)?)([/?#].*)?"


def _full(text: Column, pattern: str) -> Column:
    return text.rlike(rf"\A(?:{pattern})\z")


def _calendar_day(year: Column, month: Column, day: Column) -> Column:
    return (year != "0000") & F.concat_ws("-", year, F.lpad(month, 2, "0"), F.lpad(day, 2, "0")).try_cast("date").isNotNull()


def _is_day(text: Column) -> Column:
    return _full(text, _DAY) & _calendar_day(*[F.regexp_extract(text, _DAY, n) for n in (1, 2, 3)])


def _is_moment(text: Column) -> Column:
    plain = F.regexp_replace(F.substring(text, 1, 10), "-", "")
    week = text.rlike(r"\A\d{4}-?W")
    return _full(text, _MOMENT) & (week | _calendar_day(F.substring(plain, 1, 4), F.substring(plain, 5, 2), F.substring(plain, 7, 2)))


FORMAT_COLUMNS: dict[str, Callable[[Column], Column]] = {
    "date": _is_day,
    "date-time": _is_moment,
    "uuid": lambda t: _full(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, "urn:|uuid:", ""), r"^[{}]+|[{}]+$", ""), "-", ""), "[0-9A-Fa-f]{32}"),
    "uri": lambda t: _full(F.regexp_replace(F.regexp_replace(t, r"^[\x00-\x20]+|[\x00-\x20]+$", ""), r"[\t\r\n]", ""), f"(?s){_URI}"),
    "email": lambda t: _full(t, rf"[^@{SPACE[1:-1]}]+@[^@{SPACE[1:-1]}]+\.[^@{SPACE[1:-1]}]+"),
}


def _quoted(text: Column) -> Column:
    """A text in quotes as messages show it: single ones unless only they stand in it."""
    plain = text
    for c, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        plain = F.replace(plain, F.lit(c), F.lit(shown))
    other = F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"'))
    return F.when(other, F.concat(F.lit('"'), plain, F.lit('"'))).otherwise(F.concat(F.lit("'"), F.replace(plain, F.lit("'"), F.lit("\\'")), F.lit("'")))


def _kind(v: Column) -> Column:
    """The name that messages give a value's type. Whole decimals are numbers with a point, unless they are too long for a long."""
    t = F.schema_of_variant(v)
    names = [("OBJECT", "dict"), ("ARRAY", "list"), ("STRING", "str"), ("BIGINT", "int"), ("BOOLEAN", "bool"), ("VOID", "NoneType")]
    out = F.when(v.isNull(), "NoneType")
    for head, name in names:
        out = out.when(F.startswith(t, F.lit(head)), name)
    return out.when(t.rlike(r"^DECIMAL\((19|[23]\d),0\)$"), "int").otherwise("float")


_MADE_OF = {"array": ["list"], "object": ["dict"], "string": ["str"], "number": ["int", "float"], "null": ["NoneType"], "boolean": ["bool"], "integer": ["int"]}


def _value(v: Column, kind: str) -> Column:
    return F.try_variant_get(v, "$", kind)


def _equals(n: Column, value: object) -> Column:
    if isinstance(value, str):
        return (n["kind"] == "str") & (_value(n["v"], "string") == value)
    if value is None:
        return n["kind"] == "NoneType"
    if isinstance(value, int | float):
        return n["kind"].isin("int", "float", "bool") & (_value(n["v"], "double") == float(value))
    return F.to_json(n["v"]) == json.dumps(value, ensure_ascii=False, separators=(",", ":"), sort_keys=True)


def _shown(n: Column) -> Column:
    text = _value(n["v"], "string")
    return F.when(n["kind"] == "str", _quoted(text)).when(n["kind"] == "NoneType", "None").when(n["kind"] == "bool", F.initcap(text)).when(n["kind"] == "float", _value(n["v"], "double").cast("string")).otherwise(text)


def compiled(value: Column, schema: dict, path: Column, root: dict | None = None, above: tuple[str, ...] = ()) -> Column:
    """problems() as an expression: an array of (path, message) for a VARIANT value. References are resolved here; Recursive if one meets itself."""
    root = schema if root is None else root
    none = F.array().cast(ERROR)
    if ref := schema.get("$ref"):
        if ref in above:
            raise Recursive(ref)
        target: object = root
        for step in ref[2:].split("/") if ref.startswith("#/") else ():
            target = target.get(step) if isinstance(target, dict) else None
        if not ref.startswith("#/") or target is None:
            return F.array(F.struct(path.alias("path"), F.lit(f"{'unresolved' if ref.startswith('#/') else 'unsupported'} ref {ref!r}").alias("message")))
        return compiled(value, target, path, root, (*above, ref))

    def of(n: Column) -> Column:
        told: list[tuple[Column, Column]] = []
        number, text = n["kind"].isin("int", "float"), _value(n["v"], "string")
        if "enum" in schema:
            known = F.lit(False)
            for e in schema["enum"]:
                known = known | F.coalesce(_equals(n, e), F.lit(False))
            told.append((~known, F.concat(F.lit(f"expected one of {schema['enum']}, got "), _shown(n))))
        for name, sign in (("minimum", ">="), ("maximum", "<=")):
            if schema.get(name) is not None:
                x = _value(n["v"], "double")
                told.append((number & ((x < schema[name]) if name == "minimum" else (x > schema[name])), F.lit(f"must be {sign} {schema[name]}")))
        if schema.get("format") in FORMAT_COLUMNS:
            told.append(((n["kind"] == "str") & ~FORMAT_COLUMNS[schema["format"]](text), F.lit(f"expected {schema['format']} string")))
        if schema.get("pattern"):
            told.append(((n["kind"] == "str") & ~_full(text, schema["pattern"]), F.lit(f"must match pattern {schema['pattern']!r}")))
        error = lambda ok, message: F.when(ok, F.struct(n["path"].alias("path"), message.alias("message")))
        parts = [F.filter(F.array(*[error(ok, m) for ok, m in told]), lambda x: x.isNotNull()).cast(ERROR)] if told else []
        if isinstance(schema.get("items"), dict):
            each = F.transform(n["v"].try_cast("array<variant>"), lambda x, i: compiled(x, schema["items"], F.concat(n["path"], F.lit("["), i.cast("string"), F.lit("]")), root, above))
            parts.append(F.when(n["kind"] == "list", F.flatten(each)).otherwise(none))
        known = schema.get("properties", {})
        if known or schema.get("required") or schema.get("additionalProperties") is False:

            def inside(m: Column) -> Column:
                keys, found = F.map_keys(m), []
                missing = [error(~F.array_contains(keys, k), F.lit(f"missing required property {k!r}")) for k in schema.get("required", [])]
                if missing:
                    found.append(F.filter(F.array(*missing), lambda x: x.isNotNull()).cast(ERROR))
                if schema.get("additionalProperties") is False:
                    more = F.filter(keys, lambda k: ~k.isin(list(known))) if known else keys
                    found.append(F.transform(F.array_sort(more), lambda k: F.struct(n["path"].alias("path"), F.concat(F.lit("unexpected property "), _quoted(k)).alias("message"))).cast(ERROR))
                for k, rule in known.items():
                    if isinstance(rule, dict) and rule:
                        found.append(F.when(F.array_contains(keys, k), compiled(m[k], rule, F.concat(n["path"], F.lit(f".{k}")), root, above)).otherwise(none))
                return F.concat(*found) if found else none

            parts.append(F.when(n["kind"] == "dict", let(n["v"].try_cast("map<string,variant>"), inside)).otherwise(none))
        rest = F.concat(*parts) if parts else none
        kinds = schema.get("type")
        if kinds is None:
            return rest
        kinds = kinds if isinstance(kinds, list) else [kinds]
        good = n["kind"].isin([k for name in kinds for k in _MADE_OF.get(name, [])] or [""])
        wrong = F.array(F.struct(n["path"].alias("path"), F.concat(F.lit(f"expected {' or '.join(kinds)}, got "), n["kind"]).alias("message"))).cast(ERROR)
        return F.when(good, rest).otherwise(wrong)

    return let(F.struct(value.alias("v"), _kind(value).alias("kind"), path.alias("path")), of)


def validate(df: DataFrame, schema: dict, *, id: str = "seq", payload: str = "payload") -> DataFrame:
    """id, path, message of each error in a column of JSON texts; paths begin with $[id].

    The schema becomes one expression over the text as VARIANT, so no Python runs; one that refers to itself is
    interpreted in Arrow batches instead. A text that is no JSON is one error: so are NaN and Infinity and, as Spark's
    parser has it, an object with a key twice. A null text is a null value. Whole numbers of more than 38 digits count
    as numbers with a point. In messages, lists and objects are shown as JSON.
    """
    at = F.concat(F.lit("$["), F.coalesce(F.col(id).cast("string"), F.lit("None")), F.lit("]"))
    try:
        # Wrapped in an array, a text holds one value and nothing after it; one with a bracket might close the array itself.
        text = F.col(payload)
        boxed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).try_cast("array<variant>")
        whole = ~F.contains(text, F.lit("]")) | F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
        bad = F.array(F.struct(at.alias("path"), F.lit("invalid JSON").alias("message"))).cast(ERROR)

        def of(r: Column) -> Column:
            good = r["text"].isNull() | (F.coalesce(F.size(r["box"]) == 1, F.lit(False)) & r["whole"])
            return F.when(good, compiled(F.get(r["box"], F.lit(0)), schema, at)).otherwise(bad)

        errors = let(F.struct(text.alias("text"), boxed.alias("box"), whole.alias("whole")), of)
    except Recursive:
        return _interpreted(df, schema, id=id, payload=payload)
    # Not explode(): Spark would compute the array once more to filter rows by its size.
    return df.select(F.col(id), F.explode_outer(errors).alias("e_")).filter("e_ IS NOT NULL").select(F.col(id), "e_.path", "e_.message")


def check_tracks(data: object) -> list[dict]:
    """The enabled tracks of a track configuration; ConfigError names the first entry that is wrong."""
    return [e for e in _entries(data, "tracks", _track) if e.get("enabled", True)]


def check_sources(data: object) -> list[dict]:
    """The enabled sources of a source configuration; ConfigError names the first entry that is wrong."""
    return [e for e in _entries(data, "sources", _source) if e.get("enabled", True)]


class ConfigError(ValueError):
    """A configuration entry is missing or malformed."""


def _url(x: object) -> bool:
    return isinstance(x, str) and x.startswith(("http://", "https://"))


def _filled(x: object) -> bool:
    return isinstance(x, str) and bool(x.strip())


def _entries(data: object, kind: str, rules: Callable[[dict], Iterator[tuple[str, bool, str]]]) -> list[dict]:
    if not isinstance(data, list):
        raise ConfigError(f"{kind} config must be a list of objects")
    for n, entry in enumerate(data):
        if not isinstance(entry, dict):
            raise ConfigError(f"{kind}[{n}] must be an object")
        for field, ok, message in rules(entry):
            if not ok:
                raise ConfigError(f"{kind}[{n}].{field} {message}")
    return data


def _track(e: dict) -> Iterator[tuple[str, bool, str]]:
    yield "name", _filled(e.get("name")), "must be a non-empty string"
    yield "url", _url(e.get("url")), "must be an http/https URL"
    yield "enabled", isinstance(e.get("enabled", True), bool), "must be a boolean when provided"
    yield "state", isinstance(e.get("state"), str) and re.fullmatch("[A-Z]{2}", e["state"]) is not None, "must be a 2-letter uppercase state code"


def _source(e: dict) -> Iterator[tuple[str, bool, str]]:
    yield "name", _filled(e.get("name")), "must be a non-empty string"
    yield "url", _url(e.get("url")), "must be an http/https URL"
    yield "enabled", isinstance(e.get("enabled", True), bool), "must be a boolean when provided"
    heads = e.get("request_headers")
    yield "request_headers", heads is None or isinstance(heads, dict), "must be an object when provided"
    yield "request_headers", all(_filled(k) for k in heads or {}), "keys must be non-empty strings"
    yield "request_headers", all(isinstance(v, str) for v in (heads or {}).values()), "values must be strings"
    delay, pages = e.get("page_delay_seconds"), e.get("max_pages")
    yield "page_delay_seconds", delay is None or _number(delay) and delay >= 0, "must be a non-negative number when provided"
    yield "max_pages", pages is None or _number(pages) and isinstance(pages, int) and pages >= 1, "must be a positive integer when provided"
    yield "strategy", e.get("strategy") in fixed.STRATEGIES, f"must be one of: {', '.join(fixed.STRATEGIES)}"
    if e.get("strategy") == "bracketraces":
        pages = e.get("event_pages")
        yield "event_pages", isinstance(pages, list) and bool(pages), "must be a non-empty list for bracketraces"
        yield "event_pages", all(isinstance(p, str) and p.startswith("/") for p in pages), "entries must be path strings starting with '/'"
    if e.get("strategy") == "racingjunk":
        yield "drag_racing_url", e.get("drag_racing_url") is None or _url(e["drag_racing_url"]), "must be an http/https URL when provided"
