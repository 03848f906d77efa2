"""Deeply nested records to flat tables that keep parent-child links.

One pass over the texts: a depth-first visitor with its own stack emits, for each object it meets, the tag of the table
it belongs to, its primary key, its parent's key and its payload in the order of the table's columns. ``flat_tables``
writes the rows of all tables partitioned by tag in that one pass and applies each tag's schema. There is no shuffle.

Defined results: null, blank and invalid texts give no rows (NaN and Infinity are not JSON); records may be nested to any
depth; a text that holds a JSON text is opened again; an object without a name gives no row but its narrower objects do, under its path; odd elements of
lists give no row but count as positions; lone surrogates become U+FFFD.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnquill.session import kept_folder

FLUSH_CHARACTERS = 16_000_000
#: tag -> payload columns and their types
TABLES = {
    "keyword": {"keyword_id": "string", "raw_name": "string", "score": "double"},
    "source": {"list": "string", "year": "int", "added_by": "string"},
    "evidence": {"evidence_pos": "int", "field": "string"},
    "span": {"span_pos": "int", "span_start": "int", "span_end": "int"},
}
TAGGED = "snapshot_id bigint, tag string, node_path string, parent_path string, payload array<string>"


class _NotJson(ValueError):
    """A constant that JSON doesn't have."""


def _invalid(constant: str) -> None:
    raise _NotJson(constant)


_TOKEN = re.compile(r"[ \t\n\r]*(?:([\[\]{},:])|(\")|(-?(?:0|[1-9][0-9]*))((?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?)|(true|false|null)|$)")
_WORDS = {"true": True, "false": False, "null": None}
LONGEST_INTEGER = 4000  # digits; longer ones become floating-point numbers


def deep_json(text: str) -> object:
    """The JSON value of a text at any depth of nesting: containers wait on a stack of their own, nothing recurs."""
    holders: list = [[]]  # the root is a list of one value
    keys: list[str] = []
    wanted, at = "value", 0
    while True:
        token = _TOKEN.match(text, at)
        if token is None:
            raise _NotJson(f"at {at}")
        at = token.end()
        sign, quote, whole, rest, word = token.groups()
        if not token.group().strip(" \t\n\r"):
            if wanted == "next" and len(holders) == 1:
                return holders[0][0]
            raise _NotJson("the text ends early")
        holder = holders[-1]
        if wanted in ("value", "first") and sign not in ("]", "}", ",", ":"):
            if sign:
                value = [] if sign == "[" else {}
            elif quote:
                value, at = json.decoder.scanstring(text, at)
            elif word:
                value = _WORDS[word]
            else:
                value = float(whole + rest) if rest or len(whole) > LONGEST_INTEGER else int(whole)
            if isinstance(holder, list):
                holder.append(value)
            else:
                holder[keys.pop()] = value
            if sign:
                holders.append(value)
            wanted = {"[": "first", "{": "first key"}.get(sign, "next")
        elif quote and wanted in ("key", "first key"):
            key, at = json.decoder.scanstring(text, at)
            keys.append(key)
            wanted = "colon"
        elif sign == ":" and wanted == "colon":
            wanted = "value"
        elif sign == "," and wanted == "next" and len(holders) > 1:
            wanted = "value" if isinstance(holder, list) else "key"
        elif (sign == "]" and wanted in ("first", "next") or sign == "}" and wanted in ("first key", "next")) and (
            len(holders) > 1 and isinstance(holder, list) == (sign == "]")
        ):
            holders.pop()
            wanted = "next"
        else:
            raise _NotJson(f"at {at}")


def opened(text: str | None) -> object:
    """The JSON value of a text, opened again while it is a text itself; None if it is not valid."""
    value: object = text
    try:
        while isinstance(value, str):
            try:
                value = json.loads(value, parse_constant=_invalid)
            except (json.JSONDecodeError, _NotJson):
                return None
            except (RecursionError, ValueError):  # deeper than the quick parser goes, or an integer longer than it takes
                value = deep_json(value)
    except ValueError:
        return None
    return value


def _looks_like_json(text: str) -> bool:
    return text.lstrip(" \t\n\r")[:1] in ("[", "{", '"') if text else False


def keyword_list(value: object) -> list:
    """The list of keyword objects inside its wrappings.

    A list at the top, else what stands under ``keywords`` at any level of the wrappings (nothing there: the search goes
    on beside it), else a lone keyword object as a list of one, else the first other list that holds keyword objects.
    """
    waiting: list[tuple[object, bool]] = [(value, True)]
    lone, loose = None, None
    while waiting:
        at, sure = waiting.pop()
        if isinstance(at, str):
            at = opened(at) if sure or _looks_like_json(at) else None
        if isinstance(at, list):
            if sure:
                return at
            if loose is None and any(isinstance(x, dict) and ("display_name" in x or "narrower" in x) for x in at):
                loose = at
        elif isinstance(at, dict):
            if "display_name" in at:
                lone = at if lone is None else lone
                if sure:
                    return [at]
            waiting += [(v, False) for k, v in reversed(at.items()) if k != "keywords" and isinstance(v, (dict, list, str))]
            if "keywords" in at:
                waiting.append((at["keywords"], True))
    return [lone] if lone is not None else loose or []


def named(node: object) -> str | None:
    name = node.get("display_name") if isinstance(node, dict) else None
    return name.strip() or None if isinstance(name, str) else None


def below(node: dict) -> list:
    narrower = node.get("narrower")
    return narrower if isinstance(narrower, list) else [narrower] if isinstance(narrower, dict) else []


def has_keyword(text: str | None) -> bool:
    """Whether any keyword object of the text, at any level, has a name."""
    waiting = list(keyword_list(opened(text))) if text else []
    while waiting:
        node = waiting.pop()
        if isinstance(node, dict):
            if named(node):
                return True
            waiting += below(node)
    return False


def _text(value: object) -> str | None:
    if value is None or isinstance(value, str):
        return value
    try:
        return json.dumps(value)
    except RecursionError:  # a container deeper than its text form goes is no value of a flat column
        return None


def visit(text: str | None, tags: frozenset[str]) -> Iterator[tuple[str, str, str, list[str | None]]]:
    """(tag, path, parent path, payload) of every object, depth first."""
    stack = [(node, str(i), "") for i, node in enumerate(keyword_list(opened(text)), 1)][::-1] if text else []
    while stack:
        node, path, parent = stack.pop()
        if not isinstance(node, dict):
            continue
        if (name := named(node)) and "keyword" in tags:
            own = node.get("id")
            own = _text(own)
            yield "keyword", path, parent, [own if own and own.strip() else f"label:{name.lower()}", name, _text(node.get("score"))]
        if "source" in tags and isinstance(source := node.get("source"), dict):
            added = source.get("added") if isinstance(source.get("added"), dict) else {}
            yield "source", path, path, [_text(source.get("list")), _text(added.get("year")), _text(added.get("by"))]
        if ("evidence" in tags or "span" in tags) and isinstance(node.get("evidence"), list):
            for i, item in enumerate(node["evidence"], 1):
                if not isinstance(item, dict):
                    continue
                if "evidence" in tags:
                    yield "evidence", f"{path}/e{i}", path, [str(i), _text(item.get("field"))]
                spans = item.get("spans") if "span" in tags else None
                for j, span in enumerate(spans if isinstance(spans, list) else [], 1):
                    if isinstance(span, list) and len(span) == 2:
                        yield "span", f"{path}/e{i}/s{j}", f"{path}/e{i}", [str(j), _text(span[0]), _text(span[1])]
        stack += [(child, f"{path}.{i}", path) for i, child in enumerate(below(node), 1)][::-1]


def emit_tagged(df: DataFrame, tags: tuple[str, ...] = tuple(TABLES)) -> DataFrame:
    """Tagged rows of ``raw_keywords`` for the tables asked for."""
    import pyarrow as pa

    wanted = frozenset(tags)
    kinds = pa.schema([
        ("snapshot_id", pa.int64()), ("tag", pa.string()), ("node_path", pa.string()), ("parent_path", pa.string()),
        ("payload", pa.list_(pa.string())),
    ])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = [list(c) for c in zip(*rows)]
        try:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)
        except (UnicodeEncodeError, pa.ArrowInvalid):  # lone surrogates
            columns[4] = [[v and v.encode("utf-8", "replace").decode() for v in payload] for payload in columns[4]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        waiting = 0  # characters of paths, which are long in deep records
        for part in batches:
            for key, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                for tag, path, parent, payload in visit(text, wanted):
                    rows.append((key, tag, path, parent, payload))
                    waiting += len(path)
                    if len(rows) >= 20_000 or waiting >= FLUSH_CHARACTERS:
                        yield batch(rows)
                        rows, waiting = [], 0
        if rows:
            yield batch(rows)

    return df.select("snapshot_id", "raw_keywords").where("raw_keywords is not null").mapInArrow(run, TAGGED)


def flat_table(tagged: DataFrame, tag: str) -> DataFrame:
    """The rows of one tag under its schema."""
    columns = [
        F.get("payload", F.lit(i)).try_cast(kind).alias(name) for i, (name, kind) in enumerate(TABLES[tag].items())
    ]
    return tagged.where(F.col("tag") == tag).select("snapshot_id", "node_path", "parent_path", *columns)


def write_tables(df: DataFrame, path: str) -> None:
    """All tables in one pass, a folder for each tag."""
    emit_tagged(df).write.mode("overwrite").partitionBy("tag").parquet(path)


def read_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables that ``write_tables`` wrote, each under its own schema; a reader opens the folder of its tag only."""
    tagged = spark.read.schema(TAGGED).parquet(path)
    return {tag: flat_table(tagged, tag) for tag in TABLES}


def flat_tables(df: DataFrame) -> dict[str, DataFrame]:
    """All tables of the records from one pass over them, kept in the folder that all executors share."""
    path = kept_folder(df.sparkSession, "nested")
    write_tables(df, path)
    return read_tables(df.sparkSession, path)


def keyword_nodes(df: DataFrame) -> DataFrame:
    """(snapshot_id, node_path, parent_path, keyword_id, raw_name) of every named keyword object."""
    return flat_table(emit_tagged(df, ("keyword",)), "keyword").drop("score")
