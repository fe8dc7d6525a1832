"""Contracts of JSON that models return (T36, T37): fences, keys at every level, and what a strict reader makes of it.

Values are VARIANTs. A traversal goes down inside the row, one level at a time, as far as the text's own brackets can nest;
nothing is exploded or shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_FENCE = r"(?s)^\s*```[A-Za-z0-9_-]*[ \t]*\n(.*?)\n?[ \t]*```\s*$"
_NODES = "array<struct<path:string,value:variant>>"


def unfenced(text: Column) -> Column:
    """The inside of a Markdown code fence around a whole answer; other texts as they are."""
    return F.when(text.rlike(_FENCE), F.regexp_extract(text, _FENCE, 1)).otherwise(text)


def _below(node: Column) -> Column:
    """The nodes one level below: members of an object by their keys, elements of an array."""
    kind, path = F.schema_of_variant(node["value"]), node["path"]
    step = F.when(path == "", "").otherwise(".")
    members = F.transform(F.map_entries(node["value"].cast("map<string,variant>")), lambda e: F.struct(F.concat(path, step, e["key"]).alias("path"), e["value"].alias("value")))
    elements = F.transform(node["value"].cast("array<variant>"), lambda e: F.struct(F.concat(path, F.lit("[]")).alias("path"), e.alias("value")))
    return F.when(kind.startswith("OBJECT"), members).when(kind.startswith("ARRAY"), elements).otherwise(F.array().cast(_NODES))


def key_paths(json: Column) -> Column:
    """The sorted distinct paths of all keys at all levels, as `a.b` and, inside arrays, `a[].b`; null where there's no JSON."""
    value = F.try_parse_json(json)

    def walk(h: Column) -> Column:
        start = F.struct(F.array().cast("array<string>").alias("seen"), F.array(F.struct(F.lit("").alias("path"), h["value"].alias("value"))).alias("now"))

        def down(s: Column, _: Column) -> Column:
            return F.transform(F.array(F.flatten(F.transform(s["now"], _below))), lambda now: F.struct(F.array_union(s["seen"], F.filter(F.transform(now, lambda x: x["path"]), lambda p: ~p.endswith("[]"))).alias("seen"), now.alias("now")))[0]

        return F.aggregate(F.sequence(F.lit(1), F.greatest(h["depth"], F.lit(1))), start, down, lambda s: F.array_sort(s["seen"]))

    # An array of one element binds a value that is used more than once.
    held = F.array(F.struct(value.alias("value"), F.regexp_count(json, F.lit(r"[\[{]")).alias("depth")))
    return F.when(value.isNotNull(), F.transform(held, walk)[0])


def read(json: Column, schema: str) -> Column:
    """The JSON by a schema; its field `broken` has the text where it doesn't fit."""
    return F.from_json(json, f"{schema}, broken STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})


def verdict(text: Column, schema: str, keys: list[str], fine) -> Column:
    """What is wrong with an answer first: `json`, `keys` (other paths than all of these), `type`, `value` (by the predicate
    fine on the parsed value), or `ok`."""

    def judge(h: Column) -> Column:
        bad_type = h["value"]["broken"].isNotNull() | h["value"].isNull()
        return F.when(h["paths"].isNull(), "json").when(h["paths"] != F.array(*map(F.lit, sorted(keys))), "keys").when(bad_type, "type").when(F.coalesce(fine(h["value"]), F.lit(False)), "ok").otherwise("value")

    inner = unfenced(text)
    return F.transform(F.array(F.struct(key_paths(inner).alias("paths"), read(inner, schema).alias("value"))), judge)[0]
