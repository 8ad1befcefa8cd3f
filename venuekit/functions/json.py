"""Key/value pairs out of JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MAP = "map<string,string>"


def json_pairs(c: Column) -> Column:
    """Array of (key, value) structs of a flat JSON object."""
    return F.map_entries(F.from_json(c, _MAP))


def literal_map(c: Column) -> Column:
    """Parse a Python dict literal of scalars; malformed text gives NULL.

    ``u'x'`` becomes ``'x'`` and bare True/False/None become quoted, after which
    the JSON reader takes it with single quotes allowed.
    """
    c = F.regexp_replace(c, r"(?<=[{,:\s])u(?=['\"])", "")
    c = F.regexp_replace(c, r"(:\s*)(True|False|None)(?=\s*[,}])", "$1'$2'")
    return F.from_json(c, _MAP, {"allowSingleQuotes": "true"})


def _pair(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def is_nested(value: Column) -> Column:
    return value.startswith("{")


def nested_pairs(c: Column) -> Column:
    """Like ``json_pairs``, but a value that is itself an object gives one pair
    ``outer_inner`` per inner key.  An inner object that does not parse gives one
    pair with a NULL value, so that it can be counted.
    """

    def expand(entry: Column) -> Column:
        inner = F.transform(
            F.map_entries(literal_map(entry["value"])),
            lambda e: _pair(F.concat_ws("_", entry["key"], e["key"]), e["value"]),
        )
        unread = F.array(_pair(entry["key"], F.lit(None).cast("string")))
        flat = F.array(_pair(entry["key"], entry["value"]))
        return F.when(is_nested(entry["value"]), F.coalesce(inner, unread)).otherwise(flat)

    return F.flatten(F.transform(json_pairs(c), expand))
