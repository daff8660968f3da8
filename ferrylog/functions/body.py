"""Entry bodies: open JSON objects reshaped into flat fields.

A body is parsed once into ``map<string,variant>``, which keeps key order, JSON
types and repeated keys. Fields then travel as ``array<struct<key,value>>``
until they are written as one JSON object. That is for *plain* bodies, those that the
parser writes as they were; all others are cut into slices of their text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrylog.functions.severity import severity_json_sql, severity_name
from ferrylog.schema import EMPTY_RAW

_MAP = "map<string,variant>"
_FIELDS = "array<struct<key:string,value:variant>>"
_OPTIONS = {"allowNumericLeadingZeros": "true", "allowSingleQuotes": "false"}
#: Structured data nested deeper is cut from the text.
PLAIN_DEPTH = 4


def json_object(text: Column) -> Column:
    """Parse a JSON object; null when the text is not one, or is more than one.

    The parser stops at the end of the first value. Inside brackets whatever
    follows is seen; only text with a bracket of its own could close them, and
    has to be what its value is written as, or to stand inside braces as well.
    """
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{_MAP}>", _OPTIONS)
    braced = F.from_json(F.concat(F.lit('{"o":'), text, F.lit("}")), _MAP, _OPTIONS)
    first = F.get(listed, F.lit(0))
    whole = ~F.contains(text, F.lit("]")) | (F.to_json(first) == text) | braced.isNotNull()
    return F.when((F.size(listed) == 1) & whole, first)


def is_plain(text: Column, parsed: Column) -> Column:
    """Whether the parsed body is written as its text, and is not nested deeply."""
    braces = F.length(text) - F.length(F.replace(text, F.lit("{"), F.lit("")))
    return (F.to_json(parsed) == text) & (braces <= PLAIN_DEPTH + 1)


def object_fields(parsed: Column) -> Column:
    """Fields of a parsed body in their order; none for a faulty body."""
    return F.coalesce(F.map_entries(parsed), no_fields())


def no_fields() -> Column:
    return F.array().cast(_FIELDS)


def field(key: Column, value: Column) -> Column:
    return F.struct(key.alias("key"), value.alias("value"))


def flatten_structured_data(value: str) -> Column:
    """Leaf fields of a nested object, named by their innermost key.

    ``value`` names a VARIANT column of a plain body. Arrays and nulls are leaves,
    empty objects vanish. No fields when the value is not an object.
    """
    return F.coalesce(F.expr(_leaves(value)), no_fields())


def reshape_fields(fields: str) -> Column:
    """Name the severity, flatten structured data, pass all else through.

    ``fields`` names a column of fields of a plain body. A ``raw`` key of the body gives
    way to the entry's own raw text.
    """
    return F.expr(_reshape(fields, _leaves("e.value")))


# The nested lambdas are written as SQL text: building them call by call takes
# far longer than running them on a small batch.


def _reshape(fields: str, leaves: str) -> str:
    severity = severity_json_sql("e.value")
    return f"""
      filter(flatten(transform({fields}, e -> CASE e.key
        WHEN 'structured_data' THEN coalesce({leaves}, cast(array() AS {_FIELDS}))
        WHEN 'severity' THEN array(struct(e.key AS key, cast({severity} AS variant) AS value))
        ELSE array(struct(e.key AS key, e.value AS value)) END)),
      e -> e.key <> 'raw')"""


def _leaves(value: str, depth: int = 1) -> str:
    """Null, when ``value`` is not an object, falls back to the entry itself."""
    e = f"e{depth}"
    leaf = f"array(struct({e}.key AS key, {e}.value AS value))"
    if depth < PLAIN_DEPTH:
        leaf = f"coalesce({_leaves(f'{e}.value', depth + 1)}, {leaf})"
    return f"flatten(transform(map_entries({_object_of(value)}), {e} -> {leaf}))"


def _object_of(value: str) -> str:
    return f"try_variant_get({value}, '$', '{_MAP}')"


def repeats_keys(fields: Column) -> Column:
    """True when two fields have equal keys."""
    return F.size(F.array_distinct(fields["key"])) < F.size(fields)


def default_raw(raw: Column) -> Column:
    """Raw text, or a dash when the entry has none."""
    return F.when(raw == "", F.lit(EMPTY_RAW)).otherwise(raw)


def fields_json(fields: Column) -> Column:
    """One JSON object from fields without repeated keys."""
    return F.to_json(F.map_from_entries(fields))


def slices_json(slices: Column, raw: Column) -> Column:
    """One JSON object from slices of a body, the severity named, and the raw text."""

    def written(f: Column) -> Column:
        name = F.concat(F.lit('"'), severity_name(f["value"]), F.lit('"'))
        value = F.when(f["own"] & (f["key"] == "severity"), name).otherwise(f["value"])
        return F.concat(F.lit('"'), f["key"], F.lit('":'), value, F.lit(","))

    fields = F.array_join(F.transform(slices, written), "")
    return F.concat(F.lit("{"), fields, F.lit('"raw":"'), json_escape(raw), F.lit('"}'))


def texts(fields: Column) -> Column:
    """Fields with their values as JSON text, like slices."""
    return F.transform(
        fields,
        lambda f: F.struct(
            f["key"].alias("key"), F.to_json(f["value"]).alias("value"), F.lit(True).alias("own")
        ),
    )


def json_escape(text: Column) -> Column:
    """Text as it stands between the quotes of a JSON string."""
    quoted = F.to_json(F.array(text))
    return F.when(text.isNotNull(), F.substr(quoted, F.lit(3), F.length(quoted) - 4))


def split_line(line: Column) -> Column:
    """Payload line to (id, stream, json); the JSON text may hold tabs."""
    parts = F.split(line, "\t", 3)
    return F.struct(
        F.get(parts, F.lit(0)).alias("id"),
        F.get(parts, F.lit(1)).alias("stream"),
        F.get(parts, F.lit(2)).alias("json"),
    )
