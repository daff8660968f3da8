"""Acknowledgement messages: ``{"stream": text, "ids": [text], "ack": bool}``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrylog.functions.body import json_object

REJECT_UNDECODABLE = "undecodable"
REJECT_MALFORMED = "malformed"
REJECT_IDS = "ids"
REJECT_STREAM = "stream"


def parse_ack(parsed: Column) -> Column:
    """Typed fields of an ack from its parsed JSON object.

    Other keys are ignored, a value of the wrong type counts as absent, and an
    absent ``ack`` is false. Repeated ``ids`` add up, of a repeated ``stream`` the
    last text holds, of a repeated ``ack`` the last value.
    """
    ack = _last(parsed, "ack")
    lists = F.transform(
        _values(parsed, "ids"), lambda v: F.try_variant_get(v, "$", "array<string>")
    )
    streams = F.filter(_values(parsed, "stream"), lambda v: F.schema_of_variant(v) == "STRING")
    given = F.filter(lists, lambda v: v.isNotNull())
    ids = F.when(F.size(given) > 0, F.flatten(given))
    return F.struct(
        F.filter(ids, lambda i: i.isNotNull()).alias("ids"),
        F.try_variant_get(F.try_element_at(streams, F.lit(-1)), "$", "string").alias("stream"),
        F.coalesce(
            F.when(
                F.schema_of_variant(ack) == "BOOLEAN",
                F.try_variant_get(ack, "$", "boolean"),
            ),
            F.lit(False),
        ).alias("ack"),
    )


def reject_reason(parsed: Column, ack: Column) -> Column:
    """Why an ack is refused, null for a valid one."""
    return (
        F.when(parsed.isNull(), REJECT_MALFORMED)
        .when(F.coalesce(F.size(ack["ids"]), F.lit(0)) < 1, REJECT_IDS)
        .when(F.coalesce(ack["stream"], F.lit("")) == "", REJECT_STREAM)
    )


def ack_object(text: Column) -> Column:
    """The ack's JSON object, null when the text is malformed."""
    return json_object(text)


def _last(parsed: Column, key: str) -> Column:
    return F.try_element_at(_values(parsed, key), F.lit(-1))


def _values(parsed: Column, key: str) -> Column:
    return F.map_values(F.map_filter(parsed, lambda k, _: k == F.lit(key)))
