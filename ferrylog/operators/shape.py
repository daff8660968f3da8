"""Reshape entries: field extraction, empty bodies, payload lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrylog.functions import body, slices


def extract_fields(wire: DataFrame) -> DataFrame:
    """Typed entries from field maps; absent fields become empty text."""

    def take(name: str) -> Column:
        return F.coalesce(F.try_element_at("fields", F.lit(name)), F.lit("")).alias(name)

    return wire.select("id", "stream", take("object"), take("raw"))


def has_body() -> Column:
    return ~((F.col("object") == "") & (F.col("raw") == ""))


def drop_empty_body(entries: DataFrame) -> DataFrame:
    """Leave out entries whose object and raw are both empty."""
    return entries.filter(has_body())


def tolerate_bad_object(entries: DataFrame) -> DataFrame:
    """Add ``fields`` (none for a faulty body) and ``object_ok``.

    An empty body is no fault. The parse sits in a projection of its own so
    that both columns read one parse.
    """
    parsed = entries.withColumn("_parsed", body.json_object(F.col("object")))
    return parsed.withColumns(
        {
            "object_ok": (F.col("object") == "") | F.col("_parsed").isNotNull(),
            "fields": body.object_fields(F.col("_parsed")),
        }
    ).drop("_parsed")


def _parsed(entries: DataFrame) -> DataFrame:
    """Add ``_parsed`` and ``_plain``; one parse, in a projection of its own."""
    text = F.col("object")
    parsed = entries.withColumn("_parsed", body.json_object(text))
    return parsed.withColumn("_plain", body.is_plain(text, F.col("_parsed")))


def _odd_text() -> Column:
    """The bodies to cut into slices: good ones that are not plain."""
    return F.when(F.col("_parsed").isNotNull() & ~F.col("_plain"), F.col("object"))


def pass_through_fields(entries: DataFrame) -> DataFrame:
    """One row per untouched body field, its value the text that the body has."""
    special = ("structured_data", "severity", "raw")
    plain = body.texts(body.object_fields(F.col("_parsed")))
    return (
        _parsed(entries)
        .withColumn("_slices", slices.slices_of(_odd_text(), slices.top_slices))
        .select("id", "stream", F.explode(F.coalesce("_slices", plain)).alias("field"))
        .filter(~F.col("field.key").isin(*special))
        .select("id", "stream", "field.key", "field.value")
    )


def structured_data_fields(entries: DataFrame, prefix: str = "") -> DataFrame:
    """One row per leaf of the entries' structured data, however deep it lies."""
    parsed = _parsed(entries).withColumn(
        "_value", F.try_element_at("_parsed", F.lit("structured_data"))
    )
    plain = body.texts(body.flatten_structured_data("_value"))
    return (
        parsed.withColumn("_slices", slices.slices_of(_odd_text(), slices.leaf_slices))
        .select("id", "stream", F.explode(F.coalesce("_slices", plain)).alias("field"))
        .select("id", "stream", F.concat(F.lit(prefix), "field.key").alias("key"), "field.value")
    )


def build_payload(entries: DataFrame, skip_empty: bool = False) -> DataFrame:
    """Add ``line``: ``id \t stream \t {json}`` with ``raw`` as last field.

    With ``skip_empty`` an entry without a body keeps its row and gets a null
    line, so that a packer can count it without publishing it. Each step is a
    projection of its own: the next step names its input several times. Only bodies that
    are not plain, or whose fields come to have equal keys, travel to Python.
    """
    named = _parsed(entries).withColumn("_fields", body.object_fields(F.col("_parsed")))
    named = named.withColumn("_fields", body.reshape_fields("_fields"))
    plain = F.col("_plain") & ~body.repeats_keys(F.col("_fields"))
    odd = named.withColumn("_plain", plain).withColumn(
        "_slices", slices.slices_of(_odd_text(), slices.body_slices)
    )
    raw = body.default_raw(F.col("raw"))
    fields = F.concat("_fields", F.array(body.field(F.lit("raw"), raw.cast("variant"))))
    written = F.when(F.isnull("_slices"), body.fields_json(fields)).otherwise(
        body.slices_json(F.col("_slices"), raw)
    )
    line = F.concat_ws("\t", "id", "stream", written)
    if skip_empty:
        line = F.when(has_body(), line)
    return odd.withColumn("line", line).drop("_parsed", "_plain", "_fields", "_slices")


def parse_lines(lines: DataFrame, col: str = "line") -> DataFrame:
    """Receiver side of ``build_payload``: id, stream and the JSON text."""
    return lines.select(body.split_line(F.col(col)).alias("p")).select(
        "p.id", "p.stream", "p.json"
    )
