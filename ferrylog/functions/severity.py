"""Severity codes to names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrylog.schema import SEVERITY_FALLBACK, SEVERITY_NAMES


def severity_name(text: Column) -> Column:
    """Name for a severity written as text; anything but 0 to 7 is INFO.

    The pattern guards the cast, which would otherwise trim blanks and accept
    fractions. The code is looked up once; a place outside the list gives null.
    """
    code = F.when(text.rlike(r"\A[+-]?[0-9]+\z"), text.try_cast("int"))
    names = F.array(*[F.lit(n) for n in SEVERITY_NAMES])
    return F.coalesce(F.get(names, code), F.lit(SEVERITY_FALLBACK))


def severity_name_json(value: str) -> Column:
    """Name for a severity in a VARIANT column; only a JSON integer counts."""
    return F.expr(severity_json_sql(value))


def severity_json_sql(value: str) -> str:
    names = ", ".join(f"'{n}'" for n in SEVERITY_NAMES)
    code = f"if(schema_of_variant({value}) = 'BIGINT', try_variant_get({value}, '$', 'int'), NULL)"
    return f"coalesce(get(array({names}), {code}), '{SEVERITY_FALLBACK}')"
