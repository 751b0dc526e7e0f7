"""Response values as stored: ``{"value": x}`` or a bare ``x``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from annoloom.functions.text import col


def unwrap_value(raw: Column | str) -> Column:
    """Text of a stored value: the ``value`` member, a bare JSON string or plain text."""
    c = col(raw)
    wrapped = F.array_contains(F.json_object_keys(c), "value")
    quoted = F.get_json_object(F.concat(F.lit('{"v":'), c, F.lit("}")), "$.v")
    return (F.when(wrapped, F.get_json_object(c, "$.value"))
            .when(c.startswith('"') & c.endswith('"'), F.coalesce(quoted, c))
            .otherwise(c))


def unwrap_categories(raw: Column | str) -> Column:
    """Category list of a stored value: list kept, scalar to one element, null to none."""
    value = unwrap_value(raw)
    return (F.when(value.startswith("["), F.from_json(value, "array<string>"))
            .when(F.coalesce(value, F.lit("")) == "", F.array().cast("array<string>"))
            .otherwise(F.array(value)))


def category_list(categories: Column | str) -> Column:
    """Null list to empty list."""
    return F.coalesce(col(categories), F.array().cast("array<string>"))
