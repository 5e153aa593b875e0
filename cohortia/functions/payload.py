"""Reading JSON payload columns.

Fields of one level are decoded by one ``from_json`` with a schema.  Payloads opened over
several levels are parsed once, to a variant, and every level reads that value.  Scalars
come back as text; objects and arrays asked for as scalars come back as NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _looks_nested(text: Column) -> Column:
    return F.startswith(text, F.lit("{")) | F.startswith(text, F.lit("["))


def scalar_text(text: Column) -> Column:
    """Keep a decoded value only when it was a scalar.

    A plain string may itself begin with a bracket, so the (rare) candidates
    are parsed once more before they are dropped.
    """
    return F.when(~(_looks_nested(text) & F.try_parse_json(text).isNotNull()), text)


def json_value(payload: Column, path: str) -> Column:
    """Scalar at ``path`` as text, NULL for objects, arrays and absent paths."""
    return scalar_text(F.get_json_object(payload, path))


def json_query(payload: Column, path: str) -> Column:
    """Object or array at ``path`` as JSON text, NULL for scalars."""
    found = F.get_json_object(payload, path)
    return F.when(_looks_nested(found) & F.try_parse_json(found).isNotNull(), found)


def is_json(payload: Column) -> Column:
    """True for a valid JSON object or array; false otherwise, also for NULL."""
    text = F.ltrim(payload, F.lit(" \t\n\r"))
    valid = _looks_nested(text) & F.try_parse_json(payload).isNotNull()
    return F.coalesce(valid, F.lit(False))


def json_fields(payload: Column, names: Sequence[str]) -> dict[str, Column]:
    """Top-level scalars ``names`` of an object, decoded in a single parse.

    With an option given, the optimizer keeps the one schema instead of cutting it down
    to a parse for each field.
    """
    schema = "struct<" + ",".join(f"`{n}`:string" for n in names) + ">"
    decoded = F.from_json(payload, schema, {"mode": "PERMISSIVE"})
    return {n: scalar_text(decoded[n]) for n in names}


def open_json(payload: Column, element: str) -> Column:
    """Rows of a JSON array (or the one object) for use with ``explode``.

    ``element`` is the DDL of one element, e.g. ``struct<GroupName:string>``.
    NULL, empty and invalid payloads give no rows under ``explode``.
    """
    return F.from_json(payload, f"array<{element}>")


def _is_container(value: Column, path: str = "$") -> Column:
    as_object = F.try_variant_get(value, path, "map<string,variant>")
    return as_object.isNotNull() | F.try_variant_get(value, path, "array<variant>").isNotNull()


def members(value: Column) -> Column:
    """Members of a variant that is an array, or the one object, for use with ``explode``.

    NULL, scalars and empty arrays give no rows; an array member that is no object gives a
    row whose fields are NULL.
    """
    one_object = F.try_variant_get(value, "$", "map<string,variant>").isNotNull()
    return F.coalesce(
        F.try_variant_get(value, "$", "array<variant>"), F.when(one_object, F.array(value))
    )


def open_variant(payload: Column) -> Column:
    """:func:`members` of JSON text, which is parsed once; invalid text gives no rows.

    An object that repeats a key is invalid.
    """
    # the lambda's variable holds the parsed value, however often it is read
    return F.flatten(F.transform(F.array(F.try_parse_json(payload)), members))


def at(value: Column, path: str) -> Column:
    """The variant at ``path`` of a variant, NULL where there is none."""
    return F.try_variant_get(value, path, "variant")


def scalar_at(value: Column, path: str) -> Column:
    """Scalar at ``path`` of a variant as text, NULL for objects, arrays and absent paths.

    A variant keeps the value of a number, not its spelling: 1.0 and 1.50 read 1 and 1.5.
    """
    found = F.try_variant_get(value, path, "string")
    return F.when(~(_looks_nested(found) & _is_container(value, path)), found)
