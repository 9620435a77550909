"""JSON access, written as SQL expressions so that a plan is built in few calls.

A JSON column is parsed once per row with ``from_json`` into the fields that
are read; Catalyst prunes the fields a query does not use.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def key_path(*keys: str) -> str:
    """A JSON path through keys that may hold dots, slashes or dashes."""
    return "$" + "".join(f"['{key}']" for key in keys)


def json_text(df: DataFrame, name: str) -> str:
    """A JSON column as text: text stays as it is, nested columns are serialised."""
    dtype = df.schema[name].dataType
    nested = (T.VariantType, T.StructType, T.ArrayType, T.MapType)
    return f"to_json(`{name}`)" if isinstance(dtype, nested) else f"cast(`{name}` as string)"


def scalar(text: str, value: str) -> str:
    """Extracted text, or NULL where the JSON value (a VARIANT) is an object or an array.

    A string may itself start with a bracket, so text that looks nested is
    checked against the type of the value; all other text passes at once.
    """
    # Nested ifs, not an AND: Spark may hoist a common right side of an AND and
    # would then parse every row.
    return (
        f"if(substring({text}, 1, 1) in ('{{', '['), "
        f"if(schema_of_variant({value}) rlike '^(OBJECT|ARRAY)', null, {text}), {text})"
    )


def value_at(json: str, path: str, dtype: str = "variant") -> str:
    """The value at a path of JSON text."""
    return f"try_variant_get(try_parse_json({json}), {quoted(path)}, '{dtype}')"


def struct_ddl(fields: Iterable[str]) -> str:
    """A struct type of text fields."""
    return "struct<" + ",".join(f"`{field}`:string" for field in fields) + ">"


def _record_texts(
    df: DataFrame,
    column: str,
    fields: Iterable[str],
    keep: Iterable[str],
    position: str | None = None,
) -> DataFrame:
    """One row per record of an array column: the kept expressions, then the fields as text."""
    fields = list(fields)
    dtype = df.schema[column].dataType
    ddl = struct_ddl(fields)
    native = isinstance(dtype, T.ArrayType)
    text = json_text(df, column)
    # A lone object would be read as an array of one, hence the bracket.
    read = f"if(startswith(ltrim({text}), '['), from_json({text}, 'array<{ddl}>'), null)"
    array = f"`{column}`" if native else read
    generator = f"posexplode({array}) as ({position}, _item)" if position else (
        f"explode({array}) as _item"
    )
    rows = df.selectExpr(*keep, generator)
    element = rows.schema["_item"].dataType
    if isinstance(element, T.StringType):
        rows = rows.selectExpr("* except (_item)", f"from_json(_item, '{ddl}') as _item")
        element = rows.schema["_item"].dataType

    def field(name: str) -> str:
        if isinstance(element, T.VariantType):
            return f"try_variant_get(_item, {quoted(key_path(name))}, 'string')"
        if name not in element.names:
            return "cast(null as string)"
        nested = (T.StructType, T.ArrayType, T.MapType, T.VariantType)
        return f"to_json(_item.`{name}`)" if isinstance(element[name].dataType, nested) else (
            f"cast(_item.`{name}` as string)"
        )

    return rows.selectExpr("* except (_item)", *[f"{field(name)} as `{name}`" for name in fields])


def explode_records(
    df: DataFrame,
    column: str,
    fields: Mapping[str, str],
    keep: Iterable[str],
    position: str | None = None,
) -> DataFrame:
    """One row per record of an array column: the kept expressions, then the record's fields.

    The array is native (of records, VARIANT or JSON text) or JSON text as a
    whole. A field is cast to its type; one that is absent or does not fit is
    NULL (``rejected_fields`` returns those that do not fit). Rows whose array
    is empty or NULL give no row. ``position`` names a column for the place in
    the array, from 0.
    """
    rows = _record_texts(df, column, fields, keep, position)
    kept = [f"`{name}`" for name in rows.columns if name not in fields]
    return rows.selectExpr(
        *kept, *[f"try_cast(`{name}` as {dtype}) as `{name}`" for name, dtype in fields.items()]
    )


def rejected_fields(
    df: DataFrame, column: str, fields: Mapping[str, str], keep: Iterable[str]
) -> DataFrame:
    """The kept expressions, field and value of fields of an array's records that do not fit their type."""
    rows = _record_texts(df, column, fields, keep)
    kept = [f"`{name}`" for name in rows.columns if name not in fields]
    bad = ", ".join(
        f"if(`{name}` is not null and try_cast(`{name}` as {dtype}) is null, "
        f"named_struct('field', '{name}', 'value', `{name}`), null)"
        for name, dtype in fields.items()
    )
    return rows.selectExpr(*kept, f"inline(array_compact(array({bad})))")
