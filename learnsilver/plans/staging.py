"""The staging view: xAPI statements flattened to one wide row each."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from learnsilver.functions.columns import cast_text, conform, utc
from learnsilver.functions.jsonx import (
    json_text,
    key_path,
    quoted,
    scalar,
    struct_ddl,
    value_at,
)
from learnsilver.functions.timeids import seconds_from_ms
from learnsilver.plans.registry import model
from learnsilver.schemas import STAGING

# Staging column -> short name of the context extension it is read from.
DEFAULT_EXTENSIONS = {
    "courseId": "course_id",
    "attemptNumber": "attempts",
    "durationSeconds": "time_taken_ms",
}
# Extensions that hold milliseconds where the column holds seconds.
_MILLISECONDS = {"durationSeconds"}

# Statement part -> the fields read from it, as a type for from_json.
_PARTS = {
    "actor": "struct<account:struct<name:string>>",
    "verb": "struct<id:string,display:struct<`en-US`:string>>",
    "object": "struct<id:string,objectType:string>",
    "result": "struct<success:string,completion:string,response:string,"
    "score:struct<raw:string,min:string,max:string,scaled:string>>",
}
# Staging column -> statement part and the keys that lead to the value.
_PATHS = {
    "userId": ("actor", "account", "name"),
    "verbId": ("verb", "id"),
    "verbIri": ("verb", "id"),
    "eventType": ("verb", "id"),
    "verbDescription": ("verb", "display", "en-US"),
    "objectId": ("object", "id"),
    "contentId": ("object", "id"),
    "objectType": ("object", "objectType"),
    "success": ("result", "success"),
    "isCorrect": ("result", "success"),
    "completion": ("result", "completion"),
    "scoreRaw": ("result", "score", "raw"),
    "scoreMin": ("result", "score", "min"),
    "scoreMax": ("result", "score", "max"),
    "scoreScaled": ("result", "score", "scaled"),
    "response": ("result", "response"),
}
# The order in which parts are parsed, and then their texts read.
_STEPS = (("context",), ("actor", "result"), ("verb", "object"))
# A column's text stands under its name with this before it.
_TEXT = "_text_"
_TYPES = dict(STAGING["stg_lrs_events"].columns)


def _parts(statements: DataFrame) -> DataFrame:
    """Id, time, and each JSON part as text."""
    return statements.selectExpr(
        "cast(id as string) as event_id",
        f"{utc(statements, 'timestamp')} as event_timestamp",
        *[f"{json_text(statements, part)} as `{part}`" for part in (*_PARTS, "context")],
    )


def _parse(part: str, ddls: Mapping[str, str]) -> str:
    """A JSON part, parsed once, as ``_part``."""
    return f"from_json(`{part}`, {quoted(ddls[part])}) as _{part}"


def _texts(
    extension_map: Mapping[str, str] | None, prefix: str | None
) -> tuple[dict[str, str], dict[str, tuple[str, str]]]:
    """The type of each parsed part, and per staging column its part and the expression of its text.

    Context extensions are a record of the given keys, or a map of all of them.
    Extension keys are IRIs. With a prefix, the key is the prefix and the
    short name; without, it is the first IRI whose last segment is the short
    name, so that statements of any host are read.
    """
    names = {**DEFAULT_EXTENSIONS, **(extension_map or {})}
    keys = None if prefix is None else sorted({prefix + name for name in names.values()})
    extensions = struct_ddl(keys) if keys else "map<string,string>"
    texts = {
        column: (part, scalar(
            f"_{part}." + ".".join(f"`{key}`" for key in path),
            value_at(f"`{part}`", key_path(*path)),
        ))
        for column, (part, *path) in _PATHS.items()
    }
    for column, name in names.items():
        if prefix is not None:
            key = prefix + name
            text = scalar(
                f"_context.extensions.`{key}`", value_at("`context`", key_path("extensions", key))
            )
        else:
            hits = f"map_filter(_context.extensions, (k, v) -> endswith(k, {quoted('/' + name)}))"
            hit = f"try_element_at(array_sort(map_entries({hits})), 1)"
            values = value_at("`context`", "$.extensions", "map<string,variant>")
            text = scalar(f"{hit}.value", f"{values}[{hit}.key]")
        texts[column] = ("context", text)
    return {**_PARTS, "context": f"struct<extensions:{extensions}>"}, texts


def _typed(column: str, text: str, strict: bool) -> str:
    if column in _MILLISECONDS:
        return seconds_from_ms(cast_text(text, "bigint", strict))
    dtype = _TYPES[column]
    return text if dtype == "string" else cast_text(text, dtype, strict)


def _statement_text() -> str:
    """The whole statement as one JSON text; parts that are absent stand as null."""
    values = {
        "id": "to_json(cast(event_id as variant))",
        "timestamp": "'\"' || translate(cast(event_timestamp as string), ' ', 'T') || 'Z\"'",
        **{part: f"`{part}`" for part in (*_PARTS, "context")},
    }
    members = [f"'\"{key}\":', coalesce({value}, 'null')" for key, value in values.items()]
    return "concat('{', " + ", ',', ".join(members) + ", '}')"


@model("lrs_statements")
def stg_lrs_events(
    statements: DataFrame,
    extension_map: Mapping[str, str] | None = None,
    extension_prefix: str | None = None,
    strict: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """Flatten statements; columns nothing is read from are typed NULLs.

    ``extension_map`` names further context extensions to read, by staging
    column; ``extension_prefix`` is the IRI they are under (any IRI when
    None). A value that does not fit its type is NULL, or an error when
    ``strict``. An ``observation`` counts those values as the rows are made
    (see ``observed_rejects``).
    """
    ddls, texts = _texts(extension_map, extension_prefix)
    # The texts of some parts are read as the next ones are parsed: the code of all in one
    # would be longer than what the JVM compiles. Each value is worked out once.
    rows, parsed = _parts(statements), ()
    for parts in (*_STEPS, ()):
        rows = rows.selectExpr(
            "*",
            *[f"{text} as `{_TEXT}{column}`" for column, (part, text) in texts.items() if part in parsed],
            *[_parse(part, ddls) for part in parts],
        )
        parsed = parts
    typed = rows.selectExpr("*", *[f"{_typed(column, f'`{_TEXT}{column}`', strict)} as `{column}`" for column in texts])
    if observation:
        given = {column: f"`{_TEXT}{column}` is not null" for column in texts if _TYPES[column] != "string"}
        typed = typed.observe(
            observation,
            *[F.expr(f"count_if({there})").alias(f"given_{column}") for column, there in given.items()],
            *[
                F.expr(f"count_if({there} and `{column}` is null)").alias(f"rejected_{column}")
                for column, there in given.items()
            ],
        )
    return conform(
        typed,
        STAGING["stg_lrs_events"],
        event_id="event_id",
        event_timestamp="event_timestamp",
        actorType="'learner'",
        metadata="`context`",
        fullStatement=_statement_text(),
        **{column: f"`{column}`" for column in texts},
    )


def staging_rejects(
    statements: DataFrame,
    extension_map: Mapping[str, str] | None = None,
    extension_prefix: str | None = None,
) -> DataFrame:
    """Per typed column, how many values were given and how many did not fit the type."""
    ddls, texts = _texts(extension_map, extension_prefix)
    parsed = _parts(statements).selectExpr("*", *[_parse(part, ddls) for part in ddls])
    checks = [
        f"named_struct('column', '{column}', 'given', {c['given']}, 'rejected', {c['rejected']})"
        for column, c in _conditions({column: text for column, (_, text) in texts.items()}).items()
    ]
    return (
        parsed.selectExpr(f"inline(array({', '.join(checks)}))")
        .groupBy("column")
        .agg({"given": "count_if", "rejected": "count_if"})
        .toDF("column", "given", "rejected")
    )


def _conditions(texts: Mapping[str, str]) -> dict[str, dict[str, str]]:
    """Per typed column, when a value was given and when it did not fit the type."""
    return {
        column: {
            "given": f"({text}) is not null",
            "rejected": f"({text}) is not null and {_typed(column, text, False)} is null",
        }
        for column, text in texts.items()
        if _TYPES[column] != "string"
    }


def observed_rejects(counts: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """(column, given, rejected) from what an observation of ``stg_lrs_events`` counted."""
    columns = sorted(name.removeprefix("given_") for name in counts if name.startswith("given_"))
    return [(column, counts[f"given_{column}"], counts[f"rejected_{column}"]) for column in columns]
