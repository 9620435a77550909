"""Document collections: names, normalisation of exported documents, reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnsilver.functions.columns import cast_text, utc_from_text
from learnsilver.functions.jsonx import quoted
from learnsilver.operators.incremental import CHANGE_FIELDS, CHANGED_AT
from learnsilver.schemas import DEFAULT_COLLECTIONS, RAW, Contract

CORRUPT = "_corrupt_record"
DOCUMENT = "_document"
REJECTED = "_rejected"


def table_of(collection: str) -> str:
    """Raw table of a collection: submissions are renamed, hyphens become underscores."""
    name = {"submissions": "exercise_submissions"}.get(collection, collection)
    return "lms_" + name.replace("-", "_")


def default_tables() -> list[str]:
    return [table_of(name) for name in DEFAULT_COLLECTIONS]


def normalise(json: str) -> str:
    """Extended JSON as plain JSON, at any depth: ids, times and numbers lose their wrapping.

    Times become ISO text, also those counted in milliseconds.
    """
    counted = r'\{\s*"\$date"\s*:\s*(?:\{\s*"\$numberLong"\s*:\s*"(-?\d{1,15})"\s*\}|(-?\d{1,15}))\s*\}'
    one_spelling = quoted(_counted_time("$1$2", chr(92)))
    tight = f"regexp_replace({json}, {quoted(counted)}, {one_spelling})"
    moment = (
        "replace(cast(timestampadd(MILLISECOND, cast(ms as bigint), "
        "timestamp_ntz'1970-01-01 00:00:00') as string), ' ', 'T')"
    )
    times = quoted(_counted_time("(-?[0-9]+)", chr(92)).replace("{", chr(92) + "{").replace("}", chr(92) + "}"))
    told = (
        f"aggregate(array_distinct(regexp_extract_all({tight}, {times}, 1)), {tight}, "
        f"(text, ms) -> replace(text, {quoted(_counted_time('@', ''))[:-1].replace('@', chr(39) + ' || ms || ' + chr(39))}', "
        f"'\"' || {moment} || 'Z\"'))"
    )
    # Most documents have no counted times, many no wrapped numbers: a look for the signs is cheaper.
    told = f"if({json} rlike {quoted(_COUNTED_SIGN)}, {told}, {json})"
    wrapped = r'\{\s*"\$(?:oid|date)"\s*:\s*("[^"]*")\s*\}'
    number = r'\{\s*"\$number(?:Int|Long|Double|Decimal)"\s*:\s*"(-?\d[^"]*)"\s*\}'
    plain = f"regexp_replace({told}, {quoted(wrapped)}, '$1')"
    numbers = f"if(contains({json}, '\"$number'), regexp_replace({plain}, {quoted(number)}, '$1'), {plain})"
    return f"if(contains({json}, '\"$'), {numbers}, {json})"


# What a time counted in milliseconds begins with.
_COUNTED_SIGN = r'"\$date"\s*:\s*[{0-9-]'


def _counted_time(milliseconds: str, escape: str) -> str:
    """The one spelling in which times counted in milliseconds are looked for."""
    return f'{{"{escape}$date":{{"{escape}$numberLong":"{milliseconds}"}}}}'


def _typed(text: str, dtype: str) -> str:
    """The text of a field as its type; NULL where it does not fit."""
    if dtype == "string":
        return text
    if dtype == "timestamp_ntz":
        return utc_from_text(text)
    if dtype == "int":
        number = f"try_cast({text} as double)"
        return f"if({number} = floor({number}), try_cast({number} as int), null)"
    if dtype.startswith("array"):
        return f"from_json({text}, '{dtype}')"
    return cast_text(text, dtype, strict=False)


def parse_documents(documents: DataFrame, contract: Contract, column: str = "value") -> DataFrame:
    """Document text to the contract's columns; one parse, no Python.

    Fields are read one by one: a value that does not fit its type is NULL, and
    the field's name stands in ``_rejected``. Nested values of text columns
    stay as JSON text. Times are shifted to UTC. Besides, a row holds the whole
    document as text, so that no field is lost; the time of its last change
    under whatever name the document has it; and the text itself where it is no
    JSON.
    """
    names = dict.fromkeys([*contract.names, *CHANGE_FIELDS])
    ddl = ",".join(f"`{name}` string" for name in names)
    parsed = documents.select(F.expr(normalise(f"`{column}`")).alias(DOCUMENT)).select(
        DOCUMENT,
        F.from_json(
            DOCUMENT, f"{ddl},`{CORRUPT}` string", {"columnNameOfCorruptRecord": CORRUPT}
        ).alias("doc"),
    )
    changes = ", ".join(utc_from_text(f"doc.`{name}`") for name in CHANGE_FIELDS)
    typed = {name: _typed(f"doc.`{name}`", dtype) for name, dtype in contract.columns}
    bad = [
        f"if(doc.`{name}` is not null and {typed[name]} is null, '{name}', null)"
        for name, dtype in contract.columns
        if dtype != "string"
    ]
    return parsed.selectExpr(
        *[f"{value} as `{name}`" for name, value in typed.items()],
        f"coalesce({changes}) as {CHANGED_AT}",
        DOCUMENT,
        f"array_compact(cast(array({', '.join(bad)}) as array<string>)) as {REJECTED}",
        f"doc.`{CORRUPT}`",
    )


def valid_documents(parsed: DataFrame) -> DataFrame:
    """The documents that could be read; the others stand in ``_corrupt_record``.

    All rows of a table that comes through a connector: it says nothing of what it could not read.
    """
    return parsed.filter(f"{CORRUPT} is null").drop(CORRUPT) if CORRUPT in parsed.columns else parsed


def rejected_documents(parsed: DataFrame) -> DataFrame:
    """(field, document): a row for each value that did not fit, and for each unreadable document.

    An unreadable document has no field. None of a table that comes through a connector.
    """
    if CORRUPT not in parsed.columns:
        return parsed.sparkSession.createDataFrame([], "field string, document string")
    return parsed.selectExpr(
        f"explode(if({CORRUPT} is null, {REJECTED}, array(cast(null as string)))) as field",
        f"coalesce({CORRUPT}, {DOCUMENT}) as document",
    )


def read_collection(
    spark: SparkSession, path: str, table: str, fmt: str = "text", **options: str
) -> DataFrame:
    """A collection as its raw table.

    ``text`` reads exported documents, one per line. Any other format, such
    as a site's document-store connector, must yield the columns by name.
    """
    contract = RAW[table]
    source = spark.read.format(fmt).options(**options)
    if fmt == "text":
        return parse_documents(source.load(path), contract)
    return source.schema(contract.ddl).load(path)
