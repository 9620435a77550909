"""Column helpers shared by the models, written as SQL expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnsilver.schemas import Contract


# What a row of a model is made from, where the model's table is patched (see ``Warehouse``).
GROUP = "_group"


def widen(df: DataFrame, contract: Contract) -> DataFrame:
    """Add the contract's columns that the table lacks, as typed NULLs."""
    present = set(df.columns)
    missing = [
        f"cast(null as {dtype}) as `{name}`"
        for name, dtype in contract.columns
        if name not in present
    ]
    return df.selectExpr("*", *missing) if missing else df


def conform(df: DataFrame, contract: Contract, /, **columns: str) -> DataFrame:
    """Project to the contract: the given expressions cast to their type, others typed NULLs.

    A column ``GROUP`` of the rows goes along.
    """
    unknown = set(columns) - set(contract.names)
    if unknown:
        raise ValueError(f"{contract.name} has no column {sorted(unknown)}")
    return df.selectExpr(
        *[
            f"cast({columns.get(name, 'null')} as {dtype}) as `{name}`"
            for name, dtype in contract.columns
        ],
        *[GROUP for name in df.columns if name == GROUP],
    )


def joined_key(*parts: str) -> str:
    """Parts joined by an underscore; NULL when any part is NULL."""
    return " || '_' || ".join(f"cast({part} as string)" for part in parts)


def cases(value: str, results: dict[str, str], otherwise: str) -> str:
    """The result of the first word the value equals."""
    whens = " ".join(f"when {value} = '{word}' then '{r}'" for word, r in results.items())
    return f"case {whens} else '{otherwise}' end"


def cast_text(text: str, dtype: str, strict: bool) -> str:
    """Text to a number or boolean. Bad text is NULL, or an error when strict."""
    if dtype == "boolean":
        bad = f"cast(raise_error('not a boolean: ' || {text}) as boolean)" if strict else "null"
        return (
            f"case lower({text}) when 'true' then true when 'false' then false "
            f"else if({text} is null, null, {bad}) end"
        )
    return f"{'cast' if strict else 'try_cast'}({text} as {dtype})"


def _utc_of_instant(instant: str) -> str:
    """An instant as UTC timestamp; counted from 1970, so no local hour is ambiguous."""
    return f"timestampadd(MICROSECOND, unix_micros({instant}), timestamp_ntz'1970-01-01 00:00:00')"


def utc_from_text(text: str) -> str:
    """ISO time text as a UTC timestamp, whatever the session's time zone.

    An offset is applied; text without one is taken as UTC; other text is NULL.
    """
    return (
        rf"if({text} rlike ':\\d{{2}}(\\.\\d+)?([Zz]|[+-]\\d{{2}}(:?\\d{{2}})?)$', "
        f"{_utc_of_instant(f'try_cast({text} as timestamp)')}, "
        f"try_cast({text} as timestamp_ntz))"
    )


def utc(df: DataFrame, name: str) -> str:
    """A time column as UTC timestamp, held as text, instant or zoneless timestamp."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return utc_from_text(f"`{name}`")
    if isinstance(dtype, T.TimestampType):
        return _utc_of_instant(f"`{name}`")
    return f"cast(`{name}` as timestamp_ntz)"


def with_last_metadata(sessions: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Numbers per ``session`` (a record of the keys), with the last metadata text of each.

    The last of several texts can only be found by sorting them. Reduced by
    itself, it leaves the numbers to a hash aggregation, and both are grouped
    by the same record, so that the join moves nothing again. A record equals
    another also where both have a NULL.
    """
    texts = seen.filter("metadata is not null").groupBy(F.struct(*keys).alias("session")).agg(
        F.max("metadata").alias("metadata")
    )
    numbers = [name for name in sessions.columns if name != "session"]
    return sessions.join(texts, "session", "left").select("session.*", *numbers, "metadata")
