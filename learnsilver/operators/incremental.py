"""Incremental loading: cursors, latest version per key, upsert, append."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnsilver.functions.columns import utc_from_text
from learnsilver.functions.jsonx import quoted

EPOCH = "1970-01-01 00:00:00"
# Names of the time of the last change, in order of preference,
# and the names it falls back to when the state is computed.
CHANGE_FIELDS = ("modified_on", "updatedAt", "updated_at", "modifiedAt")
CREATION_FIELDS = ("created_on", "createdAt")
STATEMENT_FIELDS = ("stored", "timestamp")
# The time of the last change as parsed documents hold it, whatever its name there.
CHANGED_AT = "_changed_at"


def present(df: DataFrame, names: tuple[str, ...]) -> list[str]:
    """The given columns the table has, in the given order; names are case-sensitive."""
    return [name for name in names if name in df.columns]


def cursor_column(df: DataFrame) -> str | None:
    """The column that tells when a row last changed, judged from the schema."""
    found = present(df, (CHANGED_AT, "stored", *CHANGE_FIELDS))
    return found[0] if found else None


def as_cursor(text: str | None) -> str:
    """A cursor value as a SQL timestamp; the start of time when it is missing or unreadable."""
    return f"coalesce({utc_from_text(quoted(text or EPOCH))}, timestamp_ntz'{EPOCH}')"


def changed_since(
    df: DataFrame,
    since: str | None,
    columns: list[str] | None = None,
    overlap: str | None = None,
) -> DataFrame:
    """Rows changed strictly after ``since``, and rows that do not say when they changed.

    One cursor column is used; with several, a row counts when any of them is
    later, or none is set. A table without any is loaded whole. ``overlap`` (an
    interval, such as ``1 hour``) reads that much again, for late rows; the
    upsert makes all that harmless.
    """
    if columns is None:
        found = cursor_column(df)
        columns = [found] if found else []
    if not columns:
        return df
    bound = F.expr(as_cursor(since) + (f" - interval {overlap}" if overlap else ""))
    later = reduce(lambda a, b: a | b, [F.col(f"`{c}`") > bound for c in columns])
    unsaid = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNull() for c in columns])
    return df.filter(later | unsaid)


def cursor_of(df: DataFrame) -> str:
    """A row's own cursor: the first of the known times that is set."""
    names = present(df, STATEMENT_FIELDS) if "stored" in df.columns else present(
        df, (CHANGED_AT, *CHANGE_FIELDS, *CREATION_FIELDS)
    )
    if not names:
        return "cast(null as timestamp_ntz)"
    return "coalesce(" + ", ".join(f"`{name}`" for name in names) + ")"


def cursor_state(df: DataFrame, table: str) -> DataFrame:
    """One row: the table and the latest cursor in the rows."""
    return df.selectExpr(f"{cursor_of(df)} as at").agg(
        F.lit(table).alias("table"), F.max("at").alias("last_cursor")
    )


def _hashable(field: T.StructField) -> str:
    """A column as something to hash: maps as sorted entries, variants as their text."""
    name = f"`{field.name}`"
    if isinstance(field.dataType, T.MapType):
        return f"to_json(array_sort(map_entries({name})))"
    return f"to_json({name})" if isinstance(field.dataType, T.VariantType) else name


def latest_per_key(df: DataFrame, key: str, keyless: str | None = None) -> DataFrame:
    """One row per key: the latest by cursor, ties broken by a hash of the whole row.

    Rows without a key are no versions of each other: all of them stay. Spark
    keeps one row per key on the map side already (window group limit), so a
    key with very many versions does not reach one task whole, nor do the rows
    without key. ``keyless`` names a column that tells those rows; they are
    sorted by it then, and a write that is partitioned by it sorts no more.
    """
    hashes = ", ".join(map(_hashable, df.schema))
    order = [F.expr(cursor_of(df)).desc_nulls_last(), F.expr(f"xxhash64({hashes})")]
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    rows = df.withColumn("_alone", alone)
    if keyless:
        rows = rows.withColumn(keyless, F.col(key).isNull())
    versions = Window.partitionBy(*([keyless] if keyless else []), key, "_alone").orderBy(*order)
    ranked = rows.withColumn("_rank", F.row_number().over(versions))
    return ranked.filter("_rank = 1").drop("_rank", "_alone")


def upsert(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Replace the rows whose key comes in, keep the others, add the new ones.

    ``incoming`` must hold a key once (see ``latest_per_key``). Spark sends its
    keys to the target's tasks or joins by key, by their size.
    """
    kept = target.join(incoming.select(key), key, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def append(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """All rows of both."""
    return target.unionByName(incoming, allowMissingColumns=True)
