"""Pages of xAPI statements, as landed from a statement store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnsilver.functions.columns import utc_from_text
from learnsilver.schemas import RAW, STATEMENTS_TABLE

_RECORD = ",".join(f"`{name}`:string" for name in RAW[STATEMENTS_TABLE].names)
# Scheme and host of an address; a page may name its successor with or without.
_HOST = "^[A-Za-z][A-Za-z0-9+.-]*://[^/]*"


def _elements(column: str) -> str:
    """The elements of a page, each as its JSON text; NULL where there are none or they cannot be read."""
    page = f"`{column}`"
    return (
        f"if(startswith(ltrim({page}), '['), from_json({page}, 'array<string>'), "
        f"from_json({page}, 'struct<statements:array<string>>').statements)"
    )


_IS_RECORD = "startswith(ltrim(element), '{')"


def flatten_pages(pages: DataFrame, column: str = "value") -> DataFrame:
    """One row per statement of a page.

    A page is an object with a ``statements`` array, or the bare array. Its
    elements are read one by one: what is no object costs itself alone. The
    statements' JSON parts stay as text; an element that is a string with the
    text of an object is read as that object. Pages and elements that cannot
    be read give no row here; they are what ``rejected_pages`` and
    ``rejected_elements`` return.
    """
    found = pages.selectExpr(f"explode({_elements(column)}) as element").filter(_IS_RECORD)
    return found.selectExpr(f"from_json(element, 'struct<{_RECORD}>') as s").selectExpr(
        *[
            f"{utc_from_text(f's.`{name}`')} as `{name}`"
            if dtype == "timestamp_ntz"
            else f"s.`{name}`"
            for name, dtype in RAW[STATEMENTS_TABLE].columns
        ]
    )


def rejected_pages(pages: DataFrame, column: str = "value") -> DataFrame:
    """The pages whose statements cannot be read, as they came.

    An object without ``statements`` is a page without statements, and no
    reject.
    """
    page = f"`{column}`"
    empty = (
        f"schema_of_variant(try_parse_json({page})) like 'OBJECT%' "
        f"and get_json_object({page}, '$.statements') is null"
    )
    return pages.filter(f"{_elements(column)} is null and not coalesce({empty}, false)")


def rejected_elements(pages: DataFrame, column: str = "value") -> DataFrame:
    """(place, element): what stands among the statements of a page and is none.

    Places count from 0 in the page. The element is its JSON text, ``null`` for
    a null.
    """
    found = pages.selectExpr(f"posexplode({_elements(column)}) as (place, element)")
    return found.filter(f"not coalesce({_IS_RECORD}, false)").selectExpr(
        "place", "coalesce(element, 'null') as element"
    )


def rejected_parts(pages: DataFrame, column: str = "value") -> DataFrame:
    """(place, text): unreadable pages, without a place, and elements that are no statements."""
    whole = rejected_pages(pages, column).select(F.lit(None).cast("int").alias("place"), F.col(column).alias("text"))
    return whole.union(rejected_elements(pages, column).toDF("place", "text"))


def page_links(pages: DataFrame, address: str = "address", column: str = "value") -> DataFrame:
    """(address, more): each landed page and the page that it says comes next.

    ``more`` is NULL where a page is the last one: it names none, an empty one,
    or is a bare array. Addresses are without scheme and host.
    """
    more = F.expr(f"if(startswith(ltrim(`{column}`), '{{'), get_json_object(`{column}`, '$.more'), null)")
    links = pages.select(F.col(address).alias("address"), F.nullif(more, F.lit("")).alias("more"))
    return links.select(*[F.regexp_replace(name, _HOST, "").alias(name) for name in links.columns])
