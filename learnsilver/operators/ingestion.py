"""The raw load as a job: document collections and statements into the raw store."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame

from learnsilver.operators.rawstore import RawStore
from learnsilver.schemas import DEFAULT_COLLECTIONS, RAW, STATEMENTS_TABLE
from learnsilver.sources.documents import table_of
from learnsilver.sources.statements import flatten_pages

# Collections are loaded side by side; each table has its own log.
CONCURRENT_LOADS = 8


def load_collections(
    store: RawStore,
    read: Callable[[str], DataFrame],
    collections: Iterable[str] = tuple(DEFAULT_COLLECTIONS),
    since: str | None = None,
    overlap: str | None = None,
) -> dict[str, int]:
    """Merge what changed in each collection into its raw table; rows loaded per table.

    ``read`` returns a collection as the columns of its raw table, however it
    is reached: exported files, a connector, or a table made for a test. A
    collection without a cursor column is loaded whole.
    """

    def load(collection: str) -> tuple[str, int]:
        table = table_of(collection)
        df = read(collection)
        return table, store.merge(table, df, RAW[table].key, since=since, overlap=overlap)

    with ThreadPoolExecutor(CONCURRENT_LOADS) as pool:
        return dict(pool.map(load, collections))


def load_statements(
    store: RawStore, pages: DataFrame, since: str | None = None, overlap: str | None = None
) -> int:
    """Merge the statements of landed pages that were stored after the last load."""
    key = RAW[STATEMENTS_TABLE].key
    return store.merge(STATEMENTS_TABLE, flatten_pages(pages), key, since=since, overlap=overlap)
