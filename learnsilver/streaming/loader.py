"""The periodic load as a stream: all that is new, in batches, each merged once."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from learnsilver.operators.ingestion import CONCURRENT_LOADS
from learnsilver.operators.rawstore import RawStore
from learnsilver.operators.states import Folder
from learnsilver.schemas import DEFAULT_COLLECTIONS, RAW, STATEMENTS_TABLE
from learnsilver.sources.documents import (
    parse_documents,
    rejected_documents,
    table_of,
    valid_documents,
)
from learnsilver.sources.statements import flatten_pages, rejected_parts

# Fixed value: how often the load runs when it runs by itself.
INTERVAL = "15 minutes"


def landed_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """New text files of a folder, such as documents or pages, as a stream of lines."""
    return spark.readStream.format("text").options(**options).load(path)


def merge_stream(
    stream: DataFrame,
    store: RawStore,
    table: str,
    key: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    interval: str | None = None,
    rejects: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Merge a stream into a raw table.

    ``rejects`` says what of a batch could not be read; it is appended to the
    table ``<table>_rejected``.

    Without an interval the query takes all that is there and ends. A batch
    that is repeated after a failure is known by its number and not loaded
    twice; the stream itself says what is new, so the cursor is not used to
    filter, only recorded.
    """

    def load(batch: DataFrame, number: int) -> None:
        name = f"{checkpoint}#{number}"
        if rejects:
            store.append(f"{table}_rejected", rejects(batch), batch=name)
        store.merge(table, prepare(batch), key, batch=name, changed_only=False)

    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(load)
    trigger = {"processingTime": interval} if interval else {"availableNow": True}
    return writer.trigger(**trigger).start()


def load_landed(
    spark: SparkSession,
    store: RawStore,
    landing: str,
    checkpoints: str,
    collections: Iterable[str] = tuple(DEFAULT_COLLECTIONS),
) -> None:
    """Merge the exported files that no run before has seen, each collection from its folder.

    The checkpoints know the files; what could not be read of them is kept in
    ``<table>_rejected``. A collection without a folder is not there yet.
    """
    there = set(Folder(spark, landing).names())

    def load(collection: str) -> None:
        table = table_of(collection)

        def parsed(batch: DataFrame) -> DataFrame:
            return parse_documents(batch, RAW[table])

        merge_stream(
            landed_stream(spark, f"{landing}/{collection}"), store, table, RAW[table].key,
            f"{checkpoints}/{table}",
            prepare=lambda batch: valid_documents(parsed(batch)),
            rejects=lambda batch: rejected_documents(parsed(batch)),
        ).awaitTermination()

    with ThreadPoolExecutor(CONCURRENT_LOADS) as pool:
        list(pool.map(load, [name for name in collections if name in there]))


def load_landed_pages(
    spark: SparkSession,
    store: RawStore,
    landing: str,
    checkpoint: str,
    interval: str | None = None,
    files_at_once: int | None = None,
    page_per_file: bool = False,
) -> StreamingQuery:
    """Merge the statements of landed pages that no run before has seen.

    Pages are lines of text files, or whole files with ``page_per_file``.
    ``files_at_once`` bounds a batch, so that a long backlog is loaded in
    pieces. Unreadable pages and elements are kept in
    ``lrs_statements_rejected``. Without an interval the query ends when all
    that is there has been loaded.
    """
    options = {"wholetext": str(page_per_file).lower()}
    if files_at_once:
        options["maxFilesPerTrigger"] = str(files_at_once)
    return merge_stream(
        landed_stream(spark, landing, **options), store, STATEMENTS_TABLE, RAW[STATEMENTS_TABLE].key,
        checkpoint, prepare=flatten_pages, rejects=rejected_parts, interval=interval,
    )
