"""What several operators need: tables in the shared folder, words, and row order."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache
from pathlib import Path

import numpy as np
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Binary digits of a row's place in its file.
ROWS_IN_FILE = 40
#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def importable(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it.

    For local sessions and shared folders; a cluster without any gets the
    library by ``--py-files``, and this changes nothing there.
    """
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [path for path in environment.get("PYTHONPATH", "").split(os.pathsep) if path]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share.

    The folder is the session's ``spark.checkpoint.dir``; where that is unset,
    as in tests, a folder beside the warehouse. Who owns the folder empties it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.conf.get("spark.sql.warehouse.dir") + "/_scratch"
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read again.

    Cuts the lineage: what reads the result does not repeat what made it, and
    a lost executor takes nothing with it.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_row_numbers(docs: DataFrame, name: str = "_row") -> DataFrame:
    """``docs`` with a number that is each row's own, whatever its other columns: its file's and its place there.

    The same each time the files are read, however they are split among tasks.
    Rows that do not come straight from files are written first. One short row
    for each file comes to the driver.
    """
    try:
        placed = docs.withColumn(name, F.col("_metadata.row_index")).withColumn("_path", F.col("_metadata.file_path"))
    except AnalysisException:
        return with_row_numbers(stored(docs, "rows"), name)
    paths = sorted(row[0] for row in placed.select("_path").distinct().collect())
    numbers = docs.sparkSession.createDataFrame(
        [(path, i << ROWS_IN_FILE) for i, path in enumerate(paths)], "_path string, _file long"
    )
    known = placed.join(F.broadcast(numbers), "_path")
    return known.withColumn(name, F.col("_file") + F.col(name)).select(*docs.columns, name)


def text_of(column: str) -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def held_out(doc_id: str) -> Column:
    """One row in five, by id alone: never learnt from."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


@contextmanager
def small_batches(spark: SparkSession, rows: int, size: int | None = None) -> Iterator[None]:
    """For what is run inside: at most so many rows go to Python at a time, and about so many bytes."""
    wanted = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}
    if size:
        wanted["spark.sql.execution.arrow.maxBytesPerBatch"] = str(size)
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the one of splitmix64; its constants are fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bytes of a word above which its hash is not a polynomial.
LONG_WORD = 256
#: An odd multiplier of a word's bytes: a fixed random value.
_BASE = int(np.random.default_rng(20).integers(1, 2**63, 7, dtype=np.uint64)[-1]) * 2 + 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the byte multiplier, and of its inverse, modulo 2**64."""
    out = []
    for base in (_BASE % 2**64, pow(_BASE, -1, 2**64)):
        powers = np.full(size, base, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers))
    return out[0], out[1]


def hashed_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text start, and their hashes: polynomials of their bytes, mixed."""
    points = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[points], [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = turns[::2], turns[1::2]
    forth, back = _powers(1 << max(18, len(points).bit_length()))
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum((points + np.uint64(1)) * forth[: len(points)], out=sums[1:])
    hashes = mixed((sums[ends] - sums[starts]) * back[starts])
    # Different words can share a polynomial whatever its base, but only long ones.
    for k in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        hashes[k] = xxhash.xxh3_64_intdigest(data[starts[k] : ends[k]])
    return starts, hashes
