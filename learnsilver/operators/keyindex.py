"""Which files of a table may hold a key: for each file its range of keys and a Bloom filter.

The filter of a file is a number of blocks of 256 bits. A key has one block,
and in it eight bits, one in each half of four longs. With the bits that files
get for each key, one key in some ten thousand is taken for one that a file
holds; none that it holds is missed. An index is a table of blocks, small
beside the keys themselves, and asked by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_BITS = 256
BITS_PER_KEY = 24
WORDS = 4

PART, FILE = "_part", "_file"


def _text(key: Column) -> Column:
    return key.cast("string")


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), key), blocks)


def _masks(key: Column) -> list[Column]:
    """The key's bits in each long of its block."""
    code = F.xxhash64(F.lit("bits"), key)

    def bit(at: int) -> Column:
        return F.shiftrightunsigned(code, at).bitwiseAND(F.lit(31)).cast("int")

    def set_at(place: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)

    return [set_at(bit(10 * k)).bitwiseOR(set_at(bit(10 * k + 5) + 32)) for k in range(WORDS)]


def built(rows: DataFrame, key: str) -> DataFrame:
    """The index of ``rows`` (part, file, and the key): a row for each file and block that has bits.

    Rows without key have no place in it. Blocks are as many as a power of two
    of the file's rows asks for. The keys of a file are not brought together:
    each task sets the bits of the keys it reads, and only blocks are shuffled.
    """
    # Files are told apart by a number here. Two that had the same would share a wider range, which misses nothing.
    keys = rows.select(PART, FILE, _text(F.col(key)).alias("_key"), F.xxhash64(PART, FILE).alias("_number")).filter(
        "_key IS NOT NULL"
    )
    files = keys.groupBy("_number").agg(
        F.min("_key").alias("least"), F.max("_key").alias("most"), F.count(F.lit(1)).alias("keys")
    )
    wanted = F.greatest(F.lit(1.0), F.col("keys") * (BITS_PER_KEY / BLOCK_BITS))
    files = files.withColumn("blocks", F.pow(F.lit(2.0), F.ceil(F.log2(wanted))).cast("bigint")).drop("keys")
    masks = [m.alias(f"w{k}") for k, m in enumerate(_masks(F.col("_key")))]
    placed = keys.join(F.broadcast(files), "_number").select(
        PART, FILE, "least", "most", "blocks", _block(F.col("_key"), F.col("blocks")).alias("block"), *masks
    )
    return placed.groupBy(PART, FILE, "least", "most", "blocks", "block").agg(
        *[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)]
    )


def candidates(index: DataFrame, keys: DataFrame) -> DataFrame:
    """(part, file): the files of an index that may hold one of ``keys`` (one column)."""
    # A few sizes, powers of two: each key is looked for under every one.
    sizes = [row.blocks for row in index.select("blocks").distinct().collect()]
    text = _text(F.col(f"`{keys.columns[0]}`"))
    asked = keys.select(text.alias("_key")).filter("_key IS NOT NULL").distinct()
    asked = asked.select("_key", F.explode(F.array(*map(F.lit, sizes)).cast("array<bigint>")).alias("blocks"))
    asked = asked.select(
        "_key", "blocks", _block(F.col("_key"), F.col("blocks")).alias("block"),
        *[m.alias(f"m{k}") for k, m in enumerate(_masks(F.col("_key")))],
    )
    met = index.join(asked, ["blocks", "block"]).filter("_key BETWEEN least AND most")
    for k in range(WORDS):
        met = met.filter(F.col(f"w{k}").bitwiseAND(F.col(f"m{k}")) == F.col(f"m{k}"))
    return met.select(PART, FILE).distinct()
