"""Mixing sources to target weights, by fixed-length blocks of words.

The documents of a source, in a pseudorandom order, are laid end to end and cut
into blocks of ``block_words`` words; a mixture is a list of blocks. The number
of slots a source gets in every output shard is a multinomial draw; its slots,
numbered through all shards, go through pseudorandom permutations of the
source's block numbers (one permutation for each pass over the source), and the
blocks are joined by number. Draws hang on the seed and the shard alone, so a
run that is repeated, in part or whole, gives the same mixture.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnsilver.llm.shared import WORD, mixed, stored, text_of

WEIGHTS = (5, 2, 1)  # of the sources in order, repeating
SHARE = 1.5  # words of the mixture, of all words
MOST_PASSES = 2  # times a source may be used
BLOCK_WORDS = 64
SHARD_SLOTS = 4096  # slots of an output shard
SHARDS_IN_SUM = 1024  # shards whose draws are summed by one task
SHARDS_IN_TASK = 32  # shards that are laid out by one task
BUCKET_ROWS = 20_000  # documents of a source that are laid out by one task
#: One row for each source is held by the driver; more is refused, not cut off.
MOST_SOURCES = 100_000


#: One for each round of a permutation: multiples of the golden ratio's 64 bits.
_SALTS = np.arange(4, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Sources:
    """One entry for each source, in order: by code point, null last."""

    names: list[str | None]
    sizes: np.ndarray  # words
    targets: np.ndarray  # words
    blocks: np.ndarray
    quotas: np.ndarray  # slots


def targets(sizes: np.ndarray, weights: np.ndarray, share: float, most: float) -> np.ndarray:
    """``share`` of all words by weight, none above ``most`` times its size.

    What is above goes to the sources still below, by weight, until none is.
    """
    limit = most * sizes
    out = np.zeros(len(sizes))
    free = limit > 0
    rest = share * sizes.sum()
    while free.any():
        offer = np.where(free, rest * weights / weights[free].sum(), 0.0)
        full = free & (offer >= limit)
        if not full.any():
            return np.where(free, offer, out)
        out[full] = limit[full]
        rest -= limit[full].sum()
        free &= ~full
    return out


def _sources(sized: DataFrame, block_words: int) -> Sources:
    rows = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MOST_SOURCES + 1).collect()
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    rows = sorted(rows, key=lambda row: (row.source is None, row.source or ""))
    sizes = np.array([row["size"] for row in rows], dtype=np.int64)
    weights = np.resize(np.array(WEIGHTS, dtype=float), len(rows))
    aim = targets(sizes, weights, SHARE, MOST_PASSES)
    blocks = -(-sizes // block_words)
    with np.errstate(invalid="ignore"):
        passes = np.where(sizes > 0, aim / np.maximum(sizes, 1), 0.0)
    quotas = np.minimum(np.rint(passes * blocks).astype(np.int64), MOST_PASSES * blocks)
    return Sources([row.source for row in rows], sizes, aim, blocks, quotas)


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a pseudorandom permutation of 0 .. n-1, chosen by ``key``, takes each index.

    A Feistel network over the next even power of two, walked on until the
    result is below n.
    """
    half = ((np.ceil(np.log2(np.maximum(n, 2))).astype(np.int64) + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    key, out = key.astype(np.uint64), index.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for salt in _SALTS:
            turned = mixed(right ^ (key[todo] + salt))
            left, right = right, left ^ (turned & mask[todo])
        out[todo] = (left << half[todo]) | right
        todo = out >= n.astype(np.uint64)
    return out.astype(np.int64)


def _slots(spark, sources: Sources, seed: int) -> DataFrame:
    """(shard, slot, source_no, pass, block): every slot of the mixture.

    Joins with it carry a merge hint: Spark would take it for as small as the
    list of shards it is made from, and broadcast it.
    """
    total = int(sources.quotas.sum())
    width = SHARD_SLOTS
    shards = -(-total // width)
    quotas, blocks = sources.quotas, sources.blocks
    chances = quotas / max(1, total)

    def draw(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The multinomial draw of each shard."""
        for batch in batches:
            for shard in batch["id"]:
                slots = min(width, total - shard * width)
                chance = np.random.Generator(np.random.Philox(key=[seed, shard]))
                counts = chance.multinomial(slots, chances)
                first = np.cumsum(counts) - counts
                some = np.nonzero(counts)[0]
                yield pd.DataFrame(
                    {"shard": shard, "source_no": some, "first": first[some], "count": counts[some]}
                )

    drawn = spark.range(shards).mapInPandas(draw, "shard long, source_no int, first long, count long")
    drawn = stored(drawn, "draws")
    # Sums run in two steps, first over groups of shards, so that no task gets all shards of a source.
    grouped = drawn.withColumn("group", F.floor(F.col("shard") / SHARDS_IN_SUM))
    before = Window.unboundedPreceding, -1
    groups = grouped.groupBy("source_no", "group").agg(F.sum("count").alias("drawn"))
    of_groups = Window.partitionBy("source_no").orderBy("group").rowsBetween(*before)
    starts = groups.select("source_no", "group", F.coalesce(F.sum("drawn").over(of_groups), F.lit(0)).alias("start"))
    of_shards = Window.partitionBy("source_no", "group").orderBy("shard").rowsBetween(*before)
    within_group = F.coalesce(F.sum("count").over(of_shards), F.lit(0))
    numbered = grouped.withColumn("within", within_group).join(starts, ["source_no", "group"])
    numbered = numbered.withColumn("offset", F.col("start") + F.col("within"))
    # Draws beyond a source's quota go, in order, to the sources that were drawn too seldom.
    got = np.zeros(len(quotas), dtype=np.int64)
    for row in drawn.groupBy("source_no").agg(F.sum("count").alias("n")).collect():
        got[row.source_no] = row.n
    spare, lack = np.maximum(got - quotas, 0), np.maximum(quotas - got, 0)
    spare_from, lack_upto = np.cumsum(spare) - spare, np.cumsum(lack)

    def place(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                within = np.arange(row.count)
                k, source = row.offset + within, np.full(row.count, row.source_no)
                over = k >= quotas[source]
                number = spare_from[source[over]] + k[over] - quotas[source[over]]
                source[over] = np.searchsorted(lack_upto, number, side="right")
                taker = source[over]
                k[over] = got[taker] + number - (lack_upto[taker] - lack[taker])
                turn, index = k // blocks[source], k % blocks[source]
                keys = mixed(mixed((source * MOST_PASSES + turn).astype(np.uint64)) ^ np.uint64(seed))
                slots = np.full(len(k), min(width, total - row.shard * width))
                shard_key = np.full(len(k), (row.shard + 1) * 7919, dtype=np.uint64)
                yield pd.DataFrame({
                    "shard": row.shard, "slot": permute(row.first + within, slots, shard_key),
                    "source_no": source.astype(np.int32), "pass": turn.astype(np.int32),
                    "block": permute(index, blocks[source], keys),
                })

    # A few rows of each shard make thousands of slots: they are dealt by slots, not by their own size.
    dealt = numbered.select("shard", "source_no", "first", "count", "offset").repartition(
        max(1, -(-shards // SHARDS_IN_TASK)), "shard"
    )
    return dealt.mapInPandas(
        place, "shard long, slot long, source_no int, pass int, block long"
    )


def _numbered(sized: DataFrame, sources: Sources, *carried: str) -> DataFrame:
    """``sized`` with source_no, and ``offset``: where a document starts among its source's words.

    Sums run in two steps, first over buckets of documents, so that no task
    gets all documents of a source. Columns ``carried`` come along; documents
    alike in id and size are in their order.
    """
    spark = sized.sparkSession
    names = spark.createDataFrame(
        [(name, i) for i, name in enumerate(sources.names)], "name string, source_no int"
    )
    known = sized.join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    buckets = max(1, known.count() // BUCKET_ROWS)
    order = F.xxhash64(F.lit("order"), "doc_id")
    dealt = known.withColumn("bucket", F.pmod(F.xxhash64(F.lit("bucket"), "doc_id"), F.lit(buckets)))
    earlier = Window.partitionBy("source_no").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("source_no", "bucket").agg(F.sum("size").alias("words")).select(
        "source_no", "bucket", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start")
    )
    within = (
        Window.partitionBy("source_no", "bucket")
        .orderBy(order, "doc_id", "size", *carried)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = dealt.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    found = placed.join(starts, ["source_no", "bucket"]).select(
        "doc_id", "source_no", "size", (F.col("start") + F.col("before")).alias("offset"), *carried
    )
    return stored(found, "offsets")


def _spans(numbered: DataFrame, block_words: int, *carried: str) -> DataFrame:
    """(doc_id, source_no, offset, block, start, end): which words of a document a block holds.

    Start and end count from the document's first word. Columns ``carried`` come along.
    """
    first = F.floor(F.col("offset") / block_words)
    last = F.floor((F.col("offset") + F.col("size") - 1) / block_words)
    cut = numbered.filter("size > 0").select("*", F.explode(F.sequence(first, last)).alias("block"))
    begin = F.col("block") * block_words - F.col("offset")
    return cut.select(
        "doc_id", "source_no", "offset", "block",
        F.greatest(begin, F.lit(0)).alias("start"),
        F.least(begin + block_words, F.col("size")).alias("end"),
        *carried,
    )


#: All digits of times, so that rows that differ in the last one differ in their JSON.
_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _row_key(docs: DataFrame) -> Column:
    """A digest of all columns of a row: rows that share it are equal, and one stands for all."""
    text = F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("null"))
    others = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]), _JSON)
    return F.sha2(F.concat_ws(" ", text, others), 256)


def _sized(docs: DataFrame, *carried: Column) -> DataFrame:
    """Sizes of the documents, written down: the texts are read once."""
    words = F.regexp_count(text_of("text"), F.lit(WORD)).cast("long")
    sizes = docs.select("doc_id", F.col("source").cast("string").alias("source"), words.alias("size"), *carried)
    return stored(sizes, "sizes")


def mixture(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 11) -> DataFrame:
    """(shard, slot, source_no, pass, block, doc_id, start, end): the mixture, as word spans.

    In the order of shard, slot, offset its spans make the mixed text.
    """
    sized = _sized(docs)
    sources = _sources(sized, block_words)
    spans = _spans(_numbered(sized, sources), block_words)
    slots = _slots(docs.sparkSession, sources, seed)
    return slots.join(spans.hint("merge"), ["source_no", "block"])


def taken(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 11) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row of ``docs`` (doc_id, text, source).

    ``size``: its words; ``source_size`` and ``target``: those of its source;
    ``taken``: the words of it that the mixture holds, repeats counted. Null
    text has no words; null source is a source, the last one; null and repeated
    ids are documents of their own; a source without words has target 0; an
    empty table gives an empty table. Other columns are not looked at.
    """
    sized = _sized(docs)
    sources = _sources(sized, block_words)
    numbered = _numbered(sized, sources)
    uses = _slots(docs.sparkSession, sources, seed).groupBy("source_no", "block").agg(
        F.count(F.lit(1)).alias("uses")
    )
    held = _spans(numbered, block_words).join(uses.hint("merge"), ["source_no", "block"])
    used = held.groupBy("source_no", "offset").agg(
        F.sum((F.col("end") - F.col("start")) * F.col("uses")).alias("used")
    )
    facts = docs.sparkSession.createDataFrame(
        [(i, int(size), float(aim)) for i, (size, aim) in enumerate(zip(sources.sizes, sources.targets))],
        "source_no int, source_size long, target double",
    )
    # Documents without words share their offset with the next one, and take nothing.
    found = numbered.join(used.hint("merge"), ["source_no", "offset"], "left").join(F.broadcast(facts), "source_no")
    return found.select(
        "doc_id", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.coalesce("used", F.lit(0))).otherwise(0).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: int = 11) -> DataFrame:
    """The documents as the mixture has them, with the columns of ``docs``.

    A row for every document and pass over its source in which a word of it was
    drawn; its text is what was drawn in that pass: the whole text if all words
    were, else its drawn words with one space between. ``n_chars`` follows the
    text where there is such a column. Null and repeated ids are documents of
    their own, whatever their texts.
    """
    key = _row_key(docs)
    sized = _sized(docs, key.alias("_key"))
    sources = _sources(sized, block_words)
    spans = _spans(_numbered(sized, sources, "_key"), block_words, "_key")
    slots = _slots(docs.sparkSession, sources, seed).select("source_no", "block", "pass")
    drawn = spans.join(slots.hint("merge"), ["source_no", "block"]).groupBy("_key", "source_no", "offset", "pass").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans")
    )
    drawn = drawn.select(F.col("_key").alias("_drawn"), "_spans")
    rows = docs.select(key.alias("_key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    rows = rows.dropDuplicates(["_key"])
    joined = rows.join(drawn.hint("merge"), F.col("_key") == F.col("_drawn"))
    words = F.regexp_extract_all("_row.text", F.lit(f"({WORD})"))
    chosen = F.transform(F.array(words), lambda all_words: F.array_join(F.flatten(F.transform(
        F.col("_spans"),
        lambda span: F.slice(all_words, (span.start + 1).cast("int"), (span.end - span.start).cast("int")),
    )), " "))[0]
    count = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, span: n + span.end - span.start)
    text = F.when(count == F.regexp_count("_row.text", F.lit(WORD)), F.col("_row.text")).otherwise(chosen)
    out = joined.select("_row", text.alias("_text"))
    changed = {"text": F.col("_text"), "n_chars": F.length("_text").cast("long")}
    return out.select(*[changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])
