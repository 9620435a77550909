"""Documents of equal or nearly equal word shingles, by a grouped prefix join.

A document is the set of its five-word shingles, as 64-bit hashes. Two sets
link when they share 80 % of their union. With all shingles in one order, two
linked sets share one among their first fifth (the prefix). The order is that of the hashes with the
common shingles last, the commonest at the end, so that prefixes meet on rare
ones. Which order is taken changes the work, never the result.

* Documents of one prefix and size form a group; a group is posted once, under
  each shingle of its prefix. Sizes and places in the prefix rule out most
  pairs of groups that meet.
* The remaining pairs are expanded and verified on the whole sets. What is
  asked for is components, so first each group is compared with one hub of
  every list it is in, and each document of a group with the group's first.
  Documents that are already connected need no more comparison. What is left
  of the lists is then expanded to documents, and all pairs that are not
  connected are verified: no link between components is lost.

A list that near copies fill so costs as many comparisons as it is long.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnsilver.llm.components import components
from learnsilver.llm.shared import hashed_words, mixed, small_batches, stored, text_of

WORDS = 5
#: Shingles that stand last in the order, at most; a bounded list for every task.
COMMONEST = 500_000
LEAST_COMMON = 6  # documents
ROWS_IN_BATCH, BYTES_IN_BATCH = 1_000, 4_000_000  # that go to Python at a time
BYTES_AT_ONCE = 300_000  # of text, or one longer text
#: Up to so many ids (some megabytes) are sent to the tasks that read the sets; more are joined by id.
MOST_SENT = 300_000
STAR_ROUNDS = 1

#: Odd multipliers of the words of a shingle, and of its length: fixed random values.
_FACTORS = np.random.default_rng(20).integers(1, 2**63, WORDS + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _sums(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` words in a row."""
    count = len(words) - width + 1
    total = np.full(count, width, np.uint64) * _FACTORS[WORDS]
    for k in range(width):
        total += words[k : k + count] * _FACTORS[k]
    return mixed(total)


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def shingle_sets(texts: Iterable[str]) -> Iterator[np.ndarray]:
    """The set of each text's shingles, sorted: all words as one, if there are fewer than five.

    Words are runs of anything but ASCII white space, A-Z as a-z.
    """
    held: list[bytes] = []
    size = 0
    for text in texts:
        held.append(text.encode("utf-8", "surrogatepass").lower())
        size += len(held[-1]) + 1
        if size > BYTES_AT_ONCE:
            yield from _sets_of(held)
            held, size = [], 0
    yield from _sets_of(held)


def _sets_of(texts: list[bytes]) -> Iterator[np.ndarray]:
    if not texts:
        return
    starts, words = hashed_words(b"\n".join(texts))
    ends = np.searchsorted(starts, np.cumsum([len(text) + 1 for text in texts])).tolist()
    # Also the shingles that reach over the end of a text; they are left out of the sets.
    every = _sums(words, WORDS) if len(words) >= WORDS else words
    for start, end in zip([0, *ends], ends):
        width = min(WORDS, end - start)
        if width == WORDS:
            yield _distinct(every[start : end - WORDS + 1])
        else:
            yield _sums(words[start:end], width) if width else np.empty(0, np.uint64)


def prefix_length(n: int) -> int:
    """Of two linked sets, each shares a shingle among so many of its first ones."""
    return n - -(-4 * n // 5) + 1


def _digest(array: np.ndarray) -> tuple[int, int]:
    raw = xxhash.xxh3_128_digest(array.tobytes())
    return tuple(np.frombuffer(raw, np.int64).tolist())


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.concatenate([np.empty(0, np.uint64), *rows]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _common(texts: DataFrame) -> np.ndarray:
    """The commonest shingles (the upper 40 bits) of ``texts`` (doc_id, text), from rare to common."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in shingle_sets(text.as_py() for text in batch.column(1)):
                if len(own):
                    yield pa.RecordBatch.from_arrays([pa.array((own >> np.uint64(24)).view(np.int64))], ["shingle"])

    counted = texts.mapInArrow(_together(run), "shingle long").groupBy("shingle").agg(F.count(F.lit(1)).alias("documents"))
    common = counted.filter(F.col("documents") >= LEAST_COMMON)
    chosen = common.orderBy(F.desc("documents"), "shingle").limit(COMMONEST).select("shingle")
    with small_batches(texts.sparkSession, ROWS_IN_BATCH, BYTES_IN_BATCH):
        found = chosen.toArrow()["shingle"]
    return found.to_numpy().astype(np.uint64)[::-1]


def _together(run):
    """Batches of some ten thousand rows in place of many small ones."""

    def gathered(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in run(batches):
            held.append(batch)
            size += batch.num_rows
            if size >= 50_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, size = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return gathered


def ranks(shingle: np.ndarray, common: np.ndarray, order: np.ndarray) -> np.ndarray:
    """What goes before the hash in the order: how common a shingle is, 0 for all rare ones.

    ``common`` is sorted, and ``order`` says how common each is.
    """
    out = np.zeros(len(shingle), np.int32)
    if len(common):
        upper = shingle >> np.uint64(24)
        at = np.minimum(np.searchsorted(common, upper), len(common) - 1)
        known = common[at] == upper
        out[known] = order[at[known]] + 1
    return out


PREFIXES = "doc_id long, n long, s1 long, s2 long, g1 long, g2 long, prefix array<long>"


def _prefixes(texts: DataFrame) -> DataFrame:
    """Of every row the size and a digest of its set, its prefix, and a digest of that."""
    rare_first = _common(texts)
    by_value = np.argsort(rare_first)
    shared = texts.sparkSession.sparkContext.broadcast((rare_first[by_value], by_value.astype(np.int32)))

    def prefix_of(own: np.ndarray) -> np.ndarray:
        rank = ranks(own, *shared.value)
        if rank.any():
            own = own[np.argsort(rank, kind="stable")]
        return own[: prefix_length(len(own))] if len(own) else own

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts, prefixes = [], []
            for own in shingle_sets(text.as_py() for text in batch.column(1)):
                prefixes.append(prefix_of(own))
                facts.append((len(own), *_digest(own), *_digest(prefixes[-1])))
            columns = np.array(facts, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, columns), _lists(prefixes)],
                [part.split()[0] for part in PREFIXES.split(", ")],
            )

    with small_batches(texts.sparkSession, ROWS_IN_BATCH, BYTES_IN_BATCH):
        return stored(texts.mapInArrow(run, PREFIXES), "prefixes")


def _may_link(n: Column, m: Column, at_n: Column, at_m: Column) -> Column:
    """Whether sets of these sizes, whose first common shingle is at these places, can link."""
    return 9 * F.least(n - at_n, m - at_m) >= 4 * (n + m)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b): those of the pairs (hub, other) whose whole sets link."""
    pairs = stored(pairs.distinct(), "pairs")
    needed = stored(pairs.select(F.col("hub").alias("doc_id")).union(pairs.select("other")).distinct(), "pair_ids")
    if needed.count() <= MOST_SENT:
        needed = F.broadcast(needed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(text.as_py() for text in batch.column(1)))
            sizes = pa.array([len(own) for own in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, _lists(sets)], ["doc_id", "n", "own"])

    found = texts.join(needed, "doc_id", "left_semi")
    with small_batches(texts.sparkSession, ROWS_IN_BATCH, BYTES_IN_BATCH):
        found = stored(found.mapInArrow(run, "doc_id long, n long, own array<long>"), "pair_sets")
    others = pairs.join(found.select(F.col("doc_id").alias("other"), "n", "own"), "other")
    hubs = found.select(F.col("doc_id").alias("hub"), F.col("n").alias("m"), F.col("own").alias("hubs"))
    met = others.join(hubs, "hub").filter(5 * F.least("n", "m") >= 4 * F.greatest("n", "m"))
    both = F.size(F.array_intersect("own", "hubs"))
    linked_pairs = met.filter(100 * both >= 80 * (F.col("n") + F.col("m") - both))
    return stored(linked_pairs.select(F.col("hub").alias("a"), F.col("other").alias("b")), "links")


def _connected(nodes: DataFrame, links: list[DataFrame]) -> DataFrame:
    """``nodes`` (node, ..) with the component each is in by the links so far."""
    found = components(reduce(DataFrame.union, links), "document_stars")
    return nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _open(lists: DataFrame) -> DataFrame:
    """The rows of lists that hold more than one component."""
    whole = Window.partitionBy("token")
    known = lists.withColumn("_least", F.min("component").over(whole)).withColumn("_most", F.max("component").over(whole))
    return known.filter("_least <> _most").drop("_least", "_most")


def _stars(lists: DataFrame, turn: int) -> DataFrame:
    """(hub, other): each row of a list with the list's hub, if they can link and are not connected.

    Lists are cut by size, in other places each turn. First, the hub is the
    row that has fewest rarer shingles, which is nearest to what the list has in
    common; then, any.
    """
    step = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25)) + turn / STAR_ROUNDS)
    cut = lists.withColumn("_step", step)
    nearest = [F.col("pos")] if turn == 0 else []
    first = Window.partitionBy("token", "_step").orderBy(*nearest, F.xxhash64(F.lit(turn), "node"), "node")
    hubbed = cut.select("*", *[F.first(c).over(first).alias(f"_{c}") for c in ("node", "n", "pos", "component")])
    able = _may_link(F.col("n"), F.col("_n"), F.col("pos"), F.col("_pos"))
    found = hubbed.filter((F.col("component") != F.col("_component")) & able)
    return found.select(F.col("_node").alias("hub"), F.col("node").alias("other"))


def _crossing(lists: DataFrame) -> DataFrame:
    """(hub, other): all pairs of a list's rows that can link and are not connected.

    Every such pair has a row outside the component that has most rows there.
    """
    counts = lists.groupBy("token", "component").agg(F.count(F.lit(1)).alias("_rows"))
    order = Window.partitionBy("token").orderBy(F.desc("_rows"), "component")
    main = counts.withColumn("_place", F.row_number().over(order)).filter("_place = 1")
    main = main.select("token", F.col("component").alias("_main"))
    known = stored(lists.join(main, "token"), "lists")
    minor = known.filter("component <> _main").select(
        "token", *[F.col(c).alias(f"_{c}") for c in ("node", "n", "pos", "component")]
    )
    once = (F.col("component") == F.col("_main")) | (F.col("node") < F.col("_node"))
    able = _may_link(F.col("n"), F.col("_n"), F.col("pos"), F.col("_pos"))
    met = known.join(minor, "token").filter((F.col("component") != F.col("_component")) & once & able)
    return met.select(F.col("node").alias("hub"), F.col("_node").alias("other"))


def linked(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest id reachable by links. Null and empty
    texts and texts without words have no shingles and link with nothing. Rows
    of one id are one document, which links where one of its texts does; rows
    without id link with nothing and have no component. An empty table gives an
    empty table. Other columns are not looked at.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    sets = _prefixes(texts)
    able = sets.filter("n > 0 AND doc_id IS NOT NULL")
    # Documents of one set are one node, under the smallest id.
    same = ["n", "s1", "s2"]
    nodes = able.groupBy(*same, "g1", "g2").agg(F.min("doc_id").alias("node"))
    alike = ["n", "g1", "g2"]
    groups = nodes.groupBy(*alike).agg(F.min("node").alias("group"), F.count(F.lit(1)).alias("members"))
    nodes = stored(nodes.join(groups, alike), "nodes")

    # A group is posted under each shingle of its prefix; what no other group has is not kept.
    posted = able.join(
        nodes.filter("node = group").select(*same, F.col("node").alias("doc_id")), [*same, "doc_id"], "left_semi"
    )
    postings = posted.select(
        F.col("doc_id").alias("group"), "n", F.posexplode("prefix").alias("pos", "token")
    )
    met = Window.partitionBy("token")
    shared = postings.withColumn("_rows", F.count(F.lit(1)).over(met)).filter("_rows > 1").drop("_rows")
    # (Repeated rows are posted repeatedly; that makes no pair more.)
    shared = stored(shared, "postings")
    # The documents of a group are a list of their own.
    own = nodes.filter("members > 1").select(
        F.xxhash64(F.lit("group"), *alike).alias("token"), "node", "n", F.lit(0).alias("pos")
    )
    lists = shared.select("token", F.col("group").alias("node"), "n", "pos").union(own)

    nodes = nodes.select("node", "group", "n").distinct()
    links: list[DataFrame] = [nodes.sparkSession.createDataFrame([], "a long, b long")]
    known = nodes.withColumn("component", F.col("node"))
    for turn in range(STAR_ROUNDS):
        open_lists = stored(_open(lists.join(known.select("node", "component"), "node")), "open_lists")
        links.append(_verified(_stars(open_lists, turn), texts))
        known = stored(_connected(nodes, links), "connected")
    # Now every document stands in the lists of its group.
    columns = ["token", "node", "n", "pos", "component"]
    every = shared.join(known.select("group", "node", "component"), "group").select(columns)
    every = every.union(own.join(known.select("node", "component"), "node").select(columns))
    links.append(_verified(_crossing(_open(every)), texts))
    known = _connected(nodes, links)

    of_set = able.groupBy(*same).agg(F.min("doc_id").alias("node"))
    of_set = stored(of_set.join(known.select("node", "component"), "node").select(*same, "component"), "classes")
    found = sets.select("doc_id", *same).join(of_set, same, "left")
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
    )
