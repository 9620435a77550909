"""Near-duplicate vectors by sorted projection passes.

In every pass, the signs of random projections of a vector are put one behind
the other to one number; vectors are sorted by it, and each is compared with
the next ``WINDOW`` ones. Vectors at a small angle agree in the leading signs
of some pass and so stand close. Pairs of at least ``LEAST_COSINE`` are links;
those of all passes together give components.

A dense group may be wider than the windows of all passes. So the members of a
component are then compared with each other, in blocks of bounded size that
go to different tasks, and each member's links are counted; no pairs are
written for that. Vectors that are equal are one vector with a count.

The more rows a label has, the more signs must agree for two vectors to stand
close; the number of passes follows the largest label.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from learnsilver.llm.components import components
from learnsilver.llm.shared import stored
from learnsilver.llm.vectors import matrix, usable, usable_rows

LEAST_COSINE = 0.93
PASSES = 12  # at least
MOST_MISSED = 0.01  # of the pairs at ``LEAST_COSINE``, expected, for rows that the signs split evenly
WINDOW = 48
SIGNS = 62  # of a pass, in one number
PART_ROWS = 4_000  # of a sorted part
BLOCK_ROWS = 1_024  # of a component's block
BUCKETS_PER_ROW = 1 / 500  # small components are compared together, so many rows a task group


def passes(rows: int) -> int:
    """How many passes bring all but ``MOST_MISSED`` of the pairs at ``LEAST_COSINE`` together.

    In one pass, a pair stands in one window if so many leading signs agree as
    split ``rows`` to windows.
    """
    agree = 1 - math.acos(LEAST_COSINE) / math.pi
    together = agree ** math.log2(max(1, rows / WINDOW))
    if together == 1:
        return PASSES
    return max(PASSES, math.ceil(math.log(MOST_MISSED) / math.log1p(-together)))


def signatures(vectors: np.ndarray, turn: int) -> np.ndarray:
    """The signs of a pass's random projections, as one number."""
    planes = np.random.Generator(np.random.Philox(key=[turn, vectors.shape[1]])).normal(
        size=(vectors.shape[1], SIGNS)
    )
    signs = (vectors @ planes > 0).astype(np.int64)
    return signs @ (np.int64(1) << np.arange(SIGNS - 1, -1, -1, dtype=np.int64))


def _units(column: pd.Series) -> np.ndarray:
    rows = matrix(column)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _window(ids: np.ndarray, units: np.ndarray, new: int) -> Iterator[pd.DataFrame]:
    """Links between rows up to ``WINDOW`` apart; the last of the two is one of the last ``new`` rows."""
    n = len(ids)
    for apart in range(1, min(WINDOW, n - 1) + 1):
        start = max(0, n - new - apart)
        left, right = np.arange(start, n - apart), np.arange(start + apart, n)
        near = np.einsum("ij,ij->i", units[left], units[right]) >= LEAST_COSINE
        if near.any():
            yield pd.DataFrame({"a": ids[left[near]], "b": ids[right[near]]})


PAIRS = "a long, b long"
#: A found link, or (with ``border``) a row at the end of a sorted part.
FOUND = f"{PAIRS}, border int, place int, turn int, size int"
SIGNED_ROWS = 1_000  # signed at a time: each makes a row for every pass


def _compare_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links inside a sorted part, and its first and last rows, for its neighbours."""
    part = TaskContext.get().partitionId()
    key = ["turn", "label", "size"]
    held, first = None, 0
    for batch in batches:
        if first < WINDOW:
            head = batch.head(WINDOW - first)
            yield _border(head, part - 1, range(WINDOW + first, WINDOW + first + len(head)))
            first += len(head)
        for _, run in batch.groupby(key, sort=False, dropna=False):
            new = len(run)
            if held is not None and held[key].iloc[0].equals(run[key].iloc[0]):
                run = pd.concat([held, run])
            yield from _window(run["id"].to_numpy(), _units(run["embedding"]), new)
            held = run.tail(WINDOW)
        last = batch.tail(WINDOW) if len(batch) >= WINDOW or first <= len(batch) else pd.concat([last, batch]).tail(WINDOW)
    if first:
        yield _border(last, part, range(WINDOW - len(last), WINDOW))


def _border(rows: pd.DataFrame, border: int, places: range) -> pd.DataFrame:
    return rows.rename(columns={"id": "a"}).assign(border=border, place=list(places))


def _compare_borders(rows: pd.DataFrame) -> pd.DataFrame:
    """Links over a border between two sorted parts: of at most two windows of rows."""
    found = [pd.DataFrame({"a": [], "b": []}, dtype=np.int64)]
    rows = rows.sort_values("place", kind="stable")
    for _, run in rows.groupby(["turn", "label", "size"], sort=False, dropna=False):
        found += _window(run["a"].to_numpy(), _units(run["embedding"]), int((run["place"] >= WINDOW).sum()))
    return pd.concat(found)


def _in_component(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of each member of a block with the members of another, or its own block."""
    out = []
    for _, some in rows.groupby("component", sort=False):
        blocks = [some[some["block"] == b] for b in sorted(set(some["block"]))]
        one, two = blocks[0], blocks[-1]
        near = _units(one["embedding"]) @ _units(two["embedding"]).T >= LEAST_COSINE
        if len(blocks) == 1:
            np.fill_diagonal(near, False)
        else:
            out.append(pd.DataFrame({"id": two["id"], "links": near.T @ one["copies"].to_numpy()}))
        out.append(pd.DataFrame({"id": one["id"], "links": near @ two["copies"].to_numpy()}))
    return pd.concat(out)


def links(distinct: DataFrame) -> DataFrame:
    """(a, b): pairs of ``distinct`` (id, label, embedding) that the passes find; both ways may occur."""
    groups = distinct.groupBy("label", F.size("embedding")).agg(F.count(F.lit(1)).alias("n"))
    rows, largest = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n"), F.lit(0))).first()
    turns = passes(largest)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), SIGNED_ROWS):
                part = batch.iloc[start : start + SIGNED_ROWS]
                for size, some in part.groupby(part["embedding"].map(len)):
                    vectors = matrix(some["embedding"])
                    for turn in range(turns):
                        yield some.assign(turn=turn, size=size, key=signatures(vectors, turn))

    kind, label = (distinct.schema[name].dataType.simpleString() for name in ("embedding", "label"))
    signed = distinct.select("id", "label", "embedding").mapInPandas(
        sign, f"id long, label {label}, embedding {kind}, turn int, size int, key long"
    )
    parts = max(1, -(-rows * turns // PART_ROWS))
    order = ["turn", "label", "size", "key", "id"]
    ranged = signed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    compared = ranged.mapInPandas(lambda it: _outer(_compare_parts(it), label), f"{FOUND}, label {label}, embedding {kind}")
    found = stored(compared, "passes")
    over = found.filter("border IS NOT NULL").groupBy("border").applyInPandas(_compare_borders, PAIRS)
    return found.filter("border IS NULL").select("a", "b").union(over)


def _outer(frames: Iterator[pd.DataFrame], label: str) -> Iterator[pd.DataFrame]:
    """The frames with all columns of ``FOUND``, the label and the vector, null where they have none."""
    columns = dict(part.split() for part in FOUND.split(", ")) | {"label": {"bigint": "long"}.get(label, label)}
    numbers = {name: kind.replace("long", "Int64").replace("int", "Int32") for name, kind in columns.items() if kind in ("long", "int")}
    for frame in frames:
        whole = frame.reindex(columns=[*columns, "embedding"]).astype(numbers)
        for name in {"label", "embedding"} - {*frame.columns, *numbers}:
            whole[name] = None
        yield whole


def _label(rows: DataFrame) -> Column:
    """The label as something to sort by that only equal labels share: a long, or text."""
    kind, label = rows.schema["label"].dataType, F.col("label")
    if isinstance(kind, T.IntegralType):
        return label.cast("long")
    if isinstance(kind, T.FractionalType):
        label = label + F.lit(0).cast(kind)  # one zero
    return F.to_json(label) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else label.cast("string")


def near_duplicates(rows: DataFrame) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``rows`` (vec_id, embedding, label).

    Links are between vectors of one label and length with a cosine of
    ``LEAST_COSINE`` or more. Vectors that are null, zero or hold null or
    non-finite components, and rows without label, link with nothing; labels of
    any type are equal or not, as they are, text too; rows
    without id neither, and have no component. Repeated rows are vectors of
    their own, linked with each other. An empty table gives an empty table.
    Other columns are not looked at.
    """
    able = usable_rows(rows.select("vec_id", "label", "embedding")).filter("label IS NOT NULL")
    able = able.select("vec_id", _label(able).alias("label"), "embedding")
    alike = ["label", "embedding"]
    distinct = stored(
        able.groupBy(*alike).agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "vectors"
    )
    member = able.join(distinct, alike).select("vec_id", "id", "copies")
    found = components(links(distinct), "vector_stars").select(F.col("node").alias("id"), "component")
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    placed = stored(distinct.join(found, "id").join(sizes, "component").drop("label"), "members")

    blocks = F.ceil(F.col("members") / BLOCK_ROWS)
    dealt = placed.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int"))
    cells = dealt.select("*", F.explode(F.sequence(F.lit(0), (blocks - 1).cast("int"))).alias("other"))
    buckets = max(1, int(placed.count() * BUCKETS_PER_ROW))
    cells = cells.select(
        "id", "copies", "embedding", "component", "block",
        F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
        # Small components share a group, the cells of a large one have a group each.
        F.when(blocks > 1, F.xxhash64("component")).otherwise(F.pmod(F.xxhash64("component"), F.lit(buckets))).alias("group"),
    )
    counted = cells.groupBy("group", "one", "two").applyInPandas(_in_component, "id long, links long")
    counted = counted.groupBy("id").agg(F.sum("links").alias("links"))
    classes = placed.select("id", "component").join(counted, "id", "left")
    known = member.join(classes, "id", "left").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    rest = rows.select("vec_id", "label", "embedding").filter(
        ~(F.col("vec_id").isNotNull() & F.col("label").isNotNull()) | ~usable(F.col("embedding"))
    )
    alone = rest.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return known.union(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))
    )
