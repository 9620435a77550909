"""Nearest neighbours by a permutation index.

Rows get one more component, which fills them up to the largest norm of all;
queries get a zero there. So the largest inner product is the smallest angle,
whatever the norms. A vector is then represented by its ``NEAREST`` nearest
pivots in order. Vectors of each length have an index of their own. Rows are
dealt to shards; in a shard, every pivot has an inverted file of the rows that
name it and at which place. A query adds up, over the files of its own pivots,
how far the places differ: that is Spearman's footrule of the two lists, where
a missing pivot stands behind the last place. The rows of least footrule are
then ranked by inner product.

The pivots are a bounded sample; all rows are indexed and every query visits
every shard, so what limits recall is the share of a shard that is reranked
alone. A group of tasks gets a bounded block of queries and one shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnsilver.llm.shared import stored
from learnsilver.llm.vectors import matrix, usable_rows

PIVOTS = 128
NEAREST = 24  # pivots by which a vector is represented
NEIGHBOURS = 20
RERANKED = 0.4  # of a shard, in the order of the footrule
LEAST_RERANKED = 400
SHARD_ROWS = 8_192
QUERY_BLOCK = 1_024


def representation(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The numbers of each vector's nearest pivots by inner product, nearest first."""
    products = vectors / np.linalg.norm(vectors, axis=1, keepdims=True) @ pivots.T
    return np.argsort(-products, axis=1, kind="stable")[:, :NEAREST].astype(np.int16)


def filled_up(vectors: np.ndarray, most: float) -> np.ndarray:
    """Rows with one more component, all of norm 1, in proportion to the largest norm ``most``."""
    scaled = vectors / most
    return np.hstack([scaled, np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1, keepdims=True)))])


def asking(vectors: np.ndarray) -> np.ndarray:
    """Queries with one more component."""
    return np.hstack([vectors, np.zeros((len(vectors), 1))])


def inverted_files(orders: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pivot, the rows that name it and the places at which they do."""
    flat = orders.ravel()
    by_pivot = np.argsort(flat, kind="stable")
    ends = np.cumsum(np.bincount(flat, minlength=pivots))
    return [
        (some // orders.shape[1], some % orders.shape[1])
        for some in np.split(by_pivot, ends[:-1])
    ]


def footrules(query: np.ndarray, files: list[tuple[np.ndarray, np.ndarray]], rows: int) -> np.ndarray:
    """Spearman's footrule of a query's list and those of all rows, from the inverted files.

    Two lists of n pivots with none in common are n(n+1) apart. A pivot that
    both have, at places p and q, takes 2(n - max(p, q)) off that.
    """
    n = len(query)
    near = [files[pivot] for pivot in query]
    at = np.concatenate([hit[0] for hit in near])
    off = np.concatenate([2 * (n - np.maximum(place, hit[1])) for place, hit in enumerate(near)])
    return n * (n + 1) - np.bincount(at, weights=off, minlength=rows)


def _search(cell: pd.DataFrame) -> pd.DataFrame:
    """The best of one shard for each of a block of queries."""
    asks = cell["asks"].to_numpy()
    queries, rows = cell[asks], cell[~asks].sort_values("vec_id")
    out = []
    if len(queries) and len(rows):
        ids, vectors = rows["vec_id"].to_numpy(), matrix(rows["embedding"])
        most = max(LEAST_RERANKED, int(np.ceil(RERANKED * len(rows))))
        files = inverted_files(np.stack(rows["pivots"].to_numpy()), PIVOTS) if most < len(rows) else []
        for query, own, pivots in zip(queries["vec_id"], queries["embedding"], queries["pivots"]):
            if most < len(rows):  # ties at the limit are reranked too
                far = footrules(pivots, files, len(rows))
                chosen = np.flatnonzero(far <= np.partition(far, most - 1)[most - 1])
            else:
                chosen = np.arange(len(rows))
            chosen = chosen[ids[chosen] != query]
            scores = vectors[chosen] @ np.asarray(own, dtype=np.float64)
            if len(chosen) > NEIGHBOURS:
                kept = scores >= np.partition(scores, len(scores) - NEIGHBOURS)[-NEIGHBOURS]
                chosen, scores = chosen[kept], scores[kept]
            best = np.lexsort((ids[chosen], -scores))[:NEIGHBOURS]
            out.append(pd.DataFrame({"query_id": query, "vec_id": ids[chosen][best], "score": scores[best]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


def nearest(rows: DataFrame, asks: Column) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest of ``rows`` (vec_id, embedding) to those that ``asks``.

    By inner product in double precision, nearest first, ties to the smaller
    id; all others, if there are fewer than ``NEIGHBOURS``. Vectors that are
    null, zero or hold null or non-finite components take no part, nor do rows
    without id. Rows of one id are one row, that with the smallest vector. The
    nearest are of the query's length. An empty table gives an empty table.
    Other columns are not looked at.
    """
    able = usable_rows(rows.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")))
    able = able.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    able = able.select(
        "vec_id", "embedding", F.coalesce(asks, F.lit(False)).alias("asks"), F.size("embedding").alias("size")
    )
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x))
    lengths = able.groupBy("size").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asked"), F.max(norm).alias("most")
    ).filter("asked > 0").collect()
    # Where all rows are reranked, none is represented.
    most = {row["size"]: row["most"] for row in lengths if row["n"] > LEAST_RERANKED}
    hashed = F.xxhash64(F.lit("pivot"), "vec_id")
    # A few times as many rows as are taken, so that no task sorts all of a length.
    few = F.lit(False)
    for row in lengths:
        if row["size"] in most:
            few |= (F.col("size") == row["size"]) & (F.pmod(hashed, F.lit(row["n"])) < 4 * PIVOTS)
    by_hash = Window.partitionBy("size").orderBy(hashed, "vec_id")
    sample = able.filter(few).withColumn("place", F.row_number().over(by_hash))
    sampled: dict[int, list] = {size: [] for size in most}
    for row in sample.filter(F.col("place") <= PIVOTS).select("size", "embedding").collect():
        sampled[row["size"]].append(row["embedding"])
    pivots = {size: filled_up(np.array(some, dtype=np.float64), most[size]) for size, some in sampled.items()}

    def represent(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, some in batch.groupby("size"):
                if size not in pivots:
                    yield some.assign(pivots=[[]] * len(some), asked=[[]] * len(some))
                    continue
                vectors = matrix(some["embedding"])
                asked = np.flatnonzero(some["asks"])
                lists: list = [[]] * len(some)
                for i, own in zip(asked, representation(asking(vectors[asked]), pivots[size])):
                    lists[i] = own
                yield some.assign(pivots=list(representation(filled_up(vectors, most[size]), pivots[size])), asked=lists)

    index = stored(
        able.mapInPandas(
            represent,
            "vec_id long, embedding array<double>, asks boolean, size int, pivots array<smallint>, asked array<smallint>",
        ),
        "permutations",
    )
    dealt = able.sparkSession.createDataFrame(
        [(row["size"], -(-row["n"] // SHARD_ROWS), -(-row["asked"] // QUERY_BLOCK)) for row in lengths],
        "size int, shards int, blocks int",
    )
    index = index.join(F.broadcast(dealt), "size")
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    shard = F.pmod(F.xxhash64(F.lit("shard"), "vec_id"), F.col("shards")).cast("int")
    block = F.pmod(F.xxhash64(F.lit("block"), "vec_id"), F.col("blocks")).cast("int")
    held = index.select(
        "size", shard.alias("shard"), numbers("blocks").alias("block"), F.lit(False).alias("asks"), "vec_id", "embedding", "pivots"
    )
    queries = index.filter("asks").select(
        "size", numbers("shards").alias("shard"), block.alias("block"), F.lit(True).alias("asks"), "vec_id", "embedding",
        F.col("asked").alias("pivots"),
    )
    found = held.union(queries).groupBy("size", "shard", "block").applyInPandas(
        _search, "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEIGHBOURS)
    return ranked.select("query_id", "rank", "vec_id", "score")
