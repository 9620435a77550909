"""The training-data pipeline over the documents: each stage reads what its predecessor wrote.

All stages but the last return the columns of the documents. Every row is a
document of its own throughout, also where ids are missing or repeat; other
columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnsilver.llm import (
    agenda_pieces,
    block_mixture,
    group_prefix_join,
    line_chunks,
    positive_unlabelled,
)
from learnsilver.llm.queries import model_bytes
from learnsilver.llm.shared import importable, read, stored, with_row_numbers

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Words of a block of the mixture: long enough to leave most documents whole.
BLOCK_WORDS = 512


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality classifier takes for good."""
    model = positive_unlabelled.fit_on(docs, read(spark, sf_dir, "labels"))
    whole = docs.select("text", F.struct(*docs.columns).alias("row"))
    scored = positive_unlabelled.score(whole, model)
    return scored.filter(F.col("score") >= positive_unlabelled.LEAST_SCORE).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the line chunks that an earlier one has.

    A copy of a document loses most of its lines here; it stays, with what is left.
    """
    # In the order of ids, rows of one id and rows without each by themselves.
    order = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)), "_row")
    rows = with_row_numbers(docs).select(order.alias("doc_id"), "text", F.struct(*docs.columns).alias("_document"))
    left = line_chunks.remove_repeated(rows)
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return left.select(*[changed.get(c, F.col(f"_document.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id; of rows of one id, the first."""
    rows = with_row_numbers(docs)
    found = group_prefix_join.linked(rows.select(F.col("_row").alias("doc_id"), "text"))
    linked = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("_row"), "component_id")
    heads = linked.select(F.col("component_id").alias("_row"), "component_id").distinct()
    members = stored(linked.union(heads), "members")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    kept = members.join(rows.select("_row", "doc_id"), "_row").groupBy("component_id").agg(
        F.min(order).getField("_row").alias("_kept")
    )
    lost = members.join(kept, "component_id").filter("_row <> _kept").select("_row")
    return rows.join(lost, "_row", "left_anti").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mixture of sources has them, once for each pass that drew from them."""
    return block_mixture.mixed_documents(docs, BLOCK_WORDS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, and digests of them and of what they decode to."""
    return agenda_pieces.digests(docs, model_bytes(), with_ids=True)


def _ready(stage: Stage) -> Stage:
    def apply(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        importable(spark)
        return stage(spark, docs, sf_dir)

    return apply


STAGES: list[tuple[str, Stage]] = [
    ("quality", _ready(quality)),
    ("line_dedup", _ready(line_dedup)),
    ("near_duplicates", _ready(near_duplicates)),
    ("mixture", _ready(mixture)),
    ("encoding", _ready(encoding)),
]

#: Classifier, mixture and encoding have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result but the last is written and read again."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
