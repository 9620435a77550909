"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from learnsilver.llm import (
    agenda_pieces,
    block_mixture,
    chat_prefix_targets,
    davidson_whitening,
    expected,
    group_prefix_join,
    line_chunks,
    permutation_index,
    permuterm_variants,
    positive_unlabelled,
    recurrent_extraction,
    signed_fingerprints,
    sorted_projections,
    string_kernel_toxicity,
)
from learnsilver.llm.shared import held_out, importable, read

Query = Callable[[SparkSession, str], DataFrame]

#: Vocabulary file of the encoding queries.
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def model_bytes(path: str = VOCABULARY) -> bytes:
    """A model file of bounded size (half a megabyte); tasks get its bytes, not its path."""
    with open(path, "rb") as file:
        return file.read()


def op1_sorted_projections(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    return sorted_projections.near_duplicates(rows)


def op2_chat_prefix_targets(spark: SparkSession, folder: str) -> DataFrame:
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    trap = F.explode(
        F.array(*[
            F.struct(
                F.lit(-1).cast("long").alias("conv_id"), F.lit(turn).cast("long").alias("turn"),
                F.lit(role).alias("role"), F.lit(chat_prefix_targets.TRAP).alias("text"),
            )
            for turn, role in enumerate(("user", "assistant"))
        ])
    )
    added = spark.range(1).select(trap.alias("row")).select("row.*")
    return chat_prefix_targets.digests(chat_prefix_targets.examples(turns.union(added)))


def op3_string_kernel_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    machine = string_kernel_toxicity.fit_on(docs, read(spark, folder, "labels"))
    toxic = F.col("score") >= string_kernel_toxicity.LEAST_SCORE
    return string_kernel_toxicity.score(docs, machine).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", toxic.cast("int").alias("predicted")
    )


def op4_group_prefix_join(spark: SparkSession, folder: str) -> DataFrame:
    return group_prefix_join.linked(read(spark, folder, "documents").select("doc_id", "text"))


def op5_block_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return block_mixture.taken(read(spark, folder, "documents").select("doc_id", "text", "source"))


def op9_positive_unlabelled(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    model = positive_unlabelled.fit_on(docs, read(spark, folder, "labels"))
    good = F.col("score") >= positive_unlabelled.LEAST_SCORE
    return positive_unlabelled.score(docs, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", good.cast("int").alias("predicted")
    )


def op10_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return line_chunks.remove_repeated(docs)


def op6_recurrent_extraction(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages")
    return recurrent_extraction.extract(pages, recurrent_extraction.fit_on(pages))


def op7_permutation_index(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return permutation_index.nearest(rows, F.col("vec_id") % 20 == 0)


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return agenda_pieces.digests(read(spark, folder, "documents"), model_bytes())


def op11_davidson_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings").select("vec_id", "embedding")
    return davidson_whitening.whiten(rows)


def op12_signed_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents").select("doc_id", "text")
    return signed_fingerprints.fingerprints(docs, F.col("doc_id") % 50 == 0)


def op13_permuterm_variants(spark: SparkSession, folder: str) -> DataFrame:
    return permuterm_variants.variants(read(spark, folder, "documents").select("doc_id", "text"))


def queries() -> dict[str, Query]:
    found = (
        op1_sorted_projections,
        op2_chat_prefix_targets,
        op3_string_kernel_toxicity,
        op4_group_prefix_join,
        op5_block_mixture,
        op6_recurrent_extraction,
        op7_permutation_index,
        op8_sentencepiece,
        op9_positive_unlabelled,
        op10_line_chunks,
        op11_davidson_whitening,
        op12_signed_fingerprints,
        op13_permuterm_variants,
    )
    return {query.__name__: _ready(query) for query in found}


def _ready(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        importable(spark)
        return query(spark, folder)

    return run


def oracle_sql() -> dict[str, str]:
    return {
        "op1_sorted_projections": expected.SORTED_PROJECTIONS,
        "op2_chat_prefix_targets": chat_prefix_targets.ORACLE_SQL,
        "op4_group_prefix_join": expected.GROUP_PREFIX_JOIN,
        "op10_line_chunks": line_chunks.ORACLE_SQL,
        "op13_permuterm_variants": permuterm_variants.ORACLE_SQL,
    }
