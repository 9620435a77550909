"""Where tables come from, and what they hold, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from learnsilver.plans import REGISTRY, layer_of
from learnsilver.schemas import COLUMN_COMMENTS, CONTRACTS, Contract


def lineage(spark: SparkSession) -> DataFrame:
    """One row per input of a model: parent, child, layer of the child."""
    edges = [(i, m.name, m.layer) for m in REGISTRY.values() for i in m.inputs]
    return spark.createDataFrame(edges, "parent string, child string, layer string")


def schema_registry(spark: SparkSession) -> DataFrame:
    """One row per column of every table, with its type and descriptions."""
    rows = [
        (c.name, layer_of(c.name), c.description, len(c.columns), n, name, dtype,
         COLUMN_COMMENTS.get(name))
        for c in CONTRACTS.values()
        for n, (name, dtype) in enumerate(c.columns)
    ]
    return spark.createDataFrame(
        rows,
        "table string, layer string, description string, field_count int, position int, "
        "column string, type string, comment string",
    )


def with_comments(df: DataFrame, contract: Contract) -> DataFrame:
    """The table with its column comments, which a catalog shows."""
    comments = {n: COLUMN_COMMENTS[n] for n in contract.names if n in COLUMN_COMMENTS}
    for name, comment in comments.items():
        df = df.withMetadata(name, {"comment": comment})
    return df


def schema_differences(schema: T.StructType, contract: Contract) -> list[str]:
    """What of a table's columns, order or types is not as the contract says."""
    found = [(f.name, f.dataType.simpleString()) for f in schema]
    wanted = list(contract.columns)
    if found == wanted:
        return []
    return [f"missing {c}" for c in wanted if c not in found] + [
        f"unexpected {c}" for c in found if c not in wanted
    ] or ["columns in another order"]


def assert_schema(df: DataFrame, contract: Contract) -> None:
    differences = schema_differences(df.schema, contract)
    if differences:
        raise ValueError(f"{contract.name}: {'; '.join(differences)}")
