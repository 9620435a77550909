"""What a load brought: row counts per table, and expected tables that are not there."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load_report(
    spark: SparkSession, read: Callable[[str], DataFrame | None], expected: Iterable[str]
) -> DataFrame:
    """One row per expected table: rows and whether it is present; a missing one has no count.

    ``read`` looks at the storage, and gives None for a table that is not
    there, as ``RawStore.read`` does.
    """
    found = {table: read(table) for table in expected}
    missing = [(table, None) for table, df in found.items() if df is None]
    counts = [
        df.agg(F.lit(table).alias("table"), F.count(F.lit(1)).alias("rows"))
        for table, df in found.items()
        if df is not None
    ]
    absent = spark.createDataFrame(missing, "table string, rows bigint")
    return reduce(DataFrame.unionByName, counts, absent).selectExpr(
        "table", "rows", "rows is not null as present"
    )
