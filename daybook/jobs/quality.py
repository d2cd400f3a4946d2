"""Data-quality report (PIP-21): null counts per column, as rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_report(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: (table_name, column_name, rows, nulls).

    One scan with one ``count_if`` per column, then ``stack`` turns the
    single aggregate row into rows."""
    cols = list(columns or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', __n{i}" for i, c in enumerate(cols))
    out = agg.selectExpr("__rows", f"stack({len(cols)}, {pairs}) AS (column_name, nulls)")
    return out.select(F.lit(table).alias("table_name"), "column_name",
                      F.col("__rows").cast("long").alias("rows"), F.col("nulls").cast("long").alias("nulls"))


def null_reports(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [null_report(df, name) for name, df in tables.items()])


def expect_not_null(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """The declared ``not_null`` tests: rows with status pass/fail."""
    r = null_report(df, table, columns)
    return r.withColumn("status", F.when(F.col("nulls") == 0, "pass").otherwise("fail"))
