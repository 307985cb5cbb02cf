"""Joins, grouping, distinct, order and top-k by the value of terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.compare import group_key, join_key, term_eq
from ..functions.terms import lex


def value_join(a: DataFrame, b: DataFrame, left: str, right: str, how: str = "inner") -> DataFrame:
    """Join by term equality: a hashable key does the work, the exact comparison stays as a residual.

    how: inner, left, right, full, left_semi, left_anti. Column names of the two sides must differ. A null joins nothing.
    """
    x = a.withColumn("_q_a", join_key(left))
    y = b.withColumn("_q_b", join_key(right))
    return x.join(y, (F.col("_q_a") == F.col("_q_b")) & term_eq(left, right), how).drop("_q_a", "_q_b")


def value_in(a: DataFrame, column: str, values: DataFrame, right: str) -> DataFrame:
    """IN (subquery)."""
    return value_join(a, values.select(F.col(right).alias("_q_in")), column, "_q_in", "left_semi")


def value_not_in(a: DataFrame, column: str, values: DataFrame, right: str) -> DataFrame:
    return value_join(a, values.select(F.col(right).alias("_q_in")), column, "_q_in", "left_anti")


def distinct_by_value(df: DataFrame, *columns: str) -> DataFrame:
    """One row for each combination of values; of equal ones the least by text stays."""
    columns = columns or tuple(df.columns)
    rest = [c for c in df.columns if c not in columns]
    least = F.min(F.struct(*columns, *rest)).alias("_q_row")
    return df.groupBy(*[group_key(c).alias(f"_q_{c}") for c in columns]).agg(least).select(*[F.col(f"_q_row.{c}").alias(c) for c in df.columns])


def distinct_on(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key by the order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_q_k", F.row_number().over(w)).where("_q_k = 1").drop("_q_k")


def group_by_value(df: DataFrame, *columns: str):
    """Grouping by value: columns come back as _key_<name>."""
    return df.groupBy(*[group_key(c).alias(f"_key_{c}") for c in columns])


def ordered(df: DataFrame, *columns: str, descending: bool = False) -> DataFrame:
    """By text, nulls as the largest."""
    return df.orderBy(*[F.col(c).desc_nulls_first() if descending else F.col(c).asc_nulls_last() for c in columns])


def page(df: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    out = df.offset(offset) if offset else df
    return out if limit is None else out.limit(limit)


def like(x: Column, pattern: str, ignore_case: bool = False) -> Column:
    """LIKE over a term's lexical form."""
    x = lex(x)
    return x.ilike(pattern) if ignore_case else x.like(pattern)
