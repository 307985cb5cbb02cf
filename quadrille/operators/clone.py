"""Materialise a table, whole or page by page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def clone(source: DataFrame, path: str, begin_offset: int = 0, fetch_size: int = 0, max_records: int = 0, orderby_column: str | None = "", sort_order: str = "ASC", columns: list[str] | None = None) -> DataFrame:
    """Write rows to Parquet and read them back. Without limits it is one pass; with a maximum or offset the order column
    decides which rows count (the first column by default; None: no order)."""
    if min(begin_offset, fetch_size, max_records) < 0 or sort_order.upper() not in ("ASC", "DESC"):
        raise ValueError("offsets, sizes and limits must be 0 or more, sort_order ASC or DESC")
    names = columns or source.columns
    if missing := [c for c in names if c not in source.columns]:
        raise ValueError(f"no column {missing[0]}")
    out = source.select(*names)
    if begin_offset or max_records:
        if orderby_column is not None:
            c = F.col(orderby_column or source.columns[0])
            rest = [F.col(n) for n in names if n != (orderby_column or source.columns[0])]
            out = source.orderBy(c.asc_nulls_last() if sort_order.upper() == "ASC" else c.desc_nulls_first(), *rest).select(*names)
        out = out.offset(begin_offset)
        if max_records:
            out = out.limit(max_records)
    out.write.mode("overwrite").parquet(path)
    spark: SparkSession = source.sparkSession
    return spark.read.parquet(path)
