"""Tables of a SPARQL server as DataFrames, with what can be said in SPARQL sent along.

    rows = load(spark, table, ["s", "o"], [(Call("<", (Var("o"), Const(3))), term_lt(F.col("o"), F.lit('"3"^^<...integer>')))], limit=10)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.compare import sort_struct
from ..plans.pushdown import Call, Plan, Var, plan
from .catalog import Prefixes, Table
from .sparql import SparqlSource


def options_of(table: Table) -> dict[str, str]:
    """The reader's and the writer's options."""
    s, u = table.server, table.user
    given = {"endpoint": s.endpoint, "update_url": s.update_url, "format": s.format, "query_param": s.query_param, "custom": s.custom, "http_proxy": s.http_proxy, "https_proxy": s.https_proxy, "connect_timeout": s.connect_timeout, "request_timeout": s.request_timeout, "connect_retry": s.connect_retry, "request_redirect": s.request_redirect, "request_max_redirect": s.request_max_redirect, "max_response_size": s.max_response_size, "batch_size": s.batch_size, "base_uri": s.base_uri, "user": u.user, "password": u.password, "token": u.token, "proxy_user": u.proxy_user, "proxy_user_password": u.proxy_user_password, "pattern": table.sparql_update_pattern, "readonly": not table.writable}
    return {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in given.items() if v not in (None, "")}


def _columns(table: Table, names: list[str]) -> tuple[StructType, dict[str, str]]:
    return StructType([StructField(n, StringType()) for n in names]), {f"variable.{n}".lower(): table.columns[n].variable for n in names}


def _variables(tree: object) -> list[str]:
    if isinstance(tree, Var):
        return [tree.column]
    return [v for a in tree.args for v in _variables(a)] if isinstance(tree, Call) else []


def load(spark: SparkSession, table: Table, columns: list[str] | None = None, filters: list[tuple[object, Column]] | None = None, order: list[tuple[str, bool]] | None = None, limit: int | None = None, offset: int = 0, distinct: bool = False, prefixes: Prefixes | None = None) -> DataFrame:
    """The columns of a table's rows that pass the filters, in order (column, ascending), cut.

    A filter is its tree and the Column that says the same: trees that SPARQL can express go to the endpoint, and the Column
    is checked again on what comes back. What isn't pushed is done here, on all rows. `explain` shows which is which.
    """
    return _planned(spark, table, columns, filters, order, limit, offset, distinct, prefixes)[0]


def explain(spark: SparkSession, table: Table, columns: list[str] | None = None, filters: list[tuple[object, Column]] | None = None, order: list[tuple[str, bool]] | None = None, limit: int | None = None, offset: int = 0, distinct: bool = False, prefixes: Prefixes | None = None) -> str:
    made = _planned(spark, table, columns, filters, order, limit, offset, distinct, prefixes)[1]
    where = lambda pushed: "endpoint" if pushed else "here"
    return made.explain() + (f"\nOrder: {where(made.order_pushed)}" if order else "") + (f"\nLimit: {where(made.limit_pushed)}" if limit is not None else "")


def _planned(spark, table, columns, filters, order, limit, offset, distinct, prefixes) -> tuple[DataFrame, Plan]:
    filters, order, names = filters or [], order or [], columns or list(table.columns)
    checks = [check for _, check in filters]
    read = list(dict.fromkeys([*names, *(v for tree, _ in filters for v in _variables(tree)), *(c for c, _ in order)]))
    # a limit behind checks or DISTINCT is counted here, since these may let less through than the endpoint did
    made = plan(table, read, [tree for tree, _ in filters], order, None if checks or distinct else limit, offset, distinct and read == names, prefixes)
    spark.dataSource.register(SparqlSource)
    schema, variables = _columns(table, read)
    push = made.rewritten and not made.limit_pushed and spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true"
    rows = spark.read.format(SparqlSource.name()).schema(schema).options(**options_of(table), **variables, query=made.sparql, push_filters=push).load()
    for check in checks:
        rows = rows.where(check)
    if distinct:
        rows = rows.select(*dict.fromkeys([*names, *(c for c, _ in order)])).distinct()
    if order and (distinct or not made.order_pushed):
        rows = rows.orderBy(*[(sort_struct(F.col(c)).asc_nulls_first() if up else sort_struct(F.col(c)).desc_nulls_last()) for c, up in order])
    if offset:
        rows = rows.offset(offset)
    if limit is not None:
        rows = rows.limit(limit)
    return rows.select(*names), made


def save(rows: DataFrame, table: Table, operation: str = "insert") -> None:
    """Insert, delete or update (columns old_x beside x) by the table's update pattern."""
    rows.sparkSession.dataSource.register(SparqlSource)
    rows.write.format(SparqlSource.name()).options(**options_of(table), operation=operation).mode("append").save()


def clone_pages(spark: SparkSession, table: Table, path: str, columns: list[str] | None = None, fetch_size: int | None = None, begin_offset: int = 0, max_records: int = 0, orderby_column: str | None = "", ascending: bool = True, append: bool = False, prefixes: Prefixes | None = None) -> DataFrame:
    """Copy a table to Parquet page by page, each page kept once it is written, up to an empty page or max_records (0: all).

    Pages are by the order column: the first IRI column by default, else the first one; None leaves the order to the
    endpoint. A copy that broke off goes on with `append` and its number of rows as begin_offset. An empty table gives an
    empty file with the columns.
    """
    names, size = columns or list(table.columns), fetch_size or table.server.fetch_size
    if missing := [c for c in [*names, *filter(None, [orderby_column])] if c not in table.columns]:
        raise ValueError(f"no column {missing[0]}")
    if min(begin_offset, max_records) < 0 or size < 1:
        raise ValueError("offset and maximum must be 0 or more, fetch_size 1 or more")
    by = next((n for n in names if table.columns[n].nodetype == "iri"), names[0]) if orderby_column == "" else orderby_column
    made = plan(table, names, [], [(by, ascending)] if by else [], prefixes=prefixes)
    if not made.rewritten or by and not made.order_pushed:
        raise ValueError("pages need a query that order, offset and limit can be added to")
    spark.dataSource.register(SparqlSource)
    schema, variables = _columns(table, names)
    at, end = begin_offset, begin_offset + max_records if max_records else None
    if not append:
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
    while end is None or at < end:
        seen = Observation()
        query = f"{made.sparql}\nOFFSET {at}\nLIMIT {size if end is None else min(size, end - at)}"
        page = spark.read.format(SparqlSource.name()).schema(schema).options(**options_of(table), **variables, query=query).load()
        page.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(path)
        if not (n := seen.get["n"]):
            break
        at += n
    return spark.read.schema(schema).parquet(path)
