"""SPARQL's functions under SQL names, as temporary SQL functions of a session.

    register(spark)
    spark.sql("SELECT sparql_lang(label), sparql_strlen(label) FROM labels")

Each is the SQL text of the same built-in expressions that the Python functions are made of, which Catalyst puts in place of
the call, so filters and pruning work through it. Comparisons and aggregates have no SQL names: the former bind their
operands in lambdas, which have no SQL text, and SQL functions can't aggregate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import strings as S
from . import terms as T

#: Arguments and their types, and the expression over them.
FUNCTIONS: dict[str, tuple[str, Callable[..., Column]]] = {
    "lex": ("x string", T.lex),
    "bound": ("x string", T.bound),
    "sameterm": ("x string, y string", T.same_term),
    "isiri": ("x string", T.is_iri),
    "isuri": ("x string", T.is_iri),
    "isblank": ("x string", T.is_blank),
    "isliteral": ("x string", T.is_literal),
    "isnumeric": ("x string", T.is_numeric),
    "str": ("x string", T.str_),
    "lang": ("x string", T.lang),
    "datatype": ("x string", T.datatype),
    "iri": ("x string", T.iri),
    "uri": ("x string", T.iri),
    "bnode": ("x string", T.bnode),
    "strdt": ("x string, y string", T.strdt),
    "strlang": ("x string, y string", T.strlang),
    "arguments_compatible": ("x string, y string", T.compatible),
    "langmatches": ("x string, y string", T.lang_matches),
    "strlen": ("x string", S.strlen),
    "substr": ("x string, start int, length int DEFAULT 1073741824", S.substr),
    "ucase": ("x string", S.ucase),
    "lcase": ("x string", S.lcase),
    "strstarts": ("x string, y string", S.strstarts),
    "strends": ("x string, y string", S.strends),
    "contains": ("x string, y string", S.contains),
    "strbefore": ("x string, y string", S.strbefore),
    "strafter": ("x string, y string", S.strafter),
    "encode_for_uri": ("x string", S.encode_for_uri),
    "concat": ("x string, y string", S.concat),
    "abs": ("x string", S.abs_),
    "round": ("x string", S.round_),
    "ceil": ("x string", S.ceil),
    "floor": ("x string", S.floor),
    "year": ("x string", S.year),
    "month": ("x string", S.month),
    "day": ("x string", S.day),
    "hours": ("x string", S.hours),
    "minutes": ("x string", S.minutes),
    "seconds": ("x string", S.seconds),
    "timezone": ("x string", S.timezone),
    "tz": ("x string", S.tz),
    "md5": ("x string", S.md5),
}


def sql_text(spark: SparkSession, parameters: str, body: Callable[..., Column]) -> str:
    """The expression as SQL over the parameters' names."""
    declared = [p.split()[:2] for p in parameters.split(", ")]
    row = spark.range(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in declared])
    made = row.select(body(*[F.col(name) for name, _ in declared]).alias("made"))
    return made._jdf.queryExecution().analyzed().projectList().head().child().sql()


def register(spark: SparkSession, prefix: str = "sparql_", names: Iterable[str] = tuple(FUNCTIONS)) -> list[str]:
    """Create or replace the functions, all or those named; their SQL names."""
    for name in names:
        parameters, body = FUNCTIONS[name]
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURN {sql_text(spark, parameters, body)}")
    return [prefix + name for name in names]
